"""Language identification by hyperdimensional letter profiles.

Every letter owns a random vector of +1 and -1, made from its code point, so no table is stored. An n-gram
binds its letters: the first one's vector is permuted (rolled) twice, the second's once, and the three are
multiplied. A text bundles (adds) its n-gram vectors; a language's prototype bundles the texts that are
labelled with it. The language whose prototype has the greatest cosine with the text's vector is predicted.

Prototypes are learned from a bounded sample: of each language some ``per_language`` documents, those whose id
has a hash below the share that this is of all, outside the held-out fold. All texts are read whole, when learning and when predicting.

Defined results: letters are lowered, everything else counts as one blank; a null text, an empty one and one
without letters gets ``und`` and score 0. Ties go to the language that sorts first. Rows with a null
``lang`` are predicted but not learned from; with none to learn from all texts get ``und``. A null id counts
as the id ``''``. Repeated rows get the same result; an empty table gives no rows. The score is the cosine,
0 where it is negative.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from adloom.llm.common import held_out, mix64, slices, text_of
from adloom.session import ship_package

DIMENSIONS = 1024
ORDER = 3
PER_LANGUAGE = 2000
UNKNOWN = "und"
SEED = 0x5DEECE66D
SLICE, SLICE_ROWS = 256 << 10, 256  # bytes of text and rows that a task turns into vectors at once
_DENSE = 1 << 20  # cells of a table that is counted into directly; larger ones are sorted
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its own value if it is a letter or a mark that goes with one, otherwise a blank."""
    table = np.full(0x110000, _BLANK, np.uint32)
    letters = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L" or unicodedata.category(chr(c)) == "Mn"]
    table[letters] = letters
    return table


def _letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """The +1/-1 vector of each code point, drawn from its value."""
    words = np.arange(-(-dimensions // 64), dtype=np.uint64)
    bits = mix64(mix64(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)) + words[None, :])
    signs = np.unpackbits(bits.view(np.uint8), axis=1)[:, :dimensions]
    return (signs.astype(np.int8) * 2 - 1).astype(np.int8)


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of texts: the distinct ones as rows of letters, and for each text and gram its count.

    Returns ``(grams, text index, gram index, count)``; grams that hold no letter are left out.
    """
    joined = (" " * ORDER).join(["", *[(t or "").lower() for t in texts], ""])
    points = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.array([len((t or "").lower()) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes + ORDER)
    owner = np.concatenate([np.zeros(ORDER, np.int64), owner]) if len(texts) else np.zeros(0, np.int64)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != _BLANK) | (points[:-1] != _BLANK)  # runs of blanks are one
    points, owner = points[keep], owner[keep]
    if len(points) < ORDER:
        empty = np.zeros(0, np.int64)
        return np.zeros((0, ORDER), np.uint32), empty, empty, empty
    alphabet, code = np.unique(points, return_inverse=True)
    size = len(alphabet)
    key = np.zeros(len(points) - ORDER + 1, np.int64)
    for place in range(ORDER):
        key = key * size + code[place : len(points) - ORDER + 1 + place]
    # a blank between two texts belongs to both; a gram with letters on either side of it to neither
    first, last = np.full(len(key), len(texts)), np.full(len(key), -1)
    for place in range(ORDER):
        letter, own = points[place : place + len(key)] != _BLANK, owner[place : place + len(key)]
        first = np.minimum(first, np.where(letter, own, len(texts)))
        last = np.maximum(last, np.where(letter, own, -1))
    has = first == last
    key, middle = key[has], first[has]
    if size**ORDER <= _DENSE:
        present = np.flatnonzero(np.bincount(key, minlength=1))
        lookup = np.zeros(size**ORDER, np.int64)
        lookup[present] = np.arange(len(present))
        index = lookup[key]
    else:
        present, index = np.unique(key, return_inverse=True)
    width = max(len(present), 1)
    pair = middle * width + index
    if len(texts) * width <= _DENSE:
        counted = np.bincount(pair, minlength=1)
        cells = np.flatnonzero(counted)
        counts = counted[cells]
    else:
        cells, counts = np.unique(pair, return_counts=True)
    grams = np.stack([alphabet[(present // size ** (ORDER - 1 - place)) % size] for place in range(ORDER)], axis=1)
    return grams.astype(np.uint32), cells // width, cells % width, counts


def text_vectors(texts: list[str | None], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bundled vector of each text; zero where it has no letter."""
    grams, owner, gram, count = gram_counts(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    alphabet, code = np.unique(grams, return_inverse=True)
    code = code.reshape(grams.shape)
    letters = _letter_vectors(alphabet, dimensions)
    order = np.argsort(gram, kind="stable")
    owner, gram, count = owner[order], gram[order], count[order]
    for start in range(0, len(grams), 4096):
        bound = np.ones((len(grams[start : start + 4096]), dimensions), np.int8)
        for place in range(ORDER):
            bound *= np.roll(letters, ORDER - 1 - place, axis=1)[code[start : start + 4096, place]]
        first, last = np.searchsorted(gram, [start, start + len(bound)])
        dense = np.zeros((len(texts), len(bound)), np.float32)
        dense[owner[first:last], gram[first:last] - start] = count[first:last]
        out += dense @ bound.astype(np.float32)
    return out


def learn_prototypes(documents: DataFrame, dimensions: int = DIMENSIONS, per_language: int = PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit prototype of each language in ``documents`` (``doc_id, text, lang``), held-out fold aside.

    What reaches the driver is one vector per language and task of a sample that is bounded per language.
    """
    ship_package(documents.sparkSession)
    usable = documents.where(F.col("lang").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)  # the same in every run
    sample = usable.where(draw < F.element_at(shares, F.col("lang"))).select("doc_id", "lang", "text")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, limit=SLICE, rows=SLICE_ROWS):
            langs = batch.column(1).to_pylist()
            vectors = text_vectors(batch.column(2).to_pylist(), dimensions)
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            vectors /= np.where(norms == 0, 1, norms)
            for lang in sorted(set(langs)):
                part = vectors[[i for i, x in enumerate(langs) if x == lang]].sum(axis=0, dtype=np.float64)
                sums[lang] = sums[lang] + part if lang in sums else part
        columns = [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "vector"])

    totals: dict[str, np.ndarray] = {}
    for row in sorted(sample.mapInArrow(bundle, "lang string, vector array<double>").collect()):
        totals[row["lang"]] = totals.get(row["lang"], 0) + np.array(row["vector"])
    norms = {lang: float(np.linalg.norm(v)) for lang, v in totals.items()}
    return {lang: (totals[lang] / norms[lang]).astype(np.float32) for lang in sorted(totals) if norms[lang] > 0}


def predict_languages(documents: DataFrame, prototypes: dict[str, np.ndarray], *keep: str, within: str | None = None) -> DataFrame:
    """Columns ``keep`` of every row, ``lang_pred`` and ``score``.

    ``within`` names a struct among ``keep`` that holds the text, which then is not sent a second time.
    """
    ship_package(documents.sparkSession)
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((1, DIMENSIONS), np.float32)
    rows = documents.select(*keep) if within else text_of(documents, *keep)
    kept = rows.schema.fields[: len(keep)]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    columns_out = [f.name for f in schema.fields]

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column(columns_out.index(within)), "text") if within else batch.column(len(kept))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], [str(i) for i in range(len(kept))] + ["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(with_text(batches), limit=SLICE, rows=SLICE_ROWS):
            texts = batch.column(len(kept)).to_pylist()
            vectors = text_vectors(texts, matrix.shape[1])
            norms = np.linalg.norm(vectors, axis=1)
            lettered = np.array([any(map(str.isalpha, t or "")) for t in texts])  # marks alone are no letters
            known = lettered & (norms > 0) & bool(names)
            cosines = vectors @ matrix.T / np.where(norms == 0, 1, norms)[:, None]
            labels = [names[b] if k else UNKNOWN for b, k in zip(cosines.argmax(axis=1), known, strict=True)]
            scores = np.where(known, np.clip(cosines.max(axis=1), 0, 1), 0).astype(np.float64)
            columns = [*batch.columns[: len(kept)], pa.array(labels, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, columns_out)

    return rows.mapInArrow(run, schema)
