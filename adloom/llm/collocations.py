"""Phrase collocation mining by SETM: relations of occurrences, merge-joined and pruned length by length.

1. Texts are dealt out by document and cut into pieces and words in Arrow batches. Each word is a row of the
   first occurrence relation ``(doc, at, phrase)``; ``at`` is the piece in its upper half and the word's place in
   the piece in its lower one, so words next to each other in a piece have addresses next to each other, and
   words of two pieces never do. A phrase carries its language in front, behind a tab. The relation is stored
   once with its phrase's id, bucketed by document and sorted by ``(doc, at)``.
2. A group-count gives the frequency of each phrase, combined on the map side. Only occurrences of frequent
   phrases go on (semi-join), as ids of 64 bits that are checked to be different for all frequent phrases of a
   length. Words are told by their stored ids if no other word has the id of a frequent one. The relation then is merge-joined with itself, ``at`` with ``at + 1``: a phrase and the one a word further
   on make a phrase one word longer, which the pair of their ids stands for. Both sides lie in the same buckets,
   so nothing is shuffled, and an occurrence meets one partner at most.
3. That repeats up to the greatest length, from the stored relation of the length before.
4. Scores, cuts and the drop rule are equi-joins of the frequent phrases alone. Ranks come from the best of each
   language and salt, which are few.

Frequent phrases (words, then pairs of ids) are broadcast to the semi-join if no more than ``BROADCAST_ROWS`` (counted,
some 100 MB at most); with more of them it is an ordinary join, and the occurrences are dealt out by document once more.

Defined results: null texts count as empty, null languages as ``und``. Only A-Z are lowered; pieces end at
``. , ; : ! ?`` and line ends, words at blanks and tabs. Repeated rows count each. Scores are exact: products
are decimals of 38 digits. Languages without a candidate, and an empty table, give no rows. ``doc_id`` and
extra columns are not read. A text longer than a batch is cut at the end of a word, piece and place carried on.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.llm.common import slices, text_bytes
from adloom.session import durable, fresh_path, ship_package

LEAST = 30  # occurrences of a phrase
LONGEST = 4  # words of a phrase
TOP = 2000  # phrases of a language
COVERED = 80  # per cent of a phrase's occurrences inside one longer phrase, from which it is dropped
SCALE = 2_000_000
BROADCAST_ROWS = 1_000_000
SALTS = 64
BATCH = 2 << 20  # bytes of text that a task cuts at once
# one file per bucket is read in its order; rows that share a bucket by document need no other place to join by address
_IN_PLACE = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


# --- occurrences -------------------------------------------------------------------------------------
def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of texts laid end to end: each word's text, piece in that text, place in that piece, and the words."""
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    start = np.flatnonzero(first)
    text = np.searchsorted(offsets, start, "right") - 1
    stops = np.flatnonzero(kind == 2)
    piece = np.searchsorted(stops, start) - np.searchsorted(stops, offsets)[text]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
    count = np.arange(len(start))
    place = count - np.maximum.accumulate(np.where(fresh, count, 0)) if len(start) else count
    letters = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    ends = np.append(letters[start], letters[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return text, piece, place, words


def _windows(data: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """A long text in parts that end between words, with the number of pieces before and of words before in the piece."""
    start, pieces, places = 0, 0, 0
    while start < len(data):
        stop = min(start + size, len(data))
        if stop < len(data):
            gaps = np.flatnonzero(_KIND[data[start:stop]])
            while not len(gaps) and stop < len(data):
                stop = min(stop + size, len(data))
                gaps = np.flatnonzero(_KIND[data[start:stop]])
            stop = start + int(gaps[-1]) + 1 if len(gaps) else stop
        part = data[start:stop]
        yield part, pieces, places
        stops = np.flatnonzero(_KIND[part] == 2)
        if len(stops):
            pieces, places = pieces + len(stops), 0
        rest = _KIND[part[int(stops[-1]) + 1 if len(stops) else 0 :]] == 0
        places += int(rest[:1].sum() + (rest[1:] & ~rest[:-1]).sum())
        start = stop


def cut_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, at, phrase`` of every word of ``doc, lang, text``."""

    def rows(doc: pa.Array, lang: pa.Array, data: np.ndarray, offsets: np.ndarray, pieces: int = 0, places: int = 0) -> pa.RecordBatch:
        text, piece, place, words = cut_words(data, offsets)
        place = place + np.where(piece == 0, places, 0)
        at = ((piece.astype(np.int64) + pieces) << 32) + place
        phrase = pc.binary_join_element_wise(lang.take(pa.array(text)), words, "\t")
        return pa.RecordBatch.from_arrays([doc.take(pa.array(text)), pa.array(at), phrase], ["doc", "at", "phrase"])

    for batch in slices(batches, limit=BATCH, rows=1 << 16):
        data, offsets = text_bytes(batch)
        if batch.num_rows == 1 and len(data) > BATCH:
            for part, pieces, places in _windows(data, BATCH):
                yield rows(batch.column(0), batch.column(1), part, np.array([0, len(part)]), pieces, places)
        else:
            yield rows(batch.column(0), batch.column(1), data, offsets)


class _Relations:
    """Stored occurrence relations, bucketed by document and sorted; their tables are dropped at the end."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def store(self, occurrences: DataFrame) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = occurrences.write.bucketBy(self.buckets, "doc").sortBy("doc", "at").option("compression", "zstd")
        writer.option("path", fresh_path(self.spark, "occurrences")).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _longer(occurrences: DataFrame) -> DataFrame:
    """Occurrences of phrases one word longer: ``doc, at`` and the phrases ``front`` and ``back`` that make them."""
    follow = occurrences.select(F.col("doc").alias("doc_"), (F.col("at") - 1).alias("at_"), F.col("id").alias("back"))
    same = (F.col("doc") == F.col("doc_")) & (F.col("at") == F.col("at_"))
    return occurrences.join(follow.hint("merge"), same).select("doc", "at", F.col("id").alias("front"), "back")


def _mark(seed: int, *columns: str):
    return F.xxhash64(F.lit(seed), *columns)


def _marked(phrases: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """Frequent phrases with an ``id`` of 64 bits and the seed of these ids, which no two of them share."""
    written, seed = durable(phrases), 0
    while True:
        marked = written.withColumn("id", _mark(seed, *columns))
        rows, ids = marked.agg(F.count("*"), F.count_distinct("id")).first()
        if rows == ids:
            return marked, seed
        seed += 1


def _stands_alone(frequent: DataFrame, counts: DataFrame) -> bool:
    """Whether no other phrase has the id of a frequent one, so that the stored ids tell the frequent ones."""
    same = counts.withColumn("id", _mark(0, "phrase")).join(frequent.select("id"), "id", "left_semi")
    return same.count() == frequent.count()


def frequent_phrases(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, buckets: int | None = None, broadcast_rows: int = BROADCAST_ROWS
) -> tuple[list[DataFrame], DataFrame]:
    """Per length from one word on ``phrase, f`` with ``f >= least``, and ``lang, n`` with the count of all words."""
    spark = documents.sparkSession
    ship_package(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    relations = _Relations(spark, buckets)
    texts = documents.select(
        F.monotonically_increasing_id().alias("doc"), F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = texts.repartition(buckets, "doc").sortWithinPartitions("doc")

    def kept(occurrences: DataFrame, frequent: DataFrame, seed: int, *columns: str) -> tuple[DataFrame, bool]:
        """Occurrences of frequent phrases by their ids, and whether they still lie by document."""
        few = frequent.count() <= broadcast_rows
        phrases = frequent.select(*columns)
        stay = occurrences.join(F.broadcast(phrases) if few else phrases, list(columns), "left_semi")
        return stay.select("doc", "at", "id" if columns == ("id",) else _mark(seed, *columns).alias("id")), few

    with _settings(spark, _IN_PLACE):
        cut = dealt.mapInArrow(cut_documents, "doc bigint, at bigint, phrase string")
        occurrences = relations.store(cut.withColumn("id", _mark(0, "phrase")))
        counts = durable(occurrences.groupBy("phrase").agg(F.count("*").alias("f")))
        totals = durable(counts.groupBy(_lang("phrase").alias("lang")).agg(F.sum("f").alias("n")))
        frequent, seed = _marked(counts.where(F.col("f") >= least), "phrase")
        found, columns = [frequent], ["id"] if seed == 0 and _stands_alone(frequent, counts) else ["phrase"]
        for words in range(1, longest):
            left, in_place = kept(occurrences, frequent, seed, *columns)
            if words > 1 or not in_place:
                left = relations.store(left if in_place else left.repartition(buckets, "doc"))
            occurrences, columns = _longer(left), ["front", "back"]
            grouped = occurrences.groupBy(*columns).agg(F.count("*").alias("f"))
            frequent, seed = _marked(grouped.where(F.col("f") >= least), *columns)
            found.append(_named(frequent, found[-1], words))
    relations.drop()
    return [f.select("phrase", "f") for f in found], totals


def _named(frequent: DataFrame, shorter: DataFrame, words: int) -> DataFrame:
    """With the ``phrase`` that front and back, two phrases of ``words``, make together."""
    fronts = shorter.select(F.col("id").alias("front"), F.col("phrase").alias("start"))
    backs = shorter.select(F.col("id").alias("back"), F.substring_index("phrase", "\t" if words == 1 else " ", -1).alias("last"))
    named = frequent.join(fronts, "front").join(backs, "back")
    return durable(named.select("id", F.concat("start", F.lit(" "), "last").alias("phrase"), "f"))


# --- scores ------------------------------------------------------------------------------------------
def _lang(phrase: str):
    return F.expr(f"left({phrase}, length({phrase}) - length(substring_index({phrase}, '\\t', -1)) - 1)")


def _part(first, size):
    """A run of the words of a phrase, under its language."""
    return F.concat("head", F.array_join(F.slice("words", first, size), " "))


def _worded(phrases: DataFrame) -> DataFrame:
    """With ``head`` (language and tab), ``words`` and their number ``size``."""
    words = F.split(F.substring_index("phrase", "\t", -1), " ")
    out = phrases.withColumn("head", F.concat(_lang("phrase"), F.lit("\t"))).withColumn("words", words)
    return out.withColumn("size", F.size("words"))


def _wide(name: str):
    return F.col(name).cast("decimal(28,0)")


def scored_phrases(found: list[DataFrame]) -> DataFrame:
    """``phrase, a, l, r, score`` of the candidates by their lowest-scoring cut (the first one of equals)."""
    known = found[0]
    for more in found[1:-1]:
        known = known.unionByName(more)
    candidates = found[1]
    for more in found[2:]:
        candidates = candidates.unionByName(more)
    cut = _worded(candidates).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cut.select("phrase", F.col("f").alias("a"), "k", _part(F.lit(1), F.col("k")).alias("front"), _part(F.col("k") + 1, F.col("size")).alias("back"))
    parts = durable(parts)
    parts = parts.join(known.select(F.col("phrase").alias("front"), F.col("f").alias("l")), "front")
    parts = durable(parts.drop("front")).join(known.select(F.col("phrase").alias("back"), F.col("f").alias("r")), "back")
    # no part is rarer than the whole, so a score is at most SCALE / 2
    score = F.expr(f"CAST({SCALE} * CAST(a AS DECIMAL(28,0)) div (CAST(l AS DECIMAL(28,0)) + CAST(r AS DECIMAL(28,0))) AS BIGINT)")
    lowest = F.min(F.struct(score.alias("score"), "k", "a", "l", "r"))
    return parts.groupBy("phrase").agg(lowest.alias("cut")).select("phrase", "cut.a", "cut.l", "cut.r", "cut.score")


def covered_phrases(found: list[DataFrame], covered: int = COVERED) -> DataFrame:
    """``phrase, inside``: of each phrase within a longer frequent one, the greatest count of such a one."""
    longer = None
    for more in found[2:]:
        longer = more if longer is None else longer.unionByName(more)
    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    spread = _worded(longer).withColumn("n", F.explode(sizes))
    spread = spread.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    return spread.select(_part(F.col("first"), F.col("n")).alias("phrase"), "f").groupBy("phrase").agg(F.max("f").alias("inside"))


def mine_collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, **options
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases. ``options`` go to :func:`frequent_phrases`."""
    found, totals = frequent_phrases(documents, least, longest, **options)
    scored = scored_phrases(found)
    inside = covered_phrases(found)
    stays = F.col("inside").isNull() | (100 * _wide("inside") < covered * _wide("a"))
    left = durable(scored.join(inside, "phrase", "left").where(stays))
    rows = left.select(_lang("phrase").alias("lang"), F.substring_index("phrase", "\t", -1).alias("phrase"), "a", "l", "r", "score")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    entry = F.struct((-F.col("score")).alias("down"), (-F.col("a")).alias("rare"), "phrase", "a", "l", "r", "score")
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list(entry)).alias("list"))  # at most SALTS * top entries
    ranked = listed.select("lang", F.posexplode(F.slice("list", 1, top)).alias("rank", "e"))
    ranked = ranked.select("lang", (F.col("rank") + 1).cast("bigint").alias("rank"), "e.phrase", "e.a", "e.l", "e.r", "e.score")
    return durable(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
