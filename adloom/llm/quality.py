"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are coarse classes of what it looks like (length, word length, shares of
capitals, digits and symbols, repeated words, ending, whether the line came before), of the line itself and
of both neighbours; a transition weight ties each line to the next. Labels exist for documents only: a good
document has good lines alone, a bad one at least one bad line, and the field is trained on the likelihood
of exactly that, so it finds the bad lines by itself. Forward-backward gives each line's chance to be good;
their mean, weighted by line length, is the document's, and a logistic curve fitted on the training
documents turns it into the chance of label 1.

The field is fitted on a bounded sample: about ``sample`` labelled documents outside the held-out fold, those
whose id has a hash below the share that this is of all. Texts are always read whole.

Defined results: null and empty texts are one empty line. Rows with a null quality teach nothing; of several
labels for one id the lowest counts; a null id counts as the id ``''`` for the fold and has no label. If nothing
is left to learn from, all scores are 0.5. Repeated rows get the same result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from adloom.llm.common import held_out, slices, text_bytes, text_of
from adloom.llm.superminhash import _words
from adloom.session import ship_package

SAMPLE = 6000
STEPS = 150
CUT = 0.3  # documents with at least this score are predicted to be good

#: Bounds of the classes of each measure: shares are cut more finely near 0.
SHARES = [1e-9, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.45, 0.6, 0.8]
SIZES = [1, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 4096]
WORD_SIZES = [1e-9, 2, 3, 4, 5, 6, 7, 8, 10, 14, 24]
MEASURES = [SIZES, WORD_SIZES, SHARES, SHARES, SHARES, SHARES, SHARES, SHARES, [0.5], [0.5]]
CLASSES = 12  # at most, in each measure
_UPPER, _LOWER, _DIGIT, _SYMBOL, _OTHER = range(5)


def _kinds() -> np.ndarray:
    """Kind of each byte: ASCII capital, other letter (parts of non-ASCII letters too), digit, symbol, white space."""
    kinds = np.full(256, _SYMBOL, np.uint8)
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[128:] = _LOWER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[[0x20, *range(0x09, 0x0E)]] = _OTHER
    return kinds


_KIND = _kinds()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of all texts: class of each measure by line, length of each line, and the texts' offsets in lines."""
    breaks = np.flatnonzero(data == 10)
    # a line begins with each text and after each line break
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    text_starts = np.searchsorted(breaks, offsets[:-1]) + np.arange(len(offsets) - 1)
    lines = np.append(text_starts, len(begins))
    ends = np.append(begins[1:], offsets[-1])
    ended = np.zeros(len(begins), bool)
    ended[text_starts[text_starts > 0] - 1] = True
    if len(begins):
        ended[-1] = True
    ends = np.where(ended, ends, ends - 1)  # without the break
    size = ends - begins

    kinds = _KIND[data]
    counts = []
    for kind in (_UPPER, _LOWER, _DIGIT, _SYMBOL):
        total = np.concatenate([[0], np.cumsum(kinds == kind)])
        counts.append(total[ends] - total[begins])
    upper, lower, digit, symbol = counts
    shout = np.concatenate([[0], np.cumsum((kinds[1:] == _UPPER) & (kinds[:-1] == _UPPER)), [0]])
    shouted = np.where(size > 1, shout[np.maximum(ends - 1, begins)] - shout[begins], 0)
    symbols = (kinds == _SYMBOL).astype(np.int8)
    twin = np.concatenate([[0], np.cumsum(symbols[1:] * symbols[:-1], dtype=np.int64), [0]])
    runs = np.where(size > 1, twin[np.maximum(ends - 1, begins)] - twin[begins], 0)

    words, owner = _words(data, np.append(begins, offsets[-1]))
    n_words = np.bincount(owner, minlength=len(begins))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    echoed = np.bincount(owner[again], minlength=len(begins))
    order = np.lexsort((words, owner))
    known = np.zeros(len(words), bool)
    known[1:] = (words[order][1:] == words[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.bincount(owner[order][known], minlength=len(begins))

    weights = words * (np.arange(len(words)) - np.repeat(np.cumsum(n_words) - n_words, n_words) + 1).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weights, dtype=np.uint64)])
    last = np.cumsum(n_words)
    content = total[last] - total[last - n_words]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(lines))
    by_content = np.lexsort((np.arange(len(content)), content, text))
    before = np.zeros(len(content), bool)
    same = (content[by_content][1:] == content[by_content][:-1]) & (text[by_content][1:] == text[by_content][:-1])
    before[by_content[1:][same & (n_words[by_content][1:] > 0)]] = True

    final = np.where(size > 0, data[np.maximum(ends - 1, 0)] if len(data) else 0, 0)
    closed = np.isin(final, [ord("."), ord("!"), ord("?"), ord('"'), ord(":")])

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    solid = upper + lower + digit + symbol
    measures = [
        size, share(solid, n_words), share(shouted, solid), share(digit, solid), share(symbol, solid), share(runs, solid),
        share(echoed, n_words), share(repeated, n_words), closed, before,
    ]
    classes = np.stack([np.digitize(m, bounds) for m, bounds in zip(measures, MEASURES, strict=True)], axis=1)
    return classes.astype(np.uint8), size + 1, lines


class Chains:
    """Lines of many texts in time-major order, so one step takes the next line of all texts that have one."""

    def __init__(self, lines: np.ndarray):
        count = np.diff(lines)
        self.order = np.argsort(-count, kind="stable")  # texts by falling number of lines
        lengths = count[self.order]
        self.active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right") if len(lengths) else np.zeros(0, int)
        self.starts = np.concatenate([[0], np.cumsum(self.active)])
        first = lines[:-1][self.order]
        self.rows = np.concatenate([first[:n] + t for t, n in enumerate(self.active)]) if len(self.active) else np.zeros(0, int)
        self.lengths = lengths

    def forward_backward(self, scores: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each line, in this order, the chance to be bad; summed chances of the four transitions by text; log Z by text.

        ``scores`` are the lines' scores for being bad (good has 0), ``ties[a, b]`` the weight of b after a.
        """
        steps, texts = len(self.active), len(self.lengths)
        alpha = np.zeros((len(scores), 2))
        alpha[:, 1] = scores
        for t in range(1, steps):
            a, b, n = self.starts[t - 1], self.starts[t], self.active[t]
            last = alpha[a : a + n]
            for s in (0, 1):
                alpha[b : b + n, s] += np.logaddexp(last[:, 0] + ties[0, s], last[:, 1] + ties[1, s])
        end = self.starts[self.lengths - 1] + np.arange(texts) if texts else np.zeros(0, int)
        norm = np.logaddexp(alpha[end, 0], alpha[end, 1])
        beta = np.zeros((len(scores), 2))
        moves = np.zeros((texts, 2, 2))
        for t in range(steps - 1, 0, -1):
            a, b, n = self.starts[t - 1], self.starts[t], self.active[t]
            ahead = beta[b : b + n].copy()
            ahead[:, 1] += scores[b : b + n]
            for s in (0, 1):
                beta[a : a + n, s] = np.logaddexp(ties[s, 0] + ahead[:, 0], ties[s, 1] + ahead[:, 1])
                for r in (0, 1):
                    moves[:n, s, r] += np.exp(alpha[a : a + n, s] + ties[s, r] + ahead[:, r] - norm[:n])
        which = np.concatenate([np.arange(n) for n in self.active]) if steps else np.zeros(0, int)
        bad = np.exp(alpha[:, 1] + beta[:, 1] - norm[which])
        return bad, moves, norm


@dataclass(frozen=True)
class Field:
    """Weights: of each class of each measure for the line itself, the one before and the one after; ties; curve."""

    weights: np.ndarray  # 3 x measures x classes
    bias: float
    ties: np.ndarray  # 2 x 2
    curve: tuple[float, float]

    def line_scores(self, classes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        columns = np.arange(classes.shape[1])
        out = self.weights[0][columns, classes].sum(axis=1) + self.bias
        first, last = np.zeros(len(classes), bool), np.zeros(len(classes), bool)
        first[lines[:-1]], last[lines[1:] - 1] = True, True
        out[1:] += np.where(first[1:], 0.0, self.weights[1][columns, classes[:-1]].sum(axis=1))
        out[:-1] += np.where(last[:-1], 0.0, self.weights[2][columns, classes[1:]].sum(axis=1))
        return out

    def line_badness(self, classes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Each line's chance to be bad."""
        chains = Chains(lines)
        bad, _, _ = chains.forward_backward(self.line_scores(classes, lines)[chains.rows], self.ties)
        out = np.zeros(len(classes))
        out[chains.rows] = bad
        return out

    def goodness(self, classes: np.ndarray, sizes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Each text's mean chance of a good line, weighted by length."""
        if len(lines) < 2:
            return np.zeros(0)
        good = np.add.reduceat((1 - self.line_badness(classes, lines)) * sizes, lines[:-1])
        return good / np.add.reduceat(sizes, lines[:-1])

    def score(self, goodness: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] * goodness + self.curve[1])))


def _start() -> Field:
    return Field(np.zeros((3, len(MEASURES), CLASSES)), -3.0, np.zeros((2, 2)), (0.0, 0.0))


def fit_field(classes: np.ndarray, sizes: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Field and curve for texts with labels 1 (good) and 0 (bad)."""
    if not len(labels):
        return _start()
    chains = Chains(lines)
    labels = labels[chains.order].astype(bool)
    which = np.concatenate([np.arange(n) for n in chains.active])
    measures = classes.shape[1]
    shape = (3, measures, CLASSES)
    slot = np.arange(measures) * CLASSES + classes.astype(np.int64)
    first, last = np.zeros(len(classes), bool), np.zeros(len(classes), bool)
    first[lines[:-1]], last[lines[1:] - 1] = True, True
    # position len(weights) is the place of a missing neighbour, its weight stays 0
    none = np.full_like(slot, 3 * measures * CLASSES)
    left, right = none.copy(), none.copy()
    left[1:] = np.where(first[1:, None], none[1:], slot[:-1] + measures * CLASSES)
    right[:-1] = np.where(last[:-1, None], none[:-1], slot[1:] + 2 * measures * CLASSES)
    active = np.concatenate([slot, left, right], axis=1)[chains.rows]
    n_weights = 3 * measures * CLASSES
    values = np.zeros(n_weights + 1 + 1 + 4)
    values[n_weights + 1] = -3.0
    mean, square = np.zeros_like(values), np.zeros_like(values)
    steps_in = np.maximum(chains.lengths - 1, 0)
    # what a line shows itself should explain its label before what stands beside it does
    penalty = np.full_like(values, 1e-4)
    penalty[measures * CLASSES : n_weights] = 5e-3
    for step in range(1, steps + 1):
        ties = values[-4:].reshape(2, 2)
        bad, moves, norm = chains.forward_backward(values[active].sum(axis=1) + values[n_weights + 1], ties)
        all_good = np.minimum(ties[0, 0] * steps_in - norm, -1e-9)  # log chance that every line is good
        # a text's likelihood is p where it is good, 1 - p where it is bad, with p the chance that all lines are
        factor = np.where(labels, 1.0, -np.exp(all_good) / -np.expm1(all_good))
        per_line = -factor[which] * bad
        slope = np.zeros_like(values)
        slope[: n_weights + 1] = np.bincount(active.ravel(), np.repeat(per_line, active.shape[1]), n_weights + 1)
        slope[n_weights + 1] = per_line.sum()
        change = -moves
        change[:, 0, 0] += steps_in
        slope[-4:] = (factor[:, None, None] * change).sum(axis=0).ravel()
        slope = slope / len(labels) - penalty * values
        slope[n_weights] = 0.0
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        values = values + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    field = Field(values[:n_weights].reshape(shape), float(values[n_weights + 1]), values[-4:].reshape(2, 2).copy(), (0.0, 0.0))
    goodness = field.goodness(classes, sizes, lines)[chains.order]
    return Field(field.weights, field.bias, field.ties, _curve(goodness, labels))


def _curve(goodness: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the label over the mean chance, by Newton's method; a slight penalty keeps it finite."""
    x = np.stack([goodness, np.ones_like(goodness)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (labels - p) - 1e-2 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w + np.clip(np.linalg.solve(curvature, slope), -5, 5)
    return float(w[0]), float(w[1])


def learn_field(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit on about ``sample`` labelled documents; only their line classes reach the driver."""
    ship_package(documents.sparkSession)
    marked = labels.select(F.col("doc_id").alias("labelled"), "quality").where("labelled IS NOT NULL AND quality IS NOT NULL")
    marked = marked.where(~held_out("labelled")).groupBy("labelled").agg(F.min("quality").alias("quality"))
    share = min(1.0, sample / max(1, marked.count()))
    draw = F.shiftrightunsigned(F.xxhash64("labelled"), 11) / float(1 << 53)  # the same in every run
    chosen = marked.where(draw < share)  # about ``sample`` rows, which bounds the broadcast
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    rows = rows.select("labelled", "quality", F.coalesce("text", F.lit("")).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            classes, sizes, lines = line_features(*text_bytes(batch))
            bounds = list(zip(lines[:-1].tolist(), lines[1:].tolist(), strict=True))
            columns = [batch.column(0), batch.column(1).cast(pa.int32())]
            columns.append(pa.array([classes[a:b].tobytes() for a, b in bounds], pa.binary()))
            columns.append(pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in bounds], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "classes", "sizes"])

    taken = sorted(rows.mapInArrow(measure, "doc_id bigint, quality int, classes binary, sizes binary").collect())
    if not taken:
        return _start()
    classes = [np.frombuffer(r["classes"], np.uint8).reshape(-1, len(MEASURES)) for r in taken]
    lines = np.concatenate([[0], np.cumsum([len(c) for c in classes])])
    sizes = np.concatenate([np.frombuffer(r["sizes"], "<i8") for r in taken])
    return fit_field(np.concatenate(classes), sizes, lines, np.array([r["quality"] for r in taken]))


def score_quality(documents: DataFrame, field: Field, *keep: str) -> DataFrame:
    """Columns ``keep`` of every row, ``score`` (chance of label 1) and ``predicted``."""
    ship_package(documents.sparkSession)
    rows = text_of(documents, *keep)
    schema = StructType([*rows.schema.fields[:-1], StructField("score", DoubleType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = field.score(field.goodness(*line_features(*text_bytes(batch))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names)

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
