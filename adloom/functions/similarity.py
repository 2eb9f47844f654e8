"""UDF-1: Ratcliff-Obershelp similarity, the one expression Spark has no built-in for.

It runs Arrow-batched and only ever sees pairs of distinct values that already share a piece of
text (see ``adloom.operators.resolve``), never listing rows.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _scores(raw: pd.Series, candidate: pd.Series, threshold: float) -> pd.Series:
    """Ratio per pair; 0 where a count of common characters, which is never below the matched ones,
    shows that ``threshold`` is out of reach."""
    values, names = raw.tolist(), candidate.tolist()
    scores = [0.0] * len(values)
    matcher, current = SequenceMatcher(None), None
    # The matcher indexes its second sequence, so pairs are visited one candidate at a time.
    for position in sorted(range(len(names)), key=names.__getitem__):
        if names[position] != current:
            current = names[position]
            matcher.set_seq2(current)
        matcher.set_seq1(values[position])
        if threshold <= 0 or matcher.quick_ratio() >= threshold:
            scores[position] = matcher.ratio()
    return pd.Series(scores, index=raw.index)


@pandas_udf(DoubleType())
def ratio(raw: pd.Series, candidate: pd.Series) -> pd.Series:
    """``2 * matched / total length``. Not symmetric: the raw value comes first."""
    return _scores(raw, candidate, 0.0)


def ratio_from(threshold: float):
    """Like :func:`ratio`, but 0 for pairs that cannot reach ``threshold``."""

    @pandas_udf(DoubleType())
    def bounded(raw: pd.Series, candidate: pd.Series) -> pd.Series:
        return _scores(raw, candidate, threshold)

    return bounded
