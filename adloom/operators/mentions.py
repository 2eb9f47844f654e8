"""Mentions of a vocabulary in free text (STR-15, STR-18, STR-19, JN-6).

Texts and names are cut into folded tokens alike. Every run of tokens of a length that some name has, and that begins
like a name, is looked up in the vocabulary by an equi-join, so a longer vocabulary costs no longer expression: the names may be thousands.
Of mentions that overlap, those inside a longer one are dropped. What is scanned once stays in its row until the
join; a vocabulary that the optimiser knows to be small is broadcast by it, and a larger one is shuffled with the runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions.text import fold_ar
from adloom.session import durable


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased and with Arabic letter forms folded."""
    folded = fold_ar(F.lower(F.coalesce(text, F.lit(""))))
    return F.array_remove(F.split(folded, r"[^\p{L}\p{N}]+"), "")


def _named(vocabulary: DataFrame) -> DataFrame:
    own = vocabulary.withColumn("_words", tokens(F.col("name")))
    return own.filter(F.size("_words") > 0).withColumns({"_run": F.array_join("_words", " "), "_size": F.size("_words")}).drop("_words")


def find_mentions(texts: DataFrame, vocabulary: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """``key, start, size`` (in tokens, from 0) and the columns of ``vocabulary`` (``name, ord`` and more) per mention.

    A mention inside a longer one is no mention; of names that read alike the first by ``ord`` counts. ``key`` tells
    texts apart. Null and empty texts, and names without a letter or digit, have no mentions.
    """
    every = _named(vocabulary)
    rest = [c for c in vocabulary.columns if c not in ("name", "ord")]
    first = F.min(F.struct("ord", "name", *rest)).alias("_entry")
    names = durable(every.groupBy("_run", "_size").agg(first))
    sizes = sorted(r["_size"] for r in names.select("_size").distinct().collect())  # as many as name lengths
    words = texts.select(key, tokens(F.col(text)).alias("_words"))
    sizes = sizes or [1]
    # every token with those after it; most begin no name, so their runs are never put together
    following = [F.slice("_words", i + 1, F.size("_words")) for i in range(max(sizes))]
    places = words.select(key, F.posexplode(F.arrays_zip(*following)).alias("start", "_next"))
    own = [F.col("_next").getField(str(i)) for i in range(max(sizes))]
    firsts = names.select(F.substring_index("_run", " ", 1).alias("_first")).distinct()
    places = places.join(firsts, own[0] == F.col("_first"), "left_semi")
    runs = [
        F.struct(F.lit(n).alias("size"), F.when(own[n - 1].isNotNull(), F.concat_ws(" ", *own[:n])).alias("_run")) for n in sizes
    ]
    spread = places.select(key, "start", F.inline(F.array(*runs)))
    hits = spread.join(names.drop("_size"), "_run").select(key, "start", "size", "_entry.*")
    reach = F.max(F.col("start") + F.col("size")).over(
        Window.partitionBy(key).orderBy("start", F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    )
    kept = hits.withColumn("_reach", reach).filter(F.col("_reach").isNull() | (F.col("_reach") < F.col("start") + F.col("size")))
    return kept.select(key, "start", "size", *vocabulary.columns)


def first_listed(mentions: DataFrame, key: str = "id") -> DataFrame:
    """STR-18: of each text the mentioned name that the vocabulary lists first."""
    return mentions.groupBy(key).agg(F.min(F.struct("ord", "start", "name")).alias("_m")).select(key, "_m.ord", "_m.name", "_m.start")


def scoped_mentions(mentions: DataFrame, owners: DataFrame, key: str = "id", scope: str = "brand") -> DataFrame:
    """STR-19 / JN-9: mentions whose ``scope`` is itself mentioned in the text; ``owners`` are those mentions."""
    present = owners.select(key, F.col("name").alias(scope)).distinct()
    return mentions.join(present, [key, scope], "left_semi").select(*mentions.columns)
