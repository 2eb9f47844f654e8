"""Canonicalisation against a controlled vocabulary (CAN-*, JN-6 to JN-9, AGG-19).

Matching happens on *distinct* values, never on listing rows: one aggregation collects the tuples of all
fields and the pairs of make and model (combining on the map side, so a value held by a third of the rows costs
nothing extra), their values are resolved, and the result is joined back to the rows.

A value is tried as alias, exact candidate, candidate that contains it, and most similar candidate,
each stage only on what the previous ones left over. The last two stages are equi-joins on pieces of
text that value and candidate must share, so neither compares everything with everything and both
stay exact:

* A candidate that contains a value contains its first three characters (or all of a shorter value).
* Similarity of at least 3/4 means the matched characters M satisfy ``2M >= 3/4 (a + b)`` for lengths
  a and b. Were all matched blocks single characters, two neighbouring ones would be separated by an
  unmatched character, so ``a + b - 2M >= M - 1``; both together give ``M <= 3`` and ``a + b <= 8``.
  Longer pairs therefore share two adjacent characters and shorter ones share one character.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.numbers import clean_cylinders, clean_number
from adloom.functions.similarity import ratio_from
from adloom.functions.text import (
    alias_key, blank_to_null, fold_ar, is_arabic, is_short_or_numeric, map_value, override_make,
    strip, strip_brand_prefix, strip_variant_number, transliterate,
)
from adloom.session import durable, ship_package
from adloom.sources.vocabulary import ANY_MAKE, FIELD_LISTS, Vocabulary

NUMBER_FIELDS = ["price", "engine_size", "mileage", "year", "seats", "horsepower"]
# Fields whose unmatched values are not reported (see unknown_values).
SILENT_FIELDS = ["doors", "model"]
# ``drive_system`` can be resolved on request but is not part of a full listing normalisation.
_FOLD = str.maketrans(dict(zip(V.FOLD_FROM, V.FOLD_TO)))
LISTING_FIELDS = [f for f in FIELD_LISTS if f != "drive_system"]


# --- pieces of text --------------------------------------------------------------------------------
def _pieces(text: Column, size: int) -> Column:
    """Distinct substrings of exactly ``size`` characters; none when the text is shorter."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def _candidate_pieces(candidates: DataFrame, sizes: Sequence[int], *keep: str) -> DataFrame:
    """``(list, ord, name, folded, piece)`` and the columns ``keep``, which are made once per candidate."""
    pieces = F.flatten(
        F.array(*[F.coalesce(_pieces(F.col("folded"), n), F.array().cast("array<string>")) for n in sizes])
    )
    return candidates.select("list", "ord", "name", "folded", *keep, F.explode(pieces).alias("piece"))


def numbered_characters(text: Column) -> Column:
    """Characters with the number of their occurrence (``a1``, ``b1``, ``a2``), so that the common ones of two
    texts can be counted as those of two sets."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text)))

    def numbered(i: Column) -> Column:
        own, head = F.substring(text, i, F.lit(1)), F.substring(text, F.lit(1), i)
        return F.concat(own, (F.length(head) - F.length(F.replace(head, own, F.lit("")))).cast("string"))

    return F.coalesce(F.transform(places, numbered), F.array().cast("array<string>"))


def folded_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates with their folded text; of equal folded texts in a list the first one stays."""
    folded = candidates.withColumn("folded", fold_ar(F.col("name")))
    return folded.groupBy("list", "folded").agg(
        F.min("ord").alias("ord"), F.min_by("name", "ord").alias("name")
    )


# --- the three matching stages ---------------------------------------------------------------------
def match_exact(values: DataFrame, folded: DataFrame) -> DataFrame:
    """CAN-1, first stage: ``(list, folded, name)`` of equal folded texts."""
    return values.select("list", "folded").join(folded, ["list", "folded"]).select(
        "list", "folded", "name"
    )


def match_containment(
    values: DataFrame, folded: DataFrame, min_length: int = 0
) -> DataFrame:
    """JN-7: first candidate whose folded text contains the folded value.

    A value that folds to nothing is contained in every candidate and takes the first one. A value
    of one character matches too; ``min_length`` switches such short matches off.
    """
    long_enough = values.filter(F.length("folded") >= min_length) if min_length > 0 else values
    probes = long_enough.select(
        "list", F.col("folded").alias("probe"), F.substring("folded", 1, 3).alias("piece")
    )
    # of each list the first candidate stands for the empty piece, so blank values need no join, and no scan, of their own
    first = F.struct("ord", "name", "folded")
    firsts = folded.groupBy("list").agg(F.min_by(first, "ord").alias("_first")).select("list", "_first.*", F.lit("").alias("piece"))
    hits = probes.join(_candidate_pieces(folded, (1, 2, 3)).unionByName(firsts), ["list", "piece"])
    hits = hits.filter(F.col("folded").contains(F.col("probe")))
    found = hits.groupBy("list", "probe").agg(F.min_by("name", "ord").alias("name"))
    return found.withColumnRenamed("probe", "folded")


def similar_pairs(values: DataFrame, folded: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(list, probe, candidate, ord, name)`` that can reach ``threshold`` (at least 3/4).

    Matched characters are common ones, so a pair whose common characters, counted with repetition, are
    too few is dropped in the stage of the join; that leaves little to shuffle.
    """
    if threshold < 0.75:
        raise ValueError("the shared-piece rule holds for thresholds of at least 0.75")
    probe = F.col("probe")
    probes = values.select("list", F.col("folded").alias("probe")).filter("probe <> ''")
    keys = F.flatten(
        F.array(
            F.coalesce(F.when(F.length(probe) < 8, _pieces(probe, 1)), F.array().cast("array<string>")),
            F.coalesce(_pieces(probe, 2), F.array().cast("array<string>")),
        )
    )
    probes = probes.withColumn("probe_chars", numbered_characters(probe)).select("list", "probe", "probe_chars", F.explode(keys).alias("piece"))
    pieces = _candidate_pieces(folded.withColumn("chars", numbered_characters(F.col("folded"))), (1, 2), "chars")
    pieces = pieces.withColumnRenamed("folded", "candidate")
    joined = probes.join(pieces, ["list", "piece"])
    total = F.length("probe") + F.length("candidate")
    shortest = F.least(F.length("probe"), F.length("candidate"))
    possible = (F.length("piece") == F.when(total <= 8, 1).otherwise(2)) & (
        2 * shortest >= threshold * total
    )
    common = F.size(F.array_intersect("probe_chars", "chars"))
    pairs = joined.filter(possible).filter(2 * common >= threshold * total)
    return pairs.select("list", "probe", "candidate", "ord", "name").distinct()


def match_similar(
    values: DataFrame, folded: DataFrame, threshold: float = V.MATCH_THRESHOLD
) -> DataFrame:
    """JN-8: most similar candidate at or above ``threshold``; ties go to the earliest."""
    ship_package(values.sparkSession)
    pairs = similar_pairs(values, folded, threshold)
    scored = pairs.withColumn("score", ratio_from(threshold)("probe", "candidate")).filter(
        F.col("score") >= threshold
    )
    best = scored.groupBy("list", "probe").agg(
        F.max_by("name", F.struct("score", -F.col("ord"))).alias("name"),
        F.max("score").alias("score"),
    )
    return best.withColumnRenamed("probe", "folded")


def best_match(
    values: DataFrame,
    candidates: DataFrame,
    threshold: float = V.MATCH_THRESHOLD,
    min_contains_length: int = 0,
) -> DataFrame:
    """CAN-1: distinct ``(list, folded)`` to ``(list, folded, match, how)``.

    ``candidates`` is ``(list, ord, name)``. Values without a match are absent from the result.
    """
    folded = folded_candidates(candidates)
    exact = match_exact(values, folded).withColumn("how", F.lit("exact"))
    rest = values.join(exact, ["list", "folded"], "left_anti")
    inside = durable(
        match_containment(rest, folded, min_contains_length).withColumn("how", F.lit("contains"))
    )
    rest = rest.join(inside, ["list", "folded"], "left_anti")
    similar = match_similar(rest, folded, threshold).withColumn("how", F.lit("similar"))
    found = exact.unionByName(inside).unionByName(similar.drop("score"))
    return found.withColumnRenamed("name", "match")


def alias_in_row(raw: Column, field: str) -> Column:
    """JN-6 inside a row: the short per-field alias maps are literals and need no join."""
    folded: dict[str, str] = {}
    for key, canonical in V.FIELD_ALIASES[field].items():
        folded.setdefault(key.translate(_FOLD).replace("ـ", "").strip().lower(), canonical)
    return map_value(alias_key(raw), folded)


# --- fields ------------------------------------------------------------------------------------------
def _list_of(field: Column) -> Column:
    return (
        F.when(field == "make", F.lit("make"))
        .when(field == "model", F.lit(f"model:{ANY_MAKE}"))
        .otherwise(F.concat(F.lit("field:"), field))
    )


def resolve_fields(values: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """CAN-2 for list-backed fields and ``make``: distinct ``(field, raw)`` to canonical values.

    A ``model`` given here stands alone and is matched against the models of all makes; within a make
    it goes through :func:`resolve_models`.

    Result: ``(field, raw, canonical, how)`` with ``how`` one of alias, exact, contains, similar, raw.
    """
    keyed = values.select(
        "field", "raw", fold_ar(F.col("raw")).alias("folded"), _list_of(F.col("field")).alias("list"),
        alias_key(F.col("raw")).alias("key"),
    )
    aliases = vocabulary.aliases.filter(F.col("scope") == ANY_MAKE).drop("scope")
    keyed = durable(keyed.join(aliases, ["field", "key"], "left"))
    open_values = keyed.filter("canonical is null").select("list", "folded").distinct()
    matches = best_match(open_values, vocabulary.candidates)
    resolved = keyed.join(matches, ["list", "folded"], "left")
    canonical = F.coalesce("canonical", "match", "raw")
    how = F.when(F.col("canonical").isNotNull(), "alias").otherwise(
        F.coalesce("how", F.lit("raw"))
    )
    make = F.when(F.col("field") == "make", override_make(canonical)).otherwise(canonical)
    return resolved.select("field", "raw", make.alias("canonical"), how.alias("how"))


def resolve_models(values: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """CAN-4: distinct ``(make, raw)`` - the make already canonical - to canonical models.

    Candidates are the models of the make, or all models when the make has none (JN-9). Without a
    match short and numeric codes become capitals, Arabic text stays, and Latin text is transliterated.
    """
    make, raw = F.coalesce("make", F.lit("")), F.col("raw")
    bare = strip_brand_prefix(raw)
    lexus = make.contains(V.LEXUS_NAMES[0]) | F.lower(make).contains(V.LEXUS_NAMES[1])
    text = F.when(lexus, strip_variant_number(bare)).otherwise(bare)
    keyed = values.select("make", "raw", text.alias("text")).withColumns(
        {
            "key": alias_key(F.col("text")),
            "plain": F.lower(strip(F.col("text"))),
            "folded": fold_ar(F.col("text")),
            "own_list": F.concat(
                F.lit("model:"), F.coalesce(map_value(F.col("make"), V.MAKE_LIST_KEY), make)
            ),
        }
    )
    scoped = vocabulary.aliases.filter("field = 'model'").select(
        F.col("scope").alias("make"), "key", F.col("canonical").alias("scoped")
    )
    general = vocabulary.model_aliases.select(
        F.col("key").alias("plain"), F.col("canonical").alias("general")
    )
    lists = vocabulary.candidates.select(F.col("list").alias("own_list")).distinct()
    keyed = keyed.join(scoped, ["make", "key"], "left").join(general, "plain", "left")
    keyed = keyed.join(lists.withColumn("has_list", F.lit(True)), "own_list", "left")
    keyed = durable(
        keyed.withColumn(
            "list",
            F.when(F.col("has_list"), F.col("own_list")).otherwise(F.lit(f"model:{ANY_MAKE}")),
        ).withColumn("alias", F.coalesce("scoped", "general"))
    )
    open_values = keyed.filter("alias is null and text <> ''").select("list", "folded").distinct()
    resolved = keyed.join(
        best_match(open_values, vocabulary.candidates), ["list", "folded"], "left"
    )
    spelled = F.coalesce(blank_to_null(transliterate(F.col("text"))), F.col("text"))
    code, arabic = is_short_or_numeric(F.col("text")), is_arabic(F.col("text"))
    fallback = F.when(code, F.upper("text")).when(arabic, F.col("text")).otherwise(spelled)
    how = (
        F.when(F.col("alias").isNotNull(), F.lit("alias"))
        .when(F.col("match").isNotNull(), F.col("how"))
        .when(code, F.lit("code"))
        .when(arabic, F.lit("raw"))
        .otherwise(F.lit("transliterated"))
    )
    return resolved.select(
        "make", "raw", "text", F.coalesce("alias", "match", fallback).alias("canonical"),
        how.alias("how"),
    )


def seen_texts(df: DataFrame, prepare: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """The distinct texts of a table of listings, from one scan and one shuffle, written out.

    ``of_model, _key, _key2`` and a column per field: the tuples of all list-backed fields and the make, and - with
    ``of_model`` set - the pairs of make and model. The keys are those of the stored texts, see :func:`_keys`; the
    texts are stripped, after ``prepare`` has changed those of its fields, once per tuple and not once per listing.
    """
    prepare = prepare or {}
    fields = [f for f in [*FIELD_LISTS, "make"] if f in df.columns]
    texts = {f: F.col(f).cast("string") for f in [*fields, "model"] if f in df.columns}
    none = F.lit(None).cast("string")

    def entry(of_model: bool, kept: Sequence[str]) -> Column:
        return F.struct(F.lit(of_model).alias("of_model"), *[(c if f in kept else none).alias(f) for f, c in texts.items()])

    pair = ["make", "model"]
    entries = [entry(False, fields)] + ([entry(True, pair)] if "model" in texts else [])
    raw = df.select(F.inline(F.array(*entries))).distinct()
    keys = [
        F.when(F.col("of_model"), of_pair).otherwise(of_tuple).alias(name)
        for name, of_pair, of_tuple in zip(("_key", "_key2"), _keys(raw, pair), _keys(raw, fields))
    ]
    return durable(raw.select("of_model", *keys, *[strip(prepare.get(f, lambda c: c)(F.col(f))).alias(f) for f in texts]))


def _keys(df: DataFrame, fields: Sequence[str]) -> list[Column]:
    """128 bits that stand for the texts of ``fields``; that one is NULL counts, as a hash skips it otherwise."""
    texts = [F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string") for f in fields]
    parts = [x for c in texts for x in (c, c.isNull())]
    return [F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit("second"), *parts)]


def _entries(seen: DataFrame, fields: Sequence[str], *keep: str) -> DataFrame:
    """``(field, raw)`` of the tuples among ``seen``, with the columns ``keep``."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("raw")) for f in fields])
    return seen.filter("NOT of_model").select(*keep, F.inline(entries)).filter("raw <> ''")


def _model_pairs(seen: DataFrame, fields: DataFrame) -> DataFrame:
    """Keys of the pairs among ``seen`` with their canonical make (empty without one) and the text of the model."""
    pairs = seen.filter("of_model AND model <> ''")
    if "make" not in pairs.columns:
        return pairs.select("_key", "_key2", F.lit("").alias("make"), F.col("model").alias("raw"))
    makes = fields.filter("field = 'make'").select(F.col("raw").alias("make"), F.col("canonical").alias("canonical_make"))
    pairs = pairs.join(makes, "make", "left")
    return pairs.select("_key", "_key2", F.coalesce("canonical_make", F.lit("")).alias("make"), F.col("model").alias("raw"))


def unknown_values(*resolutions: DataFrame) -> DataFrame:
    """AGG-19: distinct ``(field, value)`` that no stage could match."""
    out = None
    for resolved in resolutions:
        if "make" in resolved.columns:
            open_rows = resolved.filter(F.col("how").isin("raw", "transliterated")).select(
                F.lit("model").alias("field"), F.col("text").alias("value")
            )
        else:
            open_rows = resolved.filter(
                (F.col("how") == "raw") & ~F.col("field").isin(SILENT_FIELDS)
            ).select("field", F.col("raw").alias("value"))
        out = open_rows if out is None else out.unionByName(open_rows)
    return out.filter("value <> ''").distinct()


def new_unknown_values(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """STM-6: unknown values the ledger does not hold yet."""
    return found.join(ledger.select("field", "value"), ["field", "value"], "left_anti")


class Resolution:
    """Resolved distinct values of one batch of listings."""

    def __init__(self, fields: DataFrame, models: DataFrame | None):
        self.fields = fields
        self.models = models

    def unknown(self) -> DataFrame:
        parts = [self.fields] + ([self.models] if self.models is not None else [])
        return unknown_values(*parts)


def resolve(df: DataFrame, vocabulary: Vocabulary, extra: Sequence[str] = ()) -> Resolution:
    """Resolve everything a batch contains; ``extra`` adds fields outside the usual set."""
    return resolve_seen(seen_texts(df), vocabulary, extra)


def resolve_seen(seen: DataFrame, vocabulary: Vocabulary, extra: Sequence[str] = ()) -> Resolution:
    """:func:`resolve` of the texts that :func:`seen_texts` has found."""
    fields = [f for f in [*LISTING_FIELDS, "make", *extra] if f in seen.columns]
    resolved = durable(resolve_fields(_entries(seen, fields).distinct(), vocabulary))
    if "model" not in seen.columns:
        return Resolution(resolved, None)
    pairs = _model_pairs(seen, resolved).select("make", "raw").distinct()
    return Resolution(resolved, durable(resolve_models(pairs, vocabulary)))


def apply_resolution(df: DataFrame, resolution: Resolution, seen: DataFrame | None = None) -> DataFrame:
    """Write resolved values into the rows, with one join for all fields and one for the model.

    The distinct texts (combined on the map side) are resolved value by value, and the rows meet their tuple once, by
    a 128-bit key. ``seen`` are the texts of ``df`` where they have been found before, which saves a scan.
    """
    seen = seen_texts(df) if seen is None else seen
    out = df
    present = [f for f in [*FIELD_LISTS, "make"] if f in df.columns]
    with_model = resolution.models is not None and "model" in df.columns
    pair = dict(zip(("_pair", "_pair2"), _keys(df, ["make", "model"]))) if with_model else {}
    out = df.withColumns({**dict(zip(("_key", "_key2"), _keys(df, present))), **pair})
    if present:
        values = _entries(seen, present, "_key", "_key2")
        values = values.join(resolution.fields.select("field", "raw", "canonical"), ["field", "raw"], "left")
        found = F.coalesce("canonical", "raw")
        lookup = durable(
            values.groupBy("_key", "_key2").agg(*[F.max(F.when(F.col("field") == f, found)).alias(f"_new_{f}") for f in present])
        )
        out = out.join(lookup, ["_key", "_key2"], "left").withColumns({f: F.col(f"_new_{f}") for f in present})
    if with_model:
        table = _model_pairs(seen, resolution.fields).join(resolution.models.select("make", "raw", "canonical"), ["make", "raw"])
        table = durable(table.select(F.col("_key").alias("_pair"), F.col("_key2").alias("_pair2"), F.col("canonical").alias("_model")))
        out = out.join(table, ["_pair", "_pair2"], "left").withColumn("model", F.col("_model"))
    return out.select(*df.columns)


def normalize_numbers(df: DataFrame) -> DataFrame:
    """CAN-2 for number-only fields and CAN-5 for cylinders; plain expressions."""
    changes = {f: clean_number(F.col(f)) for f in NUMBER_FIELDS if f in df.columns}
    if "cylinders" in df.columns:
        changes["cylinders"] = clean_cylinders(F.col("cylinders"))
    return df.withColumns(changes) if changes else df


def normalize_fields(
    df: DataFrame, vocabulary: Vocabulary, prepare: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """CAN-2, and CAN-4 where there is a model: the numbers, and all texts from two scans of the listings, one that
    collects the distinct texts and one that writes their canonical values."""
    seen = seen_texts(df, prepare)
    return apply_resolution(normalize_numbers(df), resolve_seen(seen, vocabulary), seen)


def normalize_listings(
    df: DataFrame, vocabulary: Vocabulary, prepare: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """CAN-3: all fields, then make, then model within the make. Blank results are NULL.

    ``prepare`` changes texts of its fields before they are matched.
    """
    if "make" not in df.columns:
        df = df.withColumn("make", F.lit(None).cast("string"))
    return normalize_fields(df, vocabulary, prepare)
