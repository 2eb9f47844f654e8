"""JN-6 to JN-9, UDF-1, CAN-*, AGG-19: canonicalisation.

The SQL side compares every value with every candidate, with the similarity written as a recursive
query over the longest common blocks, and so checks that the shared-piece joins lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adloom.functions.similarity import ratio
from adloom.functions.text import fold_ar
from adloom.operators import resolve as R
from adloom.operators.mentions import find_mentions, first_listed, tokens
from adloom.operators.neighbours import close_pairs
from adloom.plans.registered.base import query, table
from adloom.session import durable
from adloom.sources.vocabulary import Vocabulary, build_vocabulary


def ratio_ctes(pairs: str) -> str:
    """CTEs that give ``scored(a, b, score)`` for the relation ``pairs(a, b)``.

    ``work`` holds ranges still to be compared; a range yields its longest common block (earliest in
    ``a``, then in ``b``) and the ranges left and right of it.
    """
    block = """list_max(flatten([
        [{'k': n, 'i': -i, 'j': -instr(sb, substr(sa, i, n))}
         for n in range(1, length(sa) - i + 2) if instr(sb, substr(sa, i, n)) > 0]
        for i in range(1, length(sa) + 1)]))"""
    return f"""
    work AS (
      SELECT a, b, a AS sa, b AS sb, {block} AS m FROM {pairs}
      UNION ALL
      SELECT a, b, sa, sb, {block} AS m FROM (
        SELECT a, b, unnest([substr(sa, 1, -m.i - 1), substr(sa, -m.i + m.k)]) AS sa,
                     unnest([substr(sb, 1, -m.j - 1), substr(sb, -m.j + m.k)]) AS sb
        FROM work WHERE m IS NOT NULL) WHERE sa <> '' AND sb <> ''),
    scored AS (
      SELECT a, b, 2.0::DOUBLE * coalesce(sum(m.k), 0) / (length(a) + length(b)) AS score FROM work GROUP BY a, b)
    """


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_size", "p_brand", "p_type")


def _misspelled():
    """Part names with one character removed; the place depends on the size."""
    name, at = F.col("p_name"), F.col("p_size") % F.length("p_name")
    return F.concat(F.substring(name, F.lit(1), at), F.substring(name, at + 2, F.length(name)))


_MISSPELLED = "concat(substr(p_name, 1, p_size % length(p_name)), substr(p_name, p_size % length(p_name) + 2))"

_NAMES = """names AS (SELECT p_name AS name, row_number() OVER (ORDER BY p_name) AS ord FROM (SELECT DISTINCT p_name FROM part))"""


def _names(spark, sf):
    """Distinct part names as candidate list ``names``; the order is alphabetical."""
    names = _parts(spark, sf).select(F.col("p_name").alias("name")).distinct()
    # a vocabulary is a small dimension, so it is numbered in one task
    return names.select(F.lit("names").alias("list"), F.row_number().over(Window.orderBy("name")).alias("ord"), "name")


@query(
    "similarity_ratio",
    f"""
    WITH RECURSIVE pairs AS (SELECT DISTINCT {_MISSPELLED} AS a, p_name AS b FROM part), {ratio_ctes('pairs')}
    SELECT a, b, round(score, 9) AS score FROM scored
    """,
)
def _(spark, sf):
    pairs = _parts(spark, sf).select(_misspelled().alias("a"), F.col("p_name").alias("b")).distinct()
    return pairs.select("a", "b", F.round(ratio("a", "b"), 9).alias("score"))


@query(
    "alias_lookup",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'ديزل / مازوت' WHEN 2 THEN 'بنزين' WHEN 3 THEN 'كهربائي'
             WHEN 4 THEN 'هجين' WHEN 5 THEN 'ديزل / مازوت' END AS fuel FROM lineitem
    """,
)
def _(spark, sf):
    raw = F.element_at(
        F.array(*[F.lit(x) for x in ("Diesel", " PETROL", "كهـرباء", "hybrid", "مازوت", "steam", "")]), F.col("l_linenumber")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", raw.alias("raw"))
    return lines.withColumn("fuel", R.alias_in_row(F.col("raw"), "fuel_type")).drop("raw")


@query(
    "containment_match",
    f"""
    WITH {_NAMES}, words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) AS word FROM documents)
    SELECT word, arg_min(name, ord) AS match FROM words JOIN names ON contains(name, word) GROUP BY word
    """,
)
def _(spark, sf):
    runs = F.split("text", r"[ \t\r\n]+")
    # written, as conditions on the folded word would otherwise be tried on every word of every text
    words = durable(table(spark, sf, "documents").select(F.explode(runs).alias("word")).filter("word <> ''").distinct())
    values = words.select(F.lit("names").alias("list"), fold_ar(F.col("word")).alias("folded")).distinct()
    found = R.match_containment(values, R.folded_candidates(_names(spark, sf)))
    return found.select(F.col("folded").alias("word"), F.col("name").alias("match"))


@query(
    "similar_match",
    f"""
    WITH RECURSIVE {_NAMES}, raw AS (SELECT DISTINCT {_MISSPELLED} AS a FROM part WHERE length(p_name) > 1),
    pairs AS (SELECT a, name AS b FROM raw, names), {ratio_ctes('pairs')}
    SELECT a AS raw, arg_min(name, (-score, ord)) AS match, max(score) AS score
    FROM scored JOIN names ON b = name WHERE score >= 0.75 GROUP BY a
    """,
)
def _(spark, sf):
    values = _parts(spark, sf).select(F.lit("names").alias("list"), _misspelled().alias("folded")).distinct()
    found = R.match_similar(values, R.folded_candidates(_names(spark, sf)))
    return found.select(F.col("folded").alias("raw"), F.col("name").alias("match"), "score")


# Levenshtein is not what decides a match, but both engines have it built in.
@query(
    "levenshtein_match",
    f"""
    WITH {_NAMES}, raw AS (SELECT DISTINCT {_MISSPELLED} AS raw FROM part)
    SELECT raw, arg_min(name, (levenshtein(raw, name), ord)) AS match FROM raw, names
    WHERE levenshtein(raw, name) <= 1 GROUP BY raw
    """,
)
def _(spark, sf):
    probes = _parts(spark, sf).select(_misspelled().alias("probe")).distinct()
    close = close_pairs(probes, _names(spark, sf).select(F.col("name").alias("candidate"), "ord"))
    return close.groupBy(F.col("probe").alias("raw")).agg(F.min_by("candidate", F.struct("distance", "ord")).alias("match"))


@query(
    "levenshtein_short_names",
    """
    WITH probes AS (SELECT DISTINCT substr(p_name, 1, CAST(1 + p_size % 12 AS INT)) AS probe FROM part),
    names AS (SELECT DISTINCT substr(p_name, CAST(1 + p_partkey % 3 AS INT), CAST(1 + p_partkey % 12 AS INT)) AS candidate FROM part)
    SELECT probe, candidate, CAST(levenshtein(probe, candidate) AS INT) AS distance FROM probes, names
    WHERE abs(length(probe) - length(candidate)) <= 1 AND levenshtein(probe, candidate) <= 1
    """,
)
def _(spark, sf):
    """Names of 1 to 12 characters, of which every pair within one edit is found."""
    parts, size = table(spark, sf, "part"), F.col("p_size").cast("int")
    key = F.col("p_partkey").cast("int")
    probes = parts.select(F.substring("p_name", F.lit(1), 1 + size % 12).alias("probe")).distinct()
    names = parts.select(F.substring("p_name", 1 + key % 3, 1 + key % 12).alias("candidate")).distinct()
    return close_pairs(probes, names)


# Names of a vocabulary that occur in texts: the first words of each benchmark item, of one, two and three words.
_MENTIONS = r"""
cut AS (SELECT list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM benchmark),
vocab AS (SELECT name, CAST(row_number() OVER (ORDER BY name) AS INT) AS ord, size FROM (
  SELECT DISTINCT array_to_string(w[1:n], ' ') AS name, n AS size FROM cut, range(1, 4) AS t(n) WHERE len(w) >= n)),
docs AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents),
runs AS (SELECT doc_id, n AS size, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {'start': i - 1, 'run': array_to_string(w[i:i + n - 1], ' ')})) AS r FROM docs, range(1, 4) AS t(n)),
hits AS (SELECT doc_id, r.start AS start, runs.size, name, ord FROM runs JOIN vocab ON r.run = name),
mentions AS (SELECT * FROM hits h WHERE NOT EXISTS (
  SELECT 1 FROM hits l WHERE l.doc_id = h.doc_id AND l.size > h.size AND l.start <= h.start AND l.start + l.size >= h.start + h.size))
"""


def _mentions(spark, sf):
    words = table(spark, sf, "benchmark").select(tokens(F.col("text")).alias("w"))
    sizes = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: n <= F.size("w"))
    names = words.select(F.explode(F.transform(sizes, lambda n: F.array_join(F.slice("w", F.lit(1), n), " "))).alias("name")).distinct()
    vocabulary = names.withColumn("ord", F.row_number().over(Window.orderBy("name")))  # a small dimension
    return find_mentions(table(spark, sf, "documents"), vocabulary, "doc_id")


@query("text_mentions", f"WITH {_MENTIONS} SELECT doc_id, name, count(*) AS n, min(start) AS first FROM mentions GROUP BY doc_id, name")
def _(spark, sf):
    return _mentions(spark, sf).groupBy("doc_id", "name").agg(F.count("*").alias("n"), F.min("start").cast("bigint").alias("first"))


@query("text_first_listed", f"WITH {_MENTIONS} SELECT doc_id, arg_min(name, ord) AS name FROM mentions GROUP BY doc_id")
def _(spark, sf):
    return first_listed(_mentions(spark, sf), "doc_id").select("doc_id", "name")


# --- whole listings ------------------------------------------------------------------------------------
# A small vocabulary over the table's own values: brands are makes, part names are models.
_LISTS = {
    "fuel_type": ["بنزين", "ديزل / مازوت", "كهربائي", "هجين"],
    "transmission": ["أوتوماتيك", "شبه أوتوماتيك", "يدوي"],
    "location": ["دمشق", "ريف دمشق", "حمص", "حلب"],
    "color": ["أبيض", "أسود", "رمادي فاتح", "فضي"],
    "condition": ["جديد", "مستعمل"],
}
_FUELS = {"Diesel": "ديزل / مازوت", "بنزيـن": "بنزين", "مازو": "ديزل / مازوت", "كهربايي": "كهربائي", "steam": "steam"}
_CITIES = {"دوما": "ريف دمشق", "حلب": "حلب", "ريف": "ريف دمشق", "دمشف": "دمشق", "الدمام": "الدمام"}
_COLORS = {"ابيض": "أبيض", "رمادى": "رمادي فاتح", "أسوود": "أسود", "ذهبي": "ذهبي", "فضى": "فضي"}
_GEARS = {"AUTO": "أوتوماتيك", "اوتوماتيك": "أوتوماتيك", "يدوى": "يدوي", "شبه": "شبه أوتوماتيك", "cvt": "cvt"}


def vocabulary_of(spark, sf) -> Vocabulary:
    parts = _parts(spark, sf)
    rows = [(f, i, n) for f, names in _LISTS.items() for i, n in enumerate(names)]
    vocab = spark.createDataFrame(rows, "field string, ord int, name string")
    brands = parts.select("p_brand", "p_name").distinct().select(
        F.col("p_brand").alias("brand"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("brand_ord"),
        F.col("p_name").alias("model"),
        F.row_number().over(Window.partitionBy("p_brand").orderBy("p_name")).alias("model_ord"),
    )
    return build_vocabulary(spark, vocab, durable(brands))  # read by every stage of the matching


def raw_listings(spark, sf):
    """Order lines as listings whose values are variant spellings of the vocabulary."""
    def variant(entries, column):
        return F.element_at(F.array(*[F.lit(k) for k in entries]), (F.col(column) % len(entries) + 1).cast("int"))

    joined = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.translate("p_brand", "#", "").alias("make"),
        F.when(F.col("p_size") < 25, F.concat(F.col("p_name"), F.lit(" "))).otherwise(_misspelled()).alias("model"),
        variant(_FUELS, "l_suppkey").alias("fuel_type"), variant(_CITIES, "l_linenumber").alias("city"),
        variant(_COLORS, "p_size").alias("exterior_color"), variant(_GEARS, "l_partkey").alias("transmission"),
        F.concat(F.format_number(F.floor("l_extendedprice"), 0), F.lit(" $")).alias("price"),
        F.concat(F.col("p_size").cast("string"), F.lit(" سلندر")).alias("cylinders"),
    )


def _variant_case(entries: dict[str, str], column: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(entries.values()))
    return f"CASE {column} % {len(entries)} {cases} END"


@query(
    "normalize_fields",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {_variant_case(_FUELS, 'l_suppkey')} AS fuel_type,
           {_variant_case(_CITIES, 'l_linenumber')} AS city, {_variant_case(_COLORS, 'p_size')} AS exterior_color,
           {_variant_case(_GEARS, 'l_partkey')} AS transmission,
           CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS price, CAST(p_size AS VARCHAR) AS cylinders
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def _(spark, sf):
    rows = raw_listings(spark, sf).drop("make", "model")
    return R.normalize_fields(rows, vocabulary_of(spark, sf))


_MODEL_CTES = f"""
brand AS (SELECT DISTINCT p_brand AS name, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS ord FROM part),
raw AS (SELECT DISTINCT replace(p_brand, '#', '') AS raw_make, CASE WHEN p_size < 25 THEN p_name ELSE {_MISSPELLED} END AS raw_model FROM part),
mpairs AS (SELECT DISTINCT raw_make AS a, name AS b FROM raw, brand)
"""


@query(
    "make_match",
    f"""
    WITH RECURSIVE {_MODEL_CTES}, {ratio_ctes('mpairs')},
    inside AS (SELECT a, arg_min(b, ord) AS match FROM mpairs JOIN brand ON b = name WHERE contains(b, a) GROUP BY a),
    near AS (SELECT a, arg_min(b, (-score, ord)) AS match FROM scored JOIN brand ON b = name WHERE score >= 0.75 GROUP BY a)
    SELECT raw_make, coalesce(i.match, n.match, raw_make) AS make
    FROM (SELECT DISTINCT raw_make FROM raw) r LEFT JOIN inside i ON i.a = raw_make LEFT JOIN near n ON n.a = raw_make
    """,
)
def _(spark, sf):
    makes = _parts(spark, sf).select(F.lit("make").alias("field"), F.translate("p_brand", "#", "").alias("raw")).distinct()
    found = R.resolve_fields(makes, vocabulary_of(spark, sf))
    return found.select(F.col("raw").alias("raw_make"), F.col("canonical").alias("make"))


@query(
    "model_match",
    f"""
    WITH RECURSIVE owned AS (SELECT DISTINCT p_brand AS make, p_name AS name, p_name AS ord FROM part),
    raw AS (SELECT DISTINCT p_brand AS make, trim(CASE WHEN p_size < 25 THEN p_name ELSE {_MISSPELLED} END) AS raw FROM part),
    both_sides AS (SELECT r.make, raw, name, ord FROM raw r JOIN owned o ON r.make = o.make),
    pairs AS (SELECT DISTINCT raw AS a, name AS b FROM both_sides), {ratio_ctes('pairs')},
    exact AS (SELECT make, raw, name AS match FROM both_sides WHERE raw = name),
    inside AS (SELECT make, raw, arg_min(name, ord) AS match FROM both_sides WHERE contains(name, raw) GROUP BY ALL),
    near AS (SELECT make, raw, arg_min(name, (-score, ord)) AS match FROM both_sides JOIN scored ON a = raw AND b = name
             WHERE score >= 0.75 GROUP BY ALL)
    SELECT make, raw, coalesce(e.match, i.match, n.match) AS match
    FROM raw LEFT JOIN exact e USING (make, raw) LEFT JOIN inside i USING (make, raw) LEFT JOIN near n USING (make, raw)
    WHERE coalesce(e.match, i.match, n.match) IS NOT NULL
    """,
)
def _(spark, sf):
    parts = _parts(spark, sf)
    text = F.trim(F.when(F.col("p_size") < 25, F.col("p_name")).otherwise(_misspelled()))
    values = parts.select(F.concat(F.lit("model:"), "p_brand").alias("list"), text.alias("raw")).distinct()
    values = values.withColumn("folded", fold_ar(F.col("raw")))
    found = R.best_match(values.select("list", "folded"), vocabulary_of(spark, sf).candidates)
    return found.select(F.regexp_replace("list", "^model:", "").alias("make"), F.col("folded").alias("raw"), "match")


_RAW_MODEL = f"CASE WHEN p_size < 25 THEN concat(p_name, ' ') ELSE {_MISSPELLED} END"


def _pick(entries, column: str) -> str:
    return f"list_extract([{', '.join(repr(k) for k in entries)}], CAST({column} % {len(entries)} + 1 AS INT))"


# Raw and canonical values side by side. A misspelled model always finds a match within its make, as
# the make's own models include the correct spelling.
NORMALIZED = f"""
brand AS (SELECT DISTINCT p_brand AS name, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS ord FROM part),
raw_make AS (SELECT DISTINCT replace(p_brand, '#', '') AS a FROM part),
owned AS (SELECT DISTINCT p_brand AS owner, p_name AS name FROM part),
raw_model AS (SELECT DISTINCT p_brand AS make, trim({_RAW_MODEL}) AS raw FROM part),
both_sides AS (SELECT r.make, raw, name FROM raw_model r JOIN owned o ON r.make = o.owner),
pairs AS (SELECT a, name AS b FROM raw_make, brand UNION SELECT raw, name FROM both_sides), {ratio_ctes('pairs')},
made AS (SELECT a, arg_min(name, (-score, ord)) AS make FROM scored JOIN brand ON b = name JOIN raw_make USING (a)
         WHERE score >= 0.75 GROUP BY a),
inside AS (SELECT make, raw, min(name) AS match FROM both_sides WHERE contains(name, raw) GROUP BY ALL),
near AS (SELECT make, raw, arg_min(name, (-score, name)) AS match FROM both_sides JOIN scored ON a = raw AND b = name
         WHERE score >= 0.75 GROUP BY ALL),
modelled AS (SELECT r.make, raw, coalesce(CASE WHEN o.name IS NOT NULL THEN raw END, i.match, n.match) AS model
             FROM raw_model r LEFT JOIN owned o ON o.owner = r.make AND o.name = raw
             LEFT JOIN inside i USING (make, raw) LEFT JOIN near n USING (make, raw)),
normalized AS (
  SELECT l_orderkey, l_partkey, l_linenumber, a AS old_make, made.make AS make, {_RAW_MODEL} AS old_model, modelled.model AS model,
    {_pick(_FUELS, 'l_suppkey')} AS old_fuel_type, {_variant_case(_FUELS, 'l_suppkey')} AS fuel_type,
    {_pick(_CITIES, 'l_linenumber')} AS old_city, {_variant_case(_CITIES, 'l_linenumber')} AS city,
    {_pick(_COLORS, 'p_size')} AS old_exterior_color, {_variant_case(_COLORS, 'p_size')} AS exterior_color,
    {_pick(_GEARS, 'l_partkey')} AS old_transmission, {_variant_case(_GEARS, 'l_partkey')} AS transmission,
    concat(format('{{:,}}', CAST(floor(l_extendedprice) AS BIGINT)), ' $') AS old_price, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS price,
    concat(CAST(p_size AS VARCHAR), ' سلندر') AS old_cylinders, CAST(p_size AS VARCHAR) AS cylinders
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN made ON a = replace(p_brand, '#', '')
       JOIN modelled ON modelled.make = p_brand AND modelled.raw = trim({_RAW_MODEL}))
"""
NORMALIZED_FIELDS = ["make", "model", "fuel_type", "city", "exterior_color", "transmission", "price", "cylinders"]


@query(
    "normalize_listings",
    f"WITH RECURSIVE {NORMALIZED} SELECT l_orderkey, l_partkey, l_linenumber, {', '.join(NORMALIZED_FIELDS)} FROM normalized",
)
def _(spark, sf):
    return R.normalize_listings(raw_listings(spark, sf), vocabulary_of(spark, sf))


@query(
    "unknown_values",
    """
    SELECT 'fuel_type' AS field, 'steam' AS value FROM lineitem WHERE l_suppkey % 5 = 4
    UNION SELECT 'city', 'الدمام' FROM lineitem WHERE l_linenumber % 5 = 4
    UNION SELECT 'exterior_color', 'ذهبي' FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 5 = 3
    UNION SELECT 'transmission', 'cvt' FROM lineitem WHERE l_partkey % 5 = 4
    """,
)
def _(spark, sf):
    rows = raw_listings(spark, sf).drop("make", "model")
    return durable(R.resolve(rows, vocabulary_of(spark, sf)).unknown())
