"""JN-5, JN-12, EXT-5: label/value pairs to fields and specs inside descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import specs as S
from adloom.plans.registered.base import query, spread, table

_LABELS = {
    "السنة": "year", "سنة الصنع": "year", "الماركة": "make", "الوقود": "fuel_type", "نوع الوقود": "fuel_type",
    "الحالة": "condition", "الوارد": "_origin",
}
_ROW_LABELS = list(_LABELS)


def _pairs(spark, sf):
    """Order lines as label/value pairs of their order: seven line numbers, seven labels."""
    label = F.element_at(F.array(*[F.lit(x) for x in _ROW_LABELS]), F.col("l_linenumber"))
    value = F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_partkey").cast("string"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        (F.col("l_linenumber").cast("bigint") * 10000000000 + F.col("l_partkey")).alias("pos"),
        label.alias("label"), value.alias("value"),
    )


def _pivot_sql(function: str) -> str:
    case = " ".join(f"WHEN {i + 1} THEN '{f}'" for i, f in enumerate(_LABELS.values()))
    picks = ", ".join(
        f"{function}(value, pos) FILTER (WHERE field = '{f}') AS {f}" for f in ("condition", "fuel_type", "make", "year")
    )
    return f"""
    WITH pairs AS (SELECT l_orderkey AS id, CASE l_linenumber {case} END AS field,
                     CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey AS pos,
                     CAST(l_partkey AS VARCHAR) AS value
                   FROM lineitem WHERE l_returnflag <> 'A')
    SELECT id, {picks} FROM pairs WHERE field <> '_origin' GROUP BY id
    """


@query("spec_pivot_first", _pivot_sql("arg_min"))
def _(spark, sf):
    return S.pivot_specs(_pairs(spark, sf), _LABELS, keep="first")


@query("spec_pivot_last", _pivot_sql("arg_max"))
def _(spark, sf):
    return S.pivot_specs(_pairs(spark, sf), _LABELS, keep="last")


def _part_pairs():
    entries = [("السنة", F.col("p_size").cast("string")), ("نوع الوقود", F.col("p_type")), ("الماركة", F.col("p_brand")),
               ("الوقود", F.col("p_name")), ("سنة الصنع", F.lit("")), ("الوارد", F.lit("x"))]
    return F.array(
        *[F.struct(F.lit(i).alias("pos"), F.lit(k).alias("label"), v.alias("value")) for i, (k, v) in enumerate(entries)]
    )


@query(
    "spec_in_row",
    """
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS f_year, p_type AS f_fuel_type, p_brand AS f_make, CAST(NULL AS VARCHAR) AS f_condition,
           CAST(p_size AS VARCHAR) AS l_year, p_name AS l_fuel_type, p_brand AS l_make, CAST(NULL AS VARCHAR) AS l_condition
    FROM part
    """,
)
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_brand", "p_name").withColumn("pairs", _part_pairs())
    rows = S.with_specs(rows, "pairs", _LABELS, keep="first", prefix="f_")
    rows = S.with_specs(rows, "pairs", _LABELS, keep="last", prefix="l_")
    return rows.drop("pairs", "p_size", "p_type", "p_brand", "p_name")


@query(
    "positional_zip",
    """
    SELECT p_partkey, concat(p_name, '=', p_type) AS zipped, concat('a=', p_brand) AS halved FROM part
    """,
)
def _(spark, sf):
    zipped = S.zip_pairs(F.array("p_name", "p_brand"), F.array("p_type"))
    halved = S.halves(F.array(F.lit("a"), F.col("p_brand")))
    show = lambda pairs: F.array_join(F.transform(pairs, lambda p: F.concat(p["label"], F.lit("="), p["value"])), ";")
    return table(spark, sf, "part").select("p_partkey", show(zipped).alias("zipped"), show(halved).alias("halved"))


@query(
    "description_mining",
    """
    SELECT p_partkey, p_name AS model, p_type AS fuel_type, CASE WHEN p_size < 25 THEN p_brand END AS color,
           CASE WHEN p_size < 25 THEN CAST(p_size * 1000 AS VARCHAR) ELSE CAST(p_size * 1000 AS VARCHAR) END AS mileage,
           CAST(1960 + p_size AS VARCHAR) AS year, CASE WHEN p_size < 25 THEN 'دمشق' ELSE 'حلب الجديدة' END AS city
    FROM part
    """,
)
def _(spark, sf):
    size = F.col("p_size").cast("string")
    bullets = F.concat(
        F.lit("▪نوع الـسـيـارة  :  "), F.col("p_name"), F.lit("\n▪الوقود : -\n▪نوع الوقود : "), F.col("p_type"),
        F.lit("\n▪سـنـة الـصـنـع  :  "), (1960 + F.col("p_size")).cast("string"), F.lit("\n▪المسافة المقطوعة : "),
        F.format_number(F.col("p_size") * 1000, 0), F.lit(" كم\n• اللون : "), F.col("p_brand"), F.lit("\n📌العنوان : دمشق / القصور"),
    )
    prose = F.concat(
        F.lit("•نوع السيارة: "), F.col("p_name"), F.lit("\nماشية "), size, F.lit(" الف كيلو تواجد حلب الجديدة\nسنة الصنع: "),
        (1960 + F.col("p_size")).cast("string"), F.lit("\n▸الوقود ： "), F.col("p_type"),
    )
    rows = spread(table(spark, sf, "part")).select("p_partkey", F.when(F.col("p_size") < 25, bullets).otherwise(prose).alias("text"))
    return S.mine_description(rows, "text", prefix="").select("p_partkey", "model", "fuel_type", "color", "mileage", "year", "city")
