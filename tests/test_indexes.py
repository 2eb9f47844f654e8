"""Key indexes and versioned tables: plans, repeated steps, and writes that die."""

import pytest
from pyspark.sql import functions as F

from adloom.operators import incremental as I
from adloom.session import fresh_path
from adloom.sources.key_index import KeyIndex
from adloom.sources.versions import StaleVersionError, VersionedTable, current_path


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_index_persists_and_repeated_steps_add_nothing(spark):
    index = KeyIndex(spark, buckets=4)
    assert index.read().count() == 0 and index.met(keys(spark, "a")).count() == 0
    assert {r.key for r in index.append(keys(spark, "a", "b", "a", None)).collect()} == {"a", "b"}
    assert index.append(keys(spark, "a", "b")).count() == 0
    again = KeyIndex(spark, index.path, buckets=4)
    again.append(keys(spark, "c", "b"))
    again.compact()
    assert sorted(r.key for r in index.read().collect()) == ["a", "b", "c"]
    assert {r.key for r in index.met(keys(spark, "c", "x", "", None, "c")).collect()} == {"c"}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keys_")]


def test_only_the_new_side_is_shuffled(spark):
    index = KeyIndex(spark, buckets=4)
    index.append(spark.range(1000).select(F.col("id").cast("string").alias("key")))
    for runs, sorts in ((2, 2), (1, 1)):
        if runs == 2:
            index.append(spark.range(1000, 2000).select(F.col("id").cast("string").alias("key")))
        else:
            index.compact()
        with index._table() as known:
            plan = index._compared(keys(spark, "5"), known, "left_semi")._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin") :]
        assert "Bucketed: true" in join and join.count("Sort [") == sorts
        assert join.count("Exchange") == join.count("Exchange hashpartitioning(key_hash") == 1
        assert "Aggregate" not in plan  # repeated keys are one row before they reach the join


@pytest.mark.parametrize("blank", [True, False])
def test_indexed_duplicates_equal_those_by_join(spark, blank):
    schema = "id string, title string, price string"
    existing = spark.createDataFrame([("1", "A", "5"), (None, " b ", "6"), ("", "", None), ("7", None, "")], schema)
    new = spark.createDataFrame([("1", "z", "9"), ("2", "a ", "5"), (None, "B", "6"), ("", None, None), ("9", "q", "1"), (None, None, ""), ("1\u00016", "x", "y")], schema)
    index = KeyIndex(spark, buckets=4)
    I.index_listings(index, existing, blank_matches=blank)
    plain = I.mark_duplicates(new, existing, blank_matches=blank).orderBy("id", "title").collect()
    assert I.mark_duplicates_indexed(new, index, blank_matches=blank).orderBy("id", "title").collect() == plain


def test_a_hot_key_is_split_behind_the_index(spark):
    index = KeyIndex(spark, buckets=4)
    index.append(spark.range(0, 40_000, 2).select(F.col("id").cast("string").alias("key")))
    rows = spark.range(60_000).select(F.when(F.col("id") % 10 < 7, 8).otherwise(F.col("id")).cast("string").alias("id"), F.repeat(F.lit("x"), 50).alias("text"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = I.keep_unseen_indexed(rows.repartition(4), index)
        assert left.count() == spark.range(60_000).filter("id % 10 >= 7 AND NOT (id < 40000 AND id % 2 = 0)").count()
        query = left.groupBy().count()
        query.collect()
        assert "skew=true" in query._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_write_that_dies_leaves_the_old_rows(spark):
    table = VersionedTable(spark, fresh_path(spark))
    schema = spark.range(1).schema
    assert table.read(schema).count() == 0
    table.replace(spark.range(5))
    broken = table.read().select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.version() == 1 and table.read().count() == 5
    table.replace(table.read().filter("id > 2"))  # computed from the version it replaces
    assert [r.id for r in table.read().orderBy("id").collect()] == [3, 4]
    assert table.clean(keep=1) == 2 and table.read().count() == 2


def test_of_two_writers_one_fails(spark):
    table = VersionedTable(spark, fresh_path(spark))
    first = table.replace(spark.range(1))

    def late(folder):
        table.replace(spark.range(2))
        spark.range(3).write.parquet(folder)

    with pytest.raises(StaleVersionError):
        table.replace_by(late)
    with pytest.raises(StaleVersionError):
        table.replace(spark.range(9), after=first)
    assert table.read().count() == 2


def test_a_pointer_cut_short_is_passed_over(spark):
    table = VersionedTable(spark, fresh_path(spark))
    table.replace(spark.range(4))
    table._fs.create(table._hadoop.Path(f"{table.path}/versions/2"), False).close()
    assert table.version() == 1 and table.read().count() == 4
    assert table.replace(spark.range(6)) == 3 and current_path(spark, table.path) == table.current()


def test_tables_and_catalogs_are_replaced_by_versions(spark):
    from adloom.sources import catalog as C
    from adloom.sources import tables as S

    path, columns = fresh_path(spark, "sheet"), ["id", "city"]
    rows = spark.createDataFrame([("1", "x"), ("2", None)], "id string, city string")
    S.append_table(rows, path, columns)
    S.overwrite_table(S.read_listing_table(spark, path, columns).filter("id = '2'"), path, columns)
    S.append_table(rows.filter("id = '1'"), path, columns)
    assert sorted(r.id for r in S.read_listing_table(spark, path, columns).collect()) == ["1", "2"]
    broken = rows.select(F.raise_error(F.lit("lost")).cast("string").alias("id"), "city")
    with pytest.raises(Exception, match="lost"):
        S.overwrite_table(broken, path, columns)
    assert S.read_listing_table(spark, path, columns).count() == 2

    sites = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    catalog = fresh_path(spark, "catalog")
    C.save_catalog(sites, catalog)
    C.save_catalog(C.delete_from_catalog(C.read_catalog(spark, catalog), sites.filter("id = 1")), catalog)
    assert [r.name for r in C.read_catalog(spark, catalog).collect()] == ["b"]
