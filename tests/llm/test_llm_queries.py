"""Queries against their SQL on the smallest tables, and the pipeline against a brute-force version."""

from pathlib import Path

import duckdb
import numpy as np
import pytest
from edge import documents
from pyspark.sql import functions as F
from test_dedup import brute_components, near_copies

import corpus_pipeline
from adloom.llm import mixing
from adloom.llm.queries import QUERIES
from adloom.llm.tokens import default_vocabulary, encoder
from adloom.session import fresh_path

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    run, sql = QUERIES[name]
    frame = run(spark, str(DATA))
    rows = [tuple(r) for r in frame.collect()]
    assert rows
    if sql is None:
        return
    database = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    answer = database.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in frame.columns]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r[i] for i in order)) for r in answer.fetchall())


def test_pipeline_equals_a_plain_one(spark):
    docs = near_copies(7, bases=3, copies=12)
    docs += [(1000 + k, text) for k, (_, text) in enumerate(docs[:9])]  # exact copies
    docs += [(2000, None), (2001, ""), (2002, "12 34 !!"), (2003, "short"), (None, "no id but some words")]
    folder = fresh_path(spark)
    documents(spark, docs).write.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()

    kept = {}
    for i, text in docs:
        if any(c.isalpha() for c in text or "") and (text not in kept or (i or -1) > kept[text]):
            kept[text] = i
    unique = [(i, text) for text, i in kept.items()]
    stays = {i for i, _, _, keep in brute_components(unique, corpus_pipeline.SIMILAR) if keep}
    left = {i: text for i, text in unique if i in stays}
    exact = encoder(default_vocabulary()).exact
    ids = {i: exact.encode(t, add_special_tokens=False).ids + [1] for i, t in left.items()}
    assert {r["doc_id"] for r in rows} == set(left)
    for i, own in ids.items():
        pieces = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, n in pieces) == len(own) and all(r["doc_tokens"] == len(own) for r in rows if r["doc_id"] == i)
    mixed = [r["doc_id"] for r in mixing.schedule(documents(spark, list(left.items())), corpus_pipeline.SHARES).orderBy("slot", "begin").select(F.col("document.doc_id").alias("doc_id")).collect()]
    first = sorted((r["sequence_id"], r["offset"], r["doc_id"]) for r in rows if r["start"] == 0)
    assert [i for _, _, i in first] == mixed
    ends = np.cumsum([len(ids[i]) for i in mixed])
    assert [s * 2048 + o for s, o, _ in first] == [0, *ends[:-1].tolist()]


def test_stages_return_the_columns_of_documents(spark):
    docs = documents(spark, [(1, "some words in here"), (2, "other words in there")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns


def test_pipeline_drops_near_copies_from_80_per_cent(spark):
    docs = near_copies(7, bases=3, copies=12)
    for k, changed in enumerate([9, 8, 7, 10]):  # of 81 shingles each: similarities of 0.8, 0.82, 0.84 and 0.78
        words = [f"v{k}x{place}" for place in range(85)]
        docs += [(3000 + 2 * k, " ".join(words)), (3001 + 2 * k, " ".join([*words[:-changed], *["o" + w for w in words[-changed:]]]))]
    folder = fresh_path(spark)
    documents(spark, docs).write.parquet(f"{folder}/documents.parquet")
    kept = {}
    for i, text in docs:
        kept[text] = max(i, kept.get(text, i))
    stays = {i for i, _, _, keep in brute_components([(i, text) for text, i in kept.items()], 80) if keep}
    assert stays >= {3000, 3002, 3004, 3006, 3007} and not stays & {3001, 3003, 3005}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == stays
