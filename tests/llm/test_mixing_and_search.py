import collections
import random
import textwrap

import numpy as np
import pytest
from edge import ODD, SCHEMA, documents
from pyspark.sql import functions as F

from adloom.llm import licenses, mixing, topk
from adloom.session import fresh_path


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 3, "b": 1, "c": 1}, {f"s{i}": 1 + i * i % 7 for i in range(15)}])
def test_every_time_is_within_a_block_of_the_target(shares):
    slots, total = mixing.period(shares), sum(shares.values())
    assert sorted(s for x in slots.values() for s in x) == list(range(total))
    for source, share in shares.items():
        for time in range(total + 1):
            got = sum(s < time for s in slots[source])
            assert abs(got - share * time / total) < 1
        for block, slot in enumerate(slots[source]):
            assert block * total // share <= slot < -(-(block + 1) * total // share)


def sourced(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, "x" * rng.randint(0, 300), "en", source, 1, 7, 7, 7, 7.0, 7, "x", "x", "x"))
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def test_schedule_equals_a_plain_one(spark):
    docs, rows = sourced(spark)
    shares = {"hot": 3, "a": 2}
    got = mixing.schedule(docs, shares, block_chars=1000).select("document.doc_id", "source", "block", "release", "deadline", "slot", "begin")
    drawn = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    every = {s: shares.get(s, 1) for s in {r[3] or "" for r in rows}}
    slots, total = mixing.period(every), sum(every.values())
    want = set()
    for source, share in every.items():
        begin = 0
        for i, text in sorted(((r[0], r[1]) for r in rows if (r[3] or "") == source), key=lambda x: (drawn[x[0]], x[0])):
            block = begin // 1000
            turn, k = divmod(block, share)
            want.add((i, source, block, block * total // share, -(-(block + 1) * total // share), turn * total + slots[source][k], begin))
            begin += len(text)
    assert set(map(tuple, got.collect())) == want


def test_mix_keeps_all_rows_and_stores_the_order(spark):
    docs, rows = sourced(spark)
    mixed = mixing.mix(docs, {"hot": 3, "a": 2}, block_chars=1000)
    assert mixed.columns == docs.columns
    path = fresh_path(spark)
    mixed.write.parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    order = [r["doc_id"] for r in stored.orderBy("file", "at").collect()]
    slots = {r["doc_id"]: (r["slot"], r["begin"]) for r in mixing.schedule(docs, {"hot": 3, "a": 2}, block_chars=1000).select("document.doc_id", "slot", "begin").collect()}
    assert [slots[i] for i in order] == sorted(slots.values())
    assert sorted(order) == list(range(600))


def test_mix_of_odd_rows(spark):
    odd = documents(spark, ODD)
    got = collections.Counter((r["doc_id"], r["text"]) for r in mixing.mix(odd).collect())
    assert got == collections.Counter(ODD)
    assert mixing.mix(odd.where("false")).count() == 0
    with pytest.raises(ValueError):
        mixing.period({"a": 0, "b": 1})


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, 1) for i, v in rows], "vec_id bigint, embedding array<float>, label int, rank int, score int")


def brute_top(rows, k, step):
    by_id = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own = [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]
        by_id[i] = min(by_id.get(i, own), own)
    out = []
    for q, a in by_id.items():
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in by_id.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"SUBTREE": 40, "PAGE": 8, "ROUTERS": 5, "QUERY_BLOCK": 7}])
def test_top_k_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=12)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, rows[0][1]) for i in range(700, 900)]  # a common vector
    got = topk.search_top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 10)


def test_pages_are_skipped():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(-20, 20, (1500, 8)) + 400 * c for c in np.eye(8, dtype=np.int64)])
    radius2 = float((data * data).sum(axis=1).max())
    tree = topk.Subtree(np.arange(len(data)), data, topk._lifted(data[:1], radius2)[0], radius2)
    looked = []
    tree.pages = [(c, r, t, a, i, Counting(v, looked)) for c, r, t, a, i, v in tree.pages]
    best = tree.search(-1, data[0], 5, radius2)
    scores = data @ data[0]
    assert [s for s, _ in best] == sorted(scores.tolist(), reverse=True)[:5]
    assert sum(looked) < len(data) / 3


class Counting:
    def __init__(self, data, looked):
        self.data, self.looked = data, looked

    def __getitem__(self, rows):
        self.looked.append(len(self.data[rows]))
        return self.data[rows]


def test_top_k_of_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (10, [1.0, 2.0]), (10, [0.5, 2.0]), (None, [1.0, 1.0]), (5, []), (6, [3.0])]
    got = topk.search_top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 10)
    one = topk.search_top_k(vectors(spark, rows[:1]), F.col("vec_id") % 10 == 0, 5)
    assert one.count() == 0 and topk.search_top_k(vectors(spark, rows).where("false"), F.lit(True), 5).count() == 0


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n"


@pytest.mark.parametrize(
    ("text", "names"),
    [
        (None, ""), ("", ""), ("nothing here.", ""),
        ("Some text.\nLicensed under the Apache License, Version 2.0.\nMore text.", "Apache-2.0"),
        ("released   UNDER the mit license", "MIT"),
        ("Copyright me\n\n" + MIT, "MIT"),
        (MIT[: MIT.index("The above")], ""),
        ("Licensed under CC BY-NC 4.0. Released under the MIT License. Released under the MIT License.", "CC-BY-NC-4.0,MIT"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GPL-3.0-or-later"),
        ("word " * 50_000 + ". Released under the MIT License.", "MIT"),
    ],
)
def test_licenses(spark, text, names):
    assert licenses.scan_licenses(documents(spark, [text])).first()["licenses"] == names


def test_longer_rules_come_first(spark):
    sentences, rules = {1: "one", 2: "two", 3: "three"}, [("A", [1, 2]), ("B", [1, 2, 3]), ("C", [3])]
    texts = ["one. two. three.", "one. other. two.", "two. one.", "one. two. one. two. three. three."]
    rows = licenses.scan_licenses(documents(spark, texts), sentences, rules).orderBy("doc_id").collect()
    assert [r["licenses"] for r in rows] == ["B", "A", "", "A,B,C"]
    assert [r["sentence_ids"] for r in rows] == ["1 2 3", "1 2", "2 1", "1 2 1 2 3 3"]
    assert licenses.scan_licenses(documents(spark, ODD)).count() == len(ODD)
    assert licenses.scan_licenses(documents(spark, ODD).where("false")).count() == 0


CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
CLAUSES = [
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
HEADERS = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at',
        "    http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.',
    ],
    "MIT": MIT.strip().split("\n\n"),
    "BSD-2-Clause": [CONDITIONS, *CLAUSES[:2]],
    "BSD-3-Clause": [CONDITIONS, *CLAUSES],
    "GPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."],
}


def header_forms(paragraphs):
    """A header as it is, filled to two widths, and each of these behind three kinds of comment marks."""
    plain = "\n\n".join(paragraphs)
    for text in [plain, *["\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in paragraphs) for width in (50, 72)]]:
        yield text
        for mark in ("# ", " * ", "// "):
            yield "\n".join((mark + line).rstrip() for line in text.split("\n"))


def test_full_headers_are_recognised(spark):
    forms = [(name, form) for name, paragraphs in HEADERS.items() for form in header_forms(paragraphs)]
    rows = licenses.scan_licenses(documents(spark, [form for _, form in forms])).orderBy("doc_id").collect()
    assert [(name, r["licenses"]) for (name, _), r in zip(forms, rows, strict=True)] == [(name, name) for name, _ in forms]


def test_apache_header_shows_its_whole_sequence(spark):
    plain = next(header_forms(HEADERS["Apache-2.0"]))
    secure, foundation = plain.replace("http:", "https:"), plain.replace("Licensed under", "The ASF licenses this file\nto You under")
    texts = [plain, secure, foundation, plain.replace("\n\n", "\n"), " ".join(plain.split())]
    rows = licenses.scan_licenses(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["licenses"] for r in rows] == ["Apache-2.0"] * 5
    assert [r["sentence_ids"] for r in rows[:3]] == ["19 2 20 21", "19 2 20 22", "26 2 20 21"]
    assert rows[4]["sentence_ids"] == "19 2 24"


def test_licenses_of_both_readings(spark):
    """Notices on lines of their own beside wrapped ones, and headers below a commented copyright line."""
    notice, gpl = "Released under the MIT License\n", "\n\n".join(HEADERS["GPL-3.0-or-later"])
    bsd2, bsd3 = ("\n\n".join(textwrap.fill(p, 60) for p in HEADERS[f"BSD-{k}-Clause"]) for k in (2, 3))
    long_lines = "\n".join([CONDITIONS, *CLAUSES[:2], textwrap.fill(CLAUSES[2], 60)])
    texts = [
        (notice + "and more\n\n" + bsd2, "BSD-2-Clause,MIT", "4 14 15 16"),
        (gpl + "\n\n" + notice + "and more", "GPL-3.0-or-later,MIT", "9 10 4"),
        (bsd2 + "\n" + notice + "and more", "BSD-2-Clause,MIT", "14 15 16 4"),
        (long_lines, "BSD-3-Clause", "14 15 16 17"),  # no two-clause licence by the lines alone
    ]
    for name, ids in {"MIT": "6 7", "BSD-3-Clause": "14 15 16 17", "GPL-3.0-or-later": "9 10", "MPL-2.0": "18"}.items():
        body = ["Copyright (c) 2020 Some Body", *HEADERS[name]]
        texts.append(("\n".join(f"# {line}".rstrip() for line in "\n\n".join(body).split("\n")), name, ids))
    rows = licenses.scan_licenses(documents(spark, [text for text, _, _ in texts])).orderBy("doc_id").collect()
    assert [(r["licenses"], r["sentence_ids"]) for r in rows] == [(names, ids) for _, names, ids in texts]
    assert [r["n_known"] for r in rows] == [len(ids.split()) for _, _, ids in texts]
