"""Repairs against a plain search over whole audits, and the odd rows."""

import random
from functools import lru_cache

import pytest

from adloom.llm import conversation_repair as cr

GRAMMAR = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow what was written last


def plain_repair(symbols):
    """Least cost and, among its audits, the first in ASCII: every edit sequence is weighed as a whole string."""

    @lru_cache(None)
    def best(row, last, inserts):
        found = [(0, "")] if row == len(symbols) and last in ("", "a") else []
        if inserts < 3:
            for role in "ua":
                if role in GRAMMAR[last]:
                    cost, audit = best(row, role, inserts + 1)
                    found.append((cost + 5, "I" + audit))
        if row < len(symbols):
            symbol = symbols[row]
            cost, audit = best(row + 1, last, 0)
            found.append((cost + 2, "D" + audit))
            more = 5 * symbol.isupper()
            for role in GRAMMAR[last] if symbol != "x" else "":
                if symbol.lower() == role:
                    cost, audit = best(row + 1, role, 0)
                    found.append((cost + more, "K" + audit))
                if role in "ua":
                    cost, audit = best(row + 1, role, 0)
                    found.append((cost + more + 1, "R" + audit))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def test_automaton_equals_plain_search():
    draw = random.Random(5)
    signatures = {"".join(draw.choice("suaoSUAOxuaua") for _ in range(draw.randrange(10))) for _ in range(3000)}
    path = cr.SuffixPath()
    for backwards in sorted(s[::-1] for s in signatures):
        assert path.repair(backwards) == plain_repair(backwards[::-1]), backwards[::-1]


def test_a_node_is_made_once_per_suffix(monkeypatch):
    made = []
    monkeypatch.setattr(cr, "node", lambda symbol, below, real=cr.node: made.append(symbol) or real(symbol, below))
    path = cr.SuffixPath()
    signatures = ["uaua", "suaua", "aua", "uua", "ua"]
    for backwards in sorted(s[::-1] for s in signatures):
        path.repair(backwards)
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s))})


def test_very_long_conversations_take_memory_in_proportion():
    path = cr.SuffixPath()
    cost, audit = path.repair("au" * 50_000)
    assert cost == 0 and audit == "K" * 100_000
    cost, audit = path.repair("au" * 50_000 + "u")
    assert cost == 2 and audit == "D" + "K" * 100_000


def test_signature_counts_first_faults():
    roles = ["user", "user", "user", "assistant", "tool", "assistant", ""]
    texts = ["Hi.", "Hi.", " \t\n", "cut", "done!  \n", "cut", "?"]
    assert cr.signature(roles, texts) == ("uxxAoxo", 1, 2, 1, 5)
    assert cr.signature([], []) == ("", 0, 0, 0, 0)


def plain_rows(rows):
    """``conv_id`` to the repaired turns, cost and audit, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t, role or " " if role is None else role, " " if text is None else text) for c, t, role, text in rows if c == conv), key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        symbols, seen = "", set()
        for _, _, role, text in own:
            core = text.strip(" \t\n\x0b\x0c\r")
            if not core or (role, text) in seen:
                symbols += "x"
            else:
                s = role[0] if role and role[0] in "sua" else "o"
                symbols += s if core[-1] in ".!?" else s.upper()
            seen.add((role, text))
        out[conv] = plain_repair(symbols)
    return out


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (2, None, None, None), (2, 0, "system", "Be brief."), (2, 0, "system", "Be brief."),
        (3, 5, "", "x."), (3, 2, "tool", "é" * 70_000 + "."), (3, 9, "assistant", "long " * 60_000), (None, 1, "user", "no id."), (None, None, "assistant", "ok!"),
        (4, 1, "user", ""), (5, 1, "User", "a."), (5, 1, "user", "a."), (5, 1, "user", "b."), (6, 3, "assistant", "late."), (6, 1, "user", "early"),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string, turns string, signature string, cost int, audit int, present string"
    frame = spark.createDataFrame([(*r, "t", "s", 1, 2, "p") for r in rows], schema).repartition(3)
    done = {r["conv_id"]: r for r in cr.repair_conversations(frame).collect()}
    expected = plain_rows(rows)
    assert {c: (r["cost"], r["audit"]) for c, r in done.items()} == expected
    assert done[1]["repaired"] == [("user", "Hello."), ("assistant", "Yes.")] and done[3]["gaps"] == 5 and done[2]["gaps"] == 0
    assert [t["role"] for t in done[6]["repaired"]] in ([], ["user", "assistant"])


def test_conversations_without_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(7, 1, "user", "x.", False), (8, 1, "user", "x.", True)], "conv_id int, turn int, role string, text string, here boolean")
    done = {r["conv_id"]: r for r in cr.repair_conversations(frame, frame["here"]).collect()}
    assert (done[7]["cost"], done[7]["audit"], done[7]["repaired"], done[7]["gaps"]) == (0, "", [], 0) and done[8]["audit"] == "D"
    assert cr.repair_conversations(frame.where("false")).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_result_does_not_depend_on_partitions(spark, partitions):
    draw = random.Random(9)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "tool"]), draw.choice(["a.", "b", "", "c!", "a."])) for c in range(120) for t in range(draw.randrange(1, 9))]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        done = {r["conv_id"]: (r["cost"], r["audit"]) for r in cr.repair_conversations(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert done == plain_rows(rows)
