"""One query per operator over its whole table, with its SQL equivalent where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import (
    chat, collocations, conversation_repair, exact_dedup, language, licenses, mixing, near_dedup, packing, quality, secrets, shards, topk,
)
from adloom.llm.common import held_out
from adloom.llm.license_values import RULES, SENTENCES
from adloom.session import fresh_path

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CHAT.controls():
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT_SQL = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), false) AS again FROM every
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_sql_escaped("text")}) + CASE WHEN again THEN {len(chat.CHAT.part)}
           ELSE {len(chat.CHAT.open) + len(chat.CHAT.close) + 2} + length(replace({_sql_escaped("role")}, chr(10), '<\\n>')) END) AS BIGINT)
         AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query(CHAT_SQL)
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    every = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_conversations(every).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned")
    )
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    field = quality.learn_field(documents, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(documents, field, "doc_id")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


SHARES = {f"src{i}": 1 + i % 5 for i in range(20)}


@query()
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), SHARES)
    return timed.select("document.doc_id", "source", "block", "release", "deadline", "slot", "begin")


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
      FROM scored
    )
    SELECT * FROM ranked WHERE rank <= 5
    """
)
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query()
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = exact_dedup.deduplicate(table(spark, sf_dir, "documents"), exact_dedup.DigestIndex(spark))
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = shards.write_shards(table(spark, sf_dir, "documents"), fresh_path(spark, "shards"), key=20240917)
    return shards.read_shards(spark, layout).drop("ids")


def _licenses_sql() -> str:
    cases = " ".join(f"WHEN '{licenses.normalized(s)}' THEN {i}" for i, s in SENTENCES.items())
    letters = r"[^\p{L}\p{N}"

    def ids(ends: str, end: str) -> str:
        cut = f"regexp_replace(lower(coalesce(text, '')), '{ends}', {end}, 'g')"
        blank = f"regexp_replace({cut}, '{letters}' || {end} || ']+', ' ', 'g')"
        return f"list_filter(list_transform(string_split({blank}, {end}), lambda s: CASE trim(s) {cases} END), lambda i: i IS NOT NULL)"

    left, names = "seq", []
    for name, order in sorted(RULES, key=lambda r: (-len(r[1]), r[0], r[1])):
        shown = " " + "  ".join(map(str, order)) + " "
        names.append(f"CASE WHEN contains({left}, '{shown}') THEN '{name}' END")
        left = f"replace({left}, '{shown}', ' - ')"
    return f"""
    WITH read AS (
      SELECT doc_id, {ids(licenses.LINES, "chr(10)")} AS lines, {ids(licenses.WRAPPED, "chr(1)")} AS wrapped FROM documents
    ), found AS (SELECT doc_id, CASE WHEN len(wrapped) > len(lines) THEN wrapped ELSE lines END AS ids FROM read),
    s AS (SELECT doc_id, ids, ' ' || coalesce(list_aggregate(ids, 'string_agg', '  '), '') || ' ' AS seq FROM found)
    SELECT doc_id, coalesce(list_aggregate(ids, 'string_agg', ' '), '') AS sentence_ids, len(ids) AS n_known,
           coalesce(list_aggregate(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))), 'string_agg', ','), '')
             AS licenses
    FROM s
    """


@query(_licenses_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = language.learn_prototypes(documents)
    return language.predict_languages(documents, prototypes, "doc_id").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: rows damaged by a hash of conversation and turn; dropped ones are not present."""
    blank = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id", "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(code == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def _step(value: str, cost: int, edit: str) -> str:
    """SQL of a repair (eight digits of cost, then the audit) with one more edit in front."""
    return f"(lpad(CAST(CAST(substr({value}, 1, 8) AS INT) + {cost} AS VARCHAR), 8, '0') || '{edit}' || substr({value}, 9))"


def _repair_sql() -> str:
    delete = {x: _step(x, 2, "D") for x in "esua"}

    def edits(state: str, then: dict[str, str], given: str) -> str:
        kept = " ".join(f"WHEN f IS NOT NULL AND f = 't' AND i = '{i}' THEN {_step(to, 5, 'K')} WHEN f IS NULL AND i = '{i}' THEN {_step(to, 0, 'K')}" for i, to in then.items())
        role = f"CASE f WHEN 't' THEN {_step(given, 6, 'R')} ELSE {_step(given, 1, 'R')} END"
        keep = f"CASE {kept} ELSE '99999999' END"
        return f"CASE WHEN f = 'x' THEN {delete[state]} ELSE least({delete[state]}, {role}, {keep}) END"

    return f"""
    WITH RECURSIVE tab AS (
      SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, t,
             list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)) AS key
      FROM conversations, tab
    ), coded AS (
      SELECT conv_id, turn, role, text,
             xor(list_reduce(list_prepend(4294967295, key), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS code
      FROM keyed
    ), damaged AS (
      SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
             CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM coded, range(2) AS copy(n) WHERE code <> 0 AND (code = 3 OR n = 0)
    ), convs AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
    placed AS (
      SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n
      FROM damaged JOIN convs ON damaged.conv_id IS NOT DISTINCT FROM convs.conv_id
    ), judged AS (
      SELECT *, substr(role, 1, 1) AS i, lag(role) OVER w AS before,
             CASE WHEN NOT regexp_matches(text, '[^ \t-\r]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'duplicate'
                  WHEN regexp_extract(text, '([^ \t-\r])[ \t-\r]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
      FROM placed WINDOW w AS (PARTITION BY conv ORDER BY n)
    ), counted AS (
      SELECT conv, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (n > 1 AND substr(before, 1, 1) || i NOT IN ('su', 'ua', 'au')) AS illegal
      FROM judged GROUP BY conv
    ), signs AS (SELECT conv, n, i, CASE fault WHEN 'truncated' THEN 't' WHEN 'blank' THEN 'x' WHEN 'duplicate' THEN 'x' END AS f FROM judged),
    costs AS (
      SELECT conv, coalesce(rows, 0) + 1 AS n, '00000000' AS e, '00000010II' AS s, '00000005I' AS u, '00000000' AS a FROM convs LEFT JOIN counted USING (conv)
      UNION ALL
      SELECT conv, n, least(be, {_step("u", 5, "I")}), least(bs, {_step("u", 5, "I")}), u, least(ba, {_step("bu", 5, "I")}) FROM (
        SELECT *, least(bu, {_step("ba", 5, "I")}) AS u FROM (
          SELECT signs.conv, signs.n, {edits("e", {"s": "s", "u": "u"}, "u")} AS be, {edits("s", {"u": "u"}, "u")} AS bs,
                 {edits("u", {"a": "a"}, "a")} AS bu, {edits("a", {"u": "u"}, "u")} AS ba
          FROM costs JOIN signs ON signs.conv = costs.conv AND signs.n = costs.n - 1))
    ), best AS (SELECT conv, CAST(substr(e, 1, 8) AS BIGINT) AS cost, substr(e, 9) AS audit FROM costs WHERE n = 1),
    edits AS (SELECT conv, audit, unnest(range(1, length(audit) + 1)) AS j FROM best),
    turned AS (
      SELECT edits.conv, j, substr(audit, j, 1) AS edit, length(replace(substr(audit, 1, j), 'D', '')) AS m,
             role, text, i = 's' AND edit = 'K' AS system
      FROM edits LEFT JOIN judged ON judged.conv = edits.conv AND judged.n = length(replace(substr(audit, 1, j), 'I', ''))
    ), led AS (SELECT *, CASE WHEN bool_or(system AND m = 1 AND edit <> 'D') OVER (PARTITION BY conv) THEN m - 1 ELSE m END AS p FROM turned),
    told AS (
      SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN p % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                              CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS repaired
      FROM led WHERE edit <> 'D' GROUP BY conv
    )
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM convs LEFT JOIN counted USING (conv) JOIN best USING (conv) LEFT JOIN told USING (conv)
    """


@query(_repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    done = conversation_repair.repair_conversations(rows, F.col("present"))
    shown = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    digest = F.sha2(shown.cast("binary"), 256).alias("repaired_sha256")
    return done.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest)


@query(
    """
    WITH d AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
      FROM documents
    ), p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM d),
    o AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM p, range(1, 5) AS t(k)),
    g AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 30),
    cuts AS (SELECT lang, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS front, array_to_string(ws[j + 1:], ' ') AS back FROM c, range(1, 4) AS t(j) WHERE j < k),
    scored AS (
      SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f::HUGEINT + y.f) AS BIGINT) AS score
      FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = front JOIN g y ON y.lang = cuts.lang AND y.phrase = back
    ), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner_ AS (
      SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(f) AS inside
      FROM c, range(2, 4) AS s(m), range(1, 4) AS t(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM lowest LEFT JOIN inner_ USING (lang, phrase) JOIN totals USING (lang)
    WHERE inside IS NULL OR 100::HUGEINT * inside < 80::HUGEINT * a
    QUALIFY rank <= 2000
    """
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


@query()
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(documents, secrets.learn_formats(documents))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
