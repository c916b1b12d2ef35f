"""The operators over the whole test tables, and SQL that gives the same rows where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayflow.llm import (
    archives, bytepairs, decontamination, dialogues, infill, licenses, ordinal, packing, pages, pseudonyms, repair, rules, simhash,
)
from delayflow.operators.joins import join_dimension
from delayflow.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GRADES = 3


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key``, with its SQL twin if it has one."""

    def register(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grade() -> Column:
    """Grade of a document from its labels: toxic, poor, good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), keep_ids=False)
    return packing.best_fit(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_feistel_pseudonyms")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymise(docs, found_col="kinds")
    return found.select(
        "doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"),
    )


@query("op3_decision_list")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, _ = rules.judge(docs, table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "row.doc_id", *[F.col(f"_stats.{n}").alias(n) for n in names],
        F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_rule").alias("rule"),
    )


@query("op4_block_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_text(table(spark, sf_dir, "pages"), out_col="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_ordinal_grades")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.fit_ordinal(docs, table(spark, sf_dir, "labels"), grade(), GRADES)
    tails = F.col("graded.tails")
    return ordinal.grade_documents(docs, model).select(
        "doc_id", F.col("graded.expected_grade").alias("expected_grade"),
        tails[0].alias("p_not_toxic"), tails[1].alias("p_good"), (tails[1] >= 0.5).alias("kept"),
    )


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return found.select("doc_id", *[F.col(f"license.{n}").alias(n) for n in names])


OP8_SQL = """
WITH own AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS hex
  FROM pages
), named AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM own
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST(1 + 5 * (j // 4) AS INT), 5) AS INT)
      >> CAST(15 - 5 * (j % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM named
"""


@query("op8_warc_transactions", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    archives.write_captures(table(spark, sf_dir, "pages"), path)
    # The archives are parsed once; what is kept of a record is small without its payload.
    records = materialize(archives.read_records(spark, path, keep_payload=False), "records")
    captures = archives.assemble(records)
    c = F.col("capture")
    return captures.filter("part = 0").select(
        archives.page_of(c["record_id"]).cast("long").alias("page_id"),
        c["payload_bytes"].alias("payload_bytes"),
        c["payload_digest"].alias("payload_digest"),
        c["record_type"].alias("record_type"),
        archives.page_of(c["refers_to"]).cast("long").alias("refers_to"),
    )


WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
OP9_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents
), b AS (
  SELECT item_id, w, least(10, len(w)) AS k
  FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM b)
), dx AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (
    SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
    FROM d CROSS JOIN (SELECT DISTINCT k FROM win)
  )
), hit AS (
  SELECT r, i, k, s FROM dx WHERE EXISTS (SELECT 1 FROM win WHERE win.k = dx.k AND win.s = dx.s)
), cov AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY r
), its AS (
  SELECT r, list(DISTINCT CAST(item_id AS VARCHAR)) AS l
  FROM hit JOIN win ON hit.k = win.k AND hit.s = win.s GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(list_sort(l), ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""


@query("op9_benchmark_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark_hits(docs, table(spark, sf_dir, "benchmark"))
    items = F.col("hits.items")
    hit = decontamination.n_hit("hits")
    return marked.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP10_SQL = """
WITH m AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content,
    row_number() OVER (
      PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')
    ) - 1 AS pos
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'
), v AS (
  SELECT m.conv_id, perspective, CAST(pos // 512 AS INT) AS part, pos, content, speaker = perspective AS train,
    '<|' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
      ELSE 'user name=' || speaker END || '|>' || chr(10) AS head,
    content || chr(10) || '<|end|>' || chr(10) AS body
  FROM m JOIN s ON m.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
  SELECT *, sum(length(head) + length(body)) OVER (
      PARTITION BY conv_id, perspective, part ORDER BY pos
    ) AS stop
  FROM v
)
SELECT conv_id, perspective, part, count(*) AS n_messages,
  count(*) FILTER (WHERE train) AS n_trained,
  string_agg(head || body, '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(stop - length(body) AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY pos)
    FILTER (WHERE train), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""


@query("op10_perspective_rotation", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dialogues.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "conv_id", "perspective", "part", F.col("n_messages").cast("long").alias("n_messages"),
        F.size("mask").cast("long").alias("n_trained"), "text", F.array_join(spans, ",").alias("mask"),
    )


OP11_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), d AS (
  SELECT doc_id, text, u, len(u) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS one,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS other,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT *, array_to_string(u[1:least(one, other)], '') AS prefix,
    array_to_string(u[least(one, other) + 1:greatest(one, other)], '') AS middle,
    array_to_string(u[greatest(one, other) + 1:], '') AS suffix
  FROM d
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n", "form", "prefix_chars", "middle_chars"]
    output, form = F.col("infill.output"), F.col("infill.form")
    return found.select(
        "doc_id", *[F.col(f"infill.{n}").alias(n) for n in names], F.sha2(output, 256).alias("output_sha256"),
        F.sha2(infill.restore(output, form), 256).alias("restored_sha256"),
    )


RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op12_byte_pairs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bytepairs.read_ranks(public_tokenizers.path(RANKS))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bytepairs.encode(docs, ranks, public_tokenizers.PATTERN, decoded_col="decoded", packed_col="packed")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: rows dropped, emptied, cut, repeated or said by a user, by their checksum."""
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    chance = F.pmod(F.crc32(F.concat(blank["conv_id"], F.lit(":"), blank["turn"]).cast("binary")), F.lit(20))
    text = F.when(chance == 1, "").when(chance == 2, F.regexp_replace(blank["text"], "[.!?]", "")).otherwise(blank["text"])
    role = F.when(chance == 4, "user").otherwise(blank["role"])
    copies = F.explode(F.when(chance == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    hit = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), chance.alias("chance"))
    return hit.filter("chance <> 0").select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


OP13_SQL = """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce([4294967295] || list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda x: CAST(ord(x) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b)] || range(8),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM conversations
), hit AS (
  SELECT conv_id, turn, xor(crc, 4294967295) % 20 AS chance, role, text FROM keyed
), said AS (
  SELECT conv_id, turn, CASE chance WHEN 4 THEN 'user' ELSE role END AS role,
    CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE chance WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE chance <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM said
), faults AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    max(i) AS n
  FROM faults GROUP BY conv_id
), ways(state, spot, inserted, added) AS (
  VALUES (0, 0, '', ''), (0, 2, 'I', 'user:' || chr(10)), (0, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (1, 1, '', ''), (1, 2, 'I', 'user:' || chr(10)), (1, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (2, 2, '', ''), (2, 3, 'I', 'assistant:' || chr(10)), (3, 3, '', ''), (3, 2, 'I', 'user:' || chr(10))
), edits(spot, edit, behind, wanted, given) AS (
  VALUES (0, 'D', 0, '', ''), (1, 'D', 1, '', ''), (2, 'D', 2, '', ''), (3, 'D', 3, '', ''),
    (0, 'K', 1, 's', ''), (0, 'K', 2, 'u', ''), (1, 'K', 2, 'u', ''), (3, 'K', 2, 'u', ''), (2, 'K', 3, 'a', ''),
    (0, 'R', 2, '', 'user'), (1, 'R', 2, '', 'user'), (3, 'R', 2, '', 'user'), (2, 'R', 3, '', 'assistant')
), moves AS (
  SELECT state, behind, edit, wanted, given, inserted, added FROM ways JOIN edits USING (spot)
), best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS b FROM counted
  UNION ALL
  SELECT v.conv_id, v.i + 1, m.behind, min({
    'cost': b.cost + 3 * length(inserted) + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
      + CASE WHEN edit <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': b.audit || inserted || edit,
    'lines': b.lines || added || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
      ELSE given || ':' || f.text || chr(10) END})
  FROM best v JOIN faults f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1
  JOIN moves m ON m.state = v.state AND (m.wanted = '' OR m.wanted = f.initial)
    AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY v.conv_id, v.i, m.behind
), done AS (
  SELECT v.conv_id, min({'cost': b.cost + 3 * length(inserted), 'audit': b.audit || inserted, 'lines': b.lines || added}) AS b
  FROM best v JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id AND c.n = v.i
  JOIN ways w ON w.state = v.state AND w.spot IN (0, 3) GROUP BY v.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(left(b.lines, length(b.lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op13_conversation_repair", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(turns))
    same = F.struct("conv_id").alias("_same")
    reports = found.reports.select(same, *[c for c in found.reports.columns if c != "conv_id"])
    hashes = repair.digests(found.messages).select(same, "sha256")
    whole = turns.select("conv_id").distinct().withColumn("_same", F.struct("conv_id"))
    told = join_dimension(join_dimension(whole, reports, ["_same"], "left"), hashes, ["_same"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return told.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
