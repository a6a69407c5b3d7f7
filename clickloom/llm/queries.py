"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, html, infill, lm, minhash, packing, quality, repair, substrings, urls, vectors, warc
from .tables import shared_path, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(path: str | None = None) -> str:
    """The JSON text of the byte-level vocabulary; without a path the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text(encoding="utf-8")


@query("op1_bpe_codec")
def op1_bpe_codec(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    definition = vocabulary(path)
    found = bpe.encode(table(spark, folder, "documents"), definition, with_decoded=True)
    return found.select(
        "doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query("op2_near_duplicates")
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean(table(spark, folder, "documents"), with_text=False)


@query("op3_html_text")
def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query("op5_chat_format", """
WITH said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), marked AS (
  SELECT *, regexp_replace(regexp_replace(text, '###(\\\\*) ', '###\\\\\\1 ', 'g'), '</turn(\\\\*)>', '</turn\\\\\\1>', 'g') AS safe
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ') + length(role) + length(': ') + length(safe) + length('</turn>') + 1) AS BIGINT)
         AS formatted_chars
FROM marked GROUP BY conv_id
""")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    read = chat.read_back(chat.format_chats(rows.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query("op6_lm_score")
def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lm.score(docs, lm.learn(docs))


@query("op7_warc_archive", """
WITH paid AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), held AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS holder
  FROM paid
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM held
""")
def op7_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    return warc.read_archive(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(stored(packing.measured(table(spark, folder, "documents")), "measured"))


@query("op10_near_vectors")
def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op13_fill_in_middle", """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n, CAST('0x' || substr(hash, 1, 8) AS BIGINT) % (len(units) + 1) AS one,
         CAST('0x' || substr(hash, 9, 8) AS BIGINT) % (len(units) + 1) AS two,
         CAST('0x' || substr(hash, 25, 8) AS BIGINT) % 100 AS four,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM cut
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:least(one, two)], ''), '') AS prefix,
         coalesce(array_to_string(units[least(one, two) + 1:greatest(one, two)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(one, two) + 1:], ''), '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN four < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN four < 50 THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""")
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = infill.fill_in_middle(table(spark, folder, "documents"))
    text = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("restored_sha256"))


def _url_levels() -> str:
    """The SQL of the two models, context length by context length."""
    parts = []
    for k in range(4):
        low = "1 / 32.0::DOUBLE AS low_a, 1 / 32.0::DOUBLE AS low_r" if k == 0 else "l.accepted AS low_a, l.rejected AS low_r"
        lower = "" if k == 0 else f"JOIN level{k - 1} l ON l.context = c.context % {32 ** max(k - 1, 0)} AND l.symbol = y.symbol"
        parts.append(f"""
seen{k} AS (
  SELECT (gram // 32) % {32 ** k} AS context, gram % 32 AS symbol, sum(a) AS a, sum(r) AS r FROM counts GROUP BY ALL
), context{k} AS (
  SELECT context, sum(a) AS all_a, sum(r) AS all_r, count_if(a > 0) AS kinds_a, count_if(r > 0) AS kinds_r
  FROM seen{k} GROUP BY context {"HAVING sum(a) > 0 AND sum(r) > 0" if k == 0 else ""}
), level{k} AS (
  SELECT context, symbol,
         CASE WHEN all_a > 0 THEN (coalesce(a, 0) + kinds_a * low_a) / (all_a + kinds_a) ELSE low_a END AS accepted,
         CASE WHEN all_r > 0 THEN (coalesce(r, 0) + kinds_r * low_r) / (all_r + kinds_r) ELSE low_r END AS rejected
  FROM (SELECT c.*, y.symbol, s.a, s.r, {low}
        FROM context{k} c CROSS JOIN (SELECT unnest(range(32)) AS symbol) y
        LEFT JOIN seen{k} s ON s.context = c.context AND s.symbol = y.symbol {lower})
), ratio{k} AS (
  SELECT context, symbol, CAST(floor((ln(accepted) - ln(rejected)) * 65536 + 0.5) AS BIGINT) AS ratio FROM level{k}
)""")
    return ",".join(parts)


@query("op11_url_filter", f"""
WITH cut AS (
  SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), ruled AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut
), coded AS (
  SELECT *, rule IN ('example.net/en/', 'org/fr/') AS accepted,
         [0, 0, 0] || list_transform(list_filter(string_split(url, ''), lambda c: c <> ''), lambda c:
           CASE WHEN unicode(c) >= 128 THEN 31 WHEN c BETWEEN 'a' AND 'z' THEN unicode(c) - 96
                WHEN c BETWEEN 'A' AND 'Z' THEN unicode(c) - 64 WHEN c BETWEEN '0' AND '9' THEN 27 WHEN c = '/' THEN 28
                WHEN c = '.' THEN 29 ELSE 30 END) || [0] AS s
  FROM ruled
), grams AS (
  SELECT row, accepted, rule, CAST('0x' || substr(sha256(url), 1, 8) AS BIGINT) % 5 = 0 AS held,
         unnest(list_transform(range(1, len(s) - 2), lambda i: ((s[i] * 32 + s[i + 1]) * 32 + s[i + 2]) * 32 + s[i + 3])) AS gram
  FROM coded
), counts AS (
  SELECT gram, count_if(accepted) AS a, count_if(NOT accepted) AS r FROM grams
  WHERE rule IS NOT NULL AND NOT held GROUP BY gram
), {_url_levels()}, steps AS (
  SELECT row, any_value(accepted) AS accepted, any_value(rule) AS rule, any_value(held) AS held,
         CAST(floor(sum(coalesce(r3.ratio, r2.ratio, r1.ratio, r0.ratio)) / (count(*) * 256)) AS BIGINT) AS step
  FROM grams
  LEFT JOIN ratio3 r3 ON r3.context = gram // 32 AND r3.symbol = gram % 32
  LEFT JOIN ratio2 r2 ON r2.context = (gram // 32) % 1024 AND r2.symbol = gram % 32
  LEFT JOIN ratio1 r1 ON r1.context = (gram // 32) % 32 AND r1.symbol = gram % 32
  LEFT JOIN ratio0 r0 ON r0.context = 0 AND r0.symbol = gram % 32
  GROUP BY row
), known AS (
  SELECT * FROM steps WHERE rule IS NOT NULL AND held AND step IS NOT NULL
), tried AS (
  SELECT step, CAST(ceil((coalesce(lag(step) OVER (ORDER BY step), step) + step) / 2.0) AS BIGINT) AS threshold,
         (SELECT count_if(accepted AND step >= t.step) FROM known) * (SELECT count_if(NOT accepted) FROM known)
         + (SELECT count_if(NOT accepted AND step < t.step) FROM known) * (SELECT count_if(accepted) FROM known) AS good
  FROM (SELECT DISTINCT step FROM known) t
), best AS (
  SELECT threshold FROM tried WHERE (SELECT bool_or(accepted) AND bool_or(NOT accepted) FROM known) ORDER BY good DESC, step LIMIT 1
)
SELECT page_id, host, path, coded.rule,
       CASE WHEN CASE WHEN coded.rule IS NOT NULL THEN coded.accepted ELSE coalesce(step >= (SELECT threshold FROM best), true) END
            THEN 'allow' ELSE 'block' END AS verdict,
       step * (1 / 256.0::DOUBLE) AS log_ratio
FROM coded JOIN steps USING (row)
""")
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    names = [c.split()[0] for c in repair.RESULT.split(", ")]
    made = repair.repair(repair.damaged(rows)).select(F.col("conv_id").alias("_conv"), *names)
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(b""), 256)}
    return every.join(made, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(F.col(name), none.get(name, F.lit(0).cast("long"))).alias(name) for name in names])
