"""One query per operator over the whole of its table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm import chat, chunks, decontam, langid, nbest, neighbours, phrases, quality_rules, resample, runs, simhash, suffixes, warc
from weatherloom.llm.common import crc_mod3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32 modulo 3 is not 1 (a null doc_id has none), predicts every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(crc_mod3(F.col("doc_id")) != 1))
    predicted = langid.predict(docs.select("doc_id", "text"), model, ["doc_id"])
    held_out = F.coalesce(crc_mod3(F.col("doc_id")) == 1, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", F.round("containment", 6).alias("containment"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    left = chunks.deduplicated(docs)
    removed = F.aggregate("removed_spans", F.lit(0), lambda n, r: n + r["end"] - r["start"]).cast("long")
    return left.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"), "removed_spans",
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.union(own)))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = resample.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return sample.select("doc_id", "log_ratio", "log_weight", "draw", "kept")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encoded(_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_shared",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(_table(spark, sf_dir, "documents"), plant=True)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_decontamination, op3_quality_rules, op4_substring_dedup, op5_chat_format,
        op6_quality_classifier, op7_simhash, op8_sentencepiece_nbest, op9_suffix_dedup, op10_warc,
        op11_periodic_runs, op12_embedding_dedup, op13_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op2_decontamination": decontam.SQL,
    "op5_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ')) + length(role) + 14 AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op9_suffix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 800) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 239)) AS i FROM d)
), v AS MATERIALIZED (
  SELECT doc_id, i, CASE WHEN length(x) = 800 THEN md5_number(x) END AS k, md5_number(substr(x, 1, 480)) AS k240 FROM w
), r AS (
  SELECT doc_id, i FROM v WHERE k IN (SELECT k FROM v WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1)
), z AS (
  SELECT doc_id, sum(least(240, coalesce(next - i, 240)))::BIGINT AS n_shared
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM v WHERE k240 IN (SELECT k240 FROM v GROUP BY k240 HAVING count(*) > 1))
  GROUP BY doc_id
), g AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM r)
), s AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, run
), p AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM s
), o AS (
  SELECT doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS stop, string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS front
  FROM p JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE front || substr(h, 2 * stop + 1) END)) AS kept_sha256, coalesce(n_shared, 0) AS n_shared
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN z USING (doc_id)
""",
    "op12_embedding_dedup": neighbours.SQL,
    "op13_collocations": phrases.SQL,
    "op10_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p
""",
}
