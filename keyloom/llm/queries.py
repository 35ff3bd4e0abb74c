"""The registered queries of this package, each a thin use of its operator, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm import archive, chat, decontamination, hidden, licenses, merkle, mixing, neighbours, repair, repeats, sharding, similar, toxicity
from keyloom.llm.common import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    return chat.digests(chat.format_conversations(rows))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    records = docs.select("doc_id", sharding.record_size().alias("size"), sharding.text_crc32().alias("text_crc32"))
    placed, _ = sharding.assign(records, ["doc_id", "text_crc32"], "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.fit_chain(docs, labels)
    scored = chain.score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id", F.col("toxicity.poor").alias("p_poor"), F.col("toxicity.toxic").alias("p_toxic"), chain.rejects(scored).alias("toxic")
    )


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    results, _ = repeats.remove_repeats(docs)
    return repeats.per_document(docs, results).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = archive.write_archive(table(spark, sf_dir, "pages"))
    found = archive.parsed(archive.read_archive(*written))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    name = found.columns[-1]
    return found.select(
        "doc_id",
        F.col(f"{name}.n_words").alias("n_words"),
        F.col(f"{name}.n_hit").alias("n_hit"),
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ","), 256).alias("items_sha256"),
        decontamination.contaminated(name).alias("contaminated"),
    )


def op7_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sized(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    mixed = mixing.mix(rows, F.col("_weight"), F.col("_hash"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "source")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.link_documents(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op12_hidden_markov_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden.score_documents(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_sharding,
        op3_toxicity,
        op4_suffix_array_dedup,
        op5_warc,
        op6_benchmark_decontamination,
        op7_approximate_nearest_neighbours,
        op8_mixing,
        op9_ngram_jaccard_join,
        op10_license_scan,
        op11_conversation_repair,
        op12_hidden_markov_scoring,
        op13_merkle_manifest,
        pipeline,
    )
}

# DuckDB; the others need hashes, models or iterations that SQL lacks and are tested against brute force.
ORACLE = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
""",
    "op6_benchmark_decontamination": r"""
WITH norm AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
tok AS (SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM norm),
win AS (
  SELECT DISTINCT id AS item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM tok WHERE side = 'b' AND len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM tok, lens WHERE side = 'd' AND len(w) >= n)),
met AS (SELECT p.id, p.n, p.i, win.item FROM places p JOIN win ON p.n = win.n AND p.g = win.g),
hit AS (SELECT id, count(DISTINCT k)::BIGINT AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM met) GROUP BY id),
items AS (SELECT id, count(*)::BIGINT AS n_items, string_agg(s, ',' ORDER BY s) AS l
  FROM (SELECT DISTINCT id, coalesce(CAST(item AS VARCHAR), '') AS s FROM met) GROUP BY id)
SELECT tok.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM tok LEFT JOIN hit USING (id) LEFT JOIN items USING (id) WHERE side = 'd'
""",
}
