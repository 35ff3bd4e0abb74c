"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / weight, with u from a hash of its id, source and text and
weight its quality weight. A source whose target exceeds its size first gives complete epochs of all its
documents; what is left of the target is filled by its documents in the order of their keys, by a running
sum of sizes, and the document on the edge is taken whole if that brings the sum nearer to the target.

No source is sorted in one task: a histogram of sizes over ``BUCKETS`` ranges of the key gives the range in
which the budget ends, ranges before it are taken, and only that one range is sorted.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share ``share`` of all sizes; a
target stops at ``cap`` times its source's size and the excess is shared again by weight.

A null or empty text has size 0: it belongs to its source, is taken with complete epochs, and adds nothing.
Rows that agree in id, source and text share a key and follow each other; reruns agree. Long texts count with all their
words. An empty table gives an empty result. Other columns are kept by ``mix_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import free_name, numbered, quoted, written
from keyloom.operators.dedupe import ordinal

BUCKETS = 4096
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: str) -> Column:
    """Number of runs of characters other than blank, tab and line breaks."""
    words = F.split(F.coalesce(quoted(text), F.lit("")), "[\\x20\\x09-\\x0D]+")
    # Only the first and the last piece can be empty.
    empty = (F.element_at(words, 1) == "").cast("long") + ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("long")
    return F.size(words).cast("long") - empty


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size) with ``target``: capped shares by weight, found by raising the common level.

    Each round is one sum over the sources; a round caps more sources or is the last.
    """
    ranked = ordinal(sources, [F.col("source").asc_nulls_last()], "_rank")
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    ranked = ranked.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    ranked = written(ranked.withColumn("_cap", F.col("source_size") * float(cap)), "sources")
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_w") * level
        row = ranked.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(full, F.col("_cap"))).alias("given"),
            F.sum(F.when(~full, F.col("_w"))).alias("open"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped = row["capped"]
        level = max(level, (share * (row["size"] or 0) - (row["given"] or 0.0)) / row["open"])
    return ranked.select("source", "source_size", F.least("_cap", F.col("_w") * level).alias("target"))


def exponential_key(hashed: Column, weight: Column) -> Column:
    """-ln(u) / weight, u in (0, 1) from the upper 53 bits of a hash."""
    u = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def mix(
    rows: DataFrame,
    weight: Column,
    hashed: Column,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``rows`` (columns ``source`` and ``size``, others carried) with source_size, target and ``copies``.

    ``copies`` says how often the mix takes the row; ``weight`` is its positive quality weight and ``hashed``
    a 64-bit hash that stands for it.
    """
    keyed = rows.withColumn("_key", exponential_key(hashed, weight))
    keyed = keyed.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets).cast("int"))
    keyed = written(keyed, "keyed")
    per_bucket = written(keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_in")), "histogram")
    goal = targets(per_bucket.groupBy("source").agg(F.sum("_in").alias("source_size")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("_epochs", whole.cast("long"))
    goal = goal.withColumn("_budget", F.col("target") - F.col("_epochs") * F.col("source_size"))
    by_key = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.withColumn("_before", F.coalesce(F.sum("_in").over(by_key), F.lit(0)))
    plan = before.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumn("_edge", (F.col("_before") < F.col("_budget")) & (F.col("_before") + F.col("_in") > F.col("_budget")))
    plan = plan.withColumn("_all", F.col("_before") + F.col("_in") <= F.col("_budget"))
    plan = plan.withColumnsRenamed({"source": "_s", "_bucket": "_b"})
    placed = keyed.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    placed = placed.drop("_s", "_b", "_bucket", "_in")
    # The edge range only: one range of a source, a small part of it.
    order = Window.partitionBy("source").orderBy("_key", *carried(rows)).rowsBetween(Window.unboundedPreceding, 0)
    edge = placed.filter("_edge").withColumn("_after", F.col("_before") + F.sum("size").over(order))
    start, end, budget = F.col("_after") - F.col("size"), F.col("_after"), F.col("_budget")
    edge = edge.withColumn("_taken", (start < budget) & (end - budget <= budget - start)).drop("_after")
    rest = placed.filter("not _edge").withColumn("_taken", F.col("_all") & (F.col("_budget") > 0))
    copies = F.col("_epochs") + F.col("_taken").cast("long")
    return edge.unionByName(rest).select(*rows.columns, "source_size", "target", copies.alias("copies"))


def carried(rows: DataFrame) -> list[str]:
    """Columns that break ties: all of the row's own."""
    return [c for c in rows.columns if c not in ("source",)]


def quality_weight(quality: Column) -> Column:
    """Labelled good documents weigh twice, bad ones half of what unlabelled ones do."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def labelled(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``_quality``: the document's label, the best if it has several, null without one."""
    best = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_labelled"))
    best = best.agg(F.max("quality").alias("_quality"))
    return docs.join(best, quoted(id_column) == F.col("_labelled"), "left").drop("_labelled")


def sized(docs: DataFrame, labels: DataFrame, *carry: str, text: str = "text") -> DataFrame:
    """Narrow rows for ``mix``: the carried columns, source, size, weight and hash."""
    hashed = F.xxhash64("doc_id", "source", text)
    narrow = docs.select("doc_id", *carry, "source", word_count(text).alias("size"), hashed.alias("_hash"))
    rows = labelled(narrow, labels)
    return rows.withColumn("_weight", quality_weight(F.col("_quality"))).drop("_quality")


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    rows, row = numbered(docs, "mixed")
    chosen = mix(sized(rows, labels, row), F.col("_weight"), F.col("_hash")).filter("copies > 0")
    picked, times = free_name(rows, "_picked"), free_name(rows, "_times")
    chosen = chosen.select(quoted(row).alias(picked), F.sequence(F.lit(1).cast("long"), "copies").alias(times))
    return rows.join(chosen, quoted(row) == F.col(picked)).withColumn(times, F.explode(times)).select(*map(quoted, docs.columns))
