"""Joins and matches: next match in order, latest match, null-safe and skew-proof joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.rules import all_of
from keyloom.operators.dedupe import keep_one
from keyloom.session import broadcast_limit, estimated_bytes, shuffle_width


# Sketches of single tasks are merged in this many groups before the groups are merged, so that no
# task merges one sketch per input partition.
SKETCH_GROUPS = 200


def _by_sketch_group(df: DataFrame, value: Column) -> DataFrame:
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    return df.select(value.alias("v"), group.alias("g")).groupBy("g")


def quantile_cuts(df: DataFrame, value: Column, parts: int) -> list[float]:
    """At most ``parts - 1`` ascending values that cut the rows into parts of about equal size.

    A mergeable quantile sketch over one column, in one pass without shuffling rows.
    """
    precision = max(200, min(65_535, 8 * parts))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    sketches = _by_sketch_group(df, value).agg(F.kll_sketch_agg_double("v", precision).alias("s"), F.count("v").alias("n"))
    # Grouping by a constant gives no row, and so no sketch, for an empty table.
    merged = sketches.filter("n > 0").groupBy(F.lit(1)).agg(F.kll_merge_agg_double("s", precision).alias("s"))
    row = merged.select(F.kll_sketch_get_quantile_double("s", shares)).first()
    return sorted(set(row[0])) if row else []


def order_blocks(df: DataFrame, key: str, order: str, hot: Sequence, blocks: int, name: str = "_block") -> DataFrame:
    """Add a block number that splits the rows of hot keys along a numeric order column.

    The blocks are quantiles of the hot keys' rows, so no (key, block) holds more than about
    ``1 / blocks`` of them. All rows of another key are in block 0. Rows without a key or, for hot
    keys, without an order value match nothing; a hash spreads them.
    """
    value = F.col(order).cast("double")
    is_hot = F.col(key).isin(*hot) if hot else F.lit(False)
    cuts = quantile_cuts(df.filter(is_hot), value, blocks) if hot and blocks > 1 else []
    block = F.lit(0)
    if cuts:
        edges = [-float("inf"), *cuts, float("inf")]
        bucketizer = Bucketizer(splits=edges, inputCol="_order", outputCol="_part", handleInvalid="keep")
        df = bucketizer.transform(df.withColumn("_order", value)).drop("_order")
        block = F.when(is_hot, F.coalesce(F.col("_part").cast("int"), _spread(df.columns, blocks))).otherwise(block)
    block = F.when(F.col(key).isNull(), _spread(df.columns, blocks)).otherwise(block)
    return df.withColumn(name, block).drop("_part")


def _spread(columns: Sequence[str], parts: int) -> Column:
    """-1 down to -parts by the content of the row."""
    return -1 - F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def next_match(
    df: DataFrame,
    key: str,
    order: str,
    qualifies: Column,
    payload: Sequence[str],
    name: str = "nxt",
    hot: Sequence | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Add ``name``: the payload of the first later row of the same key that qualifies, else NULL.

    "Later" is a greater value of ``order``, a numeric column unique within the key. A running frame
    per key finds the match in one shuffle. Keys too large for one task are split into blocks along
    the order: the frame then runs per (key, block), and what it cannot see, the first qualifying row
    of the key's later blocks, is carried backwards from one summary row per (key, block) of those
    keys. ``hot`` and ``blocks`` override the keys that are found and the number of blocks.
    """
    hot = hot_keys(df, key)[0] if hot is None else list(hot)
    blocks = shuffle_width(df.sparkSession) if blocks is None else blocks
    valid = F.col(key).isNotNull() & F.col(order).isNotNull()
    flagged = df.withColumn("_hit", F.coalesce(qualifies & valid, F.lit(False)))
    numbered = order_blocks(flagged, key, order, hot, blocks)

    later = Window.partitionBy(key, "_block").orderBy(F.col(order).desc())
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    hit_payload = F.when(F.col("_hit"), F.struct(*payload))
    inside = numbered.withColumn("_inside", F.last(hit_payload, ignorenulls=True).over(later))
    if not hot:
        return inside.select(*df.columns, F.when(valid, F.col("_inside")).alias(name))

    hit_order = F.when(F.col("_hit"), F.col(order))
    summaries = numbered.filter(F.col(key).isin(*hot) & (F.col("_block") >= 0)).groupBy(key, "_block").agg(
        F.min(hit_order).alias("_first"),
        *[F.min_by(F.col(c), hit_order).alias(c) for c in payload],
    )
    later_blocks = Window.partitionBy(key).orderBy(F.col("_block").desc())
    later_blocks = later_blocks.rowsBetween(Window.unboundedPreceding, -1)
    first_payload = F.when(F.col("_first").isNotNull(), F.struct(*payload))
    carried = summaries.select(
        key, "_block", F.last(first_payload, ignorenulls=True).over(later_blocks).alias("_carried")
    )
    found = F.when(valid, F.coalesce("_inside", "_carried"))
    return inside.join(carried, [key, "_block"], "left").select(*df.columns, found.alias(name))


def latest_match(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    order: str,
    payload: Mapping[str, str],
    probe: DataFrame | None = None,
) -> DataFrame:
    """Left join to the newest right row per key; ``payload`` maps right columns to output names.

    The right side shrinks to one row per key before the join. ``probe`` is a cheaper frame with ``left_key``
    to look for hot keys in.
    """
    narrow = right.filter(F.col(right_key).isNotNull()).select(right_key, order, *payload)
    newest = keep_one(narrow, [right_key], [F.col(order).desc_nulls_last()])
    renamed = newest.select(
        F.col(right_key).alias("_key"), *[F.col(c).alias(as_name) for c, as_name in payload.items()]
    )
    keyed = left.withColumn("_key", F.col(left_key))
    keys = None if probe is None else probe.select(F.col(left_key).alias("_key"))
    return skew_join(keyed, renamed, "_key", probe=keys).drop("_key")


def existence_flags(child: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """One row per key with a flag per predicate: does any child row satisfy it?"""
    return child.groupBy(key).agg(*[F.bool_or(F.coalesce(p, F.lit(False))).alias(n) for n, p in flags.items()])


def null_safe_condition(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return all_of([left[k].eqNullSafe(right[k]) for k in keys])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on the keys with NULL equal to NULL; the keys come from the left side.

    The right side must be unique on the keys. Catalyst plans it as an ordinary hash or sort join.
    """
    right_keys = {k: f"_r_{k}" for k in keys}
    renamed = right.withColumnsRenamed(right_keys)
    condition = all_of([F.col(k).eqNullSafe(F.col(rk)) for k, rk in right_keys.items()])
    return left.join(renamed, condition, how).drop(*right_keys.values())


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> tuple[list, bool]:
    """Keys that hold more than ``share`` of the rows, and whether NULL does.

    The default share is that of one shuffle partition, but no less than a ten-thousandth; at most
    ``1 / share`` keys can exceed it. A mergeable heavy-hitter sketch in one pass without a shuffle of
    rows: it only steers how rows are spread, so its approximation cannot change a result.
    """
    share = max(1.0 / shuffle_width(df.sparkSession), 0.0001) if share is None else share
    most = int(1 / share) + 1
    tracked = max(100, 4 * most)
    sketches = _by_sketch_group(df, F.col(key)).agg(
        F.expr(f"approx_top_k_accumulate(v, {tracked})").alias("s"), F.count("*").alias("n")
    )
    merged = sketches.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"), F.sum("n").alias("n")
    )
    row = merged.select("n", F.expr(f"approx_top_k_estimate(s, {most})").alias("top")).first()
    found = [item["item"] for item in row["top"] if item["count"] > share * row["n"]] if row else []
    return [k for k in found if k is not None], None in found


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    probe: DataFrame | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join on one key column where the left side may be dominated by a few keys.

    A right side under the broadcast limit needs no shuffle, and Catalyst broadcasts it. Beyond that
    the left side is asked for hot keys. If there are any, their rows are spread over as many salts
    as there are shuffle partitions, by a hash of the whole row, and only those keys' right rows are
    repeated per salt; left rows with a NULL key match nothing and are spread the same way. Without
    hot keys it is a plain join. Copies of one whole row share a salt; those are left to AQE, which
    splits a partition regardless of its keys.

    ``probe`` is a cheaper frame with the same key column to look for hot keys in, such as the table
    the key comes from. ``salts`` forces the salted form.
    """
    if how not in ("left", "inner"):
        raise ValueError("the salted side must be the left one: how is 'left' or 'inner'")
    spark = left.sparkSession
    if salts is None and estimated_bytes(right) <= broadcast_limit(spark):
        return left.join(right, key, how)
    hot, null_is_hot = hot_keys(left if probe is None else probe, key)
    if salts is None and not hot and not null_is_hot:
        return left.join(right, key, how)
    salts = shuffle_width(spark) if salts is None else salts
    is_hot = F.col(key).isin(*hot) if hot else F.lit(False)
    row_hash = F.xxhash64(*[f.name for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    spread = F.pmod(row_hash, F.lit(salts)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), spread).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def key_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: distinct keys on the left, on the right and on both sides."""
    sides = left.select(F.col(left_key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.col(right_key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    keys = sides.filter("k is not null").groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return keys.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_keys"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_keys"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("common_keys"),
    )


def overlap_samples(left: DataFrame, right: DataFrame, left_key: str, right_key: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct keys of each side, for a report on keys that do not meet."""
    sides = [
        df.select(F.lit(side).alias("side"), F.col(k).cast("string").alias("key")).filter("key is not null")
        for side, df, k in (("left", left, left_key), ("right", right, right_key))
    ]
    firsts = [s.distinct().orderBy("key").limit(n) for s in sides]
    return firsts[0].unionAll(firsts[1])


def new_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key the target lacks. A NULL key is new unless ``null_safe``.

    The target's keys become distinct first, on the map side too, so a hot key of it is one row.
    """
    narrow = target.select(*keys).distinct()
    if null_safe:
        return source.join(narrow, null_safe_condition(source, narrow, keys), "left_anti")
    return source.join(narrow, list(keys), "left_anti")
