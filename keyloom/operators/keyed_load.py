"""Keyed loads: guarded, overwrite and exact upserts, insert-only loads, and what they changed.

All loads read two tables, ``target`` and ``source``, and give back DataFrames; writing is left to
``keyloom.sources``. Both sides must be unique on the key: an outer join would otherwise repeat rows
silently. A load whose source repeats a key raises when it runs, in the shuffle that the join needs anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.rules import any_of
from keyloom.functions.schema import shared_columns
from keyloom.functions.text import clean_value, collated, norm
from keyloom.operators.dedupe import keep_one
from keyloom.operators.matching import new_keys

# A pipeline's helper column that is never compared or written, and the values that
# count as equal to NULL in an overwrite load.
ROW_ORDER = "_row_order"
NULL_TEXT = ""
NULL_NUMBER = 0
NULL_DATE = "1900-01-01"


@dataclass(frozen=True)
class LoadRule:
    """How source rows update target rows.

    compare   "guarded": cleaned, case-insensitive, a blank source never counts as a difference;
              "sentinel": NULL equals 0, '' and 1900-01-01; "exact": only identical values are equal.
    assign    "nonblank": per column, only if the source is not blank and differs; "all": every column.
    trim_key  match on the trimmed text of the key, and skip NULL or blank source keys.
    caseless  keys that differ in case or trailing blanks only are one key.
    ignore    columns neither compared nor written.
    stamp     columns written with a changed row but not compared.
    audit     columns reported in the change map; None for all compared ones.
    audit_empty_counts  count an updated row even if its change map is empty.
    """

    keys: tuple[str, ...]
    compare: str = "exact"
    assign: str = "all"
    trim_key: bool = False
    ignore: tuple[str, ...] = ()
    stamp: tuple[str, ...] = ()
    audit: tuple[str, ...] | None = None
    audit_empty_counts: bool = True
    caseless: bool = False

    def matched(self, key: str) -> Column:
        """What keys are compared by."""
        value = F.trim(F.col(key).cast("string")) if self.trim_key else F.col(key)
        return collated(value) if self.caseless else value


def guarded(key: str, ignore: Sequence[str] = (), caseless: bool = False) -> LoadRule:
    return LoadRule(
        (key,),
        "guarded",
        "nonblank",
        trim_key=True,
        ignore=(*ignore, ROW_ORDER),
        audit_empty_counts=False,
        caseless=caseless,
    )


def overwrite(key: str, audit: Sequence[str] | None = None) -> LoadRule:
    return LoadRule((key,), "sentinel", "all", ignore=(ROW_ORDER,), audit=None if audit is None else tuple(audit))


def exact(*keys: str, stamp: Sequence[str] = ("ingestion_date",)) -> LoadRule:
    return LoadRule(tuple(keys), "exact", "all", stamp=tuple(stamp), audit=())


def _sentinel(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.coalesce(c, F.lit(NULL_TEXT))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(c, F.lit(NULL_NUMBER).cast(data_type))
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(c, F.lit(NULL_DATE).cast(data_type))
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    raise TypeError(f"no NULL equivalent for {data_type.simpleString()}")


class _Columns:
    """Column expressions over one joined row: ``_t`` holds the target's columns, ``_s`` the source's.

    Each side crosses the join as one struct and the columns of a guarded load are compared as two
    arrays, so that the plan of a wide table stays as small as that of a narrow one.
    """

    def __init__(self, target: DataFrame, source: DataFrame, rule: LoadRule):
        self.rule = rule
        self.schema = target.schema
        self.names = target.columns
        source_of = shared_columns(source, target)
        missing = [k for k in rule.keys if k not in source_of]
        if missing:
            raise ValueError(f"key columns not found in both tables: {missing}")
        self.source_of = source_of
        skipped = {c.lower() for c in (*rule.keys, *rule.ignore)}
        stamped = {c.lower() for c in rule.stamp}
        self.stamped = [c for c in source_of if c.lower() in stamped - skipped]
        self.compared = [c for c in source_of if c.lower() not in skipped | stamped]
        self.per_column = rule.assign == "nonblank"

    def source_struct(self) -> Column:
        """The source columns a load may write, under target names and types; text ones cleaned if guarded."""
        written = [*self.rule.keys, *self.compared, *self.stamped]

        def value(c: str) -> Column:
            raw = F.col(self.source_of[c])
            if c in self.compared and self.per_column:
                return clean_value(raw)
            return raw.cast(self.schema[c].dataType)

        return F.struct(*[value(c).alias(c) for c in written])

    def _s(self, c: str) -> Column:
        return F.col("_s").getField(c)

    def _t(self, c: str) -> Column:
        return F.col("_t").getField(c)

    def with_op(self, paired: DataFrame) -> DataFrame:
        """Add ``_op`` (INSERT, UPDATE or KEEP) and, for a guarded load, ``_old`` and ``_new`` as text."""
        inserted, kept = F.col("_t").isNull(), F.col("_s").isNull()
        if self.per_column:
            old = F.array(*[self._t(c).cast("string") for c in self.compared]).cast("array<string>")
            given = F.array(*[self._s(c) for c in self.compared]).cast("array<string>")
            merged = F.zip_with(
                "_old", "_given", lambda t, s: F.when(s.isNull() | (F.lower(s) == norm(t)), t).otherwise(s)
            )
            paired = paired.withColumns({"_old": old, "_given": given})
            paired = paired.withColumn("_new", F.when(inserted, F.col("_given")).when(kept, F.col("_old")).otherwise(merged))
            same = F.col("_new").eqNullSafe(F.col("_old"))
        elif self.rule.compare == "sentinel":
            same = self._sentinels(self._s) == self._sentinels(self._t)
        else:
            same = F.struct(*[self._s(c).alias(c) for c in self.compared]).eqNullSafe(
                F.struct(*[self._t(c).alias(c) for c in self.compared])
            )
        if not self.compared:
            same = F.lit(True)
        op = F.when(inserted, "INSERT").when(kept | same, "KEEP").otherwise("UPDATE")
        return paired.withColumn("_op", op)

    def _sentinels(self, side) -> Column:
        return F.struct(*[_sentinel(side(c), self.schema[c].dataType).alias(c) for c in self.compared])

    def row(self) -> Column:
        """The merged row as one struct: the target's where nothing is written."""
        fields = []
        for c in self.names:
            if c in self.rule.keys:
                value = F.coalesce(self._t(c), self._s(c))
            elif c in self.compared and self.per_column:
                value = F.col("_new")[self.compared.index(c)].cast(self.schema[c].dataType)
            elif c in self.compared or c in self.stamped:
                value = self._s(c)
            else:
                value = self._t(c)
            fields.append(value.alias(c))
        return F.when(F.col("_op") == "KEEP", F.col("_t")).otherwise(F.struct(*fields))

    def changes(self) -> Column:
        """Map column → {old, new} of an updated row; empty for inserts.

        Guarded loads report what differs after normalization, others what differs as text.
        """
        kind = "map<string,struct<old:string,new:string>>"
        empty = F.create_map().cast(kind)
        shown = self.compared if self.rule.audit is None else [c for c in self.compared if c in self.rule.audit]
        if not shown:
            return empty
        if self.per_column:
            pairs = F.zip_with("_old", "_new", lambda t, n: F.struct(t.alias("old"), n.alias("new")))
            names = F.array(*[F.lit(c) for c in self.compared])
            differing = F.map_filter(
                F.map_from_arrays(names, pairs),
                lambda c, v: c.isin(*shown) & (norm(v["old"]) != norm(v["new"])),
            )
        else:
            entries = []
            for c in shown:
                old, new = (side(c).cast("string") for side in (self._t, self._s))
                entries += [F.lit(c), F.struct(old.alias("old"), new.alias("new"))]
            differing = F.map_filter(F.create_map(*entries), lambda _, v: ~v["old"].eqNullSafe(v["new"]))
        return F.when(F.col("_op") == "UPDATE", differing.cast(kind)).otherwise(empty)


def compared_columns(target: DataFrame, source: DataFrame, rule: LoadRule) -> list[str]:
    """The target columns a load compares."""
    return _Columns(target, source, rule).compared


def usable_source(source: DataFrame, rule: LoadRule) -> DataFrame:
    """Source rows a trimmed-key load looks at: those with a key that is not blank."""
    if not rule.trim_key:
        return source
    return source.filter(" AND ".join(f"trim(cast(`{k}` as string)) <> ''" for k in rule.keys))


def _raising_repeats(side: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of one side of a load; running it raises if two of them have one key. Rows with a NULL key match nothing and may repeat."""
    seen = F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(1)))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in on[:-1]])
    has_key = ~any_of([F.col(k).isNull() for k in on[:-1]])
    once = F.when(has_key & (F.col("_seen") > 1), F.raise_error(F.concat(F.lit("the source repeats the key "), shown))).otherwise(F.lit(True))
    return side.withColumn("_seen", seen).filter(once).drop("_seen")


def _pair_up(target: DataFrame, source: DataFrame, rule: LoadRule, how: str, checked: bool) -> tuple[DataFrame, _Columns]:
    columns = _Columns(target, source, rule)
    s_keys = [columns.source_of[k] for k in rule.keys]
    source = usable_source(source, replace(rule, keys=tuple(s_keys)))

    def side(df: DataFrame, keys: Sequence[str], name: str, row: Column) -> DataFrame:
        # Rows with a NULL key match nothing; the hash of their columns spreads them over the partitions.
        no_key = any_of([F.col(k).isNull() for k in keys])
        spread = F.when(no_key, F.xxhash64(*df.columns)).otherwise(F.lit(0))
        join_keys = [rule.matched(k) for k in keys]
        return df.select(*[k.alias(f"_k{i}") for i, k in enumerate(join_keys)], spread.alias("_spread"), row.alias(name))

    on = [*(f"_k{i}" for i in range(len(rule.keys))), "_spread"]
    t_side = side(target, rule.keys, "_t", F.struct(*[F.col(c) for c in target.columns]))
    s_side = side(source, s_keys, "_s", columns.source_struct())
    s_side = s_side if checked else _raising_repeats(s_side, on)
    paired = t_side.join(s_side, on, how) if how == "full" else s_side.join(t_side, on, how)
    return columns.with_op(paired), columns


def upsert(target: DataFrame, source: DataFrame, rule: LoadRule, checked: bool = False) -> DataFrame:
    """The whole merged table: target rows updated, kept, and source rows inserted. One outer join.

    ``checked`` says that the source is known to have each key once, as the rule matches keys.
    """
    paired, columns = _pair_up(target, source, rule, "full", checked)
    return paired.select(columns.row().alias("_row")).select("_row.*")


def change_set(target: DataFrame, source: DataFrame, rule: LoadRule, checked: bool = False) -> DataFrame:
    """Only the rows the load writes: ``_op`` (INSERT or UPDATE), the new row, and ``changes``.

    A left join from the source, so the target side may be pruned to the source's key range. ``checked`` as in ``upsert``.
    """
    paired, columns = _pair_up(target, source, rule, "left", checked)
    touched = paired.filter("_op <> 'KEEP'")
    return touched.select("_op", columns.row().alias("_row"), columns.changes().alias("changes")).select(
        "_op", "_row.*", "changes"
    )


def apply_changes(target: DataFrame, delta: DataFrame, rule: LoadRule) -> DataFrame:
    """The merged table from the target and a change set taken against it."""
    written = delta.select(*target.columns)
    # An updated row keeps the target's key, so it is found by that very value.
    updated = delta.filter("_op = 'UPDATE'").select(*rule.keys)
    return target.join(updated, list(rule.keys), "left_anti").select(*target.columns).unionAll(written)


def load_measures(rule: LoadRule) -> list[Column]:
    """Aggregates over a change set: inserted and updated rows.

    A guarded load counts an update only if its change map has entries.
    """
    updated = (F.col("_op") == "UPDATE") & (F.lit(rule.audit_empty_counts) | (F.size("changes") > 0))
    return [F.count_if(F.col("_op") == "INSERT").alias("inserted"), F.count_if(updated).alias("updated")]


def load_counts(delta: DataFrame, rule: LoadRule) -> DataFrame:
    """One row: inserted and updated."""
    return delta.agg(*load_measures(rule))


def change_rows(delta: DataFrame, key: str) -> DataFrame:
    """One row per changed field of an updated row: key, field, old, new."""
    updated = delta.filter("_op = 'UPDATE'")
    entries = updated.select(F.col(key).cast("string").alias("key"), F.explode("changes").alias("field", "pair"))
    return entries.select("key", "field", F.col("pair.old").alias("old"), F.col("pair.new").alias("new"))


def update_samples(delta: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The change rows of the first ``n`` updated keys, for a report."""
    firsts = delta.filter((F.col("_op") == "UPDATE") & (F.size("changes") > 0)).orderBy(key).limit(n)
    return change_rows(firsts, key)


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str] | None = None, order: Sequence[Column] = ()
) -> DataFrame:
    """The source rows to append: one per key, and only keys the target lacks; NULL equals NULL.

    The key defaults to all columns. Of several source rows with one key the first in ``order`` is
    taken, with all remaining columns as tie-break.
    """
    keys = list(source.columns if keys is None else keys)
    missing = [k for k in keys if k not in source.columns]
    if missing:
        raise ValueError(f"key columns not found in the source: {missing}")
    return new_keys(keep_one(source, keys, order), target, keys, null_safe=True)
