"""A keyed Parquet table whose loads touch only what they change and become visible all at once.

``<path>/rows/commit=<id>/bucket=<n>`` are segments: the rows one load wrote for one hash bucket of the key. Segments are
never changed. ``<path>/manifests/<id>`` lists the segments a version consists of, with the row count and the least and
greatest keys of each, and ``<path>/log`` names the manifest and the schema of every version, one numbered entry each. A
load writes its segments and its manifest first; the entry in the log makes them the table. A run that breaks off before
that changes nothing for any reader and is repeated; two loads at a time cannot both take a number, the later one fails.

A load reads the segments whose bucket and key range its source reaches. Buckets that only get new rows get one more
segment; buckets with changed rows, or with ``MOST_SEGMENTS`` segments, are written anew as one. With ``fingerprint``
columns a narrow file per segment holds keys and a hash of those columns, and an exact load reads wide rows only of buckets
where hashes differ.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.rules import all_of, any_of
from keyloom.functions.schema import shared_columns
from keyloom.functions.text import collation_key
from keyloom.operators.dedupe import require_unique
from keyloom.operators.keyed_load import (
    ROW_ORDER,
    LoadRule,
    apply_changes,
    change_set,
    compared_columns,
    insert_only,
    load_measures,
    usable_source,
)
from keyloom.session import materialize
from keyloom.sources.commits import CommitLog

BUCKET = "bucket"
COMMIT = "commit"
MOST_SEGMENTS = 16


@dataclass(frozen=True)
class LoadResult:
    """What a load did; ``segments_read`` of ``segments_total`` segments were asked for keys.

    ``per_bucket`` has (bucket, inserted, updated) of the buckets it wrote.
    """

    inserted: int
    updated: int
    rows_total: int
    changes: DataFrame
    version: int = 0
    segments_read: int = 0
    segments_total: int = 0
    per_bucket: tuple[tuple[int, int, int], ...] = ()


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    manifest: str | None


def text_schema(df: DataFrame, key: str) -> T.StructType:
    """All columns nullable text, the key not null; the helper ordinal is left out."""
    return T.StructType(
        [T.StructField(c, T.StringType(), nullable=c != key) for c in df.columns if c != ROW_ORDER]
    )


def usable_key(key: str, digits_only: bool = False) -> Column:
    """Not NULL, not blank and, if asked, digits only."""
    text = F.trim(F.col(key).cast("string"))
    test = text.isNotNull() & (text != "")
    return test & F.col(key).cast("string").rlike(r"^[0-9]+\z") if digits_only else test


def row_print(columns: Sequence[Column], names: Sequence[str]) -> Column:
    """A strong hash of a row's values: rows with equal prints are taken for equal."""
    json_text = F.to_json(F.struct(*[c.alias(n) for c, n in zip(columns, names, strict=True)]), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(json_text.cast("binary"), 256))


class KeyedTable:
    """``keys`` set the buckets; ``text_keys`` hashes their trimmed text, for loads that trim keys, and ``caseless`` their
    trimmed lower-case text, for loads that disregard case.

    ``ranged`` columns have their least and greatest value kept per segment (the keys, if not given). ``fingerprint``
    names the columns an exact load compares, all of them and no others, if hashes are to be kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        buckets: int = 64,
        text_keys: bool = False,
        ranged: Sequence[str] | None = None,
        fingerprint: Sequence[str] = (),
        caseless: bool = False,
    ):
        self.spark, self.keys, self.buckets, self.text_keys, self.caseless = spark, list(keys), buckets, text_keys, caseless
        self.ranged, self.fingerprint = list(keys if ranged is None else ranged), list(fingerprint)
        self.path = path.rstrip("/")
        self.rows_path, self.prints_path = f"{self.path}/rows", f"{self.path}/prints"
        self.log = CommitLog(spark, f"{self.path}/log")

    # Versions ------------------------------------------------------------------------

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or the one of that number; None if there is none."""
        if number is None:
            found = self.log.newest()
            if found is None:
                return None
            number, entry = found
        else:
            entry = self.log.read(number)
        return Version(number, T.StructType.fromJson(entry["schema"]), entry["manifest"])

    def schema(self) -> T.StructType | None:
        version = self.version()
        return version and version.schema

    def exists(self) -> bool:
        return self.version() is not None

    def segments(self, version: Version | None = None) -> DataFrame:
        """One row per segment: bucket, commit, rows, files, lo, hi, nulls."""
        version = version or self.version()
        if version.manifest is None:
            return self.spark.createDataFrame([], self._segment_schema(version.schema))
        return self.spark.read.schema(self._segment_schema(version.schema)).parquet(f"{self.path}/manifests/{version.manifest}")

    def _range_columns(self, schema: T.StructType) -> list[T.StructField]:
        wanted = {c.lower() for c in self.ranged}
        text = {k.lower() for k in self.keys} if self.text_keys or self.caseless else set()
        return [T.StructField(f.name, T.StringType() if f.name.lower() in text else f.dataType) for f in schema if f.name.lower() in wanted]

    def _segment_schema(self, schema: T.StructType) -> T.StructType:
        values = self._range_columns(schema)
        nulls = [T.StructField(f.name, T.BooleanType()) for f in values]
        head = "bucket int, commit string, rows long, files long"
        parts = [T.StructField(n, T.StructType(v)) for n, v in (("lo", values), ("hi", values), ("nulls", nulls))]
        return T.StructType([*T._parse_datatype_string(head).fields, *(parts if values else [])])

    def _ranges(self, df: DataFrame, fields: Sequence[T.StructField], names: dict[str, str] | None = None) -> list[Column]:
        """Aggregates: least and greatest value per ranged column, and whether NULL occurs."""
        if not fields:
            return []
        values = {f.name: self._key_value((names or {}).get(f.name, f.name), f) for f in fields}
        lo, hi = ([agg(v).alias(n) for n, v in values.items()] for agg in (F.min, F.max))
        nulls = [F.bool_or(v.isNull()).alias(n) for n, v in values.items()]
        return [F.struct(*lo).alias("lo"), F.struct(*hi).alias("hi"), F.struct(*nulls).alias("nulls")]

    def _key_value(self, column: str, field: T.StructField) -> Column:
        is_key = field.name.lower() in {k.lower() for k in self.keys}
        return self._plain(column, field.dataType) if is_key else F.col(column).cast(field.dataType)

    def _plain(self, key: str, data_type: T.DataType) -> Column:
        """A key as buckets and ranges see it: equal for keys that a load takes for equal."""
        if self.caseless:
            return collation_key(F.trim(F.col(key).cast("string")))
        return F.trim(F.col(key).cast("string")) if self.text_keys else F.col(key).cast(data_type)

    def _commit(self, base: Version, segments: DataFrame | None) -> int:
        """Make ``segments``, with the schema of ``base``, the table, if nobody has committed since."""
        manifest, schema = base.manifest, base.schema
        if segments is not None:
            manifest = uuid.uuid4().hex
            columns = self._segment_schema(schema).fieldNames()
            segments.select(*columns).coalesce(1).write.parquet(f"{self.path}/manifests/{manifest}")  # one row per segment
        self.log.put(base.number + 1, {"schema": schema.jsonValue(), "manifest": manifest})
        return base.number + 1

    def _stored(self, version: Version, segments: DataFrame, path: str | None = None) -> DataFrame:
        """The rows of segments, whose folders are listed on the driver: two short texts per segment."""
        schema = T.StructType([*version.schema.fields, T.StructField(COMMIT, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        if path == self.prints_path:
            keys = [f for f in version.schema if f.name.lower() in {k.lower() for k in self.keys}]
            schema = T.StructType([*keys, T.StructField("_print", T.BinaryType()), *schema.fields[-2:]])
        path = path or self.rows_path
        folders = [f"{path}/{COMMIT}={r[0]}/{BUCKET}={r[1]}" for r in segments.select(COMMIT, BUCKET).collect()]
        if not folders:
            return self.spark.createDataFrame([], schema).drop(COMMIT)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(COMMIT)

    def read(self, number: int | None = None) -> DataFrame:
        """The table as it is now, or as it was at a version."""
        version = self.version(number)
        return self._stored(version, self.segments(version)).drop(BUCKET)

    # Writing -------------------------------------------------------------------------

    def _bucket_of(self, df: DataFrame, keys: list[str], schema: T.StructType | None = None) -> DataFrame:
        # Keys hash in the table's types; NULL keys of an insert-only table hash like any other value.
        types = {f.name.lower(): f.dataType for f in schema or self.schema() or df.schema}
        parts = [self._plain(k, types[own.lower()]) for k, own in zip(keys, self.keys, strict=True)]
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*parts), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """New segments of the bucketed rows ``df``, which are no part of any version yet; their manifest rows."""
        commit = uuid.uuid4().hex
        folder = f"{self.rows_path}/{COMMIT}={commit}"
        # Rebalancing by bucket gives a few full files per bucket; AQE splits a large bucket.
        df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        if self.fingerprint:
            prints = row_print([F.col(c) for c in self.fingerprint], self.fingerprint)
            narrow = stored.select(*self.keys, prints.alias("_print"), BUCKET)
            narrow.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.prints_path}/{COMMIT}={commit}")
        fields = self._range_columns(schema)
        per_file = stored.groupBy(BUCKET, F.col("_metadata.file_name").alias("file"))
        per_file = per_file.agg(F.count("*").alias("rows"), *self._ranges(stored, fields))
        merged = [F.sum("rows").alias("rows"), F.count("*").alias("files")]
        for name, agg in (("lo", F.min), ("hi", F.max), ("nulls", F.bool_or)):
            if fields:
                merged.append(F.struct(*[agg(F.col(name)[f.name]).alias(f.name) for f in fields]).alias(name))
        return per_file.groupBy(BUCKET).agg(*merged).withColumn(COMMIT, F.lit(commit))

    def _widened(self, schema: T.StructType) -> tuple[Version, bool]:
        """The newest version with the columns of ``schema`` it lacks, and whether that is more than what is committed."""
        base = self.version() or Version(-1, T.StructType([]), None)
        known = {f.name.lower() for f in base.schema}
        extra = [T.StructField(f.name, f.dataType) for f in schema if f.name.lower() not in known]
        if base.number < 0:
            return Version(-1, schema, None), True
        return (Version(base.number, T.StructType([*base.schema.fields, *extra]), base.manifest), True) if extra else (base, False)

    def ensure(self, schema: T.StructType) -> None:
        """Create the table, empty, if it is absent; otherwise add the columns it lacks."""
        base, new = self._widened(schema)
        if new:
            self._commit(base, None)

    def fill(self, df: DataFrame) -> None:
        """First fill of a new table."""
        if self.exists():
            raise ValueError(f"{self.path} has been filled")
        self._commit(Version(-1, df.schema, None), self._write(self._bucket_of(df, self.keys, df.schema), df.schema))

    def purge_bad_keys(self, digits_only: bool = False) -> None:
        """Remove rows whose key is NULL, blank or, if asked, not a number; rewrites their buckets only."""
        base = self.version()
        bad = ~F.coalesce(usable_key(self.keys[0], digits_only), F.lit(False))
        segments = self.segments(base)
        hit = self._buckets_in(self._stored(base, segments).filter(bad))
        if hit:
            kept = self._stored(base, segments.filter(F.col(BUCKET).isin(hit))).filter(~bad)
            fresh = self._write(kept, base.schema)
            self._commit(base, segments.filter(~F.col(BUCKET).isin(hit)).unionByName(fresh))

    def compact(self, files: int = 2) -> int:
        """Write buckets of ``files`` or more files anew, each as one segment; the number of buckets written."""
        base = self.version()
        segments = self.segments(base)
        many = [r[0] for r in segments.groupBy(BUCKET).agg(F.sum("files").alias("n")).filter(F.col("n") >= files).collect()]
        if many:
            fresh = self._write(self._stored(base, segments.filter(F.col(BUCKET).isin(many))), base.schema)
            self._commit(base, segments.filter(~F.col(BUCKET).isin(many)).unionByName(fresh))
        return len(many)

    def expire(self, keep: int = 2) -> int:
        """Delete folders that none of the last ``keep`` versions names; not while a load runs. The number of folders."""
        versions = [self.version(n) for n in self.log.numbers()[-keep:]]
        manifests = {v.manifest for v in versions if v.manifest}
        named = {r[0] for v in versions for r in self.segments(v).select(COMMIT).distinct().collect()}
        old = [f"{self.path}/manifests/{m}" for m in self.log.folders(f"{self.path}/manifests") if m not in manifests]
        for path in (self.rows_path, self.prints_path):
            old += [f"{path}/{name}" for name in self.log.folders(path) if name.removeprefix(f"{COMMIT}=") not in named]
        for folder in old:
            self.log.remove(folder)
        return len(old)

    def _buckets_in(self, df: DataFrame) -> list[int]:
        """At most ``buckets`` small numbers."""
        return [r[0] for r in df.select(BUCKET).distinct().collect()]

    # Loads ---------------------------------------------------------------------------

    def reached(self, segments: DataFrame, arriving: DataFrame, fields: Sequence[T.StructField], null_safe: bool) -> DataFrame:
        """Segments that may hold a key of the source, by bucket and by key range; ``arriving`` has one row per bucket."""
        mine = arriving.select(F.col(BUCKET).alias("_bucket"), *[F.col(c).alias(f"_{c}") for c in ("lo", "hi", "nulls") if fields])
        tests = [F.col(BUCKET) == F.col("_bucket")]
        for f in fields:
            own, theirs = (lambda c, n=f.name: F.col(c)[n]), (lambda c, n=f.name: F.col(f"_{c}")[n])
            meet = (own("lo") <= theirs("hi")) & (theirs("lo") <= own("hi"))
            tests.append(F.coalesce(meet, F.lit(False)) | (F.lit(null_safe) & own("nulls") & theirs("nulls")))
        return segments.join(mine, all_of(tests), "left_semi")

    def _staged(self, source: DataFrame, version: Version, s_keys: list[str], matched: list[Column], keys: Sequence[str], names: dict[str, str]):
        """The source written with its buckets, and per bucket its rows, how often a key is there at most, and key ranges."""
        staged = materialize(self._bucket_of(source, s_keys, version.schema), "source")
        fields = [f for f in self._range_columns(version.schema) if f.name.lower() in {k.lower() for k in keys}]
        per_key = staged.groupBy(BUCKET, *matched).agg(F.count("*").alias("n"), *self._ranges(staged, fields, names))
        merged = [F.sum("n").alias("rows"), F.max("n").alias("most")]
        for name, agg in (("lo", F.min), ("hi", F.max), ("nulls", F.bool_or)):
            if fields:
                merged.append(F.struct(*[agg(F.col(name)[f.name]).alias(f.name) for f in fields]).alias(name))
        return staged, materialize(per_key.groupBy(BUCKET).agg(*merged), "arriving"), fields

    def load(self, source: DataFrame, rule: LoadRule) -> LoadResult:
        """Upsert ``source``; columns the table lacks are added, as text for a guarded load."""
        if [k.lower() for k in rule.keys] != [k.lower() for k in self.keys]:
            raise ValueError(f"the table is bucketed by {self.keys}, not by {list(rule.keys)}")
        if rule.trim_key and not (self.text_keys or self.caseless):
            raise ValueError("a load with trimmed keys needs a table with text_keys=True")
        if rule.caseless and not self.caseless:
            raise ValueError("a load that disregards case needs a table with caseless=True")
        fields = text_schema(source, rule.keys[0]) if rule.compare == "guarded" else source.schema
        base, new = self._widened(T.StructType([f for f in fields if f.name not in rule.ignore]))
        empty = self.spark.createDataFrame([], base.schema)
        source_of = shared_columns(source, empty)
        s_keys = [source_of[k] for k in rule.keys]
        usable = usable_source(source, LoadRule(tuple(s_keys), trim_key=rule.trim_key))
        # Keys repeat if the join takes them for equal.
        matched = [rule.matched(k) for k in s_keys]
        staged, arriving, ranged = self._staged(usable, base, s_keys, matched, rule.keys, source_of)
        totals = arriving.agg(F.sum("rows"), F.max("most")).first()
        if (totals[1] or 0) > 1:
            require_unique(staged, s_keys, rule.trim_key, rule.caseless)
        segments = self.segments(base)
        near = materialize(self.reached(segments, arriving, ranged, null_safe=False), "reached")
        if self.fingerprint and rule.compare == "exact" and set(compared_columns(empty, source, rule)) == set(self.fingerprint):
            staged = materialize(self.differing(staged, base, near, source_of, s_keys), "differing")
            near = near.filter(F.col(BUCKET).isin(self._buckets_in(staged)))
        changed = change_set(self._stored(base, near).drop(BUCKET), staged.drop(BUCKET), rule, checked=True)
        delta = materialize(self._bucket_of(changed, self.keys, base.schema), "changes")
        per_bucket = delta.groupBy(BUCKET).agg(*load_measures(rule), F.bool_or(F.col("_op") == "UPDATE").alias("rewrite"))
        written = {r[BUCKET]: r for r in per_bucket.collect()}  # one small row per bucket
        delta, number = delta.drop(BUCKET), base.number
        if new and not written:
            number = self._commit(base, None)
        if written:
            counts = segments.filter(F.col(BUCKET).isin(list(written))).groupBy(BUCKET).count()
            full = {r[BUCKET] for r in counts.filter(F.col("count") >= MOST_SEGMENTS).collect()}
            anew = [b for b, r in written.items() if r["rewrite"] or b in full]
            before = self._stored(base, segments.filter(F.col(BUCKET).isin(anew))).drop(BUCKET)
            merged = apply_changes(before, delta, rule)
            fresh = self._write(self._bucket_of(merged, self.keys, base.schema), base.schema)
            number = self._commit(base, segments.filter(~F.col(BUCKET).isin(anew)).unionByName(fresh))
        return LoadResult(
            sum(b["inserted"] for b in written.values()),
            sum(b["updated"] for b in written.values()),
            totals[0] or 0,
            delta,
            number,
            near.count(),
            segments.count(),
            tuple(sorted((b, r["inserted"], r["updated"]) for b, r in written.items())),
        )

    def differing(self, staged: DataFrame, base: Version, near: DataFrame, source_of: dict[str, str], s_keys: list[str]) -> DataFrame:
        """Source rows whose key is new or whose stored print differs: reads keys and prints of the target, nothing else."""
        types = {f.name: f.dataType for f in base.schema}
        own = row_print([F.col(source_of[c]).cast(types[c]) for c in self.fingerprint], self.fingerprint)
        prints = self._stored(base, near, self.prints_path).drop(BUCKET)
        prints = prints.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.col("_print").alias("_stored"))
        no_key = any_of([F.col(k).isNull() for k in s_keys])  # matches nothing
        on = all_of([F.col(k) == F.col(f"_k{i}") for i, k in enumerate(s_keys)])
        joined = staged.withColumn("_own", own).join(prints, on, "left")
        return joined.filter(no_key | F.col("_stored").isNull() | (F.col("_stored") != F.col("_own"))).select(*staged.columns)

    def append_new(self, source: DataFrame, keys: list[str] | None = None) -> LoadResult:
        """Insert-only load: append source rows whose key the table lacks.

        The table's bucket columns must be part of the key, so that equal keys share a bucket.
        """
        keys = list(source.columns if keys is None else keys)
        if not {k.lower() for k in self.keys} <= {k.lower() for k in keys}:
            raise ValueError(f"the table is bucketed by {self.keys}, which {keys} does not include")
        base, new = self._widened(source.schema)
        names = {f.name: c for f in base.schema for c in source.columns if c.lower() == f.name.lower()}
        staged, arriving, ranged = self._staged(source, base, self.keys, [F.col(k) for k in keys], keys, names)
        segments = self.segments(base)
        near = materialize(self.reached(segments, arriving, ranged, null_safe=True), "reached")
        fresh = materialize(insert_only(self._stored(base, near).drop(BUCKET), staged.drop(BUCKET), keys), "new-rows")
        inserted, number = fresh.count(), base.number
        if new and not inserted:
            number = self._commit(base, None)
        if inserted:
            added = self._write(self._bucket_of(fresh, self.keys, base.schema), base.schema)
            number = self._commit(base, segments.unionByName(added))
        total = arriving.agg(F.sum("rows")).first()[0] or 0
        return LoadResult(inserted, 0, total, fresh, number, near.count(), segments.count())
