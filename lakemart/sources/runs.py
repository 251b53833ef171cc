"""Published tables as numbered runs of plain parquet.

Stock Spark cannot update or overwrite a parquet table in place while reading
it, so each load writes a new run folder and then appends one row to the
table's run log. The log row is the publication: readers follow the last one,
and a load that fails before it leaves the previous state untouched. One writer
per table is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import all_of, row_digests
from lakemart.operators import compare, scd2
from lakemart.operators.keys import dense_keys
from lakemart.session import delete_path, materialize, scratch_scope
from lakemart.sources.tables import is_missing_path

LOG = (
    "run bigint, first_run bigint, load_ts string, batch_id bigint, last_key bigint, feed string, buckets bigint, "
    "places array<struct<part:string,bucket:int,at:bigint,n:bigint>>"
)


@dataclass(frozen=True)
class RunTable:
    """A table stored as runs: replace starts a new range of runs, append extends it."""

    spark: SparkSession
    root: str
    schema: T.StructType

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/log")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return self.spark.createDataFrame([], LOG)

    def last(self):
        """Newest log row, None before the first publication."""
        return self.log().drop("places").orderBy(F.desc("run")).first()

    def publish(
        self,
        run: int,
        first_run: int,
        load_ts: str,
        batch_id: int | None = None,
        last_key: int | None = None,
        feed: str | None = None,
        buckets: int | None = None,
        places: Mapping[tuple[str, int], tuple[int, int]] | None = None,
    ) -> None:
        listed = None if places is None else [(part, bucket, at, n) for (part, bucket), (at, n) in sorted(places.items())]
        row = [(run, first_run, load_ts, batch_id, last_key, feed, buckets, listed)]
        self.spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def part(self, name: str, partitions: str = "run bigint") -> DataFrame:
        """Every run of one part, with ``run`` as a partition column."""
        try:
            schema = T.StructType([*self.schema.fields, *T.StructType.fromDDL(partitions).fields])
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, part: str, run: int, *partition_by: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{part}/run={run}")

    def exists(self) -> bool:
        return self.last() is not None

    def read(self) -> DataFrame:
        last = self.last()
        if last is None:
            return self.spark.createDataFrame([], self.schema)
        rows = self.part("data").where(F.col("run").between(last["first_run"], last["run"]))
        return rows.select(*self.schema.names)

    def replace(self, df: DataFrame, load_ts: str) -> int:
        """Publish ``df`` as the whole table; it may read the table's present state."""
        last = self.last()
        run = (last["run"] if last else 0) + 1
        self.write(df.select(*self.schema.names), "data", run)
        self.publish(run, run, load_ts)
        return run

    def append(self, df: DataFrame, load_ts: str) -> int:
        last = self.last()
        run = (last["run"] if last else 0) + 1
        self.write(df.select(*self.schema.names), "data", run)
        self.publish(run, last["first_run"] if last else run, load_ts)
        return run

    def retire(self) -> int:
        """Delete the data of runs that a later ``replace`` has superseded; returns how many. No reader may be at work on them."""
        last = self.last()
        old = [r["run"] for r in self.log().where(F.col("run") < (last["first_run"] if last else 0)).collect()]
        for run in old:
            delete_path(self.spark, f"{self.root}/data/run={run}")
        return len(old)


_VERSIONS = "version bigint, first_run bigint, schema string, mapping map<string,string>, legacy string"


@dataclass(frozen=True)
class EvolvingTable(RunTable):
    """A run table whose schema changes without its data being written again.

    Each run is written in the schema of its time. ``migrate`` publishes a new
    schema with an expression per changed column over the one before; readers
    take every run through the expressions between its schema and theirs. The
    table as it was stays readable under the name given to it. ``schema`` is
    that of the first version.
    """

    def versions(self) -> list:
        """``(version, first run, schema, mapping from the one before, name of the one before)``, oldest first."""
        found = [(1, 1, self.schema.json(), {}, None)]
        try:
            rows = self.spark.read.schema(_VERSIONS).parquet(f"{self.root}/versions").orderBy("version").collect()
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            rows = []
        return [*found, *[tuple(r) for r in rows]]

    def schema_of(self, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.versions()[version - 1][2]))

    def migrate(self, changes: Mapping[str, str], drop: Collection[str] = (), legacy: str | None = None) -> int:
        """Publish the next schema: ``changes`` are new or changed columns as SQL over the present ones.

        The new version is one appended row: until it is there, readers and
        writers see the present one. Returns its number.
        """
        known = self.versions()
        now = T.StructType.fromJson(json.loads(known[-1][2]))
        if legacy is not None and legacy in {v[4] for v in known}:
            raise ValueError(f"{legacy} already names an older schema")
        mapping = {c: f"`{c}`" for c in now.names if c not in drop} | dict(changes)
        made = self.spark.createDataFrame([], now).selectExpr(*[f"{e} AS `{c}`" for c, e in mapping.items()]).schema
        last = self.last()
        row = [(known[-1][0] + 1, (last["run"] if last else 0) + 1, made.json(), mapping, legacy)]
        self.spark.createDataFrame(row, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.root}/versions")
        return row[0][0]

    def _in_version(self, version: int, last_run: int | None) -> DataFrame:
        known = self.versions()[:version]
        target = T.StructType.fromJson(json.loads(known[-1][2]))
        last = self.last()
        out = self.spark.createDataFrame([], target)
        if last is None:
            return out
        stop = last["run"] if last_run is None else min(last_run, last["run"])
        for i, (_, first, schema, _, _) in enumerate(known):
            until = min(stop, known[i + 1][1] - 1) if i + 1 < len(known) else stop
            since = max(first, last["first_run"] if last_run is None else 1)
            if since > until:
                continue
            written = T.StructType.fromJson(json.loads(schema))
            runs = [f"{self.root}/data/run={r}" for r in range(since, until + 1)]
            rows = self.spark.read.schema(written).parquet(*runs)
            for _, _, _, mapping, _ in known[i + 1 :]:
                rows = rows.selectExpr(*[f"{e} AS `{c}`" for c, e in mapping.items()])
            out = out.unionByName(rows)
        return out

    def read(self) -> DataFrame:
        """The whole table in the newest schema."""
        return self._in_version(len(self.versions()), None)

    def read_legacy(self, name: str) -> DataFrame:
        """The table as it was, rows and schema, when it was migrated under this name."""
        known = self.versions()
        at = next((i for i, v in enumerate(known) if v[4] == name), None)
        if at is None:
            raise ValueError(f"no older schema is named {name}")
        return self._in_version(at, known[at][1] - 1)

    def _publish_rows(self, df: DataFrame, load_ts: str, whole: bool) -> int:
        names = self.schema_of(len(self.versions())).names
        last = self.last()
        run = (last["run"] if last else 0) + 1
        self.write(df.select(*names), "data", run)
        self.publish(run, run if whole or not last else last["first_run"], load_ts)
        return run

    def replace(self, df: DataFrame, load_ts: str) -> int:
        return self._publish_rows(df, load_ts, True)

    def append(self, df: DataFrame, load_ts: str) -> int:
        return self._publish_rows(df, load_ts, False)


@dataclass(frozen=True)
class KeyMap(RunTable):
    """Durable keys: ``(business columns, pk)`` of every row that a rebuilt fact has ever had.

    A rebuild looks its rows up here instead of numbering them anew; unseen ones
    get the next numbers in order of their business columns and are appended.
    """

    pk: str = "pk"

    @classmethod
    def of(cls, spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str], pk: str) -> KeyMap:
        return cls(spark, root, T.StructType([*[rows.schema[k] for k in keys], T.StructField(pk, T.LongType())]), pk)

    def assign(self, rows: DataFrame, load_ts: str) -> DataFrame:
        """``rows`` with their durable ``pk``; rows that share all business columns (NULL is a value) share it."""
        keys = [c for c in self.schema.names if c != self.pk]
        known = self.read()
        on = lambda a, b: all_of(a[k].eqNullSafe(b[k]) for k in keys)
        seen = rows.select(*keys).distinct()
        fresh = seen.join(known, on(seen, known), "left_anti")
        last = self.last()
        with scratch_scope(self.spark):
            numbered = dense_keys(fresh, keys, self.pk, offset=(last["last_key"] or 0) if last else 0)
            run = (last["run"] if last else 0) + 1
            self.write(numbered.select(*self.schema.names), "data", run)
        n = self.part("data").where(F.col("run") == run).count()
        self.publish(run, 1, load_ts, last_key=(last["last_key"] if last else 0) + n)
        at = self.read().select(*[F.col(k).alias(f"_k_{k}") for k in keys], self.pk)
        met = all_of(F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys)
        columns = [c for c in rows.columns if c != self.pk]
        return rows.drop(self.pk).join(at, met, "left").select(self.pk, *[f"`{c}`" for c in columns])


# Digests of a row's compared columns, kept beside the current rows.
DIGESTS = ("_d1", "_d2")
#: Inserted rows, counted, up to which one task numbers them.
FEW_INSERTS = 50_000
#: Keys of a bucket when the number of buckets is fixed; with four times as many they are split.
BUCKET_KEYS = 200_000


@dataclass(frozen=True)
class DimensionTable(RunTable):
    """A type-2 dimension as runs over buckets of the natural key.

    ``rows/run=N/_kind=kept|closed|insert/_bucket=b`` holds what became of the
    current rows of a bucket, ``new/run=N/_bucket=b`` its inserted rows with
    their keys. A run writes only the buckets that its delta touches; its log
    row names for every bucket the run that holds it (``places``). Current =
    kept and new of those places; history = closed of all runs.

    The delta is found without reading wide rows: keys and two 64-bit digests of
    the stage meet those of the current rows. Only the rows of keys that differ
    there are read whole, and compared by value.

    The number of buckets is a power of two; when the table has outgrown it, the
    next load that touches a row writes all of them anew.
    """

    # ---- where things are --------------------------------------------------------

    def bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, nk: str, buckets: int) -> set[int]:
        if buckets == 1:
            return {0}
        return {r[0] for r in rows.select(self.bucket_of(F.col(nk), buckets)).distinct().collect()}

    def places(self, last) -> dict[tuple[str, int], tuple[int, int]]:
        """``(part, bucket)`` to the run that holds it and its rows: some entries per bucket."""
        if last is None:
            return {}
        found = self.log().where(F.col("run") == last["run"]).select("places").first()["places"]
        return {(r["part"], r["bucket"]): (r["at"], r["n"]) for r in found}

    def _listed(self) -> DataFrame:
        """``(run, part, bucket, at, n)`` of every published run."""
        return self.log().select("run", F.explode("places").alias("p")).select("run", "p.*")

    def _at(self, part: str, schema: T.StructType, places: dict, only: Collection[int] | None) -> DataFrame:
        """The rows of one part in the given buckets, from the newest run of each."""
        folder = {"kept": "rows", "new": "new", "state": "state"}[part]
        kind = "/_kind=kept" if part == "kept" else ""
        paths = [
            f"{self.root}/{folder}/run={at}{kind}/_bucket={bucket}"
            for (name, bucket), (at, n) in sorted(places.items())
            if name == part and n and (only is None or bucket in only)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    @property
    def _digested(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *[T.StructField(d, T.LongType()) for d in DIGESTS]])

    def _current(self, places: dict, only: Collection[int] | None = None) -> DataFrame:
        return self._at("kept", self._digested, places, only).unionByName(self._at("new", self._digested, places, only))

    def _closed(self, last, only: Collection[int] | None = None) -> DataFrame:
        if last is None:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, *T.StructType.fromDDL("run bigint, _bucket int").fields])
        try:
            rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows/run=*/_kind=closed")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return self.spark.createDataFrame([], self.schema)
        rows = rows.where(F.col("run") <= last["run"])
        if only is not None:
            # Before a split, a bucket's rows lay in the one with the same last digits.
            sizes = [1 << i for i in range((last["buckets"] or 1).bit_length())]
            rows = rows.where(F.col("_bucket").isin({b % m for b in only for m in sizes} | set(only)))
        return rows.select(*self.schema.names)

    def read(self) -> DataFrame:
        last = self.last()
        return self._closed(last).unionByName(self.current())

    def current(self) -> DataFrame:
        return self._current(self.places(self.last())).select(*self.schema.names)

    def history(self) -> DataFrame:
        return self._closed(self.last())

    def rejects(self, run: int) -> DataFrame:
        """The stage rows that a run did not apply, with their ``reason``."""
        try:
            return self.spark.read.parquet(f"{self.root}/rejects/run={run}")
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return self.spark.createDataFrame([], self.schema).withColumn("reason", F.lit("")).limit(0)

    def written(self, run: int) -> DataFrame:
        """``(part, bucket, at, n)`` of what one run wrote."""
        return self._listed().where((F.col("run") == run) & (F.col("at") == run)).drop("run")

    # ---- loading -------------------------------------------------------------------

    def applied(self, last, batch_id: int | None, feed: str | None) -> bool:
        """Whether a batch of a feed is already part of the table."""
        if last is None or batch_id is None:
            return False
        done = self.log().where(F.col("feed").eqNullSafe(F.lit(feed))).agg(F.max("batch_id")).first()[0]
        return done is not None and batch_id <= done

    def delta(
        self, stage: DataFrame, dim: scd2.Dimension, current: DataFrame, close_missing: bool = True, delete_flag: str | None = None
    ) -> DataFrame:
        """``(key, _why)`` of every key of the stage or the current rows that a load has to look at.

        ``_why``: touched, gone (missing from a full load), null_key,
        duplicate_key, failed_cast. Reads the key and the digests of ``current``.
        """
        d1, d2 = row_digests(stage, [*dim.business, *dim.carried])
        unfit = F.size("failed_casts") > 0 if "failed_casts" in stage.columns else F.lit(False)
        deletes = F.coalesce(F.col(delete_flag), F.lit(False)) if delete_flag else F.lit(False)
        # One narrow row per key: a hash aggregate whose partial side folds hot and NULL keys.
        folded = (
            stage.select(F.col(dim.nk), d1.alias("_d1"), d2.alias("_d2"), unfit.alias("_unfit"), deletes.alias("_deletes"))
            .groupBy(dim.nk)
            .agg(F.count("*").alias("_n"), F.min("_d1").alias("_d1"), F.min("_d2").alias("_d2"), F.max("_unfit").alias("_unfit"), F.max("_deletes").alias("_deletes"))
        )
        known = current.select(F.col(dim.nk).alias("_nk"), F.col("_d1").alias("_c1"), F.col("_d2").alias("_c2"), F.lit(True).alias("_known"))
        met = folded.join(known, F.col(dim.nk) == F.col("_nk"), "full" if close_missing else "left")
        has = F.coalesce("_known", F.lit(False))
        same = has & (F.col("_d1") == F.col("_c1")) & (F.col("_d2") == F.col("_c2")) & ~F.col("_deletes")
        why = (
            F.when(F.col("_n").isNull(), "gone")
            .when(F.col(dim.nk).isNull(), "null_key")
            .when(F.col("_n") > 1, "duplicate_key")
            .when(F.col("_unfit"), "failed_cast")
            .when(same | (F.col("_deletes") & ~has), None)
            .otherwise("touched")
        )
        return met.select(F.coalesce(dim.nk, "_nk").alias(dim.nk), why.alias("_why")).where("_why IS NOT NULL")

    def _write_rejects(self, run: int, stage: DataFrame, dim: scd2.Dimension, delta: DataFrame, given: DataFrame | None, reasons: set[str]) -> None:
        """Whole stage rows with their reason; a load without any writes none."""
        parts = [] if given is None or given.isEmpty() else [given]
        if "null_key" in reasons:
            parts.append(stage.where(F.col(dim.nk).isNull()).withColumn("reason", F.lit("null_key")))
        if reasons & {"duplicate_key", "failed_cast"}:
            held = delta.where("_why IN ('duplicate_key', 'failed_cast')").select(F.col(dim.nk), F.col("_why").alias("reason"))
            both = stage.join(held, dim.nk)
            parts.append(both.where("reason = 'duplicate_key'"))
            if "failed_casts" in stage.columns:
                parts.append(both.where(F.size("failed_casts") > 0).withColumn("reason", F.lit("failed_cast")))
        if parts:
            rows = parts[0]
            for more in parts[1:]:
                rows = rows.unionByName(more, allowMissingColumns=True)
            self.write(rows, "rejects", run)

    def load(
        self,
        stage: DataFrame,
        dim: scd2.Dimension,
        load_ts: str,
        close_missing: bool = True,
        delete_flag: str | None = None,
        batch_id: int | None = None,
        feed: str | None = None,
        rejects: DataFrame | None = None,
        state: DataFrame | None = None,
        buckets: int | None = None,
    ) -> int:
        """Apply one stage and publish the result; returns the run number.

        A ``batch_id`` that the same ``feed`` has applied changes nothing; other
        feeds count for themselves. Rows with a NULL or repeated key, or with
        entries in ``failed_casts``, are published as ``rejects`` of the run and
        leave the current row of their key as it is; ``rejects`` adds further
        ones, with their ``reason``. ``state`` replaces the stored state of the
        buckets that its keys are in (see ``state_of``). Without
        ``close_missing`` only the buckets of the stage's keys are read.
        ``buckets`` fixes their number on the first load.

        The stage is read twice, its second time for the keys of the delta only,
        and once more where it has rejects: pin a stage that does not repeat.
        """
        last = self.last()
        if self.applied(last, batch_id, feed):
            return last["run"]
        run, last_key = (last["run"] + 1, last["last_key"]) if last else (1, 0)
        old = self.places(last)
        n = last["buckets"] if last else buckets and 1 << (buckets - 1).bit_length()
        held = sum(rows for (part, _), (_, rows) in old.items() if part != "state")
        # The state of a feed is split along with the rows, so a table that has one waits for a batch of the feed.
        stateless = all(part != "state" for part, _ in old)
        split = last is not None and held > 4 * BUCKET_KEYS * n and (stateless or state is not None)
        near = None
        if last and not close_missing and not split:
            near = self.buckets_of(stage, dim.nk, n)
        with scratch_scope(self.spark):
            delta = materialize(self.delta(stage, dim, self._current(old, near), close_missing, delete_flag), "delta")
            moves = F.col("_why").isin("touched", "gone")
            told = delta.groupBy("_why", (self.bucket_of(F.col(dim.nk), n) if n else F.lit(0)).alias("_bucket")).count().collect()
            self._write_rejects(run, stage, dim, delta, rejects, {r["_why"] for r in told} - {"touched", "gone"})
            touched = {r["_bucket"] for r in told if r["_why"] in ("touched", "gone")}
            keys = sum(r["count"] for r in told if r["_why"] == "touched")
            if n is None:
                n = 1 << max(0, (keys - 1) // BUCKET_KEYS).bit_length()
                touched = touched and set(range(n))
            places = dict(old)
            if split and touched:
                n <<= max(1, (held // (BUCKET_KEYS * n)).bit_length() - 1)
                touched, places = set(range(n)), {}
                if state is not None:
                    names = {r[0] for r in state.select(self.bucket_of(F.col(dim.nk), last["buckets"])).distinct().collect()}
                    rest = {b for part, b in old if part == "state"} - names
                    state = state.unionByName(self._at("state", state.schema, old, rest))
            if touched:
                now = self._current(old, None if places != old else touched)
                last_key += self._write_buckets(run, stage, dim, load_ts, delete_flag, delta.where(moves), now, touched, places, last, last_key, n)
            if state is not None:
                bucket = self.bucket_of(F.col(dim.nk), n)
                self.write(state.withColumn("_bucket", bucket).repartition("_bucket"), "state", run, "_bucket")
                found = self.spark.read.parquet(f"{self.root}/state/run={run}").groupBy("_bucket").count().collect()
                places |= {("state", r["_bucket"]): (run, r["count"]) for r in found}
        self.publish(run, 1, load_ts, batch_id, last_key, feed, n, places)
        return run

    def _write_buckets(
        self, run: int, stage: DataFrame, dim: scd2.Dimension, load_ts: str, delete_flag: str | None,
        moved: DataFrame, now: DataFrame, touched: set[int], places: dict, last, last_key: int, n: int,
    ) -> int:
        """Write the touched buckets anew, from their rows ``now``, and note their places; returns the number of inserts."""
        bucket = self.bucket_of(F.col(dim.nk), n)
        keys = moved.where("_why = 'touched'").select(dim.nk)
        gone = moved.where("_why = 'gone'").select(dim.nk, F.lit(True).alias("_gone"))
        d1, d2 = row_digests(stage, [*dim.business, *dim.carried])
        deletes = F.coalesce(F.col(delete_flag), F.lit(False)) if delete_flag else F.lit(False)
        wide = stage.select(dim.nk, *dim.business, *dim.carried, d1.alias("_d1"), d2.alias("_d2"), deletes.alias("_gone"))
        rows = wide.join(keys, dim.nk, "left_semi").unionByName(gone, allowMissingColumns=True)
        digested = replace(dim, carried=(*dim.carried, *DIGESTS))
        changes = scd2.scd2_changes(now, rows, digested, load_ts, False, "_gone")
        self.write(changes.withColumn("_bucket", bucket).repartition("_bucket"), "rows", run, "_kind", "_bucket")
        counts = self.spark.read.parquet(f"{self.root}/rows/run={run}").groupBy("_kind", "_bucket").count().collect()
        n_rows = {(r["_kind"], r["_bucket"]): r["count"] for r in counts}
        inserted = {b: n_rows.get((scd2.INSERT, b), 0) for b in touched}
        if any(inserted.values()):
            inserts = self.spark.read.schema(self._digested).parquet(f"{self.root}/rows/run={run}/_kind={scd2.INSERT}")
            few = sum(inserted.values()) <= FEW_INSERTS
            numbered = scd2.number_inserts(inserts.select(*self._digested.names), self._closed(last, touched), dim, last_key, few)
            self.write(numbered.withColumn("_bucket", bucket).repartition("_bucket"), "new", run, "_bucket")
        for b in touched:
            places[("kept", b)] = (run, n_rows.get((scd2.KEPT, b), 0))
            places[("new", b)] = (run, inserted[b])
        return sum(inserted.values())

    def repair(self, dim: scd2.Dimension, load_ts: str) -> int:
        """Leave one current row per key, the highest version, and close the others; returns how many keys had several.

        The keys are counted narrowly; only their buckets are read whole and
        written, as a run of its own. Without such a key nothing is written.
        """
        last = self.last()
        if last is None:
            return 0
        places, n = self.places(last), last["buckets"]
        run = last["run"] + 1
        with scratch_scope(self.spark):
            twice = materialize(compare.duplicate_keys(self._current(places).select(dim.nk), [dim.nk]), "repair")
            counts = twice.groupBy(self.bucket_of(F.col(dim.nk), n).alias("b")).count().collect()
            touched = {r["b"] for r in counts}
            if not touched:
                return 0
            fixed = scd2.repair_one_current(self._current(places, touched), dim, load_ts)
            kind = F.when(scd2.is_current(), scd2.KEPT).otherwise(scd2.CLOSED)
            rows = fixed.withColumn("_kind", kind).withColumn("_bucket", self.bucket_of(F.col(dim.nk), n))
            self.write(rows.repartition("_bucket"), "rows", run, "_kind", "_bucket")
        kept = self.spark.read.parquet(f"{self.root}/rows/run={run}").where(F.col("_kind") == scd2.KEPT).groupBy("_bucket").count().collect()
        for b in touched:
            places[("kept", b)], places[("new", b)] = (run, 0), (run, 0)
        places |= {("kept", r["_bucket"]): (run, r["count"]) for r in kept}
        self.publish(run, 1, load_ts, None, last["last_key"], None, n, places)
        return sum(r["count"] for r in counts)

    # ---- state of feeds ------------------------------------------------------------

    def state_of(self, last, keys: DataFrame, nk: str, schema: T.StructType) -> DataFrame:
        """The stored state rows of all keys in the buckets of ``keys``; the other buckets are not read."""
        if last is None:
            return self.spark.createDataFrame([], schema)
        return self._at("state", schema, self.places(last), self.buckets_of(keys, nk, last["buckets"]))

    # ---- retention -----------------------------------------------------------------

    def retire(self, keep: int = 1) -> int:
        """Delete bucket files that none of the last ``keep`` runs refers to; returns how many folders.

        Closed rows and rejects stay. No reader of an older run may be at work.
        """
        last = self.last()
        if last is None:
            return 0
        recent = F.col("run") > last["run"] - keep
        ones = self._listed().where("n > 0").groupBy("part", "bucket", "at").agg(F.max(recent).alias("recent"))
        old = ones.where("NOT recent").collect()
        done = 0
        folder = {"kept": "rows/run={}/_kind=kept/_bucket={}", "new": "new/run={}/_bucket={}", "state": "state/run={}/_bucket={}"}
        for r in old:
            done += delete_path(self.spark, f"{self.root}/{folder[r['part']].format(r['at'], r['bucket'])}")
        for run in range(1, last["run"] - keep + 1):
            # The inserted rows without their keys have served once their run is published.
            delete_path(self.spark, f"{self.root}/rows/run={run}/_kind={scd2.INSERT}")
        return done
