"""Loads over many tables: landing, curating, dimensions, facts, mirroring.

Tables are independent, so each load runs several at once from driver threads
(Spark schedules their jobs side by side) and reports one status row per table.
A failing table does not stop the others.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import mirror, profile, scd2, shape
from lakemart.operators.compare import split_bad_keys
from lakemart.operators.lookup import current
from lakemart.operators.quality import limit_lobs
from lakemart.operators.versioned import nameless_rows, needs_full_load, unseen_rows, versioned_upsert
from lakemart.plans import star
from lakemart.plans.facts import BUILDERS
from lakemart.session import materialize, scratch_scope
from lakemart.sources import jdbc, tables
from lakemart.sources.runs import DimensionTable, KeyMap, RunTable

# Tables curated and dimensions loaded at the same time.
CURATE_WORKERS = 4
DIMENSION_WORKERS = 2

STATUS = "table string, n_rows bigint, status string, detail string"


class Skip(Exception):
    """A table that is left out, with the status to report."""


def run_tables(
    spark: SparkSession,
    names: Sequence[str],
    work: Callable[[str], tuple[int, str]],
    workers: int,
) -> DataFrame:
    """Run ``work`` per table, a few at a time; ``(table, n_rows, status, detail)``.

    ``work`` returns a row count and a detail text. The jobs of a table share a
    pool named after it: under the fair scheduler (a session default) a large
    table leaves cores for the small ones beside it.
    """

    def one(name: str) -> tuple[str, int, str, str]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            rows, detail = work(name)
            return name, rows, "ok", detail
        except Skip as skip:
            status, _, detail = str(skip).partition(": ")
            return name, 0, status, detail
        except Exception as error:
            return name, 0, "failed", str(error).split("\n")[0]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(names) or 1))) as pool:
        # A target each: threads of one target would share their properties, and so their pool.
        targets = [inheritable_thread_target(spark)(one) for _ in names]
        return spark.createDataFrame(list(pool.map(lambda target, name: target(name), targets, names)), STATUS)


# ---- landing and curating ---------------------------------------------------------


def extract_all(
    spark: SparkSession,
    db: jdbc.Database,
    names: Sequence[str],
    raw_root: str,
    splits: Mapping[str, jdbc.Split] | None = None,
    lobs: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Full-load extract of source tables into raw folders, replacing them."""

    def work(name: str) -> tuple[int, str]:
        df = jdbc.extract(spark, db, name, (splits or {}).get(name))
        if name in (lobs or {}):
            df = limit_lobs(df, lobs[name])
        tables.write_raw(df, f"{raw_root}/{name}")
        return spark.read.parquet(f"{raw_root}/{name}").count(), ""

    return run_tables(spark, names, work, jdbc.EXTRACT_WORKERS)


def curate(spark: SparkSession, raw_root: str, curated_root: str, name: str, force_drop: Collection[str] = ()) -> tuple[int, str]:
    """Drop file-like columns of one table and write it; an empty table is written empty."""
    raw = tables.path_or_none(spark, f"{raw_root}/{name}")
    if raw is None:
        raise Skip("read_fail")
    keep, dropped, rows = profile.split_columns(raw, force_drop)
    if not keep:
        raise Skip("no_columns")
    tables.write_curated(raw.select(*[f"`{c}`" for c in keep]), f"{curated_root}/{name}")
    return rows, ("empty; " if rows == 0 else "") + "dropped: " + ",".join(dropped)


def curate_all(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    names: Sequence[str],
    exclude: Collection[str] = (),
    force_drop: Collection[str] = (),
) -> DataFrame:
    """Curate many tables; those in ``exclude`` (any case) get the status ``excluded``."""
    skip = {e.lower() for e in exclude}

    def work(name: str) -> tuple[int, str]:
        if name.lower() in skip:
            raise Skip("excluded")
        return curate(spark, raw_root, curated_root, name, force_drop)

    return run_tables(spark, names, work, CURATE_WORKERS)


# ---- dimensions ------------------------------------------------------------------


def dimension_table(spark: SparkSession, dims_root: str, curated_root: str, source: str) -> DimensionTable:
    """The dimension of a curated table; its schema is fixed by the first run."""
    path = f"{dims_root}/{shape.dim_name(source)}"
    published = tables.path_or_none(spark, f"{path}/schema")
    if published is not None:
        return DimensionTable(spark, path, published.schema)
    curated = tables.path_or_none(spark, f"{curated_root}/{source}")
    if curated is None:
        raise Skip("read_fail")
    try:
        schema = shape.dim_schema(curated.schema, source)
    except ValueError as error:
        raise Skip(str(error)) from error
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/schema")
    return DimensionTable(spark, path, schema)


def load_dimension(
    spark: SparkSession,
    curated_root: str,
    dims_root: str,
    source: str,
    load_ts: str,
    aliases: Mapping[str, str] | None = None,
    sig_hash: bool = False,
    repair: bool = True,
) -> tuple[int, str]:
    """Read, clamp, conform and apply one curated table to its dimension.

    With ``repair``, keys with several current rows are mended before the load
    and counted in the status; afterwards there must be none.

    A column that vanished from the source keeps each key's current value, so
    a profiling change on one night does not open a version of every row. A row
    with a value that cannot be cast goes to the rejects, as do NULL and
    repeated keys; the current row of its key stays. The counts by reason are
    in the status detail.
    """
    table = dimension_table(spark, dims_root, curated_root, source)
    raw = tables.path_or_none(spark, f"{curated_root}/{source}")
    if raw is None:
        raise Skip("read_fail")
    dim = scd2.Dimension.of(table.schema.names, source, sig_hash=sig_hash)
    stage = shape.conform(shape.clamp_ancient(raw), table.schema, source, aliases, failed_out="failed_casts")
    present = {(aliases or {}).get(c, c) for c in raw.columns} | {f"{c}_src" for c in raw.columns}
    missing = [c for c in dim.business if c not in present]
    if missing:
        known = table.current().select(F.col(dim.nk).alias("_key"), *[F.col(c).alias(f"_now_{c}") for c in missing])
        stage = stage.join(known, F.col(dim.nk) == F.col("_key"), "left").select(
            *[F.col(f"_now_{c}").alias(c) if c in missing else F.col(c) for c in stage.columns]
        )
    repaired = table.repair(dim, load_ts) if repair else 0
    run = table.load(stage, dim, load_ts)
    if repair and table.repair(dim, load_ts):
        raise ValueError(f"several current rows per key after run {run}")
    rejected = table.rejects(run).groupBy("reason").count().orderBy("reason").collect()
    detail = f"run {run}" + (f"; missing columns kept: {','.join(missing)}" if missing else "")
    detail += f"; keys repaired: {repaired}" if repaired else ""
    detail += "".join(f"; rejected {r['reason']}: {r['count']}" for r in rejected)
    return table.written(run).where("part = 'new'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], detail


def load_dimensions(
    spark: SparkSession,
    curated_root: str,
    dims_root: str,
    load_ts: str,
    only: Collection[str] | None = None,
    exclude: Collection[str] = (),
    aliases: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Every curated table (or ``only`` these) into its dimension."""
    names = tables.table_folders(spark, curated_root, only)

    def work(name: str) -> tuple[int, str]:
        if name in exclude:
            raise Skip("excluded")
        return load_dimension(spark, curated_root, dims_root, name, load_ts, (aliases or {}).get(name))

    return run_tables(spark, names, work, DIMENSION_WORKERS)


# ---- facts --------------------------------------------------------------------------


def load_fact(
    spark: SparkSession,
    facts_root: str,
    name: str,
    t: Callable[[str], DataFrame],
    load_ts: str,
    durable: Mapping[str, Sequence[str]] | None = None,
) -> tuple[int, str]:
    """Build one fact and publish it: replaced, versioned or appended as declared.

    Rows of versioned and insert-only facts without a whole key, and repeated
    ones of versioned facts, are the rejects of the run and counted in the
    detail. ``durable`` names the business columns of replaced facts that keep
    their keys from one rebuild to the next.
    """
    rows = BUILDERS[name](t)
    path = f"{facts_root}/{name}"
    rejected = None
    with scratch_scope(spark):
        if name in star.VERSIONED:
            pk, keys, carried = star.PRIMARY_KEYS[name], list(star.VERSIONED[name]), star.CARRIED.get(name, ())
            fit, rejected = split_bad_keys(materialize(rows, "fact"), keys)
            compare_on = [c for c in rows.columns if c != pk and c not in keys]
            table = RunTable(spark, path, rows.schema.add("fact_current_flag", "boolean"))
            existing = table.read() if table.exists() else None
            run = table.replace(versioned_upsert(existing, fit, keys, compare_on, pk, carried), load_ts)
        elif name in star.INSERT_ONLY:
            pk, business_id = star.PRIMARY_KEYS[name], star.INSERT_ONLY[name]
            table = RunTable(spark, path, rows.schema)
            existing = table.read() if table.exists() else None
            if needs_full_load(existing, pk):
                run = table.replace(rows, load_ts)
            else:
                rows = materialize(rows, "fact")
                rejected = nameless_rows(rows, business_id)
                run = table.append(unseen_rows(rows, existing, business_id, pk), load_ts)
        else:
            table = RunTable(spark, path, rows.schema)
            if name in (durable or {}):
                pk = star.PRIMARY_KEYS[name]
                keyed = KeyMap.of(spark, f"{path}/keys", rows, durable[name], pk).assign(materialize(rows, "fact"), load_ts)
                rows = keyed.select(*rows.columns)
            run = table.replace(rows, load_ts)
        detail = f"run {run}"
        if rejected is not None:
            table.write(rejected, "rejects", run)
            told = spark.read.parquet(f"{path}/rejects/run={run}").groupBy("reason").count().orderBy("reason").collect()
            detail += "".join(f"; rejected {r['reason']}: {r['count']}" for r in told)
    return table.read().count(), detail


def load_facts(
    spark: SparkSession,
    facts_root: str,
    t: Callable[[str], DataFrame],
    load_ts: str,
    names: Sequence[str] = tuple(BUILDERS),
    durable: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Facts in build order, one after the other: later ones may read earlier ones."""

    def with_facts(name: str) -> DataFrame:
        if name.startswith("fact_"):
            found = tables.path_or_none(spark, f"{facts_root}/{name}/data")
            if found is not None:
                return RunTable(spark, f"{facts_root}/{name}", found.drop("run").schema).read()
        return t(name)

    return run_tables(spark, names, lambda n: load_fact(spark, facts_root, n, with_facts, load_ts, durable), 1)


# ---- mirror ------------------------------------------------------------------------


def mirror_dimension(
    spark: SparkSession, db: jdbc.Database, name: str, df: DataFrame, settings: mirror.MirrorSettings | None = None
) -> tuple[int, str]:
    """Ship what changed since the last run and upsert it on the primary key."""
    settings = settings or mirror.DEFAULT_SETTINGS.get(name, mirror.MirrorSettings())
    if settings.exclude:
        raise Skip("excluded")
    table = mirror.layout(df, name, settings)
    jdbc.run_statements(spark, db, [jdbc.create_schema(db), jdbc.create_control(db, "_mirror_control"), jdbc.create_table(db, table)])
    control = jdbc.read_query(
        spark, db,
        f"SELECT last_max_sk, last_max_effective_from FROM {db.name('_mirror_control')} WHERE table_name = {jdbc.sql_literal(table.name)}",
    ).first()
    projected = mirror.mirror_projection(df, table)
    numeric = dict(projected.dtypes)[table.pk] in ("tinyint", "smallint", "int", "bigint")
    slice_ = mirror.mirror_slice(
        projected, table.pk,
        control["last_max_sk"] if control and numeric else None,
        control["last_max_effective_from"] if control else None,
    )
    # Narrow pass for the watermarks and the count, then one full pass to write.
    marks = mirror.watermarks(slice_, table.pk, table.name, "1970-01-01").first()
    statements = []
    if marks["n_rows"]:
        jdbc.run_statements(spark, db, jdbc.create_stage(db, table))
        jdbc.write_stage(slice_, db, table)
        statements = jdbc.upsert_from_stage(db, table)
    values = {c: marks[c] for c in ("last_max_sk", "last_max_effective_from")}
    jdbc.run_statements(spark, db, [*statements, jdbc.upsert_control(db, "_mirror_control", table.name, values)])
    return marks["n_rows"], ""


def mirror_fact(
    spark: SparkSession, db: jdbc.Database, name: str, df: DataFrame, dims: Mapping[str, DataFrame]
) -> tuple[int, str]:
    """Replace a mirrored fact in one transaction, then add the foreign keys that hold."""
    pk = star.PRIMARY_KEYS.get(name)
    if pk is not None and pk not in df.columns:
        raise ValueError(f"primary key {pk} not in {name}")
    table = mirror.layout(df, name, mirror.MirrorSettings(pk=pk), with_pk=pk is not None)
    control = "_mirror_control_facts"
    jdbc.run_statements(spark, db, [jdbc.create_schema(db), jdbc.create_control(db, control), jdbc.create_table(db, table)])
    if pk is None:
        found = jdbc.read_query(spark, db, jdbc.find_primary_key(db, table)).first()
        if found:
            jdbc.run_statements(spark, db, [jdbc.drop_primary_key(db, table, found[0])])
    jdbc.run_statements(spark, db, jdbc.create_stage(db, table))
    jdbc.write_stage(mirror.mirror_projection(df, table), db, table)
    rows = jdbc.stage_rows(spark, db, table)
    jdbc.run_statements(
        spark, db, [*jdbc.replace_from_stage(db, table), jdbc.upsert_control(db, control, table.name, {})]
    )
    statements, skipped = jdbc.foreign_keys(
        db, table, df, star.references(name), dims, jdbc.existing_constraints(spark, db, table)
    )
    jdbc.run_statements(spark, db, statements)
    return rows, "; ".join(f"{fk}: {reason}" for fk, reason in skipped)


def mirror_settings(spark: SparkSession, names: Sequence[str], database: str | None = None) -> dict[str, mirror.MirrorSettings]:
    """Settings of each dimension: the defaults, then the properties of its catalogue table in ``database``, if it has one."""

    def one(name: str) -> mirror.MirrorSettings:
        default = mirror.DEFAULT_SETTINGS.get(name, mirror.MirrorSettings())
        entry = f"{database}.`{name}`"
        if database is None or not spark.catalog.tableExists(entry):
            return default
        return mirror.MirrorSettings.from_properties(tables.table_properties(spark, entry), default)

    return {name: one(name) for name in names}


def mirror_all(
    spark: SparkSession, db: jdbc.Database, dims: Mapping[str, DataFrame], facts: Mapping[str, DataFrame],
    database: str | None = None,
) -> DataFrame:
    """Dimensions first, each with its unknown member, then facts with their foreign keys.

    Dimensions follow the ``mirror.*`` properties of their tables in ``database``.
    """

    def with_unknown(name: str, df: DataFrame) -> DataFrame:
        key = mirror.DEFAULT_SETTINGS[name].pk if name in mirror.DEFAULT_SETTINGS else shape.surrogate_key(name.removeprefix("dim_"))
        return mirror.unknown_member(df, key) if key in df.columns else df

    shipped = {n: with_unknown(n, dims[n]) for n in mirror.mirrored_tables(list(dims))}
    settings = mirror_settings(spark, list(shipped), database)
    done = run_tables(spark, list(shipped), lambda n: mirror_dimension(spark, db, n, shipped[n], settings[n]), DIMENSION_WORKERS)
    return done.unionByName(
        run_tables(spark, list(facts), lambda n: mirror_fact(spark, db, n, facts[n], shipped), 1)
    )


def current_dimensions(spark: SparkSession, dims_root: str, conformed: Mapping[str, DataFrame]) -> Callable[[str], DataFrame]:
    """Table accessor for the fact plans over published dimensions."""

    def t(name: str) -> DataFrame:
        if name in conformed:
            return conformed[name]
        schema = tables.read_parquet(spark, f"{dims_root}/{name}/schema").schema
        return current(DimensionTable(spark, f"{dims_root}/{name}", schema).current())

    return t
