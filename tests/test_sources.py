from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import names
from lakemart.operators import mirror
from lakemart.plans import facts, loads, star
from lakemart.session import SHUFFLE_CLEANUP, build_session, materialize, scratch_root, scratch_scope, settled
from lakemart.sources import jdbc, sync, tables

T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


# ---- names ----------------------------------------------------------------------


def test_safe_names():
    assert names.safe_name("User", "column") == "user_col"
    assert names.safe_name("order", "table") == "order_t"
    assert names.safe_name("9lives", "column") == "_9lives"
    assert names.safe_name("a--b", "column") == "a_b"
    long = names.safe_name("x" * 70, "column")
    assert long.startswith("x" * 50 + "_") and len(long) == 58
    assert long != names.safe_name("x" * 70, "table")
    assert names.safe_columns(["a-b", "a b", "a_b"]) == {"a-b": "a_b", "a b": "a_b_1", "a_b": "a_b_2"}


def test_primary_key_choice():
    assert names.pick_primary_key(["a", "b_id", "c_sk"]) == "c_sk"
    assert names.pick_primary_key(["a", "b_id"]) == "b_id"
    assert names.pick_primary_key(["a", "b"]) == "a"
    assert names.pick_primary_key(["a", "b_sk"], "a") == "a"
    assert names.pick_primary_key([]) is None


def test_types():
    assert names.sql_type(T.ArrayType(T.LongType())) == "BIGINT[]"
    assert names.sql_type(T.DecimalType(10, 2)) == "DECIMAL(10,2)"
    assert names.sql_type(T.MapType(T.StringType(), T.StringType())) == "TEXT"
    assert names.mirror_type(T.ByteType()) == T.ShortType()
    assert names.mirror_type(T.BinaryType()) == T.StringType()


# ---- JDBC statements ----------------------------------------------------------------

DB = jdbc.Database("jdbc:postgresql://host/db", "mart", properties={"user": "u"})


def layout(spark, pk="dim_sk"):
    df = spark.createDataFrame([], "dim_sk bigint, Name string, n tinyint")
    return mirror.layout(df, "dim_x", mirror.MirrorSettings(pk=pk), with_pk=pk is not None)


def test_statements(spark):
    table = layout(spark)
    assert jdbc.create_table(DB, table) == (
        "CREATE TABLE IF NOT EXISTS mart.dim_x (dim_sk BIGINT NOT NULL, name TEXT, n SMALLINT, PRIMARY KEY (dim_sk))"
    )
    assert jdbc.upsert_from_stage(DB, table)[0] == (
        "INSERT INTO mart.dim_x (dim_sk, name, n) SELECT dim_sk, name, n FROM mart.dim_x_stg "
        "ON CONFLICT (dim_sk) DO UPDATE SET name = EXCLUDED.name, n = EXCLUDED.n"
    )
    assert [s.split(" ")[0] for s in jdbc.replace_from_stage(DB, table)] == ["TRUNCATE", "INSERT", "DROP"]
    assert "PRIMARY KEY" not in jdbc.create_table(DB, layout(spark, None))
    control = jdbc.upsert_control(DB, "_mirror_control", "o'x", {"last_max_sk": 5, "last_max_effective_from": None})
    assert "VALUES ('o''x', 5, NULL, now())" in control and "COALESCE(EXCLUDED.last_max_sk, t.last_max_sk)" in control


def test_extract_rules_and_options():
    names_ = ["src_a", "src_b", "tmp_a"]
    assert jdbc.select_tables(names_) == names_
    assert jdbc.select_tables(names_, [("include", "src_%"), ("exclude", "%_b")]) == ["src_a"]
    options = jdbc.extract_options(DB, "t", jdbc.Split("id", 1, 100, 8))
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["dbtable"] == "mart.t"
    assert "partitionColumn" not in jdbc.extract_options(DB, "t")


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 1, 7), (2, 0, 8)], "f_id bigint, a_sk bigint, b_sk bigint")
    table = mirror.layout(fact, "fact_f", mirror.MirrorSettings(pk="f_id"))
    a = mirror.unknown_member(spark.createDataFrame([(1,)], "a_sk bigint"), "a_sk")
    dims = {"dim_a": a, "dim_b": spark.createDataFrame([(7,)], "b_sk bigint")}
    references = [("a_sk", "dim_a", "a_sk"), ("b_sk", "dim_b", "b_sk"), ("c_sk", "dim_c", "c_sk"), ("b_sk", "dim_c", "c_sk")]
    statements, skipped = jdbc.foreign_keys(DB, table, fact, references, dims)
    assert len(statements) == 1 and "FOREIGN KEY (a_sk) REFERENCES mart.dim_a(a_sk)" in statements[0]
    assert [reason for _, reason in skipped] == ["orphans", "column missing", "dim_c(c_sk) missing"]
    again, _ = jdbc.foreign_keys(DB, table, fact, references[:1], dims, existing=["fact_f_a_sk_fk"])
    assert again == []


# ---- mirror ---------------------------------------------------------------------------


def test_mirror_settings(spark):
    s = mirror.MirrorSettings.from_properties({"mirror.exclude": "TRUE", "mirror.cast.a": "NUMERIC", "mirror.rename.b": "c"})
    assert s.exclude and s.casts == {"a": "NUMERIC"} and s.renames == {"b": "c"}
    df = spark.createDataFrame([], "a bigint, b string")
    assert mirror.layout(df, "dim_t", s).columns == (("a", "NUMERIC"), ("c", "TEXT"))
    told = mirror.MirrorSettings(casts={"a": "numeric(12, 2)", "b": "integer", "c": "geometry"})
    rows = spark.createDataFrame([(5, "7", "x"), (None, None, None)], "a bigint, b string, c string")
    shipped = mirror.mirror_projection(rows, mirror.layout(rows, "dim_t", told))
    assert shipped.dtypes == [("a", "decimal(12,2)"), ("b", "int"), ("c", "string")]
    assert {tuple(r) for r in shipped.collect()} == {(Decimal("5.00"), 7, "x"), (None, None, None)}
    assert mirror.layout(spark.createDataFrame([], "date_id int, x_sk int"), "dim_date").pk == "date_id"
    assert mirror.mirrored_tables(["dim_a", "fact_b", "bridge_c", "dim_date"]) == ["dim_a", "dim_date"]


def test_string_key_is_reloaded(spark):
    df = spark.createDataFrame([("a",), ("b",)], "code string")
    marks = mirror.watermarks(df, "code", "t", T1).first()
    assert marks["last_max_sk"] is None
    assert mirror.mirror_slice(df, "code", marks["last_max_sk"], marks["last_max_effective_from"]).count() == 2


def test_watermark_predicates_reach_the_scan(spark, folder):
    df = spark.range(10).select(F.col("id").alias("sk"), F.lit(T1).cast("timestamp").alias("effective_from"))
    df.write.parquet(folder + "/d")
    sliced = mirror.mirror_slice(spark.read.parquet(folder + "/d"), "sk", 5, None)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sk), GreaterThan(sk,5)]" in plan


# ---- scans, sync, validation --------------------------------------------------------


def test_mirror_settings_of_the_catalogue(spark):
    tables.ensure_database(spark, "mirrored")
    spark.sql(
        "CREATE TABLE mirrored.dim_date (date_id INT, day STRING) USING parquet "
        "TBLPROPERTIES ('mirror.rename.day' = 'on_day', 'mirror.cast.on_day' = 'DATE', 'mirror.pk' = 'day')"
    )
    spark.sql("CREATE TABLE mirrored.dim_old (x_sk INT) USING parquet TBLPROPERTIES ('mirror.exclude' = 'true')")
    found = loads.mirror_settings(spark, ["dim_date", "dim_old", "dim_status", "dim_none"], "mirrored")
    assert found["dim_date"].pk == "day" and found["dim_date"].casts == {"on_day": "DATE"} and not found["dim_date"].exclude
    assert found["dim_old"].exclude and found["dim_status"].pk == "status_id" and found["dim_none"] == mirror.MirrorSettings()
    assert loads.mirror_settings(spark, ["dim_date"])["dim_date"].pk == "date_id"
    rows = spark.createDataFrame([(1, "2024-02-03")], "date_id int, day string")
    shipped = mirror.mirror_projection(rows, mirror.layout(rows, "dim_date", found["dim_date"]))
    assert [tuple(r) for r in shipped.collect()] == [(1, date(2024, 2, 3))]


def test_jobs_of_a_table_have_a_pool(spark):
    pool = lambda name: (1, spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
    status = loads.run_tables(spark, ["a", "b", "c"], pool, 2).collect()
    assert {r["table"]: r["detail"] for r in status} == {"a": "a", "b": "b", "c": "c"}


def test_only_a_missing_path_counts_as_absent(spark, folder):
    import os

    os.makedirs(f"{folder}/half-written")
    assert tables.path_or_none(spark, f"{folder}/none") is None
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        tables.path_or_none(spark, f"{folder}/half-written")


def test_folders_and_catalogue(spark, folder):
    for t in ("b", "a"):
        tables.write_raw(spark.range(3).toDF("id"), f"{folder}/raw/{t}")
    assert tables.table_folders(spark, folder + "/raw") == ["a", "b"]
    assert tables.table_folders(spark, folder + "/raw", only=["b"]) == ["b"]
    tables.ensure_database(spark, "synced")
    found = tables.schema_rows(spark, {t: spark.read.parquet(f"{folder}/raw/{t}").schema for t in ("a", "b")})
    none = tables.schema_rows(spark, {}) if False else spark.createDataFrame([], found.schema)
    assert sync.apply_sync(spark, "synced", folder + "/raw", sync.sync_diff(found, none)) == [
        ("a", "create_table"), ("b", "create_table"),
    ]
    assert sorted(tables.catalogue_tables(spark, "synced", exclude=["B"])) == ["a"]
    assert spark.table("synced.b").count() == 3
    changed = sync.sync_diff(found.where("table = 'a'").withColumn("type", F.lit("bigint")), found.withColumn("type", F.lit("int")))
    assert sync.apply_sync(spark, "synced", folder + "/raw", changed) == [("a", "update_table"), ("b", "drop_table")]
    assert tables.read_or_none(spark, "synced.b") is None and tables.read_or_none(spark, "synced.a").count() == 3


def test_validation(spark, folder):
    tables.write_raw(spark.range(3).toDF("id"), folder + "/raw/a")
    files = tables.file_listing(spark, folder + "/raw")
    catalogue = tables.schema_rows(spark, {"a": spark.range(1).schema})
    expected = spark.createDataFrame([("a",)], "table string")
    assert sync.require_valid(sync.validate_load(files, catalogue, expected)) == 1
    more = spark.createDataFrame([("a",), ("b",)], "table string")
    with pytest.raises(ValueError, match="b: has_files"):
        sync.require_valid(sync.validate_load(files, catalogue, more))
    with pytest.raises(ValueError, match="no table folders"):
        sync.require_valid(sync.validate_load(files, catalogue, expected.where("FALSE")))


def test_archive(spark, folder):
    tables.write_raw(spark.range(5).toDF("id"), folder + "/raw/a")
    got = tables.archive(spark, folder + "/raw", folder + "/archive/1", ["a"]).collect()
    assert [tuple(r) for r in got] == [("a", 5, 5)]
    assert tables.archive(spark, folder + "/raw", folder + "/archive/2", []).count() == 0


# ---- loads -------------------------------------------------------------------------


def test_nightly_order(spark, folder):
    """Raw to curated to dimensions to a fact, twice, by calling the loads in sequence."""
    raw, curated, dims, out = (f"{folder}/{p}" for p in ("raw", "curated", "dims", "facts"))

    def land(companies, directors):
        tables.write_raw(spark.createDataFrame(companies, "id int, industry_id int, province_id int, scan string"), f"{raw}/company_company")
        tables.write_raw(spark.createDataFrame(directors, "id int, company_id int"), f"{raw}/company_director")
        tables.write_raw(spark.createDataFrame([(1,)], "id int"), f"{raw}/src_subsectoractivity")
        tables.write_raw(spark.createDataFrame([(1,)], "id int"), f"{raw}/configurable_province")
        tables.write_raw(spark.createDataFrame([("x",)], "k string"), f"{raw}/no_key")
        tables.write_raw(spark.createDataFrame([(1,)], "id int"), f"{raw}/auth_permission")

    def run(at):
        status = loads.curate_all(spark, raw, curated, tables.table_folders(spark, raw), exclude=["AUTH_permission"])
        found = {r["table"]: r["status"] for r in status.collect()}
        assert found.pop("auth_permission") == "excluded" and set(found.values()) == {"ok"}
        done = {r["table"]: r["status"] for r in loads.load_dimensions(spark, curated, dims, at).collect()}
        t = loads.current_dimensions(spark, dims, {})
        facts_done = loads.load_facts(spark, out, t, at, ["fact_company"]).collect()
        assert [r["status"] for r in facts_done] == ["ok"], facts_done
        return done, t

    land([(1, 1, 1, "a.pdf"), (2, 9, None, "")], [(5, 1), (6, 1)])
    done, t = run(T1)
    assert "auth_permission" not in done
    assert done.pop("no_key") == "no_nk" and set(done.values()) == {"ok"}
    assert "scan" not in t("dim_company_company").columns
    land([(1, 1, 1, "plain"), (3, 1, 1, "")], [(5, 1)])
    run(T2)
    fact = tables.path_or_none(spark, f"{out}/fact_company/data").where("run = 2")
    got = {r["company_fact_id"]: (r["company_sk"], r["industry_sk"], r["director_sks"]) for r in fact.collect()}
    assert got == {1: (1, 1, [1]), 2: (3, 1, [])}


def test_failed_table_does_not_stop_others(spark):
    def work(name):
        if name == "bad":
            raise RuntimeError("broken\nlong trace")
        return 1, ""

    got = {r["table"]: (r["status"], r["detail"]) for r in loads.run_tables(spark, ["a", "bad", "c"], work, 2).collect()}
    assert got == {"a": ("ok", ""), "bad": ("failed", "broken"), "c": ("ok", "")}


def test_vanished_column_keeps_values(spark, folder):
    curated, dims = folder + "/curated", folder + "/dims"
    tables.write_raw(spark.createDataFrame([(1, "a", "n")], "id int, v string, note string"), f"{curated}/thing")
    loads.load_dimension(spark, curated, dims, "thing", T1)
    tables.write_raw(spark.createDataFrame([(1, "a")], "id int, v string"), f"{curated}/thing")
    rows, detail = loads.load_dimension(spark, curated, dims, "thing", T2)
    assert rows == 0 and "note" in detail
    current = loads.current_dimensions(spark, dims, {})("dim_thing").collect()
    assert [(r["note"], r["version"]) for r in current] == [("n", 1)]


def test_star_is_consistent(spark):
    assert set(star.PRIMARY_KEYS) == set(facts.BUILDERS)
    for name in star.FACT_COLUMNS:
        columns = star.fact_fields(name).names
        assert columns[0] == star.PRIMARY_KEYS[name]
        assert all(fk in columns for fk, _, _ in star.references(name))
    assert star.references("fact_appeal")[-1] == ("appeal_status", "dim_status", "status_id")
    with pytest.raises(ValueError):
        star.fact_fields("dim_x")


# ---- scratch -------------------------------------------------------------------------


def test_scratch_scope_deletes(spark):
    with scratch_scope(spark):
        df = materialize(spark.range(3).toDF("id"), "test")
        path = df.inputFiles()[0]
        assert scratch_root(spark) in path and df.count() == 3
    assert tables.path_or_none(spark, path) is None


def test_settled_keeps_its_result_only(spark):
    paths = []

    def make():
        inner = settled(spark, "test", lambda: spark.range(5).toDF("id"))
        outer = materialize(inner.where("id > 1"), "test")
        paths.extend([inner.inputFiles()[0], outer.inputFiles()[0]])
        return outer.where("id > 2")

    with scratch_scope(spark):
        df = settled(spark, "test", make)
        assert sorted(r.id for r in df.collect()) == [3, 4]
        assert all(tables.path_or_none(spark, p) is None for p in paths)
        last = df.inputFiles()[0]
    assert tables.path_or_none(spark, last) is None
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_session_defaults(spark):
    assert build_session() is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
