"""Digest reconciliation, chunked bridges, stacked reference checks, durable keys, rejects of facts."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators import bridge, compare, keys, quality, versioned
from lakemart.plans import facts, loads, star
from lakemart.plans.star import REFERENCES
from lakemart.sources.runs import KeyMap, RunTable

SMOKE = "/root/testdata/sf0.001"
T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def nodes(plan):
    """The physical plan that ran, without adaptive wrappers."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
        return
    if name.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
        return
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def shuffled(df):
    """Rows that each exchange of an executed frame wrote."""
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return [n.metrics().apply("shuffleRecordsWritten").value() for n in found]


def test_equal_tables_move_a_row_per_bucket_and_task(spark):
    a = spark.range(0, 100_000, 1, 4).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("t"))
    b = a.repartition(5, "v")
    diff = quality.differing_buckets(a, b, ["id"], ["v", "t"], buckets=16)
    assert diff.collect() == []
    assert all(n <= 16 * 5 for n in shuffled(diff) if n < 100_000) and sum(n == 100_000 for n in shuffled(diff)) == 1  # the repartition of b
    assert quality.reconcile_by_digest(a, b, ["id"], buckets=16).collect() == []


def test_digest_findings_are_those_of_rows(spark):
    a = spark.createDataFrame([(i, i % 5, None if i % 4 else "t") for i in range(200)] + [(None, 1, "n"), (7, 0, "again")], "id int, v int, t string")
    b = a.where("id IS NULL OR id <> 11").union(spark.createDataFrame([(500, 1, "new"), (None, 2, "n")], a.schema))
    b = b.withColumn("v", F.when(F.col("id") == 30, F.lit(None)).otherwise(F.col("v")))
    want = sorted(map(tuple, quality.reconcile(a, b, ["id"]).collect()), key=str)
    assert want and sorted(map(tuple, quality.reconcile_by_digest(a, b, ["id"], buckets=8).collect()), key=str) == want
    assert quality.differing_buckets(a, b, ["id"], ["v", "t"], buckets=64).count() <= 4
    # Swapped values keep sums of columns, not the digests of rows.
    swapped = a.withColumn("v", F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("v")))
    assert {r["id"] for r in quality.reconcile_by_digest(a, swapped, ["id"], buckets=8).collect()} == {1, 2}


def test_chunks_of_a_hot_parent(spark):
    """A parent with a third of all rows is many bounded cells, dealt over the tasks, in order."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("p"), (F.col("id") * 7 % 30_000).alias("m"), (F.col("id") % 11).alias("at")
    )
    rows = rows.unionByName(spark.createDataFrame([(5, None, 1), (None, 3, 1)], "p long, m long, at long"))
    made = bridge.bridge_chunks(rows, "p", "m", ["at"], size=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would be put together
    try:
        cells = made.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(len(r["sks"]) for r in cells) == 100 and all(r["n_members"] == len(r["sks"]) for r in cells)
    hot = sorted((r for r in cells if r["p"] == -1), key=lambda r: r["chunk_no"])
    assert len(hot) == 100 and [r["chunk_no"] for r in hot] == list(range(1, 101))
    per_task = [sum(r["task"] == t for r in hot) for t in {r["task"] for r in hot}]
    assert len(per_task) > 1 and max(per_task) < 50
    want = [r["m"] for r in rows.where("p = -1").select("at", "m").distinct().orderBy("at", "m").collect()]
    assert [m for r in hot for m in r["sks"]] == want
    assert bridge.bridge_chunks(rows.limit(0), "p", "m").count() == 0


def test_star_check_counts_orphans_and_unknowns(spark):
    fact = spark.createDataFrame([(1, 10), (1, 0), (9, 11), (None, 12), (0, 0)], "a_sk int, b_sk long")
    dims = {"dim_a": spark.createDataFrame([(1,), (2,)], "a_sk bigint"), "dim_b": spark.createDataFrame([(0,), (10,)], "b_sk int")}
    declared = {"fact_x": {"a_sk": ("dim_a", "a_sk"), "b_sk": ("dim_b", "b_sk"), "gone_sk": ("dim_a", "a_sk")}, "fact_y": {"a_sk": ("dim_a", "a_sk")}}
    got = {tuple(r) for r in quality.star_check({"fact_x": fact, "fact_y": fact.limit(0)}, declared, dims).collect()}
    assert got == {("fact_x", "a_sk", 4, 1, 1), ("fact_x", "b_sk", 5, 2, 0), ("fact_y", "a_sk", 0, 0, 0)}


def test_star_check_joins_once(spark):
    fact = spark.range(100).select(*[F.col("id").alias(f"k{i}_sk") for i in range(6)])
    dims = {f"dim_{i}": spark.range(50).select(F.col("id").alias("sk")) for i in range(3)}
    got = quality.star_check({"fact_x": fact}, {"fact_x": {f"k{i}_sk": (f"dim_{i % 3}", "sk") for i in range(6)}}, dims)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # with the dimension keys, and with the names
    assert {r["n_orphans"] for r in got.collect()} == {50}


def test_star_check_numbers_no_fact(spark, monkeypatch):
    """The rows of no fact are sorted and written for a check that reads no fact key, and are the same otherwise."""
    from lakemart.checks import star as queries

    written = []
    monkeypatch.setattr(keys, "materialize", lambda df, label: written.append(df.columns) or df)
    checked = queries.star_check(spark, SMOKE)
    assert [c for c in written if "status_nk" not in c] == []
    monkeypatch.undo()
    assert checked.count() == sum(len(queries.declared(name)) for name in queries.CHECKED)
    t = queries.STARS["fact_vetting"].tables(spark, SMOKE)
    numbered, plain = facts.vetting(t).drop("vetting_fact_id"), facts.unkeyed("fact_vetting", t)
    assert plain.agg(F.max("vetting_fact_id")).first()[0] == 0 and plain.columns == ["vetting_fact_id", *numbered.columns]
    plain = plain.drop("vetting_fact_id")
    assert plain.count() == numbered.count() and plain.exceptAll(numbered).count() == numbered.exceptAll(plain).count() == 0


def test_star_check_checks_every_declared_reference(spark):
    """All of them, the learner fact's with the rows of both its loads and the status of an appeal."""
    from lakemart.checks import star as queries

    got = {(r["table"], r["fk"]): r for r in queries.star_check(spark, SMOKE).collect()}
    assert set(got) == {(name, fk) for name, columns in REFERENCES.items() for fk in columns}
    versions, orders = queries.fact_learner(spark, SMOKE), spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    assert {got["fact_learner", fk]["n_rows"] for fk in REFERENCES["fact_learner"]} == {versions.count()}
    assert versions.count() > orders
    unknown = queries.fact_appeal(spark, SMOKE).where("appeal_status = 0").count()
    status = got["fact_appeal", "appeal_status"]
    assert (status["n_rows"], status["n_orphans"], status["n_unknown"]) == (orders, 0, unknown) and unknown > 0


def test_star_check_shuffles_counts_and_keys_once(spark):
    """Counts per value are joined as they lie after counting; a key shared by columns of two facts is one key."""
    fact = spark.range(1000).select((F.col("id") % 50).alias("a_sk"), F.lit(7).alias("b_sk"))
    dims = {"dim_a": spark.range(1, 40).select(F.col("id").alias("sk")), "dim_b": spark.range(7).select(F.col("id").alias("sk"))}
    declared = {"fact_x": {"a_sk": ("dim_a", "sk"), "b_sk": ("dim_a", "sk")}, "fact_y": {"a_sk": ("dim_a", "sk"), "b_sk": ("dim_b", "sk")}}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = quality.star_check({"fact_x": fact, "fact_y": fact.limit(10)}, declared, dims)
        want = {("fact_x", "a_sk", 1000, 200, 20), ("fact_x", "b_sk", 1000, 0, 0), ("fact_y", "a_sk", 10, 0, 1), ("fact_y", "b_sk", 10, 10, 0)}
        assert {tuple(r) for r in got.collect()} == want
        exchanges = [n for n in nodes(got._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_value = [n for n in exchanges if "value#" in n.outputPartitioning().toString()]
    assert len(by_value) == 2


def test_keys_outlive_rebuilds(spark, folder):
    def rows(*r):
        return spark.createDataFrame(list(r), "a int, b string, v int")

    def assign(df):
        return {(r["a"], r["b"]): r["pk"] for r in KeyMap.of(spark, folder + "/keys", df, ["a", "b"], "pk").assign(df, T1).collect()}

    first = assign(rows((2, "x", 1), (1, None, 1), (None, None, 1), (2, "x", 5)))
    assert first == {(1, None): 1, (2, "x"): 2, (None, None): 3}
    second = assign(rows((0, "new", 1), (2, "x", 9)))
    assert second == {(2, "x"): 2, (0, "new"): 4}
    assert assign(rows((1, None, 7), (0, "new", 7))) == {(1, None): 1, (0, "new"): 4}


def test_carried_columns_are_pointed_anew(spark):
    def rows(*r):
        return spark.createDataFrame(list(r), "id int, sk int, v int")

    one = versioned.versioned_upsert(None, rows((1, 11, 1), (2, 12, 1), (3, 13, 1)), ["id"], ["v", "sk"], "pk", carried=["sk"])
    two = versioned.versioned_upsert(one, rows((1, 99, 1), (2, 98, 2)), ["id"], ["v", "sk"], "pk", carried=["sk"])
    got = sorted(map(tuple, two.select("pk", "id", "sk", "v", "fact_current_flag").collect()))
    assert got == [(1, 1, 99, 1, True), (2, 2, 12, 1, False), (3, 3, 13, 1, True), (4, 2, 98, 2, True)]
    with pytest.raises(ValueError, match="every part"):
        versioned.versioned_upsert(two, rows((None, 1, 1)), ["id"], ["v"], "pk")
    fit, bad = compare.split_bad_keys(rows((1, 1, 1), (1, 2, 2), (None, 3, 3), (4, 4, 4)), ["id"])
    assert [r["id"] for r in fit.collect()] == [4]
    assert sorted(r["reason"] for r in bad.collect()) == ["duplicate_key", "duplicate_key", "null_key"]


def test_facts_publish_their_rejects(spark, folder, monkeypatch):
    """Versioned and insert-only loads: rows without a key are rejects of the run, counted in its detail."""
    learner = [(1, 10, 0), (2, 20, 0), (2, 21, 0), (None, 30, 0)]
    made = spark.createDataFrame(learner, "learner_programme_id long, learner_programme_sk long, learner_fact_id long")
    paid = spark.createDataFrame([(1, 5, 1), (2, None, 1)], "learningprogramme_disbursement_fact_id long, learningprogrammedisbursement_id long, company_sk long")
    more = paid.union(spark.createDataFrame([(3, 6, 1)], paid.schema))
    monkeypatch.setitem(facts.BUILDERS, "fact_learner", lambda t: made)
    name = "fact_learningprogramme_disbursement"
    monkeypatch.setitem(facts.BUILDERS, name, lambda t: paid)
    n, detail = loads.load_fact(spark, folder, "fact_learner", None, T1)
    assert n == 1 and detail == "run 1; rejected duplicate_key: 2; rejected null_key: 1"
    assert star.VERSIONED["fact_learner"] == ("learner_programme_id",)
    loads.load_fact(spark, folder, name, None, T1)
    monkeypatch.setitem(facts.BUILDERS, name, lambda t: more)
    n, detail = loads.load_fact(spark, folder, name, None, T2)
    assert n == 3 and detail == "run 2; rejected null_key: 1"
    n, detail = loads.load_fact(spark, folder, name, None, T2)
    assert n == 3 and detail == "run 3; rejected null_key: 1"


def test_replaced_runs_are_retired(spark, folder):
    df = spark.range(3)
    table = RunTable(spark, folder + "/t", df.schema)
    for _ in range(3):
        table.replace(df, T1)
    assert table.retire() == 2 and table.read().count() == 3
    table.append(df, T1)
    assert table.retire() == 2 and table.read().count() == 6


def test_types_widen(spark):
    from pyspark.sql import types as T

    from lakemart.sources.sync import widened

    def both(a, b):
        x, y = (T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b))
        assert widened(x, y) == widened(y, x)
        return widened(x, y).simpleString()

    assert both("smallint", "bigint") == "bigint" and both("bigint", "float") == "double" and both("float", "double") == "double"
    assert both("decimal(10,2)", "int") == "decimal(12,2)" and both("decimal(38,2)", "bigint") == "decimal(38,2)" and both("decimal(38,30)", "bigint") == "string"
    assert both("date", "timestamp") == "timestamp" and both("date", "int") == "string" and both("timestamp", "timestamp_ntz") == "string"
    assert both("array<int>", "array<bigint>") == "array<bigint>" and both("struct<a:int>", "struct<a:string,b:int>") == "struct<a:string,b:int>"


def test_folders_one_level_deep(spark, folder):
    import os

    from lakemart.sources import sync

    spark.range(2).write.parquet(folder + "/raw/a")
    spark.range(2).selectExpr("cast(id as int) id").write.mode("append").parquet(folder + "/raw/a")
    spark.range(2).selectExpr("cast(id as string) id", "1 n").write.mode("append").parquet(folder + "/raw/a")
    os.makedirs(folder + "/raw/empty")
    os.makedirs(folder + "/raw/_temporary")
    assert sync.child_folders(spark, folder + "/raw") == ["a"]
    assert sorted(map(tuple, sync.landed_schemas(spark, folder + "/raw").collect())) == [("a", "id", "string"), ("a", "n", "int")]
