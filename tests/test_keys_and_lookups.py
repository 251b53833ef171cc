import datetime as dt
from contextlib import contextmanager

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.operators import bridge
from lakemart.operators.calendar import calendar, date_ids, status_dim, status_ids
from lakemart.operators.keys import continue_keys, dense_keys, max_key, position_in_group
from lakemart.operators.lookup import attach, lookup_by_candidates, lookup_sk


@contextmanager
def limits(spark, **conf):
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, hot):
    """A third of 300,000 rows shares one key (or NULL); twelve map tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id"))
    return spark.range(0, 300_000, 1, 12).select(key.alias("fk"), F.sha1(F.col("id").cast("string")).alias("pad"))


def test_hot_and_null_keys_are_split(spark):
    dim = spark.range(300_000).select("id", (F.col("id") + 1).alias("x_sk"))
    with limits(spark, **HOT):
        for hot in (7, None):
            found = lookup_sk(hot_rows(spark, hot), dim, "fk", "x_sk", "sk")
            rows, plan = final_plan(found.groupBy("sk").agg(F.count("*").alias("n"), F.max("pad").alias("pad")).orderBy(F.desc("n")))
            assert "skew=true" in plan
            assert rows[0]["n"] == 100_000 + (hot is not None)


def test_hot_group_is_spread_over_range_partitions(spark):
    df = hot_rows(spark, 7).select("fk", "pad")
    keyed = dense_keys(df, ["fk", "pad"], "sk", partitions=12)
    written = spark.read.parquet(*keyed.inputFiles())
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 300_000 and max(sizes) < 60_000


def test_dense_keys_equal_row_number_and_are_stable(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v")).repartition(16)
    keyed = dense_keys(df, ["k"], "sk", offset=5, partitions=6)
    got = {r["k"]: r["sk"] for r in keyed.collect()}
    assert got == {k: i + 6 for i, k in enumerate(sorted(got))}
    assert {r["k"]: r["sk"] for r in keyed.collect()} == got
    assert keyed.rdd.getNumPartitions() >= 1


def test_dense_keys_nulls_last_and_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert [tuple(r) for r in dense_keys(df, ["k"], "sk").orderBy("sk").collect()] == [("a", 1), ("b", 2), (None, 3)]
    assert dense_keys(df.where("FALSE"), ["k"], "sk").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60, unique=True))
def test_position_in_group_property(spark, pairs):
    df = spark.createDataFrame(pairs, "g int, v int")
    got = {(r["g"], r["v"]): r["p"] for r in position_in_group(df, ["g"], ["v"], "p").collect()}
    want = {}
    for g in {g for g, _ in pairs}:
        for i, v in enumerate(sorted(v for h, v in pairs if h == g)):
            want[(g, v)] = i + 1
    assert got == want


def test_continue_keys(spark):
    old = spark.createDataFrame([(1, 7)], "id int, sk bigint")
    assert max_key(old, "sk") == 7 and max_key(old.where("FALSE"), "sk") == 0
    new = continue_keys(spark.createDataFrame([(9,), (8,)], "id int"), old, ["id"], "sk")
    assert sorted(tuple(r) for r in new.collect()) == [(8, 8), (9, 9)]


def test_lookup_miss_null_and_not_current(spark):
    dim = spark.createDataFrame([(1, 10, True), (2, 20, False)], "id bigint, x_sk bigint, current_flag boolean")
    df = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    got = lookup_sk(df, dim, "fk", "x_sk", "sk").collect()
    assert sorted((r["fk"] is None, r["fk"] or 0, r["sk"]) for r in got) == [(False, 1, 10), (False, 2, None), (True, 0, None)]
    assert lookup_sk(df, dim, "absent", "x_sk", "sk").where("sk IS NULL").count() == 3


def test_attach_replaces_and_fans_out(spark):
    df = spark.createDataFrame([(1, "old")], "id int, v string")
    other = spark.createDataFrame([(1, "a"), (1, "b")], "id int, w string")
    assert sorted(r["v"] for r in attach(df, other, "id", {"w": "v"}).collect()) == ["a", "b"]


def test_candidates(spark):
    dim = spark.createDataFrame([(1, 10)], "id int, x_sk bigint")
    names = ["x_id", "x", "x_fk"]
    assert lookup_by_candidates(spark.createDataFrame([(1,)], "x int"), dim, names, "x_sk", "sk").first()["sk"] == 10
    assert lookup_by_candidates(spark.createDataFrame([(4,)], "y int"), dim, names, "x_sk", "sk").first()["sk"] == 0
    assert lookup_by_candidates(spark.createDataFrame([(4,)], "x_sk int"), dim, names, "x_sk", "sk").first()["sk"] == 4


def test_date_ids(spark):
    days = calendar(spark, "2024-02-28", "2024-03-01")
    assert [r["date_id"] for r in days.orderBy("date_id").collect()] == [20240228, 20240229, 20240301]
    df = spark.createDataFrame(
        [(dt.datetime(2024, 2, 29, 23, 59),), (None,), (dt.datetime(2025, 1, 1),)], "at timestamp_ntz"
    )
    got = date_ids(df, days, {"at": "at_id", "gone": "gone_id"}).collect()
    assert sorted((r["at_id"], r["gone_id"]) for r in got) == [(0, 0), (0, 0), (20240229, 0)]
    twice = days.unionByName(days)
    assert date_ids(df, twice, {"at": "at_id"}).count() == 3


def test_status_ids(spark):
    df = spark.createDataFrame([(" Approved ",), ("what",), (None,), ("CLOSED",)], "s string")
    known = status_dim([("d", spark.createDataFrame([("approved",), ("Approved",), ("closed",)], "s string"), "s")])
    assert known.count() == 2
    known = known.withColumn("current_flag", F.col("status_nk") != "closed")
    got = {r["s"]: r["id"] for r in status_ids(df, known, "s", "id", "d").collect()}
    assert got == {" Approved ": 1, "what": 0, None: 0, "CLOSED": 0}
    assert status_ids(df, known, "s", "id", "other").where("id <> 0").count() == 0


def test_ordered_members(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 5, t), (1, 4, t), (1, 9, None), (1, 4, t), (1, 1, t + dt.timedelta(1)), (2, 3, t)]
    df = spark.createDataFrame(rows, "p int, m bigint, at timestamp")
    got = {r["p"]: r["ms"] for r in bridge.ordered_members(df, "p", "m", "at", "ms").collect()}
    assert got == {1: [9, 4, 5, 1], 2: [3]}
    rows = bridge.bridge_rows(df, "p", "m", ["at"]).where("p = 1").orderBy("position")
    # As rows, a missing order value comes last.
    assert [r["m"] for r in rows.collect()] == [4, 5, 1, 9]


def test_role_array_gaps_and_repeats(spark):
    df = spark.createDataFrame([(1, 7, None, 7, 3), (2, None, None, None, None)], "k int, a int, b int, c int, d int")
    dim = spark.createDataFrame([(7, 70), (3, 30)], "id int, sk bigint")
    got = {r["k"]: r["sks"] for r in bridge.role_array(df, ["k"], ["a", "b", "c", "d"], dim, "sk", "sks").collect()}
    assert got == {1: [70, 70, 30], 2: []}
    double = spark.createDataFrame([(7, 70), (7, 71), (3, 30)], "id int, sk bigint")
    repeated = df.unionByName(df.where("k = 1"))
    for limit in ("-1", "10m"):
        with limits(spark, **{"spark.sql.autoBroadcastJoinThreshold": limit}):
            twice = bridge.role_array(repeated, ["k"], ["a", "b", "c", "d"], double, "sk", "sks").collect()
        assert sorted((r["k"], r["sks"]) for r in twice) == [(1, [71, 71, 30]), (1, [71, 71, 30]), (2, [])]
    with limits(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        large = bridge.role_array(df, ["k"], ["a", "b", "c", "d"], dim, "sk", "sks")
        assert {r["k"]: r["sks"] for r in large.collect()} == got


def test_milestones_with_null_parts(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, "A", t), (1, 1, "B", None), (1, None, "A", t), (2, 1, "C", t)]
    df = spark.createDataFrame(rows, "p int, q int, s string, at timestamp")
    got = {(r["p"], r["q"]): (r["first"], r["a"]) for r in bridge.milestones(df, ["p", "q"], "s", "at", "first", {"A": "a"}).collect()}
    assert got == {(1, 1): (None, t), (1, None): (t, None), (2, 1): (t, None)}
