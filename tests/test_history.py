import math

import pytest
from pyspark.sql import functions as F

from lakemart.operators import compare, scd2, shape, versioned
from lakemart.sources.runs import DimensionTable, RunTable
from lakemart.streaming import changes

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
STAGE = "id int, name string, score double"


@pytest.fixture
def dim(spark):
    schema = shape.dim_schema(spark.createDataFrame([], STAGE).schema, "thing")
    return schema, scd2.Dimension.of(schema.names, "thing")


def stage(spark, *rows):
    return spark.createDataFrame(list(rows), STAGE)


def by_version(table):
    return {
        (r["id"], r["version"]): (r["name"], r["current_flag"], str(r["effective_to"]))
        for r in table.collect()
    }


def test_matrix(spark, dim):
    schema, d = dim
    nan = math.nan
    first = scd2.scd2_apply(
        spark.createDataFrame([], schema),
        stage(spark, (1, "same", nan), (2, "old", 1.0), (3, "gone", 1.0), (5, "x", None)), d, T1,
    )
    second = scd2.scd2_apply(
        first, stage(spark, (1, "same", nan), (2, "new", 1.0), (4, "fresh", 1.0), (5, "x", 0.0)), d, T2
    )
    third = scd2.scd2_apply(second, stage(spark, (1, "same", nan), (2, "new", 1.0), (3, "gone", 1.0), (4, "fresh", 1.0), (5, "x", 0.0)), d, T3)
    got = by_version(third)
    end = "9999-12-31 23:59:59"
    assert got == {
        (1, 1): ("same", True, end),
        (2, 1): ("old", False, T2),
        (2, 2): ("new", True, end),
        (3, 1): ("gone", False, T2),
        (3, 2): ("gone", True, end),
        (4, 1): ("fresh", True, end),
        (5, 1): ("x", False, T2),
        (5, 2): ("x", True, end),
    }
    keys = sorted(r["thing_sk"] for r in third.collect())
    assert keys == list(range(1, 9))
    assert by_version(scd2.scd2_apply(third, third.where("current_flag").select("id", "name", "score"), d, T3)) == got


def test_bad_keys_leave_the_dimension_alone(spark, dim):
    schema, d = dim
    first = scd2.scd2_apply(spark.createDataFrame([], schema), stage(spark, (1, "a", 1.0), (2, "b", 1.0)), d, T1)
    bad = stage(spark, (1, "p", 1.0), (1, "q", 1.0), (None, "n", 1.0), (2, "b", 1.0), (7, "r", 1.0), (7, "r", 1.0))
    assert by_version(scd2.scd2_apply(first, bad, d, T2)) == by_version(first)
    reasons = compare.bad_key_rows(bad, ["id"]).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in reasons} == {"null_key": 1, "duplicate_key": 4}


def test_repair(spark, dim):
    schema, d = dim
    first = scd2.scd2_apply(spark.createDataFrame([], schema), stage(spark, (1, "a", 1.0)), d, T1)
    second = scd2.scd2_apply(first, stage(spark, (1, "b", 1.0)), d, T2).withColumn("current_flag", F.lit(True))
    got = by_version(scd2.repair_one_current(second, d, T3))
    assert got[(1, 1)] == ("a", False, T3)
    assert got[(1, 2)][1] is True


def test_sig_hash_and_reserved_names(spark):
    schema = shape.dim_schema(spark.createDataFrame([], "id int, version int, note string").schema, "thing")
    assert schema.names[:4] == ["id", "version_src", "note", "thing_sk"]
    d = scd2.Dimension.of(schema.names, "thing", sig_hash=True)
    raw = spark.createDataFrame([(1, 3, None), (2, 3, "")], "id int, version int, note string")
    table = scd2.scd2_apply(spark.createDataFrame([], schema), shape.conform(raw, schema, "thing"), d, T1)
    assert table.select("sig_hash").distinct().count() == 2
    assert {r["version_src"] for r in table.collect()} == {3}


def test_published_runs_equal_in_memory(spark, dim, folder):
    schema, d = dim
    table = DimensionTable(spark, folder + "/dim", schema)
    memory = spark.createDataFrame([], schema)
    loads = [[(1, "a", 1.0), (2, "b", 1.0)], [(1, "a", 2.0), (3, "c", 1.0)], [(1, "a", 2.0), (2, "b", 1.0)]]
    for rows, at in zip(loads, (T1, T2, T3)):
        assert table.load(stage(spark, *rows), d, at) >= 1
        memory = scd2.scd2_apply(memory, stage(spark, *rows), d, at)
    assert by_version(table.read()) == by_version(memory)
    assert table.current().where("NOT current_flag").isEmpty()
    assert table.history().where("current_flag").isEmpty()
    assert table.current().count() + table.history().count() == memory.count()


def test_unpublished_run_is_not_read(spark, dim, folder):
    schema, d = dim
    table = DimensionTable(spark, folder + "/dim", schema)
    table.load(stage(spark, (1, "a", 1.0)), d, T1)
    leftovers = scd2.scd2_changes(table.current(), stage(spark, (1, "z", 1.0)), d, T2).withColumn("_bucket", F.lit(0))
    table.write(leftovers, "rows", 2, "_kind", "_bucket")
    assert by_version(table.read()) == {(1, 1): ("a", True, "9999-12-31 23:59:59")}
    table.load(stage(spark, (1, "b", 1.0)), d, T3)
    assert by_version(table.read()) == {
        (1, 1): ("a", False, T3), (1, 2): ("b", True, "9999-12-31 23:59:59")
    }


def test_run_table_replace_reads_itself(spark, folder):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    table = RunTable(spark, folder + "/t", df.schema)
    assert not table.exists() and table.read().count() == 0
    table.replace(df, T1)
    table.append(df, T2)
    assert sorted(r["v"] for r in table.read().collect()) == [1, 1, 2, 2]
    table.replace(table.read().where("v = 1"), T3)
    assert [r["v"] for r in table.read().collect()] == [1, 1]


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), "op string, seq int, id int, name string, score double")


def test_change_feed(spark, folder):
    schema = shape.dim_schema(spark.createDataFrame([], "id int, seq int, name string, score double").schema, "thing")
    d = scd2.Dimension.of(schema.names, "thing", carried=["seq"])
    table = DimensionTable(spark, folder + "/dim", schema)
    changes.apply_batch(table, d, feed(spark, ("I", 1, 1, "a", 1.0), ("U", 3, 1, "b", 1.0), ("I", 2, 2, "x", 1.0)), 0, T1)
    # Stale for key 1, unchanged but newer for key 2, new key 3.
    batch = feed(spark, ("U", 2, 1, "late", 1.0), ("U", 5, 2, "x", 1.0), ("I", 4, 3, "n", 1.0))
    changes.apply_batch(table, d, batch, 1, T2)
    changes.apply_batch(table, d, batch, 1, T3)
    # Between the two sequences of key 2: stale although its row did not change; key 3 goes.
    changes.apply_batch(table, d, feed(spark, ("U", 4, 2, "y", 1.0), ("D", 9, 3, None, None)), 2, T3)
    # After the delete, an older change is stale and a newer one opens the next version.
    changes.apply_batch(table, d, feed(spark, ("U", 8, 3, "older", 1.0)), 3, T3)
    got = by_version(table.read())
    end = "9999-12-31 23:59:59"
    assert got == {(1, 1): ("b", True, end), (2, 1): ("x", True, end), (3, 1): ("n", False, T3)}
    changes.apply_batch(table, d, feed(spark, ("I", 10, 3, "back", 1.0)), 4, T3)
    assert by_version(table.read())[(3, 2)][0] == "back"


FACT = "k int, v int"


def test_versioned(spark):
    def rows(*r):
        return spark.createDataFrame(list(r), FACT)

    one = versioned.versioned_upsert(None, rows((2, 1), (1, None), (3, 1)), ["k"], ["v"], "pk")
    two = versioned.versioned_upsert(one, rows((1, None), (2, 5), (4, 1)), ["k"], ["v"], "pk")
    got = sorted((r["k"], r["pk"], r["v"], r["fact_current_flag"]) for r in two.select("k", "pk", "v", "fact_current_flag").na.fill(-1).collect())
    assert got == [(1, 1, -1, True), (2, 2, 1, False), (2, 4, 5, True), (3, 3, 1, True), (4, 5, 1, True)]
    with pytest.raises(ValueError):
        versioned.versioned_upsert(two, rows((1, 1), (1, 2)), ["k"], ["v"], "pk")
    with pytest.raises(ValueError):
        versioned.versioned_upsert(None, rows((1, 1), (1, 2)), ["k"], ["v"], "pk")


def test_insert_only(spark):
    new = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], "pk bigint, bid bigint, v string")

    def after(existing):
        return sorted(tuple(r) for r in versioned.insert_only(existing, new, "bid", "pk").collect())

    whole = sorted(tuple(r) for r in new.collect())
    empty = spark.createDataFrame([], new.schema)
    zeros = spark.createDataFrame([(0, 10, "z")], new.schema)
    assert after(None) == after(empty) == after(zeros) == after(zeros.drop("pk")) == whole
    partly = spark.createDataFrame([(7, 20, "kept")], new.schema)
    assert after(partly) == [(7, 20, "kept"), (8, 10, "a"), (9, 30, "c")]


# ---- delta-sized loads -----------------------------------------------------------


def bytes_of(path, part):
    import os

    return {
        os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f))
        for d, _, names in os.walk(f"{path}/{part}")
        for f in names
        if f.endswith(".parquet")
    }


def things(spark, changed=(), without=(), n=400):
    rows = [(i, f"n{i}" + ("!" if i in changed else ""), float(i)) for i in range(n) if i not in without]
    return spark.createDataFrame(rows, STAGE)


def test_loads_write_the_buckets_of_their_delta(spark, dim, folder):
    schema, d = dim
    path = folder + "/dim"
    table = DimensionTable(spark, path, schema)
    table.load(things(spark), d, T1, buckets=16)
    first = {part: bytes_of(path, part) for part in ("rows", "new")}
    for _ in range(3):  # nothing changed: no row, no byte
        run = table.load(things(spark), d, T2)
        assert table.written(run).count() == 0
        assert {part: bytes_of(path, part) for part in ("rows", "new")} == first
    run = table.load(things(spark, changed={7}, without={9}), d, T3)
    touched = {r["bucket"] for r in table.written(run).collect()}
    assert len(touched) in (1, 2)
    assert table.current().count() == 399 and table.history().count() == 2
    got = by_version(table.read())
    assert got[(7, 2)] == ("n7!", True, "9999-12-31 23:59:59") and got[(7, 1)][1:] == (False, T3) and got[(9, 1)][1:] == (False, T3)
    # A returning key finds its version in the closed rows of its bucket.
    table.load(things(spark, changed={7}), d, T3)
    assert by_version(table.read())[(9, 2)][1] is True
    assert sorted(r["thing_sk"] for r in table.read().collect()) == list(range(1, 403))


def test_equal_digests_are_enough_to_leave_a_row(spark, dim, folder):
    """Unchanged rows are read as key and digests: the plan of the delta asks for three columns of the current rows."""
    schema, d = dim
    table = DimensionTable(spark, folder + "/dim", schema)
    table.load(things(spark), d, T1, buckets=4)
    current = table._current(table.places(table.last()))
    plan = table.delta(things(spark, changed={3}), d, current)._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert reads and all("ReadSchema: struct<id:int,_d1:bigint,_d2:bigint>" in line for line in reads)
    assert [tuple(r) for r in table.delta(things(spark, changed={3}), d, current).collect()] == [(3, "touched")]


def test_tables_that_outgrow_their_buckets_are_split(spark, dim, folder, monkeypatch):
    from lakemart.sources import runs

    schema, d = dim
    table = DimensionTable(spark, folder + "/dim", schema)
    memory = scd2.scd2_apply(spark.createDataFrame([], schema), things(spark, n=50), d, T1)
    table.load(things(spark, n=50), d, T1, buckets=1)
    table.load(things(spark, changed={1}, without={2}, n=60), d, T2)
    memory = scd2.scd2_apply(memory, things(spark, changed={1}, without={2}, n=60), d, T2)
    monkeypatch.setattr(runs, "BUCKET_KEYS", 10)
    table.load(things(spark, n=90), d, T3)
    memory = scd2.scd2_apply(memory, things(spark, n=90), d, T3)
    assert table.last()["buckets"] == 4
    assert by_version(table.read()) == by_version(memory)
    table.load(things(spark, without={1}, n=90), d, T3)
    assert len({r["bucket"] for r in table.written(4).collect()}) == 1
    assert by_version(table.read()) == by_version(scd2.scd2_apply(memory, things(spark, without={1}, n=90), d, T3))


def test_retired_runs_leave_the_last_ones(spark, dim, folder):
    schema, d = dim
    path = folder + "/dim"
    table = DimensionTable(spark, path, schema)
    for i, at in enumerate((T1, T2, T3)):
        table.load(things(spark, changed={i}), d, at, buckets=8)
    before, held = by_version(table.read()), sum(len(bytes_of(path, p)) for p in ("rows", "new"))
    assert table.retire(keep=2) > 0
    assert by_version(table.read()) == before
    assert sum(len(bytes_of(path, p)) for p in ("rows", "new")) < held
    table.retire(keep=1)
    assert table.retire(keep=1) == 0
    table.load(things(spark), d, T3)
    assert by_version(table.read())[(2, 3)][1] is True


def feed_table(spark, folder):
    schema = shape.dim_schema(spark.createDataFrame([], "id int, seq int, name string, score double").schema, "thing")
    return DimensionTable(spark, folder + "/dim", schema), scd2.Dimension.of(schema.names, "thing", carried=["seq"])


def test_a_one_key_batch_reads_one_bucket(spark, folder, monkeypatch):
    table, d = feed_table(spark, folder)
    rows = [("I", i, i, f"n{i}", 1.0) for i in range(200)]
    schema = shape.dim_schema(spark.createDataFrame([], "id int, seq int, name string, score double").schema, "thing")
    table.load(spark.createDataFrame([], "id int, seq int, name string, score double"), d, T1, buckets=16)
    changes.apply_batch(table, d, feed(spark, *rows), 0, T1)
    reads = []
    at = DimensionTable._at

    def seen(self, part, wanted, places, only):
        reads.append((part, only))
        return at(self, part, wanted, places, only)

    monkeypatch.setattr(DimensionTable, "_at", seen)
    run = changes.apply_batch(table, d, feed(spark, ("U", 999, 7, "new", 2.0)), 1, T2)
    assert reads and all(only is not None and len(only) == 1 for _, only in reads)
    assert {r["bucket"] for r in table.written(run).collect()} == set().union(*(only for _, only in reads))
    monkeypatch.undo()
    assert by_version(table.read())[(7, 2)][0] == "new" and table.current().count() == 200
    assert schema == table.schema


def test_feed_rejects_and_state(spark, folder):
    table, d = feed_table(spark, folder)
    run = changes.apply_batch(
        table, d, feed(spark, ("I", 5, 1, "a", 1.0), ("U", None, 1, "no seq", 1.0), ("I", 6, None, "no key", 1.0), ("D", 9, 2, None, None)), 0, T1
    )
    assert sorted((r["id"] or 0, r["name"], r["reason"]) for r in table.rejects(run).collect()) == [(0, "no key", "null_key"), (1, "no seq", "null_seq")]
    run = changes.apply_batch(table, d, feed(spark, ("U", None, 1, "again", 1.0), ("I", 8, 2, "before its delete", 1.0)), 1, T2)
    assert [r["name"] for r in table.rejects(run).collect()] == ["again"]
    assert by_version(table.read()) == {(1, 1): ("a", True, "9999-12-31 23:59:59")}
    state = table._at("state", changes.state_schema(table.schema, "id"), table.places(table.last()), None)
    assert sorted(tuple(r) for r in state.collect()) == [(1, 5, False), (2, 9, True)]


# ---- repair and schema changes -----------------------------------------------------


def test_loads_repair_keys_with_several_current_rows(spark, dim, folder):
    schema, d = dim
    table = DimensionTable(spark, folder + "/dim", schema)
    table.load(things(spark, n=60), d, T1, buckets=4)
    table.load(things(spark, changed={5}, n=60), d, T2)
    assert table.repair(d, T3) == 0 and table.last()["run"] == 2
    # A stray file brings the closed version of key 5 back as current.
    places = table.places(table.last())
    bucket = table.written(2).where("part = 'new' AND n > 0").first()["bucket"]
    at = places[("kept", bucket)][0]
    stray = table.history().withColumn("current_flag", F.lit(True)).withColumn("_d1", F.lit(0).cast("long")).withColumn("_d2", F.lit(0).cast("long"))
    stray.write.mode("append").parquet(f"{folder}/dim/rows/run={at}/_kind=kept/_bucket={bucket}")
    assert table.current().where("id = 5").count() == 2
    assert table.repair(d, T3) == 1
    assert [r["version"] for r in table.current().where("id = 5").collect()] == [2]
    assert table.current().count() == 60 and {r["bucket"] for r in table.written(3).collect()} == {bucket}
    table.load(things(spark, n=60), d, T3)
    assert [r["version"] for r in table.current().where("id = 5").collect()] == [3]


def test_intervals(spark, dim):
    schema, d = dim
    end = "9999-12-31 23:59:59"
    rows = [
        (1, "a", 1.0, 1, None, T1, T3, False, 1), (1, "b", 1.0, 2, None, T2, end, True, 2),  # overlap
        (2, "a", 1.0, 3, None, T1, end, True, 1), (2, "b", 1.0, 4, None, T2, end, True, 2),  # two current
        (3, "a", 1.0, 5, None, T1, T2, False, 1), (3, "b", 1.0, 6, None, T3, end, True, 2),  # away for a day
        (4, "a", 1.0, 7, None, T1, end, False, 1), (5, "a", 1.0, 8, None, T2, T1, False, 1),
    ]
    text = "id int, name string, score double, thing_sk bigint, sig_hash bigint, f string, t string, current_flag boolean, version bigint"
    table = spark.createDataFrame(rows, text).withColumn("effective_from", F.col("f").cast("timestamp")).withColumn("effective_to", F.col("t").cast("timestamp"))
    table = table.select(*schema.names)
    faults = {(r["id"], r["version"]): r["fault"] for r in scd2.interval_faults(table, d).collect()}
    assert faults == {(1, 1): "overlap", (2, 1): "not_last_current", (4, 1): "closed_last", (5, 1): "empty"}
    fixed = scd2.repair_intervals(table, d, T3)
    assert scd2.interval_faults(fixed, d).count() == 0
    assert by_version(fixed) == {
        (1, 1): ("a", False, T2), (1, 2): ("b", True, end), (2, 1): ("a", False, T2), (2, 2): ("b", True, end),
        (3, 1): ("a", False, T2), (3, 2): ("b", True, end), (4, 1): ("a", False, T3), (5, 1): ("a", False, T2),
    }


def test_tables_whose_schema_changes(spark, folder):
    from lakemart.sources.runs import EvolvingTable

    one = spark.createDataFrame([(1, 10), (2, None)], "id int, sk bigint")
    table = EvolvingTable(spark, folder + "/t", one.schema)
    assert table.read().columns == ["id", "sk"] and table.read().count() == 0
    table.append(one, T1)
    written = bytes_of(folder + "/t", "data")
    assert table.migrate({"sks": "array(sk)"}, drop=["sk"], legacy="t_single") == 2
    assert bytes_of(folder + "/t", "data") == written  # nothing is written again
    table.append(spark.createDataFrame([(3, [1, 2])], "id int, sks array<bigint>"), T2)
    assert table.migrate({"n": "size(sks)"}) == 3
    got = {r["id"]: (r["sks"], r["n"]) for r in table.read().collect()}
    assert got == {1: ([10], 1), 2: ([None], 1), 3: ([1, 2], 2)}
    assert sorted(map(tuple, table.read_legacy("t_single").collect())) == [(1, 10), (2, None)]
    with pytest.raises(ValueError, match="already names"):
        table.migrate({}, legacy="t_single")
    with pytest.raises(ValueError, match="no older schema"):
        table.read_legacy("other")
    table.replace(table.read().where("id = 3"), T3)
    assert [r["id"] for r in table.read().collect()] == [3]
    assert table.read_legacy("t_single").count() == 2


def test_feeds_split_rows_and_state_together(spark, folder, monkeypatch):
    from lakemart.sources import runs

    table, d = feed_table(spark, folder)
    rows = [("I", i, i, f"n{i}", 1.0) for i in range(80)]
    changes.apply_batch(table, d, feed(spark, *rows, ("D", 900, 500, None, None)), 0, T1)
    assert table.last()["buckets"] == 1
    monkeypatch.setattr(runs, "BUCKET_KEYS", 10)
    changes.apply_batch(table, d, feed(spark, ("U", 901, 3, "new", 1.0)), 1, T2)
    assert table.last()["buckets"] == 8
    state = table._at("state", changes.state_schema(table.schema, "id"), table.places(table.last()), None)
    assert state.count() == 81 and table.current().count() == 80
    # The state of before still tells what is stale, in the new buckets.
    changes.apply_batch(table, d, feed(spark, ("I", 899, 500, "before its delete", 1.0), ("U", 2, 3, "stale", 1.0), ("U", 902, 4, "x", 1.0)), 2, T3)
    got = by_version(table.read())
    assert (500, 1) not in got and got[(3, 2)][0] == "new" and got[(4, 2)][0] == "x" and (3, 3) not in got
