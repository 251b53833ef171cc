import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import is_file_like
from lakemart.operators import profile, quality, shape


def test_natural_key_and_schema():
    assert shape.natural_key(["x", "id", "t_id"], "t") == "id"
    assert shape.natural_key(["x", "t_id"], "t") == "t_id"
    assert shape.natural_key(["x"], "t") is None
    with pytest.raises(ValueError):
        shape.dim_schema(T.StructType([T.StructField("x", T.LongType())]), "t")
    assert shape.dim_name("orders") == "dim_orders"
    assert shape.dim_name("orders", {"orders": "dim_o"}) == "dim_o"


def test_clamp(spark):
    rows = [(dt.date(1582, 10, 14), dt.datetime(1899, 12, 31, 23, 59, 59)), (dt.date(1582, 10, 15), dt.datetime(1900, 1, 1))]
    df = spark.createDataFrame(rows, "d date, n timestamp_ntz").withColumn("t", F.col("n").cast("timestamp"))
    got = shape.clamp_ancient(df).select("d", "n", F.col("t").cast("string").alias("t")).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (dt.date(1582, 10, 15), dt.datetime(1900, 1, 1), "1900-01-01 00:00:00")]


def test_conform(spark):
    target = shape.dim_schema(T.StructType.fromDDL("id bigint, amount int, day date, gone string"), "t")
    raw = spark.createDataFrame([("5", "abc", "2024-13-01", 1), ("6", "7", "2024-12-01", 1)], "id string, amt string, day string, extra int")
    got = shape.conform(raw, target, "t", aliases={"amt": "amount"}).collect()
    assert [tuple(r) for r in got] == [(5, None, None, None), (6, 7, dt.date(2024, 12, 1), None)]


def test_fill_and_project(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None)], "i int, s string, b boolean, a array<bigint>, d date, m decimal(5,2)"
    )
    row = shape.fill_nulls(df).first()
    assert tuple(row) == (0, "N/A", False, [], None, 0)
    fields = T.StructType.fromDDL("x_fact_id bigint, i bigint, when_date_id int, x_sks array<bigint>, y_sk bigint")
    assert tuple(shape.project_fact(df, fields).first()) == (0, 0, 0, [], 0)


@pytest.mark.parametrize(
    "value, expected",
    [("a.PDF", True), ("x.docx?v=1", True), ("y.png#p", True), ("pdf", False), ("a.pdf.bak", False), ("", False), (None, False)],
)
def test_file_like(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(is_file_like(F.col("v"))).first()[0] is expected


def test_thresholds(spark):
    def share(hits):
        return F.when(F.col("id") < hits, F.lit("f.pdf")).otherwise(F.lit("text"))

    df = spark.range(1000).select(
        "id", share(4).alias("contract_doc"), share(5).alias("contract_doc2"), share(49).alias("note"), share(50).alias("note2"),
        F.lit("  ").alias("blank"), F.lit("plain").alias("forced"), share(4).alias("Platform"), share(5).alias("Platform2"),
    )
    keep, dropped, rows = profile.split_columns(df, force_drop=["FORCED"])
    assert dropped == ["contract_doc2", "note2", "forced", "Platform2"] and rows == 1000
    assert "blank" in keep
    assert profile.split_columns(df.where("FALSE"))[2] == 0
    assert profile.is_suspicious("platform") and not profile.is_suspicious("amount")


def test_profile_counts(spark):
    df = spark.createDataFrame(
        [("a", float("nan"), None), ("  ", 1.0, 1), (None, None, 2)], "s string, f double, i int"
    )
    got = {r["column"]: (r["n_rows"], r["n_filled"]) for r in profile.profile_columns(df).collect()}
    assert got == {"s": (3, 1), "f": (3, 1), "i": (3, 2)}


def test_reconcile(spark):
    source = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id int, v string")
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (5, "e")], "id int, v string")
    found = quality.reconcile(source, target, ["id"])
    assert sorted(tuple(r) for r in found.collect()) == [(3, "mismatch"), (4, "missing_target"), (5, "missing_source")]
    nulls = source.unionByName(spark.createDataFrame([(None, "a"), (None, "a")], source.schema))
    assert quality.reconcile(nulls, target, ["id"]).where("id IS NULL AND kind = 'missing_target'").count() == 2
    verdict = quality.reconcile_verdict(found, limit=2).first()
    assert tuple(verdict) == (1, 1, 1, 0, True)
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (2, None)], "id int, v string")
    assert quality.reconcile(twice, twice, ["id"]).count() == 0
    other = quality.reconcile(twice, twice.dropDuplicates(), ["id"]).collect()
    assert sorted(tuple(r) for r in other) == [(1, "duplicate_key"), (2, "duplicate_key")]


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (None, 6), (2, None)], "k int, fk int")
    got = {r["check"]: r["n_bad"] for r in quality.key_check(df, ["k"], "t").collect()}
    assert got == {"pk_duplicate": 1, "pk_null": 1}
    parent = spark.createDataFrame([(5,)], "sk int")
    got = {r["check"]: r["n_bad"] for r in quality.reference_check(df, "t", [("fk", parent, "sk")]).collect()}
    assert got == {"fk_orphan:fk": 1, "fk_unknown:fk": 1}


def test_casts(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("abc", "2024-13-01"), (None, None)], "n string, d string")
    good, bad = quality.split_casts(df, {"n": "bigint", "d": "date"})
    assert good.count() == 2 and dict(good.dtypes) == {"n": "bigint", "d": "date"}
    assert bad.first()["bad_columns"] == ["n", "d"] and bad.first()["n"] == "abc"
    report = quality.cast_failures(df, {"n": "bigint", "d": "date"}, limit=1).collect()
    assert {r["column"]: (r["n_failed"], r["suspended"]) for r in report} == {"n": (1, False), "d": (1, False)}


def test_lobs(spark):
    df = spark.createDataFrame([("é" * 1025, bytearray(b"x" * 1025)), ("ok", None)], "t string, b binary")
    got = quality.limit_lobs(df, ["t", "b"], limit_kb=1).collect()
    assert (len(got[0]["t"]), len(got[0]["b"]), got[0]["t_size"], got[0]["t_over_limit"], got[0]["b_over_limit"]) == (1025, 1025, 1025, True, True)
    assert (got[1]["t"], got[1]["b"], got[1]["b_size"], got[1]["t_over_limit"], got[1]["b_over_limit"]) == ("ok", None, None, False, False)


def test_scalar_to_array(spark):
    df = spark.createDataFrame([(1, 5)], "k int, sk bigint")
    new = shape.scalar_to_array(df, "sk", "sks")
    assert new.columns == ["k", "sks"] and new.first()["sks"] == [5]
    assert shape.scalar_to_array(new, "sk", "sks").columns == ["k", "sks"]
