"""Type-2 loads, change feeds and key numbering over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.checks.inputs import moment, moment_sql, read
from lakemart.functions.columns import OPEN_END
from lakemart.operators import compare, scd2, shape
from lakemart.operators.keys import dense_keys, position_in_group
from lakemart.session import scratch_path
from lakemart.sources.runs import DimensionTable
from lakemart.streaming import changes

# ---- the two states of the customer table -----------------------------------

DAY1 = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer"
# Second day: part of a segment is gone, balances move or become unknown by
# nation, and every supplier arrives as a new customer.
DAY2 = """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id,
  CASE WHEN c_nationkey < 3 THEN c_acctbal + 1 WHEN c_nationkey > 22 THEN NULL ELSE c_acctbal END AS balance,
  c_mktsegment AS segment
FROM customer WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 4000)
UNION ALL
SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier"""
LOAD_TIMES = ["2024-03-01 00:00:00", "2024-03-02 00:00:00", "2024-03-03 00:00:00", "2024-03-04 00:00:00"]
BUSINESS = ["name", "nation_id", "balance", "segment"]
SOURCE = "customer"


def states(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    found = {}
    for name, sql in (("day1", DAY1), ("day2", DAY2)):
        found[name] = spark.sql(
            sql.replace("FROM customer", "FROM {customer}").replace("FROM supplier", "FROM {supplier}"),
            customer=read(spark, sf_dir, "customer"),
            **({"supplier": read(spark, sf_dir, "supplier")} if "supplier" in sql else {}),
        )
    return found


def empty_dim(spark: SparkSession, stage: DataFrame, source: str = SOURCE):
    schema = shape.dim_schema(stage.schema, source)
    return spark.createDataFrame([], schema), scd2.Dimension.of(schema.names, source)


def after_loads(spark: SparkSession, sf_dir: str, loads: list[str]) -> tuple[DataFrame, scd2.Dimension]:
    stages = states(spark, sf_dir)
    table, dim = empty_dim(spark, stages["day1"])
    for stage, at in zip(loads, LOAD_TIMES):
        table = scd2.scd2_apply(table, stages[stage], dim, at)
    return table, dim


def shown(table: DataFrame) -> DataFrame:
    return table.select(
        "id", *BUSINESS, "customer_sk", moment("effective_from").alias("effective_from"),
        moment("effective_to").alias("effective_to"), "current_flag", "version",
    )


def loads_sql(loads: list[str]) -> str:
    """The same loads as sequential close and insert statements; table is t0..tn."""
    parts = [
        f"day1 AS ({DAY1})",
        f"day2 AS ({DAY2})",
        "t0 AS (SELECT *, CAST(0 AS BIGINT) AS customer_sk, CAST(NULL AS TIMESTAMP) AS effective_from, "
        "CAST(NULL AS TIMESTAMP) AS effective_to, FALSE AS current_flag, CAST(0 AS BIGINT) AS version FROM day1 WHERE FALSE)",
    ]
    business = ", ".join(BUSINESS)
    for i, (stage, at) in enumerate(zip(loads, LOAD_TIMES), 1):
        same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in BUSINESS)
        closes = f"t.current_flag AND (s.id IS NULL OR NOT ({same}))"
        parts.append(
            f"old{i} AS (SELECT t.id, {', '.join('t.' + c for c in BUSINESS)}, t.customer_sk, t.effective_from, "
            f"CASE WHEN {closes} THEN TIMESTAMP '{at}' ELSE t.effective_to END AS effective_to, "
            f"t.current_flag AND NOT ({closes}) AS current_flag, t.version "
            f"FROM t{i - 1} t LEFT JOIN {stage} s ON t.id = s.id)"
        )
        parts.append(
            f"ins{i} AS (SELECT s.id, {', '.join('s.' + c for c in BUSINESS)}, "
            f"(SELECT coalesce(max(customer_sk), 0) FROM t{i - 1}) + row_number() OVER (ORDER BY s.id) AS customer_sk, "
            f"TIMESTAMP '{at}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag, "
            f"CAST(coalesce(v.top, 0) + 1 AS BIGINT) AS version FROM {stage} s "
            f"LEFT JOIN (SELECT * FROM t{i - 1} WHERE current_flag) t ON t.id = s.id "
            f"LEFT JOIN (SELECT id, max(version) AS top FROM t{i - 1} GROUP BY id) v ON v.id = s.id "
            f"WHERE t.id IS NULL OR NOT ({same}))"
        )
        parts.append(f"t{i} AS (SELECT * FROM old{i} UNION ALL SELECT * FROM ins{i})")
    return "WITH " + ",\n".join(parts)


SHOWN_SQL = (
    f"id, {', '.join(BUSINESS)}, customer_sk, {moment_sql('effective_from')} AS effective_from, "
    f"{moment_sql('effective_to')} AS effective_to, current_flag, version"
)


def loaded(*loads: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(after_loads(spark, sf_dir, list(loads))[0])

    return run


def loaded_sql(*loads: str, where: str = "TRUE") -> str:
    return f"{loads_sql(list(loads))}\nSELECT {SHOWN_SQL} FROM t{len(loads)} WHERE {where}"


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = after_loads(spark, sf_dir, ["day1", "day2"])
    return shown(table.where("current_flag"))


def scd2_change_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = states(spark, sf_dir)
    _, dim = empty_dim(spark, stages["day1"])
    return scd2.change_kinds(stages["day1"], stages["day2"], dim)


CHANGE_KINDS_SQL = f"""WITH day1 AS ({DAY1}), day2 AS ({DAY2})
SELECT coalesce(a.id, b.id) AS id,
  CASE WHEN a.id IS NULL THEN 'new' WHEN b.id IS NULL THEN 'deleted'
    WHEN {' AND '.join(f'a.{c} IS NOT DISTINCT FROM b.{c}' for c in BUSINESS)} THEN 'same' ELSE 'changed' END AS kind
FROM day1 a FULL JOIN day2 b ON a.id = b.id"""


def scd2_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged under their customer: repeated keys are rejected, the rest loads."""
    orders = read(spark, sf_dir, "orders")
    stage = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"), F.col("o_orderkey").alias("order_id")
    )
    return compare.bad_key_rows(stage, ["id"]).groupBy("reason").agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_keys"), F.sum("order_id").alias("order_ids")
    )


QUARANTINE_SQL = """
WITH stage AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id, o_orderkey AS order_id FROM orders),
bad AS (SELECT *, CASE WHEN id IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS reason FROM stage
  WHERE id IS NULL OR id IN (SELECT id FROM stage WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))
SELECT reason, count(*) AS n_rows, count(DISTINCT id) AS n_keys, CAST(sum(order_id) AS BIGINT) AS order_ids FROM bad GROUP BY reason"""


def damaged(table: DataFrame) -> DataFrame:
    """A dimension in which superseded rows of some keys are current again."""
    return table.withColumn(
        "current_flag", F.col("current_flag") | ((F.col("version") == 1) & (F.col("nation_id") < 2))
    )


def scd2_repair_one_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, dim = after_loads(spark, sf_dir, ["day1", "day2", "day1"])
    return shown(scd2.repair_one_current(damaged(table), dim, LOAD_TIMES[3]))


REPAIR_SQL = f"""{loads_sql(['day1', 'day2', 'day1'])},
damaged AS (SELECT * REPLACE (current_flag OR (version = 1 AND nation_id < 2) AS current_flag) FROM t3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id, current_flag ORDER BY version DESC, customer_sk DESC) AS rn FROM damaged),
repaired AS (SELECT * EXCLUDE (rn) REPLACE (
    CASE WHEN current_flag AND rn > 1 THEN TIMESTAMP '{LOAD_TIMES[3]}' ELSE effective_to END AS effective_to,
    current_flag AND rn = 1 AS current_flag) FROM ranked)
SELECT {SHOWN_SQL} FROM repaired"""


def damaged_intervals(table: DataFrame) -> DataFrame:
    """Superseded rows of some nations are open or current again, some last ones have lost their end."""
    closed = ~F.col("current_flag")
    end = F.lit(OPEN_END).cast("timestamp")
    return table.withColumn(
        "effective_to", F.when(closed & (F.col("nation_id") < 8), end).otherwise(F.col("effective_to"))
    ).withColumn("current_flag", F.col("current_flag") | (closed & (F.col("nation_id") < 4)))


_DAMAGED_SQL = f"""damaged AS (SELECT * REPLACE (
    CASE WHEN NOT current_flag AND nation_id < 8 THEN TIMESTAMP '{OPEN_END}' ELSE effective_to END AS effective_to,
    current_flag OR (NOT current_flag AND nation_id < 4) AS current_flag) FROM t3),
n AS (SELECT *, lead(effective_from) OVER (PARTITION BY id ORDER BY version, customer_sk) AS later FROM damaged)"""


def scd2_repair_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, dim = after_loads(spark, sf_dir, ["day1", "day2", "day1"])
    return shown(scd2.repair_intervals(damaged_intervals(table), dim, LOAD_TIMES[3]))


REPAIR_INTERVALS_SQL = f"""{loads_sql(['day1', 'day2', 'day1'])}, {_DAMAGED_SQL},
repaired AS (SELECT * REPLACE (
    CASE WHEN later IS NOT NULL THEN greatest(least(effective_to, later), effective_from) WHEN current_flag THEN TIMESTAMP '{OPEN_END}'
      WHEN effective_to = TIMESTAMP '{OPEN_END}' THEN TIMESTAMP '{LOAD_TIMES[3]}' ELSE greatest(effective_to, effective_from) END AS effective_to,
    CASE WHEN later IS NOT NULL THEN FALSE ELSE current_flag END AS current_flag) FROM n)
SELECT {SHOWN_SQL} FROM repaired"""


def scd2_interval_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of the damaged history by kind of row, and none of the sound one."""
    table, dim = after_loads(spark, sf_dir, ["day1", "day2", "day1"])
    sound = scd2.interval_faults(table, dim).withColumn("state", F.lit("sound"))
    return scd2.interval_faults(damaged_intervals(table), dim).withColumn("state", F.lit("damaged")).unionByName(sound)


INTERVAL_FAULTS_SQL = f"""{loads_sql(['day1', 'day2', 'day1'])}, {_DAMAGED_SQL}
SELECT * FROM (SELECT id, version, customer_sk, CASE WHEN later IS NOT NULL AND current_flag THEN 'not_last_current'
    WHEN later IS NOT NULL AND effective_to > later THEN 'overlap' WHEN effective_to < effective_from THEN 'empty'
    WHEN later IS NULL AND current_flag <> (effective_to = TIMESTAMP '{OPEN_END}') THEN 'closed_last' END AS fault, 'damaged' AS state
  FROM n) WHERE fault IS NOT NULL"""


def scd2_published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads through a published table instead of in memory."""
    stages = states(spark, sf_dir)
    empty, dim = empty_dim(spark, stages["day1"])
    table = DimensionTable(spark, scratch_path(spark, "dim_customer"), empty.schema)
    for stage, at in zip(["day1", "day2", "day1"], LOAD_TIMES):
        table.load(stages[stage], dim, at)
    return shown(table.read())


def scd2_delta_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads over buckets, the last without a change; superseded bucket files are deleted in between."""
    stages = states(spark, sf_dir)
    empty, dim = empty_dim(spark, stages["day1"])
    table = DimensionTable(spark, scratch_path(spark, "dim_customer"), empty.schema)
    for stage, at in zip(["day1", "day2", "day1", "day1"], LOAD_TIMES):
        table.load(stages[stage], dim, at, buckets=4)
        table.retire(keep=2)
    return shown(table.read())


def scd2_digest_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the digests alone say a second load has to look at; every other key has equal rows on both days."""
    stages = states(spark, sf_dir)
    empty, dim = empty_dim(spark, stages["day1"])
    table = DimensionTable(spark, scratch_path(spark, "dim_customer"), empty.schema)
    table.load(stages["day1"], dim, LOAD_TIMES[0], buckets=4)
    current = table._current(table.places(table.last()))
    return table.delta(stages["day2"], dim, current).select("id", F.col("_why").alias("why"))


DIGEST_DELTA_SQL = f"""WITH day1 AS ({DAY1}), day2 AS ({DAY2})
SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'gone' ELSE 'touched' END AS why
FROM day1 a FULL JOIN day2 b ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR NOT ({' AND '.join(f'a.{c} IS NOT DISTINCT FROM b.{c}' for c in BUSINESS)})"""


# ---- change feeds ---------------------------------------------------------------

FIRST_BATCH_BEFORE = "2024-01-16 00:00:00"


def user_feed(events: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    return events.select(F.col("user_id").alias("id"), op.alias("op"), F.col("ts").alias("seq"), "event_type", "value")


def user_dimension(spark: SparkSession, feed: DataFrame) -> tuple[DimensionTable, scd2.Dimension]:
    schema = shape.dim_schema(feed.drop("op").schema, "user")
    table = DimensionTable(spark, scratch_path(spark, "dim_user"), schema)
    return table, scd2.Dimension.of(schema.names, "user", carried=["seq"])


def shown_user(table: DataFrame) -> DataFrame:
    return table.select(
        "id", "event_type", "value", "user_sk", "seq", moment("effective_from").alias("effective_from"),
        moment("effective_to").alias("effective_to"), "current_flag", "version",
    )


def cdc_apply_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the events, then all of them again: old changes are ignored."""
    feed = user_feed(read(spark, sf_dir, "events"))
    table, dim = user_dimension(spark, feed)
    first = feed.where(F.col("seq") < F.lit(FIRST_BATCH_BEFORE).cast("timestamp_ntz"))
    changes.apply_batch(table, dim, first, 0, LOAD_TIMES[0])
    changes.apply_batch(table, dim, feed, 1, LOAD_TIMES[1])
    changes.apply_batch(table, dim, feed, 1, LOAD_TIMES[2])
    return shown_user(table.read())


_FEED = """feed AS (SELECT user_id AS id, ts AS seq, event_type, value,
  CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op FROM events)"""


def _latest(name: str, where: str) -> str:
    return (
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn "
        f"FROM feed WHERE {where}) WHERE rn = 1)"
    )


_USER_SHOWN = (
    f"{moment_sql('effective_from')} AS effective_from, {moment_sql('effective_to')} AS effective_to, current_flag, version"
)
CDC_SQL = f"""WITH {_FEED},
{_latest('a', f"seq < TIMESTAMP '{FIRST_BATCH_BEFORE}'")},
{_latest('b', 'TRUE')},
t1 AS (SELECT id, event_type, value, row_number() OVER (ORDER BY id) AS user_sk, seq,
  TIMESTAMP '{LOAD_TIMES[0]}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag,
  CAST(1 AS BIGINT) AS version FROM a WHERE op <> 'D'),
n AS (SELECT b.* FROM b LEFT JOIN t1 ON b.id = t1.id WHERE t1.seq IS NULL OR b.seq > t1.seq),
m AS (SELECT t1.*, n.id AS nid, n.op AS nop, n.seq AS nseq,
  (n.event_type IS NOT DISTINCT FROM t1.event_type AND n.value IS NOT DISTINCT FROM t1.value) AS same
  FROM t1 LEFT JOIN n ON t1.id = n.id),
old AS (SELECT id, event_type, value, user_sk,
  CASE WHEN nid IS NOT NULL AND (nop = 'D' OR same) THEN nseq ELSE seq END AS seq, effective_from,
  CASE WHEN nid IS NOT NULL AND (nop = 'D' OR NOT same) THEN TIMESTAMP '{LOAD_TIMES[1]}' ELSE effective_to END AS effective_to,
  NOT (nid IS NOT NULL AND (nop = 'D' OR NOT same)) AS current_flag, version FROM m),
ins AS (SELECT n.id, n.event_type, n.value,
  (SELECT coalesce(max(user_sk), 0) FROM t1) + row_number() OVER (ORDER BY n.id) AS user_sk, n.seq,
  TIMESTAMP '{LOAD_TIMES[1]}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag,
  coalesce(t1.version, 0) + 1 AS version
  FROM n LEFT JOIN t1 ON n.id = t1.id
  WHERE n.op <> 'D' AND (t1.id IS NULL OR NOT (n.event_type IS NOT DISTINCT FROM t1.event_type AND n.value IS NOT DISTINCT FROM t1.value)))
SELECT id, event_type, value, user_sk, seq, {_USER_SHOWN} FROM (SELECT * FROM old UNION ALL SELECT * FROM ins)"""


def cdc_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of unseen users come first, their older changes later, then the rest from a new checkpoint (batch 0 again)."""
    feed = user_feed(read(spark, sf_dir, "events"))
    table, dim = user_dimension(spark, feed)
    cut = F.lit(FIRST_BATCH_BEFORE).cast("timestamp_ntz")
    changes.apply_batch(table, dim, feed.where((F.col("op") == "D") & (F.col("seq") < cut)), 0, LOAD_TIMES[0], feed_id="a")
    changes.apply_batch(table, dim, feed.where((F.col("op") != "D") & (F.col("seq") < cut)), 1, LOAD_TIMES[1], feed_id="a")
    changes.apply_batch(table, dim, feed.where((F.col("op") != "D") & (F.col("seq") < cut)), 0, LOAD_TIMES[2], feed_id="b")
    return shown_user(table.read())


CDC_ORDER_SQL = f"""WITH {_FEED}, early AS (SELECT * FROM feed WHERE seq < TIMESTAMP '{FIRST_BATCH_BEFORE}'),
gone AS (SELECT id, max(seq) AS seq FROM early WHERE op = 'D' GROUP BY 1),
late AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM early WHERE op <> 'D') WHERE rn = 1),
t AS (SELECT late.id, event_type, value, row_number() OVER (ORDER BY late.id) AS user_sk, late.seq,
  TIMESTAMP '{LOAD_TIMES[1]}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag, CAST(1 AS BIGINT) AS version
  FROM late LEFT JOIN gone ON late.id = gone.id WHERE gone.id IS NULL OR late.seq > gone.seq)
SELECT id, event_type, value, user_sk, seq, {_USER_SHOWN} FROM t"""


#: Three batches of the feed, each as a condition on the sequence; the second is ahead of the third.
BATCHES = [
    f"seq < TIMESTAMP '{FIRST_BATCH_BEFORE}'",
    "seq >= TIMESTAMP '2024-01-23 00:00:00'",
    f"seq >= TIMESTAMP '{FIRST_BATCH_BEFORE}' AND seq < TIMESTAMP '2024-01-27 00:00:00'",
]


def cdc_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in three batches over buckets, one of them ahead of its time and one in part seen before."""
    feed = user_feed(read(spark, sf_dir, "events"))
    table, dim = user_dimension(spark, feed)
    table.load(feed.drop("op").limit(0), dim, LOAD_TIMES[0], buckets=8)
    for i, (where, at) in enumerate(zip(BATCHES, LOAD_TIMES)):
        changes.apply_batch(table, dim, feed.where(where.replace("TIMESTAMP", "TIMESTAMP_NTZ")), i, at)
    return shown_user(table.read())


def batches_sql() -> str:
    """The batches as sequential close and insert statements; table is t0..t3."""
    same = "(n.event_type IS NOT DISTINCT FROM t.event_type AND n.value IS NOT DISTINCT FROM t.value)"
    parts = [
        _FEED,
        "t0 AS (SELECT id, event_type, value, CAST(0 AS BIGINT) AS user_sk, seq, seq AS effective_from, seq AS effective_to, "
        "FALSE AS current_flag, CAST(0 AS BIGINT) AS version FROM feed WHERE FALSE)",
    ]
    for i, (where, at) in enumerate(zip(BATCHES, LOAD_TIMES), 1):
        parts.append(_latest(f"b{i}", where))
        seen = " UNION ALL ".join(f"SELECT id, seq FROM b{j}" for j in range(1, i)) or "SELECT id, seq FROM feed WHERE FALSE"
        parts.append(
            f"n{i} AS (SELECT b.* FROM b{i} b LEFT JOIN (SELECT id, max(seq) AS m FROM ({seen}) GROUP BY id) s ON s.id = b.id "
            "WHERE s.m IS NULL OR b.seq > s.m)"
        )
        closes = f"(t.current_flag AND n.id IS NOT NULL AND (n.op = 'D' OR NOT {same}))"
        parts.append(
            f"old{i} AS (SELECT t.id, t.event_type, t.value, t.user_sk, "
            f"CASE WHEN t.current_flag AND n.id IS NOT NULL AND (n.op = 'D' OR {same}) THEN n.seq ELSE t.seq END AS seq, t.effective_from, "
            f"CASE WHEN {closes} THEN TIMESTAMP '{at}' ELSE t.effective_to END AS effective_to, "
            f"t.current_flag AND NOT {closes} AS current_flag, t.version FROM t{i - 1} t LEFT JOIN n{i} n ON t.id = n.id)"
        )
        parts.append(
            f"ins{i} AS (SELECT n.id, n.event_type, n.value, "
            f"(SELECT coalesce(max(user_sk), 0) FROM t{i - 1}) + row_number() OVER (ORDER BY n.id) AS user_sk, n.seq, "
            f"TIMESTAMP '{at}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag, "
            f"CAST(coalesce(v.top, 0) + 1 AS BIGINT) AS version FROM n{i} n LEFT JOIN (SELECT * FROM t{i - 1} WHERE current_flag) t ON t.id = n.id "
            f"LEFT JOIN (SELECT id, max(version) AS top FROM t{i - 1} GROUP BY id) v ON v.id = n.id "
            f"WHERE n.op <> 'D' AND (t.id IS NULL OR NOT {same}))"
        )
        parts.append(f"t{i} AS (SELECT * FROM old{i} UNION ALL SELECT * FROM ins{i})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT id, event_type, value, user_sk, seq, {_USER_SHOWN} FROM t{len(BATCHES)}"


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes without a key or a sequence: all are rejects of their run, by reason."""
    feed = user_feed(read(spark, sf_dir, "events"))
    feed = feed.withColumn("id", F.when(F.col("event_type") != "signup", F.col("id"))).withColumn("seq", F.when(F.col("value") >= 20, F.col("seq")))
    table, dim = user_dimension(spark, feed)
    run = changes.apply_batch(table, dim, feed, 0, LOAD_TIMES[0])
    return table.rejects(run).groupBy("reason", "event_type").agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_users"))


CDC_REJECTS_SQL = f"""WITH {_FEED}
SELECT CASE WHEN event_type = 'signup' THEN 'null_key' ELSE 'null_seq' END AS reason, event_type, count(*) AS n_rows,
  count(DISTINCT CASE WHEN event_type <> 'signup' THEN id END) AS n_users
FROM feed WHERE event_type = 'signup' OR value IS NULL OR value < 20 GROUP BY ALL"""


def scd2_load_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a load whose stage has NULL keys, repeated keys and failed casts, with the state of their keys after it."""
    stages = states(spark, sf_dir)
    empty, dim = empty_dim(spark, stages["day1"])
    table = DimensionTable(spark, scratch_path(spark, "dim_customer"), empty.schema)
    table.load(stages["day1"], dim, LOAD_TIMES[0])
    day1 = stages["day1"]
    note = F.array(F.struct(F.lit("nation_id").alias("column"), F.lit("x").alias("value")))
    none = F.array().cast("array<struct<column:string,value:string>>")
    stage = day1.withColumn("failed_casts", F.when(F.pmod("id", F.lit(9)) == 2, note).otherwise(none))
    twice = stage.where("id % 9 = 4")
    nameless = stage.where("id % 9 = 5").withColumn("id", F.lit(None).cast(dict(day1.dtypes)["id"]))
    run = table.load(stage.unionByName(twice).unionByName(nameless), dim, LOAD_TIMES[1])
    current = table.current().select(dim.nk, "version", moment("effective_from").alias("effective_from"))
    return table.rejects(run).groupBy("id", "reason").agg(F.count("*").alias("n_rows")).join(current, "id", "left")


REJECTS_SQL = f"""WITH day1 AS ({DAY1}), r AS (
SELECT CAST(NULL AS BIGINT) AS id, 'null_key' AS reason, count(*) AS n_rows FROM day1 WHERE id % 9 = 5 HAVING count(*) > 0
UNION ALL SELECT id, 'duplicate_key', 2 FROM day1 WHERE id % 9 = 4
UNION ALL SELECT id, 'failed_cast', 1 FROM day1 WHERE id % 9 = 2)
SELECT id, reason, n_rows, CASE WHEN id IS NOT NULL THEN CAST(1 AS BIGINT) END AS version,
  CASE WHEN id IS NOT NULL THEN {moment_sql(f"TIMESTAMP '{LOAD_TIMES[0]}'")} END AS effective_from FROM r"""


def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, applied by ``foreachBatch`` until none is left."""
    events = read(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    table, dim = user_dimension(spark, user_feed(events))
    query = changes.follow(
        user_feed(stream), table, dim, scratch_path(spark, "stream"), clock=lambda: LOAD_TIMES[0]
    )
    query.awaitTermination()
    return shown_user(table.read())


CDC_STREAM_SQL = f"""WITH {_FEED}, {_latest('b', 'TRUE')},
t AS (SELECT id, event_type, value, row_number() OVER (ORDER BY id) AS user_sk, seq,
  TIMESTAMP '{LOAD_TIMES[0]}' AS effective_from, TIMESTAMP '{OPEN_END}' AS effective_to, TRUE AS current_flag,
  CAST(1 AS BIGINT) AS version FROM b WHERE op <> 'D')
SELECT id, event_type, value, user_sk, seq, {_USER_SHOWN} FROM t"""


# ---- numbering --------------------------------------------------------------------

KEY_OFFSET = 1000


def keys_from_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dense_keys(orders, ["o_orderdate", "o_orderkey"], "order_sk")


def keys_from_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbering with a NULL in the key: nulls come last."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    )
    return dense_keys(orders, ["customer", "o_orderkey"], "order_sk", offset=KEY_OFFSET)


def keys_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every order inside its status; one status holds about half the rows."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return position_in_group(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "position")


QUERIES = {
    "scd2_initial": loaded("day1"),
    "scd2_second_load": loaded("day1", "day2"),
    "scd2_reappear": loaded("day1", "day2", "day1"),
    "scd2_noop": loaded("day1", "day2", "day1", "day1"),
    "scd2_current": scd2_current,
    "scd2_change_kinds": scd2_change_kinds,
    "scd2_quarantine": scd2_quarantine,
    "scd2_repair_one_current": scd2_repair_one_current,
    "scd2_repair_intervals": scd2_repair_intervals,
    "scd2_interval_faults": scd2_interval_faults,
    "scd2_published_runs": scd2_published_runs,
    "scd2_delta_loads": scd2_delta_loads,
    "scd2_digest_delta": scd2_digest_delta,
    "cdc_apply_latest": cdc_apply_latest,
    "cdc_three_batches": cdc_three_batches,
    "cdc_rejects": cdc_rejects,
    "cdc_stream": cdc_stream,
    "cdc_out_of_order": cdc_out_of_order,
    "scd2_load_with_rejects": scd2_load_with_rejects,
    "dense_keys": keys_from_one,
    "dense_keys_offset": keys_from_offset,
    "dense_keys_in_group": keys_in_group,
}
ORACLES = {
    "scd2_initial": loaded_sql("day1"),
    "scd2_second_load": loaded_sql("day1", "day2"),
    "scd2_reappear": loaded_sql("day1", "day2", "day1"),
    "scd2_noop": loaded_sql("day1", "day2", "day1", "day1"),
    "scd2_current": loaded_sql("day1", "day2", where="current_flag"),
    "scd2_change_kinds": CHANGE_KINDS_SQL,
    "scd2_quarantine": QUARANTINE_SQL,
    "scd2_repair_one_current": REPAIR_SQL,
    "scd2_repair_intervals": REPAIR_INTERVALS_SQL,
    "scd2_interval_faults": INTERVAL_FAULTS_SQL,
    "scd2_published_runs": loaded_sql("day1", "day2", "day1"),
    "scd2_delta_loads": loaded_sql("day1", "day2", "day1", "day1"),
    "scd2_digest_delta": DIGEST_DELTA_SQL,
    "cdc_apply_latest": CDC_SQL,
    "cdc_three_batches": batches_sql(),
    "cdc_rejects": CDC_REJECTS_SQL,
    "cdc_stream": CDC_STREAM_SQL,
    "cdc_out_of_order": CDC_ORDER_SQL,
    "scd2_load_with_rejects": REJECTS_SQL,
    "dense_keys": "SELECT o_orderkey, o_custkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders",
    "dense_keys_offset": (
        "SELECT o_orderkey, customer, "
        f"{KEY_OFFSET} + row_number() OVER (ORDER BY customer NULLS LAST, o_orderkey) AS order_sk "
        "FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer FROM orders)"
    ),
    "dense_keys_in_group": (
        "SELECT o_orderkey, o_orderstatus, o_orderdate, "
        "row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS position FROM orders"
    ),
}
