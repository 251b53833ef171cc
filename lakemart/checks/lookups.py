"""Lookups and bridges over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.checks.inputs import as_text, calendar_sql, customer_dim, list_text, nation_dim, read, sk_dim
from lakemart.operators import bridge
from lakemart.operators.calendar import calendar, date_ids, status_dim, status_ids
from lakemart.operators.lookup import attach, lookup_by_candidates, lookup_sk

SHORT_CALENDAR = ("1995-01-01", "1999-12-31")
FULL_CALENDAR = ("1995-01-01", "2024-12-31")


def lookup_sk_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to current customers; not all customers are current."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = lookup_sk(orders, customer_dim(spark, sf_dir), "o_custkey", "customer_sk", "customer_sk")
    return found.withColumn("customer_sk", F.coalesce("customer_sk", F.lit(0).cast("bigint")))


LOOKUP_SQL = """
SELECT o_orderkey, o_custkey, coalesce(c_custkey + 1, 0) AS customer_sk
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey"""


def lookup_chain_line_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per region over four hops, the hops resolved from the far end."""
    regions = sk_dim(read(spark, sf_dir, "region"), "region", "r_regionkey")
    nations = nation_dim(spark, sf_dir)
    nations = lookup_sk(nations, regions, "n_regionkey", "region_sk", "region_sk")
    customers = attach(
        customer_dim(spark, sf_dir).where("current_flag"), nations, "c_nationkey",
        {"nation_sk": "nation_sk", "region_sk": "region_sk"},
    )
    orders = sk_dim(read(spark, sf_dir, "orders"), "order", "o_orderkey")
    hops = {"customer_sk": "customer_sk", "nation_sk": "nation_sk", "region_sk": "region_sk"}
    orders = attach(orders, customers, "o_custkey", hops)
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    found = attach(lines, orders, "l_orderkey", {"order_sk": "order_sk", **hops})
    keys = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("region_sk", "nation_sk")]
    return found.groupBy(*keys).agg(
        F.count("*").alias("n_lines"), F.count("customer_sk").alias("n_known"), F.max("order_sk").alias("last_order_sk")
    )


CHAIN_SQL = """
SELECT CAST(coalesce(r_regionkey + 1, 0) AS BIGINT) AS region_sk, CAST(coalesce(n_nationkey + 1, 0) AS BIGINT) AS nation_sk,
  count(*) AS n_lines, count(c_custkey) AS n_known, max(o_orderkey + 1) AS last_order_sk
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2"""


def candidate_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third candidate column is the one this table has; another table has none."""
    suppliers = sk_dim(read(spark, sf_dir, "supplier"), "supplier", "s_suppkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("supplier"))
    candidates = ["supplier_id", "main_supplier_id", "supplier", "supplier_fk"]
    with_fk = lookup_by_candidates(parts, suppliers, candidates, "supplier_sk", "found_sk")
    without = lookup_by_candidates(with_fk.drop("supplier"), suppliers, candidates, "supplier_sk", "absent_sk")
    carried = lookup_by_candidates(
        without.withColumn("supplier_sk", F.col("p_partkey")), suppliers, candidates, "supplier_sk", "carried_sk"
    )
    return carried.select("p_partkey", F.coalesce("found_sk", F.lit(0).cast("bigint")).alias("found_sk"), "absent_sk", "carried_sk")


CANDIDATE_SQL = """
SELECT p_partkey, coalesce(s_suppkey + 1, 0) AS found_sk, CAST(0 AS BIGINT) AS absent_sk, p_partkey AS carried_sk
FROM part LEFT JOIN supplier ON p_size = s_suppkey"""


def dates(days: tuple[str, str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = read(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("ordered"),
        )
        found = date_ids(orders, calendar(spark, *days), {"ordered": "ordered_id", "shipped": "shipped_id"})
        return found.select("o_orderkey", "ordered_id", "shipped_id")

    return run


def dates_sql(days: tuple[str, str]) -> str:
    return f"""WITH dim_date AS ({calendar_sql(*days)})
SELECT o_orderkey, coalesce(date_id, 0) AS ordered_id, CAST(0 AS INTEGER) AS shipped_id
FROM orders LEFT JOIN dim_date ON CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END = date_actual"""


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the range of the order dates, with the orders of each day."""
    orders = read(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    days = calendar(spark, str(first), str(last))
    return attach(days, per_day, "date_actual", {"n": "n_orders"}, nk="day").select(
        "date_id", "date_actual", F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders")
    )


CALENDAR_SQL = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date_actual, coalesce(n, 0) AS n_orders
FROM range((SELECT CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders),
  (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY) AS r(d)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) ON CAST(d AS DATE) = day"""


def written_status() -> Column:
    """Order status as people type it: case and blanks vary, some are missing."""
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("  "), F.lower("o_orderstatus")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.concat(F.col("o_orderstatus"), F.lit(" ")))
    )


WRITTEN_STATUS = """CASE WHEN o_orderpriority = '1-URGENT' THEN concat('  ', lower(o_orderstatus))
  WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat(o_orderstatus, ' ') END"""


def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", written_status().alias("status"))
    lines = read(spark, sf_dir, "lineitem")
    known = status_dim([("orders", orders, "status"), ("lines", lines, "l_linestatus")])
    known = known.withColumn("current_flag", F.col("status_nk") != "f")
    found = status_ids(orders, known, "status", "status_id", "orders")
    return status_ids(found, known, "no_such_column", "absent_id", "orders").select("o_orderkey", "status_id", "absent_id")


STATUS_SQL = f"""WITH o AS (SELECT o_orderkey, lower(trim({WRITTEN_STATUS})) AS nk FROM orders),
known AS (SELECT *, row_number() OVER (ORDER BY domain, nk) AS status_id FROM (
  SELECT DISTINCT 'orders' AS domain, nk FROM o WHERE nk IS NOT NULL
  UNION SELECT DISTINCT 'lines', lower(trim(l_linestatus)) FROM lineitem))
SELECT o_orderkey, coalesce(status_id, 0) AS status_id, CAST(0 AS BIGINT) AS absent_id
FROM o LEFT JOIN (SELECT * FROM known WHERE domain = 'orders' AND nk <> 'f') k ON o.nk = k.nk"""


def status_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of orders before 1998, then of all orders and of lines: ids given first stay."""
    orders = read(spark, sf_dir, "orders")
    early = orders.where(F.year("o_orderdate") < 1998).where("o_orderpriority <> '2-HIGH'")
    first = status_dim([("orders", early, "o_orderpriority")])
    return status_dim([("orders", orders, "o_orderpriority"), ("lines", read(spark, sf_dir, "lineitem"), "l_linestatus")], first)


STATUS_SECOND_SQL = """WITH a AS (SELECT 'orders' AS status_domain, lower(trim(o_orderpriority)) AS status_nk FROM orders
  WHERE year(o_orderdate) < 1998 AND o_orderpriority <> '2-HIGH' GROUP BY 2),
first AS (SELECT row_number() OVER (ORDER BY status_domain, status_nk) AS status_id, * FROM a),
b AS (SELECT 'orders' AS status_domain, lower(trim(o_orderpriority)) AS status_nk FROM orders GROUP BY 2
  UNION ALL SELECT 'lines', lower(trim(l_linestatus)) FROM lineitem GROUP BY 2),
fresh AS (SELECT b.* FROM b LEFT JOIN a USING (status_domain, status_nk) WHERE a.status_nk IS NULL)
SELECT *, TRUE AS current_flag FROM (SELECT * FROM first UNION ALL
  SELECT (SELECT max(status_id) FROM first) + row_number() OVER (ORDER BY status_domain, status_nk), * FROM fresh)"""


def set_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part keys and line count per order; orders without lines get an empty set and 0."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey")
    lines = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_partkey + 1 AS part_sk")
    sets = bridge.members_per_parent(lines, "l_orderkey", "part_sk", "part_sks", count_out="n_lines")
    joined = attach(orders, sets, "o_orderkey", {"part_sks": "part_sks", "n_lines": "n_lines"}, nk="l_orderkey")
    return joined.select(
        "o_orderkey", F.coalesce(as_text("part_sks"), F.lit("")).alias("part_sks"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
    )


SET_BRIDGE_SQL = f"""
SELECT o_orderkey, {list_text('sks')} AS part_sks, CAST(coalesce(n, 0) AS INTEGER) AS n_lines FROM orders
LEFT JOIN (SELECT l_orderkey, list(DISTINCT l_partkey + 1 ORDER BY l_partkey + 1) AS sks, count(*) AS n
  FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""


def max_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").selectExpr("l_suppkey", "l_partkey + 1 AS part_sk")
    top = bridge.max_member(lines, "l_suppkey", "part_sk", "top_part_sk")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey")
    return attach(suppliers, top, "s_suppkey", {"top_part_sk": "top_part_sk"}, nk="l_suppkey")


MAX_CHILD_SQL = """
SELECT s_suppkey, top AS top_part_sk FROM supplier
LEFT JOIN (SELECT l_suppkey, max(l_partkey + 1) AS top FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey"""


def ordered_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", (F.col("o_orderkey") + 1).alias("order_sk"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("created_at"),
    )
    ordered = bridge.ordered_members(orders, "o_custkey", "order_sk", "created_at", "order_sks")
    unordered = bridge.ordered_members(orders, "o_custkey", "order_sk", "no_such_column", "by_key")
    return ordered.join(unordered, "o_custkey").select(
        "o_custkey", as_text("order_sks").alias("order_sks"), as_text("by_key").alias("by_key")
    )


ORDERED_BRIDGE_SQL = """
SELECT o_custkey, array_to_string(list(o_orderkey + 1 ORDER BY
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END NULLS FIRST, o_orderkey), ',') AS order_sks,
  array_to_string(list(o_orderkey + 1 ORDER BY o_orderkey), ',') AS by_key
FROM orders GROUP BY 1"""


def bridge_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each return flag in ship order as rows: three groups hold everything."""
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey")
    return bridge.bridge_rows(lines, "l_returnflag", "l_orderkey", ["l_shipdate"])


BRIDGE_ROWS_SQL = """
SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey) AS position
FROM (SELECT DISTINCT l_returnflag, l_shipdate, l_orderkey FROM lineitem)"""


def chunked_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each return flag in ship order, in cells of at most 1,000: one flag holds half of all lines."""
    lines = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey")
    made = bridge.bridge_chunks(lines, "l_returnflag", "l_orderkey", ["l_shipdate"], "order_ids", size=1000)
    return made.withColumn("order_ids", as_text("order_ids"))


CHUNKS_SQL = f"""
SELECT l_returnflag, (position - 1) // 1000 + 1 AS chunk_no, count(*) AS n_members,
  array_to_string(list(l_orderkey ORDER BY position), ',') AS order_ids
FROM ({BRIDGE_ROWS_SQL}) GROUP BY 1, 2"""


def risk_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts to current suppliers, those without debt; [0] where none is known, as for the five parts past the last one."""
    suppliers = sk_dim(read(spark, sf_dir, "supplier"), "supplier", "s_suppkey").where("s_acctbal > 0")
    links = read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    sets = bridge.linked_members(links, "l_partkey", "l_suppkey", suppliers, "supplier_sk", "sks")
    parts = attach(read(spark, sf_dir, "part").select((F.col("p_partkey") + 5).alias("p_partkey")), sets, "p_partkey", {"sks": "sks"}, nk="l_partkey")
    unknown = F.array(F.lit(0).cast("bigint"))
    return parts.select("p_partkey", as_text(F.coalesce("sks", unknown)).alias("supplier_sks"))


RISK_BRIDGE_SQL = """
SELECT p.p_partkey, coalesce(array_to_string(sks, ','), '0') AS supplier_sks FROM (SELECT p_partkey + 5 AS p_partkey FROM part) p
LEFT JOIN (SELECT l_partkey, list(DISTINCT s_suppkey + 1 ORDER BY s_suppkey + 1) AS sks
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0 GROUP BY 1) ON p_partkey = l_partkey"""

ROLES = ["first_id", "second_id", "third_id", "fourth_id", "fifth_id", "sixth_id"]
ROLE_EXPRS = [
    "o_custkey",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) - 1995 AS BIGINT) END",
    "CAST(month(o_orderdate) AS BIGINT)",
    "o_custkey",
    "CAST(floor(o_totalprice) AS BIGINT)",
    "CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 END",
]


def role_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = read(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{e} AS {r}" for r, e in zip(ROLES, ROLE_EXPRS)])
    suppliers = sk_dim(read(spark, sf_dir, "supplier"), "supplier", "s_suppkey")
    return bridge.role_array(register, ["o_orderkey"], ROLES, suppliers, "supplier_sk", "sks").select(
        "o_orderkey", as_text("sks").alias("supplier_sks"), F.size("sks").alias("n_roles")
    )


ROLE_ARRAY_SQL = f"""
WITH ids AS ({' UNION ALL '.join(f'SELECT o_orderkey, {i} AS role, {e} AS fk FROM orders' for i, e in enumerate(ROLE_EXPRS))}),
found AS (SELECT o_orderkey, list(s_suppkey + 1 ORDER BY role) AS sks FROM ids JOIN supplier ON fk = s_suppkey GROUP BY 1)
SELECT orders.o_orderkey, {list_text('sks')} AS supplier_sks, CAST(coalesce(len(sks), 0) AS INTEGER) AS n_roles
FROM orders LEFT JOIN found ON orders.o_orderkey = found.o_orderkey"""


def event_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event, first purchase and first error of every user."""
    return bridge.milestones(
        read(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", "first_at",
        {"purchase": "purchase_at", "error": "error_at"},
    )


MILESTONES_SQL = """
SELECT user_id, min(ts) AS first_at, min(ts) FILTER (WHERE event_type = 'purchase') AS purchase_at,
  min(ts) FILTER (WHERE event_type = 'error') AS error_at FROM events GROUP BY 1"""


def event_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.latest_per_status(
        read(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", {"purchase": "purchase_at", "error": "error_at"}
    )


LATEST_SQL = """
SELECT u.user_id, p.ts AS purchase_at, e.ts AS error_at FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
  FROM events WHERE event_type = 'purchase') p ON u.user_id = p.user_id AND p.rn = 1
LEFT JOIN (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
  FROM events WHERE event_type = 'error') e ON u.user_id = e.user_id AND e.rn = 1"""

QUERIES = {
    "lookup_sk_order": lookup_sk_order,
    "lookup_chain_line_to_region": lookup_chain_line_to_region,
    "lookup_candidate_fk": candidate_fk,
    "date_id_lookup": dates(FULL_CALENDAR),
    "date_id_out_of_calendar": dates(SHORT_CALENDAR),
    "calendar_days": calendar_days,
    "status_lookup": status_lookup,
    "status_second_load": status_second_load,
    "bridge_set": set_bridge,
    "bridge_max_child": max_child,
    "bridge_ordered": ordered_bridge,
    "bridge_rows": bridge_as_rows,
    "bridge_chunks": chunked_bridge,
    "bridge_risk_unknown": risk_bridge,
    "role_array": role_array,
    "event_milestones": event_milestones,
    "event_latest_status": event_latest,
}
ORACLES = {
    "lookup_sk_order": LOOKUP_SQL,
    "lookup_chain_line_to_region": CHAIN_SQL,
    "lookup_candidate_fk": CANDIDATE_SQL,
    "date_id_lookup": dates_sql(FULL_CALENDAR),
    "date_id_out_of_calendar": dates_sql(SHORT_CALENDAR),
    "calendar_days": CALENDAR_SQL,
    "status_lookup": STATUS_SQL,
    "status_second_load": STATUS_SECOND_SQL,
    "bridge_set": SET_BRIDGE_SQL,
    "bridge_max_child": MAX_CHILD_SQL,
    "bridge_ordered": ORDERED_BRIDGE_SQL,
    "bridge_rows": BRIDGE_ROWS_SQL,
    "bridge_chunks": CHUNKS_SQL,
    "bridge_risk_unknown": RISK_BRIDGE_SQL,
    "role_array": ROLE_ARRAY_SQL,
    "event_milestones": MILESTONES_SQL,
    "event_latest_status": LATEST_SQL,
}
