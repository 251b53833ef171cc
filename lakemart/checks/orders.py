"""The flagship: an order fact over freshly loaded dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.checks import history
from lakemart.checks.inputs import calendar_sql, nation_dim, read
from lakemart.operators.calendar import calendar, date_ids
from lakemart.operators.keys import dense_keys
from lakemart.operators.lookup import attach, current, lookup_sk
from lakemart.operators.shape import project_fact

DAYS = ("1995-01-01", "2000-12-31")
COLUMNS = ["order_fact_id", "order_no", "customer_sk", "nation_sk", "order_date_id", "total"]


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the keys of the customer (after two loads), its nation and the day."""
    customers, _ = history.after_loads(spark, sf_dir, ["day1", "day2"])
    customers = lookup_sk(current(customers), nation_dim(spark, sf_dir), "nation_id", "nation_sk", "nation_sk")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_no"), "o_custkey", "o_orderdate", F.col("o_totalprice").alias("total")
    )
    df = dense_keys(orders, ["order_no"], "order_fact_id")
    df = attach(df, customers, "o_custkey", {"customer_sk": "customer_sk", "nation_sk": "nation_sk"})
    df = date_ids(df, calendar(spark, *DAYS), {"o_orderdate": "order_date_id"})
    return project_fact(df, COLUMNS)


ORDER_FACT_SQL = f"""{history.loads_sql(['day1', 'day2'])},
dim_date AS ({calendar_sql(*DAYS)})
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_fact_id, o_orderkey AS order_no,
  coalesce(customer_sk, 0) AS customer_sk, CAST(coalesce(n_nationkey + 1, 0) AS BIGINT) AS nation_sk,
  coalesce(date_id, 0) AS order_date_id, o_totalprice AS total
FROM orders LEFT JOIN (SELECT * FROM t2 WHERE current_flag) c ON o_custkey = c.id
LEFT JOIN nation ON c.nation_id = n_nationkey LEFT JOIN dim_date ON CAST(o_orderdate AS DATE) = date_actual"""

QUERIES = {"order_fact": order_fact}
ORACLES = {"order_fact": ORDER_FACT_SQL}
