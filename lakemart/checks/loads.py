"""Shaping, profiling, validation and mirroring over the given tables, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.checks import history
from lakemart.checks.inputs import as_text, list_text, moment, moment_sql, read, sk_dim
from lakemart.functions.columns import FILE_EXTENSIONS, OPEN_END, is_file_like
from lakemart.operators import mirror, profile, quality, shape
from lakemart.plans import loads
from lakemart.session import scratch_path
from lakemart.sources import sync, tables
from lakemart.sources.runs import EvolvingTable

# ---- shaping ---------------------------------------------------------------------

_GAPS = {
    "o_orderkey": "o_orderkey",
    "total": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END",
    "customer": "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END",
    "priority": "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END",
    "urgent": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority = '1-URGENT' END",
    "ordered": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END",
}


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _GAPS.items()])


GAPS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _GAPS.items()) + " FROM orders"


def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_gaps(spark, sf_dir).withColumn(
        "members", F.when(F.col("customer").isNotNull(), F.array("customer", "o_orderkey"))
    )
    filled = shape.fill_nulls(df)
    return filled.withColumn("n_members", F.size("members")).withColumn("members", as_text("members"))


NULL_FILL_SQL = f"""
SELECT o_orderkey, coalesce(total, 0) AS total, coalesce(customer, 0) AS customer, coalesce(priority, 'N/A') AS priority,
  coalesce(urgent, FALSE) AS urgent, ordered,
  CASE WHEN customer IS NULL THEN '' ELSE concat(customer, ',', o_orderkey) END AS members,
  CAST(CASE WHEN customer IS NULL THEN 0 ELSE 2 END AS INTEGER) AS n_members
FROM ({GAPS_SQL})"""


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact projected to columns it lacks, and to ones it has in another order."""
    wanted = ["order_fact_id", "shipped_date_id", "line_sks", "agent_sk", "customer", "o_orderkey"]
    raw = shape.add_missing(with_gaps(spark, sf_dir), wanted).select(
        "o_orderkey", *[F.col(c).isNull().alias(f"{c}_null") for c in ("order_fact_id", "shipped_date_id", "line_sks", "agent_sk")]
    )
    fact = shape.project_fact(with_gaps(spark, sf_dir), wanted).withColumn("line_sks", as_text("line_sks"))
    return fact.join(raw, "o_orderkey")


MISSING_SQL = f"""
SELECT CAST(0 AS BIGINT) AS order_fact_id, CAST(0 AS INTEGER) AS shipped_date_id, '' AS line_sks, CAST(0 AS BIGINT) AS agent_sk,
  coalesce(customer, 0) AS customer, o_orderkey, TRUE AS order_fact_id_null, FALSE AS shipped_date_id_null,
  TRUE AS line_sks_null, TRUE AS agent_sk_null
FROM ({GAPS_SQL})"""


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns into a typed dimension: alias, failed casts, extra and absent columns."""
    raw = read(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey AS STRING) END AS buyer",
        "CASE WHEN o_orderstatus = 'F' THEN '1995-13-01' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS ordered",
        "o_totalprice AS total",
        "o_orderpriority AS extra",
    )
    target = shape.dim_schema(
        T.StructType.fromDDL("id bigint, customer_id bigint, ordered date, total double, note string"), "order"
    )
    return shape.conform(raw, target, "order", aliases={"buyer": "customer_id"})


CONFORM_SQL = """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS ordered, o_totalprice AS total,
  CAST(NULL AS VARCHAR) AS note FROM orders"""


def ancient_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_orderdate - INTERVAL 415 YEAR AS DATE) AS old_day", "o_orderdate - INTERVAL 98 YEAR AS old_ts",
        "o_orderdate AS new_ts",
    )
    return shape.clamp_ancient(shifted).select(
        "o_orderkey", F.date_format("old_day", "yyyy-MM-dd").alias("old_day"), moment("old_ts").alias("old_ts"), "new_ts"
    )


ANCIENT_SQL = f"""
SELECT o_orderkey,
  CASE WHEN old_day >= DATE '1582-10-15' THEN strftime(old_day, '%Y-%m-%d') END AS old_day,
  CASE WHEN old_ts >= TIMESTAMP '1900-01-01 00:00:00' THEN {moment_sql('old_ts')} END AS old_ts, new_ts
FROM (SELECT o_orderkey, CAST(o_orderdate - INTERVAL 415 YEAR AS DATE) AS old_day, o_orderdate - INTERVAL 98 YEAR AS old_ts,
  o_orderdate AS new_ts FROM orders)"""


def scalar_to_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("director_sk"))
    migrated = shape.scalar_to_array(orders, "director_sk", "director_sks")
    again = shape.scalar_to_array(migrated.withColumn("director_sk", F.lit(1)), "director_sk", "director_sks")
    return again.select("o_orderkey", as_text("director_sks").alias("director_sks"), F.size("director_sks").alias("n"))


SCALAR_TO_ARRAY_SQL = (
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS director_sks, CAST(1 AS INTEGER) AS n FROM orders"
)

def migrate_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published in two runs with one owner each, migrated to a list of owners, and a third run in the new schema; both readable."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("owner_sk"), "o_orderstatus")
    table = EvolvingTable(spark, scratch_path(spark, "fact_orders"), orders.drop("o_orderstatus").schema)
    for status, at in (("F", "2024-03-01"), ("O", "2024-03-02")):
        table.append(orders.where(F.col("o_orderstatus") == status), at)
    table.migrate({"owner_sks": "array(owner_sk)"}, drop=["owner_sk"], legacy="fact_orders_single")
    pending = orders.where("o_orderstatus = 'P'")
    table.append(pending.select("o_orderkey", F.array("owner_sk", F.col("owner_sk") + 1).alias("owner_sks")), "2024-03-03")
    now = table.read().select("o_orderkey", as_text("owner_sks").alias("owners"), F.lit("now").alias("read_as"))
    old = table.read_legacy("fact_orders_single").select("o_orderkey", F.col("owner_sk").cast("string").alias("owners"), F.lit("legacy").alias("read_as"))
    return now.unionByName(old)


MIGRATE_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN concat(o_custkey, ',', o_custkey + 1) ELSE CAST(o_custkey AS VARCHAR) END AS owners, 'now' AS read_as FROM orders
UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), 'legacy' FROM orders WHERE o_orderstatus <> 'P'"""

# ---- profiling ---------------------------------------------------------------------

# File names as people leave them in text columns, by document.
_ATTACHED = {
    "doc_id": "doc_id",
    "lang": "lang",
    "body": "text",
    "scan": "CASE WHEN lang = 'de' THEN concat('/in/', source, '.PDF?v=1') WHEN lang = 'fr' THEN 'pdf' ELSE '' END",
    "note": "CASE WHEN n_chars > 15000 THEN concat(source, '.docx') ELSE concat(source, '.pdf.bak') END",
    "contract_doc": "CASE WHEN n_chars > 15000 THEN concat(source, '.png#top') ELSE source END",
    "blank": "'  '",
    "weight": "CASE WHEN lang = 'es' THEN CAST('NaN' AS DOUBLE) WHEN lang = 'fr' THEN NULL ELSE n_chars * 0.5 END",
}
# The pattern as the JVM reads it: '.' stops at any line end, '$' may precede one.
_LINE_END = r"[\n\r\x{85}\x{2028}\x{2029}]"
_FILE_SQL = (
    rf"\.({'|'.join(FILE_EXTENSIONS)})([?#][^\n\r\x{{85}}\x{{2028}}\x{{2029}}]*)?(\r\n|{_LINE_END})?$"
)


def attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    exprs = [f"{e} AS {c}" for c, e in _ATTACHED.items()]
    return read(spark, sf_dir, "documents").selectExpr(*exprs)


ATTACHED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _ATTACHED.items()) + " FROM documents"
_TYPES = {"doc_id": "bigint", "weight": "double"}


def profile_sql() -> str:
    parts = []
    for column in _ATTACHED:
        kind = _TYPES.get(column, "string")
        filled = f"{column} IS NOT NULL"
        like = "FALSE"
        if kind == "string":
            filled += f" AND length(trim({column})) > 0"
            like = f"regexp_matches(lower({column}), '{_FILE_SQL}')"
        elif kind == "double":
            filled += f" AND NOT isnan({column})"
        parts.append(
            f"SELECT '{column}' AS \"column\", '{kind}' AS type, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {filled}) AS n_filled, count(*) FILTER (WHERE {like}) AS n_file_like FROM d"
        )
    return f"WITH d AS ({ATTACHED_SQL}),\np AS ({' UNION ALL '.join(parts)})\n"


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_columns(attached(spark, sf_dir))


def drop_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = profile.drop_decisions(profile.profile_columns(attached(spark, sf_dir)), force_drop=["Lang"])
    return decided.select("column", "n_filled", "n_file_like", "suspicious", "dropped")


_KEYWORD_SQL = " OR ".join(f"contains(lower(\"column\"), '{k}')" for k in profile.FILE_KEYWORDS)
DECISIONS_SQL = profile_sql() + f"""
SELECT "column", n_filled, n_file_like, suspicious,
  "column" = 'lang' OR (type = 'string' AND n_filled > 0
    AND n_file_like / n_filled >= CASE WHEN suspicious THEN {profile.DROP_SHARE_SUSPICIOUS} ELSE {profile.DROP_SHARE} END) AS dropped
FROM (SELECT *, "column" = 'lang' OR {_KEYWORD_SQL} AS suspicious FROM p)"""


def file_like_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicate on every attached value and on whole document texts."""
    df = attached(spark, sf_dir)
    return df.select("doc_id", *[is_file_like(F.col(c)).alias(c) for c in ("body", "scan", "note", "contract_doc", "blank")])


FILE_LIKE_SQL = f"WITH d AS ({ATTACHED_SQL}) SELECT doc_id, " + ", ".join(
    f"regexp_matches(lower({c}), '{_FILE_SQL}') AS {c}" for c in ("body", "scan", "note", "contract_doc", "blank")
) + " FROM d"

# ---- validation ----------------------------------------------------------------------


def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history.states(spark, sf_dir)
    return quality.reconcile(found["day1"], found["day2"], ["id"])


def reconcile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of ``reconcile_rows``, looking at rows only where digests of key buckets differ."""
    found = history.states(spark, sf_dir)
    return quality.reconcile_by_digest(found["day1"], found["day2"], ["id"])


RECONCILE_SQL = f"""WITH day1 AS ({history.DAY1}), day2 AS ({history.DAY2}), j AS (
SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'missing_target' WHEN a.id IS NULL THEN 'missing_source'
  WHEN NOT ({' AND '.join(f'a.{c} IS NOT DISTINCT FROM b.{c}' for c in history.BUSINESS)}) THEN 'mismatch' END AS kind
FROM day1 a FULL JOIN day2 b ON a.id = b.id)
"""


def reconcile_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile_verdict(reconcile_rows(spark, sf_dir), limit=200)


VERDICT_SQL = RECONCILE_SQL + """SELECT count(*) FILTER (WHERE kind = 'missing_target') AS missing_target,
  count(*) FILTER (WHERE kind = 'missing_source') AS missing_source, count(*) FILTER (WHERE kind = 'mismatch') AS mismatch,
  CAST(0 AS BIGINT) AS duplicate_key, count(*) > 200 AS suspended FROM j WHERE kind IS NOT NULL"""


def reconcile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, whose key repeats, against themselves (no finding) and against a copy with one line number changed in value."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    keys = ["l_orderkey", "l_linenumber"]
    changed = lines.withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_linenumber") == 3, 1).otherwise(0))
    same = quality.reconcile(lines, lines, keys).withColumn("run", F.lit("same"))
    return same.unionByName(quality.reconcile(lines, changed, keys).withColumn("run", F.lit("changed")))


RECONCILE_DUPLICATES_SQL = """SELECT l_orderkey, l_linenumber,
  CASE WHEN count(*) > 1 THEN 'duplicate_key' ELSE 'mismatch' END AS kind, 'changed' AS run
FROM lineitem WHERE l_linenumber = 3 GROUP BY 1, 2"""


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line keys, which repeat, and order keys, which do not."""
    lines = quality.key_check(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    orders = quality.key_check(read(spark, sf_dir, "orders"), ["o_orderkey"], "orders")
    gaps = quality.key_check(with_gaps(spark, sf_dir), ["customer"], "orders_with_gaps")
    return lines.unionByName(orders).unionByName(gaps)


def _key_check_sql(table: str, relation: str, keys: str, known: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", 'pk_duplicate' AS \"check\", (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM "
        f"(SELECT count(*) AS n FROM {relation} WHERE {known} GROUP BY {keys})) AS n_bad "
        f"UNION ALL SELECT '{table}', 'pk_null', (SELECT count(*) FROM {relation} WHERE NOT ({known}))"
    )


PK_SQL = " UNION ALL ".join(
    [
        _key_check_sql("lineitem", "lineitem", "l_orderkey, l_linenumber", "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL"),
        _key_check_sql("orders", "orders", "o_orderkey", "o_orderkey IS NOT NULL"),
        _key_check_sql("orders_with_gaps", f"({GAPS_SQL})", "customer", "customer IS NOT NULL"),
    ]
)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against customers without debt: every missing key with its rows."""
    orders = read(spark, sf_dir, "orders").select("o_custkey")
    customers = read(spark, sf_dir, "customer").where("c_acctbal > 0")
    return quality.orphans(orders, "o_custkey", customers, "c_custkey")


ORPHANS_SQL = """
SELECT o_custkey, count(*) AS n_rows, o_custkey = 0 AS is_unknown FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey"""


def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.col("l_partkey") + 1).alias("part_sk")
    )
    parts = sk_dim(read(spark, sf_dir, "part"), "part", "p_partkey").where("p_size > 10")
    suppliers = read(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return quality.reference_check(
        lines, "lineitem", [("part_sk", parts, "part_sk"), ("l_suppkey", suppliers, "s_suppkey")]
    )


REFERENCE_SQL = """WITH l AS (SELECT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_partkey + 1 END AS part_sk FROM lineitem)
SELECT 'lineitem' AS "table", 'fk_orphan:part_sk' AS "check", count(*) AS n_bad FROM l
  WHERE part_sk <> 0 AND part_sk NOT IN (SELECT p_partkey + 1 FROM part WHERE p_size > 10)
UNION ALL SELECT 'lineitem', 'fk_unknown:part_sk', count(*) FROM l WHERE part_sk = 0
UNION ALL SELECT 'lineitem', 'fk_orphan:l_suppkey', count(*) FROM l
  WHERE l_suppkey <> 0 AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
UNION ALL SELECT 'lineitem', 'fk_unknown:l_suppkey', count(*) FROM l
  WHERE l_suppkey = 0 AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""

_TYPED = {
    "o_orderkey": "o_orderkey",
    "level": "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE substring(o_orderpriority, 1, 1) END",
    "day": "CASE WHEN o_orderpriority = '5-LOW' THEN '1995-13-01' WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE '1995-12-01' END",
}
_CASTS = {"level": "bigint", "day": "date"}
TYPED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _TYPED.items()) + " FROM orders"


def typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _TYPED.items()])


def quarantine_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows with typed values, bad rows with the failing columns."""
    good, bad = quality.split_casts(typed_text(spark, sf_dir), _CASTS)
    return good.select(
        "o_orderkey", F.col("level").cast("string").alias("level"), F.col("day").cast("string").alias("day"),
        F.lit(None).cast("string").alias("bad_columns"),
    ).unionByName(bad.withColumn("bad_columns", F.array_join("bad_columns", ",")))


_FAILED = "(level IS NOT NULL AND TRY_CAST(level AS BIGINT) IS NULL) AS bad_level, (day IS NOT NULL AND TRY_CAST(day AS DATE) IS NULL) AS bad_day"
QUARANTINE_SQL = f"""
SELECT o_orderkey, level, day, CASE WHEN bad_level AND bad_day THEN 'level,day' WHEN bad_level THEN 'level' WHEN bad_day THEN 'day' END AS bad_columns
FROM (SELECT *, {_FAILED} FROM ({TYPED_SQL}))"""


def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cast_failures(typed_text(spark, sf_dir), _CASTS, limit=10)


CAST_FAILURES_SQL = f"""WITH f AS (SELECT {_FAILED} FROM ({TYPED_SQL}))
SELECT 'level' AS "column", count(*) FILTER (WHERE bad_level) AS n_failed, count(*) FILTER (WHERE bad_level OR bad_day) > 10 AS suspended FROM f
UNION ALL SELECT 'day', count(*) FILTER (WHERE bad_day), count(*) FILTER (WHERE bad_level OR bad_day) > 10 FROM f"""


def lob_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large objects with their size and the extract's limit as a flag; the digest covers the whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.limit_lobs(docs, ["text"]).select("doc_id", F.md5("text").alias("digest"), "text_size", "text_over_limit")


_LOB = quality.LOB_LIMIT_KB * 1024
LOB_SQL = f"""
SELECT doc_id, md5(text) AS digest, length(text) AS text_size, length(text) > {_LOB} AS text_over_limit FROM documents"""

# ---- catalogue and files -----------------------------------------------------------

def landed_by_nation(spark: SparkSession, sf_dir: str) -> str:
    """A folder of suppliers per nation; files with debtors have a wider key and one column more."""
    root = scratch_path(spark, "landed-nations")
    suppliers = read(spark, sf_dir, "supplier")
    debtors = suppliers.where("s_acctbal < 0").withColumn("s_debt", -F.col("s_acctbal"))
    others = suppliers.where("s_acctbal IS NULL OR s_acctbal >= 0").withColumn("s_suppkey", F.col("s_suppkey").cast("int"))
    for df in (others, debtors):
        df.repartition("s_nationkey").write.mode("append").partitionBy("s_nationkey").parquet(root)
    return root


def nation_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows of one supplier table for every nation that has customers."""
    columns = (("s_suppkey", "int"), ("s_name", "string"), ("s_acctbal", "double"))
    known = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in columns])
    nations = read(spark, sf_dir, "customer").select(F.concat(F.lit("s_nationkey="), "c_nationkey").alias("table")).distinct()
    return nations.select("table", F.explode(known).alias("c")).select("table", "c.*")


def landed_rows(spark: SparkSession, root: str) -> DataFrame:
    counted = spark.read.parquet(root).groupBy("s_nationkey").agg(F.count("*").alias("n_rows"))
    return counted.select(F.concat(F.lit("s_nationkey="), "s_nationkey").alias("table"), "n_rows")


def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders landed per nation against a catalogue of the nations with customers, with the rows that lie there."""
    root = landed_by_nation(spark, sf_dir)
    diff = sync.sync_diff(sync.landed_schemas(spark, root), nation_catalogue(spark, sf_dir))
    return diff.join(landed_rows(spark, root), "table", "left")


_NATIONS_SQL = """f AS (SELECT s_nationkey AS k, count(*) AS n_rows, coalesce(bool_or(s_acctbal < 0), FALSE) AS debt FROM supplier GROUP BY 1),
c AS (SELECT DISTINCT c_nationkey AS k FROM customer)"""

SYNC_SQL = f"""WITH {_NATIONS_SQL}, d AS (
  SELECT coalesce(f.k, c.k) AS k, n_rows, unnest(CASE
    WHEN c.k IS NULL THEN [{{'c': NULL, 'a': 'create_table', 'o': NULL, 'n': NULL}}]
    WHEN f.k IS NULL THEN [{{'c': NULL, 'a': 'drop_table', 'o': NULL, 'n': NULL}}]
    WHEN debt THEN [{{'c': 's_debt', 'a': 'add_column', 'o': NULL, 'n': 'double'}}, {{'c': 's_suppkey', 'a': 'change_type', 'o': 'int', 'n': 'bigint'}}]
    ELSE [] END) AS x FROM f FULL JOIN c ON f.k = c.k)
SELECT 's_nationkey=' || k AS "table", x.c AS "column", x.a AS action, x.o AS old_type, x.n AS new_type, n_rows FROM d"""


def landed_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """Folders as several extracts leave them: other types, missing and further columns from file to file."""
    root = scratch_path(spark, "landed")
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    parts = {
        "orders": [orders.where(urgent).withColumn("o_custkey", F.col("o_custkey").cast("int")), orders.where(~urgent)],
        "customer": [customer.drop("c_acctbal"), customer.drop("c_acctbal").withColumn("c_note", F.lit(1)).limit(0),
                     customer.drop("c_acctbal").withColumn("c_note", F.lit("x")).limit(0)],
        "nation": [read(spark, sf_dir, "nation")],
        "supplier": [read(spark, sf_dir, "supplier").withColumn("s_nationkey", F.col("s_nationkey").cast("smallint")),
                     read(spark, sf_dir, "supplier").drop("s_name")],
    }
    for name, frames in parts.items():
        for df in frames:
            df.write.mode("append").parquet(f"{root}/{name}")
    return root


def folder_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas found in landed folders: the least types that hold what all files of a table have."""
    return sync.landed_schemas(spark, landed_in_parts(spark, sf_dir))


def _described(table: str) -> str:
    kinds = {"VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int"}
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in kinds.items())
    return (
        f"SELECT '{table}' AS \"table\", column_name AS \"column\", CASE column_type {cases} ELSE lower(column_type) END AS type "
        f"FROM (DESCRIBE {table})"
    )


_LANDED_SQL = (
    f"{_described('orders')} UNION ALL {_described('nation')} UNION ALL {_described('supplier')} "
    f"UNION ALL SELECT * FROM ({_described('customer')}) WHERE \"column\" <> 'c_acctbal' "
    "UNION ALL SELECT 'customer', 'c_note', 'string'"
)


def sync_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sync of those folders with a catalogue of the given tables would do."""
    catalogue = tables.schema_rows(spark, {t: read(spark, sf_dir, t).schema for t in ("orders", "customer", "nation", "part")})
    return sync.sync_diff(sync.landed_schemas(spark, landed_in_parts(spark, sf_dir)), catalogue)


SYNC_LANDED_SQL = f"""WITH f AS ({_LANDED_SQL}),
c AS ({' UNION ALL '.join(_described(t) for t in ('orders', 'customer', 'nation', 'part'))})
SELECT coalesce(f."table", c."table") AS "table", coalesce(f."column", c."column") AS "column",
  CASE WHEN c.type IS NULL THEN 'add_column' WHEN f.type IS NULL THEN 'drop_column' ELSE 'change_type' END AS action,
  c.type AS old_type, f.type AS new_type
FROM f FULL JOIN c ON f."table" = c."table" AND f."column" = c."column"
WHERE f.type IS DISTINCT FROM c.type AND coalesce(f."table", c."table") IN (SELECT "table" FROM f)
  AND coalesce(f."table", c."table") IN (SELECT "table" FROM c)
UNION ALL SELECT DISTINCT "table", CAST(NULL AS VARCHAR), 'create_table', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM f WHERE "table" NOT IN (SELECT "table" FROM c)
UNION ALL SELECT DISTINCT "table", NULL, 'drop_table', NULL, NULL FROM c WHERE "table" NOT IN (SELECT "table" FROM f)"""


def raw_folders(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    root = scratch_path(spark, "raw")
    for name in names:
        tables.write_raw(read(spark, sf_dir, name), f"{root}/{name}")
    return root


def validate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder and a catalogue entry are expected for every nation."""
    root = landed_by_nation(spark, sf_dir)
    expected = read(spark, sf_dir, "nation").select(F.concat(F.lit("s_nationkey="), "n_nationkey").alias("table"))
    report = sync.validate_load(tables.file_listing(spark, root), nation_catalogue(spark, sf_dir), expected).drop("detail")
    return report.join(landed_rows(spark, root), "table", "left")


VALIDATE_SQL = f"""WITH {_NATIONS_SQL}, v AS (
  SELECT n_nationkey AS k, unnest([{{'c': 'has_files', 'ok': f.k IS NOT NULL}}, {{'c': 'in_catalogue', 'ok': c.k IS NOT NULL}}]) AS x, n_rows
  FROM nation LEFT JOIN f ON f.k = n_nationkey LEFT JOIN c ON c.k = n_nationkey)
SELECT 's_nationkey=' || k AS "table", x.c AS "check", x.ok AS ok, n_rows FROM v"""


def archive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "orders", "lineitem"]
    return tables.archive(spark, raw_folders(spark, sf_dir, names), scratch_path(spark, "archive"), names)


ARCHIVE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS n_rows, count(*) AS n_archived FROM {t}" for t in ("customer", "orders", "lineitem")
)


def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with file-like columns: landed, profiled, curated and read back."""
    raw, curated = scratch_path(spark, "raw"), scratch_path(spark, "curated")
    tables.write_raw(attached(spark, sf_dir), f"{raw}/documents")
    tables.write_raw(read(spark, sf_dir, "orders"), f"{raw}/orders")
    loads.curate_all(spark, raw, curated, ["documents", "orders", "no_such_table"]).collect()
    docs = tables.read_parquet(spark, f"{curated}/documents")
    orders = tables.read_parquet(spark, f"{curated}/orders")
    return docs.select(
        F.lit(",".join(docs.columns)).alias("kept"), "doc_id", F.md5("body").alias("digest"), "blank"
    ).unionByName(
        orders.select(
            F.lit(",".join(orders.columns)).alias("kept"), F.col("o_orderkey").alias("doc_id"),
            F.md5("o_orderpriority").alias("digest"), F.lit(None).cast("string").alias("blank"),
        )
    )


def curated_sql() -> str:
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_ATTACHED))
    return f"""{profile_sql()},
kept AS (SELECT string_agg("column", ',' ORDER BY CASE "column" {order} END) AS kept FROM p
  WHERE NOT (type = 'string' AND n_filled > 0 AND n_file_like / n_filled >=
    CASE WHEN {_KEYWORD_SQL} THEN {profile.DROP_SHARE_SUSPICIOUS} ELSE {profile.DROP_SHARE} END))
SELECT (SELECT kept FROM kept) AS kept, doc_id, md5(body) AS digest, blank FROM d
UNION ALL SELECT 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority', o_orderkey, md5(o_orderpriority), NULL FROM orders"""


# ---- mirror ----------------------------------------------------------------------------


def shipped_tables(spark: SparkSession, sf_dir: str):
    """The customer dimension after one and after two loads, and the first watermarks."""
    stages = history.states(spark, sf_dir)
    empty, dim = history.empty_dim(spark, stages["day1"])
    first = history.scd2.scd2_apply(empty, stages["day1"], dim, history.LOAD_TIMES[0])
    second = history.scd2.scd2_apply(first, stages["day2"], dim, history.LOAD_TIMES[1])
    return first, second, mirror.watermarks(first, dim.sk, "dim_customer", history.LOAD_TIMES[0])


def next_slice(spark: SparkSession, sf_dir: str):
    first, second, marks = shipped_tables(spark, sf_dir)
    mark = marks.first()
    return first, mirror.mirror_slice(second, "customer_sk", mark["last_max_sk"], mark["last_max_effective_from"]), marks


def mirror_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shipped after the second load: inserted and closed ones."""
    return history.shown(next_slice(spark, sf_dir)[1])


def mirror_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after upserting that slice equals the dimension."""
    first, shipped, _ = next_slice(spark, sf_dir)
    return history.shown(mirror.upsert_state(first, shipped, "customer_sk"))


def mirror_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, shipped, marks = next_slice(spark, sf_dir)
    update = mirror.watermarks(shipped, "customer_sk", "dim_customer", history.LOAD_TIMES[1])
    idle = mirror.watermarks(shipped.where("FALSE"), "customer_sk", "dim_customer", history.LOAD_TIMES[2])
    control = mirror.merge_control(mirror.merge_control(marks, update), idle)
    return control.select(
        "table_name", "last_max_sk", moment("last_max_effective_from").alias("last_max_effective_from"),
        moment("last_run_ts").alias("last_run_ts"),
    )


_TWO_LOADS = history.loads_sql(["day1", "day2"])
SLICE_SQL = f"""{_TWO_LOADS}
SELECT {history.SHOWN_SQL} FROM t2 WHERE customer_sk > (SELECT max(customer_sk) FROM t1)
  OR (effective_to > TIMESTAMP '{history.LOAD_TIMES[0]}' AND effective_to < TIMESTAMP '{OPEN_END}')"""
WATERMARK_SQL = f"""{_TWO_LOADS}
SELECT 'dim_customer' AS table_name, max(customer_sk) AS last_max_sk, '{history.LOAD_TIMES[1]}' AS last_max_effective_from,
  '{history.LOAD_TIMES[2]}' AS last_run_ts FROM t2"""


def mirror_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made safe and unique, types the target lacks sent as text."""
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_sk"), F.col("p_name").alias("User"), F.col("p_brand").alias("9lives"),
        F.col("p_type").alias("a--b"), F.col("p_size").cast("tinyint").alias("a_b"),
        F.create_map(F.lit("size"), "p_size").alias("order"), F.col("p_retailprice").alias("price"),
    )
    settings = mirror.MirrorSettings.from_properties({"mirror.rename.price": "Retail Price", "mirror.pk": "part_sk"})
    layout = mirror.layout(parts, "dim_part", settings)
    return mirror.mirror_projection(parts, layout).withColumn("pk", F.lit(layout.pk)).withColumn(
        "a_b_1", F.col("a_b_1").cast("int")
    )


PROJECTION_SQL = """
SELECT p_partkey AS part_sk, p_name AS user_col, p_brand AS _9lives, p_type AS a_b, CAST(p_size AS INTEGER) AS a_b_1,
  concat('{size -> ', p_size, '}') AS order_col, p_retailprice AS retail_price, 'part_sk' AS pk FROM part"""


def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mirror.unknown_member(sk_dim(read(spark, sf_dir, "supplier"), "supplier", "s_suppkey").drop("id"), "supplier_sk")


UNKNOWN_SQL = """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_suppkey + 1 AS supplier_sk FROM supplier
UNION ALL SELECT NULL, NULL, NULL, NULL, 0"""

QUERIES = {
    "null_fill": null_fill,
    "missing_columns": missing_columns,
    "conform_schema": conform_schema,
    "ancient_clamp": ancient_clamp,
    "migrate_scalar_to_array": scalar_to_array,
    "migrate_published_table": migrate_published,
    "profile_columns": profile_columns,
    "drop_decisions": drop_decisions,
    "file_like_share": file_like_values,
    "reconcile_rows": reconcile_rows,
    "reconcile_duplicates": reconcile_duplicates,
    "reconcile_digest": reconcile_digest,
    "reconcile_verdict": reconcile_verdict,
    "pk_duplicates": pk_duplicates,
    "fk_orphans": fk_orphans,
    "reference_check": reference_check,
    "quarantine_casts": quarantine_casts,
    "cast_failures": cast_failures,
    "lob_flags": lob_limit,
    "sync_diff": schema_sync,
    "folder_schemas": folder_schemas,
    "sync_landed": sync_landed,
    "validate_tables": validate_tables,
    "archive_counts": archive_counts,
    "curated_roundtrip": curated_roundtrip,
    "mirror_slice": mirror_slice,
    "mirror_upsert_state": mirror_upsert_state,
    "mirror_watermark": mirror_watermark,
    "mirror_projection": mirror_projection,
    "mirror_unknown_member": unknown_member,
}
ORACLES = {
    "null_fill": NULL_FILL_SQL,
    "missing_columns": MISSING_SQL,
    "conform_schema": CONFORM_SQL,
    "ancient_clamp": ANCIENT_SQL,
    "migrate_scalar_to_array": SCALAR_TO_ARRAY_SQL,
    "migrate_published_table": MIGRATE_SQL,
    "profile_columns": profile_sql() + "SELECT * FROM p",
    "drop_decisions": DECISIONS_SQL,
    "file_like_share": FILE_LIKE_SQL,
    "reconcile_duplicates": RECONCILE_DUPLICATES_SQL,
    "reconcile_rows": RECONCILE_SQL + "SELECT * FROM j WHERE kind IS NOT NULL",
    "reconcile_digest": RECONCILE_SQL + "SELECT * FROM j WHERE kind IS NOT NULL",
    "reconcile_verdict": VERDICT_SQL,
    "pk_duplicates": PK_SQL,
    "fk_orphans": ORPHANS_SQL,
    "reference_check": REFERENCE_SQL,
    "quarantine_casts": QUARANTINE_SQL,
    "cast_failures": CAST_FAILURES_SQL,
    "lob_flags": LOB_SQL,
    "sync_diff": SYNC_SQL,
    "folder_schemas": _LANDED_SQL,
    "sync_landed": SYNC_LANDED_SQL,
    "validate_tables": VALIDATE_SQL,
    "archive_counts": ARCHIVE_SQL,
    "curated_roundtrip": curated_sql(),
    "mirror_slice": SLICE_SQL,
    "mirror_upsert_state": f"{_TWO_LOADS}\nSELECT {history.SHOWN_SQL} FROM t2",
    "mirror_watermark": WATERMARK_SQL,
    "mirror_projection": PROJECTION_SQL,
    "mirror_unknown_member": UNKNOWN_SQL,
}
