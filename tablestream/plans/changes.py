"""Keyed changes, unique loads, snapshots and partition reloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import changes
from tablestream.plans.fixtures import plain, table
from tablestream.plans.registry import query
from tablestream.session import run_dir

BUCKETS = 16

CHANGES = """
target AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer),
changes AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS id,
         o_orderkey AS seq,
         CASE o_orderkey % 7 WHEN 0 THEN 'D' WHEN 1 THEN 'I' WHEN 2 THEN 'I' ELSE 'U' END AS op,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS name,
         CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS balance
  FROM orders),
marked AS (
  SELECT *, coalesce(last_value(CASE WHEN op <> 'U' THEN op END IGNORE NULLS)
                       OVER (PARTITION BY id ORDER BY seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                     CASE WHEN id IN (SELECT id FROM target) THEN 'I' ELSE 'D' END) = 'I' AS found
  FROM changes),
applied AS (
  SELECT * FROM marked WHERE CASE WHEN op = 'I' THEN NOT found ELSE found END)
"""


def _target_and_changes(spark: SparkSession, data: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, data, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    number, customer = F.col("o_orderkey"), F.col("o_custkey")
    op = (
        F.when(number % 7 == 0, "D").when((number % 7).isin(1, 2), "I").otherwise("U").alias("op")
    )
    log = table(spark, data, "orders").select(
        F.when(number % 11 == 0, customer + 1_000_000_000).otherwise(customer).alias("id"),
        number.alias("seq"),
        op,
        F.when(number % 3 == 0, F.col("o_orderpriority")).alias("name"),
        F.when(number % 2 == 0, F.col("o_totalprice")).alias("balance"),
    )
    return target, log


CHANGED = f"""
WITH {CHANGES},
life AS (
  SELECT id, max(seq) FILTER (WHERE op <> 'U') AS start,
         arg_max(op, seq) FILTER (WHERE op <> 'U') AS turn
  FROM applied GROUP BY 1),
fields AS (
  SELECT a.id, arg_max(a.name, a.seq) FILTER (WHERE a.name IS NOT NULL) AS name,
         arg_max(a.balance, a.seq) FILTER (WHERE a.balance IS NOT NULL) AS balance
  FROM applied a JOIN life l USING (id)
  WHERE a.op <> 'D' AND (l.start IS NULL OR a.seq >= l.start) GROUP BY 1)
SELECT id, coalesce(f.name, CASE WHEN turn IS NULL THEN t.name END) AS name,
       coalesce(f.balance, CASE WHEN turn IS NULL THEN t.balance END) AS balance
FROM target t FULL JOIN life l USING (id) LEFT JOIN fields f USING (id)
WHERE turn IS NULL OR turn <> 'D'
"""


@query(CHANGED)
def apply_changes(spark: SparkSession, data: str) -> DataFrame:
    target, log = _target_and_changes(spark, data)
    state, _ = changes.apply_changes(target, log, "id", "seq")
    return state


@query(CHANGED)
def apply_changes_to_buckets(spark: SparkSession, data: str) -> DataFrame:
    """The log in three batches, each on the partitions it touches; the second is repeated."""
    target, log = _target_and_changes(spark, data)
    path, staged = run_dir(spark, "bucketed"), run_dir(spark, "staged")
    changes.create_bucketed(target, path, "id", BUCKETS)
    borders = log.agg(F.percentile_approx("seq", [0.4, 0.7])).first()[0] or [0, 0]
    batch = sum(((F.col("seq") > b).cast("int") for b in borders), F.lit(0))
    for number in (0, 1, 1, 2):
        part = log.filter(batch == number)
        changes.apply_to_buckets(spark, path, part, "id", "seq", BUCKETS, f"{staged}/{number}")
    return spark.read.parquet(path).select("id", "name", "balance")


@query(f"""
WITH {CHANGES}
SELECT id, seq, op, CASE WHEN op = 'I' THEN 'exists' ELSE 'missing' END AS reason
FROM marked WHERE CASE WHEN op = 'I' THEN found ELSE NOT found END
""")
def rejected_changes(spark: SparkSession, data: str) -> DataFrame:
    target, log = _target_and_changes(spark, data)
    _, rejected = changes.apply_changes(target, log, "id", "seq")
    return rejected.select("id", "seq", "op", "reason")


@query("""
WITH old AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 97 = 0),
new AS (
  SELECT event_id, user_id, CASE WHEN event_id % 13 <> 0 THEN event_type END AS event_type
  FROM events WHERE event_id % 97 <> 0)
SELECT event_id, user_id, event_type,
       event_type IS NULL OR (
         NOT EXISTS (SELECT 1 FROM old WHERE old.user_id = new.user_id
                     AND old.event_type = new.event_type)
         AND event_id = min(event_id) OVER (PARTITION BY user_id, event_type)) AS accepted
FROM new
""")
def unique_on_load(spark: SparkSession, data: str) -> DataFrame:
    events = table(spark, data, "events").select("event_id", "user_id", "event_type")
    old = events.filter("event_id % 97 = 0")
    kind = F.when(F.col("event_id") % 13 != 0, F.col("event_type"))
    new = events.filter("event_id % 97 <> 0").withColumn("event_type", kind)
    return changes.mark_unique(old, new, ["user_id", "event_type"], "event_id")


@query("""
WITH first AS (
  SELECT o_orderkey, o_totalprice, o_orderdate AS updated_at FROM orders WHERE o_orderkey % 5 <> 0),
second AS (
  SELECT o_orderkey, o_totalprice + 1 AS o_totalprice,
         CASE o_orderkey % 3 WHEN 0 THEN o_orderdate + INTERVAL 1 DAY WHEN 1 THEN o_orderdate
              ELSE o_orderdate - INTERVAL 1 DAY END AS updated_at
  FROM orders WHERE o_orderkey % 4 <> 0)
SELECT f.o_orderkey, f.o_totalprice, f.updated_at, f.updated_at AS valid_from,
       CASE WHEN s.updated_at > f.updated_at THEN s.updated_at END AS valid_to
FROM first f LEFT JOIN second s USING (o_orderkey)
UNION ALL
SELECT o_orderkey, s.o_totalprice, s.updated_at, s.updated_at, NULL
FROM second s LEFT JOIN first f USING (o_orderkey)
WHERE f.updated_at IS NULL OR s.updated_at > f.updated_at
""")
def snapshot_scd2(spark: SparkSession, data: str) -> DataFrame:
    orders = table(spark, data, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").alias("updated_at")
    )
    number, moment = F.col("o_orderkey"), F.col("updated_at")
    first = orders.filter(number % 5 != 0)
    day = F.expr("INTERVAL 1 DAY")
    moved = F.when(number % 3 == 0, moment + day).when(number % 3 == 1, moment)
    second = orders.filter(number % 4 != 0).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "updated_at": moved.otherwise(moment - day)}
    )
    history = changes.snapshot(None, first, "o_orderkey", "updated_at")
    return plain(
        changes.snapshot(history, second, "o_orderkey", "updated_at"),
        "updated_at", "valid_from", "valid_to",
    )


NULL_KEYS = """
first AS (
  SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer, o_orderkey, o_totalprice,
         o_orderdate AS updated_at
  FROM orders WHERE o_orderkey % 5 <> 0),
second AS (
  SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer, o_orderkey, o_totalprice + 1 AS o_totalprice,
         o_orderdate + INTERVAL 30 DAY AS updated_at
  FROM orders WHERE o_orderkey % 4 = 0),
f AS (
  SELECT * FROM first QUALIFY row_number() OVER (
    PARTITION BY customer ORDER BY updated_at DESC, o_orderkey DESC, o_totalprice DESC) = 1),
s AS (
  SELECT * FROM second QUALIFY row_number() OVER (
    PARTITION BY customer ORDER BY updated_at DESC, o_orderkey DESC, o_totalprice DESC) = 1)
"""


@query(f"""
WITH {NULL_KEYS}
SELECT f.customer, f.o_orderkey, f.o_totalprice, f.updated_at, f.updated_at AS valid_from,
       CASE WHEN s.updated_at > f.updated_at THEN s.updated_at END AS valid_to
FROM f LEFT JOIN s ON s.customer IS NOT DISTINCT FROM f.customer
UNION ALL
SELECT s.customer, s.o_orderkey, s.o_totalprice, s.updated_at, s.updated_at, NULL
FROM s LEFT JOIN f ON s.customer IS NOT DISTINCT FROM f.customer
WHERE f.updated_at IS NULL OR s.updated_at > f.updated_at
""")
def snapshot_repeated_keys(spark: SparkSession, data: str) -> DataFrame:
    """Keys that are NULL or come several times in a load, on a bucketed history."""
    number = F.col("o_orderkey")
    orders = table(spark, data, "orders").select(
        F.when(number % 50 != 0, F.col("o_custkey")).alias("customer"), "o_orderkey", "o_totalprice",
        F.col("o_orderdate").alias("updated_at"),
    )
    later = F.col("updated_at") + F.expr("INTERVAL 30 DAY")
    second = orders.filter(number % 4 == 0).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "updated_at": later}
    )
    path, staged = run_dir(spark, "history"), run_dir(spark, "staged")
    history = changes.snapshot(None, orders.filter(number % 5 != 0), "customer", "updated_at")
    changes.create_bucketed(history, path, "customer", BUCKETS)
    for _ in range(2):  # the same load again opens no second version
        changes.snapshot_to_buckets(spark, path, second, "customer", "updated_at", BUCKETS, staged)
    return plain(spark.read.parquet(path).drop("bucket"), "updated_at", "valid_from", "valid_to")
