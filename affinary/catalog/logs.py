"""The given tables seen as interaction logs, with the SQL that derives the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinary.functions.calendar import is_weekend, to_int
from affinary.roles import JobSpec, Resampling, Roles

INFER_DAY = 20240131
EVAL_DAY = 20240130
HISTORY_DAYS = 20

ROLES = Roles(
    row_id="event_id",
    account_features=("market_segment", "user_region"),
    profile_features=("user_nation",),
    item_features=("item_brand", "item_type"),
)
SPEC = JobSpec(
    name="clicks",
    roles=ROLES,
    resampling=Resampling(popular={1: 0.1, 2: 0.05}, tail={3: 0.5, 4: 0.3, 5: 0.25, 0: 1.0}),
    batch_size=200,
)
FEATURES = ["market_segment", "user_region", "user_nation", "item_brand", "item_type", "is_weekend"]
BAND_CUTS = (5, 15, 50, 80)
ORDER_BAND_CUTS = (100, 300, 1000, 2000)
ORDER_ROLES = Roles(row_id="event_id")
JOIN_ROWS = 1 << 18  # order lines in a task that brings them together with their orders
ORDER_SPEC = JobSpec(name="orders", roles=ORDER_ROLES, resampling=SPEC.resampling, batch_size=1000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as interactions: purchases and signups positive, clicks and views negative, errors excluded."""
    kind = F.col("event_type")
    negative = kind.isin("click", "view")
    label = F.when(kind.isin("purchase", "signup"), 2).when(negative, 1).otherwise(0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        to_int(F.col("ts")).alias("filename_date"),
        label.alias("is_interacted"),
        F.col("value").alias("duration"),
        F.when(negative, 1.0).otherwise(1 + F.col("value") / 100).alias("weighted_lr"),
        (F.col("user_id") % 4).alias("batch_idx"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("n_name").alias("user_nation"),
        F.col("r_name").alias("user_region"),
        (F.col("c_acctbal") >= 0).alias("is_infering_user"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("item_brand"),
        F.col("p_type").alias("item_type"),
        F.col("p_size").alias("item_size"),
    )


def with_bands(log: DataFrame, cuts: tuple[int, ...]) -> DataFrame:
    """Add the popularity band of the item: 1 for the most popular, 0 without positives.

    Only the head needs places, so the items are ranked by a distributed top-n.
    """
    counts = log.filter("is_interacted = 2").groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    head = counts.orderBy(F.desc("_n"), "item_id").limit(cuts[-1])
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_n"), "item_id"))
    head = head.select("item_id", place.alias("_place"))
    band: Column = F.lit(len(cuts) + 1)
    for number, cut in reversed(list(enumerate(cuts, start=1))):
        band = F.when(F.col("_place") <= cut, number).otherwise(band)
    bands = counts.join(head, "item_id", "left").select("item_id", band.alias("popularity_item_group"))
    joined = log.join(bands, "item_id", "left")
    return joined.withColumn("popularity_item_group", F.coalesce("popularity_item_group", F.lit(0)))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with user and item features joined in, as a feature store would deliver it."""
    log = with_bands(interactions(spark, sf_dir), BAND_CUTS)
    joined = log.join(users(spark, sf_dir), "user_id").join(items(spark, sf_dir), "item_id")
    return joined.withColumn("is_weekend", is_weekend())


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as interactions, a longer log with many items.

    Both sides are cut into as many parts as there are lines for, so what a task of the join sorts does not grow.
    """
    lines = table(spark, sf_dir, "lineitem")
    # the files' footers tell the count
    n_parts = max(1, -(-lines.count() // JOIN_ROWS))
    orders = table(spark, sf_dir, "orders").repartition(n_parts, "o_orderkey")
    joined = lines.repartition(n_parts, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        to_int(F.col("o_orderdate")).alias("filename_date"),
        F.when(flag == "A", 2).when(flag == "N", 1).otherwise(0).alias("is_interacted"),
        F.col("l_quantity").alias("duration"),
        (1 - F.col("l_discount")).alias("weighted_lr"),
        F.col("l_extendedprice").alias("price"),
    )


LOG_SQL = """
log AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS filename_date,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 2
              WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS is_interacted,
         value AS duration,
         CASE WHEN event_type IN ('click', 'view') THEN CAST(1 AS DOUBLE) ELSE 1 + value / 100 END AS weighted_lr,
         user_id % 4 AS batch_idx
  FROM events)"""

USERS_SQL = """
users AS (
  SELECT c_custkey AS user_id, c_mktsegment AS market_segment, n_name AS user_nation, r_name AS user_region,
         c_acctbal >= 0 AS is_infering_user
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ITEMS_SQL = """
items AS (
  SELECT p_partkey AS item_id, p_brand AS item_brand, p_type AS item_type, p_size AS item_size FROM part)"""

WEEKEND_SQL = "CASE WHEN dayofweek(strptime(CAST({date} AS VARCHAR), '%Y%m%d')) IN (0, 6) THEN 1 ELSE 0 END"


def bands_sql(log: str, cuts: tuple[int, ...], name: str = "bands") -> str:
    arms = " ".join(f"WHEN place <= {cut} THEN {number}" for number, cut in enumerate(cuts, start=1))
    return f"""
{name} AS (
  SELECT item_id, CASE {arms} ELSE {len(cuts) + 1} END AS popularity_item_group
  FROM (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place
        FROM {log} WHERE is_interacted = 2 GROUP BY item_id))"""


OBS_SQL = f"""{LOG_SQL},{USERS_SQL},{ITEMS_SQL},{bands_sql("log", BAND_CUTS)},
obs AS (
  SELECT log.*, market_segment, user_nation, user_region, is_infering_user, item_brand, item_type, item_size,
         coalesce(popularity_item_group, 0) AS popularity_item_group,
         {WEEKEND_SQL.format(date="filename_date")} AS is_weekend
  FROM log JOIN users USING (user_id) JOIN items USING (item_id) LEFT JOIN bands USING (item_id))"""

ORDERS_SQL = f"""
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
         o_custkey AS user_id, l_partkey AS item_id,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS filename_date,
         CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END AS is_interacted,
         l_quantity AS duration, 1 - l_discount AS weighted_lr, l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),{bands_sql("lines", ORDER_BAND_CUTS, "line_bands")}"""
