"""Scans, filters, projections, column functions, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.logs import (
    EVAL_DAY,
    HISTORY_DAYS,
    INFER_DAY,
    LOG_SQL,
    OBS_SQL,
    ROLES,
    USERS_SQL,
    WEEKEND_SQL,
)
from affinary.catalog.registry import query, rounded
from affinary.functions import calendar
from affinary.functions.columns import (
    conform,
    double_hash_index,
    drop_incomplete,
    fill_date,
    group_key,
    narrow_types,
    round_floats,
    string_part,
)
from affinary.functions.predicates import apply_filters
from affinary.functions.vectors import discount, dot, l2_normalize, pairwise_dots, sigmoid
from affinary.operators.assembly import encode, mapping_table
from affinary.operators.learning import fit_min_max
from affinary.operators.metrics import best_run, count_active_users, ideal_gain
from affinary.operators.pairs import first_per_key, latest_per_key, split_by_label, union_all
from affinary.operators.batching import count_mini_batches
from affinary.sources.scan import FeatureSource, partition_values, read_snapshot, scan, scan_as, scan_optimized
from affinary.sources.scratch import new_path
from affinary.sources.sinks import stamp, write_predictions, write_report, write_table

_START = calendar.days_before(EVAL_DAY, HISTORY_DAYS)


@query(f"WITH {LOG_SQL} SELECT * FROM log")
def interactions(spark, sf_dir):
    return logs.interactions(spark, sf_dir)


@query(
    f"""WITH {OBS_SQL}
    SELECT event_id, user_id, item_id, user_region, item_type, duration FROM obs
    WHERE filename_date >= 20240105 AND is_interacted IN (1, 2) AND duration > 12.5 AND user_region <> 'ASIA'
      AND item_type NOT IN ('SMALL', 'ECONOMY') AND popularity_item_group IS NOT NULL AND is_infering_user"""
)
def filter_strings(spark, sf_dir):
    filters = [
        "filename_date >= 20240105",
        "is_interacted in [1, 2]",
        "duration > 12.5",
        "user_region != 'ASIA'",
        "item_type not in ['SMALL', 'ECONOMY']",
        "popularity_item_group is not None",
        "is_infering_user is True",
    ]
    df = apply_filters(logs.observations(spark, sf_dir), filters)
    return df.select("event_id", "user_id", "item_id", "user_region", "item_type", "duration")


@query(
    f"""WITH {LOG_SQL} SELECT event_id, user_id, item_id FROM log
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
      AND item_id NOT IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2')"""
)
def filter_in_table(spark, sf_dir):
    building = logs.users(spark, sf_dir).filter("market_segment = 'BUILDING'")
    brand = logs.items(spark, sf_dir).filter("item_brand = 'Brand#2'")
    filters = [("user_id", "in", building), ("item_id", "not in", brand)]
    return apply_filters(logs.interactions(spark, sf_dir), filters).select("event_id", "user_id", "item_id")


@query(
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount <= 0.05"""
)
def scan_projected(spark, sf_dir):
    source = FeatureSource(spark, [f"{sf_dir}/lineitem.parquet"])
    return source.extract(["l_orderkey", "l_partkey", "l_quantity"], ["l_shipdate >= '1996-01-01'", "l_discount <= 0.05"])


@query(
    f"""WITH {LOG_SQL} SELECT event_id, filename_date, {WEEKEND_SQL.format(date="filename_date")} AS is_weekend,
    CAST(dayofweek(strptime(CAST(filename_date AS VARCHAR), '%Y%m%d')) AS INTEGER) AS encoded_weekday FROM log"""
)
def weekend_flag(spark, sf_dir):
    return logs.interactions(spark, sf_dir).select(
        "event_id",
        "filename_date",
        calendar.is_weekend().alias("is_weekend"),
        calendar.encoded_weekday("filename_date").alias("encoded_weekday"),
    )


@query(
    f"""WITH {LOG_SQL} SELECT filename_date,
      CAST(strftime(strptime(CAST(filename_date AS VARCHAR), '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d') AS INTEGER) AS week_before,
      count(*) AS n_rows
    FROM log WHERE filename_date < {EVAL_DAY} AND filename_date >= {_START} GROUP BY 1"""
)
def date_window(spark, sf_dir):
    window = calendar.window_filters(EVAL_DAY, HISTORY_DAYS)
    counts = apply_filters(logs.interactions(spark, sf_dir), window).groupBy("filename_date")
    counted = counts.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("week_before", calendar.shift_days("filename_date", 7))


@query(
    f"""WITH {LOG_SQL}, parts AS (
      SELECT 'full train' AS split, * FROM log WHERE filename_date >= {_START} AND filename_date < {EVAL_DAY}
      UNION ALL SELECT 'full validation', * FROM log WHERE filename_date = {EVAL_DAY}
      UNION ALL SELECT 'refit train', * FROM log WHERE filename_date >= {EVAL_DAY} AND filename_date <= {INFER_DAY}
      UNION ALL SELECT 'moved train', * FROM log WHERE filename_date = {EVAL_DAY} AND duration > 10)
    SELECT split, filename_date, count(*) AS n_rows FROM parts GROUP BY 1, 2"""
)
def temporal_split(spark, sf_dir):
    log = logs.interactions(spark, sf_dir)
    full = calendar.full_training_split(INFER_DAY, HISTORY_DAYS)
    refit = calendar.refit_split(INFER_DAY)
    old = ["filename_date == 20240102", "duration > 10"]
    moved = calendar.split_for_inference(old, old, INFER_DAY, refit=True)
    named = {
        "full train": full.train,
        "full validation": full.validation,
        "refit train": refit.train,
        "moved train": moved.train,
    }
    parts = [apply_filters(log, filters).select(F.lit(name).alias("split"), "filename_date") for name, filters in named.items()]
    return union_all(*parts).groupBy("split", "filename_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"WITH {LOG_SQL} SELECT DISTINCT user_id, item_id, is_interacted FROM log")
def distinct_rows(spark, sf_dir):
    return logs.interactions(spark, sf_dir).select("user_id", "item_id", "is_interacted").distinct()


@query(
    f"""WITH {LOG_SQL} SELECT event_id, user_id, item_id, filename_date, is_interacted FROM log
    QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY event_id) = 1"""
)
def distinct_first(spark, sf_dir):
    log = logs.interactions(spark, sf_dir).select("event_id", "user_id", "item_id", "filename_date", "is_interacted")
    return first_per_key(log, ["user_id", "item_id"], ["event_id"])


@query(
    f"""WITH {OBS_SQL} SELECT user_id, item_id, market_segment, user_region, user_nation, item_brand, item_type,
    is_weekend, is_interacted, round(weighted_lr, 6) AS weighted_lr, duration FROM obs"""
)
def role_projection(spark, sf_dir):
    return rounded(logs.observations(spark, sf_dir).select(*ROLES.select_order()))


_SEGMENTS = {"BUILDING": 1, "AUTOMOBILE": 2, "MACHINERY": 3, "FURNITURE": 4}
_ENCODED = """encoded AS (
  SELECT user_id, user_nation, CASE market_segment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2
    WHEN 'MACHINERY' THEN 3 WHEN 'FURNITURE' THEN 4 END AS market_segment FROM users)"""


def _encoded(spark, sf_dir) -> DataFrame:
    mapping = mapping_table(spark, {"market_segment_mapping": _SEGMENTS}, "market_segment")
    people = logs.users(spark, sf_dir).select("user_id", "user_nation", "market_segment")
    return encode(people, "market_segment", mapping)


@query(f"WITH {USERS_SQL}, {_ENCODED} SELECT * FROM encoded")
def encode_lookup(spark, sf_dir):
    return _encoded(spark, sf_dir)


@query(f"WITH {USERS_SQL}, {_ENCODED} SELECT * FROM encoded WHERE market_segment IS NOT NULL")
def drop_null_rows(spark, sf_dir):
    return drop_incomplete(_encoded(spark, sf_dir))


@query("SELECT p_partkey, p_name, CAST(p_size AS TINYINT) AS p_size, round_even(p_retailprice, 0) AS p_retailprice FROM part WHERE p_size > 5")
def scan_narrowed(spark, sf_dir):
    """A scan with narrow types and rounded floats."""
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    path = f"{sf_dir}/part.parquet"
    return scan_optimized(spark, path, {"p_size": "int8"}, 0, columns=columns, filters=["p_size > 5"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def scan_cast(spark, sf_dir):
    """A scan cast to a given schema; the filter column is not among the selected ones."""
    columns, filters = ["c_custkey", "c_mktsegment"], ["c_acctbal >= 0"]
    path = f"{sf_dir}/customer.parquet"
    return scan_as(spark, path, {"c_custkey": "string"}, columns=columns, filters=filters)


@query("SELECT part.*, 20230101 AS filename_date FROM part")
def fill_missing_date(spark, sf_dir):
    return fill_date(logs.table(spark, sf_dir, "part"), "filename_date", calendar.DEFAULT_DATE)


@query(
    f"""WITH {LOG_SQL} SELECT CASE is_interacted WHEN 2 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'exclude' END AS part,
    count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM log GROUP BY 1"""
)
def label_split(spark, sf_dir):
    parts = split_by_label(logs.interactions(spark, sf_dir), ROLES)
    named = [df.select(F.lit(name).alias("part"), "user_id") for name, df in parts.items()]
    counts = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_users")]
    return union_all(*named).groupBy("part").agg(*counts)


@query(
    """SELECT p_partkey, CAST(p_size AS TINYINT) AS p_size, round(CAST(p_retailprice AS FLOAT), 6) AS p_retailprice,
    p_name FROM part"""
)
def narrow_types_checked(spark, sf_dir):
    part = logs.table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_name")
    # part keys and names do not fit and stay as they are
    types = {"p_partkey": "int8", "p_size": "int8", "p_retailprice": "float32", "p_name": "int32", "absent": "int8"}
    return rounded(narrow_types(part, types))


@query("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_name FROM customer")
def cast_to_schema(spark, sf_dir):
    customers = logs.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    return conform(customers, {"c_custkey": "int32", "c_nationkey": "int64"})


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_extendedprice * l_discount / 7, 6) AS amount
    FROM lineitem"""
)
def round_floats_even(spark, sf_dir):
    amount = (F.col("l_extendedprice") * F.col("l_discount") / 7).alias("amount")
    lines = logs.table(spark, sf_dir, "lineitem")
    return round_floats(lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount))


@query(
    """SELECT p_partkey, string_split(p_brand, '#')[2] AS brand_no, TRY_CAST(string_split(p_brand, '#')[2] AS DOUBLE) AS brand_number,
    TRY_CAST(string_split(p_name, ' ')[1] AS DOUBLE) AS not_a_number, string_split(p_name, ' ')[4] AS no_such_part FROM part"""
)
def string_parts(spark, sf_dir):
    return logs.table(spark, sf_dir, "part").select(
        "p_partkey",
        string_part("p_brand", "#", 1).alias("brand_no"),
        string_part("p_brand", "#", 1, numeric=True).alias("brand_number"),
        string_part("p_name", " ", 0, numeric=True).alias("not_a_number"),
        string_part("p_name", " ", 3).alias("no_such_part"),
    )


@query(
    f"""WITH {OBS_SQL} SELECT concat_ws('@', popularity_item_group, filename_date) AS band_date, count(*) AS n_rows
    FROM obs GROUP BY 1"""
)
def sample_group_key(spark, sf_dir):
    key = group_key("popularity_item_group", "filename_date").alias("band_date")
    return logs.observations(spark, sf_dir).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""WITH {LOG_SQL}, days AS (SELECT DISTINCT filename_date FROM log),
    dated AS (SELECT filename_date, strptime(CAST(filename_date AS VARCHAR), '%Y%m%d') AS d FROM days)
    SELECT filename_date, concat_ws('-', isoyear(d), weekofyear(d)) AS week_key,
      CAST(isoyear(d) AS INTEGER) AS iso_year, CAST(weekofyear(d) AS INTEGER) AS iso_week FROM dated"""
)
def iso_week_key(spark, sf_dir):
    days = logs.interactions(spark, sf_dir).select("filename_date").distinct()
    return days.select(
        "filename_date",
        calendar.iso_week_key("filename_date").alias("week_key"),
        calendar.iso_year("filename_date").alias("iso_year"),
        calendar.iso_week("filename_date").alias("iso_week"),
    )


@query(
    """WITH bounds AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_tax) AS t0, max(l_tax) AS t1 FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - q0) / (q1 - q0), 6) AS quantity_scaled,
      round((l_tax - t0) / (t1 - t0), 6) AS tax_scaled, CAST(0.5 AS DOUBLE) AS constant_scaled
    FROM lineitem, bounds"""
)
def min_max_scaled(spark, sf_dir):
    lines = logs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", F.lit(3).alias("l_constant")
    )
    targets = {"l_quantity": "quantity_scaled", "l_tax": "tax_scaled", "l_constant": "constant_scaled"}
    return rounded(fit_min_max(lines, list(targets)).transform(lines, targets))


@query(
    f"""WITH {LOG_SQL} SELECT user_id, filename_date, event_id, item_id FROM log WHERE filename_date < {EVAL_DAY}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY filename_date DESC, event_id DESC) = 1"""
)
def latest_snapshot(spark, sf_dir):
    log = logs.interactions(spark, sf_dir).select("user_id", "filename_date", "event_id", "item_id")
    return latest_per_key(log, ["user_id"], "filename_date", EVAL_DAY)


# ---- written tables -------------------------------------------------------


def _written_log(spark, sf_dir) -> str:
    """The log stored the way the jobs expect it: partitioned by date and label."""
    path = new_path(spark, "log")
    log = logs.interactions(spark, sf_dir).repartition("filename_date", "is_interacted")
    write_table(log, path, ["filename_date", "is_interacted"])
    return path


@query(f"WITH {LOG_SQL} SELECT filename_date, is_interacted, count(*) AS n_rows, round(sum(duration), 4) AS watched FROM log GROUP BY 1, 2")
def partition_values_from_paths(spark, sf_dir):
    # the directories are read as plain files here, the values come from their paths alone
    files = spark.read.option("recursiveFileLookup", True).parquet(_written_log(spark, sf_dir))
    named = partition_values(files, {"filename_date": True, "is_interacted": True})
    sums = [F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("duration"), 4).alias("watched")]
    return named.groupBy("filename_date", "is_interacted").agg(*sums)


@query(
    f"""WITH {LOG_SQL} SELECT event_id, filename_date, is_interacted, duration FROM log
    WHERE filename_date >= 20240110 AND filename_date <> 20240115 AND is_interacted NOT IN (0) AND duration < 60"""
)
def partition_scan(spark, sf_dir):
    filters = ["filename_date >= 20240110", "filename_date != 20240115", "is_interacted not in [0]", "duration < 60"]
    columns = ["event_id", "filename_date", "is_interacted", "duration"]
    return scan(spark, _written_log(spark, sf_dir), columns, filters, merge_schema=True)


@query(
    f"""WITH {LOG_SQL} SELECT event_id, filename_date,
      CASE WHEN filename_date >= 20240125 THEN duration + 1000 ELSE duration END AS duration FROM log"""
)
def write_read_back(spark, sf_dir):
    path = new_path(spark, "replaced")
    log = logs.interactions(spark, sf_dir).select("event_id", "duration", "filename_date")
    write_table(log.repartition("filename_date"), path, ["filename_date"])
    newer = log.filter("filename_date >= 20240125").withColumn("duration", F.col("duration") + 1000)
    write_table(newer.repartition("filename_date"), path, ["filename_date"], "replace_partitions")
    return scan(spark, path).select("event_id", "filename_date", "duration")


@query(f"WITH {USERS_SQL} SELECT user_id, market_segment, user_region FROM users")
def snapshot_lookup(spark, sf_dir):
    folder = new_path(spark, "user_features")
    people = logs.users(spark, sf_dir).select(F.col("user_id").alias("key0"), "market_segment", "user_region")
    write_table(people, f"{folder}/{EVAL_DAY}")
    return read_snapshot(spark, folder, EVAL_DAY, "user_id")


@query(
    f"""WITH {OBS_SQL}, counts AS (
      SELECT 'user_region' AS feature, user_region AS value, count(*) AS sample_count FROM obs GROUP BY 2
      UNION ALL SELECT 'item_type', item_type, count(*) FROM obs GROUP BY 2)
    SELECT feature, value, sample_count, '2024-01-31 00:00:00' AS evaluate_time, 'clicks' AS model_name, 'val' AS data_type
    FROM counts"""
)
def report_sink(spark, sf_dir):
    obs = logs.observations(spark, sf_dir).select("user_region", "item_type")
    long = obs.unpivot([], ["user_region", "item_type"], "feature", "value")
    report = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("sample_count"))
    path = new_path(spark, "report")
    write_report(stamp(report, "2024-01-31 00:00:00", "clicks", "val"), path, order_by=["sample_count"])
    stored = spark.read.option("header", True).csv(path)
    return stored.select(
        "feature",
        "value",
        F.col("sample_count").cast("bigint").alias("sample_count"),
        "evaluate_time",
        "model_name",
        "data_type",
    )


@query(f"WITH {LOG_SQL} SELECT event_id, user_id, item_id, round(1 / (1 + exp(-(duration - 25) / 25)), 6) AS prediction FROM log")
def prediction_sink(spark, sf_dir):
    log = logs.interactions(spark, sf_dir)
    scored = log.select("event_id", "user_id", "item_id", sigmoid((F.col("duration") - 25) / 25).alias("prediction"))
    return rounded(write_predictions(scored, new_path(spark, "predictions"), "csv"))


# ---- scalar and vector functions -----------------------------------------


@query(
    f"""WITH {LOG_SQL}, spans AS (SELECT user_id, count(*) AS n FROM log GROUP BY 1)
    SELECT user_id, n, round(1 / log2(n + 1), 6) AS discounted,
      round(list_sum(list_transform(range(1, least(n, 20) + 1), lambda i: 1 / log2(i + 1))), 6) AS ideal_gain_20
    FROM spans"""
)
def discounts(spark, sf_dir):
    counts = logs.interactions(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return rounded(counts.select("user_id", "n", discount(n).alias("discounted"), ideal_gain(n, 20).alias("ideal_gain_20")))


def _slot_sql(seed: str, column: str, size: int) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {column})), 1, 15) AS BIGINT) % {size}"


@query(
    f"""WITH {LOG_SQL} SELECT event_id,
      {_slot_sql("a", "user_id", 600014)} + {_slot_sql("b", "user_id", 600014)} AS user_index,
      {_slot_sql("a", "item_id", 600014)} + {_slot_sql("b", "item_id", 600014)} AS item_index FROM log"""
)
def double_hash_indexes(spark, sf_dir):
    return logs.interactions(spark, sf_dir).select(
        "event_id",
        double_hash_index("user_id", 600014).alias("user_index"),
        double_hash_index("item_id", 600014).alias("item_index"),
    )


_SIXTEENTHS = ", ".join(f"CAST(embedding[{16 * i + 1}:{16 * i + 16}] AS DOUBLE[]) AS v{i}" for i in range(4))
_DOTS = ", ".join(f"round(list_dot_product(v{i}, v{j}), 6) AS d{i}{j}" for i in range(4) for j in range(i))


@query(f"WITH parts AS (SELECT vec_id, {_SIXTEENTHS} FROM embeddings) SELECT vec_id, {_DOTS} FROM parts")
def pairwise_dot_products(spark, sf_dir):
    parts = [F.slice("embedding", 16 * i + 1, 16) for i in range(4)]
    vectors = logs.table(spark, sf_dir, "embeddings").select("vec_id", pairwise_dots(parts).alias("dots"))
    names = [f"d{i}{j}" for i in range(4) for j in range(i)]
    return rounded(vectors.select("vec_id", *[F.col("dots")[at].alias(name) for at, name in enumerate(names)]))


@query(
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(e[i] / sqrt(list_dot_product(e, e)), 6) AS unit
    FROM v, unnest(range(1, len(e) + 1)) AS places(i)"""
)
def unit_vectors(spark, sf_dir):
    """Every component of every vector at length one."""
    vectors = logs.table(spark, sf_dir, "embeddings")
    return rounded(vectors.select("vec_id", F.posexplode(l2_normalize(F.col("embedding"))).alias("place", "unit")))


@query(
    f"""WITH {LOG_SQL} SELECT 'mini batches' AS counted, count(DISTINCT batch_idx) AS n FROM log
    UNION ALL SELECT 'active users', count(DISTINCT user_id) FROM log WHERE is_interacted = 2"""
)
def distinct_counts(spark, sf_dir):
    log = logs.interactions(spark, sf_dir)
    batches = count_mini_batches(log, ROLES).select(F.lit("mini batches").alias("counted"), F.col("n_mini_batches").alias("n"))
    active = count_active_users(log, ROLES).select(F.lit("active users").alias("counted"), F.col("active_users").alias("n"))
    return union_all(batches, active)


@query(
    f"""WITH {LOG_SQL}, daily AS (SELECT filename_date, avg(duration) AS score FROM log GROUP BY 1)
    SELECT round(max(score), 6) AS best_score, min_by(filename_date, (-score, filename_date)) AS best_run FROM daily"""
)
def best_day(spark, sf_dir):
    daily = logs.interactions(spark, sf_dir).groupBy("filename_date").agg(F.avg("duration").alias("score"))
    return rounded(best_run(daily, "filename_date", "score"))
