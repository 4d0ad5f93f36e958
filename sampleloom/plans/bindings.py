"""Canonical tables built from the test tables, in Spark and as DuckDB text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions.base import lit_map
from sampleloom.functions.fid import make_fid
from sampleloom.functions.numeric import sigmoid
from sampleloom.operators.joins import lookup_join

ITEM_SLOT, USER_SLOT, TAG_SLOT = 200, 1, 5
DIM = 64
ACTIONS = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the files give fewer splits than there are cores (a small file with
    one row group). A large table has more splits than cores and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session zone."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def samples_of(events: DataFrame) -> DataFrame:
    """Sample rows from event rows; works on streams as well."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    code = lit_map(ACTIONS, "string", "int")[F.col("event_type")]
    e = events.select("event_id", "user_id", "value", "ts", k.alias("k"), code.alias("code"),
                      epoch_seconds(F.col("ts")).alias("req_time"))
    hit = F.when(F.col("code").isin(2, 3, 4), 1.0).otherwise(0.0)
    strategies = F.element_at(F.array(
        F.array().cast("array<int>"), F.array(F.lit(1)), F.array(F.lit(2)),
        F.array(F.lit(1), F.lit(2)), F.array(F.lit(3))), (F.col("event_id") % 5).cast("int") + 1)
    device = F.element_at(F.array(F.lit("pc"), F.lit("mobile"), F.lit("cloud")),
                          (F.col("user_id") % 3).cast("int") + 1)
    return e.select(
        F.col("event_id").alias("sample_id"), F.col("user_id").alias("uid"), "req_time", "ts",
        F.col("k").alias("item_id"), (F.col("k") % 10).alias("chnid"),
        F.array("code").alias("actions"), F.array(hit, F.col("value") / 500.0).alias("label"),
        F.when(F.col("code") == 5, 0.5).otherwise(1.0).alias("sample_rate"),
        (F.lit(1.0) + (F.col("event_id") % 4) * 0.25).alias("instance_weight"),
        strategies.alias("special_strategies"), device.alias("device_type"),
        (F.col("event_id") % 7).cast("int").alias("rank"), (F.col("event_id") % 2 == 0).alias("is_draw"),
        F.array(make_fid(ITEM_SLOT, "k")).alias("f_item"), F.array(make_fid(USER_SLOT, "user_id")).alias("f_user"),
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("k") % 4),
                    lambda i: make_fid(TAG_SLOT, F.col("k") * 7 + i)).alias("f_tags"),
        F.array(make_fid(301, F.col("k") % 10, 1), make_fid(ITEM_SLOT, "k", 1), make_fid(USER_SLOT, "user_id", 1),
                make_fid(1000, F.col("k") % 3, 1)).alias("fids_v1"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_of(spread(read(spark, sf_dir, "events")))


def multi_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day with all actions of the day and those of the last active day."""
    from pyspark.sql import Window

    s = samples(spark, sf_dir)
    g = s.groupBy("uid", F.floor(F.col("req_time") / 86400).alias("day")).agg(
        F.sort_array(F.collect_set(F.get("actions", F.lit(0)))).alias("actions"),
        F.max("req_time").alias("req_time"), F.min("sample_id").alias("sample_id"))
    # one row per user and day is left, so the window below stays small
    prev = F.lag("actions").over(Window.partitionBy("uid").orderBy("day"))
    return g.select("sample_id", "uid", "day", "req_time", "actions",
                    F.coalesce(prev, F.array().cast("array<int>")).alias("pre_actions"),
                    F.array(F.when(F.array_contains("actions", 4), 1.0).otherwise(-1.0), F.lit(0.5)).alias("label"))


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding table ``item`` over the vectors, as DOUBLE, with an update time per row."""
    return read(spark, sf_dir, "embeddings").select(
        F.lit("item").alias("table"), make_fid(ITEM_SLOT, "vec_id").alias("fid"),
        F.col("embedding").cast("array<double>").alias("num"), F.lit(None).cast("struct<none:double>").alias("opt"),
        (F.lit(1700000000) + F.col("vec_id") * 3600).cast("bigint").alias("last_update_ts"))


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row, seq, fid)``: the parts of each order as a ragged id list, one row per element. Some
    ids have no vector."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row"), (F.col("l_linenumber").cast("bigint") * 10000000 + F.col("l_suppkey") * 10000 + F.col("l_partkey") % 10000).alias("seq"),
        make_fid(ITEM_SLOT, F.col("l_partkey") % 550).alias("fid"))


def gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(table, fid, seq, grad)``: one gradient per event on its item: (pred − label)·num."""
    s = samples(spark, sf_dir)
    pred = sigmoid(F.get("label", F.lit(1)) * 4.0 - 1.0)
    g = s.select(F.lit("item").alias("table"), F.get("f_item", F.lit(0)).alias("fid"), F.col("sample_id").alias("seq"),
                 (pred - F.get("label", F.lit(0))).alias("d"))
    t = emb(spark, sf_dir).select("fid", "num")
    return lookup_join(g, t, "fid", "inner").select("table", "fid", "seq", F.transform("num", lambda x: x * F.col("d")).alias("grad"))


def ranked_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, item_id, label, score, weight)``: an order is a list, its lines the items."""
    li = read(spark, sf_dir, "lineitem")
    uid = F.col("l_linenumber").cast("bigint") * 1000000 + F.col("l_partkey")
    key = [F.col("l_orderkey").alias("query_id"), uid.alias("item_id")]
    lab = F.floor(F.col("l_discount") * 50 + 0.5).cast("bigint") % 5 - 1
    return li.groupBy(*key).agg(
        F.max(lab).cast("double").alias("label"), (F.max("l_extendedprice") / 1e5).alias("score"),
        F.sqrt(F.max("l_quantity") / 50.0).alias("weight"))


# ---------------------------------------------------------------- DuckDB text

SAMPLES = """
ev AS (
  SELECT event_id, user_id, value, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
              WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS code,
         epoch_us(ts) // 1000000 AS req_time
  FROM events),
samples AS (
  SELECT event_id AS sample_id, user_id AS uid, req_time, k AS item_id, k % 10 AS chnid,
         [code] AS actions,
         [CASE WHEN code IN (2,3,4) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, value / 500.0::DOUBLE] AS label,
         CASE WHEN code = 5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS sample_rate,
         1.0::DOUBLE + (event_id % 4) * 0.25::DOUBLE AS instance_weight,
         CASE event_id % 5 WHEN 0 THEN []::INT[] WHEN 1 THEN [1] WHEN 2 THEN [2] WHEN 3 THEN [1,2] ELSE [3] END AS special_strategies,
         CASE user_id % 3 WHEN 0 THEN 'pc' WHEN 1 THEN 'mobile' ELSE 'cloud' END AS device_type,
         CAST(event_id % 7 AS INT) AS rank, event_id % 2 = 0 AS is_draw,
         [(200::BIGINT << 48) + k] AS f_item, [(1::BIGINT << 48) + user_id] AS f_user,
         list_transform(range(0, k % 4 + 1), lambda i: (5::BIGINT << 48) + k * 7 + i) AS f_tags,
         [(301::BIGINT << 54) + k % 10, (200::BIGINT << 54) + k, (1::BIGINT << 54) + user_id,
          CAST((1000::HUGEINT * 18014398509481984 + k % 3) - 18446744073709551616::HUGEINT AS BIGINT)] AS fids_v1
  FROM ev)"""

MULTI = """
md AS (
  SELECT user_id AS uid, CAST(req_time // 86400 AS BIGINT) AS day, list_sort(list(DISTINCT code)) AS actions,
         max(req_time) AS req_time, min(event_id) AS sample_id
  FROM ev GROUP BY 1, 2),
multi AS (
  SELECT sample_id, uid, day, req_time, actions,
         coalesce(lag(actions) OVER (PARTITION BY uid ORDER BY day), []::INT[]) AS pre_actions,
         [CASE WHEN list_contains(actions, 4) THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END, 0.5::DOUBLE] AS label
  FROM md)"""

EMB = """
emb AS (
  SELECT 'item' AS tbl, (200::BIGINT << 48) + vec_id AS fid, vec_id, CAST(embedding AS DOUBLE[]) AS num,
         1700000000 + vec_id * 3600 AS last_update_ts
  FROM embeddings)"""

ORDER_IDS = """
oids AS (
  SELECT l_orderkey AS row, CAST(l_linenumber AS BIGINT) * 10000000 + l_suppkey * 10000 + l_partkey % 10000 AS seq,
         l_partkey % 550 AS v, (200::BIGINT << 48) + l_partkey % 550 AS fid FROM lineitem)"""

GRADS = """
gr AS (
  SELECT s.f_item[1] AS fid, s.sample_id AS seq,
         1.0::DOUBLE / (1.0::DOUBLE + exp(-(s.label[2] * 4.0::DOUBLE - 1.0::DOUBLE))) - s.label[1] AS d
  FROM samples s),
gdim AS (
  SELECT gr.fid, gr.seq, i AS dim, e.num[i + 1] * gr.d AS g
  FROM gr JOIN emb e ON e.fid = gr.fid, range(0, 64) t(i)),
merged AS (SELECT fid, dim, sum(g) AS g FROM gdim GROUP BY fid, dim)"""

LISTS = """
lists AS (
  SELECT l_orderkey AS query_id, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS item_id,
         CAST(max(CAST(floor(l_discount * 50 + 0.5::DOUBLE) AS BIGINT) % 5 - 1) AS DOUBLE) AS label,
         max(l_extendedprice) / 100000.0::DOUBLE AS score, sqrt(max(l_quantity) / 50.0::DOUBLE) AS weight
  FROM lineitem GROUP BY 1, 2)"""


def w(*ctes: str) -> str:
    """WITH clause of the given CTE texts, each starting a line."""
    return "WITH " + ",".join(ctes) + "\n"
