"""Item pools and negative generation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sampleloom.functions import labels as L
from sampleloom.operators import negatives as N
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import SAMPLES, w
from sampleloom.plans.registry import ints, labs, query, r6, s_ints, s_labs, s_r6, s_u, s_u32

CFG = N.NegativeConfig(neg_num=3, item_features=("f_item", "f_tags"), per_channel=True, channel="chan", start_num=4,
                       max_item_num=8, positive_actions=(2, 3, 4), action_priority=(4, 3, 2, 1, 5), negative_action=9,
                       negative_label=-1.0, real_neg_instance_weight=0.5)


def _samples(spark, d):
    """Channels 1..10 from the item; items 0..99."""
    return bind.samples(spark, d).withColumn("chan", F.col("chnid") + 1).select(
        "sample_id", "uid", "req_time", "item_id", "chan", "actions", "label", "instance_weight", "f_item", "f_tags", "f_user")


def _queue(capacity: int, rows: str = "s WHERE pos") -> str:
    """The queue of each channel as a recursive fold: ``pool`` holds its entries, numbered by channel."""
    return f"""
ord AS (SELECT ch, item_id, req_time, sample_id, row_number() OVER (PARTITION BY ch ORDER BY req_time, sample_id) AS r FROM {rows}),
fold AS (
  SELECT DISTINCT ch, 0::BIGINT AS r, []::BIGINT[] AS q, 0::BIGINT AS seq, false AS enters FROM ord
  UNION ALL
  SELECT f.ch, o.r, CASE WHEN list_contains(f.q, o.item_id) THEN f.q WHEN len(f.q) >= {capacity} THEN list_append(f.q[2:], o.item_id) ELSE list_append(f.q, o.item_id) END,
         f.seq + CASE WHEN list_contains(f.q, o.item_id) THEN 0 ELSE 1 END, NOT list_contains(f.q, o.item_id)
  FROM fold f JOIN ord o ON o.ch = f.ch AND o.r = f.r + 1),
pool AS (SELECT o.ch, o.item_id, struct_pack(a := o.req_time, b := o.sample_id) AS fa, f.seq, o.r FROM fold f JOIN ord o ON o.ch = f.ch AND o.r = f.r WHERE f.enters)"""


def wr(*ctes: str) -> str:
    return w(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def _pool(channel: str, max_items: int) -> str:
    return f"""
s AS (SELECT *, chnid + 1 AS chan, {channel} AS ch, actions[1] IN (2, 3, 4) AS pos FROM samples)""" + "," + _queue(max_items) + f""",
known AS (SELECT s.*, n, least(n, {max_items}) AS size FROM (
    SELECT ch, sample_id, req_time, sum(new) OVER (PARTITION BY ch ORDER BY req_time, sample_id, q) AS n, q FROM (
      SELECT ch, fa.b AS sample_id, fa.a AS req_time, 1 AS new, 0 AS q FROM pool
      UNION ALL SELECT ch, sample_id, req_time, 0, 1 FROM s WHERE pos)) x
  JOIN s ON s.sample_id = x.sample_id WHERE x.q = 1),
drawn AS (SELECT k.*, i AS k, {s_u32("CAST(sample_id AS VARCHAR) || '|' || CAST(i AS VARCHAR) || '|item'")} % size AS at0
  FROM known k, range(0, 3) t(i) WHERE size > 4),
hit AS (SELECT d.*, p.item_id AS new_item, (at0 + 1) / CAST(size AS DOUBLE) AS tf,
         1.0::DOUBLE / row_number() OVER (PARTITION BY d.ch, p.seq ORDER BY d.req_time, d.sample_id, d.k) AS freq
  FROM drawn d JOIN pool p ON p.ch = d.ch AND p.seq = d.n - d.size + d.at0 + 1)"""


def _out(max_items: int) -> str:
    tags = "list_transform(range(0, new_item % 4 + 1), lambda i: (5::BIGINT << 48) + new_item * 7 + i)"
    return f"""
SELECT sample_id, CAST(k AS INT) AS gen_no, new_item AS item_id, {s_labs('[-1.0::DOUBLE, label[2]]')} AS label, '9' AS actions,
       {s_r6('1.0::DOUBLE + 3.0::DOUBLE * tf * freq')} AS instance_weight, CAST((200::BIGINT << 48) + new_item AS VARCHAR) AS f_item,
       {s_ints(tags)} AS f_tags, f_user[1] AS f_user
FROM hit
UNION ALL
SELECT sample_id, 3, item_id, {s_labs('label')}, {s_ints('actions')}, CASE WHEN pos THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END,
       {s_ints('f_item')}, {s_ints('f_tags')}, f_user[1]
FROM s"""


def _show(df):
    return df.select("sample_id", "gen_no", "item_id", labs("label").alias("label"), ints("actions").alias("actions"),
                     r6("instance_weight").alias("instance_weight"), ints("f_item").alias("f_item"), ints("f_tags").alias("f_tags"),
                     F.get("f_user", F.lit(0)).alias("f_user"))


@query("negative_gen", wr(SAMPLES, _pool("chnid + 1", 8)) + _out(8))
def _(spark, d):
    return _show(N.negative_gen(_samples(spark, d), CFG))


@query("negative_gen_one_pool", wr(SAMPLES, _pool("3", 50)) + _out(50))
def _(spark, d):
    return _show(N.negative_gen(_samples(spark, d), replace(CFG, per_channel=False, max_item_num=50)))


@query("negative_gen_only_negatives", wr(SAMPLES, _pool("chnid + 1", 8)) + "SELECT * FROM (" + _out(8) + ") WHERE gen_no < 3")
def _(spark, d):
    return _show(N.negative_gen(_samples(spark, d), replace(CFG, throw_origin=True)))


@query("item_pool", wr(SAMPLES, """
s AS (SELECT *, chnid + 1 AS ch FROM samples)""", _queue(7, "s"), """
p AS (SELECT *, max(seq) OVER (PARTITION BY ch) AS n FROM pool)""") + f"""
SELECT ch AS channel, item_id AS item, seq, (SELECT count(*) FROM ord o WHERE o.ch = p.ch AND o.item_id = p.item_id AND o.r >= p.r) AS origin_cnt,
       least(n, 7) AS pool_size, least(n, 7) > 5 AS usable, {s_r6('(seq - n + least(n, 7)) / CAST(least(n, 7) AS DOUBLE)')} AS time_factor
FROM p WHERE seq > n - 7""")
def _(spark, d):
    out = N.pool_state(bind.samples(spark, d).withColumn("chan", F.col("chnid") + 1), "chan", "item_id", 5, 7)
    return out.withColumn("time_factor", r6("time_factor"))


_EASY = 0.4


def _slots(capacity: int) -> str:
    """Entries that made a pool grow, in order of time over all channels, and how many there are up to each question of ``tag``."""
    return f"""
slots AS (SELECT ch, seq, fa, row_number() OVER (ORDER BY fa) AS slot FROM pool WHERE seq <= {capacity}),
total AS (SELECT t.sample_id, t.k, (SELECT count(*) FROM slots p WHERE p.fa <= struct_pack(a := t.req_time, b := t.sample_id)) AS n_all,
                 (SELECT count(*) FROM slots p WHERE p.seq = 1 AND p.fa <= struct_pack(a := t.req_time, b := t.sample_id)) AS chs FROM tag t),
pick AS (SELECT t.*, CASE WHEN chs >= 2 THEN CAST(floor({s_u('t.tg', "'channel'")} * n_all) AS BIGINT) + 1 END AS slot
         FROM tag t JOIN total USING (sample_id, k)),
easy AS (SELECT p.*, l.ch AS easy_ch FROM pick p LEFT JOIN slots l ON l.slot = p.slot)"""


@query("easy_negative_channel", wr(SAMPLES, """
s AS (SELECT *, chnid + 1 AS chan, chnid + 1 AS ch, actions[1] IN (2, 3, 4) AS pos FROM samples)""", _queue(5), """
tag AS (SELECT s.*, 0 AS k, CAST(sample_id AS VARCHAR) AS tg FROM s)""", _slots(5)) + """
SELECT sample_id, coalesce(easy_ch, chan) AS channel FROM easy""")
def _(spark, d):
    from sampleloom.functions.base import u01

    s = _samples(spark, d).withColumn("_ch", F.col("chan")).withColumn("_item", F.col("item_id"))
    pool = N.item_pool(s.filter(N.is_positive(CFG)), capacity=5)
    drawn = N.easy_channels(s.withColumn("k", F.lit(0)), pool, 5, u01("sample_id", "channel"))
    return drawn.select("sample_id", F.coalesce("_easy", "chan").alias("channel"))


_EH = """
s AS (SELECT *, chnid + 1 AS chan, chnid + 1 AS ch, actions[1] IN (2, 3, 4) AS pos FROM samples)""" + "," + _queue(8) + """,
tag AS (SELECT s.*, i AS k, CAST(sample_id AS VARCHAR) || '|' || CAST(i AS VARCHAR) AS tg FROM s, range(0, 3) t(i) WHERE pos)""" + "," + _slots(8) + f""",
asks AS (SELECT * EXCLUDE (ch), CASE WHEN {s_u('tg', "'easy'")} < 0.5::DOUBLE THEN coalesce(easy_ch, ch) ELSE ch END AS ch FROM easy),
known AS (SELECT a.*, n, least(n, 8) AS size FROM (
    SELECT ch, sample_id, k, q, sum(new) OVER (PARTITION BY ch ORDER BY req_time, sample_id, q, k) AS n FROM (
      SELECT ch, fa.b AS sample_id, fa.a AS req_time, 1 AS new, 0 AS q, -1 AS k FROM pool
      UNION ALL SELECT ch, sample_id, req_time, 0, 1, k FROM asks)) x
  JOIN asks a ON a.sample_id = x.sample_id AND a.k = x.k WHERE x.q = 1),
drawn AS (SELECT *, {s_u32("tg || '|item'")} % size AS at0 FROM known WHERE size > 4),
hit AS (SELECT d.*, p.item_id AS new_item, (at0 + 1) / CAST(size AS DOUBLE) AS tf,
         1.0::DOUBLE / row_number() OVER (PARTITION BY d.ch, p.seq ORDER BY d.req_time, d.sample_id, d.k) AS freq
  FROM drawn d JOIN pool p ON p.ch = d.ch AND p.seq = d.n - d.size + d.at0 + 1)"""


@query("negative_gen_easy_hard", wr(SAMPLES, _EH) + _out(8))
def _(spark, d):
    return _show(N.negative_gen(_samples(spark, d), replace(CFG, easy_hard_ratio=0.5)))


@query("instance_weight_rules", w(SAMPLES) + f"""
SELECT sample_id, CASE WHEN label[1] = 1 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS real_weight, {s_r6('1.0::DOUBLE + 4.0::DOUBLE * power(tf, 2) * freq')} AS unbiased, 0.75::DOUBLE AS fixed
FROM (SELECT *, (rank + 1) / 7.0::DOUBLE AS tf, 1.0::DOUBLE / (item_id + 1) AS freq FROM samples)""")
def _(spark, d):
    tf, freq = (F.col("rank") + 1) / 7.0, F.lit(1.0) / (F.col("item_id") + 1)
    return bind.samples(spark, d).select(
        "sample_id", L.real_weight(F.get("label", F.lit(0)) == 1, 0.25).alias("real_weight"),
        r6(L.sampled_negative_weight(4, freq, tf, 2.0)).alias("unbiased"), L.sampled_negative_weight(4, freq, tf, fixed=0.75).alias("fixed"))
