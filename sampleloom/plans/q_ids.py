"""Ids: packing, hashing, combining, counting, sharding."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import fid as U
from sampleloom.functions import numeric as N
from sampleloom.functions import sql as SQL
from sampleloom.operators import admission as A
from sampleloom.operators import sharding as H
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import EMB, SAMPLES, read, w
from sampleloom.plans.registry import MASK48, MASK54, ints, query, r6, s_ints, s_r6, s_u, s_vec, vec
from sampleloom.streaming.flows import work_dir


def _low(e: str) -> str:
    """Low 54 bits of a v1 id (works for negative ids)."""
    return f"({e} & {MASK54})"


@query("make_fid", w(SAMPLES) + f"""
SELECT sample_id, (CAST(chnid AS BIGINT) << 54) + item_id AS v1, (200::BIGINT << 48) + item_id AS v2,
       ((200::BIGINT << 48) + item_id) & {MASK48} AS sig2, 200 AS slot2, 1000 AS slot1,
       (1000::BIGINT << 48) + item_id % 3 AS moved
FROM samples""")
def _(spark, d):
    fid1 = F.get("fids_v1", F.lit(3))
    return bind.samples(spark, d).select(
        "sample_id", U.make_fid(F.col("chnid"), "item_id", 1).alias("v1"), U.make_fid(200, "item_id").alias("v2"),
        U.signature_of(F.get("f_item", F.lit(0))).alias("sig2"), U.slot_of(F.get("f_item", F.lit(0))).alias("slot2"),
        U.slot_of(fid1, 1).alias("slot1"), U.v1_to_v2(fid1).alias("moved"))


@query("switch_slot", w(SAMPLES) + f"""
SELECT sample_id, {s_ints(f'list_transform(f_tags, lambda f: (77::BIGINT << 48) | (f & {MASK48}))')} AS strict_v2,
       {s_ints(f'list_transform(f_tags, lambda f: (77::BIGINT << 48) | (f & {(1 << 49) - 1}))')} AS compat_v2,
       {s_ints(f'list_transform(fids_v1, lambda f: (78::BIGINT << 54) | (f & {MASK54}))')} AS strict_v1
FROM samples""")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", ints(U.switch_slot("f_tags", 77)).alias("strict_v2"),
                                         ints(U.switch_slot("f_tags", 77, compat=True)).alias("compat_v2"),
                                         ints(U.switch_slot("fids_v1", 78, 1)).alias("strict_v1"))


@query("switch_slot_batch", w(SAMPLES) + f"""
SELECT sample_id, {s_ints(f'list_transform(f_item, lambda f: (301::BIGINT << 48) | (f & {MASK48}))')} AS f_item,
       {s_ints('f_tags')} AS f_tags, {s_ints(f'list_transform(f_tags, lambda f: (302::BIGINT << 48) | (f & {MASK48}))')} AS f_tags_share
FROM samples""")
def _(spark, d):
    from sampleloom.operators.features import switch_slots

    out = switch_slots(bind.samples(spark, d), {"f_item": (True, 301), "f_tags": (False, 302)}, "share")
    return out.select("sample_id", ints("f_item").alias("f_item"), ints("f_tags").alias("f_tags"), ints("f_tags_share").alias("f_tags_share"))


@query("extract_fid", w(SAMPLES) + "SELECT sample_id, (9::BIGINT << 48) + CAST('0x' || substr(md5(CAST(uid AS VARCHAR)), 1, 12) AS BIGINT) AS fid FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", U.extract_fid_md5("uid", 9).alias("fid"))


@query("feature_hash", "SELECT event_id, (31::BIGINT << 48) + CAST('0x' || substr(md5(event_type || '-etype'), 1, 12) AS BIGINT) AS fid FROM events")
def _(spark, d):
    return read(spark, d, "events").select("event_id", U.feature_hash("event_type", "etype", 31, portable=True).alias("fid"))


def _mix(a: str, b: str) -> str:
    p = f"({a}::HUGEINT * {b}::HUGEINT)"
    lo = f"({p} % 18446744073709551616::HUGEINT)"
    signed = f"CAST(CASE WHEN {lo} >= 9223372036854775808::HUGEINT THEN {lo} - 18446744073709551616::HUGEINT ELSE {lo} END AS BIGINT)"
    return f"xor(CAST({p} // 18446744073709551616::HUGEINT AS BIGINT), {signed})"


@query("fid_mix", w(SAMPLES) + f"SELECT sample_id, {_mix('f_item[1]', 'f_user[1]')} AS mixed FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", U.fid_mix(F.get("f_item", F.lit(0)), F.get("f_user", F.lit(0))).alias("mixed"))


@query("feature_combine", w(SAMPLES) + f"""
SELECT sample_id, {s_ints(f"list_transform(f_tags, lambda t: (500::BIGINT << 48) | ({_mix('f_user[1]', 't')} & {MASK48}))")} AS ids FROM samples""")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", ints(U.feature_combine("f_user", "f_tags", 500)).alias("ids"))


@query("float_bucket", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(log2(abs(l_extendedprice) + 1)) AS BIGINT) AS bucket FROM lineitem")
def _(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", U.float_bucket("l_extendedprice").alias("bucket"))


@query("fid_mask", w(SAMPLES) + f"SELECT sample_id, CASE WHEN list_contains(f_tags, {(5 << 48) + 22}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mask FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", U.fid_mask("f_tags", (5 << 48) + 22).alias("mask"))


@query("seq_mask", w(SAMPLES) + f"SELECT sample_id, {s_ints('list_transform(range(0, 3), lambda i: CASE WHEN i < len(f_tags) THEN 1 ELSE 0 END)')} AS mask FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", ints(U.seq_mask(F.size("f_tags"), 3)).alias("mask"))


@query("row_ids", w(SAMPLES) + "SELECT sample_id, unnest(f_tags) AS value FROM samples")
def _(spark, d):
    return H.row_ids(bind.samples(spark, d), "sample_id", "f_tags")


@query("merge_splits", w(SAMPLES) + f"""
SELECT 0 AS source, sample_id, {s_ints('f_tags')} AS ids FROM samples UNION ALL SELECT 1, sample_id, {s_ints('f_item')} FROM samples""")
def _(spark, d):
    s = bind.samples(spark, d)
    parts = [s.select("sample_id", F.col(c).alias("ids")) for c in ("f_tags", "f_item")]
    return H.merge_ragged(parts, "sample_id", "ids").withColumn("ids", ints("ids"))


@query("java_hash", """
SELECT event_id, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INT) AS h
FROM (SELECT event_id, list_reduce(list_transform(string_split(event_type, ''), lambda c: ascii(c)::BIGINT), lambda a, b: (a * 31 + b) & 4294967295, 0::BIGINT) AS h FROM events)""")
def _(spark, d):
    return read(spark, d, "events").select("event_id", U.java_hash("event_type").alias("h"))


@query("quantize_fixed8", w(EMB) + f"""
SELECT fid, {s_vec('list_transform(num, lambda x: greatest(least(trunc((CASE WHEN x >= 0 THEN x + 0.00078125::DOUBLE ELSE x - 0.00078125::DOUBLE END) / 0.0015625::DOUBLE), 127), -128) * 0.0015625::DOUBLE)')} AS num
FROM emb""")
def _(spark, d):
    return bind.emb(spark, d).select("fid", vec(N.quantize_fixed8("num", 0.2)).alias("num"))


@query("one_bit_forward", w(EMB) + f"""
SELECT fid, {s_vec('list_transform(num, lambda x: 0.1::DOUBLE * tanh(scale * x))')} AS num, {s_r6('scale')} AS scale
FROM (SELECT fid, num, least(power(1.0::DOUBLE + 0.005::DOUBLE * (vec_id * 10 - (vec_id * 10) % 200), 0.5::DOUBLE), 10000.0::DOUBLE) AS scale FROM emb)""")
def _(spark, d):
    step = U.signature_of("fid") * 10
    e = bind.emb(spark, d).select("fid", "num", N.one_bit_scale(step).alias("scale"))
    return e.select("fid", vec(N.one_bit_forward("num", F.col("scale"))).alias("num"), r6("scale").alias("scale"))


_QUANT = "power(2.0::DOUBLE, greatest(floor(log2(greatest(abs(x), 1e-300::DOUBLE))), -14) - 10)"


@query("fp16_round", w(EMB) + f"""
SELECT fid, {s_vec(f'list_transform(num, lambda x: sign(x) * round_even(abs(x) / {_QUANT}, 0) * {_QUANT})')} AS num FROM emb""")
def _(spark, d):
    return bind.emb(spark, d).select("fid", vec(N.fp16_round("num")).alias("num"))


@query("polynomial_decay", w(EMB) + f"""
SELECT vec_id AS step, {s_r6('(0.1::DOUBLE - 0.001::DOUBLE) * power(1.0::DOUBLE - least(vec_id, 300) / 300.0::DOUBLE, 2) + 0.001::DOUBLE')} AS plain,
       {s_r6('(0.1::DOUBLE - 0.001::DOUBLE) * (1.0::DOUBLE - vec_id / (300.0::DOUBLE * greatest(ceil(vec_id / 300.0::DOUBLE), 1))) + 0.001::DOUBLE')} AS cyclic
FROM emb""")
def _(spark, d):
    s = read(spark, d, "embeddings").select(F.col("vec_id").alias("step"))
    return s.select("step", r6(N.polynomial_decay("step", 0.1, 300, 0.001, 2.0)).alias("plain"),
                    r6(N.polynomial_decay("step", 0.1, 300, 0.001, cycle=True)).alias("cyclic"))


# ---------------------------------------------------------------- the same for SQL users

@query("sql_functions", w(SAMPLES) + f"""
SELECT sample_id, (7::BIGINT << 48) | uid AS fid, 200 AS slot, item_id AS signature, CAST(floor(log2(abs(label[2]) + 1)) AS BIGINT) AS bucket,
       {s_ints('list_transform(range(0, 3), lambda i: CASE WHEN i < len(f_tags) THEN 1 ELSE 0 END)')} AS mask,
       {s_r6('-(greatest(label[2], 0.0::DOUBLE) - label[2] + ln(1.0::DOUBLE + exp(-abs(label[2]))))')} AS logsig,
       {s_r6('label[2] - ln(sample_rate)')} AS corrected, {s_ints('list_transform(f_tags, lambda f: (9::BIGINT << 48) | (f & 281474976710655))')} AS moved
FROM samples WHERE actions[1] IN (1, 2, 4) AND (label[1] >= 1 OR label[2] >= 0.2::DOUBLE)""")
def _(spark, d):
    SQL.register(spark)
    bind.samples(spark, d).createOrReplaceTempView("sl_samples")
    got = spark.sql("""
        SELECT sample_id, sl_make_fid(7, uid) AS fid, sl_slot_of(f_item[0]) AS slot, sl_signature_of(f_item[0]) AS signature,
               sl_float_bucket(label[1]) AS bucket, sl_seq_mask(size(f_tags), 3) AS mask, sl_safe_log_sigmoid(label[1]) AS logsig,
               sl_logit_correction(label[1], sample_rate) AS corrected, sl_switch_slot(f_tags, 9) AS moved
        FROM sl_samples WHERE sl_any_action(actions, array(1, 2, 4)) AND sl_by_label(label, array(1.0D, 0.2D))""")
    return got.withColumns({"mask": ints("mask"), "moved": ints("moved"), "logsig": r6("logsig"), "corrected": r6("corrected")})


@query("sql_explode_request", w(SAMPLES) + """
SELECT sample_id, CAST(i AS INT) AS pos, f_tags[i + 1] AS fid, i * 2 AS score FROM samples, range(0, 4) t(i) WHERE i < len(f_tags)""")
def _(spark, d):
    SQL.register_request(spark, "fid BIGINT, score BIGINT")
    bind.samples(spark, d).select("sample_id", F.transform("f_tags", lambda f, i: F.struct(f.alias("fid"), (i * 2).cast("bigint").alias("score"))).alias(
        "instances")).createOrReplaceTempView("sl_requests")
    return spark.sql("SELECT sample_id, pos, fid, score FROM sl_requests, LATERAL sl_explode_request(instances)")


# ---------------------------------------------------------------- counting and admission

def _items(spark, d):
    return bind.samples(spark, d).select("sample_id", "req_time", F.get("f_item", F.lit(0)).alias("fid"))


@query("fid_frequency", w(SAMPLES) + "SELECT f_item[1] AS fid, count(*) AS cnt, least(count(*), 15) AS capped FROM samples GROUP BY 1")
def _(spark, d):
    exact = A.fid_frequency(_items(spark, d))
    return exact.withColumn("capped", F.least("cnt", F.lit(A.COUNTER_LIMIT).cast("bigint")))


@query("occurrence_admission", w(SAMPLES) + """
SELECT sample_id, fid, row_number() OVER (PARTITION BY fid ORDER BY req_time, sample_id) - 1 >= CASE WHEN slot = 200 THEN 20 WHEN slot = 1 THEN 5 ELSE 0 END AS admitted
FROM (SELECT sample_id, req_time, f_item[1] AS fid, 200 AS slot FROM samples
      UNION ALL SELECT sample_id, req_time, f_user[1], 1 FROM samples UNION ALL SELECT sample_id, req_time, unnest(f_tags), 5 FROM samples)""")
def _(spark, d):
    ids = bind.samples(spark, d).select("sample_id", "req_time", F.explode(F.concat("f_item", "f_user", "f_tags")).alias("fid"))
    return A.occurrence_admission(ids, ["req_time", "sample_id"], {200: 20, 1: 5}).select("sample_id", "fid", "admitted")


@query("sliding_admission", w(SAMPLES, """
c AS (SELECT f_item[1] AS fid, req_time // 21600 AS block, count(*) AS n FROM samples GROUP BY 1, 2)""") + """
SELECT a.fid, a.block, CAST(sum(b.n) AS BIGINT) AS cnt, sum(b.n) >= 5 AS admitted
FROM c a JOIN c b ON a.fid = b.fid AND b.block BETWEEN a.block - 3 AND a.block GROUP BY 1, 2""")
def _(spark, d):
    return A.sliding_admission(_items(spark, d), "req_time", 21600, 4, 5)


def _cut(distinct: int) -> str:
    """Splits of the stream as a recursive fold: ``q`` holds the ids of the open split before each row."""
    return f"""
ord AS (SELECT *, row_number() OVER (ORDER BY req_time, sample_id) AS r FROM src),
fold AS (
  SELECT 0::BIGINT AS r, []::BIGINT[] AS q, 0::BIGINT AS nxt, 0::BIGINT AS split
  UNION ALL
  SELECT o.r, CASE WHEN list_contains(f.q, o.fid) THEN f.q WHEN len(f.q) + 1 >= {distinct} THEN []::BIGINT[] ELSE list_append(f.q, o.fid) END,
         f.nxt + CASE WHEN NOT list_contains(f.q, o.fid) AND len(f.q) + 1 >= {distinct} THEN 1 ELSE 0 END, f.nxt
  FROM fold f JOIN ord o ON o.r = f.r + 1),
cut AS (SELECT o.*, f.split FROM ord o JOIN fold f USING (r))"""


_RING_SRC = "\nsrc AS (SELECT sample_id, req_time, f_user[1] AS fid FROM samples)"
_KEPT = """
gap AS (SELECT *, CASE WHEN split - lag(split) OVER (PARTITION BY fid ORDER BY r) > {back} THEN 1 ELSE 0 END AS lost FROM cut),
run AS (SELECT *, sum(lost) OVER (PARTITION BY fid ORDER BY r) AS run FROM gap),
cnt AS (SELECT *, row_number() OVER (PARTITION BY fid, run ORDER BY r) - 1 AS before FROM run)"""


def _recursive(text: str) -> str:
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


def _users(spark, d):
    return bind.samples(spark, d).select("sample_id", "req_time", F.get("f_user", F.lit(0)).alias("fid"))


def _ring(distinct: int, back: int, threshold: int):
    text = _recursive(w(SAMPLES, _RING_SRC, _cut(distinct), _KEPT.format(back=back))) + f"""
SELECT sample_id, fid, split, before >= {threshold} AS admitted FROM cnt"""

    @query(f"ring_admission_{distinct}", text)
    def _(spark, d):
        out = A.ring_admission(_users(spark, d), ["req_time", "sample_id"], distinct, back, {1: threshold}, chunk=1 << 12)
        return out.select("sample_id", "fid", "split", "admitted")


_ring(*A.ring_size(1000, 10), 3)
_ring(24, 3, 2)


@query("ring_state", _recursive(w(SAMPLES, _RING_SRC, _cut(24), _KEPT.format(back=3))) + """
SELECT fid, CAST(head - split AS INT) AS age, CAST(least(15, before + 1) AS INT) AS cnt
FROM (SELECT * FROM cnt QUALIFY row_number() OVER (PARTITION BY fid ORDER BY r DESC) = 1), (SELECT max(nxt) AS head FROM fold)
WHERE head - split <= 3""")
def _(spark, d):
    """Two halves of the stream: the second goes on from the saved state of the first."""
    order = ["req_time", "sample_id"]
    users = _users(spark, d)
    half = users.agg(F.percentile_approx("req_time", 0.5)).first()[0]
    one, two = users.filter(F.col("req_time") <= half), users.filter(F.col("req_time") > half)
    saved = work_dir(spark, "ring")
    A.save_counts(A.ring_state(A.ring_splits(one, order, 24), 24, 3), saved, 4)
    state = A.restore_counts(spark, [saved])
    return A.ring_state(A.ring_splits(two, order, 24, state), 24, 3, state)


@query("touched_set", _recursive(w(SAMPLES, _RING_SRC, _cut(101))) + """
SELECT DISTINCT fid, CAST(split * 101 AS BIGINT) AS dropped FROM cut WHERE split = (SELECT max(split) FROM cut)""")
def _(spark, d):
    return A.touched_set(_users(spark, d), ["req_time", "sample_id"], 100, chunk=1 << 12)


@query("restored_admission", w(SAMPLES) + """
SELECT sample_id, fid, row_number() OVER (PARTITION BY fid ORDER BY req_time, sample_id) - 1 + coalesce(least(15, 2 * n), 0) >= 20 AS admitted
FROM (SELECT sample_id, req_time, f_item[1] AS fid FROM samples WHERE sample_id % 2 = 0)
LEFT JOIN (SELECT f_item[1] AS fid, count(*) AS n FROM samples WHERE sample_id % 2 = 1 GROUP BY 1) USING (fid)""")
def _(spark, d):
    """Counts saved twice, restored together and counted on."""
    rows = _items(spark, d)
    counts, saves = A.fid_frequency(rows.filter("sample_id % 2 = 1"), A.COUNTER_LIMIT), [work_dir(spark, "counts") for _ in range(2)]
    for path in saves:
        A.save_counts(counts, path, 4)
    known = A.restore_counts(spark, saves)
    new = rows.filter("sample_id % 2 = 0")
    return A.occurrence_admission(new, ["req_time", "sample_id"], {200: 20}, known=known).select("sample_id", "fid", "admitted")


@query("probabilistic_admission", w(SAMPLES, """
c AS (SELECT f_user[1] AS fid, count(*) AS cnt FROM samples GROUP BY 1)""") + f"""
SELECT fid, cnt, fid % 7 = 0 OR {s_u('fid', "'3'")} < cnt / 100.0::DOUBLE AS admitted FROM c""")
def _(spark, d):
    counts = A.fid_frequency(bind.samples(spark, d).select(F.get("f_user", F.lit(0)).alias("fid")))
    return A.probabilistic_admission(counts, counts.filter("fid % 7 = 0"), 100, 3)


@query("probabilistic_admission_equal", w(SAMPLES, """
c AS (SELECT f_user[1] AS fid, count(*) AS cnt FROM samples GROUP BY 1)""") + f"""
SELECT fid, cnt, fid % 7 = 0 OR {s_u('fid', "'4'")} < 1.0::DOUBLE - power(1.0::DOUBLE - (1.0::DOUBLE - power(0.05::DOUBLE, 0.01::DOUBLE)), cnt) AS admitted FROM c""")
def _(spark, d):
    counts = A.fid_frequency(bind.samples(spark, d).select(F.get("f_user", F.lit(0)).alias("fid")))
    return A.probabilistic_admission(counts, counts.filter("fid % 7 = 0"), 100, 4, equal_probability=True)


@query("touched_keys", w(SAMPLES) + "SELECT DISTINCT unnest(f_tags) AS fid FROM samples")
def _(spark, d):
    return A.touched_keys(bind.samples(spark, d).select(F.explode("f_tags").alias("fid")))


# ---------------------------------------------------------------- sharding

def _table_ids(spark, d):
    s = bind.samples(spark, d)
    return s.select(F.inline(F.flatten(F.array(*[F.transform(c, _named(t)) for t, c in (
        ("item", "f_item"), ("tags", "f_tags"), ("user", "f_user"))]))))


def _named(t):
    return lambda f: F.struct(F.lit(t).alias("table"), f.alias("fid"))


_TIDS = """
u AS (SELECT DISTINCT tbl, fid, CAST(fid % 4 AS INT) AS shard FROM (
  SELECT 'item' AS tbl, f_item[1] AS fid FROM samples UNION ALL SELECT 'user', f_user[1] FROM samples UNION ALL SELECT 'tags', unnest(f_tags) FROM samples))"""


@query("shard_unique_ids", w(SAMPLES, _TIDS) + 'SELECT tbl AS "table", fid, shard FROM u')
def _(spark, d):
    return H.shard_unique_ids(_table_ids(spark, d), 4)


@query("shard_sizes", w(SAMPLES, _TIDS) + """
SELECT shard, tbl AS "table", count(*) AS table_size, CAST(sum(count(*)) OVER (PARTITION BY shard) AS BIGINT) AS shard_size FROM u GROUP BY 1, 2""")
def _(spark, d):
    return H.shard_sizes(H.shard_unique_ids(_table_ids(spark, d), 4))


@query("shard_offsets", w(SAMPLES, _TIDS) + """
SELECT shard, tbl AS "table", fid, CAST(sum(dim) OVER (ORDER BY shard, tbl, fid) - dim AS BIGINT) AS "offset"
FROM (SELECT *, CASE tbl WHEN 'item' THEN 1 WHEN 'tags' THEN 2 ELSE 3 END AS dim FROM u)""")
def _(spark, d):
    return H.shard_offsets(H.shard_unique_ids(_table_ids(spark, d), 4), {"item": 1, "tags": 2, "user": 3})


@query("split_by_shard", w(SAMPLES) + f"""
SELECT sample_id, CAST(s AS INT) AS shard, {s_ints('list_filter(f_tags, lambda f: f % 3 = s)')} AS ids,
       {s_ints('list_filter(range(0, len(f_tags)), lambda i: f_tags[i + 1] % 3 = s)')} AS positions
FROM samples, range(0, 3) t(s)""")
def _(spark, d):
    s = bind.samples(spark, d).select("sample_id", F.inline(H.split_list("f_tags", 3)))
    return s.select("sample_id", "shard", ints("ids").alias("ids"), ints("positions").alias("positions"))


@query("feature_stat", w(SAMPLES, _TIDS) + 'SELECT tbl AS "table", count(*) AS entries FROM u GROUP BY 1')
def _(spark, d):
    return H.feature_stat(_table_ids(spark, d).distinct())
