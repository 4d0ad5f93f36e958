"""Ranked lists, batch losses, windows over batches."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sampleloom.functions import vectors as V
from sampleloom.functions.fid import make_fid
from sampleloom.operators import batches as B
from sampleloom.operators import losses as X
from sampleloom.operators import ranking as R
from sampleloom.operators.ordering import together_sorted
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import EMB, LISTS, SAMPLES, read, w
from sampleloom.plans.registry import query, r6, s_r6, s_u

_Q = "query_id"


def _round(df, *cols):
    return df.withColumns({c: r6(c) for c in cols})


@query("top_n_by_score", w(LISTS) + f"""
SELECT query_id, item_id, label, {s_r6('score')} AS score, CAST(rk AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rk FROM lists) WHERE rk <= 3""")
def _(spark, d):
    return _round(R.top_n_by_score(bind.ranked_lists(spark, d), 3).drop("weight"), "score")


@query("group_lists", w(LISTS) + """
SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY item_id) AS place, count(*) OVER (PARTITION BY query_id) AS list_size FROM lists""")
def _(spark, d):
    return R.group_lists(bind.ranked_lists(spark, d).select(_Q, "item_id"), _Q, "item_id")


_IDEAL = """
cl AS (SELECT *, CASE WHEN label >= 0 THEN label ELSE 0.0::DOUBLE END AS l FROM lists)""", """
idl AS (SELECT query_id, (power(2, l) - 1) / ln(1 + row_number() OVER (PARTITION BY query_id ORDER BY l DESC, item_id)) AS g,
        row_number() OVER (PARTITION BY query_id ORDER BY l DESC, item_id) AS r FROM cl)""", """
inv AS (SELECT query_id, CASE WHEN sum(g) > 0 THEN 1.0::DOUBLE / sum(g) ELSE 0.0::DOUBLE END AS inv FROM idl GROUP BY 1)"""


@query("inverse_max_dcg", w(LISTS, *_IDEAL) + f"SELECT query_id, {s_r6('inv')} AS inv_max_dcg FROM inv")
def _(spark, d):
    return _round(R.inverse_max_dcg(bind.ranked_lists(spark, d)), "inv_max_dcg")


@query("approx_ranks", w(LISTS) + f"""
SELECT a.query_id, a.item_id, {s_r6('sum(1.0::DOUBLE / (1.0::DOUBLE + exp(-10.0::DOUBLE * (b.score - a.score)))) + 0.5::DOUBLE')} AS approx_rank
FROM lists a JOIN lists b ON a.query_id = b.query_id GROUP BY 1, 2""")
def _(spark, d):
    return _round(R.approx_ranks(bind.ranked_lists(spark, d)), "approx_rank")


@query("approx_ndcg", w(LISTS, *_IDEAL, """
sc AS (SELECT query_id, item_id, l, CASE WHEN label >= 0 THEN score ELSE min(score) OVER (PARTITION BY query_id) - 1000 END AS s,
        sum(l) OVER (PARTITION BY query_id) AS ls FROM cl)""", """
ar AS (SELECT a.query_id, a.item_id, a.l, sum(1.0::DOUBLE / (1.0::DOUBLE + exp(least(-10.0::DOUBLE * (b.s - a.s), 700)))) + 0.5::DOUBLE AS r
       FROM sc a JOIN sc b ON a.query_id = b.query_id WHERE a.ls > 0 GROUP BY 1, 2, 3)""") + f"""
SELECT ar.query_id, {s_r6('-sum((power(2, l) - 1) / ln(1 + r)) * any_value(inv)')} AS loss FROM ar JOIN inv ON inv.query_id = ar.query_id GROUP BY 1""")
def _(spark, d):
    return _round(R.approx_ndcg(bind.ranked_lists(spark, d)), "loss")


@query("is_last", "SELECT event_id, user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_last FROM events")
def _(spark, d):
    return B.mark_last(read(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", "is_last")


@query("count_window", w(SAMPLES) + """
SELECT sample_id, chnid, CAST((rn - 1) // 16 AS BIGINT) AS batch_no FROM (
  SELECT sample_id, chnid, row_number() OVER (PARTITION BY chnid ORDER BY sample_id) AS rn, count(*) OVER (PARTITION BY chnid) AS n FROM samples)
WHERE (rn - 1) // 16 < n // 16""")
def _(spark, d):
    return B.count_window(bind.samples(spark, d).select("sample_id", "chnid"), ["chnid"], ["sample_id"], 16)


@query("merged_window", w(SAMPLES) + """
SELECT sample_id, chnid, CAST((rn - 1) // 16 AS BIGINT) AS batch_no, CAST((rn - 1) // 32 AS BIGINT) AS window_no FROM (
  SELECT sample_id, chnid, row_number() OVER (PARTITION BY chnid ORDER BY sample_id) AS rn, count(*) OVER (PARTITION BY chnid) AS n FROM samples)
WHERE (rn - 1) // 16 < n // 16 AND (rn - 1) // 32 < (n // 16) // 2""")
def _(spark, d):
    b = B.count_window(bind.samples(spark, d).select("sample_id", "chnid"), ["chnid"], ["sample_id"], 16)
    return B.merge_windows(b, ["chnid"], "batch_no", 2)


@query("step_interval", w(SAMPLES, """
st AS (SELECT item_id, (sample_id // 10)::BIGINT AS step, sample_id FROM samples)""", """
gp AS (SELECT item_id, step - coalesce(lag(step) OVER (PARTITION BY item_id ORDER BY sample_id), 0) AS gap,
              row_number() OVER (PARTITION BY item_id ORDER BY sample_id DESC) - 1 AS left_n FROM st)""") + f"""
SELECT item_id, count(*) AS appearances, {s_r6('sum(0.1::DOUBLE * gap * power(0.9::DOUBLE, left_n))')} AS interval FROM gp GROUP BY 1""")
def _(spark, d):
    s = bind.samples(spark, d).select("item_id", F.floor(F.col("sample_id") / 10).alias("step"))
    return _round(B.step_interval(s, "item_id", "step", 0.1, chunk_steps=64), "interval")


_PAIRS = """
pr AS (SELECT a.query_id, a.weight * abs(a.label - b.label) AS w, a.score - b.score AS d
       FROM lists a JOIN lists b ON a.query_id = b.query_id WHERE a.label > b.label AND b.label >= 0)"""
_PSUMS = f"""{s_r6('sum(w * greatest(1 - d, 0))')} AS hinge, {s_r6('sum(w * (greatest(-d, 0) + ln(1.0::DOUBLE + exp(-abs(d)))))')} AS logistic,
       {s_r6('sum(w / (1.0::DOUBLE + exp(d)))')} AS soft_zero_one, count(*) FILTER (WHERE w <> 0) AS pairs"""
_KINDS = ["hinge", "logistic", "soft_zero_one"]


@query("pairwise_losses", w(LISTS, _PAIRS) + f"""
SELECT l.query_id, coalesce(p.hinge, 0) AS hinge, coalesce(p.logistic, 0) AS logistic, coalesce(p.soft_zero_one, 0) AS soft_zero_one, coalesce(p.pairs, 0) AS pairs
FROM (SELECT DISTINCT query_id FROM lists WHERE label >= 0) l LEFT JOIN (SELECT query_id, {_PSUMS} FROM pr GROUP BY 1) p ON p.query_id = l.query_id""")
def _(spark, d):
    return _round(R.pairwise_loss(bind.ranked_lists(spark, d), _KINDS), *_KINDS)


@query("pairwise_losses_total", w(LISTS, _PAIRS) + f"""
SELECT {s_r6('sum(w * greatest(1 - d, 0)) / count(*) FILTER (WHERE w <> 0)')} AS hinge, {s_r6('sum(w * (greatest(-d, 0) + ln(1.0::DOUBLE + exp(-abs(d))))) / count(*) FILTER (WHERE w <> 0)')} AS logistic,
       {s_r6('sum(w / (1.0::DOUBLE + exp(d))) / count(*) FILTER (WHERE w <> 0)')} AS soft_zero_one, count(*) FILTER (WHERE w <> 0) AS pairs FROM pr""")
def _(spark, d):
    parts = R.pairwise_loss(bind.ranked_lists(spark, d), _KINDS)
    return _round(R.reduce_nonzero(parts, _KINDS, "pairs"), *_KINDS)


_RANKED = """
rk AS (SELECT c.*, inv.inv, row_number() OVER (PARTITION BY c.query_id ORDER BY c.label < 0, c.score DESC, c.item_id) AS r,
              count(*) OVER (PARTITION BY c.query_id) AS sz FROM cl c JOIN inv ON inv.query_id = c.query_id)"""


def _lam_sql(weight: str, *ctes: str) -> str:
    return w(LISTS, *_IDEAL, *ctes, _RANKED, f"""
pw AS (SELECT a.query_id, a.score - b.score AS d, a.weight * a.sz * {weight} AS w FROM rk a JOIN rk b ON a.query_id = b.query_id
       WHERE a.label > b.label AND b.label >= 0)""") + f"""
SELECT l.query_id, coalesce(p.x, 0) AS logistic, coalesce(p.n, 0) AS pairs FROM (SELECT DISTINCT query_id FROM lists WHERE label >= 0) l
LEFT JOIN (SELECT query_id, {s_r6('sum(w * (greatest(-d, 0) + ln(1.0::DOUBLE + exp(-abs(d)))))')} AS x, count(*) FILTER (WHERE w <> 0) AS n FROM pw GROUP BY 1) p ON p.query_id = l.query_id"""


_U = "(CASE WHEN a.r = b.r THEN 0 ELSE abs(1.0::DOUBLE / ln(1 + abs(a.r - b.r)) - 1.0::DOUBLE / ln(2 + abs(a.r - b.r))) END)"
_V = "abs(1.0::DOUBLE / ln(1 + a.r) - 1.0::DOUBLE / ln(1 + b.r))"
_GAIN = "abs((power(2, a.l) - 1) * a.inv - (power(2, b.l) - 1) * b.inv)"


@query("lambda_ndcg_loss", _lam_sql(f"{_GAIN} * (0.75::DOUBLE * {_U} + 0.25::DOUBLE * {_V})"))
def _(spark, d):
    return _round(R.pairwise_loss(bind.ranked_lists(spark, d), ["logistic"], R.ndcg_weight(smooth=0.25)), "logistic")


@query("lambda_precision_loss", _lam_sql("CASE WHEN (a.l >= 1) <> (b.l >= 1) AND (a.r <= 2) <> (b.r <= 2) THEN 1 ELSE 0 END"))
def _(spark, d):
    return _round(R.pairwise_loss(bind.ranked_lists(spark, d), ["logistic"], R.LambdaWeight("precision", 2)), "logistic")


_UT = "(CASE WHEN least(a.r, 3) = least(b.r, 3) THEN 0 ELSE abs(1.0::DOUBLE / abs(least(a.r, 3) - least(b.r, 3)) - 1.0::DOUBLE / (1 + abs(least(a.r, 3) - least(b.r, 3)))) END)"


@query("lambda_reciprocal_rank_loss", _lam_sql(
    f"(CASE WHEN a.r <= 2 OR b.r <= 2 THEN abs(a.l * mrr.inv - b.l * mrr.inv) * {_UT} ELSE 0 END)", """
mi AS (SELECT query_id, l / row_number() OVER (PARTITION BY query_id ORDER BY l DESC, item_id) AS g, row_number() OVER (PARTITION BY query_id ORDER BY l DESC, item_id) AS r FROM cl)""", """
mrr AS (SELECT query_id, CASE WHEN sum(g) > 0 THEN 1.0::DOUBLE / sum(g) ELSE 0 END AS inv FROM mi WHERE r <= 2 GROUP BY 1)""").replace(
    "FROM rk a JOIN rk b ON a.query_id = b.query_id", "FROM rk a JOIN rk b ON a.query_id = b.query_id JOIN mrr ON mrr.query_id = a.query_id"))
def _(spark, d):
    return _round(R.pairwise_loss(bind.ranked_lists(spark, d), ["logistic"], R.reciprocal_rank_weight(2)), "logistic")


@query("lambda_row_weights", w(LISTS, *_IDEAL, _RANKED) + f"""
SELECT query_id, item_id, {s_r6('(power(2, l) - 1) * inv / ln(1 + r)')} AS row_weight FROM rk""")
def _(spark, d):
    return _round(R.dcg_row_weights(bind.ranked_lists(spark, d), R.ndcg_weight()), "row_weight")


_LOGIT = f"CASE WHEN label >= 0 THEN score ELSE {math.log(1e-10)!r}::DOUBLE END"


@query("softmax_list_loss", w(LISTS, _IDEAL[0], f"""
sm AS (SELECT query_id, l * weight AS y, {_LOGIT} AS s FROM cl)""") + f"""
SELECT query_id, {s_r6('ln(sum(exp(s))) * sum(y) - sum(y * s)')} AS loss, {s_r6('sum(y)')} AS label_sum FROM sm GROUP BY 1 HAVING sum(y) > 0""")
def _(spark, d):
    return _round(R.softmax_list_loss(bind.ranked_lists(spark, d)), "loss", "label_sum")


@query("pointwise_losses", w(LISTS) + f"""
SELECT {s_r6('sum(weight * (greatest(score, 0) - score * label + ln(1.0::DOUBLE + exp(-abs(score))))) / count(*) FILTER (WHERE weight <> 0)')} AS sigmoid_cross_entropy,
       {s_r6('sum(weight * power(label - score, 2)) / count(*) FILTER (WHERE weight <> 0)')} AS mean_squared, count(*) FILTER (WHERE weight <> 0) AS "rows"
FROM lists WHERE label >= 0""")
def _(spark, d):
    return _round(R.pointwise_losses(bind.ranked_lists(spark, d)), "sigmoid_cross_entropy", "mean_squared")


_MLE_KEY = "CAST(query_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)"
_MLE = f"""
ml AS (SELECT query_id, item_id, l, {_LOGIT} AS s, CASE WHEN label >= 0 THEN {s_u(_MLE_KEY, "'mle'")} ELSE -1e-6::DOUBLE END AS u FROM cl)"""


@query("list_mle", w(LISTS, _IDEAL[0], _MLE, """
mt AS (SELECT query_id, s, sum(exp(s)) OVER (PARTITION BY query_id ORDER BY l, u, item_id) AS tail FROM ml)""") + f"""
SELECT query_id, {s_r6('sum(ln(tail) - s)')} AS loss FROM mt GROUP BY 1""")
def _(spark, d):
    return _round(R.list_mle(bind.ranked_lists(spark, d)), "loss")


@query("position_aware_list_mle", w(LISTS, _IDEAL[0], _MLE, """
mt AS (SELECT query_id, s, sum(exp(s)) OVER (PARTITION BY query_id ORDER BY l, u, item_id) AS tail,
              count(*) OVER (PARTITION BY query_id) - row_number() OVER (PARTITION BY query_id ORDER BY l, u, item_id) + 1 AS r FROM ml)""") + f"""
SELECT query_id, {s_r6('sum((ln(tail) - s) * (power(2.0::DOUBLE, 8.0::DOUBLE - r) - 1))')} AS loss FROM mt GROUP BY 1""")
def _(spark, d):
    return _round(R.list_mle(bind.ranked_lists(spark, d), lam=R.p_list_mle_weight(8)), "loss")


@query("combined_loss", w(LISTS, _PAIRS, _IDEAL[0], f"""
sm AS (SELECT query_id, l * weight AS y, {_LOGIT} AS s FROM cl)""", """
sl AS (SELECT avg(x) AS softmax FROM (SELECT ln(sum(exp(s))) * sum(y) - sum(y * s) AS x FROM sm GROUP BY query_id HAVING sum(y) > 0))""", """
hl AS (SELECT sum(w * greatest(1 - d, 0)) / count(*) FILTER (WHERE w <> 0) AS hinge FROM pr)""") + f"""
SELECT {s_r6('hinge * 0.5::DOUBLE')} AS pairwise_hinge, {s_r6('softmax * 2.0::DOUBLE')} AS softmax, {s_r6('hinge * 0.5::DOUBLE + softmax * 2.0::DOUBLE')} AS loss FROM sl, hl""")
def _(spark, d):
    out = R.combined_loss(bind.ranked_lists(spark, d), ["pairwise_hinge", "softmax"], [0.5, 2.0])
    return _round(out, "pairwise_hinge", "softmax", "loss")


# ---------------------------------------------------------------- sample and batch losses

_X = "(label[2] * 8.0::DOUBLE - 2.0::DOUBLE)"


@query("sigmoid_loss", w(SAMPLES, f"""
z AS (SELECT *, greatest(least({_X} - ln(sample_rate), ln(0.95::DOUBLE / 0.05::DOUBLE)), -ln(0.95::DOUBLE / 0.05::DOUBLE)) AS x FROM samples)""") + f"""
SELECT chnid, {s_r6('sum(CASE WHEN rank < 6 THEN instance_weight * (greatest(x, 0) - x * label[1] + ln(1.0::DOUBLE + exp(-abs(x)))) ELSE 0 END)')} AS loss,
       {s_r6(f'avg(1.0::DOUBLE / (1.0::DOUBLE + exp(-{_X})))')} AS mean_pred, count(*) AS n FROM z GROUP BY 1""")
def _(spark, d):
    x = F.get("label", F.lit(1)) * 8.0 - 2.0
    loss = X.sigmoid_loss(x, F.get("label", F.lit(0)), "sample_rate", instance_weight="instance_weight", mask=F.col("rank") < 6, logit_clip=0.05)
    return _round(bind.samples(spark, d).groupBy("chnid").agg(F.sum(loss).alias("loss"), F.avg(X.sigmoid_prediction(x)).alias("mean_pred"),
                                                              F.count(F.lit(1)).alias("n")), "loss", "mean_pred")


@query("softmax_loss", w(EMB, """
z AS (SELECT fid, num AS x, list_transform(range(0, 64), lambda i: CASE WHEN i = vec_id % 64 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS y FROM emb)""") + f"""
SELECT fid, {s_r6('ln(list_sum(list_transform(x, lambda v: exp(v)))) - list_dot_product(x, y)')} AS loss, CAST(list_position(x, list_max(x)) - 1 AS INT) AS pred FROM z""")
def _(spark, d):
    e = read(spark, d, "embeddings").select(make_fid(200, "vec_id").alias("fid"), V.doubles("embedding").alias("x"),
                                            F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(i == F.col("vec_id") % 64, 1.0).otherwise(0.0)).alias("y"))
    return e.select("fid", r6(X.softmax_loss("x", "y")).alias("loss"), X.softmax_prediction("x").alias("pred"))


def _batches(spark, d):
    """Batches of 64 consecutive samples with a query and an item vector each."""
    s = bind.samples(spark, d).select("sample_id", "uid", "item_id", F.get("label", F.lit(0)).alias("y"), (F.get("label", F.lit(1)) * 4.0 - 1.0).alias("s"))
    b = together_sorted(B.count_window(s, [], ["sample_id"], 64, drop_remainder=False), "batch_no")
    t = bind.emb(spark, d).select("fid", "num")
    q = t.withColumnsRenamed({"fid": "qf", "num": "q"})
    v = t.withColumnsRenamed({"fid": "vf", "num": "v"})
    return b.join(q, F.col("qf") == make_fid(200, F.col("uid") % 500)).join(v, F.col("vf") == make_fid(200, "item_id"))


_B = """
b AS (SELECT s.sample_id, (row_number() OVER (ORDER BY s.sample_id) - 1) // 64 AS batch_no, s.label[1] AS y, s.label[2] * 4.0::DOUBLE - 1.0::DOUBLE AS s,
             s.item_id, q.num AS q, v.num AS v FROM samples s JOIN emb q ON q.vec_id = s.uid % 500 JOIN emb v ON v.vec_id = s.item_id)"""


@query("batch_softmax_loss", w(SAMPLES, EMB, _B, """
nb AS (SELECT *, sqrt(list_dot_product(q, q)) AS qn, sqrt(list_dot_product(v, v)) AS vn, -ln(greatest(item_id / 10.0::DOUBLE, 1.0::DOUBLE)) AS f FROM b)""", """
al AS (SELECT a.batch_no, a.sample_id, sum(exp(list_dot_product(a.q, c.v) / a.qn / c.vn / 0.5::DOUBLE - c.f)) AS total FROM nb a JOIN nb c ON a.batch_no = c.batch_no GROUP BY 1, 2)""") + f"""
SELECT n.batch_no, {s_r6('-sum((y + 0.5::DOUBLE) * (list_dot_product(q, v) / qn / vn / 0.5::DOUBLE - f - ln(total)))')} AS loss
FROM nb n JOIN al ON al.batch_no = n.batch_no AND al.sample_id = n.sample_id GROUP BY 1""")
def _(spark, d):
    b = _batches(spark, d).withColumn("interval", F.col("item_id") / 10.0).withColumn("r", F.col("y") + 0.5)
    return _round(X.batch_softmax_loss(b, "batch_no", "sample_id", "q", "v", "interval", "r", temperature=0.5), "loss")


@query("inbatch_auc", w(SAMPLES, EMB, _B) + f"""
SELECT batch_no, {s_r6('coalesce(sum(x), 0)')} AS loss FROM (SELECT DISTINCT batch_no FROM b) k
LEFT JOIN (SELECT a.batch_no, (a.s - c.s) - ln(1.0::DOUBLE + exp(a.s - c.s)) AS x FROM b a JOIN b c ON a.batch_no = c.batch_no AND a.y > 0 AND c.y <= 0) p USING (batch_no) GROUP BY 1""")
def _(spark, d):
    return _round(X.inbatch_auc(_batches(spark, d), "batch_no", "sample_id", "y", "s"), "loss")


@query("inbatch_auc_gradient", w(SAMPLES, EMB, _B, """
p AS (SELECT a.batch_no, a.sample_id AS i, c.sample_id AS j, 1.0::DOUBLE - 1.0::DOUBLE / (1.0::DOUBLE + exp(-(a.s - c.s))) AS g FROM b a JOIN b c ON a.batch_no = c.batch_no AND a.y > 0 AND c.y <= 0)""") + f"""
SELECT b.batch_no, b.sample_id, {s_r6('coalesce(sum(g), 0)')} AS grad FROM b
LEFT JOIN (SELECT i AS sample_id, g FROM p UNION ALL SELECT j, -0.5::DOUBLE * g FROM p) x USING (sample_id) GROUP BY 1, 2""")
def _(spark, d):
    return _round(X.inbatch_auc_gradient(_batches(spark, d), "batch_no", "sample_id", "y", "s", neg_weight=0.5), "grad")


@query("eval_sample_dump", w(SAMPLES) + f"""
SELECT sample_id, '{{"uid":' || uid || ',"req_time":' || req_time || ',"rank":' || rank || '}}' AS record FROM samples WHERE {s_u('sample_id', "'eval'")} < 0.25::DOUBLE""")
def _(spark, d):
    return X.eval_samples(bind.samples(spark, d), "sample_id", 0.25, ["uid", "req_time", "rank"])


@query("channel_loss", w(SAMPLES, f"""
z AS (SELECT *, {_X} - ln(sample_rate) AS x FROM samples
      WHERE actions[1] IN (1, 2, 4, 5) AND uid >= 5 AND uid < 140 AND (label[1] >= 1 OR label[2] >= 0.05::DOUBLE))""") + f"""
SELECT chnid, {s_r6('sum(instance_weight * (greatest(x, 0) - x * label[1] + ln(1.0::DOUBLE + exp(-abs(x)))))')} AS loss, count(*) AS n FROM z GROUP BY 1""")
def _(spark, d):
    from sampleloom.functions import predicates as P
    from sampleloom.operators import samples as S

    flow = S.compose(S.keep_if(P.any_action("actions", [1, 2, 4, 5])), S.keep_if(P.compare("uid", "between", [5, 140])),
                     S.keep_if(P.by_label("label", [1.0, 0.05])))
    loss = X.sigmoid_loss(F.get("label", F.lit(1)) * 8.0 - 2.0, F.get("label", F.lit(0)), "sample_rate", instance_weight="instance_weight")
    return _round(bind.samples(spark, d).transform(flow).groupBy("chnid").agg(F.sum(loss).alias("loss"), F.count(F.lit(1)).alias("n")), "loss")
