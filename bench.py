"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query is written in full to Spark's
``noop`` sink, so every row and column is computed. The two table micro-benchmarks work on 10^7 ids
stored table; insert assigns them into a stored table that has a tenth of them, and writes the result as a stored table.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from sampleloom.functions.fid import make_fid
from sampleloom.operators import gradients as G
from sampleloom.operators import pooling as P
from sampleloom.operators.tables import assign
from sampleloom.plans import bindings as bind
from sampleloom.plans import registry
from sampleloom.plans.bindings import read
from sampleloom.session import build_session
from sampleloom.sources.table_store import save_bucketed
from sampleloom.streaming.flows import work_dir
from sampleloom.streaming.state import STATE_CONF

# Operators timed without the text formatting that the registered queries add for comparison.
BARE = {
    "embedding_lookup": lambda s, d: P.lookup(bind.order_ids(s, d), bind.emb(s, d), bind.DIM),
    "dedup_lookup": lambda s, d: P.dedup_lookup(bind.order_ids(s, d), bind.emb(s, d), bind.DIM),
    "pool_sum": lambda s, d: P.pool(P.lookup(bind.order_ids(s, d), bind.emb(s, d), bind.DIM), "row", bind.DIM),
    "pool_mean": lambda s, d: P.pool(P.lookup(bind.order_ids(s, d), bind.emb(s, d), bind.DIM), "row", bind.DIM, "mean"),
    "merge_gradients": lambda s, d: G.merge_gradients(bind.gradients(s, d), bind.DIM),
}
HEADLINE = ["channel_loss", "transform_compose", "instance_reweight", "feature_combine", "embedding_lookup", "dedup_lookup", "pool_sum",
            "pool_mean", "merge_gradients", "apply_gradients_adagrad", "apply_gradients_adam", "assign", "evict", "delta_since",
            "occurrence_admission", "shard_offsets", "item_pool", "negative_gen", "pairwise_losses", "lambda_ndcg_loss", "approx_ndcg",
            "softmax_list_loss", "list_mle", "batch_softmax_loss", "inbatch_auc", "step_interval", "stream_update", "stream_negative_gen"]
IDS, DIM = 10_000_000, 32


def wide_ids(spark, sf_dir):
    """About 10^7 distinct ids: every line item repeated with a different offset."""
    li = bind.spread(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"))
    times = -(-IDS // li.count())
    key = F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "i")
    return li.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("i")).select(make_fid(200, key).alias("fid"))


def vectors(ids):
    return ids.select("fid", F.array(*[(F.col("fid") % 1000 + i).cast("float") for i in range(DIM)]).alias("num"))


def table_rows(spark, sf_dir):
    """Distinct ids with their vectors: 10^7 entries."""
    return vectors(wide_ids(spark, sf_dir).distinct())


def table_insert(spark, sf_dir):
    """10^7 rows assigned into a stored table that holds a part of the ids already, written as a new stored table."""
    ids = table_rows(spark, sf_dir).select(F.lit("t").alias("table"), "fid", "num", F.lit(1).cast("bigint").alias("ts"))
    stored = spark.table(TABLE[1]).select(F.lit("t").alias("table"), "fid", "num", F.lit(None).cast("int").alias("opt"),
                                          F.lit(0).cast("bigint").alias("last_update_ts"))
    path = work_dir(spark, "bench-insert")
    save_bucketed(assign(stored, ids, distinct=True), path.rsplit("/", 1)[-1].replace("-", "_"), path, int(os.environ.get("BENCH_CPUS", "8")) * 4)
    return spark.range(0)


def table_find(spark, sf_dir):
    """10^7 lookups in a stored table."""
    return P.lookup(wide_ids(spark, sf_dir), spark.table(TABLE[0]), DIM)


TABLE: list[str] = []


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus, **{
        "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), **STATE_CONF})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    jobs = {k: BARE.get(k, registry.QUERIES[k]) for k in HEADLINE}
    only = sys.argv[1:]
    if not only or "table" in only:
        TABLE.extend([work_dir(spark, "bench-table"), work_dir(spark, "bench-part")])
        jobs |= {"table_insert_10m": table_insert, "table_find_10m": table_find}
    if only:
        jobs = {k: f for k, f in jobs.items() if any(o in k for o in only)}
    noop(registry.QUERIES["channel_loss"](spark, "/root/testdata/sf0.001"))
    if TABLE:
        rows = table_rows(spark, sf_dir)
        for i, (name, some) in enumerate((("bench_table", rows), ("bench_part", rows.filter("fid % 10 = 0")))):
            save_bucketed(some, name, TABLE[i], cpus * 4)
            TABLE[i] = name
    took: dict[str, float] = {}
    for k, f in jobs.items():
        t0 = time.time()
        noop(f(spark, sf_dir))
        took[k] = round(time.time() - t0, 3)
        print(f"{k} {took[k]}", file=sys.stderr, flush=True)
    n = {t: read(spark, sf_dir, t).count() for t in ("events", "lineitem")}
    rates = {k: round(n["lineitem" if k in ("embedding_lookup", "pool_sum", "pairwise_losses") else "events"] / took[k])
             for k in ("embedding_lookup", "pool_sum", "pairwise_losses", "merge_gradients", "negative_gen") if k in took}
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "rows_per_sec": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
