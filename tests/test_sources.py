"""Readers, writers, patterns."""

import pytest
from pyspark.sql import functions as F

from sampleloom.plans import bindings as bind
from sampleloom.session import checkpoint_dir, settled
from sampleloom.sources import dump, kafka, text
from sampleloom.sources import feature_meta as FM
from sampleloom.sources import parquet as PQ
from sampleloom.sources import table_store as TS
from sampleloom.sources.generate import generate_samples

SF = "/root/testdata/sf0.001"


def test_patterns_expand_both_ends_inclusive():
    assert PQ.expand_patterns("/d/{DATE(20240228,20240301)}/p{INT(1,2)}") == [
        f"/d/{d}/p{i}" for d in ("20240228", "20240229", "20240301") for i in (1, 2)]
    assert PQ.expand_patterns("/d/{DATE(2024010122,2024010201)}") == [f"/d/{h}" for h in ("2024010122", "2024010123", "2024010200", "2024010201")]
    assert PQ.expand_patterns("/plain") == ["/plain"]
    with pytest.raises(ValueError):
        PQ.expand_patterns("{DATE(202401,202402)}")


def test_read_patterns_and_exclude(spark, tmp_path):
    for day in ("20240101", "20240103"):
        spark.range(5).withColumn("d", F.lit(day)).coalesce(1).write.parquet(str(tmp_path / day))
    pat = [str(tmp_path / "{DATE(20240101,20240104)}")]
    df = PQ.read_patterns(spark, pat)
    assert df.count() == 10
    names = sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles())
    assert PQ.read_patterns(spark, pat, lambda n: n == names[0]).count() == 5
    with pytest.raises(FileNotFoundError):
        PQ.read_patterns(spark, pat, lambda n: True)
    with pytest.raises(FileNotFoundError):
        PQ.existing(spark, [str(tmp_path / "nope*")])


def test_date_range_prunes_partitions(spark, tmp_path):
    df = spark.range(40).select("id", F.concat(F.lit("202401"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0")).alias("dt"), (F.col("id") % 4).alias("hr"))
    df.write.partitionBy("dt", "hr").parquet(str(tmp_path / "p"))
    src = spark.read.option("basePath", str(tmp_path / "p")).schema("id bigint, dt string, hr int").parquet(str(tmp_path / "p"))
    out = PQ.date_range(src, "20240103", "20240105")
    assert {r[0] for r in out.select("dt").distinct().collect()} == {"20240103", "20240104"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    hours = PQ.hourly_range(src, ("20240103", 2), ("20240104", 3)).select("dt", "hr").distinct().collect()
    assert {(r[0], r[1]) for r in hours} == {(d, h) for d, h in [(r["dt"], r["hr"]) for r in df.select("dt", "hr").collect()] if ("20240103", 2) <= (d, h) < ("20240104", 3)}
    assert PQ.date_range(src, "20240109", today="20240110").count() == 4


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = PQ.scan_parquet(spark, f"{SF}/lineitem.parquet", ["l_orderkey", "l_quantity"], ["int", "float"]).filter("l_quantity > 45")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan and "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan


def test_sample_scan_reads_only_what_is_used(spark):
    df = bind.samples(spark, SF).filter("uid > 5").select("sample_id", "label")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "user_id" in plan and "props" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("cols,types", [(["l_orderkey"], ["float"]), (["nope"], ["int"]), (["l_orderkey"], ["date"]), (["l_orderkey"], []), (["l_returnflag"], ["fid_v1"])])
def test_declared_types_are_checked(spark, cols, types):
    with pytest.raises(ValueError):
        PQ.scan_parquet(spark, f"{SF}/lineitem.parquet", cols, types)


def test_reserved_names(spark, tmp_path):
    spark.range(2).select(F.array(F.lit(1.0)).alias("__LABEL__"), F.col("id").alias("__REQ_TIME__")).write.parquet(str(tmp_path / "r"))
    assert PQ.scan_parquet(spark, str(tmp_path / "r"), ["__LABEL__", "__REQ_TIME__"], ["float", "int"]).columns == ["label", "req_time"]


def test_csv_keeps_broken_lines_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2,3.5\nx,y,z\n4,5,1\n")
    good, broken = text.csv_lines(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in good.orderBy("mov").collect()] == [(1, 2, 3.5), (4, 5, 1.0)]
    assert [r.line for r in broken.collect()] == ["x,y,z"]
    with pytest.raises(Exception):
        text.csv_samples(spark, str(tmp_path / "a.csv")).collect()
    assert text.csv_samples(spark, str(tmp_path), streaming=True).isStreaming


def test_hashed_ids_are_non_negative(spark):
    df = spark.range(2000).select(text.hashed_id(F.col("id")).alias("a"), text.hashed_id(F.col("id"), True).alias("b"))
    assert df.filter("a < 0 or b < 0").count() == 0 and df.select("a").distinct().count() == 2000


def test_kafka_options_and_codec(spark):
    o = kafka.source_options(["h1:1", "h2:2"], ["t"], "g", 100, session_timeout_ms="7")
    assert o["kafka.bootstrap.servers"] == "h1:1,h2:2" and o["subscribe"] == "t" and o["kafka.group.id"] == "g"
    assert o["maxOffsetsPerTrigger"] == "100" and o["kafka.session.timeout.ms"] == "7"
    with pytest.raises(ValueError):
        kafka.source_options([], ["t"])
    raw = kafka.encode(spark.range(3).withColumnRenamed("id", "x"), "x").unionByName(spark.createDataFrame([("k", ""), ("k", None)], "key string, value string"))
    assert sorted(r["x"] for r in kafka.decode(raw.withColumn("value", F.col("value").cast("binary")), "x bigint").collect()) == [0, 1, 2]


def test_table_save_skips_expired_and_restore_checks(spark, tmp_path):
    path = str(tmp_path / "s")
    t = bind.emb(spark, SF).drop("opt").withColumn("last_update_ts", F.when(F.col("fid") % 100 == 7, None).otherwise(F.col("last_update_ts")))
    counts = TS.table_save(t.filter("last_update_ts is not null"), path, {200: 10}, buckets=3)
    assert counts.first()["entries"] == 240 - 2 and TS.table_restore(spark, path).count() == 238
    with pytest.raises(FileNotFoundError):
        TS.table_restore(spark, str(tmp_path / "missing"))
    t.write.parquet(str(tmp_path / "nulls"))
    assert TS.table_restore(spark, str(tmp_path / "nulls")).filter("last_update_ts is null").count() == 0
    assert TS.bucket_count(0) == 1 and TS.bucket_count(11, 5) == 3


def test_store_versions(spark, tmp_path):
    st = TS.TableStore(spark, str(tmp_path / "v"), key="id")
    with pytest.raises(FileNotFoundError):
        st.current()
    assert st.commit(spark.range(1)) and st.commit(spark.range(2), 0) and not st.commit(spark.range(3), 0)
    assert st.current().count() == 2 and st.pointer() == {"version": 1, "batch": 0}


def test_metric_files(spark, tmp_path):
    dump.metric_dump(spark.range(10), str(tmp_path / "m"), "a", "20240101")
    assert (tmp_path / "m" / "model=a" / "dt=20240101").is_dir()


def test_generated_samples_are_repeatable(spark):
    a = generate_samples(spark, 200, {"f": 3, "g": 4}, {"d": 2}, drop_rate=0.3)
    assert a.collect() == generate_samples(spark, 200, {"f": 3, "g": 4}, {"d": 2}, drop_rate=0.3).collect()
    empty = a.filter(F.size("f") == 0).count()
    assert 30 < empty < 90 and a.filter(F.size("f") > 4).count() == 0 and a.filter(F.size("d") != 2).count() == 0


def test_settled_uses_the_named_folder(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert settled(spark.range(3)).count() == 3


def test_feature_meta(spark, tmp_path):
    (tmp_path / "m.conf").write_text("feed_name=area; shared=true; feature_id=368235\nfeature_name=f_x; slot=12; method=Direct; args=a, 'b'\nnothing here\n")
    rows = {r["name"]: r for r in FM.read_feature_meta(spark, str(tmp_path / "m.conf")).collect()}
    assert rows["area"]["shared"] and rows["area"]["feature_id"] == 368235 and rows["area"]["slot"] is None
    assert rows["f_x"]["slot"] == 12 and rows["f_x"]["args"] == ["a", "b"] and not rows["f_x"]["shared"]


def test_feature_names():
    n = FM.SlotNames([5], combined=True)
    assert [n.slot(x) for x in ("fc_slot_5", "slot_77", "slot_x", "new", "other", "new")] == [5, 77, None, 1, 2, 1]
    cols = ["f_a", "fc_b", "fc_a-fc_b", "c", "d_raw"]
    assert [FM.resolve(cols, x) for x in ("a", "b", "a-b", "c")] == ["f_a", "fc_b", "fc_a-fc_b", "c"]
    with pytest.raises(ValueError):
        FM.resolve(cols, "zz")


def test_prune_drops_raw(spark):
    df = spark.range(1).selectExpr("id", "1 AS f_a", "2 AS b_raw")
    assert FM.prune_features(df, ["a", "b_raw"], ["id"]).columns == ["id", "f_a"]
    assert FM.prune_features(df, ["b_raw"], drop_raw=False).columns == ["b_raw"]


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    from sampleloom.operators.pooling import lookup

    stored = TS.save_bucketed(bind.emb(spark, SF).drop("opt"), "t_bucketed", str(tmp_path / "b"), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lookup(bind.order_ids(spark, SF), stored, 64)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_shards_share_the_files(spark, tmp_path):
    path = str(tmp_path / "files")
    for i in range(5):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    seen, files = [], []
    for i in range(3):
        df = PQ.shard_files(spark, path, 3, i)
        files.append(set(df.inputFiles()))
        seen += [r[0] for r in df.collect()]
    assert sorted(seen) == list(range(50))
    assert [len(f) for f in files] == [2, 2, 1] and len(set().union(*files)) == 5
    assert PQ.shard_files(spark, path, 8, 7).count() == 0
    with pytest.raises(ValueError):
        PQ.shard_files(spark, path, 3, 3)


def test_store_keeps_optimizer_state(spark, tmp_path):
    rows = [("t", 1, [1.0], ([0.5],), 7), ("t", 2, [2.0], None, None)]
    df = spark.createDataFrame(rows, "table string, fid bigint, num array<double>, opt struct<norm:array<double>>, last_update_ts bigint")
    TS.table_save(df, str(tmp_path / "s"), buckets=2)
    got = {r.fid: (r.num, r.opt and r.opt.norm, r.last_update_ts) for r in TS.table_restore(spark, str(tmp_path / "s")).collect()}
    assert got == {1: ([1.0], [0.5], 7), 2: ([2.0], None, 0)}
