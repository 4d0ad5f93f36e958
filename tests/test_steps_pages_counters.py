"""Transforms as data, pages by cursor, old table names, counters that ride along."""

import pytest
from pyspark.sql import functions as F

from sampleloom.functions import labels as L
from sampleloom.functions import predicates as P
from sampleloom.operators import samples as S
from sampleloom.operators import steps as ST
from sampleloom.operators import tables as E
from sampleloom.plans import bindings as bind
from sampleloom.sources.table_store import save_pages, stored_page, stored_pages
from sampleloom.streaming import flows as W

SF = "/root/testdata/sf0.001"

STEPS = [
    ST.step("by_fids", fids="f_tags", filter_fids=[(5 << 48) + 70], has_fids=[], actions="actions", has_actions=[1, 2]),
    ST.step("has_slots", fids="f_tags", slots=[5]),
    ST.step("any_action", actions="actions", wanted=[1, 2, 4]),
    ST.step("by_label", label="label", thresholds=[1.0, 0.2], filter_equal=True),
    ST.step("compare", value="uid", op="between", operand=(3, 90)),
    ST.step("set_compare", values="f_tags", op="any", operands=[(5 << 48) + 70]),
    ST.step("feature_value", values="f_tags", op="gt", operand=5, field_type="int64"),
    ST.step("negative_kept", key="sample_id", label="sample_rate", drop_rate=0.5),
    ST.step("add_action", actions="actions", new=[9], field="uid", op="lt", operand=50),
    ST.step("add_label", key="sample_id", label="label", actions="actions", config="4::1.0"),
    ST.step("scatter_label", label="label", chnid="chnid", config="1:0,2:1"),
    ST.step("multi_label", label="label", actions="actions", head="device_type", heads={"pc": 0, "mobile": 1}, positive=[2], negative=[1]),
    ST.step("label_upper_bound", label="label", bounds=[0.5, 0.5]),
    ST.step("normalize_label", label="label", methods=[("scale", 0.5), ("repow", 3.0)]),
    ST.step("multi_rank_label", label="label", is_draw="is_draw", chnid="chnid", rank="rank", rank_num=7),
    ST.step("map_id", x="chnid", mapping={1: 10, 2: 20}),
    ST.step("field_as_label", field="uid", threshold=3.0),
    ST.step("special_strategy", strategies=[1, 2], rates={1: 0.5}),
    ST.step("negative_sample", drop_rate=0.5),
    ST.step("instance_reweight", priority=[4, 3], table={4: (2, 1), 3: (1, 0)}),
]


def test_every_kind_goes_through_text():
    assert {s.kind for s in STEPS} == set(ST.KINDS)
    tree = ST.every(*STEPS[:4], ST.either(STEPS[2], ST.every(*STEPS[3:5])), *STEPS[8:])
    text = ST.to_json(tree)
    again = ST.from_json(text)
    assert ST.to_json(again) == text
    assert again.steps[-1].params["table"] == {4: [2, 1], 3: [1, 0]}


@pytest.mark.parametrize("step", [s for s in STEPS if s.kind not in ("instance_reweight", "feature_value", "set_compare")], ids=lambda s: s.kind)
def test_a_stored_step_is_the_function(spark, step):
    df = bind.samples(spark, SF)
    kind = ST.KINDS[step.kind]
    if kind.rows:
        want = kind.make(df, **step.params)
    elif kind.sets is None:
        want = df.filter(kind.make(**step.params))
    else:
        want = df.withColumn(step.params.get(kind.sets, kind.sets) if kind.sets in kind.columns else kind.sets, kind.make(**step.params))
    got = df.transform(ST.compiled(ST.from_json(ST.to_json(step))))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_filters_are_one_expression(spark):
    df = bind.samples(spark, SF)
    tree = ST.every(STEPS[2], ST.every(STEPS[4], ST.either(STEPS[2], STEPS[3])))
    by_hand = df.filter(P.any_action("actions", [1, 2, 4]) & P.compare("uid", "between", (3, 90)) & (
        P.any_action("actions", [1, 2, 4]) | P.by_label("label", [1.0, 0.2], True)))
    assert df.transform(ST.compiled(tree)).sameSemantics(by_hand)
    both = df.transform(ST.compiled(ST.every(STEPS[2], STEPS[9], STEPS[3])))
    assert both.count() == df.filter(P.any_action("actions", [1, 2, 4])).withColumn(
        "label", L.add_label("sample_id", "label", "actions", "4::1.0")).filter(P.by_label("label", [1.0, 0.2], True)).count()


@pytest.mark.parametrize("text", [
    '{"step": "no_such", "params": {}}', '{"step": "by_label", "params": {"label": "label"}}', '{"either": []}', '{"all": []}',
    '{"step": "by_label", "params": {"label": "label", "thresholds": [1], "x": 1}}',
    '{"either": [{"step": "add_label", "params": {"key": "sample_id", "label": "label", "actions": "actions", "config": "4::1.0"}}]}'])
def test_wrong_trees_are_refused(text):
    with pytest.raises(ValueError):
        ST.from_json(text)


def test_columns_are_checked(spark):
    df = bind.samples(spark, SF)
    for step in (ST.step("any_action", actions="nowhere", wanted=[1]), ST.step("any_action", actions="uid", wanted=[1]),
                 ST.step("map_id", x="device_type", mapping={1: 2})):
        with pytest.raises(ValueError):
            df.transform(ST.compiled(step))


def test_pages_join_to_the_shard_and_read_few_files(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("table"), F.col("id").alias("fid"), F.col("id").alias("v"))
    save_pages(rows, str(tmp_path / "p"), 2, 40)
    want = [i for i in range(1000) if i % 2 == 1]
    got, after = [], None
    while True:
        page = stored_page(spark, str(tmp_path / "p"), "a", 1, 50, after)
        ids = [r.fid for r in page.collect()]
        if not ids:
            break
        assert len(page.inputFiles()) > 0 and page.select(F.input_file_name()).distinct().count() <= 3
        got, after = got + ids, ids[-1]
    assert got == want


def test_all_pages_at_once_are_the_pages_of_a_walk(spark, tmp_path):
    rows = spark.range(700).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("table"), F.col("id").alias("fid"))
    save_pages(rows, str(tmp_path / "p"), 2, 40)
    got = {}
    for r in stored_pages(spark, str(tmp_path / "p"), "a", 1, 50).collect():
        got.setdefault(r.page_no, []).append(r.fid)
    after = None
    for page_no in range(len(got)):
        page = [r.fid for r in stored_page(spark, str(tmp_path / "p"), "a", 1, 50, after).collect()]
        assert sorted(got[page_no]) == page
        after = page[-1]
    assert stored_page(spark, str(tmp_path / "p"), "a", 1, 50, after).isEmpty()
    assert stored_pages(spark, str(tmp_path / "p"), "a", 0, 50).count() == 280 and stored_pages(spark, str(tmp_path / "p"), "c", 1, 50).isEmpty()


def test_pages_hold_under_inserts(spark):
    table = lambda ids: spark.createDataFrame([("t", i) for i in ids], "table string, fid bigint")
    one = [r.fid for r in E.page_after(table(range(0, 100, 2)), 1, 0, 20).collect()]
    more = table([*range(0, 100, 2), 1, 3, 95])  # two before the cursor, one behind it
    two = [r.fid for r in E.page_after(more, 1, 0, 100, max(one)).collect()]
    assert sorted(one + two) == sorted([*range(0, 100, 2), 95])


def test_old_names(spark):
    configs = {"fc_slot_1": "x", "fc_slot_2": "x", "user": "y"}
    both, old, user = E.merged_name(["fc_slot_1", "fc_slot_2"]), E.merged_name(["slot_1", "slot_2"]), E.merged_name(["user"])
    assert E.restore_names(configs, {"user": ["people"]}) == {both: [both, old], user: [user, "people"]}
    assert E.resolve_names({both: [both, old], user: [user, "people"]}, [old, "people", "z"]) == {old: both, "people": user}
    assert E.resolve_names({both: [both, old]}, [both, old]) == {both: both}  # the first name wins
    with pytest.raises(ValueError):
        E.resolve_names({"a": ["s"], "b": ["s"]}, ["s"])
    saved = spark.createDataFrame([(old, 1), (user, 2), ("other", 3)], "table string, fid bigint")
    assert sorted(map(tuple, E.restore_merged(saved, configs).collect())) == sorted([(both, 1), (user, 2)])


def test_counters_take_no_second_pass(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    batch = spark.range(500).mapInArrow(passed, "id bigint")
    out = []
    W.counting({"top": F.max("id")}, str(tmp_path / "c"), lambda df, i: out.append(len(df.collect())))(batch, 0)
    assert out == [500] and read.value == 500
    W.counting({"top": F.max("id")}, str(tmp_path / "c"))(batch, 1)
    assert read.value == 1000
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "c")).select("batch_no", "rows", "top").collect())) == [(0, 500, 499), (1, 500, 499)]


def test_a_listener_logs_every_batch_over_a_restart(spark, tmp_path):
    base = str(tmp_path)
    log = W.CounterLog(spark, "seen", f"{base}/log")
    spark.streams.addListener(log)
    try:
        for part in range(2):
            for i in range(3):
                spark.range(10 * (i + 1)).coalesce(1).write.mode("append").parquet(f"{base}/in")
            src = W.file_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema, files_per_trigger=1)
            W.run_available(W.observed(src, "seen", {"top": F.max("id")}), f"{base}/ckpt", path=f"{base}/out")
        import time
        for _ in range(50):  # events come a little later than the batch
            time.sleep(0.2)
            try:
                if log.counters().count() == 6:
                    break
            except Exception:
                continue
    finally:
        spark.streams.removeListener(log)
    got = log.counters()
    assert got.agg(F.sum("rows"), F.max("top")).first() == (120, 29) and got.select("batch_no").distinct().count() == 6


def test_retention_comes_from_the_run_of_the_filters(spark):
    from pyspark.sql import Observation

    filters = {"small": F.col("id") < 80, "even": F.col("id") % 2 == 0, "none": F.col("id") < -1}
    seen = Observation()
    assert S.filtered(spark.range(100), dict(list(filters.items())[:2]), seen).count() == 40
    assert S.retention_of(dict(list(filters.items())[:2]), seen) == [("small", 100, 80, 0.8), ("even", 80, 40, 0.5)]
    seen = Observation()
    assert S.filtered(spark.range(10), {"none": filters["none"]}, seen).count() == 0
    assert S.retention_of({"none": filters["none"]}, seen) == [("none", 10, 0, 0.0)]
