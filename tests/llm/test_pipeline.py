import corpus_pipeline
from sampleloom.llm.frames import shared_path

from .cases import SF
from .test_minhash import classes
from .test_suffixes import brute
from .test_tokens import check_pieces


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()])
        if name != "packing":
            assert docs.columns == columns and docs.dtypes == before.dtypes
            assert docs.where("n_chars <> char_length(text)").count() == 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = seen["quality rules"]
    kept = {r["doc_id"] for r in after}
    good = [r for r in before if labels.get(r["doc_id"]) == 1 and r["doc_id"] not in kept]
    assert len(good) < 0.1 * len(before) and len(after) < len(before)
    before, after = seen["MinHash near-dedup"]
    assert {r["doc_id"] for r in after} == set(classes([(r["doc_id"], r["text"]) for r in before]).values())
    before, after = seen["suffix-array dedup"]
    want = brute([(r["doc_id"], r["text"]) for r in before])
    text = {r["doc_id"]: r["text"] for r in after}
    assert set(text) == set(want) and all(len(text[i].encode()) <= n - gone for i, [(n, gone, *_)] in want.items())
    before, after = seen["secret scans"]
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after}
    before, after = seen["packing"]
    check_pieces(docs.collect(), {r["doc_id"]: r["text"] for r in before})
