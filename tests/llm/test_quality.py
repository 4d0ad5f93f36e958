import re
from collections import Counter

from sampleloom.llm import quality as Q

from .cases import SF, empty, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, cover = Counter(win), set()
    for i, k in enumerate(win):
        if n[k] > 1:
            cover |= set(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def check(rows):
    for r in rows:
        want = counts(r.source_text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_base_counts_of_odd_texts(spark):
    df = frame(spark).withColumn("source_text", Q.F.col("text"))
    got = Q.score_quality(df, None).collect()
    assert len(got) == df.count() and {r.quality_score for r in got} == {1.0}
    check(got)


def test_query_counts_and_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Q.op9(spark, SF).join(docs.select("doc_id", Q.F.col("text").alias("source_text")), "doc_id").collect()
    check(got)
    big = SF.replace("0.001", "0.01")
    d, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = Q.fit_quality(d, labels.where("doc_id % 2 = 0"))
    rows = Q.score_quality(d, model, keep=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.95 * len(rows)


def test_empty_tables_and_one_class(spark):
    assert Q.score_quality(empty(spark), None).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.fit_quality(frame(spark), none) is None
    one = spark.createDataFrame([(i, 1) for i in range(6)] + [(None, 0), (7, None)], "doc_id long, quality int")
    model = Q.fit_quality(frame(spark), one)
    assert all(r.quality_score > 0.5 for r in Q.score_quality(frame(spark), model).collect())
