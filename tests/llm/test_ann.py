import numpy as np

from sampleloom.llm import ann as A

from .cases import SF


def exact(rows, i, k):
    q = dict(rows)[i]
    s = [(-float((np.array(v) * np.array(q)).sum()), j) for j, v in rows if j != i]
    return [(j, -x) for x, j in sorted(s)[:k]]


def test_query_recall(spark):
    for sf in (SF, SF.replace("0.001", "0.1")):
        rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        got = {}
        for r in A.op1(spark, sf).collect():
            got.setdefault(r.query_id, []).append(r)
        assert set(got) == {i for i, _ in rows if i % 20 == 0}
        hit = 0
        for i, rs in got.items():
            rs.sort(key=lambda r: r["rank"])
            assert [r["rank"] for r in rs] == list(range(1, 21))
            want = exact(rows, i, 20)
            hit += len({j for j, _ in want} & {r.vec_id for r in rs})
            assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
        assert hit >= 0.95 * 20 * len(got)


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist(), "x") for i in range(60)] + [(100 + i, [1.0, 2.0, 3.0, 4.0], "x") for i in range(50)]
    bad = [(200, None, "x"), (201, [0.0] * 4, "x"), (202, [1.0, None, 2.0, 3.0], "x"), (203, [float("nan")] * 4, "x"),
           (204, [float("inf"), 0.0, 0.0, 1.0], "x"), (None, [1.0] * 4, "x"), (205, [], "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in A.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {0, 20, 40, 100, 120, 140}
    for i, rs in got.items():
        assert [(r.vec_id, r.score) for r in sorted(rs, key=lambda r: r["rank"])] == exact([(a, b) for a, b, _ in rows], i, 20)
    assert A.nearest(df.where("1 = 0"), df, 3).count() == 0
    assert A.nearest(df, df.where("1 = 0"), 3).count() == 0
    few = df.where("vec_id < 5")
    assert A.nearest(few, few, 20).count() == 5 * 4


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    want = sorted(map(tuple, A.nearest(df, df.where("vec_id % 20 = 0"), 5).collect()))
    monkeypatch.setattr(A, "BLOCK_ROWS", 16)
    monkeypatch.setattr(A, "BLOCK_QUERIES", 3)
    assert sorted(map(tuple, A.nearest(df, df.where("vec_id % 20 = 0"), 5).collect())) == want


def test_tree_visits_best_bins_first():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    tree = A.fit_tree(x, float(np.linalg.norm(x, axis=1).max()), 20)
    order = tree.visits(x[:5], tree.leaves)
    assert all(sorted(o) == list(range(tree.leaves)) for o in order)
    own = tree.assign(x[:5])
    assert np.mean([o.index(a) for o, a in zip(order, own)]) < tree.leaves / 3
