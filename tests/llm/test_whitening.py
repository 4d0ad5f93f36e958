import math
from fractions import Fraction

import numpy as np

from sampleloom.llm import whitening as W

from .cases import SF

DDL = "vec_id long, embedding array<double>, n string, component string, index string, x string, part string"


def exact(vectors, k=32):
    """Component shares, whitened rows up to sign, and exact deviations, by plain products of integers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(dim)]
    y = [[n * r[i] - s[i] for i in range(dim)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n ** 3)) for j in range(dim)] for i in range(dim)])
    e, v = np.linalg.eigh(cov)
    order = np.argsort(-e)[:k]
    order = order[e[order] > 1e-12 * e.max()] if e.max() > 0 else order[:0]
    z = np.array(y, float) / n @ v[:, order] / np.sqrt(e[order])
    return e[order] / np.trace(cov), z, [sum(a * a for a in r) for r in y]


def compare(rows, vectors):
    """Rows of the result in the order of ``vectors``, each vector with an id of its own."""
    share, z, dev = exact([v for _, v in vectors])
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * len(share)
    m = np.array([[got[i, c + 1].whitened for c in range(len(share))] for i, _ in vectors])
    assert np.allclose(m * np.sign((m * z).sum(0)), z, atol=1e-7)
    for (i, _), d in zip(vectors, dev):
        for c, e in enumerate(share):
            r = got[i, c + 1]
            assert r.n == len(vectors) and r.deviation == d and abs(r.explained - e) < 1e-9 and r.identity_error < 1e-8


def test_query_against_exact_products(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(W.op11(spark, SF).collect(), rows)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=5) * [1, 2, 3, 4, 5]).tolist()) for i in range(230)]
    df = spark.createDataFrame([(*r, *"abcde") for r in rows], DDL).repartition(7)
    compare(W.whiten(df).collect(), rows)
    monkeypatch.setattr(W, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(W, "GROUPS", 3)
    compare(W.whiten(df).collect(), rows)
    assert W.whiten(df, components=2).agg({"component": "max"}).first()[0] == 2


def test_odd_rows(spark):
    rows = [(i, [float(i % 7), float(i % 3) / 2, 1.0]) for i in range(20)]  # one entry without spread
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [1.0, float("inf"), 1.0]), (105, [1.0, 2.0]), (106, [1e13, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, *"abcde") for r in rows + bad], DDL)
    compare(W.whiten(df).collect(), rows)
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [5.0, 1.0])], "vec_id long, embedding array<double>")
    got = W.whiten(twice).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [("1", 1), ("1", 1), ("None", 1)]
    assert W.whiten(df.where("1 = 0")).count() == 0
    assert W.whiten(df.where("vec_id = 3")).count() == 0  # a single row has no spread
    assert W.whiten(spark.createDataFrame([(i, [2.0, 3.0]) for i in range(4)], "vec_id long, embedding array<double>")).count() == 0


def test_deviations_beyond_a_long():
    y = np.array([[3, 4], [1 << 31, 1 << 31], [1 << 33, 0]])
    assert W.deviations(y[:1]) == [25] and W.deviations(y) == [25, None, None]
    assert W.deviations(np.array([[1 << 31, 1 << 30]])) == [(1 << 62) + (1 << 60)]
