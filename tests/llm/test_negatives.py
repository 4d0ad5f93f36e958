import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from sampleloom.llm import negatives as N
from sampleloom.llm.registry import ORACLES

from .cases import SF


def brute(rows, anchors, low=80, high=100):
    """Rows (id, label, integer vector); anchors by place."""
    out = []
    for a in anchors:
        i, label, x = rows[a]
        s = [(-sum(p * q for p, q in zip(x, y)), j, m) for j, m, y in rows]
        for p, j, m in sorted(t for t in s if t[2] == label and t[1] != i)[:5]:
            fit = sorted(t for t in s if t[2] != label and low * -p <= 100 * -t[0] <= high * -p)[:5]
            out += [(i, j, k + 1, b, -p, -n) for k, (n, b, _) in enumerate(fit)]
    return sorted(out)


def listed(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def integers(v):
    return [math.floor(256 * c) for c in v]


def made(seed=1, n=300, dim=10):
    """Vectors around a few centres, with equal ones and ones of opposite sign."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    rows = [(i, int(rng.integers(0, 4)), (centre[i % 6] + rng.normal(size=dim) * 0.3).tolist()) for i in range(n)]
    rows += [(n + i, i % 4, rows[0][2]) for i in range(40)] + [(n + 50 + i, i % 3, (-np.array(rows[1][2])).tolist()) for i in range(5)]
    return rows


DDL = "vec_id long, label int, embedding array<double>, rank string, anchor string, x string"


def test_against_all_pairs(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame([(*r, "r", "a", "x") for r in rows], DDL)
    whole = [(i, m, integers(v)) for i, m, v in rows]
    want = brute(whole, [k for k, (i, _, _) in enumerate(rows) if i % 10 == 0])
    assert listed(N.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"))) == want
    for name, value in (("ANCHOR_BLOCK", 8), ("ROW_BLOCK", 60), ("TILE", 16), ("OPEN", 2.0)):
        monkeypatch.setattr(N, name, value)
        assert listed(N.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"))) == want


def test_odd_rows(spark):
    rows = [(i, i % 2, [float(i), 1.0]) for i in range(1, 20)] + [(10, 0, [10.0, 1.0])]
    bad = [(None, 0, [1.0, 1.0]), (20, None, [1.0, 1.0]), (30, 0, None), (40, 0, [1.0, None]), (50, 0, [float("nan"), 1.0]),
           (60, 1, [1.0, float("inf")]), (70, 1, []), (80, 1, [1.0]), (90, 0, [1e9, 1.0])]
    df = spark.createDataFrame([(*r, "r", "a", "x") for r in rows + bad], DDL)
    got = listed(N.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label")))
    whole = [(i, m, integers(v)) for i, m, v in rows]
    assert got == brute(whole, [9, 19]) and got
    assert N.hard_negatives(df.where("1 = 0"), F.lit(True), F.col("label")).count() == 0
    assert N.hard_negatives(df, F.lit(False), F.col("label")).count() == 0
    assert N.hard_negatives(df.where("vec_id = 1"), F.lit(True), F.col("label")).count() == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    want = sorted(con.sql(f"SELECT {names} FROM ({ORACLES['op12_hard_negatives']})").fetchall())
    assert listed(N.op12(spark, SF)) == want and want


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(3)
    for scale in (1, 1000, N.LIMIT // 8):
        a, b = (N.Summaries.of(np.rint(rng.normal(size=(n, 24)) * scale + rng.normal(size=(n, 1)) * 3 * scale).astype(np.int64)) for n in (20, 30))
        exact = (a.x.astype(object) @ b.x.T.astype(object)).astype(np.float64)
        width = []
        for level in range(len(a.mean)):
            low, high = N.bounds(a, b, level)
            assert (low <= exact).all() and (exact <= high).all()
            width.append((high - low).mean())
            i, j = np.nonzero(exact > -np.inf)
            one, two = N.pair_bounds(a, b, i, j, level)
            assert np.allclose(one, low[i, j]) and np.allclose(two, high[i, j])
        assert width == sorted(width, reverse=True) and width[-1] < width[0]


def test_large_scores_are_exact():
    x = np.array([[N.LIMIT - 1] * 4096, [N.LIMIT - 2] * 4096])
    a = N.Summaries.of(x)
    assert N.scores(a, a, np.array([0, 1]), np.array([1, 1])).tolist() == [4096 * (N.LIMIT - 1) * (N.LIMIT - 2), 4096 * (N.LIMIT - 2) ** 2]
