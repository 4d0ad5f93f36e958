import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sampleloom.llm import ngram_lm as L
from sampleloom.llm.frames import fold_of

from .cases import SF, empty, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, mu=L.MU):
    """(tokens, known, N, base, score) of rows (text, held out), in order."""
    docs = [WORD.findall((t or "").translate(LOW)) + [None] for t, _ in rows]
    one, two, ctx = Counter(), Counter(), Counter()
    for w, (_, held) in zip(docs, rows):
        if not held:
            one.update(w)
            two.update(zip([None] + w, w))
            ctx.update([None] + w[:-1])
    total, kinds = sum(one.values()), len(one)
    p1 = lambda x: (one[x] + 1) / (total + kinds + 1)
    return [(len(w), sum(one[x] > 0 for x in w), total, sum(math.log10(p1(x)) for x in w),
             sum(math.log10((two[h, x] + mu * p1(x)) / (ctx[h] + mu)) for h, x in zip([None] + w, w))) for w in docs]


def same(got, want):
    assert got[:3] == want[:3]
    assert abs(got[3] - want[3]) < 1e-9 * abs(want[3])
    assert abs(got[4] - want[4]) < 3e-3 * abs(want[4])  # one byte for each probability


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want = dict(zip([i for i, _ in docs], brute([(t, h) for (_, t), h in zip(docs, held)])))
    got = L.op10(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        same(tuple(r)[2:], want[r.doc_id])


def test_frequent_contexts_are_dealt_out(spark):
    """One word before a third of all tokens: its successors lie in many shards, and nothing changes."""
    rows = [(i, " ".join(f"the w{(i * 37 + k * 11) % 400} x" for k in range(60))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute([(t, i % 5 == 0) for i, t in rows])
    for groups in (2, 40):
        got = {r.doc_id: tuple(r)[2:] for r in L.score_documents(df, F.col("doc_id") % 5 == 0, groups=groups).collect()}
        for i, _ in rows:
            same(got[i], want[i])


def test_odd_rows(spark):
    df = frame(spark)
    rows = [(r.text, False) for r in df.collect()]
    got = [tuple(r)[2:] for r in L.score_documents(df, fold_of("doc_id", 7) == 99).collect()]
    assert len(got) == len(rows)
    for a, b in zip(sorted(got), sorted(brute(rows))):
        same(a, b)
    nothing = L.score_documents(df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in nothing)
    assert L.score_documents(empty(spark), F.lit(False)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 5000), max_size=60), st.integers(5001, 1 << 62), st.lists(st.integers(0, 5000), max_size=20))
def test_elias_fano(values, universe, asked):
    v = np.array(sorted(values), np.uint64)
    e = L.EliasFano.of(v, universe)
    if len(v):
        assert (e.get(np.arange(len(v))) == v).all()
        x = np.array(asked + sorted(values), np.uint64)
        want = [int(np.searchsorted(v, y)) if y in v else len(v) for y in x]
        assert e.find(x).tolist() == want


def test_trie_finds_what_it_holds():
    rng = np.random.default_rng(2)
    context = np.unique(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    succ = [np.unique(rng.integers(0, 1 << 40, n, dtype=np.uint64)) for n in rng.integers(0, 30, len(context))]
    prob = rng.random(sum(map(len, succ))) + 1e-6
    t = L.Trie(context, np.concatenate([[0], np.cumsum([len(s) for s in succ])]), np.concatenate(succ), prob)
    size = np.array([len(s) for s in succ])
    got = t.book[t.ask(context, size, np.concatenate(succ))]
    assert np.abs(np.log(got) - np.log(prob)).max() < 0.1
    assert not t.ask(context + np.uint64(1 << 20), size, np.concatenate(succ)).any()
