import random

import numpy as np
import pyarrow as pa

from sampleloom.llm import jaccard as J
from sampleloom.llm.textnum import chunks

from .cases import SF, empty, frame, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    x = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    return {tuple(x[i:i + 5]) for i in range(max(1, len(x) - 4))} if x else set()


def brute(rows):
    """(id, set size, component) of each row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {k for g in s for k in holders[g] if k < i}:
            c = len(s & sets[j])
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in least[root(i)] if x is not None]
        out.append((d, len(sets[i]), d if not sets[i] else min(ids) if ids else None))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def made(seed=3):
    """Groups of near copies, some with a smallest member that is like none, and a passage that many texts share."""
    rnd = random.Random(seed)
    rows, common = [], words(rnd, 90)
    for _ in range(25):
        base = words(rnd, rnd.randrange(3, 200))
        for _ in range(rnd.randrange(1, 9)):
            b = list(base)
            for _ in range(rnd.randrange(1 + len(b) // 20)):
                b[rnd.randrange(len(b))] = words(rnd, 1)[0]
            rows.append(" ".join(b))
    rows += [" ".join(common + words(rnd, 70)) for _ in range(60)] + [" ".join(common[:80] + words(rnd, rnd.randrange(8, 14))) for _ in range(40)]
    rows += ["", "", None, "one two", "ONE\ttwo", "x " * 600, "x " * 500, " \n"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_against_all_pairs(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert result(J.jaccard_components(df)) == want
    monkeypatch.setattr(J, "TILE", 6)
    monkeypatch.setattr(J, "BLOCK", 64)
    assert result(J.jaccard_components(df)) == want


def test_query_against_all_pairs(spark):
    sf = SF.replace("0.001", "0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(J.op13(spark, sf)) == brute(rows)


def test_odd_rows(spark):
    df = frame(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(J.jaccard_components(df)) == brute(rows)
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2
    twice = [(7, base), (7, base + "more"), (7, "quite another text with seven words"), (None, base), (None, "alone without an id here"), (3, base.upper())]
    assert result(J.jaccard_components(spark.createDataFrame(twice, "doc_id long, text string"))) == brute(twice)
    assert J.jaccard_components(empty(spark)).count() == 0


def test_linked_sets_share_a_first_shingle():
    rnd = random.Random(6)
    texts = []
    for _ in range(300):
        w = words(rnd, rnd.randrange(5, 90))
        v = w[rnd.randrange(len(w) // 6 + 1):]
        texts += [" ".join(w), " ".join(v)]
    c = next(chunks(pa.array(texts)))
    key, cut = J.sets_of(c)
    counts = np.bincount(J._counter(key), minlength=J.COUNTERS)
    some, of = J.first_shingles(key, cut, counts)
    size = np.diff(cut)
    assert (np.bincount(of, minlength=c.n) == size - -(-80 * size // 100) + 1).all()
    linked = 0
    for i in range(0, c.n, 2):
        common = len(np.intersect1d(key[cut[i]:cut[i + 1]], key[cut[i + 1]:cut[i + 2]]))
        if 100 * common >= 80 * (size[i] + size[i + 1] - common):
            linked += 1
            assert set(some[of == i]) & set(some[of == i + 1])
    assert linked > 100


def test_tree_leaves_every_link_open_and_prunes():
    texts = [t for _, t in made() if t and t.strip()]
    sets = [J.sets_of(c) for c in chunks(pa.array(texts))]
    key, cut = sets[0]
    tree = J.CountTree(J.points_of(key, cut))
    assert sorted(tree.order) == list(range(len(texts)))
    got = {(int(i), int(j)) for a, b in tree.pairs(80) for i, j in zip(a, b)}
    assert all(i < j for i, j in got)
    i, j = np.array([(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))]).T
    common = J.common_counts(key, cut, i, j)
    plain = [shingle_set(t) for t in texts]
    assert common.tolist() == [len(plain[x] & plain[y]) for x, y in zip(i, j)]
    hit = J.linked(common, tree.n[i], tree.n[j], 80)
    assert set(zip(i[hit].tolist(), j[hit].tolist())) <= got and len(got) < len(i) / 2
