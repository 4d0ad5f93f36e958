import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from sampleloom.llm import toxicity as X
from sampleloom.llm.textnum import chunks

from .cases import SF, empty, frame, words


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = X.op8(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    hit = sum(a and b for a, b in held)
    assert hit >= 0.8 * sum(a for a, _ in held) and hit >= 0.75 * sum(b for _, b in held)


def test_odd_rows(spark):
    df = frame(spark)
    none = X.score_toxicity(df, None)
    assert none.count() == df.count() and none.where("score <> 0").count() == 0
    few = spark.createDataFrame([(9, 1), (10, 0), (17, 0), (18, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = X.fit_toxicity(df, few)
    rows = X.score_toxicity(df, model).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert X.score_toxicity(empty(spark), model).count() == 0
    assert X.fit_toxicity(df, few.where("1 = 0")) is None


def fitted(texts, toxic, prior=0.1):
    return X.fit(pa.chunked_array([pa.array(texts, pa.large_string())]), np.array(toxic), prior)


def scores(model, texts):
    return np.concatenate([model.score(c) for c in chunks(pa.array(texts, pa.large_string()))])


def invented(n_toxic, n_plain, seed=4):
    """Texts of invented words; a toxic one holds two or three of ten bad words."""
    rnd = random.Random(seed)
    bad, good = words(rnd, 10), words(rnd, 400)
    bad = [w + "q" for w in bad]
    out = []
    for i in range(n_toxic + n_plain):
        t = [rnd.choice(good) for _ in range(rnd.randrange(5, 120))] + words(rnd, 5)
        for _ in range(rnd.randrange(2, 4) if i < n_toxic else 0):
            t[rnd.randrange(len(t))] = rnd.choice(bad)
        out.append((" ".join(t), int(i < n_toxic)))
    rnd.shuffle(out)
    return [t for t, _ in out], [y for _, y in out], good


def test_rare_toxic_labels_and_long_texts():
    texts, toxic, good = invented(40, 4000)
    model = fitted(texts, toxic, 0.01)
    texts, toxic, _ = invented(300, 300, seed=4)
    got, y = scores(model, texts) >= 0.3, np.array(toxic) == 1
    assert got[y].mean() > 0.9 and got[~y].mean() < 0.02
    rnd = random.Random(8)
    behind = [" ".join(rnd.choice(good) for _ in range(1500)) + "\n" + t for t, v in zip(texts, toxic) if v]
    assert (scores(fitted(*invented(300, 3000)[:2]), behind) >= 0.3).mean() > 0.85


def plain_model(docs, toxic):
    """Kneser-Ney by dictionaries: probability of a word after another in a class (0 toxic, 1 ordinary)."""
    seen, n = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0, 0])
    for d, y in zip(docs, toxic):
        for v, w in zip([None] + d, d):
            n[v, w][1 - y] += 1
            n[v, w][2] += 1
    total = defaultdict(lambda: [0, 0, 0])
    for (v, w), c in n.items():
        for k in range(3):
            total[v][k] += c[k]
            seen[w][k] += c[k] > 0
    bin_of = {w: int(math.log2(c[2])) for w, c in seen.items()}
    floor = 1 / max(1000, 2 * len(seen))

    def one(w, k):
        if w not in seen:
            return floor * X.UNSEEN
        return mass(w, k) / sum(mass(u, k) for u in seen) * (1 - X.UNSEEN) + floor * X.UNSEEN

    def mass(w, k):
        same = [u for u in seen if bin_of[u] == bin_of[w]]
        taken = X.DISCOUNT * max(0.5, sum(seen[u][k] > 0 for u in same))
        return max(0, seen[w][k] - X.DISCOUNT) + taken * seen[w][2] / sum(seen[u][2] for u in same)

    def two(v, w, k):
        c = n.get((v, w), [0, 0, 0])
        return max(0, c[k] - X.DISCOUNT) / max(1, total[v][k]) if c[2] >= X.PAIR_COUNT else 0.0

    def rest(v, k):
        return 1 - sum(two(v, w, k) for u, w in list(n) if u == v)

    return lambda v, w, k: two(v, w, k) + rest(v, k) * (two(v, w, 2) + rest(v, 2) * one(w, k))


def test_probabilities_against_plain_counts():
    rnd = random.Random(2)
    some = words(rnd, 12)
    docs = [[rnd.choice(some[: 4 + i % 9]) for _ in range(rnd.randrange(1, 30))] for i in range(40)]
    toxic = [i % 3 == 0 for i in range(40)]
    c = next(chunks(pa.array([" ".join(d) for d in docs], pa.large_string())))
    lm = X.kneser_ney(c.word_hash, c.words[2], np.array(toxic, int))
    p = plain_model(docs, toxic)
    asked = docs[:8] + [["never", some[0], "seen"]]
    got = lm.shares(next(chunks(pa.array([" ".join(d) for d in asked], pa.large_string()))))
    for k in (0, 1):
        want = [p(v, w, k) for d in asked for v, w in zip([None] + d, d)]
        assert np.allclose(got[k], want, rtol=1e-5)


def test_a_word_list_is_a_distribution():
    left = np.array([[1, 0, 1], [0, 3, 3], [40, 0, 40], [2, 2, 4], [0, 1, 1], [30, 300, 330]])
    assert np.allclose(X.word_shares(left, 0.0).sum(0), 1 - X.UNSEEN)
    p = X.word_shares(left, 1e-3)
    assert p[2, 0] / p[2, 1] > 20 * p[0, 0] / p[0, 1]  # seen often in one class only, and seen once


def test_contradicting_labels_are_no_examples(spark):
    df = frame(spark)
    a = spark.createDataFrame([(9, 1), (10, 0), (17, 0), (18, 1)], "doc_id long, toxic int")
    b = a.union(spark.createDataFrame([(20, 1), (20, 0)], a.schema))
    one, two = (sorted(r.score for r in X.score_toxicity(df, X.fit_toxicity(df, x)).collect()) for x in (a, b))
    assert one == two


def test_a_copied_passage_counts_once():
    word = np.arange(1, 9, dtype=np.uint64)
    once = X.kneser_ney(word, np.zeros(8, int), np.array([1, 0]))
    often = X.kneser_ney(np.tile(word, 50), np.repeat(np.arange(50), 8), np.array([1] * 50 + [0]))
    assert np.allclose(once.word.get(word), often.word.get(word))
