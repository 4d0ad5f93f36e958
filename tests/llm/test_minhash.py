import random
from collections import Counter

import numpy as np
import pyarrow as pa

from sampleloom.llm import minhash as M
from sampleloom.llm.textnum import chunks

from .cases import SF, empty, frame, words


def bag(text):
    x = (text or "").split()
    return Counter(tuple(x[i:i + 5]) for i in range(max(1, len(x) - 4))) if x else None


def classes(rows):
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    bags, holders = {i: bag(t) for i, t in rows}, {}
    text = dict(rows)
    for i, t in rows:
        a = bags[i] or {"": 1}
        near = {j for g in a for j in holders.get(g, [])}
        for g in a:
            holders.setdefault(g, []).append(i)
        for j in near:
            u, a, b = text[j], bags[i], bags[j]
            if (t or "") == (u or "") or a and b and 5 * sum((a & b).values()) >= 4 * sum((a | b).values()):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i, _ in rows}


def made(seed=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(25):
        base = words(rnd, rnd.randrange(3, 200))
        for _ in range(rnd.randrange(1, 7)):
            b = list(base)
            for _ in range(rnd.randrange(1 + len(b) // 25)):
                b[rnd.randrange(len(b))] = words(rnd, 1)[0]
            rows.append(" ".join(b))
    shared = words(rnd, 100)
    rows += [" ".join(shared + words(rnd, 70)) for _ in range(60)] + ["", "", None, "one two", "one two", "x " * 600]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_signatures_estimate_weighted_jaccard():
    rnd = random.Random(1)
    a = words(rnd, 400)
    b = [w if rnd.random() > 0.04 else "zz" for w in a] + a[:50]
    for x, y in ((a, b), (a[:9], a[:8]), (a * 2, a)):
        c = next(chunks(pa.array([" ".join(x), " ".join(y)])))
        sig, _ = M.signatures(c, 600)
        p, q = bag(" ".join(x)), bag(" ".join(y))
        want = sum((p & q).values()) / sum((p | q).values())
        assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(0.25 / 600)


def test_classes_against_all_pairs(spark):
    rows = made()
    got = {r.doc_id: r.class_id for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(rows)


def test_buckets_are_dealt_in_parts(spark, monkeypatch):
    """A bucket whose head is like nobody: the others still find each other, also over parts, with fewer links than rows."""
    rnd = random.Random(9)
    base = " ".join(words(rnd, 80))
    rows = [(0, " ".join(words(rnd, 80)))] + [(i, base + " " + words(rnd, 1)[0]) for i in range(1, 13)]
    sets = M._shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    bucket = spark.createDataFrame([(0, 1, i, i) for i, _ in rows], "band int, key long, doc_id long, root long")
    for tile in (2000, 4):
        monkeypatch.setattr(M, "TILE", tile)
        links = M._links_between(bucket.join(sets, "doc_id"), 0.8)
        assert tile < 100 or links.count() == 11
        assert {r.node: r.root for r in M.components(links).collect()} == {i: 1 for i in range(1, 13)}


def test_pair_below_its_estimate_is_linked(spark):
    """Two texts of similarity 0.8 behind a head like neither: few equal coordinates do not lose the link."""
    rnd = random.Random(4)
    pairs = []
    for _ in range(3000):
        w = words(rnd, 104)
        pairs += [" ".join(w[:94]), " ".join(w[10:])]
    sig = np.concatenate([M.signatures(c)[0] for c in chunks(pa.array(pairs))])
    agree = (sig[::2] == sig[1::2]).mean(1)
    k = 2 * int(np.argmin(agree))
    a, b = bag(pairs[k]), bag(pairs[k + 1])
    assert agree.min() < 0.65 and 5 * sum((a & b).values()) >= 4 * sum((a | b).values())
    rows = [(0, " ".join(words(rnd, 94))), (1, pairs[k]), (2, pairs[k + 1])]
    sets = M._shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    bucket = spark.createDataFrame([(0, 1, i, i) for i, _ in rows], "band int, key long, doc_id long, root long")
    assert [tuple(r) for r in M._links_between(bucket.join(sets, "doc_id"), 0.8).collect()] == [(1, 2)]


def test_similarities_of_many_rows():
    """The index gives what each pair gives, with counts, in blocks and pair by pair."""
    texts = [t for _, t in made() if t]
    parts = []
    for c in chunks(pa.array(texts)):
        key, doc, count = M.shingles(c)
        for i in range(c.n):
            k, n = key[doc == i] >> np.uint64(24), count[doc == i].astype("<u4")
            parts.append((k & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (k >> np.uint64(32)).astype(np.uint8).tobytes() + n.tobytes())
    sets = M.Sets(parts)
    for block in (M.BLOCK, 7):
        old, M.BLOCK = M.BLOCK, block
        try:
            for r in range(1, len(parts), 5):
                want = [M.weighted_jaccard(parts[h], parts[r]) for h in range(r)]
                assert sets.similar(r, np.arange(r)).tolist() == want
        finally:
            M.BLOCK = old


#: Shingles whose 64-bit hashes differ and agree in their upper 40 bits.
ALIKE = [("upw wac kbz lnm hst", "rxv pig sbp xib myf"), ("gex mag ndk icm hlp", "qys qws bei qgl fsi")]


def alike(seed=6):
    """Near copies of a text that holds both shingles of each of two such pairs, one of them three times."""
    rnd = random.Random(seed)
    base = words(rnd, 150)
    for a, b in ALIKE:
        base[rnd.randrange(50):0] = a.split()
        base += b.split() + words(rnd, 9)
    base += (ALIKE[0][1] + " " + " ".join(words(rnd, 9))).split() * 2
    return [" ".join(base)] + [" ".join(base + words(rnd, n)) for n in (1, 2, 3, 5, 8)]


def test_shingles_of_one_text_that_share_a_stored_hash(spark):
    """Two such shingles count as one in the sets; near copies that hold both are compared with heads and in buckets."""
    texts = alike()
    c = next(chunks(pa.array(texts)))
    key, doc, count = M.shingles(c)
    assert all(len(np.unique(key[doc == i] >> np.uint64(24))) == len(key[doc == i]) - 2 for i in range(c.n))
    rows = list(enumerate(texts))
    sets = M._shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    parts = [bytes(r.parts) for r in sets.orderBy("doc_id").collect()]
    for i, p in enumerate(parts):
        k, n = M._set(p)
        assert (k[1:] > k[:-1]).all() and n.sum() == count[doc == i].sum()
    bags = [bag(t) for t in texts]
    for r in range(1, len(texts)):
        want = [sum((bags[h] & bags[r]).values()) / sum((bags[h] | bags[r]).values()) for h in range(r)]
        assert [M.weighted_jaccard(parts[h], parts[r]) for h in range(r)] == want
        assert M.Sets(parts).similar(r, np.arange(r)).tolist() == want
    bucket = spark.createDataFrame([(0, 1, i, i) for i, _ in rows], "band int, key long, doc_id long, root long")
    assert M._links_between(bucket.join(sets, "doc_id"), 0.8).count() == len(rows) - 1
    docs = spark.createDataFrame(rows + [(9, "quite another text of seven words")], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in M.near_duplicates(docs).collect()} == {i: 0 for i, _ in rows} | {9: 9}
    assert sorted(r.doc_id for r in M.near_duplicates_stage(spark, docs, SF).collect()) == [0, 9]


def test_odd_rows_and_stage(spark):
    df = frame(spark)
    got = M.near_duplicates(df)
    assert got.count() == df.count()
    by = {r.doc_id: r.class_id for r in got.collect()}
    assert by[None] is None and by[0] == by[1] == 0 and by[10] == by[9]
    base = " ".join(words(random.Random(2), 60))
    shared = [(1, base, "b"), (1, "quite another text that shares the id", "a"), (1, base, "a"), (2, base + " more", "c"), (None, "no id here at all", "x"),
              (None, "no id here at all", "x"), (None, "nor here though the text differs", "x"), (None, base, "z"), (5, None, "n"), (4, "", "n")]
    df = spark.createDataFrame(shared, "doc_id long, text string, band string")
    got = sorted(map(tuple, M.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1)] * 3 + [(2, 1), (None, 1), (5, 4), (4, 4)] + [(None, None)] * 3, key=str)
    runs = [sorted(map(tuple, M.near_duplicates_stage(spark, df.repartition(n), SF).collect()), key=str) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 5
    assert [(i, t) for i, t, _ in runs[0]] == sorted([(1, base), (1, shared[1][1]), (4, ""), (None, shared[4][1]), (None, shared[6][1])], key=str)
    assert M.near_duplicates(empty(spark)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = M.near_duplicates_stage(spark, docs.unionByName(docs.limit(3)), SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes(rows).values()))


def test_every_near_pair_of_the_documents_is_joined(spark):
    """Recall on sf0.01: the classes are those of all pairs of similarity 0.8 and more."""
    sf = SF.replace("0.001", "0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.class_id for r in M.op5(spark, sf).collect()} == classes(rows)


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    names = rnd.sample(range(10 ** 6), 400)
    chain, star, up = names[:200], names[200:300], sorted(names[300:])
    links = list(zip(chain, chain[1:])) + [(star[0], x) for x in star[1:]] + list(zip(up, up[1:])) + [(7, 7), (up[3], up[2])]
    got = {r.node: r.root for r in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: min(group) for group in (chain, star, up) for x in group}
    assert M.components(spark.createDataFrame([], "a long, b long")).count() == 0
