import hashlib
import random
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sampleloom.llm import suffixes as U

from .cases import SF, empty, frame, texts


def brute(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.setdefault(i, []).append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        assert sum(b - a for a, b in r.spans) == r.n_removed
        out.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def test_shared_passages(spark):
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abé ") for _ in range(300)) for _ in range(5)]
    rows = []
    for i in range(120):
        t = ""
        for _ in range(rnd.randrange(5)):
            b, x = rnd.choice(base), rnd.randrange(200)
            t += b[x:x + rnd.randrange(40, 300)] + "".join(rnd.choice("xyz") for _ in range(rnd.randrange(30)))
        rows.append((i * 7 % 120, t + "ab" * rnd.choice([0, 0, 0, 200])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(U.remove_repeats(df)) == brute(rows)
    assert found(U.remove_repeats(df, groups=3)) == brute(rows)


def test_query_and_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    assert all(want[r.doc_id] == [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)] for r in U.op4(spark, SF).collect())
    df = frame(spark, texts() + [texts()[7], "ab " * 2000])
    assert found(U.remove_repeats(df)) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert U.remove_repeats(empty(spark)).count() == 0
    assert "keep_0" in U.remove_repeats(df, keep=["spans"]).columns


def edges(n, seed=5):
    """A passage and a line in every document, with other text around them, and some whole copies."""
    rnd = random.Random(seed)
    some = lambda k: "".join(rnd.choice("abcdefé ") for _ in range(k))
    passage, line = some(250), some(101)
    rows = [(i, some(rnd.randrange(90)) + passage + some(rnd.randrange(90)) + (line if i % 3 else "") + some(rnd.randrange(90))) for i in range(n)]
    return rows + [(n + i, rows[i][1]) for i in range(0, n, 7)] + [(None, rows[3][1]), (5, rows[8][1] + passage)]


def test_heavy_anchor_is_not_one_group(monkeypatch):
    """An anchor with different text around it in every document never meets whole in one range, and the result is the same."""
    rows = edges(150)
    n, heavy, most = 8, 20, Counter()
    tables = []
    for g in range(n):
        mine = [r for r in rows if (r[0] or 0) % n == g]
        tables.append(pa.table({"doc_id": pa.array([r[0] for r in mine], pa.int64()), "text": [r[1] for r in mine],
                                "gid": pa.array([g] * len(mine), pa.int32())}))
    plain = U.repeated

    def watched(group, length):
        most["entries"] = max(most["entries"], len(group))
        return plain(group, length)

    monkeypatch.setattr(U, "repeated", watched)
    asked = pa.concat_tables([U.ask(t, n, 100, 32) for t in tables])
    asked = asked.append_column("n", pa.array([len(k) // 8 for k in asked["keys"].to_pylist()], pa.int32()))
    by = lambda t, c, x: t.filter(pa.compute.equal(t[c], x))
    replies = pa.concat_tables([U.answer(b, heavy).append_column("n", b["n"]) for k in range(n) if len(b := by(asked, "bucket", k))])
    sent = pa.concat_tables([U.runs(t, by(replies, "gid", g), [], n, 100, 32) for g, t in enumerate(tables)])
    hits = pa.concat_tables([U.merge_range(p, 100, 32) for k in range(n) if len(p := by(sent, "part", k))])
    assert most["entries"] < heavy
    assert len({x["part"] for x in sent.to_pylist() if x["kind"] == 2}) == n
    got = {}
    for g, t in enumerate(tables):
        for r in U.cut_out(t, by(hits, "gid", g), 100, []).to_pylist():
            got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()))
    assert {i: sorted(v) for i, v in got.items()} == brute(rows)


def test_heavy_anchors_in_spark(spark):
    rows = edges(120, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for heavy in (2, 30):
        assert found(U.remove_repeats(df, heavy=heavy)) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=12), max_size=20), max_size=9))
def test_loser_tree_merges_and_knows_prefixes(groups):
    runs = [sorted(x.encode() for x in g) for g in groups]
    coded = [U.front_coded(r) for r in runs]
    assert [U.decoded(*c) for c in coded] == runs
    got = list(U.merged(runs, [c[0].tolist() for c in coded])) if runs else []
    out = [runs[r][i] for _, r, i in got]
    assert out == sorted(x for r in runs for x in r)
    for (n, _, _), a, b in zip(got[1:], out, out[1:]):
        assert n == U.shared_prefix(a, b)
