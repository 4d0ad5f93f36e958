import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sampleloom.llm import packing as P
from sampleloom.llm import token_files as T
from sampleloom.llm.frames import shared_path
from sampleloom.llm.tokens import Encoder, encoder

from .cases import SF, empty, frame, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)


def ids(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids


def packed(x):
    return array("I", x).tobytes()


def test_encoder_is_the_library():
    odd = [t or "" for t in texts()] + ["  a b\n\nc  d ", " x", "\n a", "a \nb", "\x1cfoo bar", "it's we'll 12 45", "a<|endoftext|> b", "\0x y", " ", "\n", "a\r\nb", "a  b"]
    assert encoder(PATH).encode(odd) == [packed(ids(t)) for t in odd]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(" \n\tab'sé日1.　\x1d"), max_size=30))
def test_encoder_on_white_space(text):
    assert encoder(PATH).encode([text]) == [packed(ids(text))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\0ab'é.,;!?"), max_size=30), max_size=4))
def test_encoder_on_marks(many):
    assert encoder(PATH).encode(many) == [packed(ids(t)) for t in many]


def test_new_words_with_marks_are_learned_bare():
    """A word behind which different marks stand is looked up and remembered once."""
    model = Encoder(PATH)
    seen, learn = [], model._learn
    model._learn = lambda pieces: (seen.extend(pieces), learn(pieces))
    text = " ".join(["qwzxv" + m for m in ("", ",", ".", "!", "?!", ";")])
    assert model.encode([text]) == [packed(ids(text))]
    assert seen.count("qwzxv") == 1 and not any(x.startswith("qwzxv") and x != "qwzxv" for x in seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=40), min_size=1, max_size=8), st.integers(2, 5))
def test_repair_round_trip(docs, frequent):
    size = np.array([len(d) for d in docs])
    last = np.zeros(size.sum(), bool)
    last[np.cumsum(size) - 1] = True
    flat = np.array([x for d in docs for x in d])
    seq, rules, rounds = T.repair(flat, last, 6, frequent)
    shard = T.Shard(6, rules, rounds, seq, size)
    assert shard.documents().tolist() == flat.tolist()
    for k, d in enumerate(docs):
        assert shard.documents(k, k + 1).tolist() == d


def test_repair_shrinks():
    docs = [packed([1, 2, 3, 4] * 200 + [0])] * 5
    assert len(T.Shard.of(T.encode_shard(docs, 10)).seq) < 200


def test_token_files(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    at = 0
    for r in sorted(T.op2(spark, SF).collect(), key=lambda r: r.doc_id):
        x = ids(text[r.doc_id]) + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(packed(x)))
        at += len(x)


def test_token_files_of_odd_rows(spark):
    df = frame(spark)
    path = shared_path(spark, "odd")
    T.write_tokens(df, path, shard_tokens=500)
    got = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.tokens)) for r in T.read_tokens(spark, path).collect())
    assert got == sorted((r.doc_id is not None, r.doc_id or 0, packed(ids(r.text) + [0])) for r in df.collect())
    none = shared_path(spark, "none")
    T.write_tokens(empty(spark), none)
    assert T.read_tokens(spark, none).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40), st.sampled_from([1, 2, 8, 16]))
def test_windows_are_full(lengths, context):
    seen = {}
    for window, pieces in P.pack_lengths(lengths, context):
        assert sum(n for *_, n in pieces) == window and window & (window - 1) == 0 and window <= context
        for k, at, n in pieces:
            assert n > 0
            seen.setdefault(k, []).append((at, n))
    for k, n in enumerate(lengths):
        at = 0
        for a, m in sorted(seen[k]):
            assert a == at
            at += m
        assert at == n


def test_rests_go_to_the_pool_of_their_context():
    sizes = [w for w, _ in P.pack_lengths([200] * 40)]
    assert sizes[:31] == [256] * 31 and sum(sizes) == 8000  # not into windows of 2048
    got = list(P.pack_lengths([1500, 700, 500, 48]))
    assert got[0] == (2048, [(0, 0, 1500), (2, 0, 500), (3, 0, 48)])  # its gap is filled from the shorter pools
    assert {w for w, _ in P.pack_lengths([3000, 1000, 600, 400, 300, 100, 2048, 250])} >= {2048, 1024}


def test_steps_hold_equal_tokens():
    sizes = [256] * 100 + [2048] * 33 + [512] * 7
    steps = P.deal_steps(sizes, 8 * 2048)
    held = {}
    for s, n in zip(steps, sizes):
        held[s] = held.get(s, 0) + n
    assert len(held) == round(sum(sizes) / (8 * 2048)) and max(held.values()) - min(held.values()) <= 256
    assert P.deal_steps([], 100) == []


def test_context_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        list(P.pack_lengths([3], 6))


def check_pieces(rows, text):
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for i, rs in docs.items():
        x, at = ids(text[i]) + [1], 0
        for r in sorted(rs, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(x)) and r.ids_crc32 == zlib.crc32(packed(x[at:at + r.length]))
            at += r.length
        assert at == len(x)
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rs[0].window and at & (at - 1) == 0 and at <= 2048


def test_packing(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = P.op7(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(text)
    check_pieces(rows, text)
    assert len({r.step for r in rows}) < len({r.sequence_id for r in rows})


def test_packing_of_odd_rows(spark):
    df = frame(spark)
    got = P.pack_documents(df, context=64, keep=df.columns)
    whole = {}
    for r in got.collect():
        assert r.length * 4 == len(r.tokens)
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    want = {}
    for r in df.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + len(ids(r.text)) + 1
    assert whole == want
    assert P.pack_documents(empty(spark)).count() == 0
