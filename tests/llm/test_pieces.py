import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from sampleloom.llm import pieces as P

from .cases import SF, empty, frame, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = SentencePieceProcessor(model_file=PATH)
OWN = P.pieces(PATH)


def ids(blob):
    return np.frombuffer(blob, "<u4").tolist()


def test_library_on_odd_texts():
    odd = [t or "" for t in texts()] + ["aaa▁b ▁▁ c", "ab\0cd e\0", "x" * 900, "日本語テスト " * 40, "a" + " " * 20 + "b", "😀😀 z", "<s> <0x41>"]
    for t, got in zip(odd, OWN.encode(odd)):
        assert ids(got) == SP.encode(t)
        assert OWN.decode(np.array(ids(got), np.int64)) == SP.decode(SP.encode(t))


@settings(max_examples=120, deadline=None)
@given(st.text(st.sampled_from(" abtheingo\n▁é日😀"), max_size=40))
def test_library_on_any_text(text):
    assert ids(OWN.encode([text])[0]) == SP.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 20))
def test_suffix_array(codes, depth):
    x = np.array(codes)
    order = P.suffix_array(x, depth).tolist()
    cut = [codes[i:i + depth] for i in order]
    assert sorted(order) == list(range(len(codes))) and cut == sorted(cut)


def test_query_and_odd_rows(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    import zlib
    from array import array

    for r in P.op6(spark, SF).collect():
        x = SP.encode(text[r.doc_id])
        assert r.n_pieces == len(x) and r.ids_crc32 == zlib.crc32(array("I", x).tobytes()) and r.round_trip
    df = frame(spark)
    rows = P.decode_pieces(P.encode_pieces(df)).collect()
    assert len(rows) == df.count() and all(r.decoded == SP.decode(SP.encode(r.text or "")) for r in rows)
    assert P.encode_pieces(empty(spark)).count() == 0
