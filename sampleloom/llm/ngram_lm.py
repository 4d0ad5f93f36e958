"""Language-model scores from an Elias-Fano n-gram trie that is counted, smoothed and asked in shards.

Documents are grouped; each group sends what it counted and wants to know, and gets answers in the order it asked:

1. words: a shard of the word hashes adds up training counts and returns them, with its share of the corpus totals;
2. pairs: a shard of the contexts builds the trie of its words after words and answers from it. A context with more than
   a small share of all tokens is dealt over all shards by its successors; its count is known from step 1.

A shard is one file of monotone sequences - contexts, pointers, successors - in Elias-Fano form with one byte for each
smoothed probability, mapped into memory while it is asked and removed afterwards. A pair is found by its context, the
pointers of that context, and a successor search relative to it.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import fold_of, group_count, grouped, light, pack, schema_of, table, total_bytes, unpack
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import Chunk, chunks, mix

#: Weight of the unigram distribution in each context, in tokens.
MU = 100.0
_U = np.uint64
END = mix(np.array([0x1F83D9ABFB41BD6B], _U))[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SUCC = 40


# ---- Elias-Fano sequences

@dataclass
class EliasFano:
    """A sorted sequence: the lower ``width`` bits of each value side by side, the upper parts as a unary bit vector with a
    count of ones before each 64-bit word."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> "EliasFano":
        n = len(values)
        width = min(56, max(0, (universe // max(1, n)).bit_length() - 1))  # at most: a value lies in eight bytes
        values = values.astype(_U)
        low = values & _U((1 << width) - 1)
        bits = np.zeros((n, width), np.uint8)
        for k in range(width):
            bits[:, k] = (low >> _U(k)) & _U(1)
        up = (values >> _U(width)).astype(np.int64) + np.arange(n)
        size = -(-int((universe >> width) + n + 2) // 64) * 64
        unary = np.zeros(size, np.uint8)
        unary[up] = 1
        words = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(unary.reshape(-1, 64).sum(1))]).astype(np.uint32)
        return cls(n, width, np.concatenate([np.packbits(bits.ravel(), bitorder="little"), np.zeros(8, np.uint8)]), words, ones)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), _U)
        at = i * self.width
        window = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return (window[at >> 3] >> (at & 7).astype(_U)) & _U((1 << self.width) - 1)

    def before_zero(self, k: np.ndarray) -> np.ndarray:
        """How many values have an upper part of ``k`` or less: the ones before the k-th zero (from 0)."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(zeros, k, "right") - 1
        out = np.empty(len(k), np.int64)
        for a in range(0, len(k), 1 << 16):
            w = word[a:a + (1 << 16)]
            bits = np.unpackbits(np.ascontiguousarray(self.high[w]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            seen = np.cumsum(bits == 0, axis=1, dtype=np.int16)
            rank = (k[a:a + (1 << 16)] - zeros[w] + 1)[:, None]
            out[a:a + (1 << 16)] = w * 64 + (seen >= rank).argmax(1) - k[a:a + (1 << 16)]
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each value, or ``n`` where it is not there."""
        up = (x >> _U(self.width)).astype(np.int64)
        hi = self.before_zero(up)
        lo = np.where(up > 0, self.before_zero(np.maximum(up - 1, 0)), 0)
        want, end = x & _U((1 << self.width) - 1), hi
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            less = (self.lows(np.minimum(mid, self.n - 1)) < want) & (lo < hi)
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, np.where(lo < hi, mid, hi))
        hit = lo < end
        hit[hit] &= self.lows(lo[hit]) == want[hit]
        return np.where(hit, lo, self.n)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``: select the i-th one."""
        word = np.searchsorted(self.ones, i, "right") - 1
        out = np.empty(len(i), np.int64)
        for a in range(0, len(i), 1 << 16):
            w = word[a:a + (1 << 16)]
            bits = np.unpackbits(np.ascontiguousarray(self.high[w]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            seen = np.cumsum(bits, axis=1, dtype=np.int16)
            rank = (i[a:a + (1 << 16)] - self.ones[w] + 1)[:, None]
            out[a:a + (1 << 16)] = w * 64 + (seen >= rank).argmax(1) - i[a:a + (1 << 16)]
        return (out.astype(_U) << _U(self.width)) | self.lows(i)


def quantised(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code from 1 to 255 for each probability, and the probability of each code; code 0 is none."""
    book = np.zeros(256)
    if not len(p):
        return np.zeros(0, np.uint8), book
    x = np.log(p)
    lo, hi = x.min(), x.max()
    code = 1 + np.minimum(254, ((x - lo) / max(hi - lo, 1e-12) * 255).astype(np.int64))
    count = np.bincount(code, minlength=256)
    total = np.bincount(code, weights=p, minlength=256)
    book[count > 0] = total[count > 0] / count[count > 0]
    return code.astype(np.uint8), book


class Trie:
    """Contexts and their successors in one mapped file."""

    def __init__(self, context: np.ndarray, pointer: np.ndarray, succ: np.ndarray, prob: np.ndarray):
        code, self.book = quantised(prob)
        rank = np.repeat(np.arange(len(context), dtype=_U), np.diff(pointer))
        levels = [EliasFano.of(context >> _U(16), 1 << 48), EliasFano.of(pointer, int(pointer[-1]) + 1),
                  EliasFano.of((rank << _U(_SUCC)) | succ, max(1, len(context)) << _SUCC)]
        arrays = [a for e in levels for a in (e.low, e.high, e.ones)] + [code]
        with tempfile.TemporaryFile(prefix="trie-") as f:
            at = []
            for a in arrays:
                f.write(b"\0" * (-f.tell() % 8))
                at.append(f.tell())
                f.write(a.tobytes())
            f.write(b"\0" * 8)
            f.flush()
            self.map = mmap.mmap(f.fileno(), os.fstat(f.fileno()).st_size, access=mmap.ACCESS_READ)
        view = [np.frombuffer(self.map, a.dtype, len(a), o) for a, o in zip(arrays, at)]
        self.contexts, self.pointers, self.successors = [
            EliasFano(e.n, e.width, *view[3 * k:3 * k + 3]) for k, e in enumerate(levels)]
        self.code = np.append(view[-1], np.uint8(0)) if len(code) else np.zeros(1, np.uint8)

    def ask(self, context: np.ndarray, size: np.ndarray, succ: np.ndarray) -> np.ndarray:
        """Codes of pairs given as contexts with numbers of successors; 0 where the pair was not seen."""
        if not self.contexts.n:
            return np.zeros(len(succ), np.uint8)
        i = self.contexts.find(context >> _U(16))
        known = i < self.contexts.n
        none = np.zeros(len(i), bool)
        if known.any():  # a context without training successors has an empty range
            k = i[known]
            none[known] = self.pointers.get(k) == self.pointers.get(k + 1)
        use = np.repeat(known & ~none, size)
        out = np.zeros(len(succ), np.uint8)
        rank = np.repeat(i, size)[use].astype(_U)
        out[use] = self.code[self.successors.find((rank << _U(_SUCC)) | succ[use])]
        return out


# ---- groups of documents

def tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts of a group, each text with its end, and the text number of each token."""
    tok, doc = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for c in chunks(column):
        c = Chunk(c.first, _LOWER[c.data], c.off)
        of = c.words[2]
        count = np.bincount(of, minlength=c.n) + 1
        out = np.full(len(of) + c.n, END, _U)
        out[np.arange(len(of)) + of] = c.word_hash
        tok.append(out)
        doc.append(np.repeat(np.arange(c.n) + c.first, count))
    return np.concatenate(tok), np.concatenate(doc)


def _cuts(keys: np.ndarray, parts: int) -> list[int]:
    inner = np.searchsorted(keys, np.array([b * (1 << 64) // parts for b in range(1, parts)], _U))
    return [0, *inner.tolist(), len(keys)]


def _rows(rows: list[tuple], names: str) -> pa.Table:
    kinds = {"part": pa.int32(), "gid": pa.int32(), "kind": pa.int32(), "blob": pa.binary()}
    return pa.table({k: pa.array([r[i] for r in rows], kinds[k]) for i, k in enumerate(names.split())})


def ask_words(t: pa.Table, parts: int) -> pa.Table:
    """For each shard the distinct words of a group with their training counts; every shard is asked."""
    tok, doc = tokens(t["text"])
    train = ~np.asarray(t["held_out"])
    keys, inv = np.unique(tok, return_inverse=True)
    n = np.bincount(inv, weights=train[doc], minlength=len(keys)).astype(np.int64)
    cut = _cuts(keys, parts)
    gid = t["gid"][0].as_py()
    return _rows([(b, gid, pack(key=keys[i:j], n=n[i:j])) for b, (i, j) in enumerate(zip(cut, cut[1:]))], "part gid blob")


def answer_words(t: pa.Table) -> pa.Table:
    """Corpus counts in the order asked, and the shard's numbers of training tokens and distinct words."""
    asked = [unpack(b.as_py()) for b in t["blob"]]
    _, inv = np.unique(np.concatenate([a["key"] for a in asked]), return_inverse=True)
    total = np.bincount(inv, weights=np.concatenate([a["n"] for a in asked])).astype(np.int64)
    cut = np.cumsum([len(a["key"]) for a in asked])[:-1]
    all_, kinds = int(total.sum()), int((total > 0).sum())
    part = t["part"][0].as_py()
    return _rows([(gid, pack(part=part, n=n, tokens=all_, kinds=kinds)) for gid, n in
                  zip(t["gid"].to_pylist(), np.split(total[inv], cut))], "gid blob")


def _counts(blobs: list[dict]) -> tuple[np.ndarray, int, int]:
    blobs = sorted(blobs, key=lambda b: b["part"])
    return np.concatenate([b["n"] for b in blobs]), sum(b["tokens"] for b in blobs), sum(b["kinds"] for b in blobs)


def _pairs(tok: np.ndarray, doc: np.ndarray, inv: np.ndarray, end: int) -> np.ndarray:
    """Context and word numbers of each token in one integer; a text starts in the context of an end."""
    prev = np.empty(len(inv), np.int64)
    prev[1:] = inv[:-1]
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    prev[first] = end
    return prev << 32 | inv


def _plan(keys: np.ndarray, pair: np.ndarray, n: np.ndarray, total: int, parts: int) -> np.ndarray:
    """Shard of each distinct pair: by context, or by context and successor where the context is frequent."""
    h, w = keys[pair >> 32], keys[pair & 0xFFFFFFFF]
    hot = n[pair >> 32] * 4 * parts > total
    return ((np.where(hot, mix(h + w * _U(5)), h) >> _U(32)) * _U(parts) >> _U(32)).astype(np.int32)


def ask_pairs(t: pa.Table, got: pa.Table, parts: int) -> pa.Table:
    """For each shard the distinct pairs of a group with training counts and the corpus counts of their contexts."""
    blobs = [unpack(b.as_py()) for b in got["blob"]]
    n, total, kinds = _counts(blobs)
    tok, doc = tokens(t["text"])
    train = ~np.asarray(t["held_out"])
    keys, inv = np.unique(tok, return_inverse=True)
    pair, at = np.unique(_pairs(tok, doc, inv, int(np.searchsorted(keys, END))), return_inverse=True)
    count = np.bincount(at, weights=train[doc], minlength=len(pair)).astype(np.int64)
    shard = _plan(keys, pair, n, total, parts)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(parts + 1))
    gid = t["gid"][0].as_py()
    out = [(gid % parts, gid, 1, pack(n=n, tokens=total, kinds=kinds))]
    for p in range(parts):
        mine = order[cut[p]:cut[p + 1]]
        if len(mine):
            ctx, size = np.unique(pair[mine] >> 32, return_counts=True)
            succ = keys[pair[mine] & 0xFFFFFFFF] >> _U(64 - _SUCC)
            out.append((p, gid, 0, pack(context=keys[ctx], seen=n[ctx], size=size.astype(np.uint32), low=(succ & _U(0xFFFFFFFF)).astype(np.uint32),
                                        high=(succ >> _U(32)).astype(np.uint8), n=count[mine].astype(np.uint32))))
    return _rows(out, "part gid kind blob")


def answer_pairs(t: pa.Table, mu: float) -> pa.Table:
    """Builds a shard's trie and answers each group from it; what groups sent for themselves passes through."""
    out, asked = [], []
    for gid, kind, blob in zip(t["gid"].to_pylist(), t["kind"].to_pylist(), t["blob"]):
        if kind == 1:
            out.append((gid, 1, blob.as_py()))
        else:
            x = unpack(blob.as_py())
            x["succ"] = x.pop("low").astype(_U) | x.pop("high").astype(_U) << _U(32)
            asked.append((gid, x))
    if asked:
        context, first, inv = np.unique(np.concatenate([x["context"] for _, x in asked]), return_index=True, return_inverse=True)
        seen = np.concatenate([x["seen"] for _, x in asked])[first]
        rank = np.repeat(inv, np.concatenate([x["size"] for _, x in asked]))
        key, at = np.unique(rank.astype(_U) << _U(_SUCC) | np.concatenate([x["succ"] for _, x in asked]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([x["n"] for _, x in asked]))
        key, n = key[n > 0], n[n > 0]
        of = (key >> _U(_SUCC)).astype(np.int64)
        pointer = np.searchsorted(of, np.arange(len(context) + 1))
        trie = Trie(context, pointer, key & _U((1 << _SUCC) - 1), n / (seen[of] + mu))
        part = t["part"][0].as_py()
        out += [(gid, 0, pack(part=part, code=trie.ask(x["context"], x["size"], x["succ"]), book=trie.book)) for gid, x in asked]
    return _rows(out, "gid kind blob")


def score_group(t: pa.Table, got: pa.Table, parts: int, mu: float) -> pa.Table:
    """Base and model scores of a group's documents from the answers to its two questions."""
    own, codes = None, []
    for kind, blob in zip(got["kind"].to_pylist(), got["blob"]):
        if kind == 1:
            own = unpack(blob.as_py())
        else:
            codes.append(unpack(blob.as_py()))
    n, total, kinds = own["n"], own["tokens"], own["kinds"]
    tok, doc = tokens(t["text"])
    keys, inv = np.unique(tok, return_inverse=True)
    pair, at = np.unique(_pairs(tok, doc, inv, int(np.searchsorted(keys, END))), return_inverse=True)
    order = np.argsort(_plan(keys, pair, n, total, parts), kind="stable")
    alpha = np.empty(len(pair))
    codes.sort(key=lambda c: c["part"])
    alpha[order] = np.concatenate([c["book"][c["code"]] for c in codes])
    one = (n + 1) / (total + kinds + 1)
    p = alpha + mu / (n[pair >> 32] + mu) * one[pair & 0xFFFFFFFF]
    rows = len(t)
    per = lambda x: np.bincount(doc, weights=x, minlength=rows)
    return pa.table({
        "doc_id": t["doc_id"], "held_out": t["held_out"], "n_tokens": pa.array(np.bincount(doc, minlength=rows), pa.int64()),
        "n_known": pa.array(per(n[inv] > 0).astype(np.int64)), "train_tokens": pa.array(np.full(rows, total), pa.int64()),
        "base_score": pa.array(per(np.log10(one)[inv])), "score": pa.array(per(np.log10(p)[at]))})


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", mu: float = MU, groups: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    The model learns from all rows for which the column ``held_out`` is not true. A null text is an empty one and has its
    end alone as token; repeated rows are counted and scored each; an empty table gives an empty result, and with nothing to
    learn from every token has the floor probability. Other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    F.coalesce(held_out, F.lit(False)).alias("held_out"))
    parts = groups or group_count(total_bytes(d, "text"))
    d = grouped(d, "doc_id", parts)
    words = d.groupBy("gid").applyInArrow(light(lambda t: ask_words(t, parts)), schema_of("part int, gid int, blob binary"))
    counted = words.groupBy("part").applyInArrow(light(answer_words), schema_of("gid int, blob binary"))
    asked = d.groupBy("gid").cogroup(counted.groupBy("gid")).applyInArrow(
        light(lambda a, b: ask_pairs(a, b, parts)), schema_of("part int, gid int, kind int, blob binary"))
    told = asked.groupBy("part").applyInArrow(light(lambda t: answer_pairs(t, mu)), schema_of("gid int, kind int, blob binary"))
    out = (f"doc_id {d.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")
    return d.groupBy("gid").cogroup(told.groupBy("gid")).applyInArrow(light(lambda a, b: score_group(a, b, parts, mu)), schema_of(out))


@query("op10_ngram_lm")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), fold_of("doc_id", 7) == 2)
