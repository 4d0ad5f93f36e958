"""Token files: ids in ascending document order, Re-Pair compressed per shard, with random access by document.

A file set is a Parquet folder of shards. A shard holds whole documents: its grammar rules, the expansion length of
every symbol (from the rules), the compressed symbol string, and where each document starts in it. Rules never cross
documents, so one document is decoded from its own symbols.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleloom.llm.frames import group_count, pack, release, schema_of, shared_path, table, total_bytes, unpack
from sampleloom.llm.registry import query
from sampleloom.llm.tokens import encoder, slices

END_ID = 0
SHARD_TOKENS = 1 << 21
#: A pair is worth a rule from so many places in its shard on.
FREQUENT = 24
_HASH = np.uint64(0x9E3779B97F4A7C15)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each stands there."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    s = np.sort(keys)
    cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    return s[cut[:-1]], np.diff(cut)


def repair(ids: np.ndarray, last: np.ndarray, base: int, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Symbols of a shard, the rules (left, right) of symbols from ``base`` on, and the rule counts after each round.

    ``last`` marks the last id of each document; no pair reaches over it. Each round replaces the most frequent pairs together,
    left to right, until none is frequent. All pairs are counted once. A pair of old symbols only gets rarer, and a pair
    with a new symbol only stands beside a replaced place, so later rounds count what was replaced and what came of it.
    """
    seq, ends = ids.astype(np.int64), np.flatnonzero(last)  # few places, so they are kept as such
    left, right, rounds = [], [], [0]
    symbols = base

    def pairs_at(at: np.ndarray) -> np.ndarray:
        return seq.take(at, mode="clip") << 24 | seq.take(at + 1, mode="clip")  # faster than an index, and always in range

    def near(at: np.ndarray, *steps: int) -> np.ndarray:
        """Places beside some, each once, at which a pair stands; those themselves only with step 0."""
        mark = np.zeros(len(seq) + 1, bool)
        for x in steps:
            mark[at + x] = True  # place -1 is the spare one
        if 0 not in steps:
            mark[at] = False
        return np.flatnonzero(within(mark[:max(0, len(seq) - 1)]))

    def within(mark: np.ndarray) -> np.ndarray:
        mark[ends[ends < len(mark)]] = False
        return mark

    pair, count = _counted((seq[:-1] << 24 | seq[1:])[within(np.ones(max(0, len(seq) - 1), bool))])
    pair, count = pair[count >= frequent], count[count >= frequent]
    while len(pair):
        top = count.max()
        best = np.flatnonzero(count >= max(frequent, top // 8))
        chosen = pair[best][np.argsort(-count[best], kind="stable")]
        bits = max(10, int(len(chosen) * 4).bit_length())
        slot = lambda k: ((k.view(np.uint64) * _HASH) >> np.uint64(64 - bits)).view(np.int64)
        _, first = np.unique(slot(chosen), return_index=True)  # of two pairs in one slot the rarer waits for the next round
        chosen = chosen[np.sort(first)]
        if symbols + len(chosen) >= 1 << 24:
            break
        held, number = np.full(1 << bits, -1), np.zeros(1 << bits, np.int64)
        at = slot(chosen)
        held[at], number[at] = chosen, symbols + np.arange(len(chosen))
        role = np.zeros(symbols, np.uint8)  # 1: opens a pair, 2: closes one
        role[chosen >> 24] = 1
        role[chosen & 0xFFFFFF] |= 2
        role = role.take(seq, mode="clip")
        hit = np.flatnonzero(within((role[:-1] & (role[1:] >> 1)).view(bool)))
        key = pairs_at(hit)
        at = slot(key)
        same = np.flatnonzero(held.take(at, mode="clip") == key)
        hit, made = hit.take(same), number.take(at.take(same))
        run = np.concatenate([[True], hit[1:] != hit[:-1] + 1])  # in a row of overlapping hits every other one counts
        begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        even = np.flatnonzero((np.arange(len(hit)) - begin) & 1 == 0)
        hit, made = hit.take(even), made.take(even)
        count[np.searchsorted(pair, chosen)] -= np.bincount(made - symbols, minlength=len(chosen))
        old, times = _counted(pairs_at(near(hit, -1, 1)))
        where = np.searchsorted(pair, old)
        where[where == len(pair)] = 0
        known = pair[where] == old
        count[where[known]] -= times[known]
        seq[hit] = made
        ends = ends - np.searchsorted(hit + 1, ends, side="right")
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        seq = seq[keep]
        new, times = _counted(pairs_at(near(hit - np.arange(len(hit)), -1, 0)))  # beside the new symbols
        many, stay = times >= frequent, count >= frequent
        pair, count = np.concatenate([pair[stay], new[many]]), np.concatenate([count[stay], times[many]])
        order = np.argsort(pair)
        pair, count = pair[order], count[order]
        left.append(chosen >> 24)
        right.append(chosen & 0xFFFFFF)
        symbols += len(chosen)
        rounds.append(symbols - base)
    none = np.zeros(0, np.int64)
    return seq, np.column_stack([np.concatenate(left or [none]), np.concatenate(right or [none])]), rounds


def encode_shard(docs: list[bytes], base: int) -> bytes:
    """A shard's blob from the ids of its documents."""
    size = np.array([len(d) // 4 for d in docs], np.int64)
    ids = np.frombuffer(b"".join(docs), "<u4")
    last = np.zeros(len(ids), bool)
    last[np.cumsum(size) - 1] = True
    seq, rules, rounds = repair(ids, last, base)
    s = Shard(base, rules, rounds, seq, size)
    return pack(base=base, rules=rules.astype(np.uint32), rounds=rounds, low=(seq & 0xFFFF).astype(np.uint16), high=(seq >> 16).astype(np.uint8),
                size=size.astype(np.uint32), first=s.first.astype(np.uint32))


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, base: int, rules: np.ndarray, rounds: list[int], seq: np.ndarray, size: np.ndarray, first: np.ndarray | None = None):
        self.seq, self.size = seq, size
        self.length = np.ones(base + len(rules), np.int64)
        for a, b in zip(rounds, rounds[1:]):
            self.length[base + a:base + b] = self.length[rules[a:b, 0]] + self.length[rules[a:b, 1]]
        self.at = np.concatenate([np.arange(base), base + np.cumsum(self.length[base:]) - self.length[base:]])
        self.flat = np.concatenate([np.arange(base), np.zeros(int(self.length[base:].sum()), np.int64)])
        for a, b in zip(rounds, rounds[1:]):
            own = np.arange(base + a, base + b)
            self._fill(self.at[own], rules[a:b, 0])
            self._fill(self.at[own] + self.length[rules[a:b, 0]], rules[a:b, 1])
        if first is None:
            done = np.concatenate([[0], np.cumsum(self.length[seq])])
            first = np.searchsorted(done, np.concatenate([[0], np.cumsum(size)]))
        self.first = first

    @classmethod
    def of(cls, blob: bytes) -> "Shard":
        x = unpack(blob)
        return cls(x["base"], x["rules"].astype(np.int64), x["rounds"], x["low"].astype(np.int64) | x["high"].astype(np.int64) << 16,
                   x["size"].astype(np.int64), x["first"].astype(np.int64))

    def _places(self, symbols: np.ndarray) -> np.ndarray:
        n = self.length[symbols]
        return np.repeat(self.at[symbols] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def _fill(self, to: np.ndarray, symbols: np.ndarray) -> None:
        n = self.length[symbols]
        self.flat[np.repeat(to - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = self.flat[self._places(symbols)]

    def documents(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids of documents ``start`` to ``stop`` - 1, from their own symbols."""
        stop = len(self.size) if stop is None else stop
        return self.flat[self._places(self.seq[self.first[start]:self.first[stop]])]


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the ids of all texts, each with ``end_id``, in ascending id order (null first; one id: by text) to ``path``.

    A null or empty text has the end alone; repeated rows are written each; an empty table gives a file set without shards.
    Other columns are not read.
    """
    tok = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = group_count(total_bytes(d, "text"))
    kind = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[d.schema["doc_id"].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        model = encoder(tok)
        base = model.model.get_vocab_size()
        end = np.array([end_id], "<u4").tobytes()
        before, n, ids, blobs = 0, 0, [], []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64()), pa.array([ids], pa.list_(kind)),
                pa.array([encode_shard(blobs, base)], pa.binary())], names=["part", "before", "n_tokens", "doc_ids", "shard"])

        for b in batches:
            keys, at = b.column(0).to_pylist(), 0
            for s in slices(b.column(1).to_pylist()):
                for x in model.encode(s):
                    blobs.append(x + end)
                    ids.append(keys[at])
                    at += 1
                    n += len(blobs[-1]) // 4
                    if n >= shard_tokens:
                        yield shard()
                        before, n, ids, blobs = before + n, 0, [], []
        if blobs:
            yield shard()
        blobs = []
        release()

    ordered = d.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    key = d.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(run, schema_of(f"part int, before long, n_tokens long, doc_ids array<{key}>, shard binary")).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, part, before, n_tokens, tokens`` of every document of a file set; ``before`` counts the ids of its part before it."""
    shards = spark.read.parquet(path)
    key = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                s = Shard.of(b.column(3)[i].as_py())
                before = b.column(1)[i].as_py() + np.cumsum(s.size) - s.size
                doc_ids = b.column(2)[i].values
                step = max(1, len(s.size) // max(1, -(-int(s.size.sum()) // (1 << 19))))
                for a in range(0, len(s.size), step):
                    z = min(len(s.size), a + step)
                    raw = s.documents(a, z).astype("<u4").tobytes()
                    cut = np.concatenate([[0], np.cumsum(s.size[a:z])]) * 4
                    yield pa.RecordBatch.from_arrays([
                        doc_ids.slice(a, z - a), pa.array(np.full(z - a, b.column(0)[i].as_py()), pa.int32()), pa.array(before[a:z], pa.int64()),
                        pa.array(s.size[a:z], pa.int64()), pa.array([raw[j:k] for j, k in zip(cut, cut[1:])], pa.binary())],
                        names=["doc_id", "part", "before", "n_tokens", "tokens"])

    return shards.select("part", "before", "doc_ids", "shard").mapInArrow(
        run, schema_of(f"doc_id {key}, part int, before long, n_tokens long, tokens binary"))


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, first``: the ids before each part, from one row per part."""
    per = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("first"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    read = read_tokens(spark, path).select("doc_id", "part", "before", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
    return read.join(part_starts(spark, path), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
