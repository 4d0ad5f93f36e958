"""Packing of token sequences into full windows of four context sizes.

One pass without a shuffle: each block of documents is packed by itself. Documents are cut into full windows of the longest size;
what is left of each is routed to the pool of the shortest context that holds it. The pools are packed from the longest to the
shortest: a window opens with the longest rest of its pool, its gap takes the longest rests that fit, from its own pool and the shorter
ones, and is closed by a cut of the shortest rest, whose remainder goes to the pool of its new length. The last tokens of a block go to
shorter windows that they fill exactly, so nothing is padded. The windows of a block are dealt to steps of equal token sums.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.llm.frames import release, schema_of, table
from sampleloom.llm.registry import query
from sampleloom.llm.tokens import encoder, slices

CONTEXT = 2048
END_ID = 1
#: Sequences of one training step hold about so many full windows together.
STEP_WINDOWS = 64
#: Context sizes: 2048, 1024, 512 and 256 tokens.
TIERS = 4


def tiers_of(context: int) -> list[int]:
    """The context sizes, longest first: ``context``, its half, quarter and eighth."""
    return [context >> s for s in range(TIERS) if context >> s]


class Pools:
    """Rests by tier: a rest waits in the pool of the shortest context that holds it, there by its exact length."""

    def __init__(self, tiers: list[int]) -> None:
        self.tiers = tiers
        self.rests: dict[int, list[tuple[int, int]]] = {}
        self.there = dict.fromkeys(tiers, 0)  # of each tier: bit n is set where a rest of n tokens waits

    def tier(self, n: int) -> int:
        return next((t for t in reversed(self.tiers) if n <= t), self.tiers[0])

    def put(self, k: int, at: int, n: int) -> None:
        self.rests.setdefault(n, []).append((k, at))
        self.there[self.tier(n)] |= 1 << n

    def take(self, n: int) -> tuple[int, int]:
        got = self.rests[n].pop()
        if not self.rests[n]:
            self.there[self.tier(n)] &= ~(1 << n)
        return got

    def longest(self, most: int) -> int:
        """Length of the longest rest of at most ``most`` tokens, from the pool of the longest tier that has one; 0 if none has."""
        for t in self.tiers:
            fits = self.there[t] & ((2 << most) - 1)
            if fits:
                return fits.bit_length() - 1
        return 0

    def shortest(self) -> int:
        """Length of the shortest rest of all pools, 0 if they are empty."""
        bits = next((self.there[t] for t in reversed(self.tiers) if self.there[t]), 0)
        return (bits & -bits).bit_length() - 1 if bits else 0


def pack_lengths(lengths: list[int], context: int = CONTEXT) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(window size, [(document number, start, length)]) of documents with at least one token each.

    ``context`` is a power of two, and so is every window size; every window is full."""
    if context < 1 or context & (context - 1):
        raise ValueError("the context size is a power of two")
    pools = Pools(tiers_of(context))
    for k, n in enumerate(lengths):
        full = n - n % context
        for at in range(0, full, context):
            yield context, [(k, at, context)]
        if n > full:
            pools.put(k, full, n - full)

    for tier in pools.tiers:
        while pools.there[tier] or (tier == pools.tiers[-1] and pools.shortest()):
            window, gap = [], tier
            while gap:
                n = pools.longest(gap)
                if n:
                    window.append((*pools.take(n), n))
                    gap -= n
                    continue
                n = pools.shortest()
                if not n:
                    break
                k, at = pools.take(n)  # all rests are longer: cut the shortest
                window.append((k, at, gap))
                pools.put(k, at + gap, n - gap)
                gap = 0
            if not gap:
                yield tier, window
            else:
                yield from short_windows(window, tier - gap)


def short_windows(window: list[tuple[int, int, int]], used: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """The last ``used`` tokens in windows of falling powers of two that they fill."""
    i = 0
    for size in (1 << b for b in range(used.bit_length() - 1, -1, -1)):
        if used & size:
            short, room = [], size
            while room:
                k, at, n = window[i]
                cut = min(n, room)
                short.append((k, at, cut))
                room -= cut
                if cut == n:
                    i += 1
                else:
                    window[i] = (k, at + cut, n - cut)
            yield size, short


def deal_steps(sizes: list[int], step_tokens: int) -> list[int]:
    """Step of each window: the windows are dealt, longest first, to the step that holds the fewest tokens, so two steps differ by
    one window at most."""
    steps = max(1, round(sum(sizes) / step_tokens))
    loads = [(0, s) for s in range(steps)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, s = loads[0]
        out[i] = s
        heapq.heapreplace(loads, (load + sizes[i], s))
    return out


PIECES = "start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, window int, step long"


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT, end_id: int = END_ID,
                   tokenizer: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: ``keep`` (default: the id) and the columns of ``PIECES``; ``tokens`` are little-endian unsigned 32-bit ids.

    A document is its ids and ``end_id``, so a null or empty text has one token. Every id is in one piece, pieces fill their
    sequence without gaps, and a sequence holds exactly ``window`` tokens, a power of two up to ``context``. ``step`` groups
    sequences of about equal token sums. Repeated rows are packed each; an empty table gives an empty result. Kept columns
    with names of new ones are replaced.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    new = schema_of(PIECES)
    kept = [c for c in (keep if keep is not None else [id_col]) if c not in new.names]
    out = T.StructType([docs.schema[c] for c in kept] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        seq, steps = 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            ids = [x + end for s in slices(b.column(b.num_columns - 1).to_pylist()) for x in encoder(path).encode(s)]
            rows = []
            windows = list(pack_lengths([len(x) // 4 for x in ids], context))
            dealt = deal_steps([window for window, _ in windows], STEP_WINDOWS * context)
            for (window, pieces), step in zip(windows, dealt):
                at = 0
                for k, start, n in pieces:
                    rows.append((k, start, n, ids[k][4 * start:4 * (start + n)], len(ids[k]) // 4, base + seq, at, window,
                                 base + steps + step))
                    at += n
                seq += 1
            steps += max(dealt, default=-1) + 1
            for i in range(0, len(rows), 1 << 13):
                some = rows[i:i + (1 << 13)]
                pick = pa.array([r[0] for r in some], pa.int64())
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([b.column(j).take(pick) for j in range(len(kept))] +
                                                 [pa.array([r[j + 1] for r in some], t) for j, t in enumerate(kinds)], names=out.names)
        release()

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("__text")).mapInArrow(run, out)


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents in their sequences."""
    p = pack_documents(docs)
    return p.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step")
