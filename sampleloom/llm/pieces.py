"""SentencePiece encoding and decoding through suffix arrays.

New words of a batch are laid end to end and indexed by a suffix array over as many characters as the longest piece
has. Every piece finds its range of occurrences by binary search; the occurrences are the edges from a place over a
length, stored by place. The segmentation is then relaxed from single characters: in each round every word takes the
edge of best score that joins two of its neighbouring symbols, the leftmost of equals, until none is left - the order
in which the model's own merges happen. Characters without a piece become their UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import add_columns, table
from sampleloom.llm.registry import query
from sampleloom.llm.tokens import slices

SPACE = "▁"
#: Words remembered in a worker process; at that number the older half is only kept as far as it is used again.
REMEMBERED = 250_000
#: Characters indexed at a time.
INDEXED = 200_000
#: Longer words are relaxed with a queue of their own instead of in common rounds.
LONG = 200
MARKS = ".,;:!?*#$%&|"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the ``depth`` (or more) characters from there on, by prefix doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    rank, have, n = rank.astype(np.int64) + 1, 1, len(codes)
    order = np.argsort(rank, kind="stable")
    while have < depth:
        after = np.zeros(n, np.int64)
        after[:max(0, n - have)] = rank[have:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank[order] = np.cumsum(np.concatenate([[1], (s[1:] != s[:-1]).astype(np.int64)]))
        have *= 2
    return order


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) for i in range(n)]
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.single = {x: i for i, x in enumerate(names) if plain[i] and len(x) == 1}
        self.byte = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.ids = np.array([i for i in range(n) if plain[i] and len(names[i]) > 1])
        self.size = np.array([len(names[i]) for i in self.ids])
        self.depth = int(self.size.max())
        self.codes = np.zeros((len(self.ids), self.depth), np.int64)
        for r, i in enumerate(self.ids):
            self.codes[r, :self.size[r]] = [ord(c) for c in names[i]]
        # order of merges: rank 0 is the best score; equal scores share a rank, and there the left one goes first
        levels, inv = np.unique(-self.score, return_inverse=True)
        self.rank, self.levels = inv.astype(np.int64), len(levels)
        self.bytes = [bytes([int(x[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                      else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]
        # marks that no piece joins to a letter or digit before them: a word is cut there, and merges never cross the cut
        both = {names[i][k:k + 2] for i in self.ids for k in range(len(names[i]) - 1)}
        self.marks = "".join(c for c in MARKS if not any(x[1] == c and x[0].isalnum() for x in both))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def edges(self, text: np.ndarray) -> np.ndarray:
        """Table of places and lengths: the piece of that length that starts there, or -1."""
        order = suffix_array(text, self.depth)
        padded = np.concatenate([text, np.full(self.depth, -1)])
        out = np.full((len(text), self.depth), -1, np.int32)

        def bound(upper: bool) -> np.ndarray:
            lo, hi = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(text))
            while (lo < hi).any():
                mid = np.minimum((lo + hi) >> 1, len(text) - 1)
                at = order[mid]
                sign, open_ = np.zeros(len(at), np.int8), np.ones(len(at), bool)
                for d in range(self.depth):
                    live = np.flatnonzero(open_ & (d < self.size))
                    if not len(live):
                        break
                    diff = np.sign(padded[at[live] + d] - self.codes[live, d]).astype(np.int8)
                    sign[live] = diff
                    open_[live[diff != 0]] = False
                right = (sign < 0) | (upper & (sign == 0))
                move = lo < hi
                lo, hi = np.where(move & right, mid + 1, lo), np.where(move & ~right, mid, hi)
            return lo

        first, last = bound(False), bound(True)
        n = last - first
        piece = np.repeat(np.arange(len(self.ids)), n)
        place = order[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        out[place, self.size[piece] - 1] = self.ids[piece]
        return out

    def _queue(self, start: int, n: int, table_: np.ndarray) -> list[tuple[int, int]]:
        """Symbols (start, length) of one long word."""
        size, nxt, prev = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and size[i] + size[j] <= self.depth:
                p = table_[start + i, size[i] + size[j] - 1]
                if p >= 0:
                    heapq.heappush(heap, (int(self.rank[p]), i, size[i], size[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if size[i] != a or j >= n or size[j] != b:
                continue
            size[i], size[j], nxt[i] = a + b, 0, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return [(start + i, s) for i, s in enumerate(size) if s]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of words that start with the space mark, as little-endian unsigned 32-bit integers."""
        text = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        table_ = self.edges(text)
        size = np.array([len(w) for w in words])
        first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        symbols: list[tuple[np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(size > LONG):
            pairs = np.array(self._queue(int(first[k]), int(size[k]), table_))
            symbols.append((pairs[:, 0], pairs[:, 1]))
        use = np.flatnonzero(size <= LONG)
        n = size[use]
        word = np.repeat(use, n)
        start = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[use], n)
        long_ = np.ones(len(word), np.int64)
        while len(word):
            both = np.full(len(word), -1, np.int64)
            total = long_[:-1] + long_[1:]
            pair = np.flatnonzero((word[1:] == word[:-1]) & (total <= self.depth))
            both[pair] = table_[start[pair], total[pair] - 1]
            key = np.where(both >= 0, self.rank[both] * len(word) + np.arange(len(word)), self.levels * (len(word) + 1))
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(key, head)
            live = best < self.levels * len(word)
            at = best[live] % len(word)
            done = ~np.repeat(live, np.diff(np.append(head, len(word))))
            symbols.append((start[done], long_[done]))
            long_[at] += long_[at + 1]
            keep = ~done
            keep[at + 1] = False
            word, start, long_ = word[keep], start[keep], long_[keep]
        start, long_ = (np.concatenate(x) for x in zip(*symbols)) if symbols else (np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(start)
        start, long_ = start[order], long_[order]
        ids = table_[start, long_ - 1].astype(np.int64)
        out: list[list[int]] = [[] for _ in words]
        of = np.searchsorted(first, start, "right") - 1
        for w, s, n_, i in zip(of.tolist(), start.tolist(), long_.tolist(), ids.tolist()):
            if n_ > 1:
                out[w].append(i)
                continue
            c = chr(text[s])
            got = self.single.get(c)
            if got is not None:
                out[w].append(got)
            elif self.byte:
                out[w] += [self.byte[b] for b in c.encode("utf-8", "surrogatepass")]
            else:
                out[w].append(self.unknown)
        return [array("I", x).tobytes() for x in out]

    def encode(self, texts: list[str]) -> list[bytes]:
        cuts: list[list[str]] = []
        new: set[str] = set()
        for t in texts:
            if not t:
                words = []
            elif "  " in t or SPACE in t or t[0] == " " or t[-1] == " " or "\0" in t:
                words = [w[1:] for w in _WORD.findall(SPACE + t.replace(" ", SPACE))]
            else:
                words = t.split(" ")
            cuts.append(words)
            new.update(words)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        new.difference_update(self.known)
        again = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        new -= again
        some, n = [], 0
        for w in sorted(new):
            some.append(w)
            n += len(w) + 2
            if n >= INDEXED:
                self._learn(some)
                some, n = [], 0
        self._learn(some)
        get = self.known.__getitem__
        return [b"".join(map(get, c)) for c in cuts]

    def _learn(self, words: list[str]) -> None:
        if words:  # a NUL would end a word of the index: such words are done one by one around it
            odd = [w for w in words if "\0" in w]
            even = [w for w in words if "\0" not in w]
            bare = {w: b for w in even if (b := w.rstrip(self.marks)) and b != w and b[-1].isalnum()}
            heads = sorted({*bare.values(), *(w for w in even if w not in bare)} - self.known.keys())
            tails = sorted({w[len(b):] for w, b in bare.items()})
            if even:
                done = self.segment([SPACE + w for w in heads] + tails)
                self.known.update(zip(heads, done))
                ends = dict(zip(tails, done[len(heads):]))
                self.known.update((w, self.known[b] + ends[w[len(b):]]) for w, b in bare.items())
            nul = np.array([self.byte.get(0, self.unknown)], "<u4").tobytes()
            for w in odd:
                parts = (SPACE + w).split("\0")
                got = iter(self.segment([p for p in parts if p]))
                self.known[w] = nul.join(next(got) if p else b"" for p in parts)

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(docs: DataFrame, text_col: str = "text", model: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``n_pieces`` and ``piece_ids`` (little-endian unsigned 32-bit), which replace columns of those names.

    The ids are those of the model's own encoder without added marks. Null and empty texts have no pieces; repeated rows are
    encoded each; an empty table gives an empty result."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def make(b: pa.RecordBatch) -> dict:
        ids = [x for s in slices(b.column(text_col).to_pylist(), 1 << 20) for x in pieces(path).encode(s)]
        return {"n_pieces": [len(x) // 4 for x in ids], "piece_ids": ids}

    return add_columns(docs, [text_col], "n_pieces long, piece_ids binary", make, keep)


def decode_pieces(df: DataFrame, model: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` with ``decoded``, the text of ``piece_ids``; null ids decode to the empty text. The space mark becomes a space."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def make(b: pa.RecordBatch) -> dict:
        return {"decoded": [pieces(path).decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in b.column("piece_ids")]}

    return add_columns(df, ["piece_ids"], "decoded string", make, keep)


@query("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode_pieces(encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text")))
    same = F.col("decoded") == F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    return done.select("doc_id", "n_pieces", F.crc32("piece_ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))
