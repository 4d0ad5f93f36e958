"""Token ids of whole texts with the tokenizers library, at the cost of the distinct words.

A byte-level tokenizer splits a text before a single space or line feed between other characters, whatever follows, and
between letters and the marks after them. So a text is cut there, each distinct piece is encoded once in a process -
many pieces in one call, since a space or line feed opens each of them and nothing else - and ids are joined. Texts with
other runs of white space are encoded in one go.
"""

from __future__ import annotations

import os
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces remembered in a worker process; at that number the older half is only kept as far as it is used again.
REMEMBERED = 500_000
_MARKS = ".,;:!?*#$%&|"
#: Marks behind a word that are cut off for all words of a call at once.
MOST_MARKS = 3


def _pieces(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct pieces, and for each word the numbers of its two: letters and the marks after them, or the word and no piece (the
    number behind the last). The encoder cuts other words of that kind itself."""
    bare = pc.ascii_rtrim(words, characters=_MARKS)
    over = pc.subtract(pc.binary_length(words), pc.binary_length(bare)).to_numpy()
    over = np.where(pc.ascii_is_alpha(bare).to_numpy(zero_copy_only=False) & (over <= MOST_MARKS), over, 0)
    heads = pc.if_else(pa.array(over > 0), bare, words).dictionary_encode()
    pieces = heads.dictionary.to_numpy(zero_copy_only=False).tolist()
    tails = np.full(len(words), -1)
    for n in range(1, MOST_MARKS + 1):
        at = np.flatnonzero(over == n)
        if len(at):
            marks = pc.utf8_slice_codeunits(words.take(pa.array(at)), -n).dictionary_encode()
            tails[at] = len(pieces) + np.asarray(marks.indices)
            pieces += ["\0" + x for x in marks.dictionary.to_pylist()]
    tails[tails < 0] = len(pieces)
    return pieces, np.column_stack([np.asarray(heads.indices), tails]).ravel()


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        size = self.model.get_vocab_size()
        names = [self.model.id_to_token(i) or "" for i in range(size)]
        self.opens = {" ": np.array([x[:1] == "\u0120" for x in names]), "\n": np.array([x[:1] == "\u010a" for x in names])}
        self.known: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _many(self, bodies: list[str], opener: str) -> list[bytes]:
        """Ids of pieces that ``opener`` opens and in which no white space stands."""
        out = []
        for i in range(0, len(bodies), 4096):
            some = bodies[i:i + 4096]
            ids = np.array(self.model.encode_batch_fast([opener + opener.join(some)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.opens[opener][ids])
            if len(cut) != len(some):
                out += self._ids([opener + x for x in some])
                continue
            raw, at = ids.tobytes(), [*(4 * cut).tolist(), 4 * len(ids)]
            out += [raw[a:b] for a, b in zip(at, at[1:])]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Remembers pieces: a plain one follows a space, others name what is before them (a line feed, or NUL for nothing)."""
        known, older = self.known, self.older
        groups: dict[str, list[str]] = {" ": [], "\n": [], "\0": []}
        split: list[tuple[str, str, str]] = []
        seen: set[str] = set()

        def want(w: str) -> None:
            if w in known or w in seen:
                return
            got = older.get(w)
            if got is not None:
                known[w] = got
                return
            seen.add(w)
            before = w[:1] if w[:1] in ("\n", "\0") else " "
            body = w if before == " " else w[1:]
            if body.split() != [body]:  # empty, or white space inside or at an edge
                if not body or body[0].isspace() or body[-1].isspace() or "\0" in body:
                    known[w] = False
                    return
                known[w] = self._ids([body if before == "\0" else before + body])[0]
                return
            bare = body.rstrip(_MARKS)
            if len(bare) < len(body) and bare.isalpha():
                head, tail = (bare if before == " " else before + bare), "\0" + body[len(bare):]
                split.append((w, head, tail))
                want(head)
                want(tail)
            else:
                groups[before].append(body)

        plain: set[str] = set()  # letters only, or what is left of a piece without the marks at its end: most pieces
        for w in pieces:
            bare = w if w.isalpha() else w.rstrip(_MARKS)
            if not bare.isalpha():
                want(w)
                continue
            if bare not in known:
                got = older.get(bare)
                if got is None:
                    plain.add(bare)
                else:
                    known[bare] = got
            if len(bare) < len(w):
                tail = "\0" + w[len(bare):]
                split.append((w, bare, tail))
                if tail not in known:
                    want(tail)
        groups[" "] += plain.difference(groups[" "])
        known.update(zip(groups[" "], self._many(groups[" "], " ")))
        known.update(zip(["\n" + x for x in groups["\n"]], self._many(groups["\n"], "\n")))
        known.update(zip(["\0" + x for x in groups["\0"]], self._ids(groups["\0"])))
        for w, head, tail in split:
            a, b = known[head], known[tail]
            known[w] = a + b if a is not False and b is not False else False

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        cut = [k for k, t in enumerate(texts) if t and "\0" not in t]
        out: list[bytes | None] = [None] * len(texts)
        if cut:
            lists = pc.split_pattern(pa.array(["\0" + texts[k].replace("\n", " \n") for k in cut], pa.large_string()), " ")
            pieces, places = _pieces(lists.flatten())
            ids = list(map(self.known.get, pieces))
            holes = [i for i, x in enumerate(ids) if x is None]
            self._learn([pieces[i] for i in holes])
            for i in holes:
                ids[i] = self.known[pieces[i]]
            unsafe = np.zeros(len(ids) + 1, bool)  # the last one stands for no piece
            for i in [i for i, x in enumerate(ids) if x is False]:
                unsafe[i], ids[i] = True, b""
            joined = pa.array([*ids, b""], pa.large_binary()).take(pa.array(places))
            ends = 2 * np.asarray(lists.offsets)
            begins = np.frombuffer(joined.buffers()[1], np.int64)[ends].tolist()
            whole = np.cumsum(np.concatenate([[False], unsafe[places]]))[ends].tolist()
            raw = memoryview(joined.buffers()[2])
            for k, a, b, x, y in zip(cut, begins, begins[1:], whole, whole[1:]):
                if x == y:
                    out[k] = bytes(raw[a:b])
        # no cuts, or one that is not safe
        return [self._ids([t])[0] if x is None else x for t, x in zip(texts, out)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: list[str | None], size: int = 1 << 22):
    """Runs of texts of about ``size`` characters, null as empty."""
    some, n = [], 0
    for t in texts:
        some.append(t or "")
        n += len(some[-1])
        if n >= size:
            yield some
            some, n = [], 0
    if some:
        yield some
