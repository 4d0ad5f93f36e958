"""Removal of repeated passages by a distributed merge sort of suffixes.

Suffixes are sampled so that nothing is lost: every string of ``length`` bytes holds exactly one *anchor*, the leftmost
of its ``GRAM``-byte pieces with the smallest hash, and equal strings hold it at the same place. So all strings can be
compared through the suffixes that start at anchors (one byte in about 35) with the bytes around them.

1. Each group of documents sends the hashes of its anchors; the reply says which ones occur more than once at all.
2. Suffixes at those anchors are sorted into runs, front-coded (length of the prefix shared with the suffix before, and
   the rest), cut at common splitters and exchanged. Equal surroundings in one group travel once.
3. Each range merges its runs with a loser tree whose nodes keep the prefix length known to be shared with the last
   winner: unequal lengths decide without a look at the bytes, equal ones go on after the known prefix.
4. Neighbours that share an anchor piece are compared as whole strings; the places that have an earlier equal go back to
   their documents.
5. Anchors with very many different surroundings do not travel as suffixes: each group sends the 128-bit digests of the
   strings around them, each once, to shards by digest, so that one anchor spreads over all shards.
"""

from __future__ import annotations

from bisect import bisect_right
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.llm.frames import group_count, grouped, light, pack, schema_of, table, total_bytes, unpack
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import Chunk, chunks, columns, mix, powers

LENGTH = 100
GRAM = 32
#: Documents whose anchors place the splitters. They set the balance of the ranges only, never the result.
SPLIT_ROWS = 256
#: An anchor with so many surroundings, counted by group, is compared by digests of its strings instead of in one range.
HEAVY = 4000
_U = np.uint64
_LOW = _U(0xFFFFFFFF)


def chunk_anchors(c: Chunk, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor of a chunk, and the first and last start of the strings that hold it."""
    n = len(c.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(_U), none, none, none
    _, down = powers(n)
    h = mix((c.prefix[gram:] - c.prefix[:-gram]) * down[:n - gram + 1])
    low = (h & ~_LOW) | np.arange(len(h), dtype=_U)  # equal upper halves: the leftmost wins
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    edge = np.zeros(n + 1, np.int64)
    ends = c.off[1:]
    np.add.at(edge, np.maximum(c.off[:-1], ends - length + 1), 1)
    np.add.at(edge, ends, -1)
    start = np.flatnonzero(np.cumsum(edge)[:n - length + 1] == 0)
    if not len(start):
        return none.astype(_U), none, none, none
    at = (low[start] & _LOW).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return mix(h[at[first]] + _U(1)), at[first], start[first], start[last]  # mixed again: minima crowd at small hashes


def anchors(column: pa.ChunkedArray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The same for all texts of a group, with places in its concatenated bytes."""
    _, off = columns(column)
    parts = []
    for c in chunks(column):
        h, at, lo, hi = chunk_anchors(c, length, gram)
        parts.append((h, *(x + off[c.first] for x in (at, lo, hi))))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def in_order(t: pa.Table, key: str, text: str) -> pa.Table:
    """Rows by id, null first, then text: the same order whenever a group is read."""
    return t.take(pa.compute.sort_indices(t, [(key, "ascending"), (text, "ascending")], null_placement="at_start"))


def ask(t: pa.Table, buckets: int, length: int, gram: int) -> pa.Table:
    """Distinct anchor hashes of a group for each bucket, which of them it holds more than once, and in how many surroundings."""
    h, at, lo, hi = anchors(t["text"], length, gram)
    keys, inv, count = np.unique(h, return_inverse=True, return_counts=True)
    raw = columns(t["text"])[0].tobytes()
    use = np.flatnonzero(count[inv] > 1)
    different = {(k, a - p, raw[p:q + length]) for k, a, p, q in zip(inv[use].tolist(), at[use].tolist(), lo[use].tolist(), hi[use].tolist())}
    around = np.bincount(np.array([k for k, _, _ in different], np.int64), minlength=len(keys)).astype("<u4")
    cut = np.searchsorted(keys, np.array([b * (1 << 64) // buckets for b in range(1, buckets)], _U))
    cut = [0, *cut.tolist(), len(keys)]
    gid = t["gid"][0].as_py()
    rows = [(b, keys[i:j].tobytes(), np.packbits(count[i:j] > 1).tobytes(), around[i:j][count[i:j] > 1].tobytes())
            for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "gid": pa.array([gid] * len(rows), pa.int32()),
                     "keys": pa.array([r[1] for r in rows], pa.binary()), "multi": pa.array([r[2] for r in rows], pa.binary()),
                     "around": pa.array([r[3] for r in rows], pa.binary())})


def answer(t: pa.Table, heavy: int = HEAVY) -> pa.Table:
    """For each group of a bucket two bits for each of its hashes: whether it occurs elsewhere or more than once, and whether
    it has ``heavy`` surroundings or more."""
    keys = [np.frombuffer(x.as_buffer(), _U) for x in t["keys"]]
    multi = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(k)) for x, k in zip(t["multi"], keys)]
    around = [np.ones(len(k)) for k in keys]
    for n, m, x in zip(around, multi, t["around"]):
        n[m > 0] = np.frombuffer(x.as_buffer(), "<u4")
    _, inv = np.unique(np.concatenate(keys), return_inverse=True)
    again = np.bincount(inv, weights=np.concatenate(multi) + 1.0)[inv] > 1
    many = again & (np.bincount(inv, weights=np.concatenate(around))[inv] >= heavy)
    cut = np.cumsum([len(k) for k in keys])[:-1]
    return pa.table({"gid": t["gid"], "bucket": t["bucket"], "bits": pa.array([np.packbits(x).tobytes() for x in np.split(again, cut)], pa.binary()),
                     "heavy": pa.array([np.packbits(x).tobytes() for x in np.split(many, cut)], pa.binary())})


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes at least."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Shared prefix lengths, lengths of the rests, and the rests of sorted keys."""
    lcp = [0] + [shared_prefix(a, b) for a, b in zip(keys, keys[1:])] if keys else []
    rest = [k[n:] for k, n in zip(keys, lcp)]
    return np.array(lcp, np.int32), np.array([len(r) for r in rest], np.int32), b"".join(rest)


def decoded(lcp: np.ndarray, size: np.ndarray, rest: bytes) -> list[bytes]:
    keys, last, at = [], b"", 0
    for n, m in zip(lcp.tolist(), size.tolist()):
        last = last[:n] + rest[at:at + m]
        at += m
        keys.append(last)
    return keys


def joined(row: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Starts of strings as runs of neighbours: row, first and last start."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    return {"row": row[first].astype(np.int32), "lo": at[first].astype(np.int64), "hi": at[last].astype(np.int64)}


def digests(raw: bytes, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the strings that start from ``lo`` to ``hi``, and their digests as two numbers each."""
    n = hi - lo + 1
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    out = bytearray()
    for p in at:
        out += blake2b(raw[p:p + length], digest_size=16).digest()
    return at, np.frombuffer(bytes(out), "<u8").reshape(-1, 2)


def runs(t: pa.Table, bits: pa.Table, splitters: list[bytes], parts: int, length: int, gram: int) -> pa.Table:
    """Front-coded runs of a group's repeated suffixes for each range (kind 0), the repeats inside the group (kind 1), and the
    first places of the strings at heavy anchors for each shard of their digests (kind 2)."""
    t = in_order(t, "doc_id", "text")
    data, off = columns(t["text"])
    h, at, lo, hi = anchors(t["text"], length, gram)
    keys, inv = np.unique(h, return_inverse=True)
    by = np.argsort(np.asarray(bits["bucket"])) if len(bits) else []
    again = many = np.zeros(len(keys), bool)
    if len(by):
        sizes = [bits["n"][int(i)].as_py() for i in by]
        again, many = (np.concatenate([np.unpackbits(np.frombuffer(bits[c][int(i)].as_buffer(), np.uint8), count=n)
                                       for i, n in zip(by, sizes)]).astype(bool) for c in ("bits", "heavy"))
    use = np.flatnonzero(again[inv])
    h, at, lo, hi, heavy = h[use], at[use], lo[use], hi[use], many[inv[use]]
    row = np.searchsorted(off, lo, "right") - 1
    raw = data.tobytes()
    # equal surroundings: the first stands for all of them
    spots: dict[tuple, int] = {}
    keep, local = [], []
    for i, (x, p, q, a) in enumerate(zip(h.tolist(), lo.tolist(), hi.tolist(), at.tolist())):
        if spots.setdefault((raw[p:q + length], a - p), i) == i:
            keep.append(i)
        else:
            local.append(i)
    gid = t["gid"][0].as_py()
    loc = np.array(local, np.int64)
    out = [(gid % parts, 1, pack(row=row[loc].astype(np.int32), lo=(lo - off[row])[loc], hi=(hi - off[row])[loc]))]
    ranges: dict[int, list] = {}
    for i in keep:
        if not heavy[i]:
            key = raw[at[i]:hi[i] + length]
            ranges.setdefault(bisect_right(splitters, key[:gram]), []).append((key, i))
    ids = np.asarray(t["doc_id"].fill_null(-(1 << 63)))
    dense = np.array([i for i in keep if heavy[i]], np.int64)
    if len(dense):
        start, digest = digests(raw, lo[dense], hi[dense], length)
        where = np.repeat(row[dense], (hi - lo + 1)[dense])
        order = np.lexsort((start, digest[:, 1], digest[:, 0]))
        start, digest, where = start[order] - off[where[order]], digest[order], where[order]
        new = np.ones(len(digest), bool)
        new[1:] = (digest[1:] != digest[:-1]).any(1)
        out.append((gid % parts, 1, pack(**joined(where[~new], start[~new]))))
        start, digest, where = start[new], digest[new], where[new]
        shard = ((digest[:, 0] >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        cut = np.searchsorted(shard, np.arange(parts + 1))
        out += [(p, 2, pack(digest=digest[i:j].tobytes(), doc=ids[where[i:j]], row=where[i:j].astype(np.int32), at=start[i:j].astype(np.int32)))
                for p, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
    for r, found in ranges.items():
        found.sort()
        order = np.array([i for _, i in found], np.int64)
        lcp, size, rest = front_coded([k for k, _ in found])
        left = [raw[lo[i]:at[i]] for i in order]
        out.append((r, 0, pack(lcp=lcp, size=size, rest=rest, left=b"".join(left), left_size=np.array([len(x) for x in left], np.int32),
                               doc=ids[row[order]], row=row[order].astype(np.int32), at=(at - off[row])[order], span=(hi - lo)[order].astype(np.int32))))
    return pa.table({"part": pa.array([r[0] for r in out], pa.int32()), "gid": pa.array([gid] * len(out), pa.int32()),
                     "kind": pa.array([r[1] for r in out], pa.int32()), "blob": pa.array([r[2] for r in out], pa.binary())})


def merged(keys: list[list[bytes]], lcps: list[list[int]]):
    """(shared prefix with the one before, run, place) of all keys in order, from sorted runs, by a loser tree.

    Each node keeps a run and the prefix its key shares with the last winner that passed. A longer shared prefix is the
    smaller key; only equal lengths need bytes, and only those after the shared prefix.
    """
    size = 1
    while size < len(keys):
        size *= 2
    place = [0] * len(keys)
    head = [k[0] if k else None for k in keys] + [None] * (size - len(keys))
    run, known = [0] * size, [0] * size

    def play(r: int, n: int, s: int, m: int) -> tuple[int, int, int, int]:
        """Winner and its shared prefix, loser and the prefix that it shares with the winner."""
        a, b = head[r], head[s]
        if b is None:
            return r, n, s, m
        if a is None:
            return s, m, r, n
        if n != m:
            return (r, n, s, m) if n > m else (s, m, r, n)
        k = shared_prefix(a, b, n)
        if a[k:] <= b[k:]:
            return r, n, s, k
        return s, m, r, k

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            return node - size, 0
        (r, n), (s, m) = build(2 * node), build(2 * node + 1)
        w, wn, run[node], known[node] = play(r, n, s, m)
        return w, wn

    w, n = build(1)
    while head[w] is not None:
        yield n, w, place[w]
        place[w] += 1
        i = place[w]
        if i < len(keys[w]):
            head[w], n = keys[w][i], lcps[w][i]
        else:
            head[w], n = None, 0
        node = (w + size) // 2
        while node:
            w, n, run[node], known[node] = play(w, n, run[node], known[node])
            node //= 2


def repeated(group: list[tuple], length: int) -> list[tuple[tuple, int, int]]:
    """(entry, first and last start) of the strings that have an earlier equal, for entries that share an anchor piece.

    An entry is (left bytes, right bytes, span, doc, row, at, gid): its strings start ``len(left) - span`` to ``len(left)``
    bytes before ``at``."""
    kinds: dict[tuple, list] = {}
    for e in group:
        kinds.setdefault((e[0], e[1], e[2]), []).append(e)
    order = lambda e: (e[3], e[6], e[4], e[5])
    heads = {k: min(v, key=order) for k, v in kinds.items()}
    out = [(e, e[5] - len(e[0]), e[5] - len(e[0]) + e[2]) for k, v in kinds.items() for e in v if e is not heads[k]]
    if len(kinds) > 1:
        best: dict[tuple[int, bytes], tuple] = {}
        for (left, right, span), e in heads.items():
            n, mine = len(left), order(e)
            for d in range(n - span, n + 1):
                s = (d, left[n - d:] + right[:length - d])
                if s not in best or mine < best[s]:
                    best[s] = mine
        for (left, right, span), e in heads.items():
            n, mine, first = len(left), order(e), None
            for d in range(n, n - span - 2, -1):  # starts in ascending order
                hit = d >= n - span and best[d, left[n - d:] + right[:length - d]] != mine
                if hit and first is None:
                    first = e[5] - d
                elif not hit and first is not None:
                    out.append((e, first, e[5] - d - 1))
                    first = None
    return out


def merge_range(t: pa.Table, length: int, gram: int) -> pa.Table:
    """Repeats of one range and of one shard of digests, by document group; the repeats found inside groups pass through."""
    out_gid, out_blob, keys, lcps, side, sent = [], [], [], [], [], []
    for gid, kind, blob in zip(t["gid"].to_pylist(), t["kind"].to_pylist(), t["blob"]):
        if kind == 1:
            out_gid.append(gid)
            out_blob.append(blob.as_py())
            continue
        x = unpack(blob.as_py())
        if kind == 2:
            sent.append((np.frombuffer(x["digest"], "<u8").reshape(-1, 2), x["doc"], np.full(len(x["doc"]), gid), x["row"], x["at"]))
            continue
        cut = np.concatenate([[0], np.cumsum(x["left_size"])]).tolist()
        lefts = [x["left"][i:j] for i, j in zip(cut, cut[1:])]
        keys.append(decoded(x["lcp"], x["size"], x["rest"]))
        lcps.append(x["lcp"].tolist())
        side.append((lefts, x["span"].tolist(), x["doc"].tolist(), x["row"].tolist(), x["at"].tolist(), gid))
    found: dict[int, list] = {}

    def close(group: list[tuple[int, int]]) -> None:
        if len(group) < 2:
            return
        entries = [(s[0][i], keys[r][i], s[1][i], s[2][i], s[3][i], s[4][i], s[5]) for r, i in group for s in (side[r],)]
        for e, lo, hi in repeated(entries, length):
            found.setdefault(e[6], []).append((e[4], lo, hi))

    group: list[tuple[int, int]] = []
    for n, r, i in merged(keys, lcps) if keys else ():
        if n < gram:
            close(group)
            group = []
        group.append((r, i))
    close(group)
    for gid, rows in found.items():
        a = np.array(rows, np.int64)
        out_gid.append(gid)
        out_blob.append(pack(row=a[:, 0].astype(np.int32), lo=a[:, 1], hi=a[:, 2]))
    for gid, blob in later(sent) if sent else ():
        out_gid.append(gid)
        out_blob.append(blob)
    return pa.table({"gid": pa.array(out_gid, pa.int32()), "blob": pa.array(out_blob, pa.binary())})


def later(sent: list[tuple[np.ndarray, ...]]) -> list[tuple[int, bytes]]:
    """Groups and places of the strings that another group holds earlier, from (digests, doc, gid, row, at) of each group."""
    digest, doc, gid, row, at = (np.concatenate(x) for x in zip(*sent))
    order = np.lexsort((gid, doc, digest[:, 1], digest[:, 0]))
    digest = digest[order]
    hit = np.zeros(len(order), bool)
    hit[1:] = (digest[1:] == digest[:-1]).all(1)
    hit = order[hit]
    hit = hit[np.argsort(gid[hit], kind="stable")]
    cuts = np.flatnonzero(np.diff(gid[hit])) + 1
    return [(int(gid[x[0]]), pack(**joined(row[x], at[x]))) for x in np.split(hit, cuts) if len(x)]


def cut_out(t: pa.Table, hits: pa.Table, length: int, extra: list[str]) -> pa.Table:
    """Rows of a group with the removed byte spans, the bytes that stay, and their text without halves of characters."""
    t = in_order(t, "doc_id", "text")
    data, off = columns(t["text"])
    edge = np.zeros(len(data) + 1, np.int32)
    for blob in hits["blob"]:
        x = unpack(blob.as_py())
        base = off[x["row"]]
        np.add.at(edge, base + x["lo"], 1)
        np.add.at(edge, base + x["hi"] + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    raw = data[~gone].tobytes()
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[off[1:]] - total[off[:-1]]
    kept_off = off - total[off]
    step = gone.copy()
    step[1:] &= ~gone[:-1] if len(gone) else step[1:]
    inner = off[:-1][off[:-1] < len(data)]
    step[inner] = gone[inner]
    starts = np.flatnonzero(step)
    stop = gone.copy()
    stop[:-1] &= ~gone[1:] if len(gone) else stop[:-1]
    ends_in = off[1:][off[1:] > 0] - 1
    stop[ends_in] = gone[ends_in]
    ends = np.flatnonzero(stop) + 1
    row = np.searchsorted(off, starts, "right") - 1
    cut = np.searchsorted(row, np.arange(len(off)))
    pairs = np.column_stack([starts - off[row], ends - off[row]]) if len(starts) else np.zeros((0, 2), np.int64)
    kept = [raw[i:j] for i, j in zip(kept_off, kept_off[1:])]
    made = {"text": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()),
            "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array([pairs[i:j].tolist() for i, j in zip(cut, cut[1:])], pa.list_(pa.list_(pa.int64()))), "kept": pa.array(kept, pa.binary())}
    return pa.table({c: made.get(c, t[c] if c in t.column_names else None) for c in ["doc_id", *extra, *made]})


def split_points(docs: DataFrame, parts: int, length: int, gram: int) -> list[bytes]:
    """At most ``parts`` - 1 keys of ``gram`` bytes that cut the suffixes of a bounded sample of documents evenly."""
    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SPLIT_ROWS).select("text")

    def heads(batches):
        for b in batches:
            column = pa.chunked_array([b.column(0)])
            data, _ = columns(column)
            _, at, *_ = anchors(column, length, gram)
            at = at[:: max(1, len(at) // 4096)]
            yield pa.RecordBatch.from_arrays([pa.array([data[i:i + gram].tobytes() for i in at], pa.binary())], names=["head"])

    found = sorted({bytes(r["head"]) for r in sample.mapInArrow(heads, "head binary").collect()})
    n = min(parts - 1, len(found))
    return [found[(i + 1) * len(found) // (n + 1)] for i in range(n)] if n else []


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   groups: int | None = None, keep: list[str] | None = None, heavy: int = HEAVY) -> DataFrame:
    """``doc_id``, the columns ``keep`` as ``keep_0, keep_1, ...``, and ``text, n_bytes, n_removed, spans, kept``: each text as
    bytes without those covered by a string of ``length`` bytes that also starts earlier (smaller id, or the same document
    further left), judged on the input; ``text`` is ``kept`` without halves of cut characters.

    ``spans`` are the maximal removed (start, end) runs. A null text is an empty one; shorter texts lose nothing. A null id
    comes before all others; rows with one id are ordered by text. Other columns are not read. ``heavy`` sets how many surroundings
    of an anchor one task compares, never the result.
    """
    extra = [f"keep_{i}" for i in range(len(keep or []))]
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    *[F.col(f"`{c}`").alias(k) for c, k in zip(keep or [], extra)])
    n = groups or group_count(total_bytes(d, "text"))
    splitters = split_points(d, n, length, gram)
    d = grouped(d, "doc_id", n)
    asked = d.groupBy("gid").applyInArrow(light(lambda t: ask(t, n, length, gram)), schema_of("bucket int, gid int, keys binary, multi binary, around binary"))
    asked = asked.withColumn("n", (F.octet_length("keys") / 8).cast("int"))

    def reply(t: pa.Table) -> pa.Table:
        return answer(t, heavy).append_column("n", t["n"])

    replies = asked.groupBy("bucket").applyInArrow(light(reply), schema_of("gid int, bucket int, bits binary, heavy binary, n int"))
    sent = d.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(
        light(lambda a, b: runs(a, b, splitters, n, length, gram) if len(a) else _no_runs()), schema_of("part int, gid int, kind int, blob binary"))
    hits = sent.groupBy("part").applyInArrow(light(lambda t: merge_range(t, length, gram)), schema_of("gid int, blob binary"))
    out = T.StructType([d.schema[c] for c in ("doc_id", *extra)] +
                       list(schema_of("text string, n_bytes long, n_removed long, spans array<array<long>>, kept binary")))
    return d.groupBy("gid").cogroup(hits.groupBy("gid")).applyInArrow(light(lambda a, b: cut_out(a, b, length, extra)), out)


def _no_runs() -> pa.Table:
    return pa.table({"part": pa.array([], pa.int32()), "gid": pa.array([], pa.int32()), "kind": pa.array([], pa.int32()),
                     "blob": pa.array([], pa.binary())})


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, without passages of 100 bytes and more that also stand earlier."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    done = remove_repeats(docs, keep=rest)
    named = {c: F.col(f"keep_{i}").alias(c) for i, c in enumerate(rest)}
    named["n_chars"] = F.length("text").cast("long").alias("n_chars")
    return done.select(*[named.get(c, F.col(c)) for c in docs.columns])
