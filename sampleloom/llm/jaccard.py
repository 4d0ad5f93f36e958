"""Jaccard join of word shingles by trees of count vectors.

A text is the set of its distinct shingles. Hashing them into groups and counting each group makes the set a point, and
the summed minima of two points' coordinates are at least the size of the sets' intersection. An R-tree over such points
keeps the largest count of each coordinate, so the same sum bounds all sets below a node; only pairs that the bound
leaves open are compared exactly.

One tree for the corpus would not spread, so texts are first dealt to buckets without losing a link: two linked sets share one
of the first |A| - ceil(0.8 |A|) + 1 shingles of each, in any order that is the same for all. The order is from rare to frequent,
by a sketch of counts over all texts, so a passage that many texts hold fills no bucket. The points of a bucket meet its
smallest member and, in a tree, each other. Texts of pairs that the bounds leave open are a family, and each family is
compared once, in its own tree and then by the whole sets, which only families need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import kept, light, release, schema_of, table
from sampleloom.llm.minhash import components, shingles
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import Chunk, chunks, mix

#: Similarity from which texts are linked, in hundredths.
PERCENT = 80
#: Coordinates of a point, and of the folded point that inner nodes of a tree bound; counters of the sketch that orders
#: shingles; children of a tree node.
GROUPS, COARSE, COUNTERS, FAN = 256, 64, 1 << 17, 8
#: Bits of the map of wanted sets.
FLAGS = 1 << 21
#: Most rows, and about how many bytes of sets, that one task compares; a larger bucket is dealt as pairs of parts.
TILE, TILE_BYTES = 1000, 16 << 20
#: Pairs and rows that are looked at together.
BLOCK = 1 << 18
_U = np.uint64
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def lower(c: Chunk) -> Chunk:
    return Chunk(c.first, _LOW[c.data], c.off)


def sets_of(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of 48 bits, sorted by text and hash, and where each text's begin (n + 1 places)."""
    key, doc, _ = shingles(lower(c))
    return key >> _U(16), np.searchsorted(doc, np.arange(c.n + 1))


def points_of(key: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The count vector of each set."""
    n = len(cut) - 1
    of = np.repeat(np.arange(n), np.diff(cut))
    return np.bincount(of * GROUPS + (key % _U(GROUPS)).astype(np.int64), minlength=n * GROUPS).reshape(n, GROUPS).astype(np.uint32)


def names_of(key: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set that is not empty; 0 for the others."""
    some = np.flatnonzero(np.diff(cut))
    out = np.zeros(len(cut) - 1, _U)
    if len(some):
        out[some] = mix(np.add.reduceat(mix(key), cut[some]) + mix(np.bitwise_xor.reduceat(mix(key + _U(1)), cut[some])))
    return out


def _counter(key: np.ndarray) -> np.ndarray:
    return (mix(key + _U(5)) & _U(COUNTERS - 1)).astype(np.int64)


def first_shingles(key: np.ndarray, cut: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each set that decide its buckets, with set numbers: the rarest by the sketch, ties by hash."""
    size = np.diff(cut)
    of = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((key, counts[_counter(key)], of))
    rank = np.arange(len(key)) - np.repeat(cut[:-1], size)
    keep = rank < np.repeat(size + (-PERCENT * size) // 100 + 1, size)
    return key[order][keep], of[keep]


def _points(docs: DataFrame, kind: str) -> DataFrame:
    """``kind`` 0: ``doc_id, node, n, point`` of each row (node null without words). ``kind`` 1: one row per counter of a
    task's sketch, with its number in ``node`` and its count in ``n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(COUNTERS, np.int64)
        of_id = None
        for b in batches:
            of_id = b.column(0).type
            for c in chunks(b.column(1)):
                key, cut = sets_of(c)
                sketch += np.bincount(_counter(key), minlength=COUNTERS)
                n, name, p = np.diff(cut), names_of(key, cut).view(np.int64), points_of(key, cut)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(c.n, np.int32)), b.column(0).slice(c.first, c.n), pa.array(name, mask=n == 0), pa.array(n),
                    pa.array([x.tobytes() for x in p], pa.binary())], names=["kind", "doc_id", "node", "n", "point"])
        if of_id is not None:
            used = np.flatnonzero(sketch)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(len(used), np.int32)), pa.nulls(len(used), of_id), pa.array(used), pa.array(sketch[used]),
                pa.nulls(len(used), pa.binary())], names=["kind", "doc_id", "node", "n", "point"])
        release()

    return docs.mapInArrow(run, schema_of(f"kind int, doc_id {kind}, node long, n long, point binary"))


def _keys(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """``key, node``: the buckets of each set. Equal sets of a batch are named once."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = np.zeros(0, _U)
            for c in chunks(b.column(0)):
                key, cut = sets_of(c)
                name = names_of(key, cut)
                once = np.zeros(c.n, bool)
                once[np.unique(name, return_index=True)[1]] = True
                once &= (name != 0) & ~np.isin(name, done)
                done = np.concatenate([done, name[once]])
                key, of = first_shingles(key, cut, shared.value)
                use = once[of]
                yield pa.RecordBatch.from_arrays([pa.array(key[use].view(np.int64)), pa.array(name[of[use]].view(np.int64))], names=["key", "node"])
        release()

    return texts.mapInArrow(run, schema_of("key long, node long"))


def _stars(keys: DataFrame) -> DataFrame:
    """``key, a, b``: the smallest member of each bucket with each other one. A task reads its buckets one after the other
    and holds one member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, last = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            k, node = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            new = np.append(True, k[1:] != k[:-1])
            new[0] = k[0] != key
            begin = np.flatnonzero(new)
            of = np.cumsum(new) - 1
            heads = node[begin][of] if len(begin) else np.zeros(len(k), np.int64)
            if not new[0]:
                heads = np.where(of < 0, head, heads)
            before = np.append(last if last is not None and not new[0] else heads[0], node[:-1])
            keep = ~new & (node != heads) & (node != before)
            key, head, last = k[-1], heads[-1], node[-1]
            yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(heads[keep]), pa.array(node[keep])], names=["key", "a", "b"])

    return keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, schema_of("key long, a long, b long"))


def _flag(node: np.ndarray) -> np.ndarray:
    return (mix(node.astype(_U) + _U(11)) & _U(FLAGS - 1)).astype(np.int64)


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the wanted nodes: their sets as six bytes a shingle. A bitmap of fixed size leaves out most other texts before
    anything is moved; the join decides."""
    flags = np.zeros(FLAGS, bool)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_flag(np.asarray(b.column(0)))))], names=["flag"])

    flags[wanted.mapInArrow(number, schema_of("flag long")).distinct().toPandas()["flag"].to_numpy(np.int64)] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            for c in chunks(b.column(0)):
                key, cut = sets_of(c)
                name = names_of(key, cut)
                some = np.flatnonzero(name)
                some = some[there[_flag(name[some])]]
                _, once = np.unique(name[some], return_index=True)
                some = some[np.sort(once)]
                raw = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                yield pa.RecordBatch.from_arrays([pa.array(name[some].view(np.int64)), pa.array([raw[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary())],
                                                 names=["node", "shingles"])
        release()

    made = texts.mapInArrow(run, schema_of("node long, shingles binary"))
    return made.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(b) // 6 for b in blobs], np.int64)
    raw = np.zeros((int(size.sum()), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    return raw.reshape(-1).view("<u8").astype(_U), np.append(0, np.cumsum(size))


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b with so many common shingles, or at most so many, are (can be) linked."""
    return 100 * common >= percent * (a + b - common)


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points leave open that they are linked."""
    side = lambda x: points.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("point").alias(f"p_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if not t.num_rows:
                continue
            p, q = (np.frombuffer(b"".join(t.column(c).to_pylist()), "<u4").reshape(-1, GROUPS).astype(np.int64) for c in (3, 5))
            ok = linked(np.minimum(p, q).sum(1), np.asarray(t.column(2)), np.asarray(t.column(4)), percent)
            yield t.select([0, 1]).filter(pa.array(ok))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "p_a", "n_b", "p_b")
    return both.mapInArrow(run, schema_of("a long, b long"))


class CountTree:
    """An R-tree of count vectors, packed by halving along the widest coordinate. ``order`` lists the points from left
    to right; a node of level 0 stands for ``FAN`` points, one of a higher level for ``FAN`` nodes. Nodes bound folded points; pairs
    that those leave open are bounded by the whole points."""

    def __init__(self, points: np.ndarray):
        self.whole, self.n = points.astype(np.int32), points.sum(1).astype(np.int64)
        self.points = self.whole.reshape(len(points), -1, COARSE).sum(1, dtype=np.int32)
        self.order = self._packed()
        self.most: list[np.ndarray] = []
        self.least_n: list[np.ndarray] = []
        self.most_n: list[np.ndarray] = []
        top, low, high = self.points[self.order], self.n[self.order], self.n[self.order]
        while len(top) > 1 or not self.most:
            at = np.arange(0, len(top), FAN)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.most.append(top)
            self.least_n.append(low)
            self.most_n.append(high)

    def _packed(self) -> np.ndarray:
        todo, out = [np.arange(len(self.points))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= FAN:
                out.append(rows)
                continue
            p = self.points[rows]
            wide = int((p.max(0) - p.min(0)).argmax())
            rows = rows[np.lexsort((self.n[rows], p[:, wide]))]
            half = -(-len(rows) // (2 * FAN)) * FAN
            todo += [rows[half:], rows[:half]]
        return np.concatenate(out)

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs i < j that the bounds leave open, in blocks."""
        step = max(1, BLOCK // max(1, len(self.most[-1]) * FAN * 8))
        for a in range(0, len(self.points), step):
            q = np.arange(a, min(len(self.points), a + step))
            q, node = np.repeat(q, len(self.most[-1])), np.tile(np.arange(len(self.most[-1])), len(q))
            for level in range(len(self.most) - 1, -1, -1):
                q, node = self._open(q, node, self.most[level], self.least_n[level], self.most_n[level], percent)
                width = len(self.most[level - 1]) if level else len(self.order)
                q, node = np.repeat(q, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel()
                q, node = q[node < width], node[node < width]
            other = self.order[node]
            ahead = other > q
            q, other = self._open(q[ahead], other[ahead], self.points, self.n, self.n, percent)
            yield self._open(q, other, self.whole, self.n, self.n, percent)

    def _open(self, q: np.ndarray, node: np.ndarray, most: np.ndarray, least_n: np.ndarray, most_n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        keep = np.zeros(len(q), bool)
        points = self.whole if most.shape[1] == GROUPS else self.points
        for at in range(0, len(q), BLOCK // 16):
            i, j = q[at:at + BLOCK // 16], node[at:at + BLOCK // 16]
            common = np.minimum(np.minimum(points[i], most[j]).sum(1, dtype=np.int64), most_n[j])
            keep[at:at + BLOCK // 16] = linked(common, self.n[i], least_n[j], percent)
        return q[keep], node[keep]


def common_counts(key: np.ndarray, cut: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    rows = np.unique(np.concatenate([i, j]))
    if len(i) * 16 < len(rows) ** 2 and len(i) < 1 << 16:
        return np.array([len(np.intersect1d(key[cut[x]:cut[x + 1]], key[cut[y]:cut[y + 1]], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    size = np.diff(cut)[rows]
    of = np.repeat(np.arange(len(rows)), size)
    _, at, times = np.unique(np.concatenate([key[cut[r]:cut[r + 1]] for r in rows]), return_inverse=True, return_counts=True)
    out = np.zeros((len(rows), len(rows)), np.float32)
    many = np.flatnonzero(times > 1)  # the others are common to none
    place = np.full(len(times), -1)
    place[many] = np.arange(len(many))
    col = place[at]
    of, col = of[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    of, col = of[order], col[order]
    for a in range(0, len(many), 4096):
        x, y = np.searchsorted(col, [a, a + 4096])
        here = np.zeros((len(rows), min(4096, len(many) - a)), np.float32)
        here[of[x:y], col[x:y] - a] = 1
        out += here @ here.T
    return out[np.searchsorted(rows, i), np.searchsorted(rows, j)].astype(np.int64)


def _tree(t: pa.Table) -> CountTree:
    return CountTree(np.frombuffer(b"".join(t["point"].to_pylist()), "<u4").reshape(-1, GROUPS))


def _candidates(t: pa.Table, tree: CountTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Open pairs of a task; of different parts if it compares two (pairs inside a part are the business of its own task)."""
    mine = np.asarray(t["mine"])
    across = t["i"][0].as_py() != t["j"][0].as_py()
    for i, j in tree.pairs(percent):
        if across:
            keep = mine[i] != mine[j]
            i, j = i[keep], j[keep]
        if len(i):
            yield i, j


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the smallest member of each component) after the components of i and j are joined, pair by pair."""
    while True:
        low = np.minimum(label[i], label[j])
        if (label[i] == low).all() and (label[j] == low).all():
            return label
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label = label[label]


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """``key, i, j, mine, node, point`` from ``key, node, n, point``: rows of a group for each task that needs them. A large group is dealt
    into parts, and each task compares two of them."""
    size = rows.groupBy(key).agg(F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n") * 6 / TILE_BYTES)).cast("int").alias("tiles"))
    dealt = rows.join(size, key).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return dealt.select(key, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "point")


def _open_within(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b`` that tie together the rows ``key, node, n, point`` of a bucket between which its tree leaves pairs open: fewer than rows."""
    def run(t: pa.Table) -> pa.Table:
        label, node = np.arange(len(t)), np.asarray(t["node"])
        for i, j in _candidates(t, _tree(t), percent):
            label = joined(label, i, j)
        moved = np.flatnonzero(label != np.arange(len(t)))
        return pa.table({"a": node[label[moved]], "b": node[moved]})

    return _dealt(rows, "key").groupBy("key", "i", "j").applyInArrow(light(run), schema_of("a long, b long"))


def _links_within(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of a family's dealt rows with ``shingles``, compared exactly where the tree leaves a pair open. Rows that are of one
    component already are not compared again, so a task gives fewer links than it has rows."""
    def compare(t: pa.Table) -> pa.Table:
        node, label = np.asarray(t["node"]), np.arange(len(t))
        tree = _tree(t)
        key, cut = _unpacked(t["shingles"].to_pylist())
        for i, j in _candidates(t, tree, percent):
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if len(i):
                hit = linked(common_counts(key, cut, i, j), tree.n[i], tree.n[j], percent)
                label = joined(label, i[hit], j[hit])
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": node[label[moved]], "b": node[moved]})

    return rows.groupBy("family", "i", "j").applyInArrow(light(compare), schema_of("a long, b long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the number of distinct five-word shingles of its text, A-Z lowered,
    and the smallest id reachable over links, where texts are linked if 100 times the common shingles are at least
    ``percent`` times all their shingles.

    A text with fewer words has one shingle of all of them. A null, empty or blank text has none and is linked with nothing,
    so its component is its own id. Equal sets are linked whatever their ids; rows that share an id are nodes of their own. A row
    with a null id links others, and its component is null only if none of them has an id. Repeated rows get a row each;
    an empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = kept(_points(plain, plain.schema["doc_id"].dataType.simpleString()), "points")
    rows = made.where("kind = 0").select("doc_id", "node", "n", "point")
    counts = np.zeros(COUNTERS, np.int64)  # of fixed size, whatever the input
    summed = made.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).toPandas()
    counts[summed["node"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)

    texts = plain.select("text")
    stars = kept(_stars(_keys(texts, counts)), "stars")
    pairs = stars.select("a", "b").distinct()
    involved = kept(stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct(), "involved")
    points = kept(rows.select("node", "n", "point").join(involved, "node", "left_semi").dropDuplicates(["node"]), "points")
    near = kept(_bounded(pairs, points, percent), "near")
    # the others of a bucket may be like each other, though not like its smallest member
    rest = stars.select("key", F.col("b").alias("node"))
    buckets = rest.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum(F.pmod(F.xxhash64("node"), F.lit(1 << 40))).alias("h"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"))
    once = buckets.where("m > 1").groupBy("m", "h", "x").agg(F.min("key").alias("key"))  # buckets of the same members once
    inner = kept(_open_within(rest.join(once.select("key"), "key", "left_semi").join(points, "node"), percent), "inner")
    family = components(near.union(inner)).withColumnRenamed("root", "family")
    sets = _sets(texts, family.select("node"))
    links = _links_within(_dealt(family.join(points, "node"), "family").join(sets, "node"), percent)
    roots = components(links)
    named = rows.select("doc_id", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("head"))
    return named.join(heads, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(
        F.col("head")).alias("component_id"))


@query("op13_jaccard_join")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
