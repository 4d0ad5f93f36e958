"""Near duplicates by DartMinHash: weighted signatures of word shingles, banded candidates, exact check, components.

Each shingle of a text owns a region as wide as its count. Hashed darts fall on weights and ranks as a Poisson process;
a text keeps, for each of ``K`` coordinates, the dart of lowest rank inside its regions. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity, and the work follows the number of shingles plus K log K.
"""

from __future__ import annotations

from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import kept, release, schema_of, shared_path, table
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import Chunk, chunks, mix
from sampleloom.session import settled

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
K = BANDS * ROWS
#: Largest part of a bucket that one task compares; a larger one is dealt as pairs of parts.
TILE = 2000
#: Places of shingles that a task looks at together.
BLOCK = 1 << 20
_U = np.uint64


def shingles(c: Chunk, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a chunk, sorted by text and hash, with text numbers and counts.
    A text with fewer words than a shingle has one shingle of all its words. With fewer ``bits``, shingles of a text whose
    hashes share their upper bits count as one."""
    h, doc = c.word_hash, c.words[2]
    n = np.bincount(doc, minlength=c.n)
    first = np.cumsum(n) - n
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    of = np.repeat(np.arange(c.n), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + first[of]
    key = np.full(len(of), 0x2545F4914F6CDD1D, _U)
    for j in range(SHINGLE):
        there = j < n[of]
        key = np.where(there, mix(key + h[np.minimum(at + j, len(h) - 1)] if len(h) else key), key)
    key >>= _U(64 - bits)
    order = np.lexsort((key, of))
    of, key = of[order], key[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1])
    start = np.flatnonzero(new)
    return key[start], of[start], np.diff(np.append(start, len(of)))


def _poisson(area: float) -> np.ndarray:
    """Distribution function of a Poisson number with the given mean."""
    p, out, k = exp(-area), [], 0
    while k < area or sum(out[-1:]) < 1 - 1e-12 and k < area + 12 * area ** 0.5 + 30:
        out.append((out[-1] if out else 0.0) + p)
        k += 1
        p *= area / k
    return np.array(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) / (1 << 53)


def darts(key: np.ndarray, weight: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element number, coordinate, rank and identity of all darts inside each element's weight and below its rank limit.

    Weight and rank axes are cut into cells 0-1, 1-2, 2-4, ...; the darts of a cell depend on the element and cell alone."""
    parts = []
    w_low, w_high, a = 0.0, 1.0, 0
    while a == 0 or (len(weight) and w_low < weight.max()):
        wide = np.flatnonzero(weight > w_low)
        r_low, r_high, b = 0.0, 1.0, 0
        while b == 0 or (len(wide) and r_low < limit[wide].max()):
            e = wide[limit[wide] > r_low]
            cell = mix(key[e] + _U((a * 64 + b + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            area = (w_high - w_low) * (r_high - r_low)
            for piece in range(max(1, int(area // 64))):  # a large cell is a sum of smaller ones, so that its table stays exact
                share = area / max(1, int(area // 64))
                cdf = _poisson(share)
                seed = mix(cell + _U(piece + 1))
                n = np.minimum(np.searchsorted(cdf, _unit(seed), "right"), len(cdf))
                of = np.repeat(np.arange(len(e)), n)
                i = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                ident = mix(seed[of] + (i + 1).astype(_U) * _U(0xD1B54A32D192ED03))
                rank = r_low + _unit(mix(ident + _U(2))) * (r_high - r_low)
                inside = (w_low + _unit(mix(ident + _U(1))) * (w_high - w_low) < weight[e[of]]) & (rank < limit[e[of]])
                ident = ident[inside]
                parts.append((e[of[inside]], (mix(ident + _U(3)) % _U(k)).astype(np.int64), rank[inside], ident))
            r_low, r_high, b = r_high, r_high * 2, b + 1
        w_low, w_high, a = w_high, w_high * 2, a + 1
    return tuple(np.concatenate(x) for x in zip(*parts))


def signatures(c: Chunk, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``k`` dart identities for each text, and whether the text has any words."""
    key, doc, count = shingles(c)
    weight = count.astype(np.float64)
    total = np.bincount(doc, weights=weight, minlength=c.n)
    some = total > 0
    out = np.zeros((c.n, k), _U)
    budget = k * (np.log(k) + 2.0)
    todo = some.copy()
    while todo.any():
        use = np.flatnonzero(todo[doc])
        limit = budget / total[doc[use]]
        e, coord, rank, ident = darts(key[use], weight[use], limit, k)
        place = doc[use[e]] * k + coord
        order = np.lexsort((ident, rank, place))
        place = place[order]
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        out.reshape(-1)[place[new]] = ident[order[new]]
        filled = np.bincount(place[new] // k, minlength=c.n)
        todo &= filled < k  # an empty coordinate: throw again with more ranks; what was found stays the lowest
        budget *= 2
    return out, some


def _digest(text: Column) -> Column:
    """The number that stands for a text, null as empty; equal texts have equal numbers."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _signed(texts: DataFrame) -> DataFrame:
    """``doc_id, bands`` from ``doc_id, text``: the band keys (null without words)."""
    def run(batches):
        for b in batches:
            bands = []
            for c in chunks(b.column(1)):
                sig, some = signatures(c)
                key = np.zeros((c.n, BANDS), _U)
                for r in range(ROWS):
                    key = mix(key + sig[:, r::ROWS])
                bands += [x.astype(np.int64).tolist() if s else None for x, s in zip(key.view(np.int64), some)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "bands"])
        release()

    return texts.mapInArrow(run, schema_of("doc_id long, bands array<long>"))


def _shingle_sets(df: DataFrame) -> DataFrame:
    """``doc_id, parts``: sorted distinct 40-bit shingle hashes with counts, from ``doc_id, text``."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for c in chunks(b.column(1)):
                key, doc, count = shingles(c, 40)  # cut any later, two of one text could be equal
                cut = np.searchsorted(doc, np.arange(c.n + 1))
                low, high = (key & _U(0xFFFFFFFF)).astype("<u4"), (key >> _U(32)).astype(np.uint8)
                count = count.astype("<u4")
                out += [low[i:j].tobytes() + high[i:j].tobytes() + count[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "parts"])
        release()

    return df.select("doc_id", "text").mapInArrow(run, schema_of(f"doc_id {kind}, parts binary"))


def _set(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 9
    key = np.frombuffer(blob, "<u4", n).astype(_U) | np.frombuffer(blob, np.uint8, n, 4 * n).astype(_U) << _U(32)
    return key, np.frombuffer(blob, "<u4", n, 5 * n).astype(np.int64)


def weighted_jaccard(a: bytes, b: bytes) -> float:
    (x, n), (y, m) = _set(a), _set(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = np.minimum(n[i], m[j]).sum()
    return float(common / max(1, n.sum() + m.sum() - common))


def _checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b, linked`` of distinct pairs, by their exact similarity."""
    kind = pairs.schema["a"].dataType.simpleString()
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("parts").alias("pa")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("parts").alias("pb")), "b").select("a", "b", "pa", "pb")

    def run(batches):
        for t in batches:
            linked = [weighted_jaccard(x.as_py(), y.as_py()) >= similarity for x, y in zip(t.column(2), t.column(3))]
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return both.mapInArrow(run, schema_of(f"a {kind}, b {kind}, linked boolean"))


class Sets:
    """Shingle sets of the rows of a task with an index from each shingle to its rows."""

    def __init__(self, parts: list[bytes]):
        self.parts = parts
        keys, counts = zip(*map(_set, parts))
        size = np.array([len(k) for k in keys])
        self.total = np.array([n.sum() for n in counts])
        self.off = np.concatenate([[0], np.cumsum(size)])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.row, self.count = np.repeat(np.arange(len(parts), dtype=np.int32), size)[order], np.concatenate(counts).astype(np.int32)[order]
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        self.place = np.empty(len(key), np.int32)
        self.place[order] = np.arange(len(key), dtype=np.int32)
        self.first = np.flatnonzero(new).astype(np.int32)[np.cumsum(new) - 1]

    def similar(self, r: int, others: np.ndarray) -> np.ndarray:
        """Exact weighted Jaccard similarity of row ``r`` with each of some rows before it."""
        place = self.place[self.off[r]:self.off[r + 1]]
        n = (place - self.first[place]).astype(np.int64)  # rows before r that hold the shingle
        end = np.cumsum(n)
        if len(others) << 11 < end[-1]:
            return np.array([weighted_jaccard(self.parts[h], self.parts[r]) for h in others])
        common = np.zeros(r)
        cut = np.unique(np.append(np.searchsorted(end, np.arange(0, end[-1], BLOCK)), len(n)))
        for i, j in zip(cut, cut[1:]):
            m = n[i:j]
            at = np.arange(m.sum()) + np.repeat(self.first[place[i:j]] - (np.cumsum(m) - m), m)
            common += np.bincount(self.row[at], np.minimum(self.count[at], np.repeat(self.count[place[i:j]], m)), r)
        common = common[others]
        return common / (self.total[r] + self.total[others] - common)


def _links_between(rows: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between different components in the same bucket, from rows ``band, key, doc_id, root, parts``.

    A row is compared exactly with all those before it that belong to other components; a link joins the components at once, so a bucket gives fewer links than it has rows. A bucket above ``TILE`` rows is dealt into parts, and
    each task compares two of them."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    size = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), tiles).cast("int")
    dealt = rows.join(size, ["band", "key"]).withColumn("tiles", tiles).withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("band", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "doc_id", "root",
                         "parts")

    def compare(t: pa.Table) -> pa.Table:
        ids = np.array(t["doc_id"].to_pylist(), object)
        order = np.argsort(ids, kind="stable")
        parts = t["parts"].to_pylist()
        sets = Sets([parts[i] for i in order])
        ids, mine = ids[order], np.asarray(t["mine"])[order]
        _, of = np.unique(np.array(t["root"].to_pylist(), object)[order], return_inverse=True)
        across = t["i"][0].as_py() != t["j"][0].as_py()  # pairs inside a part are the business of its own task
        a, b = [], []
        for r in range(1, len(ids)):
            other = np.flatnonzero((of[:r] != of[r]) & (mine[:r] != mine[r] if across else True))
            if not len(other):
                continue
            for h in other[sets.similar(r, other) >= similarity]:
                if of[h] != of[r]:
                    a.append(ids[h])
                    b.append(ids[r])
                    of[of == of[r]] = of[h]
        t_id = t.schema.field("doc_id").type
        return pa.table({"a": pa.array(a, t_id), "b": pa.array(b, t_id)})

    return dealt.groupBy("band", "key", "i", "j").applyInArrow(compare, schema_of(f"a {kind}, b {kind}"))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of the ends of ``links`` ``a, b``: the smallest member of each node's connected component.

    Each node hooks to its smallest neighbour below it, chains are shortened, and links between the trees' roots go on to the next
    round, so links shrink by a factor in every round, also along chains. Each round is written once."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    first = kept(links.select(low, high).where("a <> b").distinct(), "links")
    edges, ups = first, []
    while not edges.isEmpty():
        up = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        for _ in range(2):
            above = up.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            up = up.join(above, "up", "left").select("node", F.coalesce("higher", "up").alias("up"))
        up = kept(up, "hooks")
        ups.append(up)
        to = lambda e, c: e.join(up.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("up", c)).drop("up")
        edges = kept(to(to(edges, "a"), "b").select(low, high).where("a <> b").distinct(), "links")
    nodes = first.select(F.col("a").alias("node")).union(first.select("b")).distinct().withColumn("root", F.col("node"))
    for up in ups:
        step = up.select(F.col("node").alias("root"), "up")
        nodes = nodes.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return kept(nodes, "components")


def classes_of(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``node, root`` of every text that is linked with another one, from ``doc_id, text`` where ``doc_id`` is the digest of the
    text: the smallest digest of its class."""
    spark = texts.sparkSession
    path = shared_path(spark, "signed")
    _signed(texts).write.parquet(path)
    # exact copies count once from here on
    once = settled(spark.read.parquet(path).groupBy("doc_id").agg(F.any_value("bands").alias("bands")))
    each = once.where("bands is not null").select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = each.groupBy("band", "key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = settled(each.join(buckets.drop("n"), ["band", "key"]).where("doc_id <> a").select("band", "key", "a", F.col("doc_id").alias("b")))
    stars = members.select("a", "b").distinct()
    involved = members.select(F.col("a").alias("doc_id")).union(members.select("b")).distinct()
    set_path = shared_path(spark, "sets")
    _shingle_sets(texts.join(involved, "doc_id", "left_semi")).dropDuplicates(["doc_id"]).write.parquet(set_path)
    sets = spark.read.parquet(set_path)
    first = settled(_checked(stars, sets, similarity))
    links = first.where("linked").select("a", "b")
    roots = components(links)
    # buckets that still hold several components: their members may be like each other, though not like the head
    whole = members.select("band", "key", F.col("b").alias("doc_id")).union(members.select("band", "key", "a").distinct())
    whole = whole.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    open_ = whole.groupBy("band", "key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("band", "key")
    rows = whole.join(open_, ["band", "key"]).join(sets, "doc_id")
    more = settled(_links_between(rows, similarity))
    return components(links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest id of its class of texts linked, also through others, by a similarity
    of at least ``similarity``.

    The similarity is the weighted Jaccard of five-word shingles with their counts. Equal texts are one class, also empty ones
    (a null text is an empty one); a text without words has no other links. A text is known by its 64-bit digest, not by its id:
    rows that share an id but not a text are compared like any others, and a row with a null id takes part, with a null class if no
    row of its class has an id. Repeated rows get a row each. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), _digest(F.col(text_col)).alias("node"))
    roots = classes_of(docs.select(_digest(F.col(text_col)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), similarity)
    named = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(heads, "root").select("doc_id", "class_id")


@query("op5_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class, by smallest id (null last), then by text digest and the other columns. Distinct texts
    stay, whatever their ids; equal texts are one class, also where ids are null."""
    node = _digest(F.col("text"))
    roots = classes_of(docs.select(node.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.name != "text" and "map<" not in f.dataType.simpleString()]
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), node.alias("node"), F.xxhash64(*others).alias("rest"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), node.alias("node"), rank.alias("rank"))
    named = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min("rank").alias("head"))
    kept = named.join(heads, "root").where(F.col("rank").eqNullSafe(F.col("head")))
    return kept.dropDuplicates(["root"]).select("row.*")  # what is left of a class are equal rows
