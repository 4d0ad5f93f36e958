"""Toxicity by class-conditional Kneser-Ney models of word pairs.

One model learns from toxic documents, one from ordinary ones. Both back off through the same shared counts. Pairs that
are rare over both classes are left to that backoff. What discounting takes from the words of a class goes back to words
of about the same shared count: a rare word that only one class has seen costs both nearly the same, a frequent one does
not. A document is judged by the length-normalised difference of its log-likelihoods and by its strongest words, however
long the text around them, through a calibrated logistic line.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import add_columns, fold_of, in_one_task, smallest, table
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import Chunk, chunks, mix

#: Most documents of each class that the models learn from.
FIT_ROWS = 4000
THRESHOLD = 0.3
DISCOUNT = 0.75
#: Share of words that no class has seen.
UNSEEN = 0.02
#: Pairs need so many places over both classes for counts of their own.
PAIR_COUNT = 3
#: Difference of log-likelihoods from which a word is strong evidence.
STRONG = 2.0
TOP = 3
RIDGE = 0.5
CHUNK = 4 << 20
_U = np.uint64
_START = _U(0x5851F42D4C957F2D)
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32


def plain(c: Chunk) -> Chunk:
    """The same texts with A-Z lowered and ASCII marks turned into spaces, so that words are bare."""
    return Chunk(c.first, _PLAIN[c.data], c.off)


def pairs(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the word before each word (of a start mark for the first of a text), and of the two together."""
    prev = np.empty_like(word)
    prev[1:] = word[:-1]
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    prev[first] = _START
    return prev, mix(prev * _U(3) + word)


@dataclass
class Slots:
    """A table from 64-bit keys to three numbers, filled once by linear probing."""

    key: np.ndarray
    value: np.ndarray
    reach: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray, default: float) -> "Slots":
        size = 1 << max(10, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        keys = np.maximum(keys, _U(1))  # 0 marks a free place
        table = np.zeros(size, _U)
        out = np.full((size, 3), default, np.float32)
        left, step = np.arange(len(keys)), 0
        while len(left):
            at = ((keys[left] + _U(step)) & _U(size - 1)).astype(np.int64)
            free = table[at] == 0
            _, one = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[one]
            table[at[put]], out[at[put]] = keys[left[put]], values[left[put]]
            left = np.delete(left, put)
            step += 1
        return cls(table, np.concatenate([out, np.full((1, 3), default, np.float32)]), step)

    def get(self, keys: np.ndarray) -> np.ndarray:
        size = len(self.key)
        found = np.full(len(keys), size)
        left = np.arange(len(keys))
        for step in range(self.reach):
            at = ((keys[left] + _U(step)) & _U(size - 1)).astype(np.int64)
            got = self.key[at]
            hit = got == keys[left]
            found[left[hit]] = at[hit]
            left = left[~hit & (got != 0)]
            if not len(left):
                break
        return self.value[found]


@dataclass
class KneserNey:
    """Discounted shares and backoff weights in the columns toxic, ordinary, shared.

    A word after another: class pairs, then shared pairs, then the words of the class by their distinct left neighbours.
    ``word`` holds the finished probabilities of words; a word that no class has seen has ``floor`` in both.
    """

    pair: Slots
    context: Slots
    word: Slots

    def shares(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each word of a plain chunk after its left neighbour, toxic and ordinary."""
        w = c.word_hash
        prev, both = pairs(w, c.words[2])
        one, two, g = self.word.get(w), self.pair.get(both), self.context.get(prev)
        p, q = (two[:, k] + g[:, k] * (two[:, 2] + g[:, 2] * one[:, k]) for k in (0, 1))
        return p, q

    def llr(self, c: Chunk) -> np.ndarray:
        """Log-likelihood difference (toxic minus ordinary) of each word of a plain chunk."""
        p, q = self.shares(c)
        return np.log(p) - np.log(q)


def _sums(keys: np.ndarray, label: np.ndarray, add: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of ``add`` in the columns toxic, ordinary, both."""
    out, inv = np.unique(keys, return_inverse=True)
    t = np.bincount(inv, weights=add * (label == 1), minlength=len(out))
    o = np.bincount(inv, weights=add * (label == 0), minlength=len(out))
    return out, np.column_stack([t, o, t + o])


def kneser_ney(word: np.ndarray, doc: np.ndarray, label: np.ndarray) -> KneserNey:
    """Models from word hashes with their document numbers and the class (1 toxic) of each document."""
    y = label[doc]
    prev, both = pairs(word, doc)
    pair, one = np.unique(both, return_index=True)
    _, n2 = _sums(both, y, np.ones(len(both)))
    v, w = prev[one], word[one]
    ctx, inv = np.unique(v, return_inverse=True)
    total = np.column_stack([np.bincount(inv, weights=n2[:, k], minlength=len(ctx)) for k in range(3)])
    alpha2 = np.maximum(n2 - DISCOUNT, 0) / np.maximum(total[inv], 1)
    often = n2[:, 2] >= PAIR_COUNT
    alpha2[~often] = 0
    gamma = 1 - np.column_stack([np.bincount(inv, weights=alpha2[:, k], minlength=len(ctx)) for k in range(3)])
    kept = np.unique(inv[often])
    # words by distinct left neighbours: a passage that is copied a thousand times counts once
    words, inv = np.unique(w, return_inverse=True)
    left = np.column_stack([np.bincount(inv, weights=n2[:, k] > 0, minlength=len(words)) for k in range(3)])
    floor = 1 / max(1000, 2 * len(words))
    return KneserNey(Slots.of(pair[often], alpha2[often], 0.0), Slots.of(ctx[kept], gamma[kept], 1.0),
                     Slots.of(words, word_shares(left, floor), floor * UNSEEN))


def word_shares(left: np.ndarray, floor: float) -> np.ndarray:
    """Probabilities of words from their distinct left neighbours in both classes and over both (the last column).

    Words are put in bins by the power of two of the shared count. A class gives the words of a bin, in proportion to their
    shared counts, what discounting took from its own words there; a bin that it has not seen gets a half discount."""
    _, of = np.unique(np.log2(left[:, 2]).astype(int), return_inverse=True)
    shared = np.bincount(of, weights=left[:, 2])
    out = np.zeros((len(left), 3))
    for k in range(3):
        taken = DISCOUNT * np.maximum(np.bincount(of, weights=left[:, k] > 0), 0.5)
        mass = np.maximum(left[:, k] - DISCOUNT, 0) + taken[of] * left[:, 2] / shared[of]
        out[:, k] = mass / max(1, mass.sum())
    return out * (1 - UNSEEN) + floor * UNSEEN


@dataclass
class ToxicModel:
    lm: KneserNey
    line: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def score(self, c: Chunk) -> np.ndarray:
        x = (features(self.lm, c) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.line[:-1] + self.line[-1], -30, 30)))


def features(lm: KneserNey, c: Chunk) -> np.ndarray:
    """For each text: mean difference per word, share and number of strongly toxic words, and the strongest words. The
    last four do not thin out in a long text."""
    c = plain(c)
    start, _, doc = c.words
    out = np.zeros((c.n, 3 + TOP))
    if not len(start):
        return out
    s = lm.llr(c)
    count = np.bincount(doc, minlength=c.n)
    first, some = np.cumsum(count) - count, count > 0
    strong = np.bincount(doc, weights=s > STRONG, minlength=c.n)
    out[:, 0] = np.bincount(doc, weights=s, minlength=c.n) / np.maximum(1, count)
    out[:, 1] = np.sqrt(strong / np.maximum(1, count))
    out[:, 2] = np.log1p(strong)
    for k in range(TOP):  # the strongest word, then the strongest of the rest
        top = np.full(c.n, -4.0)
        top[some] = np.maximum.reduceat(s, first[some])
        out[count > k, 3 + k] = np.clip(top[count > k], -4, 8)
        hit = np.flatnonzero(s == top[doc])
        _, one = np.unique(doc[hit], return_index=True)
        s[hit[one]] = -9.0
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset of a logistic line in which more toxic evidence never lowers the score: columns whose weight
    would be negative are left out."""
    use = np.arange(x.shape[1])
    while True:
        z = np.column_stack([x[:, use], np.ones(len(x))])
        ridge = np.array([RIDGE] * len(use) + [0.01])
        w = np.zeros(len(ridge))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        if (w[:-1] >= 0).all():
            out = np.zeros(x.shape[1] + 1)
            out[use], out[-1] = w[:-1], w[-1]
            return out
        use = np.delete(use, w[:-1].argmin())


def fit(texts: pa.ChunkedArray, y: np.ndarray, prior: float) -> ToxicModel:
    """Language models from two thirds of the rows, the calibrated line from the others."""
    held = np.arange(len(y)) % 3 == 2
    words, docs = [], []
    for c in chunks(texts.filter(pa.array(~held)), CHUNK):
        c = plain(c)
        words.append(c.word_hash)
        docs.append(c.words[2] + c.first)
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    lm = kneser_ney(cat(words, _U), cat(docs, np.int64), y[~held])
    rest = texts.filter(pa.array(held)) if held.any() else texts
    yr = y[held] if held.any() else y
    x = np.concatenate([features(lm, c) for c in chunks(rest, CHUNK)])
    mean, spread = x.mean(0), x.std(0) + 1e-6
    line = _logistic((x - mean) / spread, yr.astype(float))
    got = np.clip(yr.mean(), 0.001, 0.999)  # the classes are sampled by themselves: back to their true shares
    line[-1] += np.log(prior / (1 - prior)) - np.log(got / (1 - got))
    return ToxicModel(lm, line, mean, spread)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 rows: int = FIT_ROWS) -> ToxicModel | None:
    """Model from at most ``rows`` documents of each class, those with the smallest id hashes; None without labels.
    Rows with a null id or label and ids with both labels are no examples; a null text is an empty one."""
    l = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    l = l.where("__id is not null and __y in (0, 1)").groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z"))
    l = l.where("__y = __z").drop("__z")
    shares = {r["__y"]: r["count"] for r in l.groupBy("__y").count().collect()}
    prior = min(0.99, max(0.01, shares.get(1, 0) / max(1, sum(shares.values()))))
    sample = smallest(l.where("__y = 1"), "__id", rows).unionByName(smallest(l.where("__y = 0"), "__id", rows))
    pairs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(sample), "__id")

    def task(t: pa.Table) -> bytes:
        ids = np.asarray(t["__id"])
        order = np.lexsort((ids, mix(ids.astype(np.int64).view(_U))))
        t = t.take(pa.array(order))
        return pickle.dumps(fit(t["__t"].combine_chunks().cast(pa.large_string()), np.asarray(t["__y"]).astype(np.int64), prior))

    blob = in_one_task(pairs, task)
    return pickle.loads(blob) if blob else None


def score_toxicity(docs: DataFrame, model: ToxicModel | None, text_col: str = "text", threshold: float = THRESHOLD,
                   keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``score`` (0 to 1) and ``predicted``, which replace columns of those names.

    Null and empty texts get the score of a text without words. Without a model every score is 0. Each of repeated rows
    is scored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(b: pa.RecordBatch) -> dict:
        got = [shared.value.score(c) if shared.value is not None else np.zeros(c.n) for c in chunks(b.column(text_col), CHUNK)]
        score = np.concatenate(got) if got else np.zeros(0)
        return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    return add_columns(docs, [text_col], "score double, predicted int", make, keep)


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 4) != 2)
    scored = score_toxicity(docs, fit_toxicity(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
