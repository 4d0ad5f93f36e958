"""Quality rules: hashed word and character n-gram logistic regression, calibrated, over fixed base rules.

``score_quality`` is one pass without a shuffle. The classifier is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import add_columns, in_one_task, smallest, table
from sampleloom.llm.registry import query
from sampleloom.llm.textnum import SPACE, Chunk, chunks, mix, repeats

#: Most labelled rows the classifier is fitted on.
FIT_ROWS = 3000
#: A document is kept if its probability of good quality is at least this.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEATED = 10, 20
BITS = 18
WINDOW = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_U = np.uint64


def base_counts(c: Chunk) -> dict[str, np.ndarray]:
    """Counts of the fixed rules for each text of a chunk."""
    start, end, doc = c.words
    n_words = np.bincount(doc, minlength=c.n)
    solid = ~SPACE[c.data]
    chars = c.per_text(solid & ((c.data & 0xC0) != 0x80))
    symbols = c.per_text(_SYMBOL[c.data])
    out = {"n_words": n_words, "word_chars": chars, "n_symbols": symbols}

    breaks = np.flatnonzero(c.data == 10)
    line_start = np.concatenate([c.off[:-1], breaks + 1])
    line_doc = np.concatenate([np.arange(c.n), c.text_of(breaks)]) if len(breaks) else np.arange(c.n)
    order = np.lexsort((line_start, line_doc))
    line_start, line_doc = line_start[order], line_doc[order]
    line_end = np.empty_like(line_start)
    line_end[:-1] = line_start[1:] - 1
    last = np.ones(len(line_doc), bool)
    last[:-1] = line_doc[1:] != line_doc[:-1]
    line_end[last] = c.off[1:][line_doc[last]]
    filled = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    has = filled[line_end] > filled[line_start]
    s, e, d = line_start[has], line_end[has], line_doc[has]
    later, _ = repeats(mix(c.hashes(s, e) + d.astype(_U) * _U(0xD6E8FEB86659FD93)))
    out["n_dup_lines"] = np.bincount(d[later], minlength=c.n)

    repeated = np.zeros(c.n, np.int64)
    if len(start) >= WINDOW:
        h = c.word_hash
        at = np.flatnonzero(doc[:len(doc) - WINDOW + 1] == doc[WINDOW - 1:])
        key = mix(doc[at].astype(_U) + _U(77))
        for j in range(WINDOW):
            key = mix(key + h[at + j])
        _, again = repeats(key)
        cover = np.zeros(len(start) + 1, np.int64)
        cover[at[again]] += 1
        cover[at[again] + WINDOW] -= 1
        inside = np.cumsum(cover)[:-1] > 0
        repeated = np.bincount(doc[inside], minlength=c.n)
    out["n_repeat_words"] = repeated
    return out


def _word_ids(c: Chunk) -> np.ndarray:
    return (c.word_hash >> _U(64 - BITS)).astype(np.int64)


def _char_ids(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams and whether each lies in one text."""
    x = c.data.astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    ids = (((x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    inside = np.ones(len(ids), bool)
    for k in (1, 2):
        cut = c.off[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(ids))]] = False
    return ids, inside


@dataclass
class QualityModel:
    """Weights of hashed words and byte trigrams (mean over a text), bias, and the calibration line."""

    word: np.ndarray
    char: np.ndarray
    bias: float
    scale: float
    shift: float

    def raw(self, c: Chunk) -> np.ndarray:
        start, _, doc = c.words
        w = np.bincount(doc, weights=self.word[_word_ids(c)], minlength=c.n) / np.maximum(1, np.bincount(doc, minlength=c.n))
        ids, inside = _char_ids(c)
        v = np.zeros(len(c.data))
        v[:len(ids)] = np.where(inside, self.char[ids], 0)
        return self.bias + w + c.per_text(v) / np.maximum(1, np.diff(c.off))

    def probability(self, c: Chunk) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(c) + self.shift, -30, 30)))


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a calibrated probability, with smoothed targets so that one class alone works."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, w = t - p, np.maximum(p * (1 - p), 1e-9)
        h11, h12, h22 = (w * z * z).sum() + 1e-3, (w * z).sum(), w.sum() + 1e-6
        g1, g2 = (g * z).sum() - 1e-3 * (a - 1), g.sum()
        det = h11 * h22 - h12 * h12
        da, db = (h22 * g1 - h12 * g2) / det, (h11 * g2 - h12 * g1) / det
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
    return float(a), float(b)


def fit(texts: pa.ChunkedArray, y: np.ndarray, steps: int = 80) -> QualityModel:
    """Logistic regression by Adam on three quarters of the rows, calibrated on the others."""
    size, row, idx, val, first = 1 << BITS, [], [], [], 0
    for c in chunks(texts):
        _, _, doc = c.words
        ids, inside = _char_ids(c)
        at = c.text_of(np.flatnonzero(inside))
        for d, i, n, base in ((doc, _word_ids(c), np.bincount(doc, minlength=c.n), 0), (at, ids[inside], np.diff(c.off), size)):
            key, count = np.unique(d.astype(np.int64) << 20 | i, return_counts=True)
            row.append((key >> 20) + c.first)
            idx.append((key & ((1 << 20) - 1)) + base)
            val.append(count / np.maximum(1, n[key >> 20]))
    row, idx, val = np.concatenate(row), np.concatenate(idx), np.concatenate(val)
    held = np.arange(len(y)) % 4 == 3
    if len(y) < 8:
        held[:] = True
    train = ~held if (~held).any() else np.ones(len(y), bool)
    use = train[row]
    r, i, v = row[use], idx[use], val[use]
    w, m, s = np.zeros(2 * size), np.zeros(2 * size), np.zeros(2 * size)
    prior = np.clip(y[train].mean(), 0.01, 0.99)
    b = float(np.log(prior / (1 - prior)))
    n = train.sum()
    for k in range(1, steps + 1):
        z = b + np.bincount(r, weights=v * w[i], minlength=len(y))
        g = np.where(train, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0) / n
        grad = np.bincount(i, weights=v * g[r], minlength=2 * size) + 1e-8 * w
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        w -= 1.0 * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.99 ** k)) + 1e-9)
        b -= 0.5 * g.sum()
    z = b + np.bincount(row, weights=val * w[idx], minlength=len(y))
    scale, shift = platt(z[held], y[held])
    return QualityModel(w[:size].astype(np.float32), w[size:].astype(np.float32), b, scale, shift)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                rows: int = FIT_ROWS) -> QualityModel | None:
    """Model from at most ``rows`` labelled rows (those with the smallest id hash). None without labelled rows.
    Rows with a null id or label are no examples; a null text is an empty one."""
    l = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y is not null")
    sample = smallest(l.dropDuplicates(["__id"]), "__id", rows)
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    pairs = d.join(F.broadcast(sample), "__id")

    def task(t: pa.Table) -> bytes:
        order = np.argsort(np.asarray(t["__id"]), kind="stable")
        t = t.take(pa.array(order))
        return pickle.dumps(fit(t["__t"], np.asarray(t["__y"]).astype(float)))

    blob = in_one_task(pairs, task)
    return pickle.loads(blob) if blob else None


SCORED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "quality_score double, kept boolean")


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", threshold: float = THRESHOLD,
                  keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with the columns of ``SCORED``; those replace columns of the same names.

    A null or empty text has no words and fails the base rules. Without a model the score is 1 and the base rules
    decide alone. Repeated rows are scored each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(b: pa.RecordBatch) -> dict:
        parts: dict[str, list] = {}
        for c in chunks(b.column(text_col)):
            got = base_counts(c)
            got["quality_score"] = shared.value.probability(c) if shared.value is not None else np.ones(c.n)
            for k, v in got.items():
                parts.setdefault(k, []).append(v)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "quality_score")
        out = {k: np.concatenate(parts[k]) if k in parts else np.zeros(0) for k in names}
        n = out["n_words"]
        out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED * n)
        out["kept"] = ~out["base_failed"] & (out["quality_score"] >= threshold)
        return out

    return add_columns(docs, [text_col], SCORED, make, keep)


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, keep=["doc_id"])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the quality rules keep."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    plain = docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))])  # no name of a result is in the way
    marked = score_quality(plain, model, text_col=f"column_{docs.columns.index('text')}")
    return marked.where("kept").select(*[F.col(p).alias(c) for p, c in zip(plain.columns, docs.columns)])
