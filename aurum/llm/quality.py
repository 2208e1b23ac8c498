"""Quality classifier: ordinal cumulative-link regression (operator 3).

Graded ratings 0 < 1 < ... < K-1 are modelled by one weight per hashed text
feature, shared by all grades, and ordered thresholds:
``P(grade >= k) = sigmoid(w . x - threshold_k)``. The model gives each document
its expected grade and the tail probability used for selection.

Features of a whole text are its words (lower-cased letters and digits), their
first four letters, and their shapes (letters, capitals, digits, other signs),
hashed to ``2**bits`` places. Counts are damped by a logarithm and weighted by
rarity among the training rows; places that fewer than ``min_rows`` of them
hold count nothing, so no weight rests on a handful of texts. The vector is
scaled to length one.

The model is fitted on a bounded sample of the labelled rows: the
``max_training_rows`` of smallest hashed id, a choice that does not depend on
partitioning. Their sparse features are made on the executors; only they reach
the driver. Every document is scored, in a map over the table's partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import document_columns, text_slices

BITS = 18
MAX_TRAINING_ROWS = 6_000
MIN_ROWS = 5
_OTHER = re.compile(r"[\W_]+")
_CLASSES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"[^\W\dX_]+"), "x"), (re.compile(r"\d+"), "9"))


def shape(word: str) -> str:
    for pattern, sign in _CLASSES:
        word = pattern.sub(sign, word)
    return word[:16]


class Features:
    """Hashed sparse features of texts, with a bounded memory of words."""

    def __init__(self, bits: int = BITS, limit: int = 300_000):
        self._mask, self._limit = (1 << bits) - 1, limit
        self._known: dict[str, tuple[int, int, int]] = {}

    def _codes(self, word: str) -> tuple[int, int, int]:
        """Places of the word, its beginning and its shape."""
        core = _OTHER.sub("", word.lower())
        return tuple(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), k) & self._mask
                     for k, x in enumerate((core, core[:4], shape(word))))

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if not text:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        if len(self._known) > self._limit:
            self._known.clear()
        known, out = self._known, []
        for w in text.split():
            c = known.get(w)
            if c is None:
                c = known[w] = self._codes(w)
            out += c
        if not out:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        places, counts = np.unique(np.array(out, dtype=np.int32), return_counts=True)
        return places, (1 + np.log(counts)).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    rarity: np.ndarray  # per place; 0 where too few training rows hold it
    thresholds: np.ndarray  # ascending; one less than grades
    bits: int

    def score(self, places: np.ndarray, values: np.ndarray) -> float:
        v = values * self.rarity[places]
        return float(self.weights[places] @ v) / max(float(np.linalg.norm(v)), 1e-12)

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -30, 30)))


def fit(rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, n_grades: int, *, bits: int = BITS,
        min_rows: int = MIN_ROWS, steps: int = 200, rate: float = 0.3, penalty: float = 1e-4) -> Model:
    """Maximum likelihood by full-batch Adam; each grade counts the same in all."""
    size = 1 << bits
    lengths = np.array([len(r) for r in rows])
    index, x = np.concatenate(rows), np.concatenate(values).astype(np.float64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    held = np.bincount(index, minlength=size)
    rarity = np.where(held >= min_rows, np.log((len(rows) + 1) / np.maximum(held, 1)), 0).astype(np.float32)
    x *= rarity[index]
    x /= np.maximum(np.sqrt(np.bincount(owner, x * x, minlength=len(rows))), 1e-12)[owner]
    some = x != 0
    index, x, owner = index[some], x[some], owner[some]
    used, local = np.unique(index, return_inverse=True)
    counts = np.bincount(grades, minlength=n_grades)
    weight = (1 / np.maximum(counts, 1))[grades] / max((counts > 0).sum(), 1)
    w = np.zeros(len(used))
    # The thresholds are the first one and the logarithms of their steps, so they stay ordered.
    raw = np.concatenate([[-0.5], np.zeros(n_grades - 2)])
    m = [np.zeros_like(w), np.zeros_like(raw)]
    v = [np.zeros_like(w), np.zeros_like(raw)]
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        steps_ = np.exp(raw[1:])
        th = np.concatenate([[-np.inf], raw[:1], raw[0] + np.cumsum(steps_), [np.inf]])
        s = np.bincount(owner, w[local] * x, minlength=len(rows))
        low, high = th[grades], th[grades + 1]
        above, over = sig(s - low), np.where(np.isinf(high), 0, sig(s - np.where(np.isinf(high), 0, high)))
        above = np.where(np.isinf(low), 1, above)
        p = np.maximum(above - over, 1e-9)
        ds = weight * (1 - above - over)
        dlow = -weight * above * (1 - above) / p
        dhigh = weight * over * (1 - over) / p
        dth = np.bincount(grades, dlow, minlength=n_grades + 1)[:n_grades + 1]
        dth = dth + np.concatenate([[0], np.bincount(grades, dhigh, minlength=n_grades)])
        dth = dth[1:n_grades]
        draw = np.concatenate([[dth.sum()], [dth[k + 1:].sum() * steps_[k] for k in range(n_grades - 2)]])
        grad = [np.bincount(local, ds[owner] * x, minlength=len(used)) - penalty * w, draw]
        for k, (param, g) in enumerate(zip((w, raw), grad)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            param += rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return Model(weights, rarity, raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))]), bits)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, *, bits: int = BITS,
          max_training_rows: int = MAX_TRAINING_ROWS, min_rows: int = MIN_ROWS) -> Model | None:
    """Fit on a bounded sample of ``ratings`` (``doc_id, grade``); None if no
    rated document has a text. Ratings of one document that differ count as the
    lowest; null grades and grades out of range teach nothing; of several rows
    with one doc_id the text of the smallest hash teaches."""
    spark = docs.sparkSession
    rated = (ratings.where(F.col("grade").between(0, n_grades - 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("grade").cast("int").alias("grade")).where("doc_id is not null"))
    ids = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training_rows).collect()
    if not ids:
        return None
    chosen = spark.createDataFrame([(r["doc_id"], r["grade"]) for r in ids], "doc_id long, grade int")
    own = document_columns(docs)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features(bits)
        for b in batches:
            made = [f(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "grade": b.column("grade"), "places": pa.array([p.tobytes() for p, _ in made], pa.binary()),
                "x": pa.array([v.tobytes() for _, v in made], pa.binary())})

    # The ids are at most max_training_rows: a bounded broadcast. An id that many
    # rows carry teaches by one of them, so what is collected is bounded, too.
    one = (own.where("text is not null and text != ''").join(F.broadcast(chosen), "doc_id")
           .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "grade")).alias("r")))
    rows = (one.select("doc_id", "r.grade", "r.text").mapInArrow(features, "doc_id long, grade int, places binary, x binary").collect())
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["places"])))
    rows = [r for r in rows if len(r["places"])]
    if not rows:
        return None
    return fit([np.frombuffer(r["places"], np.int32) for r in rows], [np.frombuffer(r["x"], np.float32) for r in rows],
               np.array([r["grade"] for r in rows]), n_grades, bits=bits, min_rows=min_rows)


def score(docs: DataFrame, model: Model | None, n_grades: int, *, keep_grade: int = 2, keep_probability: float = 0.25) -> DataFrame:
    """``doc_id, expected_grade, p_at_least array<double>`` (for grades 1, 2,
    ...) ``, kept`` for every row.

    ``kept``: the tail probability of ``keep_grade`` is at least
    ``keep_probability``. Null and empty texts, and every text where there is no
    model, have expected grade and probabilities null and are not kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 x 2**bits numbers
    own = document_columns(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        f = Features(m.bits) if m else None
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                grades, tails, kept = [], [], []
                for text in texts[lo:hi]:
                    places, x = f(text) if f else ((), ())
                    if not len(places):
                        grades.append(None), tails.append(None), kept.append(False)
                        continue
                    p = m.tails(m.score(places, x))
                    grades.append(float(p.sum()))
                    tails.append(p.tolist())
                    kept.append(bool(p[keep_grade - 1] >= keep_probability))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column(0).slice(lo, hi - lo), "expected_grade": pa.array(grades, pa.float64()),
                    "p_at_least": pa.array(tails, pa.list_(pa.float64())), "kept": pa.array(kept, pa.bool_())})

    return own.mapInArrow(run, "doc_id long, expected_grade double, p_at_least array<double>, kept boolean")


def ratings(labels: DataFrame) -> DataFrame:
    """Graded ratings from the two labels: 0 toxic, 1 low quality, 2 good.
    Null labels count as not toxic and as unrated."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
