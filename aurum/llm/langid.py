"""Language ID by hyperdimensional profiles (operator 9).

Every letter has a fixed random vector of +1 and -1 drawn from its code
point. A trigram's vector binds its letters: the elementwise product of their
vectors, each rotated by its place, so order matters. A text's vector bundles
(sums) the vectors of its trigrams; a language's prototype bundles its
training texts, each weighted to the same total. The prediction is the
prototype with the largest cosine to the text's vector.

Training sums integers on the executors, element by element, so the
prototypes do not depend on the order of rows or tasks; only the prototypes
(languages x dimensions) reach the driver and the prediction tasks, a size
bounded by ``max_languages``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import columns_of, give_back, mix64, neutral, text_slices

DIMENSIONS = 1024
#: Trigrams whose bound vectors a task keeps (16,384 x 1,024 x 4 bytes = 64 MB).
BANK = 16_384
#: Each training text counts this much in all, dealt out over its trigrams: more than
#: any text has of them, and two billion texts stay within 64 bits.
TEXT_WEIGHT = 1 << 32
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Which code points are letters, once a process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (three code points of 21 bits) of the letters of a
    whole text and their counts. Letters are lower-cased; each run of other
    characters counts as one blank, and so do both ends."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.where(_is_letter()[c], c, 0).astype(np.int64)
    if not c.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.concatenate([[0], c, [0]])
    keep = c != 0
    keep[1:] |= c[:-1] != 0
    keep[0] = True
    c = c[keep]
    return np.unique((c[:-2] << 42) | (c[1:-1] << 21) | c[2:], return_counts=True)


class Bank:
    """Bound vectors of trigrams, made when first met; at most ``limit`` kept."""

    def __init__(self, dimensions: int = DIMENSIONS, limit: int = BANK):
        self.dimensions, self.limit = dimensions, limit
        self._letter: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self._keys = np.empty(0, np.int64)
        self._rows = np.empty(0, np.int64)
        self._vectors = np.empty((self.limit, self.dimensions), np.float32)
        self._used = 0

    def letter(self, code: int) -> np.ndarray:
        v = self._letter.get(code)
        if v is None:
            if len(self._letter) > 4096:
                self._letter.clear()
            words = np.arange(self.dimensions // 64, dtype=np.uint64) + np.uint64(code * 1_000_003 + 1)
            with np.errstate(over="ignore"):
                bits = np.unpackbits(mix64(words * np.uint64(0x9E3779B97F4A7C15)).view(np.uint8))
            v = self._letter[code] = bits.astype(np.int8) * 2 - 1
        return v

    def bind(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self._keys, keys)
        return (at < len(self._keys)) & (self._keys[np.minimum(at, len(self._keys) - 1)] == keys) if len(self._keys) else np.zeros(len(keys), bool)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors of ``keys`` (distinct, ascending), each times its count."""
        if len(keys) > self.limit // 2:  # more than fits: in parts
            half = len(keys) // 2
            return self.bundle(keys[:half], counts[:half]) + self.bundle(keys[half:], counts[half:])
        new = keys[~self._find(keys)]
        if self._used + len(new) > self.limit:
            self._clear()
            new = keys
        if len(new):
            for i, k in enumerate(new.tolist()):
                self._vectors[self._used + i] = self.bind(k)
            self._rows = np.concatenate([self._rows, np.arange(self._used, self._used + len(new))])
            self._keys = np.concatenate([self._keys, new])
            order = np.argsort(self._keys, kind="stable")
            self._keys, self._rows = self._keys[order], self._rows[order]
            self._used += len(new)
        rows = self._rows[np.searchsorted(self._keys, keys)]
        return counts.astype(np.float32) @ self._vectors[rows]


def learn(training: DataFrame, *, dimensions: int = DIMENSIONS, max_languages: int = 1024) -> dict[str, np.ndarray]:
    """One prototype per language of ``training`` (columns ``text, lang``),
    from every row. Rows with a null lang, or whose text is null or holds no
    letter, teach nothing."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bank = Bank(dimensions)
        weights: dict[str, dict[int, int]] = {}
        pending: dict[str, list] = {}

        def fold(lang: str) -> None:
            keys, inverse = np.unique(np.concatenate([k for k, _ in pending[lang]]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, inverse, np.concatenate([w for _, w in pending[lang]]))
            pending[lang] = [(keys, sums)]

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys, counts = trigrams(text)
                if not len(keys):
                    continue
                own = pending.setdefault(lang, [])
                own.append((keys, counts * TEXT_WEIGHT // counts.sum()))
                if len(own) >= 512:
                    fold(lang)
        for lang in pending:
            fold(lang)
            keys, sums = pending[lang][0]
            total = np.zeros(dimensions, np.int64)
            for i in range(0, len(keys), 4096):
                rows = np.array([bank.bind(k) for k in keys[i:i + 4096].tolist()], dtype=np.int64)
                total += sums[i:i + 4096] @ rows
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "vector": pa.array([total.tolist()], pa.list_(pa.int64()))})
        give_back()

    parts = (training.where("lang is not null").select("text", "lang")
             .mapInArrow(bundles, "lang string, vector array<long>"))
    # At most one partial vector per task and language is summed per element.
    sums = (parts.select("lang", F.posexplode("vector").alias("i", "v"))
            .groupBy("lang", "i").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("vector")))
    rows = sums.limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    return {r["lang"]: np.array([x["v"] for x in r["vector"]], dtype=np.float64) for r in rows}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], *, dimensions: int = DIMENSIONS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (cosine, 0 to 1) appended.

    A null text, a text without letters and an empty model give ``und`` with
    score 0. Equal cosines give the language first in alphabetical order.
    Columns of ``docs`` with those two names are replaced; any other, whatever
    its name, is unchanged.
    """
    langs = sorted(prototypes)
    matrix = np.array([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-12) for k in langs], dtype=np.float32)
    own, restore = neutral(docs, "text")
    at = own.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bank = Bank(dimensions)
        for b in batches:
            texts = b.column(at).to_pylist()
            for lo, hi in text_slices(texts):
                best, scores = [], []
                for text in texts[lo:hi]:
                    keys, counts = trigrams(text) if langs else ((), ())
                    if not len(keys):
                        best.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    v = bank.bundle(keys, counts)
                    cosines = matrix @ v / max(float(np.linalg.norm(v)), 1e-12)
                    k = int(cosines.argmax())
                    best.append(langs[k])
                    scores.append(min(1.0, max(0.0, float(cosines[k]))))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*part.schema.names, "lang_pred", "score"])
        give_back()

    fields = ", ".join(f"`{c}` {t}" for c, t in own.dtypes)
    return restore(own.mapInArrow(run, f"{fields}, lang_pred string, score double"), "lang_pred", "score")


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 modulo 3. A null id is neither
    held out nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id, text, held_out, lang_pred, score`` for every row of ``docs``
    (columns ``doc_id, text, lang``; others are ignored), learned from the rows
    that are not held out. An empty table gives an empty result; repeated rows
    are predicted one by one."""
    own = columns_of(docs, "doc_id", "text", "lang").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                                            F.col("lang").cast("string").alias("lang"))
    prototypes = learn(own.where(F.col("doc_id").isNotNull() & ~held_out()), dimensions=dimensions)
    return predict(own.select("doc_id", "text", held_out().alias("held_out")), prototypes, dimensions=dimensions)
