"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.session import scratch_path

#: glibc's release of free heap memory, where there is one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: ASCII white space, the characters that separate words in the contracts.
WHITE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a table that every executor can read, so losing an
    executor never recomputes what came before. The shuffle files behind it are
    of no more use; Spark's cleaner drops them once the driver collects its
    garbage, which is asked for here, so that one step's files don't add to the
    next one's.
    """
    spark = df.sparkSession
    path, schema = scratch_path(spark, name), df.schema
    df.write.parquet(path)
    del df
    _collect(spark)
    return spark.read.schema(schema).parquet(path)


def _collect(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Return a worker's free memory to the system: workers stay for other
    tasks, beside those of the next step."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    if _TRIM:
        _TRIM(0)


def release(*tables: DataFrame) -> None:
    """Remove scratch tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if "/aurum-scratch/" in folder:
                path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        _collect(tables[0].sparkSession)


def neutral(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with the named columns under these names and every other column
    under a name of its place, so that none meets a column that an operator
    adds; and a function that gives a result of it the given names again, in the
    given order, followed by columns that it is told to keep (which stand in for
    given ones of the same name)."""
    at = {}
    for name in names:
        found = [i for i, c in enumerate(docs.columns) if c == name] or [i for i, c in enumerate(docs.columns) if c.lower() == name.lower()]
        if len(found) != 1:
            raise ValueError(f"{len(found)} columns named {name} among {docs.columns}")
        at[found[0]] = name
    own = [at.get(i, f"given {i}") for i in range(len(docs.columns))]

    def restore(df: DataFrame, *added: str) -> DataFrame:
        new = {a.lower() for a in added}
        given = [F.col(f"`{o}`").alias(c) for o, c in zip(own, docs.columns) if c.lower() not in new]
        return df.select(*given, *added)
    return docs.toDF(*own), restore


def columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever the other columns are called. A name
    means the column of just that name, or the one that differs in case only."""
    return neutral(docs, *names)[0].select(*names)


def document_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` only: extra columns, whatever their
    names, never meet the columns an operator adds."""
    return columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_slices(texts: list, max_chars: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of a batch holding about ``max_chars`` characters each (one text
    at least), so that what a task builds at a time is bounded."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that few rows are
    Python objects at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


_MASK = (1 << 64) - 1


def _mix(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE.encode())] = True
_BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at a time (cut between words).
_HASH_BLOCK = 1 << 20
_tables: dict = {}


def _byte_values(fold: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with ``fold`` A-Z have those of a-z."""
    if fold not in _tables:
        with np.errstate(over="ignore"):
            v = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        if fold:
            v[65:91] = v[97:123]
        _tables[fold] = v
    return _tables[fold]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = _tables.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, _HASH_BLOCK + 1)
        with np.errstate(over="ignore"):
            have = tuple(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(x))]).cumprod(dtype=np.uint64)
                         for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        if size <= 2 * _HASH_BLOCK:
            _tables["powers"] = have
    return have


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def folded(text: str | None) -> bytes:
    """The words of a text in lower case (A-Z only), joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split()) if text else b""


def word_hashes(text: str | None, fold: bool = False) -> np.ndarray:
    """A 64-bit hash per word of the whole text, in order.

    Prefix sums of byte values times powers give each word's polynomial at
    once; dividing by the power of its start makes it independent of its place.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) if text else np.empty(0, np.uint8)
    out, at = [], 0
    while at < len(data):
        end = at + _HASH_BLOCK
        if end < len(data):
            white = np.flatnonzero(_IS_WHITE[data[at:end]])
            if len(white):
                end = at + int(white[-1]) + 1
            else:  # a word longer than a block
                while end < len(data) and not _IS_WHITE[data[end]]:
                    end += 1
        part = data[at:end]
        edges = np.flatnonzero(np.diff(_IS_WHITE[part].view(np.int8), prepend=1, append=1))
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            power, inverse = _powers(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(_byte_values(fold)[part] * power[:len(part)], out=sums[1:])
                h = (sums[ends] - sums[starts]) * inverse[starts]
                out.append(mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def word_windows(texts: list, n: int, *, fold: bool = False, seeds: tuple[int, ...] = (0,)) -> Iterator[list[np.ndarray]]:
    """For each text the hashes of its words and, per seed, of its runs of
    ``n`` words. Short texts are hashed together, a block at a time."""
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo] or "")
        while hi < len(texts) and size + len(texts[hi] or "") < _HASH_BLOCK // 4:
            size += len(texts[hi] or "") + 1
            hi += 1
        group = [t or "" for t in texts[lo:hi]]
        words = word_hashes("\n".join(group), fold)
        if len(group) == 1:
            counts = [len(words)]
        else:
            # Words up to the end of each text: those that start before it ends.
            data = "\n".join(group).encode("utf-8", "surrogatepass")
            white = _IS_WHITE[np.frombuffer(data, np.uint8)]
            before = np.cumsum(~white & np.concatenate([[True], white[:-1]]))
            ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in group]) - 1
            counts = np.diff(np.concatenate([[0], np.concatenate([[0], before])[ends]])).tolist()
        windows = [window_hashes(words, n, s) for s in seeds]
        at = 0
        for c in counts:
            last = at + max(0, c - n + 1)
            yield [words[at:at + c], *(w[at:last] for w in windows)]
            at += c
        lo = hi


def window_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each run of ``n`` consecutive word hashes.

    Each word is multiplied by an odd constant of its place and mixed, so the
    order of words matters; the sum wraps modulo 2**64.
    """
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            c = np.uint64(_mix((seed * 1000003 + k + 1) * 0x9E3779B97F4A7C15 & _MASK) | 1)
            part = words[k:k + m] * c
            total += part ^ (part >> np.uint64(29))
        return mix64(total)
