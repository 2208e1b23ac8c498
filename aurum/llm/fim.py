"""Fill-in-middle transformation by secondary-sort assembly (operator 11).

A text is cut in three at two places drawn from its id and put together again
in another order: prefix, suffix, middle or suffix, prefix, middle, each part
behind its sentinel. No task ever assembles a text: the documents are emitted
as pieces of at most ``PIECE`` code points with their place in the output,
dealt out by document and sorted by place within each partition, and a task
streams them into an incremental digest. What passes is read back as a reader
of the output would: the sentinels are looked for in the stream, the pieces
behind them get their place in the original, and a second sort within the same
partitions (the documents are already together, so nothing is shuffled again)
streams them into the digest of the restored text.

A document's pieces share a partition but are never held together: both sorts
spill and both digests take one piece at a time, so a text of any length needs
the memory of an Arrow batch, of which few rows are Python objects at a time; a
worker gives its memory back at the end of a task, since two are at work in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import columns_of, give_back, row_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Percent of the texts that are reordered, and of these the share suffix first.
REORDERED, SUFFIX_FIRST = 90, 20
#: Code points of a piece.
PIECE = 8192
#: Code points of the pieces that a task hands on at a time.
BATCH_CHARS = 1 << 20

_PIECES = "doc_id long, print binary, place long, form string, n long, prefix_chars long, middle_chars long, copies long, piece binary"
_PASSED = "doc_id long, print binary, part int, place long, form string, n long, prefix_chars long, middle_chars long, copies long, piece binary"
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
#: The part of the row that ends a document: behind prefix, middle and suffix.
_END = 3


def draw(doc_id: int | None, text: str) -> tuple[str, int, int]:
    """The form of a text and where it is cut; 0, 0 if it stays plain."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not n or h3 % 100 >= REORDERED or any(s in text for s in SENTINELS):
        return "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < SUFFIX_FIRST else "psm"), a, b


def _ranges(form: str, a: int, b: int, n: int) -> list:
    """The output as sentinels and ranges of the text."""
    if form == "plain":
        return [(0, n)]
    head, tail = (PREFIX, (0, a)), (SUFFIX, (b, n))
    first, second = (head, tail) if form == "psm" else (tail, head)
    return [*first, *second, MIDDLE, (a, b)]


def _cut(piece: int):
    """Documents into pieces in output order. Equal rows of a batch are cut
    once and counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies: dict = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = doc_id, text or ""
                copies[key] = copies.get(key, 0) + 1
            rows: list = []
            size = 0
            for (doc_id, text), k in copies.items():
                form, a, b = draw(doc_id, text)
                n, place = len(text), 0
                print_ = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                head = (form, n, None, None) if form == "plain" else (form, n, a, b - a)
                for x in _ranges(form, a, b, n):
                    parts = [x] if isinstance(x, str) else (text[i:min(i + piece, x[1])] for i in range(x[0], x[1], piece))
                    for part in parts:
                        rows.append((doc_id, print_, place, *head, k, part.encode("utf-8", "surrogatepass")))
                        place += 1
                        size += len(part)
                        if size > BATCH_CHARS:
                            yield _batch(rows, _CUT)
                            rows, size = [], 0
                if not place:  # an empty text is one empty piece
                    rows.append((doc_id, print_, 0, *head, k, b""))
            if rows:
                yield _batch(rows, _CUT)
            copies, rows = {}, []
        give_back()
    return run


_LONG, _BYTES, _TEXT = pa.int64(), pa.binary(), pa.string()
_CUT = pa.schema([("doc_id", _LONG), ("print", _BYTES), ("place", _LONG), ("form", _TEXT), ("n", _LONG), ("prefix_chars", _LONG),
                  ("middle_chars", _LONG), ("copies", _LONG), ("piece", _BYTES)])
_PASS = pa.schema([("doc_id", _LONG), ("print", _BYTES), ("part", pa.int32()), ("place", _LONG), ("form", _TEXT), ("n", _LONG),
                   ("prefix_chars", _LONG), ("middle_chars", _LONG), ("copies", _LONG), ("piece", _BYTES)])
_DONE = pa.schema([("doc_id", _LONG), ("n", _LONG), ("form", _TEXT), ("prefix_chars", _LONG), ("middle_chars", _LONG),
                   ("output_sha256", _TEXT), ("restored_sha256", _TEXT)])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order: the digest of each output, and its pieces with
    their place in the original, found by the sentinels in the stream."""
    part_of = {PREFIX.encode(): 0, MIDDLE.encode(): 1, SUFFIX.encode(): 2}
    key = digest = head = None
    last = copies = part = 0
    for b in row_slices(batches):
        rows: list = []
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for doc_id, print_, place, form, n, prefix, middle, k, piece in zip(*columns):
            if (doc_id, print_) != key:
                if key is not None:
                    rows.append((*key, _END, 0, *head, copies, digest.digest()))
                key, head, digest, last, copies, part = (doc_id, print_), (form, n, prefix, middle), hashlib.sha256(), -1, 0, 0
            if place == 0:
                copies += k  # each task's copies begin at 0
            if place == last:
                continue  # the same piece from another task
            last = place
            digest.update(piece)
            if form != "plain" and piece in part_of:
                part = part_of[piece]
            else:
                rows.append((*key, part, place, None, None, None, None, None, piece))
        if rows:
            yield _batch(rows, _PASS)
    if key is not None:
        yield _batch([(*key, _END, 0, *head, copies, digest.digest())], _PASS)
    give_back()


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the original's order: the digest of what was restored."""
    digest = hashlib.sha256()
    for b in row_slices(batches):
        rows: list = []
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for doc_id, _, part, _, form, n, prefix, middle, copies, piece in zip(*columns):
            if part == _END:
                rows += [(doc_id, n, form, prefix, middle, piece.hex(), digest.hexdigest())] * copies
                digest = hashlib.sha256()
            else:
                digest.update(piece)
        if rows:
            yield _batch(rows, _DONE)
    give_back()


def pieces(docs: DataFrame, *, piece: int = PIECE) -> DataFrame:
    """The transformed texts as pieces: ``doc_id, print, place, form, n,
    prefix_chars, middle_chars, copies, piece``. Joined by ``place``, the pieces
    of a ``doc_id, print`` are its output; ``copies`` says how many equal rows of
    a task they stand for."""
    own = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(_cut(piece), _PIECES)


def transform(docs: DataFrame, *, piece: int = PIECE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256``, one row per row of ``docs``.

    A null text is an empty one, which stays plain; a null doc_id draws like an
    empty one. Rows that share a doc_id are told apart by their text, and equal
    rows, which have equal results, are assembled once and counted, so that a
    row repeated any number of times is no hot group. Other columns are not
    read. An empty table gives an empty one. Texts of any length are whole.
    """
    dealt = pieces(docs, piece=piece).repartition("doc_id", "print")
    passed = dealt.sortWithinPartitions("doc_id", "print", "place").mapInArrow(_assemble, _PASSED)
    return passed.sortWithinPartitions("doc_id", "print", "part", "place").mapInArrow(_restore, _OUT)
