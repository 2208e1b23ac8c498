"""BPE encoding and decoding by tree concatenation (operator 10).

Texts no longer than a leaf are encoded as they come. A longer text is cut
into leaves at fixed places, wherever that falls; the leaves are dealt out
over the cluster and encoded independently. A tree then concatenates
neighbours: around each join a window of growing size is re-encoded until it
agrees exactly with both sides, and only the tokens inside it are replaced.

Agreement is one of two exact conditions, at each side of the join:

* a token boundary in both encodings that is *certain*: between a character
  that is not white space and a blank or line feed. No alternative of the
  pre-tokenizer's pattern crosses such a place, whatever came before, and no
  special token holds a blank, so what follows it does not depend on what
  precedes it;
* in a long run of ASCII letters or of one class without such a place (the
  run is a single pre-token), a whole token that both encodings share at the
  same place. In byte-pair encoding a token sequence is the encoding of its
  bytes if and only if each adjacent pair of it is, so the concatenation over
  shared tokens is exact.

Where neither is found the window doubles; at the limit it is the whole
text of both sides, which is exact by definition.

Between the rounds a node is its ids alone, in two bytes each if the vocabulary
has no more than 65,536: its text is what they decode to, which is compared
when the node is made. A text that its ids don't tell travels with them.

The vocabulary files are public and named by a parameter; every task loads
them from the installed package or the given path. A special token's string
in a text is encoded as that token, as the reference library does.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import document_columns, give_back, materialize, row_slices, text_slices

#: Code points of a leaf: texts up to this are encoded in one piece.
LEAF_CHARS = 16_384
#: Bytes on each side of a join in the first window.
FIRST_WINDOW = 64
#: Neighbours that one task concatenates in a round of the tree.
FAN_IN = 16

_LETTERS = re.compile(rb"[A-Za-z]+")
_DIGITS = re.compile(rb"[0-9]+")
_CERTAIN = re.compile(rb"(?<=[!-~])[ \n]")


class Codec:
    """A byte-level BPE vocabulary with numpy views of its tokens."""

    def __init__(self, ranks_path: str, specials_path: str | None = None):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        specials = {}
        if specials_path:
            with open(specials_path, encoding="utf-8") as f:
                specials = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self._encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self._allowed = set(specials)
        tokens = {**{i: b for b, i in ranks.items()}, **{i: s.encode() for s, i in specials.items()}}
        size = max(tokens) + 1
        self.lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], dtype=np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self._bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), dtype=np.uint8)
        self._narrow = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.uint32)
        return np.asarray(self._encoding.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=()),
                          dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered at once from the vocabulary."""
        if not len(ids):
            return b""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        index = np.repeat(self._starts[ids] - (ends - n), n) + np.arange(ends[-1])
        return self._bytes[index].tobytes()

    def pack(self, ids: np.ndarray) -> bytes:
        """The ids in two bytes each where the vocabulary allows it."""
        return ids.astype(self._narrow).tobytes()

    def unpack(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, dtype=self._narrow).astype(np.uint32)

    def node(self, text: bytes, ids: np.ndarray) -> tuple[bytes | None, bytes]:
        """What of a node is stored: the text only if its ids don't tell it."""
        return (None if self.decode(ids) == text else text), self.pack(ids)

    def read_node(self, text: bytes | None, data: bytes) -> tuple[bytes, np.ndarray]:
        ids = self.unpack(data)
        return (self.decode(ids) if text is None else text), ids

    def bounds(self, ids: np.ndarray) -> np.ndarray:
        """Byte offsets of the token boundaries, both ends included."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])


@lru_cache(maxsize=2)
def codec(ranks: str, specials: str | None) -> Codec:
    return Codec(ranks, specials)


def default_vocabulary() -> tuple[str, str]:
    """The ranks and the special tokens of the 50k byte-level vocabulary."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def _char_start(data: bytes, i: int) -> int:
    """The last place at or before ``i`` where a code point begins."""
    while 0 < i < len(data) and data[i] & 0xC0 == 0x80:
        i -= 1
    return i


def _token_at(bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of ``places`` are boundaries."""
    i = np.searchsorted(bounds, places)
    return (i < len(bounds)) & (bounds[np.minimum(i, len(bounds) - 1)] == places)


def _one_run(data: bytes) -> bool:
    """Whether the bytes are ASCII letters only, or digits only."""
    return bool(_LETTERS.fullmatch(data) or _DIGITS.fullmatch(data))


def join(c: Codec, left: bytes, left_ids: np.ndarray, right: bytes, right_ids: np.ndarray,
         window: int = FIRST_WINDOW) -> np.ndarray:
    """The encoding of ``left + right`` from the encodings of both."""
    if not left or not right:
        return np.concatenate([left_ids, right_ids])
    lb, rb = c.bounds(left_ids), c.bounds(right_ids)
    w = max(window, FIRST_WINDOW // 4)  # longer than any special token or contraction
    while True:
        lo, hi = max(0, len(left) - w), min(len(right), w)
        lo, hi = _char_start(left, lo), _char_start(right, hi) if hi < len(right) else hi
        part = left[lo:] + right[:hi]
        ids = c.encode(part.decode("utf-8"))
        wb = c.bounds(ids)
        cut = len(left) - lo
        u = v = None
        certain = np.array([m.start() for m in _CERTAIN.finditer(part)], dtype=np.int64)
        if lo == 0:
            u = 0
        else:
            # The window itself starts anywhere: a certain place in it is where
            # the whole text's scan, the left scan and its own scan all meet.
            # The left scan ends at the cut, which only bears on its last
            # pre-token, and a certain place ends the one before it.
            places = certain[certain < cut]
            places = places[_token_at(wb, places) & _token_at(lb - lo, places)]
            if len(places):
                u = int(places[0])
        if hi == len(right):
            v = len(part)
        else:
            # The window's end bears on its last pre-token only.
            places = certain[certain >= cut]
            places = places[_token_at(wb, places) & _token_at(rb + cut, places)]
            if len(places):
                v = int(places[-1])
        if (u is None or v is None) and lo > 0 and hi < len(right) and _one_run(part):
            # One pre-token: whole tokens shared with each side.
            places = wb[:-1]
            shared_l = [int(p) for p in places if 0 < p and p + c.lengths[ids[np.searchsorted(wb, p)]] <= cut
                        and _same_token(lb - lo, left_ids, wb, ids, p)]
            shared_r = [int(p) for p in places if p >= cut and p + c.lengths[ids[np.searchsorted(wb, p)]] < len(part)
                        and _same_token(rb + cut, right_ids, wb, ids, p)]
            if shared_l and shared_r:
                u, v = shared_l[0], shared_r[-1]
        if u is not None and v is not None:
            head = left_ids[:np.searchsorted(lb, u + lo)]
            mid = ids[np.searchsorted(wb, u):np.searchsorted(wb, v)]
            tail = right_ids[np.searchsorted(rb, v - cut):]
            return np.concatenate([head, mid, tail])
        w *= 2


def _same_token(bounds: np.ndarray, own: np.ndarray, wb: np.ndarray, ids: np.ndarray, p: int) -> bool:
    i, j = np.searchsorted(bounds, p), np.searchsorted(wb, p)
    return i < len(own) and bounds[i] == p and own[i] == ids[j]


def concatenate(c: Codec, parts: list[tuple[bytes, np.ndarray]], window: int = FIRST_WINDOW) -> tuple[bytes, np.ndarray]:
    """Halves of halves: neighbours are joined pair by pair, level by level."""
    while len(parts) > 1:
        pairs = []
        for i in range(0, len(parts) - 1, 2):
            (a, x), (b, y) = parts[i], parts[i + 1]
            pairs.append((a + b, join(c, a, x, b, y, window)))
        parts = pairs + parts[len(parts) - len(parts) % 2:]
    return parts[0] if parts else (b"", np.empty(0, dtype=np.uint32))


_LEAVES = "doc_id long, key long, part long, parts long, text binary, ids binary"


def _cut(leaf_chars: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_slices(batches):
            for doc_id, key, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                parts = -(-len(text) // leaf_chars)
                for first in range(0, parts, 64):
                    leaves = [text[i * leaf_chars:(i + 1) * leaf_chars].encode() for i in range(first, min(parts, first + 64))]
                    n = len(leaves)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_id] * n, pa.int64()), "key": pa.array([key] * n, pa.int64()),
                        "part": pa.array(range(first, first + n), pa.int64()), "parts": pa.array([parts] * n, pa.int64()),
                        "text": pa.array(leaves, pa.binary()), "ids": pa.array([b""] * n, pa.binary())})
    return cut


def _encode_leaves(vocabulary):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary)
        for b in row_slices(batches, 64):
            texts = b.column("text").to_pylist()
            text, ids = zip(*(c.node(t, c.encode(t.decode())) for t in texts))
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array(text, pa.binary()))
            yield b.set_column(b.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))
        give_back()
    return encode


def _join_round(vocabulary, window: int, last: bool):
    """A round of the tree. The ``last`` one gives the text and its ids."""
    def joined(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pydict()
        c = codec(*vocabulary)
        text, ids = concatenate(c, [c.read_node(t, i) for t, i in zip(rows["text"], rows["ids"])], window)
        text, ids = (text, ids.tobytes()) if last else c.node(text, ids)
        return pa.table({"doc_id": pa.array([rows["doc_id"][0]], pa.int64()), "key": pa.array([rows["key"][0]], pa.int64()),
                         "part": pa.array([rows["part"][0] // FAN_IN], pa.int64()),
                         "parts": pa.array([-(-rows["parts"][0] // FAN_IN)], pa.int64()),
                         "text": pa.array([text], pa.binary()), "ids": pa.array([ids], pa.binary())})
    return joined


def encode_documents(docs: DataFrame, *, vocabulary: tuple[str, str | None] | None = None,
                     leaf_chars: int = LEAF_CHARS, window: int = FIRST_WINDOW) -> DataFrame:
    """``doc_id, text binary (UTF-8), ids binary`` (little-endian unsigned 32-bit
    integers), one row per row of ``docs``.

    Null and empty texts give no ids. Rows that repeat a doc_id are encoded
    one by one, each giving its own row. Null doc_ids are kept.
    """
    vocabulary = vocabulary or default_vocabulary()
    own = document_columns(docs)
    long_text = F.length("text") > leaf_chars

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary)
        for b in row_slices(batches):
            ids, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                part = [t or "" for t in texts[lo:hi]]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(lo, hi - lo), "text": pa.array([t.encode() for t in part], pa.binary()),
                    "ids": pa.array([c.encode(t).tobytes() for t in part], pa.binary())})
        give_back()

    schema = "doc_id long, text binary, ids binary"
    out = own.where(~F.coalesce(long_text, F.lit(False))).mapInArrow(short, schema)

    # Long texts: leaves dealt out by document and place, written once (the
    # row key is drawn here and must not change when a task is repeated).
    keyed = own.where(long_text).select("doc_id", F.monotonically_increasing_id().alias("key"), "text")
    cut = keyed.mapInArrow(_cut(leaf_chars), _LEAVES)
    parts = materialize(cut.repartition("key", "part").mapInArrow(_encode_leaves(vocabulary), _LEAVES), "bpe-leaves")
    left = parts.agg(F.max("parts")).first()[0] or 1
    while True:
        left = -(-left // FAN_IN)
        parts = (parts.withColumn("_node", F.expr(f"part div {FAN_IN}"))
                 .groupBy("key", "_node").applyInArrow(_join_round(vocabulary, window, left <= 1), _LEAVES))
        if left <= 1:
            break
        parts = materialize(parts, "bpe-nodes")
    return out.unionByName(parts.select("doc_id", "text", "ids"))


def digest_documents(encoded: DataFrame, *, vocabulary: tuple[str, str | None] | None = None) -> DataFrame:
    """Decode the ids of ``encode_documents`` and digest both sides:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip`` (whether the
    decoded bytes are the text's)."""
    vocabulary = vocabulary or default_vocabulary()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary)
        for b in row_slices(batches):
            rows = []
            for text, ids in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                tokens = np.frombuffer(ids, dtype="<u4")
                decoded = c.decode(tokens)
                rows.append((len(tokens), hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest(), decoded == text))
            n, i, d, same = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(i, pa.string()),
                "decoded_sha256": pa.array(d, pa.string()), "round_trip": pa.array(same, pa.bool_())})
        give_back()

    return encoded.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
