"""The training-data operators against brute force, and on awkward input."""

from __future__ import annotations

import os
import random
import sys
import tracemalloc
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
import zstandard

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
from aurum.llm import bpe, decontaminate, html, jaccard, langid, lines, naming, passages, quality, substrings  # noqa: E402
from aurum.llm import common, components, exchange, suffixes  # noqa: E402

#: Extra columns whose names the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, print long, node string, at string, "
          "key string, name string, places string, h1 string, _print string, d string")
EXTRA = (1, "n", "a", "k", "m", "p", "h", "x", "y")


def table(spark, rows):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(*r, *(None, None, None)[len(r) - 1:])[:4] if len(r) < 4 else r for r in rows]
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None) for r in full]
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in full], SCHEMA)


def prose(rng, n, words=("the", "of", "Ünder", "river", "stone", "a", "walks", "blue", "cat", "ran", "far", "away,", "日本")):
    return " ".join(rng.choice(words) + (str(rng.randrange(60)) if rng.random() < 0.7 else "") for _ in range(n))


def corpus(seed=5, n=40):
    """Copies, near copies, shared passages, short and empty texts."""
    rng = random.Random(seed)
    out, base, passage = [], prose(rng, 90), prose(rng, 30)
    for i in range(n):
        k = rng.randrange(8)
        if k == 0:
            t = base
        elif k == 1:
            w = base.split()
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
            t = rng.choice([" ", "\n", "\t "]).join(w)
        elif k == 2:
            t = prose(rng, rng.randrange(0, 40)) + " " + passage + "\n" + prose(rng, rng.randrange(0, 40))
        elif k == 3:
            t = prose(rng, rng.randrange(0, 6))
        elif k == 4:
            t = rng.choice(["", None, " \n\t ", "word", "!!!"])
        else:
            t = prose(rng, rng.randrange(5, 120))
        out.append((i * 3 + 1, t))
    rng.shuffle(out)
    return out


AWKWARD = [(1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "word"), (5, "word"), (6, "a " * 30), (7, "a " * 60), (8, "x" * 3000),
           (9, "x" * 3000), (10, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 40)]


def ids(df, *cols):
    return sorted((tuple(r) for r in df.select("doc_id", *cols).collect()), key=repr)


# ---------------------------------------------------------------- exact dedup

@pytest.mark.parametrize("rows", [corpus(), AWKWARD, corpus(9)])
def test_naming_equals_brute_force(spark, rows):
    rows = [*rows, *[(1000 + i, (t or "").replace(" ", "\r\x0b ")) for i, (_, t) in enumerate(rows[:6])]]
    expected = brute.exact(rows)
    got = naming.dedup(table(spark, rows), block_chars=7)
    assert ids(got, "keep_id", "group_size", "kept", "text_sha256") == sorted(
        ((d, *expected[(d, t or "")]) for d, t in rows), key=repr)


def test_naming_of_null_id_and_empty_table(spark):
    got = naming.dedup(table(spark, [(None, "a b"), (4, "ab"), (2, "a b")]))
    assert ids(got, "keep_id", "kept") == sorted([(None, 2, False), (4, 2, False), (2, 2, True)], key=repr)
    assert naming.dedup(table(spark, [])).count() == 0


# ---------------------------------------------------------------- passages and substrings

@pytest.mark.parametrize("rows,length,period,cover", [(corpus(), 13, 7, (0, 1, 3)), (corpus(3), 6, 3, (0, 1)), (AWKWARD, 13, 7, (0, 1, 3))])
def test_passages_equal_brute_force(spark, rows, length, period, cover):
    words = [(d, brute.WORD.findall(t or "")) for d, t in rows]
    expected = []
    for (d, w), (_, starts) in zip(words, brute.windows(words, length)):
        g = brute.gone(len(w), starts, length)
        expected.append((d, len(w), sum(g), bytearray(" ".join(x for x, f in zip(w, g) if not f).encode())))
    got = passages.remove_passages(table(spark, rows), length=length, period=period, cover=cover)
    assert ids(got, "n_words", "n_removed", "kept") == sorted(expected, key=repr)


def test_passages_need_a_cover(spark):
    with pytest.raises(ValueError):
        passages.repeated_passages(table(spark, []), length=13, period=7, cover=(0, 1))


@pytest.mark.parametrize("rows,length,gram", [(corpus(), 50, 16), (corpus(4), 20, 8), (AWKWARD, 50, 16)])
def test_substrings_equal_brute_force(spark, rows, length, gram):
    data = [(d, (t or "").encode()) for d, t in rows]
    expected = []
    for (d, b), (_, starts) in zip(data, brute.windows(data, length)):
        g = brute.gone(len(b), starts, length)
        expected.append((d, len(b), sum(g), brute.spans(g), bytearray(x for x, f in zip(b, g) if not f)))
    got = substrings.remove_substrings(table(spark, rows), length=length, gram=gram)
    assert ids(got, "n_bytes", "n_removed", "n_spans", "kept") == sorted(expected, key=repr)


def test_anchors_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    """Texts looked at together, alone, and cut into pieces have the same runs,
    and equal windows have their anchors at equal offsets."""
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 123) for _ in range(400))
    texts = [b"", b"x" * 49, b"y" * 50, b"ab" * 700] + [bytes(rng.randrange(97, 100) for _ in range(rng.randrange(1500))) + passage for _ in range(12)]
    monkeypatch.setattr(substrings, "_PIECE", 1000)
    for gram in (4, 8, 11, 24):
        offsets, cut = {}, 0
        for lo, hi, data, starts, begin, end, at, h in substrings._grouped_runs(texts, 50, gram):
            cut += len(data) > 1000
            for t, start in zip(texts[lo:hi], starts.tolist()):
                alone, hashes = substrings._window_anchors(np.frombuffer(t, np.uint8), 50, gram) if len(t) >= 50 else ([], None)
                mine = (begin >= start) & (begin < start + len(t))
                assert np.array_equal(np.repeat(at[mine], (end - begin)[mine]) - start, alone)
                assert np.array_equal(h[mine], hashes[at[mine] - start] if len(t) >= 50 else [])
                for i, p in enumerate(alone):
                    assert offsets.setdefault(t[i:i + 50], p - i) == p - i
        assert cut


def test_digests_do_not_depend_on_neighbours():
    rng = random.Random(6)
    data = np.frombuffer(bytes(rng.randrange(2) for _ in range(3000)), np.uint8)
    at, size = np.array([rng.randrange(2900) for _ in range(4000)]), np.array([rng.choice([1, 3, 7, 8, 9, 50, 76]) for _ in range(4000)])
    together, known = substrings._digests(data, at, size), {}
    for i, (a, n) in enumerate(zip(at.tolist(), size.tolist())):
        assert known.setdefault(data[a:a + n].tobytes(), together[i].tobytes()) == together[i].tobytes()
        if i < 100:
            assert np.array_equal(substrings._digests(data[a:a + n], np.array([0]), np.array([n]))[0], together[i])
    assert len(set(known.values())) == len(known)


def test_a_shard_sorts_only_windows_that_may_be_equal(monkeypatch):
    """Chunks around one anchor, most with surroundings of their own: those
    are not sorted, and the answers are those of all windows."""
    rng = random.Random(9)
    noise = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    anchor, left, right = noise(24), noise(26), noise(26)
    chunks = [noise(26) + anchor + noise(26) for _ in range(300)]
    chunks += [left + anchor + noise(26) for _ in range(3)] + [noise(26) + anchor + right for _ in range(3)]
    chunks += [noise(10) + left[10:] + anchor + right[:14] + noise(12) for _ in range(3)]
    docs = np.array([rng.randrange(1000) for _ in chunks])
    sorted_bytes, order = [], substrings.suffix_order
    monkeypatch.setattr(substrings, "suffix_order", lambda text, depth: sorted_bytes.append(len(text)) or order(text, depth))
    shard = substrings.Shard(50, 24)
    halves = [slice(0, 200), slice(150, len(chunks))]  # some chunks in both flushes
    for uid, own in enumerate(halves):
        part = chunks[own]
        size = np.array([len(c) for c in part], np.uint32)
        digests = substrings._digests(np.frombuffer(b"".join(part), np.uint8), np.cumsum(size.astype(np.int64)) - size, size.astype(np.int64))
        shard.add(uid, zstandard.compress(b"".join(part)), size.tobytes(), digests.tobytes(), docs[own].astype(np.int64).tobytes(),
                  np.full(len(part), 26, np.uint32).tobytes())
    least = {}
    for c, d in zip(chunks, docs.tolist()):
        for i in range(len(c) - 49):
            least[c[i:i + 50]] = min(d, least.get(c[i:i + 50], d))
    for (uid, values, runs), own in zip(shard.answer(), halves):
        got = np.repeat(np.frombuffer(values, np.int64), np.frombuffer(runs, np.uint32))
        assert got.tolist() == [least[c[i:i + 50]] for c in chunks[own] for i in range(len(c) - 49)]
    assert 0 < sum(sorted_bytes) < 1500


def test_shards_grow_with_the_text_whatever_the_partitions(spark, monkeypatch):
    rows, made, pack = corpus(), [], substrings._pack
    monkeypatch.setattr(substrings, "SHARD_TEXT", 200)
    monkeypatch.setattr(substrings, "_pack", lambda length, gram, buckets, flush_bytes: made.append(buckets) or pack(length, gram, buckets, 3000))
    got = ids(substrings.remove_substrings(table(spark, rows), length=20, gram=8), "n_removed")
    text = sum(len((t or "").encode()) for _, t in rows)
    assert made[0] >= 0.9 * text / 200 > 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = [(d, (t or "").encode()) for d, t in rows]
    assert got == sorted([(d, sum(brute.gone(len(b), starts, 20))) for (d, b), (_, starts) in zip(data, brute.windows(data, 20))], key=repr)


def test_passages_and_substrings_of_null_id_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = table(spark, [(None, text), (7, text)])
    assert ids(passages.remove_passages(rows), "n_removed") == sorted([(None, 40), (7, 0)], key=repr)
    assert ids(substrings.remove_substrings(rows), "n_removed") == sorted([(None, len(text)), (7, 0)], key=repr)
    assert passages.remove_passages(table(spark, [])).count() == substrings.remove_substrings(table(spark, [])).count() == 0


def test_words_hash_alike_alone_and_together():
    """A text's hashes do not depend on its neighbours or on the block's cuts."""
    rng = random.Random(0)
    texts = [prose(rng, rng.randrange(0, 40)) + rng.choice(["", " ", "\n\t"]) for _ in range(50)] + [None, "", "  ", "x" * 3000]
    texts += ["É a\x0bB " * 200_000, "y" * (1 << 21)]
    for t, (w, runs) in zip(texts, common.word_windows(texts, 3, fold=True)):
        alone = common.word_hashes(t, fold=True)
        assert np.array_equal(w, alone) and len(w) == len(common.words_of(t))
        assert np.array_equal(runs, common.window_hashes(alone, 3))
    known = {}
    for t in texts:
        for w, h in zip(common.words_of(t), common.word_hashes(t).tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def traced_peak(work):
    """Most bytes that Python and numpy held while ``work`` ran, above those before."""
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        work()
        return tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("least,most", [(False, 72), (True, 112)])
def test_packed_flush_holds_few_arrays(monkeypatch, least, most):
    """Bytes an entry of a flush being packed, those of its hashes and places included."""
    monkeypatch.setattr(exchange, "TaskContext", type("Task", (), {"get": lambda: type("Own", (), {"partitionId": lambda _: 0})()}))
    n, per = 400_000, 200

    def work():
        f, rng = exchange._Flush(8, least), np.random.default_rng(0)
        for i in range(n // per):
            h = rng.integers(0, 1 << 62, per, dtype=np.uint64)
            f.add(i, i, per, h, h.copy() if least else None, np.arange(per))
        return [b.num_rows for b in f.rows()]

    assert traced_peak(work) < most * n


@pytest.mark.parametrize("least,docs,expected", [(True, [[4, 9, 7], [3, 9]], [[True, False, False], [False, False]]),
                                                 (False, [[0, 1, 0], [0, 0]], [[True, True, False], [True, False]])])
def test_packed_answers_are_bits(least, docs, expected):
    """Of a hash in both flushes the one with the larger document is told so."""
    kind = np.int64 if least else np.uint8
    hashes = [np.array(h, np.uint64).tobytes() for h in ([5, 6, 8], [5, 7])]
    got = exchange._answer(least)(pa.table({
        "uid": pa.array([1, 2], pa.int64()), "bucket": pa.array([0, 0], pa.int32()), "h1": pa.array(hashes, pa.binary()),
        "h2": pa.array(hashes if least else [None, None], pa.binary()), "docs": pa.array([np.array(d, kind).tobytes() for d in docs], pa.binary())}))
    assert [len(a) for a in got["answer"].to_pylist()] == [1, 1] and got["n"].to_pylist() == [3, 2]
    bits = [np.unpackbits(np.frombuffer(a, np.uint8), count=n) > 0 for a, n in zip(got["answer"].to_pylist(), got["n"].to_pylist())]
    assert [b.tolist() for b in bits] == expected


def test_packed_flushes_agree(spark):
    """The answers do not depend on how documents fall into flushes."""
    rows = exchange.keyed(table(spark, corpus(6, 60)))
    make, hashed = passages._anchors(13, 7, (0, 1, 3)), partial(common.word_windows, n=7)
    one = exchange.shared_places(rows, make, least=True, prepare=hashed)
    many = exchange.shared_places(rows.repartition(5), make, least=True, prepare=hashed, flush=40)
    assert ids(one, "at") == ids(many, "at")


@pytest.mark.parametrize("depth,base,batch,memory", [(50, 1 << 20, 1 << 20, 1 << 20), (5, 3, 4, 2), (3, 0, 16, 10)])
def test_suffix_order(monkeypatch, depth, base, batch, memory):
    """Against sorted(), with recursion, spilled queues and file sections."""
    monkeypatch.setattr(suffixes, "BATCH", batch)
    monkeypatch.setattr(suffixes, "IN_MEMORY", memory)
    monkeypatch.setattr(suffixes, "SMALL", 8)
    rng = random.Random(depth)
    for _ in range(120):
        x = [rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(1, 50))] * rng.choice([1, 1, 2])
        at, lcp = [], []
        for a, b in suffixes.suffix_order(np.array(x, np.uint8), depth, base=base):
            at += a.tolist()
            lcp += b.tolist()
        expected = sorted(range(len(x)), key=lambda i: x[i:])
        assert at == expected
        common = [next((k for k in range(depth) if x[a + k:a + k + 1] != x[b + k:b + k + 1] or not x[a + k:a + k + 1]), depth)
                  for a, b in zip(expected, expected[1:])]
        assert lcp == [0, *common]


# ---------------------------------------------------------------- near duplicates

@pytest.mark.parametrize("rows", [corpus(), corpus(11, 70), AWKWARD])
def test_near_duplicates_equal_brute_force(spark, rows):
    got = jaccard.near_duplicates(table(spark, rows), sketch_bits=10)
    assert ids(got, "n_shingles", "component_id") == sorted(brute.near(rows), key=repr)


def test_near_duplicates_find_links_at_the_bound(spark):
    """Chains of edits around the threshold, over several sizes."""
    rng = random.Random(2)
    rows, w = [], prose(rng, 60).split()
    for i in range(60):
        w = w[:]
        for _ in range(rng.randrange(1, 3)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            w = w + [f"t{i}"] * rng.randrange(8)
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    assert ids(jaccard.near_duplicates(table(spark, rows)), "n_shingles", "component_id") == sorted(brute.near(rows), key=repr)


def test_texts_under_one_id_share_places_in_one_flush(spark):
    rows = exchange.keyed(table(spark, [(5, "a"), (5, "b")])).coalesce(1)

    def make():
        return lambda text: (2, np.array([7, ord(text)], np.uint64), None, np.array([0, 1]))

    for flush in (1, 1000):
        found = exchange.shared_places(rows, make, least=False, flush=flush).collect()
        assert [(r["doc_id"], np.frombuffer(r["at"], np.int64).tolist()) for r in found] == [(5, [0]), (5, [0])]


def test_near_duplicates_of_null_id_and_empty_table(spark):
    text = "one two three four five six seven"
    assert ids(jaccard.near_duplicates(table(spark, [(None, text), (3, text), (None, None)])), "component_id") == sorted(
        [(None, 3), (3, 3), (None, None)], key=repr)
    assert jaccard.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_meet_once_per_run_of_shared_columns(spark):
    """Rows of 100 columns each that share their first 11 are paired at the
    first, not at all 11; a pair that parts and meets again is paired twice,
    and one whose first columns are the only ones alike is paired there."""
    def row(node, columns):
        return [(h, node, 100, i, columns[i - 1] if i else None, node) for i, h in enumerate(columns)]

    same = list(range(11))
    parts = [*range(4), 77, *range(5, 11)]
    late = [*range(50, 58), 8, 61, 62]
    rows = spark.createDataFrame(row(1, same) + row(2, same) + row(3, parts) + row(4, late), "h long, node long, n long, i int, before long, comp long")
    met = sorted((r["a"], r["b"]) for r in jaccard._pairs(rows, rows, 80).collect())
    assert met == [(1, 2), (1, 3), (1, 3), (1, 4), (2, 3), (2, 3), (2, 4), (3, 4)]


def test_near_duplicates_of_one_long_passage_with_other_ends(spark):
    """Many near copies, each with a few words of its own at several places."""
    import random
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(60):
        words = list(base)
        for k in rnd.sample(range(150), d % 5):
            words[k] = f"own{d}x{k}"
        rows.append((d, " ".join(words)))
    assert ids(jaccard.near_duplicates(table(spark, rows)), "n_shingles", "component_id") == sorted(brute.near(rows), key=repr)


def test_near_duplicates_meet_at_their_original(spark, monkeypatch):
    """Copies with one to seven changed words link with their original, not
    with most other copies: few pairs are left after the star turns."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(500, " ".join(base))]
    for d in range(240):
        words = list(base)
        for k in rng.sample(range(150), 1 + d % 7):
            words[k] = f"own{d}x{k}"
        rows.append((d, " ".join(words)))
    counts, write = [], jaccard.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    got = jaccard.near_duplicates(table(spark, rows))
    assert ids(got, "n_shingles", "component_id") == sorted(brute.near(rows), key=repr)
    assert counts[-1] < len(rows), counts


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40) if i % 10] + [(rng.randrange(100, 130), 100) for _ in range(20)] + [(7, 7)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    for a, b in edges:
        if a != b:
            assert got[a] == got[b] <= min(a, b)
    assert set(got.values()) == {1, 11, 21, 31, 100}


# ---------------------------------------------------------------- lines

def test_lines_equal_brute_force(spark):
    rng = random.Random(8)
    common_lines = [f"boiler {k}" for k in range(30)]
    rows = []
    for i in range(120):
        text = "\n".join(rng.choice([rng.choice(common_lines), f"own {i} {rng.random()}", "", "  "]) for _ in range(rng.randrange(0, 9)))
        rows.append((i, rng.choice([text, text, text, None]), "en", rng.choice([None, *[f"s{k}" for k in range(12)]])))
    rows += [rows[0], (500, "x\n" * 2000, "en", "s1")]
    for sites in (2, 5, 9):
        expected = brute.boilerplate([(d, t, s) for d, t, _, s in rows], sites)
        got = lines.dedup_lines(table(spark, rows), min_sites=sites)
        assert ids(got, "text", "lines_n", "lines_removed") == sorted(((r[0], *expected[(r[0], r[1])]) for r in rows), key=repr)
        assert got.columns[:3] == ["doc_id", "text", "lang"]
    assert lines.dedup_lines(table(spark, [])).count() == 0


def test_lines_leave_columns_of_internal_names_alone(spark):
    docs = spark.createDataFrame([(1, "x\ny", "s", 0.5, 7, "t")], "doc_id long, text string, source string, _print double, print int, Text string")
    row = lines.dedup_lines(docs).collect()[0]
    assert tuple(row) == (1, "x\ny", "s", 0.5, 7, "t", 2, 0)


def test_lines_of_a_text_with_many_removed_lines(spark):
    many = [f"boilerplate {i}" for i in range(300)]
    rows = [(d, "\n".join([f"own {d}", *many, "", "end"]) if d else "\n".join(many), f"s{d}") for d in range(9)]
    found = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    # "end" stands in the other eight documents, of eight sites: its first place is document 1.
    assert found[0] == ("\n".join(many), 0) and found[1] == ("own 1\n\nend", 300)
    assert all(found[d] == (f"own {d}\n", 301) for d in range(2, 9))


def test_line_sketch_is_close(spark):
    """Estimates over many sites stay within four standard errors."""
    rows = [(i, f"line {k}", None, f"site{i}") for k, n in enumerate((1, 7, 40, 300)) for i in range(n)]
    got = {r["rows_n"]: r["sites"] for r in lines.sketch_lines(lines.line_rows(table(spark, rows))).collect()}
    for n, e in got.items():
        assert abs(e - n) <= max(1, lines.NEAR * n)


# ---------------------------------------------------------------- decontamination

def test_alignment_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 12))], np.int32)
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(0, 15))], np.int32)
        best, lo, hi = decontaminate.align(a, b)
        assert best == brute.smith_waterman(a.tolist(), b.tolist())
        assert best == brute.smith_waterman(a.tolist(), b[lo:hi].tolist())


def leak_rows():
    rng = random.Random(12)
    items = [(i, " ".join(f"q{i}w{rng.randrange(400)}" for _ in range(rng.randrange(12, 40)))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "two words"), (3, items[3][1])]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(0, 60))]
        for k, t in rng.sample(items[:12], rng.randrange(0, 3)):
            w = t.split()
            for _ in range(rng.choice([0, 0, len(w) // 6, len(w) // 3])):
                j = rng.randrange(len(w))
                w[j:j + 1] = rng.choice([[], [w[j].upper() + "!"], ["zz"], [w[j], "extra"]])
            w = w if rng.random() < 0.8 else w[:5]
            parts += [" ".join(w), prose(rng, rng.randrange(0, 60))]
        docs.append((i, "\n".join(parts)))
    return docs + [(100, None), (101, ""), (5, docs[5][1])], items


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_leaks_equal_alignment_of_everything(spark, block_words):
    docs, items = leak_rows()
    words = {}
    expected = {}
    for d, t in docs:
        for k, q in items:
            a, b = decontaminate.words(q), decontaminate.words(t)
            number = lambda ws: np.array([words.setdefault(w, len(words)) for w in ws], np.int32)
            if len(a) >= decontaminate.NGRAM and b:
                best = decontaminate.align(number(a), number(b))[0]
                if best >= 0.5 * 2 * len(a):
                    expected[(d, k)] = best / (2 * len(a))
    found = decontaminate.find_leaks(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()}
    # A passage without any seed is out of reach of the method; whole ones never are.
    assert {k: v for k, v in expected.items() if v >= 0.7} == {k: v for k, v in got.items() if v >= 0.7}
    assert all(got[k] <= expected[k] for k in got)
    assert len(set(expected) - set(got)) <= 0.05 * len(expected)


def test_leaks_of_short_items(spark):
    docs = table(spark, [(1, "so Two, words stand"), (2, "words two"), (3, "one"), (4, "three words here, one"), (5, "two x words"), (6, "")])
    items = spark.createDataFrame([(1, "two words"), (2, "One!"), (3, "three words here"), (4, "?"), (5, None)], "item_id long, text string")
    found = decontaminate.find_leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"], r["first_word"]) for r in found) == [
        (1, 1, 1.0, 1), (3, 2, 1.0, 0), (4, 2, 1.0, 3), (4, 3, 1.0, 0)]


@pytest.mark.parametrize("edit,score", [
    (lambda i: i % 4 == 3, 0.64), (lambda i: i % 5 == 4, 0.71), (lambda i: i >= 20 and i % 3 == 2, 0.74)])
def test_leaks_of_a_single_edited_copy(spark, edit, score):
    items = [(k, " ".join(f"e{k}w{i}" for i in range(40))) for k in range(10)]
    copies = [(k, f"before {k} " + " ".join("zz" if edit(i) else w for i, w in enumerate(t.split())) + " after") for k, t in items]
    found = decontaminate.find_leaks(table(spark, copies), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(k, k) for k in range(10)]
    assert all(abs(r["score"] - score) < 0.02 for r in found)


def test_leaks_of_an_edited_copy_of_common_words(spark):
    # The copy's n-grams are in many documents, those of a fragment of the same item in one.
    item = [f"c{i}" for i in range(40)]
    copy = " ".join("zz" if i >= 30 or i % 4 == 3 and i < 24 else w for i, w in enumerate(item))
    far = " ".join(f"far{i}" for i in range(200))
    docs = [(0, f"{' '.join(item[30:])} {far} {copy}")] + [(k, copy) for k in range(1, 20)]
    found = decontaminate.find_leaks(table(spark, docs), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(20))
    assert len({r["score"] for r in found}) == 1 and {r["first_word"] for r in found} == {0, 210}


def test_leaks_of_a_hot_item_and_empty_tables(spark):
    item = " ".join(f"h{i}" for i in range(20))
    docs = table(spark, [(i, f"x{i} {item} y{i}") for i in range(200)] + [(999, "clean text here")])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect()) == list(range(200))
    assert decontaminate.find_leaks(table(spark, []), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


# ---------------------------------------------------------------- quality

def rated(spark, n=900):
    rng = random.Random(3)
    rows, grades = [], []
    for i in range(n):
        g = rng.randrange(3)
        w = prose(rng, rng.randrange(20, 80)).split()
        for _ in range(6):
            w[rng.randrange(len(w))] = {0: rng.choice(["nasty", "awful"]), 1: "meh!!", 2: "well"}[g]
        rows.append((i, " ".join(w)))
        grades.append((i, g))
    return rows, grades


def test_quality_orders_grades(spark):
    rows, grades = rated(spark)
    docs = table(spark, [*rows, (5000, None), (5001, ""), (5002, "!"), (5002, "!")])
    train = spark.createDataFrame([*grades[:600], (7, 9), (8, None), (99999, 1)], "doc_id long, grade int")
    model = quality.train(docs, train, 3, bits=14)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r for r in quality.score(docs, model, 3).collect()}
    held = grades[600:]
    right = sum(round(got[i]["expected_grade"]) == g for i, g in held)
    assert right / len(held) > 0.9
    assert all((got[i]["kept"]) == (got[i]["p_at_least"][1] >= 0.25) for i, _ in held)
    assert got[5000]["expected_grade"] is None and not got[5001]["kept"]
    assert got[5002]["p_at_least"][0] >= got[5002]["p_at_least"][1]


def test_quality_on_held_out_labels(spark):
    """Toxic documents are caught and good ones left alone."""
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.1"
    docs, labels = common.read(spark, sf, "documents"), common.read(spark, sf, "labels")
    model = quality.train(docs, quality.ratings(labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 > 0)), 3)
    held = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0)
    r = quality.score(docs, model, 3).join(held, "doc_id").selectExpr(
        "count_if(toxic = 1) toxic", "count_if(toxic = 1 and not kept) caught", "count_if(toxic = 0 and quality = 1) good",
        "count_if(toxic = 0 and quality = 1 and kept) left").first()
    assert r["toxic"] > 50 and r["caught"] / r["toxic"] > 0.93 and r["left"] / r["good"] > 0.97, r


def test_quality_sample_is_bounded_and_stable(spark):
    rows, grades = rated(spark, 200)
    docs, labels = table(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int")
    a = quality.train(docs, labels, 3, bits=10, max_training_rows=50)
    b = quality.train(docs.repartition(7), labels.repartition(5), 3, bits=10, max_training_rows=50)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.thresholds, b.thresholds)


def test_quality_without_ratings(spark):
    docs = table(spark, [(1, "text")])
    empty = spark.createDataFrame([], "doc_id long, grade int")
    assert quality.train(docs, empty, 3) is None
    assert [tuple(r) for r in quality.score(docs, None, 3).collect()] == [(1, None, None, False)]
    assert quality.score(table(spark, []), None, 3).count() == 0


def test_ratings(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, None), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert ids(quality.ratings(labels), "grade") == [(1, 0), (2, 1), (3, 2), (4, None), (5, 2)]


# ---------------------------------------------------------------- html

ARTICLE = "<h1>Title &amp; more</h1><p>First, long paragraph with   several,\n commas, and words enough.</p><p>Second <b>bold</b> text&nbsp;here.<br>Line"


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=x>Menu</a></nav><article>{ARTICLE}</article><footer>&copy; f</footer></body></html>",
    f"<body><div class='top menu'><ul><li><a>a</a><li><a>b</a></ul></div><div id=content>{ARTICLE}</div><div class=sidebar><p>side, bar, text</p></div>"
    "<div id=comments><p>reader, comment, long, with, commas</p></div><div class='cookie-notice'>We use cookies</div>",
    f"<body><script>var t='</p>';</script><!-- <p>no</p> --><main>{ARTICLE}</main><form><input><p>Search, here</p></form><div role=banner>ad</div>",
    f"<body><header><h1>Site, name, of, the, page</h1></header><section>{ARTICLE}</section><aside>other</aside><div style='display: none'>hidden, text</div>",
])
def test_html_article(page):
    assert html.main_text(page) == ("Title & more\nFirst, long paragraph with several, commas, and words enough.\n"
                                    "Second bold text here. Line")


@pytest.mark.parametrize("name", ["with-sidebar", "has-sidebar", "content-no-sidebar", "site-header-fixed", "skip-lazy", "related-work",
                                  "social-science", "layout sidebar-right", "widget"])
def test_html_wrapper_that_mentions_furniture(name):
    whole = "Title & more\nFirst, long paragraph with several, commas, and words enough.\nSecond bold text here. Line"
    for page in (f"<div id=page class='{name}'>{ARTICLE}</div>",
                 f"<body><div id=page class='{name}'><div id=content>{ARTICLE}</div></div><div class='footer'><p>foot</p></div>",
                 f"<div id=page class='{name}'><article>{ARTICLE}</article></div><div id=comments><p>{'reader, comment, ' * 20}</p></div>"):
        assert html.main_text(page) == whole


@pytest.mark.parametrize("name", ["related-work", "social-science", "skip-lazy"])
def test_html_section_that_mentions_furniture(name):
    page = f"<article>{ARTICLE}<div class='{name}'><p>Its section</p></div><div class='share-buttons'><p>Share</p></div></article>"
    assert html.main_text(page).split("\n")[-1] == "Its section"


@pytest.mark.parametrize("name", ["sidebar-left", "cookie-notice", "site-footer", "related-posts", "ad-300x250", "comment-list"])
def test_html_furniture_by_whole_name(name):
    page = f"<body>{ARTICLE * 3}<div class='{name}'><article><p>other, text</p></article><article><p>more</p></article></div>"
    assert "other" not in html.main_text(page)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>", ""), ("<p>a<p>b", "a\nb"), ("a < b &lt; c", "a < b < c"),
    ("<div><p>x</div></p></div><p>y", "x\ny"), ("<script>only", ""), ("<!-- open", ""), ("<p title='a>b'>t</p>", "t"), ("<P>Caps</P>", "Caps"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<table><tr><td>a<td>b</table>", "a\nb"), ("&am &amp &quo", "&am & &quo")])
def test_html_awkward(page, text):
    assert html.main_text(page) == text


def test_html_sections_and_long_pages(spark):
    body = "".join(f"<div class=part><p>Paragraph {i}, with, commas and text.</p></div>" for i in range(400))
    page = f"<body><nav>m</nav><div>{body}</div><footer>f</footer>"
    expected = "\n".join(f"Paragraph {i}, with, commas and text." for i in range(400))
    rows = [(1, "u", page, "t"), (1, "u", page, "t"), (2, None, None, None), (None, "v", "<p>x", "t")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(1, "u", expected, len(expected)), (1, "u", expected, len(expected)), (2, None, "", 0), (None, "v", "x", 1)], key=repr)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_deep_nesting():
    assert html.main_text("<div>" * 5000 + "<p>deep</p>") == "deep"


# ---------------------------------------------------------------- language ID

LANGS = {"en": "the house of the old man is near the river and they like walking", "de": "das haus des alten mannes liegt nahe dem fluss und sie gehen gern",
         "fr": "la maison du vieil homme est proche de la rivière et ils aiment marcher"}


def language_rows():
    rng = random.Random(6)
    rows = []
    for i in range(150):
        lang = rng.choice(list(LANGS))
        rows.append((i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(rng.randrange(3, 30))), lang, "s"))
    return rows + [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 !! 3", "fr", "s"), (1003, "the old house", None, "s"),
                   (1003, "the old house", None, "s"), (1004, "日本語の文", None, "s"), (None, "das haus", "de", "s")]


def test_language_equals_brute_force(spark):
    rows = language_rows()
    import zlib
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    bank = langid.Bank()
    proto = {}
    for d, t, lang, _ in rows:
        if d is not None and not held(d) and lang and t:
            keys, counts = langid.trigrams(t)
            if len(keys):
                w = counts * langid.TEXT_WEIGHT // counts.sum()
                proto[lang] = proto.get(lang, 0) + sum(x * bank.bind(k).astype(np.int64) for k, x in zip(keys.tolist(), w.tolist()))
    got = sorted((tuple(r) for r in langid.identify(table(spark, rows)).drop("text").collect()), key=repr)
    expected = []
    for d, t, _, _ in rows:
        v = brute.language_vector(t, bank) if t and any(c.isalpha() for c in t) else None
        if v is None:
            expected.append((d, held(d), "und", 0.0))
        else:
            cos = {k: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for k, p in sorted(proto.items())}
            best = max(cos, key=cos.get)
            expected.append((d, held(d), best, min(1.0, max(0.0, cos[best]))))
    assert [r[:3] for r in got] == [r[:3] for r in sorted(expected, key=repr)]
    assert all(abs(a[3] - b[3]) < 1e-4 for a, b in zip(got, sorted(expected, key=repr)))


def test_language_learns_rare_trigrams_of_a_long_text(spark):
    text = "ab " * 40_000 + "xyz"
    keys, counts = langid.trigrams(text)
    got = langid.learn(spark.createDataFrame([(text, "xx")], "text string, lang string"))["xx"]
    exact = sum(x * langid.Bank().bind(k).astype(np.int64) for k, x in zip(keys.tolist(), counts.tolist()))
    assert np.abs(got * counts.sum() / langid.TEXT_WEIGHT - exact).max() < 0.5


def test_language_held_out_accuracy(spark):
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    r = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").selectExpr(
        "count(*) n", "count_if(lang = lang_pred) good").first()
    assert r["n"] > 200 and r["good"] / r["n"] > 0.95


def test_language_without_training_rows(spark):
    assert [r["lang_pred"] for r in langid.identify(table(spark, [(1, "text", None, None)])).collect()] == ["und"]
    assert langid.identify(table(spark, [])).count() == 0


def test_language_bank_limit():
    """A bank that is too small for a text gives the same vector."""
    keys, counts = langid.trigrams("the quick brown fox jumps over the lazy dog " + "".join(chr(0x4E00 + i) for i in range(200)))
    assert np.allclose(langid.Bank(128).bundle(keys, counts), langid.Bank(128, limit=16).bundle(keys, counts))


# ---------------------------------------------------------------- BPE

def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_bpe_joins_equal_the_library():
    tok, c, rng = library(), bpe.codec(*bpe.default_vocabulary()), random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "'s", "'re", "'", "1", "23", "é", "日本", "<|endoftext|>", "<|", "|>", ".", "!!", "====",
             "\t", "\x85", "　", "😀", "hello" * 30, "ß" * 40, "7" * 50, "x" * 200]
    for _ in range(400):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        leaf = rng.choice([1, 3, 7, 20, 64])
        leaves = [(p.encode(), c.encode(p)) for p in (s[i:i + leaf] for i in range(0, len(s), leaf))]
        text, got = bpe.concatenate(c, leaves, window=rng.choice([1, 16, 32, 64]))
        assert text == s.encode() and got.tolist() == tok.encode(s, add_special_tokens=False).ids
        assert c.decode(got).decode() == tok.decode(got.tolist(), skip_special_tokens=False)


def test_bpe_documents_equal_the_library(spark):
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, "x" * 900), (3, "x" * 900), (4, "日本語" * 300), (5, prose(rng, 400)), (6, " " * 500 + "a"),
            (7, "a<|endoftext|>b" * 60), (None, "null id " * 40), (8, "é" * 33), (9, prose(rng, 3000))]
    tok = library()
    got = bpe.digest_documents(bpe.encode_documents(table(spark, rows), leaf_chars=33)).collect()
    expected = []
    for d, t in rows:
        i = tok.encode(t or "", add_special_tokens=False).ids
        expected.append((d, len(i), brute.sha(np.array(i, "<u4").tobytes()), brute.sha(tok.decode(i, skip_special_tokens=False)), True))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert bpe.encode_documents(table(spark, [])).count() == 0


def test_bpe_nodes_are_their_ids():
    """A stored node is two bytes a token; a text that its ids don't tell stays."""
    vocabulary = bpe.default_vocabulary()
    c, texts = bpe.codec(*vocabulary), [b"the river", "日本 <|endoftext|>".encode()]
    cut = pa.RecordBatch.from_pydict({"doc_id": [1, 1], "key": [0, 0], "part": [0, 1], "parts": [2, 2],
                                      "text": pa.array(texts, pa.binary()), "ids": pa.array([b"", b""], pa.binary())})
    leaves = pa.Table.from_batches(bpe._encode_leaves(vocabulary)(iter([cut])))
    assert leaves["text"].to_pylist() == [None, None]
    tokens = [c.encode(t.decode()) for t in texts]
    assert [len(x) for x in leaves["ids"].to_pylist()] == [2 * len(t) for t in tokens]
    assert [c.read_node(t, i)[0] for t, i in zip(leaves["text"].to_pylist(), leaves["ids"].to_pylist())] == texts
    node = bpe._join_round(vocabulary, bpe.FIRST_WINDOW, False)(leaves).to_pylist()[0]
    assert node["text"] is None and len(node["ids"]) == 2 * len(c.encode("the river日本 <|endoftext|>"))
    done = bpe._join_round(vocabulary, bpe.FIRST_WINDOW, True)(leaves).to_pylist()[0]
    assert done["text"] == b"".join(texts) and np.frombuffer(done["ids"], "<u4").tolist() == c.encode("the river日本 <|endoftext|>").tolist()
    other = c.node(b"another text", tokens[0])
    assert other[0] == b"another text" and c.read_node(*other)[0] == b"another text"
