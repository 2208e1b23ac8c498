"""Operators 11 to 13 against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from aurum.llm import divergence, fim, rules

SCHEMA = "doc_id long, text string, lang string, source string, print long, place string, `a.b` int, Text string, n long"


def table(spark, rows):
    """Documents with further columns whose names clash with the operators'."""
    return spark.createDataFrame([(*r, 7, "x", 1, "y", -1) for r in rows], SCHEMA)


def texts(seed: int, count: int) -> list:
    rnd = random.Random(seed)
    words = ["the", "of", "Über", "straße", "x" * 40, "naïve", "a", "b", "donaudampfschifffahrt", "donaudampfmaschine", "日本語", "É", "#", "|", "ab<P"]
    out = []
    for _ in range(count):
        lines = [" ".join(rnd.choices(words, k=rnd.randint(0, 12))) for _ in range(rnd.randint(0, 6))]
        out.append(rnd.choice(["\n", "\r\n", "\n\n"]).join(lines))
    return out


ODD = [None, "", " ", "\n\n", "a", "x<P>y", "<S>", "😀" * 30, "<" * 50, "a<", "🙂 the of " * 3000]


def documents(seed=3, count=300):
    rnd = random.Random(seed)
    rows = [(i, t, rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "s3", None])) for i, t in enumerate(texts(seed, count) + ODD)]
    rows += [(None, "no id the of", "en", "s1"), (None, None, None, None), (5, "other text of five", "en", "s9")]
    return rows + rows[:40] + rows[:40]


def sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


# -- fill-in-middle ----------------------------------------------------------

def plain_fim(doc_id, text):
    t = text or ""
    n = len(t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(t), sha(t)
    p, m, s = t[:a], t[a:b], t[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if h4 % 100 < 20 else "psm", a, b - a, sha(out), sha(t)


@pytest.mark.parametrize("piece", [3, 8192])
def test_fill_in_middle_equals_whole_texts(spark, piece):
    rows = documents(count=60 if piece == 3 else 300)
    found = Counter(tuple(r) for r in fim.transform(table(spark, rows).repartition(5), piece=piece).collect())
    assert found == Counter(plain_fim(r[0], r[1]) for r in rows)
    assert {k[2] for k in found} == {"plain", "psm", "spm"}


def test_fill_in_middle_counts_repeated_rows_of_many_tasks(spark):
    rows = [(1, "the same text", "en", "s")] * 500 + [(1, "another", "en", "s")] * 3
    found = Counter(tuple(r) for r in fim.transform(table(spark, rows).repartition(16)).collect())
    assert found == Counter(plain_fim(r[0], r[1]) for r in rows)


def test_fill_in_middle_pieces_join_to_the_output(spark):
    rows = [r for r in documents()[:300] if r[1]]
    got = defaultdict(list)
    for r in fim.pieces(table(spark, rows), piece=5).collect():
        assert len(r["piece"].decode()) <= 5
        got[r["doc_id"]].append((r["place"], r["piece"]))
    for d, parts in got.items():
        assert sha(b"".join(p for _, p in sorted(parts)).decode()) in {plain_fim(d, r[1])[5] for r in rows if r[0] == d}


def test_fill_in_middle_of_an_empty_table(spark):
    out = fim.transform(table(spark, []))
    assert out.count() == 0
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_fill_in_middle_shuffles_once(spark):
    plan = fim.transform(table(spark, documents()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


def test_fill_in_middle_holds_few_pieces(monkeypatch):
    """A task holds few of a batch's pieces as Python objects, and gives memory back at its end."""
    given = []
    monkeypatch.setattr(fim, "give_back", lambda: given.append(1), raising=False)
    n, piece = 4000, b"x" * fim.PIECE
    rows = [(1, b"p", i, "plain", n * fim.PIECE, None, None, 1 if i == 0 else 0, piece) for i in range(n)]
    batch = fim._batch(rows, fim._CUT)
    sizes = []
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for passed in fim._assemble(iter([batch])):
            sizes.append(passed.num_rows)
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert sum(sizes) == n + 1 and peak < n * fim.PIECE / 2
    text = "ab " * 2_000_000
    docs = pa.record_batch({"doc_id": [1, 2, 3], "text": [text, text, None]})
    cut = list(fim._cut(fim.PIECE)(iter([docs])))
    assert max(b.nbytes for b in cut) < 2 * fim.BATCH_CHARS and sum(b.num_rows for b in cut) > 1400
    assert list(fim._restore(iter([]))) == [] and len(given) == 3


# -- source divergence -------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, min_docs=3, top=200):
    docs = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    held = defaultdict(Counter)
    for lang, _, w in docs:
        held[lang].update(set(w))
    kept = {lang: {t for t, k in c.items() if k >= min_docs} for lang, c in held.items()}
    count = defaultdict(Counter)
    for lang, source, w in docs:
        own = [t for t in w if t in kept[lang]]
        count[lang, source].update(own)
        count[lang, None].update(own)
    share = {}
    for key, c in count.items():
        terms = kept[key[0]]
        share[key] = {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(terms)) for t in terms}
    out = set()
    for (lang, source), p in share.items():
        if source is None:
            continue
        pairs = [(s, sum((p[t] - q[t]) ** 2 // q[t] for t in p)) for (x, s), q in share.items() if x == lang and s not in (None, source)]
        of = share[lang, None]
        terms = [(t, (p[t] - of[t]) ** 2 // of[t]) for t in p if count[lang, source][t] > 0 and p[t] > of[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, i, v, k) for k, (i, v) in enumerate(items[:limit], 1)}
    return out


@pytest.mark.parametrize("first, bits", [(4, 23), (3, 6)])
def test_divergence_equals_counting_all(spark, first, bits):
    rows = documents()
    out = divergence.audit(table(spark, rows).repartition(4), first_level=first, map_bits=bits, top=5)
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_audit(rows, top=5)


def test_divergence_blocks_read_eight_bytes_at_once():
    """The terms of a block and their first bytes, as whole integers, are those
    of its texts one by one; none crosses from a text to the next."""
    import re
    texts = ["", "Ab c", "d", "", "é漢字x\x00Y", "abcdefgh", "ABCDEFGHi jklmnopqrstuvwxyzab", "1", "z"]
    block = divergence._Block([""] * len(texts), texts)
    want = [(i, m.lower()) for i, t in enumerate(texts) for m in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.encode())]
    assert [(int(d), block.data[b:b + n].tobytes()) for b, n, d in zip(block.begin, block.length, block.doc)] == want
    for level in (1, 3, 8, 16, 24):
        cells = divergence._cells(block.words, block.begin, block.length, level)
        assert len(cells) == -(-level // 8)
        got = [b"".join(int(c[i]).to_bytes(8, "big") for c in cells) for i in range(len(want))]
        assert got == [w[:level].ljust(8 * len(cells), b"\0") for _, w in want]
    assert not len(divergence._Block([""], [""]).begin)


def test_divergence_of_long_terms_that_share_beginnings(spark):
    rnd = random.Random(5)
    stems = ["w" * k for k in (3, 4, 5, 8, 9, 16, 31, 32, 33, 64, 70)]
    rows = [(i, " ".join(rnd.choice(stems) + rnd.choice(["", "a", "b", "é"]) for _ in range(rnd.randint(1, 6))), rnd.choice(["x", "y"]), f"s{rnd.randint(0, 3)}")
            for i in range(80)]
    assert {tuple(r) for r in divergence.audit(table(spark, rows)).collect()} == plain_audit(rows)


def test_divergence_of_empty_tables_and_rare_terms(spark):
    assert divergence.audit(table(spark, [])).count() == 0
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", None)]
    assert {tuple(r) for r in divergence.audit(table(spark, rows)).collect()} == plain_audit(rows)
    assert {r[4] for r in plain_audit(rows)} == {0}


def test_terms_end_with_their_text(spark):
    rows = [(i, "ab", "en", "a") for i in range(3)] + [(9, "cd", "en", "a")]
    found = {(r["term"], r["count"]) for r in divergence.kept_terms(table(spark, rows).coalesce(1)).collect()}
    assert found == {("ab", 3)}


# -- quality rules -----------------------------------------------------------

def plain_rules(doc_id, text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    repeat = len({j for i, g in enumerate(windows) if seen[g] > 1 for j in range(i, i + 5)})
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    symbols = sum(t.count(c) for c in "#*$%&|<>")
    dup = len(lines) - len(set(lines))
    apart = str.maketrans(rules.PUNCTUATION + "\t\n\x0b\x0c\r", " " * (len(rules.PUNCTUATION) + 5))
    stop = sum(x in set(rules.STOP_WORDS) for x in t.translate(LOWER).translate(apart).split(" "))
    n, chars = len(w), sum(map(len, w))
    failed = n < 10 or 100 * repeat > 20 * n
    good = (200 * n <= 100 * chars <= 1500 * n and 100 * symbols <= 10 * n and (n < 50 or 100 * stop >= 2 * n)
            and (len(lines) < 4 or 100 * dup <= 30 * len(lines)))
    return doc_id, n, chars, symbols, dup, repeat, failed, not failed and good, len(lines), stop


def test_rules_equal_plain_counting(spark):
    rows = documents(seed=11) + [(900, "same line of the text\n" * 50, "en", "s"), (901, "a b c d e f g h i j k a b c d e x", "en", "s"),
                                 (902, "of the " * 5, "en", "s"), (903, "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5 w6", "en", "s")]
    found = Counter(tuple(r)[:-1] for r in rules.apply_rules(table(spark, rows)).collect())
    assert found == Counter(plain_rules(r[0], r[1]) for r in rows)


def test_rules_of_an_empty_table_and_without_rules(spark):
    assert rules.apply_rules(table(spark, [])).count() == 0
    row = rules.apply_rules(table(spark, [(1, " ".join(f"%{i}" for i in range(12)), "en", "s")]), rules=()).first()
    assert row["kept"] and row["broken_rules"] == []


def test_broken_rules_are_named(spark):
    row = rules.apply_rules(table(spark, [(1, " ".join(f"%{i}abc" for i in range(60)), "en", "s")])).first()
    assert not row["kept"] and row["broken_rules"] == ["symbols", "stop_words"]


def test_rules_are_one_map_without_python(spark):
    plan = rules.apply_rules(table(spark, documents()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_leave_good_documents_and_drop_spam(spark):
    sf = "/root/testdata/sf0.1"
    judged = rules.apply_rules(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    both = {(r["quality"], r["kept"]): r["count"] for r in judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert both[1, True] / (both[1, True] + both.get((1, False), 0)) > 0.97
    assert both.get((0, True), 0) / (both.get((0, True), 0) + both[0, False]) < 0.1
