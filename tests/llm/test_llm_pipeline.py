"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from aurum.llm import decontaminate, lines  # noqa: E402
from aurum.llm.common import materialize, read  # noqa: E402
from test_llm_operators import library, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(docs, items):
    """What each stage keeps: [{doc_id: text}, ...] and the last stage's rows."""
    out = []
    docs = [(d, t, s) for d, t, s in docs if t and any(c.isalpha() for c in t)]
    out.append({d: t for d, t, _ in docs})
    cleaned = brute.boilerplate(docs, lines.MIN_SITES)
    docs = [(d, cleaned[(d, t)][0], s) for d, t, s in docs if not cleaned[(d, t)][2] or cleaned[(d, t)][0].strip(" ")]
    out.append({d: t for d, t, _ in docs})
    docs = [(d, t) for (d, t, _), (_, _, c) in zip(docs, brute.near([(d, t) for d, t, _ in docs])) if d == c]
    out.append(dict(docs))
    words: dict = {}
    number = lambda t: np.array([words.setdefault(w, len(words)) for w in decontaminate.words(t)], np.int32)
    asked = [number(t) for _, t in items]
    docs = [(d, t) for d, t in docs if not any(
        len(q) >= decontaminate.NGRAM and decontaminate.align(q, number(t))[0] >= 0.5 * 2 * len(q) for q in asked)]
    out.append(dict(docs))
    tok, rows = library(), []
    for d, t in docs:
        i = tok.encode(t, add_special_tokens=False).ids
        rows.append((d, len(i), brute.sha(np.array(i, "<u4").tobytes()), brute.sha(t), True))
    return out, rows


@pytest.fixture(scope="module")
def expected(spark):
    docs = [tuple(r) for r in read(spark, SF, "documents").select("doc_id", "text", "source").collect()]
    return plain(docs, [tuple(r) for r in read(spark, SF, "benchmark").collect()])


def test_stages_equal_brute_force(spark, expected):
    stages, rows = expected
    docs = read(spark, SF, "documents")
    columns = docs.columns
    for (name, f), want in zip(P.STAGES, [*stages, None]):
        docs = materialize(f(spark, docs, SF), f"test-{name}")
        if want is None:
            assert sorted(map(tuple, docs.collect())) == sorted(rows)
        else:
            assert docs.columns == columns
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want


def test_run_equals_brute_force(spark, expected):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(expected[1])


def test_stages_take_awkward_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " "), (4, "word"), (4, "word"), (None, "null id"), (5, "tab\tand\nline"), (7, "some words")]
    spark.createDataFrame([(0, "some item of the benchmark")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (rows, []):
        docs = table(spark, [(*r, "en", "s") for r in given])
        for name, f in P.STAGES:
            docs = materialize(f(spark, docs, str(tmp_path)), f"awkward-{name}")
        assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == ([4, 4, 5, 7, None] if given else [])


CLASHING = ["_print", "lines_n", "lines_removed", "score", "lang_pred", "a.b", "Text", "DOC_ID", "print", "component_id", "places", "c0", "`x`"]


@pytest.mark.parametrize("name, stage", P.STAGES[:-1])
def test_stages_leave_other_columns_alone(spark, tmp_path, name, stage):
    """Columns named like those that operators add, in other cases or with dots."""
    spark.createDataFrame([(0, "an item of the benchmark, long enough to be found")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [(i, t, "en", f"s{i}", len(t)) for i, t in enumerate(["first document of words", "another text altogether", "line\ntwo"])]
    given = [(*r, *[f"{r[0]}-{c}" for c in CLASHING]) for r in rows]
    docs = spark.createDataFrame(given, [f"x{i}" for i in range(len(own) + len(CLASHING))]).toDF(*own, *CLASHING)
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == [*own, *CLASHING]
    assert sorted(tuple(r) for r in out.collect()) == given


def test_language_stage_fills_languages_and_keeps_a_corpus_without_any(spark):
    rows = [(i, "the words of this text are these and those", "en", "s", 1) for i in range(30)]
    rows += [(90, "the words of that text", None, "s", 1), (91, "123 !!", None, "s", 1), (92, None, None, "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    kept = {r["doc_id"]: r["lang"] for r in P.language_id(spark, spark.createDataFrame(rows, schema), SF).collect()}
    assert kept == {**{i: "en" for i in range(30)}, 90: "en"}
    bare = [(d, t, None, s, n) for d, t, _, s, n in rows]
    kept = {r["doc_id"]: r["lang"] for r in P.language_id(spark, spark.createDataFrame(bare, schema), SF).collect()}
    assert kept == {i: None for i in [*range(30), 90]}
