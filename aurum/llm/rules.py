"""Quality rules as one projection (operator 13).

A table of thresholds (``RULES``) is compiled into column expressions: each rule
bounds a ratio of two counts of the text in hundredths, as a comparison of
integers. All counts come from built-in array and string functions over the
row's own text, so the operator is a map over the table: no shuffle, no user
function, and a row's work is n log n in its words at most (the sort of its
word windows).
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import WHITE, columns_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Read as spaces where stop words are counted.
PUNCTUATION = ".,;:!?\"'()"

# Frequent function words of the languages read.
STOP_WORDS = ("the of and to in is that it for on with as was are be this by at from or an "
              "der die das und ist von zu den mit des im für auf ein eine nicht sich auch "
              "le la les de des et un une du en est que qui dans pour pas sur au "
              "el los las y del se por con una para no su al lo como").split()


class Rule(NamedTuple):
    """``low <= 100 * count / per <= high``; a bound of None is open. Rows with
    ``per`` below ``least`` are too short to be judged by the rule."""

    name: str
    count: str
    per: str
    low: int | None
    high: int | None
    least: int = 0


#: Of the rows that pass the base rules.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 2, None, 50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 30, 4),
)
#: Base rules: fewer words, or a larger share of words in repeated windows, fail.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def compile_rules(rules: Iterable[Rule]) -> list[tuple[str, Column]]:
    """Per rule its name and whether a row breaks it."""
    out = []
    for r in rules:
        hundredfold, per = 100 * F.col(r.count), F.col(r.per)
        broken = F.lit(False)
        if r.low is not None:
            broken = broken | (hundredfold < r.low * per)
        if r.high is not None:
            broken = broken | (hundredfold > r.high * per)
        out.append((r.name, (per >= r.least) & broken))
    return out


def _long(c: Column) -> Column:
    return c.cast("long")


def _starts(words: Column, n: int) -> Column:
    return F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))


def _run_hashes(hashes: str, n: int) -> Column:
    """A hash for each run of n words."""
    h = F.col(hashes)
    return F.transform(_starts(h, n), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]))


def _runs(words: str, n: int) -> Column:
    """The runs of n words with their places, equal ones beside each other."""
    w = F.col(words)
    return F.array_sort(F.transform(_starts(w, n), lambda x, i: F.struct(
        F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, n)]).alias("run"), i.alias("at"))))


def _repeated(runs: str) -> Column:
    """Places of the runs found twice or more, ascending."""
    s = F.col(runs)
    same = lambda x, j: F.coalesce(F.get(s, j)["run"] == x["run"], F.lit(False))
    places = F.transform(s, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["at"]))
    return F.array_sort(F.filter(places, lambda p: p.isNotNull()))


def _covered(places: str, n: int) -> Column:
    """How many words the runs of n words at these places cover."""
    p = F.col(places)
    own = F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n))))
    return F.aggregate(own, F.lit(0).cast("long"), lambda a, b: a + b)


def measure(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and the counts that rules refer to, one row per row."""
    white = "[\\x20\\x09-\\x0D]+"
    has_word = "[^\\x20\\x09-\\x0D]"
    text = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = text.select(
        "doc_id", "text",
        F.filter(F.split("text", white), lambda x: x != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(has_word)).alias("lines"))
    # Equal runs have equal hashes: only texts that hold a hash twice have
    # their runs themselves sorted and compared.
    hashed = cut.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    hashed = hashed.withColumn("hashes", _run_hashes("hashes", window))
    runs = hashed.withColumn("runs", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _runs("words", window)))
    places = runs.withColumn("places", F.coalesce(_repeated("runs"), F.array().cast("array<int>")))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    apart = PUNCTUATION + WHITE
    folded = F.split(F.translate("text", upper + apart, lower + " " * len(apart)), " ")
    return places.select(
        "doc_id",
        _long(F.size("words")).alias("n_words"),
        _long(F.char_length(F.array_join("words", ""))).alias("word_chars"),
        _long(F.regexp_count("text", F.lit("[" + SYMBOLS + "]"))).alias("n_symbols"),
        _long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _covered("places", window).alias("n_repeat_words"),
        _long(F.size("lines")).alias("n_lines"),
        _long(F.size(F.filter(folded, lambda x: x.isin(STOP_WORDS)))).alias("n_stop_words"))


def apply_rules(docs: DataFrame, rules: Iterable[Rule] = RULES, *, min_words: int = MIN_WORDS,
                max_repeat_percent: int = MAX_REPEAT_PERCENT, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept``, then ``n_lines``, ``n_stop_words`` and the names of the
    ``broken_rules``; one row per row of ``docs``.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` of the words in windows that the text holds twice.
    ``kept``: not failed and no rule broken. A null text is an empty one, which
    fails; a null doc_id and repeated rows are rows like others; the other
    columns, whatever their names, are not read. Texts of any length are read
    whole. An empty table gives an empty table.
    """
    m = measure(docs, window=window)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(is_broken, F.lit(name)) for name, is_broken in compile_rules(rules)], F.lit(None).cast("string")))
    judged = m.withColumns({"base_failed": failed, "broken_rules": broken})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size("broken_rules") == 0)).alias("kept"),
                         "n_lines", "n_stop_words", "broken_rules")
