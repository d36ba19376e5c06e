"""Quality rules: a table of thresholds, compiled into one Spark projection over each whole text.

Every text gives integer counts (words, characters, symbols, stop words, lines). A rule bounds the ratio of two of them, and
the table of rules becomes one array expression that names the rules a text breaks. Nothing is shuffled and no Python runs:
counts and verdict are built-in functions of one row, so the work is in proportion to the text and a lost task is redone alone.

Repeated windows are found by sorting a text's own windows with their places: equal ones are neighbours then. That takes
n log n for n words, where a look-up of each window among all others would take n squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MARKS = "[!?.,;:]"

#: The commonest short words of the languages that the corpus is meant to hold; another table is a parameter.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "by", "at", "from", "this", "be", "or",
    "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "ein", "eine", "für", "auf", "dem", "nicht", "im", "sich", "als", "des",
    "el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "para", "del", "se", "es", "al",
    "le", "les", "et", "du", "une", "est", "dans", "pour", "qui", "sur", "pas", "au", "par", "ce", "il", "ne",
]


class Rule(NamedTuple):
    """A text breaks the rule if part / whole is under least or over most (a bound that is None does not hold it).

    part and whole are names of counts; the ratio of a text whose whole is 0 counts as 0. Without whole, the part itself counts."""

    name: str
    part: str
    whole: str | None = None
    least: float | None = None
    most: float | None = None


#: The thresholds of the registered query. `base` names the contracted failures, which are rules like others.
BASE = [
    Rule("few_words", "n_words", least=50),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.5),
]
RULES = [
    *BASE,
    Rule("word_length", "word_chars", "n_words", least=2.0, most=20.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("marks", "n_marks", "word_chars", most=0.15),
    Rule("capitals", "n_capitals", "word_chars", most=0.5),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", most=0.3),
]

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals", "n_stop_words", "n_bullet_lines", "n_cut_lines"]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it: the value is the variable of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _repeated_words(words: Column, width: int = 3) -> Column:
    """Number of words inside a window of `width` words that the array holds twice or more."""
    def places(found: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(found, a)["window"] == F.get(found, b)["window"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return _size(F.array_distinct(F.flatten(F.transform(twice, lambda j: F.sequence(F.get(found, j)["at"], F.get(found, j)["at"] + width - 1)))))

    window = lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(width)))  # noqa: E731  words hold no blanks, so this is exact
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.struct(window(i).alias("window"), i.alias("at")))
    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(_bound(F.sort_array(windows), places))


def _of(text: Column, signs: str) -> Column:
    """Number of characters of text in a class of a regular expression."""
    return F.regexp_count(text, F.lit(signs)).cast("long")


def text_counts(text: Column, stop_words: Iterable[str] = tuple(STOP_WORDS)) -> Column:
    """A struct of the counts of a text; null counts as empty.

    Words are runs of anything but ASCII white space. n_lines are lines with a word, n_dup_lines those equal to an earlier
    one; n_cut_lines end in an ellipsis, n_bullet_lines begin with a bullet; n_marks are signs of punctuation."""
    stops = sorted(set(stop_words))
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(words: Column) -> list[Column]:
        stop = F.filter(words, lambda w: F.lower(w).isin(stops)) if stops else F.array()
        return [_size(words).alias("n_words"), _repeated_words(words).alias("n_repeat_words"), _size(stop).alias("n_stop_words")]

    def of_lines(lines: Column) -> list[Column]:
        count = lambda test: _size(F.filter(lines, test))
        return [
            _size(lines).alias("n_lines"), (_size(lines) - _size(F.array_distinct(lines))).alias("n_dup_lines"),
            count(lambda x: x.rlike(rf"(\.\.\.|…){SPACE}*$")).alias("n_cut_lines"), count(lambda x: x.rlike(rf"^{SPACE}*[-*•‣·]")).alias("n_bullet_lines"),
        ]

    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    whole = _bound(text, lambda t: F.struct(
        (F.char_length(t).cast("long") - _of(t, SPACE)).alias("word_chars"), _of(t, SYMBOLS).alias("n_symbols"), _of(t, MARKS).alias("n_marks"), _of(t, "[A-Z]").alias("n_capitals"),
    ))
    return F.struct(_bound(words, lambda w: F.struct(*of_words(w))).alias("w"), _bound(lines, lambda x: F.struct(*of_lines(x))).alias("l"), whole.alias("t"))


def _flat(counts: Column) -> list[Column]:
    place = {"w": ["n_words", "n_repeat_words", "n_stop_words"], "l": ["n_lines", "n_dup_lines", "n_cut_lines", "n_bullet_lines"], "t": ["word_chars", "n_symbols", "n_marks", "n_capitals"]}
    at = {name: counts[part][name].alias(name) for part, names in place.items() for name in names}
    return [at[name] for name in COUNTS]


def broken_rules(rules: Iterable[Rule]) -> Column:
    """An array of the names of the rules, in their order, that the counts in a row's columns break."""
    def broken(r: Rule) -> Column:
        value = F.col(r.part).cast("double")
        if r.whole:
            value = F.when(F.col(r.whole) == 0, F.lit(0.0)).otherwise(value / F.col(r.whole))
        tests = ([value < float(r.least)] if r.least is not None else []) + ([value > float(r.most)] if r.most is not None else [])
        return F.when(tests[0] | tests[-1], F.lit(r.name)) if tests else F.lit(None).cast("string")

    found = [broken(r) for r in rules]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def rules_of(table: DataFrame, most: int = 10_000) -> list[Rule]:
    """Rules from a table with the columns name, part, whole, least and most, in the order of their names.

    A table of more than `most` rules raises: a projection is compiled from them, so they are no data."""
    rows = table.select("name", "part", "whole", F.col("least").cast("double"), F.col("most").cast("double")).orderBy("name", "part").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    if unknown := {c for r in rows for c in (r["part"], r["whole"]) if c and c not in COUNTS}:
        raise ValueError(f"no such counts: {', '.join(sorted(unknown))}")
    return [Rule(*r) for r in rows]


def quality_rules(docs: DataFrame, rules: Iterable[Rule] = tuple(RULES), stop_words: Iterable[str] = tuple(STOP_WORDS)) -> DataFrame:
    """One row for each row of docs: doc_id, the counts of its whole text, rules_failed (names), base_failed and kept.

    base_failed tells whether a rule of BASE is broken, kept that neither those nor any of `rules` are. Null and empty texts
    have counts of 0 and fail for their few words. Rows that repeat, and null ids, are judged each by itself. Other columns
    of docs are ignored, whatever their names; an empty table gives an empty one.
    """
    rules = list(rules)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_counts(F.col("text"), stop_words).alias("_counts"))
    flat = counted.select("doc_id", *_flat(F.col("_counts")))
    judged = flat.withColumn("rules_failed", broken_rules(rules)).withColumn("base_failed", F.size(broken_rules(BASE)) > 0)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rules_failed") == 0))


def keep_by_rules(docs: DataFrame, rules: Iterable[Rule] = tuple(RULES), stop_words: Iterable[str] = tuple(STOP_WORDS)) -> DataFrame:
    """The rows of docs, with all their columns, that break no rule; null texts go, equal rows are judged alike."""
    rules = [*BASE, *rules]
    row = docs.select(F.struct("*").alias("_row"), text_counts(docs["text"], stop_words).alias("_counts")).select("_row", *_flat(F.col("_counts")))
    return row.where(F.size(broken_rules(rules)) == 0).select("_row.*")
