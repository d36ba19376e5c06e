"""Operators 11 to 13 against brute force, with nulls, empty and very long texts, ties, repeated rows, clashing names."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import quality_rules as rules
from ledgerlake.llm import ranked_search as search
from ledgerlake.llm import source_divergence as sources
from ledgerlake.llm.quality_rules import BASE, RULES, Rule, keep_by_rules, quality_rules, rules_of
from ledgerlake.llm.ranked_search import ranked_search, term_index
from ledgerlake.llm.source_divergence import source_divergence
from ledgerlake.llm.terms import ALNUM, LETTERS, count_terms

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, term string, row string, rank string, item_id string, kept string, _row string"
DOCS = [
    (1, "the cat sat on the mat the cat sat on"), (1, "the cat sat on the mat the cat sat on"), (2, None), (3, ""), (None, "The Cat-9 été ÉTÉ|x"), (4, "a\nb\na\n \n\na"),
    (5, " \t\n\x0b\x0c\r "), (6, "aa aa aa aa aa"), (7, "x" * 30_000), (8, "İstanbul ʼcat\x00cat\x1ccat ﬀ"), (9, "- one\n- two...\n* three…\n#$% 4"),
]


def table(spark, rows, lang="en", source="s"):
    more = [(i, t, lang, source, *["x"] * 7) if len(r) == 2 else (*r, *["x"] * 7) for r in rows for i, t in [r[:2]]]
    return spark.createDataFrame(more, SCHEMA)


# -- 11

def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    of, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        hit |= {i, i + 1, i + 2} if of[w] > 1 else set()
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_counts_of_rules(spark):
    long = " ".join(f"w{i % 7}" for i in range(40_000)) + "\n" + " ".join(f"v{i}" for i in range(40_000))
    docs = [*DOCS, (10, long), (11, "\n".join(["same line here"] * 5000))]
    got = quality_rules(table(spark, docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = [(i, *counts(t)) for i, t in docs]
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.rules_failed)
    nine = next(r for r in got if r.doc_id == 9)
    assert (nine.n_lines, nine.n_bullet_lines, nine.n_cut_lines) == (4, 3, 2)


def test_rules_have_bounds_and_tables(spark):
    words = " ".join(f"word{i}" for i in range(100))
    docs = table(spark, [(1, words), (2, words + " the" * 3), (3, words.upper()), (4, None)])
    kept = lambda rules: {r.doc_id for r in quality_rules(docs, rules).where("kept").collect()}
    assert kept([]) == {1, 2, 3}
    assert kept([Rule("stops", "n_stop_words", least=3)]) == {2}
    assert kept([Rule("exact", "n_stop_words", "n_words", least=3 / 103, most=3 / 103)]) == {2}
    assert kept([Rule("none", "n_words")]) == {1, 2, 3}
    assert kept(RULES) == {2}
    floats = [Rule(*r[:3], *(None if x is None else float(x) for x in r[3:])) for r in RULES]
    threshold_table = spark.createDataFrame([tuple(r) for r in floats], "name string, part string, whole string, least double, most double")
    assert rules_of(threshold_table) == sorted(floats)
    with pytest.raises(ValueError):
        rules_of(threshold_table, most=3)
    with pytest.raises(ValueError):
        rules_of(threshold_table.withColumn("part", F.lit("text")))
    assert quality_rules(docs, stop_words=[]).where("n_stop_words > 0").count() == 0
    out = keep_by_rules(docs, [])
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 2, 3}
    assert quality_rules(docs.limit(0)).collect() == [] and keep_by_rules(docs.limit(0)).collect() == []


def test_rules_are_one_projection(spark, tmp_path):
    table(spark, DOCS).write.parquet(str(tmp_path / "d"))
    plan = quality_rules(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Generate", plan) and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_rules_agree_with_labels(spark):
    judged = quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = judged.where("NOT base_failed").select("kept", "quality").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


# -- 12

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ranked(docs, items, k=10):
    texts = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    many, length = sum(1 for _, c in texts if c), sum(c.total() for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    of = defaultdict(set)
    for item, text in items:
        if item is not None:
            of[item] |= set(TERM.findall(lowered(text)))
    out = []
    for item, terms in of.items():
        found = []
        for i, c in texts:
            m = 10 + (90 * c.total() * many) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10):
    given = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id string, text string, term string, row string")
    return sorted((tuple(r) for r in ranked_search(term_index(table(spark, docs)), given, k).collect()), key=str)


def test_search_equals_brute_force(spark):
    items = [("a", "the cat"), ("b", None), ("c", ""), (None, "cat"), ("d", "été x 9"), ("a", "MAT zzz"), ("e", "unknown"), ("f", "aa b"), ("g", "ÉTÉ İstanbul ﬀ")]
    assert searched(spark, DOCS, items) == ranked(DOCS, items)
    assert searched(spark, DOCS, items, 1) == ranked(DOCS, items, 1)
    assert searched(spark, [], items) == [] and searched(spark, DOCS, []) == []


def test_search_prunes_safely(spark):
    """Frequent and rare terms, copies with equal scores, very long texts: pruning never changes the answer."""
    word = lambda i, j: f"w{(i * 7919 + j * j * 31 + j) % (5 + (j * i) % 97)}"
    docs = [(i, " ".join(word(i % 90, j) for j in range(3 + i % 40))) for i in range(300)]
    docs += [(1000 + i, "rare passage of several words") for i in range(40)] + [(5000, "w1 rare " * 20_000), (5001, " ".join(f"u{i}" for i in range(30_000)))]
    items = [(f"i{n}", " ".join(word(n * 3, j) for j in range(2 + n))) for n in range(12)] + [("p", "a rare passage w1 w2 w3 of several words u7"), ("q", "w0 w1 w2 w3 w4"), ("u", " ".join(f"u{i}" for i in range(3000)))]
    assert searched(spark, docs, items) == ranked(docs, items)
    assert searched(spark, docs, items, 3) == ranked(docs, items, 3)


def test_search_index_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(search, "BATCH", 3)
    batch = pa.record_batch([pa.array(range(4)), pa.array([9, 8, None, 7]), pa.array(["a b a", None, "c d e f", ""])], ["row", "id", "text"])
    rows = [r for b in search._counted(iter([batch])) for r in b.to_pylist()]
    assert [(r["row"], r["id"], r["n"], dict(zip(r["terms"], r["counts"]))) for r in rows] == [(0, 9, 3, {"a": 2, "b": 1}), (1, 8, 0, {}), (2, None, 4, dict.fromkeys("cdef", 1)), (3, 7, 0, {})]


def test_terms_of_slices():
    import pyarrow as pa

    text = "Ab9 é-É_x" * 500 + "z" * 900
    for pattern, plain in ((ALNUM, TERM), (LETTERS, re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"))):
        whole = Counter(t.encode() for t in plain.findall(lowered(text)))
        assert all(count_terms(pa.scalar(text), pattern, size) == whole for size in (1, 2, 7, 64, 10_000))
    assert not count_terms(pa.scalar(None, pa.string()), ALNUM)


# -- 13

def divergence(docs, least=30, most=50):
    letters = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    uses, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        found = Counter(letters.findall(lowered(text)))
        groups.add((lang or "", source or ""))
        uses[lang or "", source or ""].update(found)
        df[lang or ""].update(found.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        share = lambda count, total: 1 + (1000000000 * (count + 5)) // (total + 5 * len(kept))
        of, all_uses = {}, Counter()
        for g in groups:
            if g[0] == lang:
                total = sum(uses[g][t] for t in kept)
                of[g[1]] = {t: share(uses[g][t], total) for t in kept}
                all_uses.update({t: uses[g][t] for t in kept})
        q = {t: share(all_uses[t], sum(all_uses.values())) for t in kept}
        for a, p in of.items():
            pair = sorted((-sum(abs(p[t] - of[b][t]) for t in kept), b.encode(), b) for b in of if b != a)
            term = sorted((q[t] - p[t], t.encode(), t) for t in kept if uses[lang, a][t] > 0 and p[t] > q[t])[:most]
            for part, ranks in (("pair", pair), ("term", term)):
                out += [(lang, a, part, item, -value, rank) for rank, (value, _, item) in enumerate(ranks, 1)]
    return sorted(out)


def test_divergence_equals_brute_force(spark):
    docs = [(i, " ".join(f"{'Word' if j % 5 else 'été'}{'abcdefghij'[(i * j) % 10]}" for j in range(i % 23)), ["en", "de", None, ""][i % 4], ["s1", "s2", "s3", None, "S", "é"][(i * i) % 6]) for i in range(240)]
    docs += [(1, None, "en", "empty"), (2, "", "fr", "one"), (3, None, None, None), (4, "x " * 50_000 + "worda", "en", "long"), (4, "x " * 50_000 + "worda", "en", "long"), (5, "9 8", "it", "a"), (6, "-", "it", "b")]
    for least, most in ((1, 50), (3, 2), (30, 50), (10_000, 50)):
        got = sorted(tuple(r) for r in source_divergence(table(spark, docs), least, most).collect())
        assert got == divergence(docs, least, most)
    assert source_divergence(table(spark, docs).limit(0)).collect() == []


def test_divergence_counts_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sources, "HELD", 2)
    batch = pa.record_batch([pa.array(["a", "a", "b"]), pa.array(["s", "s", ""]), pa.array(["x y x", "x z", None])], ["lang", "source", "text"])
    uses, docs = Counter(), Counter()
    for r in (r for b in sources._counted(iter([batch])) for r in b.to_pylist()):
        uses[r["lang"], r["source"], r["term"]] += r["uses"]
        docs[r["lang"], r["source"], r["term"]] += r["docs"]
    assert uses == Counter({("a", "s", "x"): 3, ("a", "s", "y"): 1, ("a", "s", "z"): 1}) and docs["a", "s", "x"] == 2


def test_shares_beyond_64_bits(spark):
    row = spark.range(1).select(sources._share(F.lit(9 * 10**17), F.lit(4 * 10**18), F.lit(7)).alias("p")).first()
    assert row.p == 1 + (10**9 * (9 * 10**17 + 5)) // (4 * 10**18 + 35)


def test_base_rules_are_among_the_thresholds():
    assert set(BASE) <= set(RULES) and {r.part for r in rules.RULES} <= set(rules.COUNTS)


# -- the labelled sample of operators 4 and 6

def test_sample_has_one_row_for_each_id(spark):
    """One id on 100,000 rows is one row of the sample, always the same."""
    from ledgerlake.llm.quality import labelled_sample, sampled_texts

    docs = spark.range(0, 100_000, 1, 8).select(F.lit(7).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).unionByName(spark.createDataFrame([(8, None), (9, "a"), (9, "a")], "doc_id int, text string"))
    sample = labelled_sample(spark.createDataFrame([(7, 1), (8, 0), (9, 1), (10, 1)], "doc_id long, quality int"), "quality", 3, 5, 100)
    found = [sorted(map(tuple, sampled_texts(d, sample).collect())) for d in (docs, docs.repartition(5, "text"))]
    assert found[0] == found[1] and [(i, y) for i, y, _ in found[0]] == [(7, 1.0), (8, 0.0), (9, 1.0)] and found[0][1][2] is None
