"""Source divergence audit: how far the word use of the sources of a language lies apart.

Tasks count terms by language, source and term before anything is shuffled, so a source that holds most documents sends
one row for each of its terms and task. A term that is kept is pivoted into one wide row: arrays of its counts by the
number of the source within its language. Higher-order functions of the JVM turn a row into contributions of pairs of
sources, and partial aggregation sums them before they are shuffled.

A source without a term has a share of it all the same, p0, which depends on the source only. For a pair of sources, most
terms are in neither; each of them contributes |p0 - q0|. So rows emit only pairs of which one source at least has the
term, as the difference from |p0 - q0|, and that constant times the number of kept terms is added at the end. The sums are
equal, and the rows emitted follow the occurrences instead of terms times pairs.

Shares are computed in decimals of up to 38 digits, so counts beyond 2^63 / 10^9 are exact too.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.terms import LETTERS, count_terms, strings
from ledgerlake.storage import frugal, materialize

#: Distinct terms by source that a task holds before it sends their counts on.
HELD = 300_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, uses, docs) of (lang, source, text): sums of some rows."""
    uses: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in uses.items():
            terms = list(found)
            there = docs[lang, source]
            for at in range(0, len(terms), 100_000):
                some = terms[at : at + 100_000]
                n = len(some)
                yield pa.record_batch([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), strings(some), pa.array([found[t] for t in some], pa.int64()), pa.array([there[t] for t in some], pa.int64())], ["lang", "source", "term", "uses", "docs"])

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            all_uses, all_docs = uses[lang, source], docs[lang, source]
            found = count_terms(text, LETTERS)
            held -= len(all_docs)
            all_uses.update(found)
            all_docs.update(found.keys())
            held += len(all_docs) + 1
            if held > HELD:
                yield from flush()
                uses.clear(), docs.clear()
                held = 0
        pa.default_memory_pool().release_unused()
    yield from flush()


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def term_counts_by_source(docs: DataFrame) -> DataFrame:
    """(lang, source, term, uses, docs): occurrences of a term and documents that hold it."""
    some = docs.select(_filled("lang"), _filled("source"), _filled("text")).mapInArrow(_counted, "lang string, source string, term string, uses long, docs long")
    return some.groupBy("lang", "source", "term").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(count + 5) * F.lit(1_000_000_000).cast("decimal(10,0)"), wide(total + 5 * terms))


def source_divergence(docs: DataFrame, least_docs: int = 30, most_terms: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): for every pair of sources of a language, and for a source's own terms.

    Terms are runs of ASCII letters, A-Z lower-cased, and of characters beyond ASCII. A language keeps the terms that at
    least `least_docs` of its documents hold; p of a kept term is 1 + floor(10^9 * (count + 5) / (N + 5 * V)), with N the sum
    of the counts of the V kept terms in the group or language. Part `pair` has, for each other source of the language, the
    sum of |p - q| over kept terms (0 without any), all of them ranked. Part `term` has the first most_terms of the kept terms
    that the source uses and more than its language does, by p - q. Ranks go by descending value, then ascending item.

    Null texts, languages and sources count as ''. A group of null or empty texts occurs like any other, with counts of 0.
    Rows that repeat count each. A language with one source has no pairs. Other columns are ignored; an empty table gives an
    empty result.
    """
    with frugal(docs.sparkSession):
        return _audited(docs, least_docs, most_terms)


def _audited(docs: DataFrame, least_docs: int, most_terms: int) -> DataFrame:
    # one wide row for each kept term: its counts by source
    counts = term_counts_by_source(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("uses").alias("all"), F.collect_list(F.struct("source", "uses")).alias("by_source"))
    kept = materialize(counts.where(F.col("docs") >= least_docs).select("lang", "term", "all", "by_source"), "divergence_kept")
    used = kept.select("lang", "term", "all", F.explode("by_source").alias("u")).select("lang", "term", "all", "u.source", "u.uses")

    # a number for each source within its language
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = docs.select(_filled("lang"), _filled("source")).distinct().withColumn("at", place.cast("int"))
    totals = used.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("all").alias("lang_total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    total, terms = F.coalesce("total", F.lit(0)), F.coalesce("V", F.lit(0))
    groups = groups.withColumn("total", total).withColumn("V", terms).withColumn("none", F.when(F.col("V") > 0, _share(F.lit(0).cast("long"), total, terms)))
    groups = materialize(groups, "divergence_groups")

    # the same rows with shares in place of counts: (place, p) of the sources that use a term, and the p of its language
    share = _share(F.col("uses"), F.col("total"), F.col("V"))
    shares = used.join(groups.select("lang", "source", "at", "total", "V", "lang_total"), ["lang", "source"]).withColumn("p", share).withColumn("q", _share(F.col("all"), F.col("lang_total"), F.col("V")))
    shares = materialize(shares.select("lang", "source", "at", "term", "p", "q"), "divergence_shares")
    wide = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("at", "p"))).alias("used"))
    languages = groups.where("V > 0").groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "none"))), lambda g: g["none"]).alias("none"))

    # contributions of pairs (a, b) with a < b, as differences from what two unused terms contribute; one source at a time
    def of_source(u: Column, used: Column, none: Column) -> Column:
        own = F.get(none, u["at"])
        pair = lambda j, p: F.struct(F.least(u["at"], j).alias("a"), F.greatest(u["at"], j).alias("b"), (F.abs(u["p"] - p) - F.abs(own - F.get(none, j))).alias("f"))
        both = F.transform(F.filter(used, lambda v: v["at"] > u["at"]), lambda v: pair(v["at"], v["p"]))
        unused = F.array_except(F.sequence(F.lit(0), F.size(none) - 1), F.transform(used, lambda v: v["at"]))
        return F.concat(both, F.transform(unused, lambda j: pair(j, F.get(none, j))))

    each = wide.join(languages, "lang").select("lang", "used", "none", F.explode("used").alias("u"))
    emitted = each.select("lang", F.explode(of_source(F.col("u"), F.col("used"), F.col("none"))).alias("c"))
    sums = emitted.groupBy("lang", F.col("c.a").alias("a"), F.col("c.b").alias("b")).agg(F.sum("c.f").alias("f"))
    sums = materialize(sums, "divergence_sums")
    sums = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "f"))

    side = groups.select("lang", "source", F.col("at").alias("a"), "V", "none")
    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("none").alias("o_none"))
    base = F.col("V") * F.coalesce(F.abs(F.col("none") - F.col("o_none")), F.lit(0))
    pairs = side.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (base + F.coalesce("f", F.lit(0))).cast("long").alias("value"))
    own = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.withColumn("rank", place).unionByName(own.withColumn("rank", place).where(F.col("rank") <= most_terms))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
