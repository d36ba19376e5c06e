"""Ranked lexical search as a threshold-seeded join.

The index holds the terms of every whole text with their counts. For the terms of a set of items it stores the
largest impacts (a term's weight times its part in a document's score), some times k of them, with their documents. They
seed each item's threshold: the best documents by the sum of their stored impacts are scored exactly, and the k-th of these
scores is a lower bound of the k-th score of the answer.

An item's terms are ordered by their largest impact. Terms at the end whose largest impacts sum to less than a part of the
threshold cannot lift a document into the answer alone, so only the terms before them join with the index. An occurrence is left out
where even the largest impacts of all the item's other terms would not reach the threshold, and so is a document whose sum
over the joined terms and the largest impacts of the others stay below it. What is left is scored exactly over all terms.
Every bound is an upper bound and only sums strictly below the threshold go, so documents of equal scores are never lost.

All joins are by term, by document or by item; nothing is broadcast by hand, so Spark broadcasts only what its threshold
allows and splits the lists of frequent terms otherwise. Only two numbers, N and L, come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.terms import ALNUM, count_terms, strings
from ledgerlake.storage import frugal, materialize

#: Terms that one record batch of the index holds, about.
BATCH = 100_000
#: For an answer of k: k times so many stored impacts of a term, and k times so many seeds of an item. Both only sharpen the
#: threshold.
STORED, SEEDS = 10, 5
#: Terms are left to the exact scores while their largest impacts sum to less than this part of the threshold (its inverse):
#: the more is left out, the more documents stay candidates.
PRUNED = 4


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, n, terms, counts) of (row, id, text), in batches that end when they hold enough terms."""
    def packed(batch: pa.RecordBatch, at: int, end: int, n: list[int], terms: list[bytes], counts: list[int], ends: list[int]) -> pa.RecordBatch:
        offsets = pa.array([0, *ends], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, values) for values in (strings(terms), pa.array(counts, pa.int64()))]
        return pa.record_batch([batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at), pa.array(n, pa.int64()), *lists], ["row", "id", "n", "terms", "counts"])

    for batch in batches:
        at, held = 0, ([], [], [], [])
        for i, text in enumerate(batch.column(2)):
            n, terms, counts, ends = held
            found = count_terms(text, ALNUM)
            n.append(found.total()), terms.extend(found), counts.extend(found.values()), ends.append(len(terms))
            if len(terms) >= BATCH or i + 1 == len(batch):
                yield packed(batch, at, i + 1, *held)
                at, held = i + 1, ([], [], [], [])
        pa.default_memory_pool().release_unused()


def term_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A written table of each row's terms: row (a number of its own), id, n (terms with repeats), terms and counts (lists).

    Terms are runs of ASCII digits and letters, A-Z lower-cased, and of characters beyond ASCII. Null and empty texts have
    no terms; null and repeated ids are rows of their own. Other columns of docs are ignored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return materialize(rows.mapInArrow(_counted, "row long, id long, n long, terms array<string>, counts array<long>"), "search_index")


def _best(df: DataFrame, by: str, value: str, tie: list[str], k: int) -> DataFrame:
    """The k rows of each `by` with the largest value, with their place; ties by other columns, upward, nulls last."""
    place = Window.partitionBy(by).orderBy(F.col(value).desc(), *(F.col(c).asc_nulls_last() for c in tie))
    return df.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def ranked_search(index: DataFrame, items: DataFrame, k: int = 10, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents with a score above 0, all if they are fewer.

    index is of term_index(). With N documents that have a term, L terms in all, df documents with a term, tf its count in a
    document of n terms: weight w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 10 + (90 * n * N) div L, and the score is the
    sum of w * ((10^9 * tf) div (1000 * tf + 8 * m)) over the item's distinct terms, in 64-bit integers. Equal scores rank by
    ascending doc_id, null ids last; documents that repeat an id are ranked each.

    Items without terms, and items without documents that hold one of their terms, have no rows. An item without id cannot
    be named and has none. Rows of one item_id are one item, with the terms of all of them. An empty index or table of items
    gives an empty result.
    """
    with frugal(index.sparkSession):
        return _ranked(index, *_item_terms(items, id_column, text_column), k)


def _item_terms(items: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(item_id, item), a number for each item, and (item, term), distinct; both written."""
    text = F.translate(F.coalesce(F.col(text_column).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = items.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("item_id"), text.alias("text"))
    numbers = materialize(named.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "search_items")
    terms = named.join(numbers, "item_id").select("item", F.explode(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")).alias("term"))
    return numbers, materialize(terms.where("term <> ''").distinct(), "search_item_terms")


def _ranked(index: DataFrame, numbers: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    total = index.where("n > 0").agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    many, length = total["N"], max(1, total["L"])

    # the occurrences of wanted terms, with their part in a score
    each = index.select("row", "id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("row", "id", "n", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))
    m = F.lit(10).cast("long") + F.expr(f"(90L * n * {many}L) div {length}L")
    found = each.join(wanted.select("term").distinct(), "term", "left_semi").withColumn("m", m)
    postings = materialize(found.select("term", "row", "id", F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)").alias("part")), "search_postings")

    # each term's weight, largest impact and stored impacts
    counts = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("part").alias("most"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * many + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = counts.withColumn("w", weight).where("w > 0").select("term", "w", (F.col("w") * F.col("most")).alias("most"))
    stored = materialize(_best(postings.select("term", "row", "part"), "term", "part", ["row"], STORED * k).drop("rank"), "search_stored")
    terms = materialize(wanted.join(weights, "term"), "search_terms")

    # seeds: the best documents by stored impacts alone, scored exactly; the k-th score is the item's threshold
    sums = terms.join(stored, "term").groupBy("item", "row").agg(F.sum(F.col("w") * F.col("part")).alias("score"))
    least = _threshold(_scored(_best(sums, "item", "score", ["row"], SEEDS * k).select("item", "row"), terms, postings), k)

    # an item's terms by largest impact: those before the point from which the largest impacts sum to less than a part of it
    upward = Window.partitionBy("item").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    bounded = terms.join(least, "item").withColumn("suffix", F.sum("most").over(upward))
    joined = F.col("suffix") * PRUNED >= F.col("threshold")
    item = Window.partitionBy("item")
    bounded = bounded.withColumn("rest", F.coalesce(F.sum(F.when(~joined, F.col("most"))).over(item), F.lit(0))).withColumn("others", F.sum("most").over(item) - F.col("most"))
    essential = materialize(bounded.where(joined).select("item", "term", "w", "threshold", "rest", "others"), "search_essential")

    # candidates by the essential terms alone
    met = essential.join(postings.select("term", "row", "part"), "term").withColumn("impact", F.col("w") * F.col("part"))
    known = met.where(F.col("impact") + F.col("others") >= F.col("threshold")).groupBy("item", "row").agg(F.sum("impact").alias("known"))
    bounds = essential.select("item", "threshold", "rest").distinct()
    candidates = materialize(known.join(bounds, "item").where(F.col("known") + F.col("rest") >= F.col("threshold")).select("item", "row"), "search_candidates")

    # and exact scores over all terms
    final = _best(_scored(candidates, terms, postings).where("score > 0"), "item", "score", ["id", "row"], k)
    return final.join(numbers, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def _threshold(scores: DataFrame, k: int) -> DataFrame:
    """(item, threshold): the k-th score of each item, 1 if it has fewer."""
    best = _best(scores, "item", "score", ["row"], k)
    return materialize(best.groupBy("item").agg(F.when(F.count("*") >= k, F.greatest(F.min("score"), F.lit(1))).otherwise(F.lit(1)).alias("threshold")), "search_thresholds")


def _scored(pairs: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """Exact scores of pairs of an item and a row, over all of the item's terms."""
    each = pairs.join(terms.select("item", "term", "w"), "item").join(postings, ["term", "row"])
    return each.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum(F.col("w") * F.col("part")).alias("score"))
