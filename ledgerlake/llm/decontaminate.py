"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: runs of 10 words, or a whole item of fewer. The patterns of one length
form one search: a table gives for each block of two words how far the window may move on when it ends with this block,
blocks without an entry let it move by almost its whole length, and where the shift is zero the pair of last words picks
the bucket of patterns that are compared word by word. Patterns are broadcast in blocks of a fixed number, so a larger
benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.words import NOT_ALNUM
from ledgerlake.storage import materialize

_BLANK = bytes(0x20 if NOT_ALNUM[i] else i for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: runs of digits, letters a-z and all non-ASCII characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANK).split()


class WuManber:
    """Search for word sequences of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], frozenset[int]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], frozenset[int]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.bucket.setdefault(pattern[length - self.block :], []).append((pattern, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, frozenset[int]]]:
        """Start and items of each occurrence, from left to right."""
        length, default, shift = self.length, self.default, self.shift
        if self.block == 1:
            for at, word in enumerate(words):
                for _, items in self.bucket.get((word,), ()):
                    yield at, items
            return
        end, n = length, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1])
            by = shift.get(key, default)
            if by:
                end += by
                continue
            window = tuple(words[end - length : end])
            for pattern, items in self.bucket[key]:
                if pattern == window:
                    yield end - length, items
            end += 1


def build_searches(items: list[tuple[int | None, tuple[bytes, ...]]]) -> list[WuManber]:
    """items: (item, window of words). Windows of a null item are found but name no item."""
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
    for item, window in items:
        found = by_length.setdefault(len(window), {}).setdefault(window, set())
        if item is not None:
            found.add(item)
    return [WuManber(n, {p: frozenset(s) for p, s in patterns.items()}) for n, patterns in sorted(by_length.items())]


def occurrences(words: list[bytes], searches: list[WuManber]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged spans [start, end) of words inside any occurrence, and the items that occur."""
    found, items = [], set()
    for search in searches:
        for at, its in search.search(words):
            found.append((at, at + search.length))
            items |= its
    spans: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    return spans, items


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for k in range(max(1, len(words) - size + 1) if words else 0):
                    ids.append(item), out.append(b" ".join(words[k : k + size]))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["item_id", "window"])

    return run


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = build_searches([(item, tuple(window.split(b" "))) for item, window in shared.value])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            n, spans, items = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                at, its = occurrences(words, searches)
                n.append(len(words)), spans.append([{"start": a, "end": b} for a, b in at]), items.append(sorted(its))
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.int64()))], ["row", "n_words", "spans", "items"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for batch in batches:
        out = []
        for row, n, spans, items in zip(*(c.to_pylist() for c in batch.columns)):
            end, hit = 0, 0
            for s in sorted((s["start"], s["end"]) for part in spans for s in part):
                hit += max(0, s[1] - max(s[0], end))
                end = max(end, s[1])
            its = sorted({str(i) for part in items for i in part})
            out.append((row, n, hit, len(its), hashlib.sha256(",".join(its).encode()).hexdigest(), hit > 0))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        yield pa.record_batch([pa.array(list(x), t) for x, t in zip(zip(*out) if out else [[]] * 6, types)], names)


def benchmark_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Distinct (item_id, window): each run of `size` words of an item joined by blanks, or all of its fewer words."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(_windows(size), "item_id long, window binary").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = 200_000, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each document: doc_id, n_words, n_hit (words inside an occurrence of a window), n_items (items whose windows
    occur), items_sha256 (of their ids, sorted as strings and joined by commas) and contaminated (n_hit > 0).

    At most `block` windows are broadcast at once; further ones take further passes, and the spans of all passes are
    merged by document. Null and empty texts have no words. Items with null text have no windows; windows of an item
    without id count as hits and name no item. Rows that repeat an id are rows of their own, with repeated results.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "row long, n_words long, spans array<struct<start: long, end: long>>, items array<long>"
    windows = benchmark_windows(benchmark, size)
    total = windows.count() if block else 0
    if total <= block:
        parts = [(windows, base.select(F.col("doc_id").alias("row"), "text"))]
    else:  # a key for each row, so that the passes can be put together
        keyed = materialize(base.withColumn("row", F.monotonically_increasing_id()), "decontamination_rows")
        passes = -(-total // block)
        cut = materialize(windows.withColumn("pass", F.pmod(F.xxhash64("window"), F.lit(passes))), "decontamination_windows")
        parts = [(cut.where(F.col("pass") == k), keyed.select("row", "text")) for k in range(passes)]
    found = []
    for some, rows in parts:
        shared = spark.sparkContext.broadcast([(r["item_id"], bytes(r["window"])) for r in some.select("item_id", "window").toLocalIterator()])
        found.append(rows.mapInArrow(_scan(shared), schema))
    if len(found) == 1:
        merged = found[0].select("row", "n_words", F.array("spans").alias("spans"), F.array("items").alias("items"))
    else:
        union = found[0]
        for more in found[1:]:
            union = union.union(more)
        merged = union.groupBy("row").agg(F.max("n_words").alias("n_words"), F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    out = merged.mapInArrow(_merge, "row long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    if len(found) == 1:
        return out.withColumnRenamed("row", "doc_id")
    return keyed.select("row", "doc_id").join(out, "row").drop("row")


def _keep(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = build_searches([(item, tuple(window.split(b" "))) for item, window in shared.value])
        for batch in batches:
            clean = []
            for text in batch.column(at):
                words = words_of(text.as_py())
                clean.append(all(next(search.search(words), None) is None for search in searches))
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of the benchmark occurs. One pass for each `block` windows."""
    windows = materialize(benchmark_windows(benchmark, size), "decontamination_windows")
    passes = max(1, -(-windows.count() // block))
    for k in range(passes):
        some = windows.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == k).select("item_id", "window")
        shared = docs.sparkSession.sparkContext.broadcast([(r["item_id"], bytes(r["window"])) for r in some.toLocalIterator()])
        docs = docs.mapInArrow(_keep(shared, docs.columns.index("text")), docs.schema)
    return docs
