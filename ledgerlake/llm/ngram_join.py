"""N-gram Jaccard join by multiple-global-order filtering.

Under any total order of tokens, two sets whose Jaccard similarity reaches the threshold t share a token among the first
n - ceil(t * n) + 1 tokens of each (the prefix). So candidates must share a prefix token under every order used here:

* order 1 sorts by document frequency, rare first, and builds the inverted index. Frequencies are counted over all
  documents for a fixed part of the token space (the tokens whose hash is low, a fifth at 90 %); those tokens come first,
  the rest after them. A set with fewer tokens in that part than its prefix is long also counts and indexes its other tokens.
* orders 2 and 3 sort by two further hashes. Their prefixes are kept beside each set, and a candidate pair of order 1
  must intersect in both before its sets are compared.

Equal sets are one class from the start. A posting list is not expanded into all its pairs: each list first compares its
members with one leader (the member with most shared tokens), and the verified links give components. Only sets of lists
that still hold more than one component go on; for them order 1 counts all tokens, so that prefixes and positions are
exact and what many sets share comes last. Their lists are again compared with leaders, and then pairs between different
components of a list. So a list of g near copies costs g comparisons, and no link between components is lost: a linked pair
shares a prefix token in each pass, so it is compared or already in one component. Every comparison is of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.words import SPACES, mix, sequence_hashes, slices, word_hashes
from ledgerlake.operators.components import connected_components
from ledgerlake.storage import discard, frugal, materialize

#: Seeds of orders 2 and 3.
SEEDS = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
#: At most this many tokens count as hot; their rows are dealt to one task for every SHARE of them, at most SALTS.
HOT, SHARE, SALTS = 10_000, 2_000, 32
POSTING = "token long, cls long, zone byte"
#: Bytes kept of a token in the prefixes of orders 2 and 3.
NARROW = 3


def tokens_of(text: str | None, size: int) -> np.ndarray:
    """The set of a text: sorted distinct hashes of its runs of `size` words."""
    return np.unique(sequence_hashes(word_hashes(text, SPACES)[0], size))


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit hash of a whole set; equal for equal sets."""
    return int(mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def counted_below(percent: int) -> np.uint64:
    """The bound of the counted part of the token space: twice the share of a set that its prefix takes, so that the counted
    tokens of nearly all sets cover their prefixes."""
    return np.uint64(min(2**64 - 1, 2**64 * 2 * (100 - percent) // 100))


def split_tokens(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The indexed tokens of a set: those in the counted part, and the others if the first are fewer than the prefix."""
    low = tokens < counted_below(percent)
    counted, rest = tokens[low], tokens[~low]
    return counted, rest if len(counted) < prefix_length(len(tokens), percent) else rest[:0]


def _high_bytes(x: np.ndarray, n: int) -> bytes:
    return x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def _set(data) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _prefixes(tokens: np.ndarray, percent: int) -> list[bytes]:
    p = prefix_length(len(tokens), percent)
    return [_high_bytes(np.sort(mix(tokens ^ seed))[:p] << np.uint64(3), NARROW) for seed in SEEDS]


def _classes(size: int, percent: int):
    """Class and sizes of each text, and its packed indexed tokens unless this task has written them before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            n, counted, rest, keys, low_out, high_out = [], [], [], [], [], []
            for text in batch.column(1):
                tokens = tokens_of(text.as_py(), size)
                low, high = split_tokens(tokens, percent)
                key = class_of(tokens) if len(tokens) else None
                fresh = len(tokens) > 0 and key not in seen
                n.append(len(tokens)), counted.append(len(low)), rest.append(len(high)), keys.append(key)
                low_out.append(low.astype("<u8").tobytes() if fresh else None), high_out.append(high.astype("<u8").tobytes() if fresh else None)
                if len(seen) < 200_000:  # only spares work: a set that comes twice changes nothing but counts
                    seen.add(key)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(counted, pa.int32()), pa.array(rest, pa.int32()), pa.array(keys, pa.int64()), batch.column(2), pa.array(low_out, pa.binary()), pa.array(high_out, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n_shingles", "counted", "rest", "cls", "row_key", "low", "high"])

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, cls, zone): the indexed tokens of classes."""
    for batch in slices(batches):
        tokens_out, class_out, zones = [], [], []
        for key, *parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            for zone, part in enumerate(_set(data.as_buffer()) for data in parts):
                tokens_out.append(part), class_out.append(np.full(len(part), key, np.int64)), zones.append(np.full(len(part), zone, np.int8))
        if tokens_out:
            yield pa.record_batch([pa.array(np.concatenate(tokens_out).view(np.int64)), pa.array(np.concatenate(class_out)), pa.array(np.concatenate(zones))], ["token", "cls", "zone"])


def _packed(size: int, percent: int):
    """The whole sets of wanted classes from their texts, with the prefixes under orders 2 and 3."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, n, second, third, sets = [], [], [], [], []
            for wanted, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = tokens_of(text.as_py(), size)
                if len(tokens) and class_of(tokens) == wanted:  # two rows of one key may hold different texts
                    a, b = _prefixes(tokens, percent)
                    keys.append(wanted), n.append(len(tokens)), second.append(a), third.append(b), sets.append(tokens.astype("<u8").tobytes())
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (second, third, sets))], ["cls", "n", "second", "third", "tokens"])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, cls, zone): every token of packed sets."""
    for batch in slices(batches):
        sets = [_set(x.as_buffer()) for x in batch.column(1)]
        if sets:
            size = np.array([len(x) for x in sets])
            tokens = np.concatenate(sets).view(np.int64)
            yield pa.record_batch([pa.array(tokens), pa.array(np.repeat(np.array(batch.column(0).to_pylist(), np.int64), size)), pa.array(np.zeros(len(tokens), np.int8))], ["token", "cls", "zone"])


def _share_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs whose prefixes under orders 2 and 3 both intersect."""
    def meet(x: bytes, y: bytes) -> bool:
        cut = lambda d: {d[i : i + NARROW] for i in range(0, len(d), NARROW)}
        return not cut(x).isdisjoint(cut(y))

    for batch in slices(batches):
        cols = [batch.column(i).to_pylist() for i in range(2, 6)]
        keep = pa.array([meet(a2, b2) and meet(a3, b3) for a2, a3, b2, b3 in zip(*cols)], pa.bool_())
        yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _set(x.as_buffer()), _set(y.as_buffer())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _hot_tokens(counts: DataFrame) -> DataFrame:
    """(token, salts): tokens with more than SHARE postings and more than a 10,000th of all that are counted.

    They are at most 10,000, however many postings there are, so the table is safe to broadcast. counts has token and df."""
    total = counts.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    salts = F.least(F.lit(SALTS), F.ceil(F.col("df") / SHARE)).cast("int").alias("salts")
    return materialize(counts.where((F.col("df") > SHARE) & (F.col("df") * HOT > total)).select("token", salts).coalesce(1), "shingle_hot")


def _dealt(df: DataFrame, hot: DataFrame, by: F.Column | None) -> DataFrame:
    """df with a salt: the rows of a hot token go to its parts by a column, or to all of them (by is None)."""
    marked = df.join(F.broadcast(hot), "token", "left")
    if by is None:
        return marked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return marked.withColumn("salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("salts")).cast("int"), F.lit(0))).drop("salts")


def _by_token(many: DataFrame, one: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """many joined by token with a table of one row for each token; rows of a hot token are dealt to several tasks.

    The join is the same with and without hot tokens, so the plans of small and large tables can be compared."""
    return _dealt(many, hot, F.col("cls")).join(_dealt(one, hot, None), ["token", "salt"], how).drop("salt")


def _prefix_index(postings: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(token, cls, n, pos, shared): the tokens of each prefix under order 1 that two postings have; pos from 1. And the
    hot tokens among them."""
    counts = materialize(postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "shingle_counts")
    hot = _hot_tokens(counts)
    shared = _by_token(postings, counts, hot).groupBy("cls").agg(F.sort_array(F.collect_set(F.struct("zone", "df", "token"))).alias("tokens"))
    first = F.size(F.filter("tokens", lambda x: x["zone"] == 0))
    # tokens that only one posting has come before the others of their part of the order
    pos = F.col("i") + 1 + F.col("counted") - F.col("first") + F.when(F.col("t.zone") == 1, F.col("rest") - (F.col("all") - F.col("first"))).otherwise(0)
    index = (
        shared.join(classes, "cls").withColumn("first", first).withColumn("all", F.size("tokens"))
        .select("cls", "n", "counted", "rest", "first", "all", F.posexplode("tokens").alias("i", "t"))
        .select(F.col("t.token").alias("token"), "cls", "n", pos.alias("pos"), (F.col("all") / (F.col("counted") + F.col("rest"))).alias("shared"))
        .where(F.col("pos") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1)
    )
    index = materialize(index, "shingle_index")
    discard(counts)
    return index, hot


def _may_link(percent: int) -> F.Column:
    """Length and position filters for an index row and another (o_): the first common token leaves enough room behind it."""
    n, pos, m, at = (F.col(c) for c in ("n", "pos", "o_n", "o_pos"))
    room = 1 + F.least(n - pos, m - at)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * room >= percent * (n + m))


def _other(df: DataFrame, *more: str) -> DataFrame:
    return df.select("token", *more, *(F.col(c).alias(f"o_{c}") for c in ("cls", "n", "pos", "component")))


def _ordered_pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("cls", "o_cls").alias("a"), F.greatest("cls", "o_cls").alias("b")).distinct()


def _placed(index: DataFrame, labels: DataFrame) -> DataFrame:
    """The index with the component of each class; a class without links is its own."""
    named = labels.select(F.col("node").alias("cls"), F.col("component").alias("_c"))
    return index.drop("component").join(named, "cls", "left").withColumn("component", F.coalesce("_c", "cls")).drop("_c")


def _open_lists(index: DataFrame, hot: DataFrame) -> DataFrame:
    """The posting lists that hold more than one component."""
    mixed = index.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    return _by_token(index, mixed, hot, "left_semi")


def _star_pairs(index: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Pairs of each posting list's leader, its member with most shared tokens, and the members of other components."""
    lists = index.groupBy("token").agg(F.max_by(F.struct("cls", "n", "pos", "component"), F.struct("shared", "cls")).alias("l"), F.min("component").alias("low"), F.max("component").alias("high"))
    met = _by_token(index, _other(lists.where("low < high").select("token", "l.*")), hot)
    return _ordered_pairs(met.where((F.col("component") != F.col("o_component")) & _may_link(percent)))


def _list_pairs(index: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Pairs within each posting list of members in different components.

    The join is by token and a class of length: lengths that differ by no more than the threshold allows lie in the same
    or in neighbouring classes. The side that has a row for each of these is dealt, the other goes to all parts of a hot list."""
    step = float(np.log(100 / percent)) if percent < 100 else 1e-9
    rows = index.withColumn("length", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("long"))
    near = rows.withColumn("length", F.explode(F.array(*(F.col("length") + k for k in (-1, 0, 1)))))
    x, y = _dealt(rows, hot, None), _other(_dealt(near, hot, F.col("cls")), "length", "salt")
    return _ordered_pairs(x.join(y, ["token", "salt", "length"]).where((F.col("component") < F.col("o_component")) & _may_link(percent)))


def _verified(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    side = lambda name, *cols: packed.select(F.col("cls").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in cols))
    met = (
        pairs.join(side("a", "second", "third"), "a").join(side("b", "second", "third"), "b")
        .select("a", "b", "a_second", "a_third", "b_second", "b_third").mapInArrow(_share_prefixes, "a long, b long")
    )
    return met.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").select("a", "b", "a_tokens", "b_tokens").mapInArrow(_compare(percent), "a long, b long")


def _row_key(doc_id: F.Column, text: F.Column) -> F.Column:
    """A 64-bit hash of a row's id and text, by which rows without id are found again."""
    return F.xxhash64(doc_id.cast("long"), text.cast("string"))


def ngram_jaccard_join(docs: DataFrame, size: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Links texts whose sets of `size`-word shingles have a Jaccard similarity of at least percent / 100.

    Returns (documents, links). documents has for each input row doc_id, n_shingles, cls (a hash of its set, null if
    empty) and component_id (smallest doc_id reachable by links, itself included). links has the verified pairs (a, b)
    of classes that join the components; pairs inside a component that its other links already join are not listed.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer words than `size` has its whole
    sequence as one shingle. Null and empty texts have an empty set and are linked with nothing; a row whose doc_id is
    null is linked like any other but names no component: component_id is null if no linked row has an id. Rows that
    repeat an id are rows of their own. Equal rows are one class. Other columns are ignored. An empty table gives none.
    Shingles and sets are compared by 64-bit hashes.
    """
    documents, links = _linked(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")), size, percent)
    return documents.select("doc_id", "n_shingles", "component_id", "cls"), links


def _linked(base: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """ngram_jaccard_join() of (doc_id, text); its documents have each row's row_key and component, a class, too."""
    with frugal(base.sparkSession):
        return _found(base, size, percent)


def _found(base: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    base = base.withColumn("row_key", _row_key(F.col("doc_id"), F.col("text")))
    rows = materialize(base.mapInArrow(_classes(size, percent), "doc_id long, n_shingles long, counted int, rest int, cls long, row_key long, low binary, high binary"), "shingle_classes")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.first("n_shingles").alias("n"), F.first("counted").alias("counted"), F.first("rest").alias("rest"), F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"))
    postings = rows.where("low IS NOT NULL").select("cls", "low", "high").mapInArrow(_postings, POSTING)
    index, hot = _prefix_index(postings, classes.drop("doc_id", "row_key"), percent)

    # first pass: each posting list against its leader
    index = index.withColumn("component", F.col("cls"))
    near = materialize(_star_pairs(index, hot, percent), "shingle_stars")
    wanted = _open_lists(index, hot).select("cls").distinct().join(classes.select("cls", "row_key"), "cls")
    texts = base.select("row_key", "text").join(wanted, "row_key").dropDuplicates(["row_key"])
    packed = materialize(texts.select("cls", "text").mapInArrow(_packed(size, percent), "cls long, n long, second binary, third binary, tokens binary"), "shingle_packed")
    links = materialize(_verified(near, packed, percent), "shingle_links")

    # second pass: sets of lists that still meet other components, by frequencies of all their tokens
    labels = connected_components(links)
    left = materialize(_open_lists(_placed(index, labels), hot).select("cls").distinct(), "shingle_open")
    again = packed.join(left, "cls").select("cls", "n", "tokens")
    fine, hot = _prefix_index(again.select("cls", "tokens").mapInArrow(_unpacked, POSTING), again.select("cls", "n", F.col("n").alias("counted"), F.lit(0).alias("rest")), percent)
    links2 = materialize(_verified(_star_pairs(_placed(fine, labels), hot, percent), packed, percent), "shingle_links")
    links = links.unionByName(links2)

    # third pass: all pairs of a list that are in different components by now
    labels = connected_components(links)
    links3 = materialize(_verified(_list_pairs(_open_lists(_placed(fine, labels), hot), hot, percent), packed, percent), "shingle_links")
    links = links.unionByName(links3)
    final = (labels if links3.isEmpty() else connected_components(links)).withColumnRenamed("node", "cls")
    for used in (index, fine, packed):
        discard(used)

    members = classes.select("cls", "doc_id").join(final, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = members.join(smallest, "component").select("cls", "component", "component_id")
    out = rows.select("doc_id", "n_shingles", "cls", "row_key").join(named, "cls", "left")
    return out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))), links


def keep_one_of_each(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """docs with one row of each group of linked texts: that of the smallest doc_id, ids before null ids, and of several
    rows with that id one. Empty texts are no group: they all stay, but of equal rows one. All columns are kept; of rows
    with the same id and text any one stays, with its other columns. An empty table stays empty.
    """
    named, _ = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), size, percent)
    group = F.when(F.col("cls").isNull(), F.struct(F.lit(0).alias("kind"), F.col("row_key").alias("key"))).otherwise(F.struct(F.lit(1).alias("kind"), F.col("component").alias("key")))
    first = F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    kept = named.groupBy(group.alias("group")).agg(first.alias("_key")).select("_key").distinct()
    # the columns of a row travel in one struct, so that their names cannot clash with the key's
    rows = docs.select(F.struct("*").alias("_row"), _row_key(docs["doc_id"], docs["text"]).alias("_key"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
