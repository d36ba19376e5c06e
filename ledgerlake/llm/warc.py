"""WARC records and a Merkle fixity audit of their replicas.

Pages become WARC response records; an index gives each record its file, its place in it and its range of bytes. For
a replica, every record's bytes are hashed, and the hashes with their ordered ranges are combined, FANOUT neighbours at a
time, up to one root. Two replicas with the same root are the same; otherwise only the children of nodes that differ are
compared, level by level, down to the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.storage import discard, materialize

FANOUT = 16
#: Files are numbered below this; number 0 is for pages without id.
FILES = 2**31


def warc_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, record, record_id): each page as the bytes of a WARC response record, and the hash of these as its id.

    Null urls and pages are empty."""
    url, html = F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.regexp_replace(url, r"[\r\n]", " "),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.encode(F.concat(head, html, F.lit("\r\n\r\n")), "UTF-8").alias("record"))
    return rows.withColumn("record_id", F.sha2("record", 256))


def warc_index(records: DataFrame, per_file: int = 1000) -> DataFrame:
    """(page_id, url, record_id, file, ordinal, start, end) of each record.

    A file holds the pages of `per_file` consecutive ids; pages without id share file 0. Records of a file go by id, url
    and hash and lie without gaps. Equal records (same id, url and page) are one. Only hashes and lengths are moved.
    """
    file = F.coalesce(F.pmod(F.floor(F.col("page_id") / per_file) + 1, F.lit(FILES)), F.lit(0)).cast("long")
    rows = records.select("record_id", "page_id", "url", F.octet_length("record").cast("long").alias("size"), file.alias("file"))
    rows = rows.groupBy("record_id").agg(*(F.first(c).alias(c) for c in ("page_id", "url", "size", "file")))
    order = Window.partitionBy("file").orderBy("page_id", "url", "record_id")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("page_id", "url", "record_id", "file", (F.row_number().over(order) - 1).cast("long").alias("ordinal"), (end - F.col("size")).alias("start"), end.alias("end"))


def merkle_tree(leaves: DataFrame, slots: int, files: int) -> list[DataFrame]:
    """Levels of a replica's tree, from the records up to one root, each (node, hash, start, end).

    leaves: file, ordinal, start, end, sha256. slots is a power of FANOUT, no smaller than any file's number of
    records; file numbers are below files. A node's hash covers the hashes and ranges of its children in order.
    """
    node = F.col("file") * slots + F.col("ordinal")
    level = materialize(leaves.select(node.alias("node"), F.col("sha256").alias("hash"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")), "merkle")
    levels, top = [level], files * slots
    while top > 1:
        child = F.struct("node", F.concat_ws(":", "start", "end", "hash").alias("h"))
        up = levels[-1].groupBy(F.floor(F.col("node") / FANOUT).cast("long").alias("node")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(child))["h"], ","), 256).alias("hash"), F.min("start").alias("start"), F.max("end").alias("end"))
        levels.append(materialize(up, "merkle"))
        top = -(-top // FANOUT)
    return levels


def differing_leaves(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """(node, a_hash, b_hash) of the leaves that differ between two trees, in hash or range; of each level only the children
    of nodes that differ are read."""
    found = None
    for x, y in zip(reversed(a), reversed(b)):
        if found is not None:
            parents = found.select(F.col("node").alias("parent"))
            x, y = (d.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long")).join(parents, "parent", "left_semi") for d in (x, y))
        side = lambda d, s: d.select("node", F.col("hash").alias(f"{s}_hash"), F.concat_ws(":", "start", "end", "hash").alias(f"{s}_all"))
        both = side(x, "a").join(side(y, "b"), "node", "full").where(~F.col("a_all").eqNullSafe(F.col("b_all")))
        found = materialize(both.drop("a_all", "b_all"), "merkle_diff")
        if found.isEmpty():
            break
    return found


def fixity_audit(index: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(page_id, file, ordinal, start, end, status) of every record on which two replicas differ.

    index is what warc_index() gives; a replica is (record_id, record) with the bytes it holds for an index entry, and
    start and end where it found them, if it has such columns (null or no columns: where the index has them).
    status is altered (both have the record, with different bytes), moved (the same bytes in another range), missing (only
    the first has it) or extra (only the second has it). A replica that repeats a record with the same bytes has it once; with
    different bytes it equals no single copy. A null record counts as missing, an empty one as present. Records that are
    not in the index take no part. Equal replicas and empty tables give no rows. Start and end are the index's.
    """
    entries = materialize(index.select("record_id", "page_id", "file", "ordinal", "start", "end"), "warc_index")
    most = entries.groupBy("file").count().agg(F.max("count").alias("n"), F.max("file").alias("file")).first()
    slots, files = FANOUT, (most["file"] or 0) + 1
    while slots < (most["n"] or 1):
        slots *= FANOUT

    def leaves(replica: DataFrame) -> DataFrame:
        own = [F.col(c).cast("long").alias(f"own_{c}") if c in replica.columns else F.lit(None).cast("long").alias(f"own_{c}") for c in ("start", "end")]
        hashed = replica.where(F.col("record").isNotNull()).select("record_id", F.sha2("record", 256).alias("sha256"), *own)
        low, high = F.min("sha256"), F.max("sha256")
        one = hashed.groupBy("record_id").agg(F.when(low == high, low).otherwise(F.sha2(F.concat(low, high), 256)).alias("sha256"), F.min("own_start").alias("own_start"), F.max("own_end").alias("own_end"))
        placed = one.join(entries.select("record_id", "file", "ordinal", "start", "end"), "record_id")
        return placed.withColumn("start", F.coalesce("own_start", "start")).withColumn("end", F.coalesce("own_end", "end"))

    a, b = merkle_tree(leaves(first), slots, files), merkle_tree(leaves(second), slots, files)
    found = differing_leaves(a, b)
    for level in (*a, *b):
        discard(level)
    status = F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "extra").when(F.col("a_hash") == F.col("b_hash"), "moved").otherwise("altered")
    at = found.select(F.floor(F.col("node") / slots).cast("long").alias("file"), (F.col("node") % slots).alias("ordinal"), status.alias("status"))
    return entries.join(at, ["file", "ordinal"]).select("page_id", "file", "ordinal", "start", "end", "status")
