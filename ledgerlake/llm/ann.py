"""Approximate nearest neighbours with randomly rotated one-bit codes.

Each vector is coded relative to the centroid of its cluster: the direction of the difference is rotated at random into
BITS or more dimensions, and of each coordinate one bit (its sign) is kept, packed, with two scalars, the length of the
difference and the inner product of the direction with its own code. A query is rotated likewise and cut into PLANES
bit planes, so its inner product with a code is a sum of counts of common bits. That gives an unbiased estimate of the
distance, with an error bound. The index holds codes and scalars only.

A query visits the clusters nearest to it, and keeps the vectors whose lower bound does not exceed the k-th distance known
so far (within a bounded sample, and by the upper bounds within the cluster). The vectors of its first candidates by
estimate are fetched, which gives a k-th distance close to the true one, then those of all candidates whose lower
bound does not exceed that. Distances of the result are exact.

There are as many clusters as the root of the number of rows, up to a bound; they, and the number of clusters that a query
must visit, are fitted on a bounded sample. Every vector is indexed. Clusters and their queries are split into blocks of a
fixed size, so a large cluster is many small groups. Of equal vectors the k + 1 with the smallest ids are indexed: any
other has k nearer ones, or equally near ones with smaller ids, for every query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.storage import materialize

#: Standard errors in the bound, least length of a code, bit planes of a query.
EPSILON, BITS, PLANES = 2.0, 256, 6


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    """A random matrix with orthonormal rows, from dims to a multiple of 64 dimensions, at least BITS."""
    bits = max(BITS, -(-dims // 64) * 64)
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, dims)))[0].T.copy()


def cluster_means(x: np.ndarray, clusters: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from distinct sampled rows."""
    x = np.unique(x, axis=0)
    means = x[np.random.default_rng(seed).permutation(len(x))[:clusters]]
    for _ in range(rounds):
        near = nearest_means(x, means, 1)[:, 0]
        count = np.bincount(near, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, near, x)
        means = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], means)
    return means


def nearest_means(x: np.ndarray, means: np.ndarray, n: int) -> np.ndarray:
    """The n nearest means of each row, nearest first."""
    d = (means**2).sum(1)[None, :] - 2 * x @ means.T
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def visits_needed(x: np.ndarray, means: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """How many clusters a query must visit so that its k neighbours within x are there, for a share `recall` of them."""
    some = x[:queries]
    d = ((some**2).sum(1)[:, None] - 2 * some @ x.T) + (x**2).sum(1)[None, :]
    d[np.arange(len(some)), np.arange(len(some))] = np.inf
    true = np.argsort(d, axis=1)[:, :k]
    place = np.argsort(nearest_means(some, means, len(means)), axis=1)
    own = nearest_means(x, means, 1)[:, 0]
    ranks = np.sort(np.take_along_axis(place, own[true], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1 if len(ranks) else len(means)


def encode(x: np.ndarray, means: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, packed signs, length and correction of each row."""
    own = nearest_means(x, means, 1)[:, 0]
    r = x - means[own]
    length = np.linalg.norm(r, axis=1)
    o = (r / np.where(length > 0, length, 1)[:, None]) @ turn
    return own, np.packbits(o > 0, axis=1), length, np.abs(o).sum(1) / np.sqrt(turn.shape[1])


def inner_products(codes: np.ndarray, ones: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, float]:
    """The inner products of packed codes (as 64-bit words, with their numbers of ones) with a turned query, and a bound
    of what cutting the query into PLANES bits adds to their error."""
    low = turned.min()
    step = max((turned.max() - low) / (2**PLANES - 1), 1e-300)
    level = np.rint((turned - low) / step).astype(np.uint8)
    total = np.zeros(len(codes), np.int64)
    for plane in range(PLANES):
        word = np.packbits(level >> plane & 1).view(np.uint64)
        total += np.bitwise_count(codes & word).sum(1, dtype=np.int64) << plane
    size = len(turned)
    return (2 * (low * ones + step * total) - (low * size + step * level.sum(dtype=np.int64))) / np.sqrt(size), step / 2


def bounds(codes: np.ndarray, ones: np.ndarray, length: np.ndarray, correction: np.ndarray, diff: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate, lower and upper bound of the squared distance of coded vectors to a query at `diff` from their mean."""
    away = np.linalg.norm(diff)
    inner, cut = inner_products(codes, ones, (diff / (away if away > 0 else 1)) @ turn)
    fix = np.where(correction > 0, correction, 1.0)
    error = np.where(correction > 0, (EPSILON * np.sqrt(np.maximum(0, 1 - fix**2)) / np.sqrt(turn.shape[1] - 1) + cut) / fix, 0.0)
    inner, base, twice = inner / fix, length**2 + away**2, 2 * length * away
    return base - twice * inner, base - twice * np.minimum(1, inner + error), base - twice * np.maximum(-1, inner - error)


def _index(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, turn = shared.value[:2]
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, means.shape[1])
            own, codes, length, correction = encode(x, means, turn)
            yield pa.record_batch([batch.column(0), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(correction)], ["vec_id", "cluster", "code", "length", "correction"])

    return run


def _visits(shared, k: int):
    """Each query with its clusters and the squared k-th distance within the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, _, visits, sample, ids = shared.value
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, means.shape[1])
            near = nearest_means(x, means, visits)
            limit = []
            for own, row in zip(batch.column(0).to_pylist(), x):
                d = np.where(ids == own, np.inf, ((sample - row) ** 2).sum(1))
                limit.append(np.partition(d, k - 1)[k - 1] if len(d) >= k else np.inf)
            at = np.repeat(np.arange(len(x)), near.shape[1])
            yield pa.record_batch([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(np.repeat(limit, near.shape[1])), pa.array(near.ravel(), pa.int32())], ["query_id", "query", "limit", "cluster"])

    return run


def _search(shared, k: int):
    """(query_id, vec_id, estimate, low) of the vectors of a block that may be among a query's k nearest."""
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        means, turn = shared.value[:2]
        parts = []
        if len(queries) and len(vectors):
            codes = np.frombuffer(b"".join(vectors["code"]), np.uint64).reshape(len(vectors), -1)
            ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
            ids, mean = vectors["vec_id"].to_numpy(), means[int(vectors["cluster"].iloc[0])]
            length, correction = vectors["length"].to_numpy(), vectors["correction"].to_numpy()
            for own, query, limit in zip(queries["query_id"], queries["query"], queries["limit"]):
                estimate, low, high = bounds(codes, ones, length, correction, np.asarray(query, np.float64) - mean, turn)
                others = np.flatnonzero(ids != own)
                if len(others) > k:
                    limit = min(limit, np.partition(high[others], k - 1)[k - 1])
                else:
                    limit = np.inf if not np.isfinite(limit) else limit
                may = others[low[others] <= limit * (1 + 1e-9) + 1e-300]
                parts.append(pd.DataFrame({"query_id": own, "vec_id": ids[may], "estimate": estimate[may], "low": low[may]}))
        out = pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "estimate": [], "low": []})
        return out.astype({"query_id": "int64", "vec_id": "int64", "estimate": "float64", "low": "float64"})

    return run


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, vec_id, score) of pairs with both vectors."""
    flat = lambda c, n: np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
    for batch in batches:
        if len(batch):
            a, b = flat(batch.column(2), len(batch)), flat(batch.column(3), len(batch))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.sqrt(((a - b) ** 2).sum(1)))], ["query_id", "vec_id", "score"])


def usable_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, vector) of rows with an id and a finite nonzero vector of the most common length (of several, the least)."""
    x = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    whole = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("vector", lambda c: c != 0)
    x = x.where(whole)
    size = x.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return x.where(F.size("vector") == (size["n"] if size else 0))


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10, clusters: int = 1024, sample_rows: int = 20_000, recall: float = 0.97, block: int = 4096, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, by Euclidean distance in doubles.

    Queries are the rows whose id is divisible by `every`; a row with the query's own id is no candidate of it.
    Equally near rows go by smaller id; a query has fewer rows if there are fewer candidates. Equal rows count once.
    Rows with a null id, and vectors that are null, zero, of another length or hold null or non-finite components take no
    part. The sample for centroids holds at most sample_rows rows, those first by a hash of the id. An empty table gives
    no rows. `recall` is the share of neighbours within the sample that lie in the clusters visited.
    """
    spark = vectors.sparkSession
    x = usable_vectors(vectors, id_column, vector_column)
    rows = x.count()
    drawn = x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    sample = np.array([r["vector"] for r in drawn], np.float64)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    means = cluster_means(sample, max(1, min(clusters, int(np.sqrt(rows)), len(sample) // 16)))
    ids = np.array([r["vec_id"] for r in drawn], np.int64)
    shared = spark.sparkContext.broadcast((means, rotation(sample.shape[1]), visits_needed(sample, means, k, recall), sample, ids))
    same = Window.partitionBy("vector").orderBy("vec_id")
    kept = x.distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    coded = materialize(kept.mapInArrow(_index(shared), "vec_id long, cluster int, code binary, length double, correction double"), "ann_index")
    own = x.where(F.col("vec_id") % every == 0).distinct()
    asked = materialize(own.mapInArrow(_visits(shared, k), "query_id long, query array<double>, limit double, cluster int"), "ann_queries")
    # one row for each cluster: in how many blocks its vectors and its queries go
    sizes = coded.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    plan = asked.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("askers")).join(sizes, "cluster")
    plan = materialize(plan, "ann_plan")
    deal = lambda df, key, split, copy: (
        df.join(F.broadcast(plan), "cluster").withColumn(split[0], F.pmod(F.xxhash64(key), F.col(split[1])).cast("int")).withColumn(copy[0], F.explode(F.sequence(F.lit(0), F.col(copy[1]) - 1))).drop("parts", "askers")
    )
    queries = deal(asked, "query_id", ("qpart", "askers"), ("vpart", "parts")).groupBy("cluster", "qpart", "vpart")
    targets = deal(coded, "vec_id", ("vpart", "parts"), ("qpart", "askers")).groupBy("cluster", "qpart", "vpart")
    may = materialize(queries.cogroup(targets).applyInPandas(_search(shared, k), "query_id long, vec_id long, estimate double, low double"), "ann_candidates")
    sought = own.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))

    def measured(pairs: DataFrame) -> DataFrame:
        both = pairs.select("query_id", "vec_id").distinct().join(x, "vec_id").join(sought, "query_id").select("query_id", "vec_id", "query", "vector")
        return both.mapInArrow(_distances, "query_id long, vec_id long, score double")

    order = lambda *c: Window.partitionBy("query_id").orderBy(*c)
    first = may.withColumn("_n", F.row_number().over(order("estimate", "vec_id"))).where(F.col("_n") <= 4 * k)
    kth = measured(first).withColumn("_n", F.row_number().over(order("score", "vec_id"))).where(F.col("_n") == k).select("query_id", F.pow("score", F.lit(2.0)).alias("kth"))
    rest = may.join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("low") <= F.col("kth") * (1 + 1e-9)))
    found = measured(rest.select("query_id", "vec_id").unionByName(first.select("query_id", "vec_id")))
    return found.distinct().withColumn("rank", F.row_number().over(order("score", "vec_id"))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
