"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network on top.

Every word belongs to two units: a hash bucket of the word itself and a class of its shape (case, digits, symbols,
length). Each unit has a sparse ternary index vector; the context vector of a unit is the sum of the index vectors of
the units next to its words, over all documents. A document's features are pools of the context vectors of its words. The network
is trained with numpy on a bounded sample of labelled rows, and its logits are divided by a temperature fitted on rows
that training left aside. The tables have fixed sizes (units x dimensions), whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.words import SPACES, give_back, mix, slices, word_hashes
from ledgerlake.storage import frugal

WORDS, SHAPES, DIMS, NONZERO = 8192, 256, 32, 2
UNITS = WORDS + SHAPES
_SEEDS = mix(np.arange(UNITS * NONZERO, dtype=np.uint64) + np.uint64(77)).reshape(UNITS, NONZERO)
#: Index vectors: positions and signs of their nonzero entries.
POSITION, SIGN = (_SEEDS % np.uint64(DIMS)).astype(np.int64), np.where(_SEEDS >> np.uint64(63), 1.0, -1.0)

_UPPER, _DIGIT, _SYMBOL = np.zeros((3, 256), np.int64)
_UPPER[0x41:0x5B] = _DIGIT[0x30:0x3A] = 1
_SYMBOL[[i for i in range(0x21, 0x7F) if not chr(i).isalnum()]] = 1
FEATURES = 4 * DIMS + 4


def units_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word unit and shape unit of each word of a text."""
    hashes, starts, ends = word_hashes(text, SPACES)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    runs = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[b])))[np.stack([starts, ends])], axis=0)[0]
    size, upper, symbols = ends - starts, runs(_UPPER), runs(_SYMBOL)
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(2 * upper >= size - symbols, 3, 2)))
    shape = ((case * 2 + (runs(_DIGIT) > 0)) * 4 + np.minimum(symbols, 3)) * 4 + np.digitize(size, [2, 5, 12])
    return (hashes % np.uint64(WORDS)).astype(np.int64), WORDS + shape


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(UNITS * DIMS)
    seen = np.zeros(UNITS)

    def add(docs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        own, near = [], []
        for word, shape in docs:
            for target in (word, shape):
                for context in (word, shape):
                    own += [target[1:], target[:-1]]
                    near += [context[:-1], context[1:]]
        own, near = np.concatenate(own), np.concatenate(near)
        seen[:] += np.bincount(own, minlength=UNITS)
        for k in range(NONZERO):
            total[:] += np.bincount(own * DIMS + POSITION[near, k], SIGN[near, k], UNITS * DIMS)

    for batch in batches:
        docs, size = [], 0
        for text in batch.column(0):
            docs.append(units_of(text.as_py()))
            size += len(docs[-1][0])
            if size > 50_000:
                add(docs)
                docs, size = [], 0
        if docs:
            add(docs)
        give_back()
    there = np.flatnonzero(seen)
    yield pa.record_batch([pa.array(there), pa.array(list(total.reshape(UNITS, DIMS)[there]), pa.list_(pa.float64()))], ["unit", "vector"])


def context_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Context vector of each unit over all documents, scaled to length near 1; shorter for rare units."""
    sums = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(_contexts, "unit long, vector array<double>")
    rows = sums.groupBy("unit").agg(*(F.sum(F.col("vector")[i]).alias(f"d{i}") for i in range(DIMS))).toArrow()  # UNITS rows at most
    out, units = np.zeros((UNITS, DIMS)), rows["unit"].to_numpy()
    for i in range(DIMS):
        out[units, i] = rows[f"d{i}"].to_numpy()
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 20.0)


def features_of(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Pools of a text: means over words and shapes, their spread, likeness of neighbours, and log length."""
    word, shape = units_of(text)
    out = np.zeros(FEATURES)
    if len(word):
        w, s = vectors[word], vectors[shape]
        out[:DIMS], out[DIMS : 2 * DIMS], out[2 * DIMS : 3 * DIMS], out[3 * DIMS : 4 * DIMS] = w.mean(0), s.mean(0), w.std(0), s.std(0)
        out[-4:] = np.log1p(len(word)) / 10, len(np.unique(word)) / len(word), (word[1:] == word[:-1]).sum() / len(word), (shape[1:] == shape[:-1]).sum() / len(word)
    return out


@dataclass
class Network:
    """Two layers; temperature divides the logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, aside: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 1) -> Network:
    """Adam on the log loss of the rows not aside; the temperature minimises the log loss of the rows aside."""
    rng = np.random.default_rng(seed)
    if not len(x):
        return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    fit = ~aside if (~aside).any() else np.ones(len(x), bool)
    z, t = x[fit], y[fit]
    net = Network(z.mean(0), z.std(0) + 1e-3, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), 0.0)
    z -= net.mean
    z /= net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            some = order[at : at + 256]
            a = z[some]
            h = np.maximum(a @ params[0] + params[1], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - t[some]) / len(some)
            dh = np.outer(d, params[2]) * (h > 0)
            step += 1
            for k, g in enumerate((a.T @ dh + 1e-4 * params[0], dh.sum(0), h.T @ d + 1e-4 * params[2], d.sum(keepdims=True))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                params[k] -= 3e-3 * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if aside.any():
        logit, t = net.logits(x[aside]), y[aside]
        loss = lambda T: np.logaddexp(0, np.where(t == 1, -logit, logit) / T).mean()
        net.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return net


def labelled_sample(labels: DataFrame, column: str, folds: int, out: int, rows: int) -> DataFrame:
    """(doc_id, y) of at most `rows` labelled ids outside fold `out`: those first by a hash of the id. Conflicting labels
    of an id are averaged; nulls and ties leave the id out."""
    of = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) != out)
    one = of.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col(column).cast("double")).alias("y")).where("y <> 0.5")
    return one.select("doc_id", (F.col("y") > 0.5).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, y, text), one row for each sampled id: of several rows with its id, that whose text has the least hash.

    The sample is broadcast; its rows, and so the rows here, are bounded by labelled_sample(). Copies of an id are reduced
    to one text in each task before they are shuffled."""
    text = F.col("text").cast("string")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.xxhash64(text).alias("hash"), text.alias("text")).alias("t")).join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id").agg(F.first("y").alias("y"), F.min("t").alias("t")).select("doc_id", "y", F.col("t.text").alias("text"))


def sample_matrix(sample: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, y and the features x of a bounded sample as arrays, by doc_id; x has `width` numbers in each row.

    The driver takes the rows as Arrow batches: as rows of Python floats they have four times the size, and the driver's
    JVM decodes and pickles them besides."""
    rows = sample.select("doc_id", "y", "x").toArrow()
    ids = rows["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    place, x, at = np.empty(len(ids), np.int64), np.empty((len(ids), width)), 0
    place[order] = np.arange(len(ids))
    for part in rows["x"].chunks:
        x[place[at : at + len(part)]] = part.flatten().to_numpy().reshape(-1, width)
        at += len(part)
    return ids[order], rows["y"].to_numpy()[order], x


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features_of(text.as_py(), shared.value) for text in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    return run


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in slices(batches):
            x = np.array([features_of(text.as_py(), vectors) for text in batch.column(1)]).reshape(-1, FEATURES)
            yield pa.record_batch([batch.column(0), pa.array(net.scores(x))], ["doc_id", "score"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, column: str = "quality", folds: int = 3, out: int = 1, sample_rows: int = 20_000) -> tuple[np.ndarray, Network]:
    """Context vectors over all documents and the network trained on at most sample_rows labelled documents, one for each id."""
    with frugal(docs.sparkSession):
        return _fitted(docs, labels, column, folds, out, sample_rows)


def _fitted(docs: DataFrame, labels: DataFrame, column: str, folds: int, out: int, sample_rows: int) -> tuple[np.ndarray, Network]:
    vectors = context_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    sample = sampled_texts(docs, labelled_sample(labels, column, folds, out, sample_rows)).mapInArrow(_features(shared), "doc_id long, y double, x array<double>")
    ids, y, x = sample_matrix(sample, FEATURES)
    shared.destroy()
    net = train(x, y, mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(5) == 0)
    del x
    give_back()
    return vectors, net


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, whole texts.

    score is in [0, 1], higher where label 1 is likelier. A text that is null, empty or without words gets the score of
    all-zero features; without labelled rows every score is 0.5. held_out marks ids of the fold that training never
    sees (null ids: false). Rows that repeat an id are scored each. Labels, languages, sources and ids are no inputs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, "quality", folds, out))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(shared), "doc_id long, score double")
    return with_fold(scored, folds, out)


def with_fold(scored: DataFrame, folds: int, out: int) -> DataFrame:
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == out, F.lit(False))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(shared, at: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in slices(batches):
            x = np.array([features_of(text.as_py(), vectors) for text in batch.column(at)]).reshape(-1, FEATURES)
            yield batch.filter(pa.array(net.scores(x) >= least))

    return run


def keep_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, out: int = 1, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose quality score is at least `least`.

    Null and empty texts have the score of all-zero features and are judged by it like others; rows that repeat are judged
    each; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, "quality", folds, out))
    return docs.mapInArrow(_keep(shared, docs.columns.index("text"), least), docs.schema)
