"""Toxicity: a support vector machine over a gapped subsequence kernel with Nyström landmarks, trained on sentences.

The kernel of two words counts their common subsequences of three letters, a subsequence that spans d + 1 letters
weighing DECAY**d, up to a span of SPAN + 1 letters. So letters put into a word change few of its subsequences. Words
are read as a reader sees them: letters without the symbols between them, single letters in a row joined, digits and
signs that stand for letters read as these. Sentences end at a stop, question or exclamation mark before white space,
at a line's end, or after LONGEST words.

The machine is trained on the distinct sentences of labelled documents: every sentence has its document's label and
weight one, dealt among its words, and every word of three letters or more is a training point of each class whose
sentences have it. No word is left out, and none is chosen by hand: words that both classes use pull both ways and end
near the middle. Landmark words give the Nyström map x -> K^(-1/2) k(x, landmarks). The machine is linear in that space;
its Newton steps are sums over the words, which Spark's tasks add up. The sum over landmarks folds into one weight for
each subsequence, so scoring a word is a sum over its subsequences. A document's score is a logistic function of the
highest margins of its words, and of how many are high.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.quality import labelled_sample, sample_matrix, sampled_texts, with_fold
from ledgerlake.llm.words import mix
from ledgerlake.storage import discard, materialize

BITS, SPAN, DECAY, LONGEST, RARE = 15, 5, 0.6, 16, 1.5
#: Distances of the second and third letter of a subsequence, and its weight.
GAPS = [(i, j, DECAY ** (i + j)) for i in range(1, SPAN) for j in range(1, SPAN + 1 - i)]
_REACH = np.array([i + j for i, j, _ in GAPS])
_SQUARES = np.array([w * w for *_, w in GAPS])
#: Signs read as letters.
READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"}

_TABLE, _DROP, _SPACE = 0x600, 0, 1
#: Kind of each sign: dropped, white space, or 2 plus the letter; a-z are 0 to 25, others their lower-cased code point.
_KIND = np.full(_TABLE, _DROP, np.uint32)
for _c in range(_TABLE):
    if chr(_c).isalpha():
        _low = ord(chr(_c).lower()[0])
        _KIND[_c] = 2 + (_low - 97 if 97 <= _low <= 122 else 26 + _low)
for _a, _b in READ_AS.items():
    _KIND[ord(_a)] = 2 + ord(_b) - 97
for _c in (0x20, *range(0x09, 0x0E), 0x85, 0xA0):
    _KIND[_c] = _SPACE
_STOPS = np.isin(np.arange(_TABLE), [ord(c) for c in ".!?"])
_BREAKS = np.isin(np.arange(_TABLE), [0x0A, 0x0D, 0x85])


def _place_codes(letters: np.ndarray) -> list[np.ndarray]:
    """For each of the three places of a subsequence, a code of BITS bits for every letter; the index of a subsequence
    is the exclusive or of its codes. Triples of a-z have an index of their own, others one by hash."""
    latin = letters < 26
    own = [letters << np.uint32(10), letters << np.uint32(5), letters]
    if latin.all():
        return own
    wide = letters.astype(np.uint64) * np.uint64(3)
    return [np.where(latin, o, (mix(wide + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.uint32)) for k, o in enumerate(own)]


_CODES = np.stack(_place_codes(np.maximum(_KIND, 2) - np.uint32(2)))


@dataclass
class Reading:
    """Letters of a text: their codes for each place, and where words and sentences start among them."""

    codes: np.ndarray
    words: np.ndarray
    sentences: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.words, self.codes.shape[1]))


def read_text(text: str | None) -> Reading:
    cp = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.minimum(cp, _TABLE - 1)
    far = cp >= _TABLE
    kind = _KIND[low]
    if far.any():
        mark = ((cp >= 0x2000) & (cp < 0x2070)) | ((cp > 0x3000) & (cp < 0x3040))
        kind = np.where(far, np.where(cp == 0x3000, _SPACE, np.where(mark, _DROP, 28 + cp)), kind).astype(np.uint32)
    space, letter = kind == _SPACE, kind > 1
    at = np.flatnonzero(letter)
    if not len(at):
        return Reading(np.zeros((3, 0), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    codes = np.stack(_place_codes(kind[at] - np.uint32(2))) if far.any() else _CODES[:, cp[at]]
    ends = _BREAKS[low] & ~far
    ends[:-1] |= (_STOPS[low] & ~far)[:-1] & space[1:]
    word, part = np.cumsum(space)[at], np.cumsum(ends)[at]
    new = np.concatenate(([True], word[1:] != word[:-1]))
    starts = np.flatnonzero(new)
    single = np.diff(np.append(starts, len(at))) == 1
    starts = starts[~np.concatenate(([False], single[1:] & single[:-1]))]
    # a sentence starts with the first word behind an end, and behind LONGEST words
    first = np.concatenate(([True], part[starts[1:]] != part[starts[:-1]]))
    order = np.arange(len(starts))
    since = order - np.maximum.accumulate(np.where(first, order, 0))
    return Reading(codes, starts, starts[first | (since % LONGEST == 0)])


def _triples(r: Reading) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """First positions, index and weight of the subsequences within words, gap by gap."""
    n = r.codes.shape[1]
    word = np.zeros(n, np.int64)
    word[r.words[1:]] = 1
    word = np.cumsum(word)
    one, two, three = r.codes
    for i, j, weight in GAPS:
        if n > i + j:
            at = np.flatnonzero(word[: n - i - j] == word[i + j :])
            yield at, one[at] ^ two[at + i] ^ three[at + i + j], weight


def _norms(r: Reading) -> np.ndarray:
    """Length of each word's feature vector if no subsequence comes twice, for words of any size."""
    return np.sqrt(np.maximum(np.maximum(r.sizes()[:, None] - _REACH, 0) @ _SQUARES, 1e-12))


def packed_words(r: Reading) -> list[bytes]:
    """Each word as the bytes of its letters' codes, place by place."""
    codes, ends = r.codes.astype("<u2"), np.append(r.words[1:], r.codes.shape[1])
    return [codes[:, a:b].tobytes() for a, b in zip(r.words.tolist(), ends.tolist())]


def unpacked_words(words: list[bytes]) -> Reading:
    """The reading of some packed words; its sentences are the words."""
    codes = [np.frombuffer(w, "<u2").reshape(3, -1) for w in words]
    starts = np.cumsum([0, *(c.shape[1] for c in codes)])[:-1].astype(np.int64)
    return Reading(np.concatenate(codes, axis=1).astype(np.uint32) if codes else np.zeros((3, 0), np.uint32), starts, starts)


def folded(r: Reading, table: np.ndarray, block: int = 512) -> np.ndarray:
    """Each word's normalised features times a table with a row for each subsequence; a block of letters at a time."""
    out = np.zeros((len(r.words), table.shape[1]), np.float32)
    word = np.searchsorted(r.words, np.arange(r.codes.shape[1]), "right") - 1
    for at, index, weight in _triples(r):
        for k in range(0, len(at), block):
            own = word[at[k : k + block]]
            cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            out[own[cut]] += np.float32(weight) * np.add.reduceat(table[index[k : k + block]], cut)
    return out / _norms(r)[:, None].astype(np.float32)


def feature_rows(r: Reading) -> np.ndarray:
    """The kernel's normalised features, one row for each word of a reading."""
    out = np.zeros((len(r.words), 1 << BITS), np.float32)
    word = np.searchsorted(r.words, np.arange(r.codes.shape[1]), "right") - 1
    for at, index, weight in _triples(r):
        np.add.at(out, (word[at], index), np.float32(weight))
    return out / _norms(r)[:, None].astype(np.float32)


def nystroem(marks: np.ndarray, floor: float = 1e-4) -> np.ndarray:
    """The map from features to the space of the landmarks: marks' times K^(-1/2) on the eigenvectors above the floor."""
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > floor * value.max()
    return marks.T @ (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)


@dataclass
class StringMachine:
    weights: np.ndarray
    bias: float
    document: np.ndarray  # logistic weights of document_features(), the last is the constant

    def margins(self, text: str | None) -> np.ndarray:
        """The margin of each word of three letters or more."""
        r = read_text(text)
        if not len(r.words):
            return np.zeros(0)
        total = np.zeros(r.codes.shape[1])
        for at, index, weight in _triples(r):
            total[at] += weight * self.weights[index]
        return (np.add.reduceat(total, r.words) / _norms(r) + self.bias)[r.sizes() >= 3]

    def document_features(self, text: str | None) -> np.ndarray:
        m = self.margins(text)
        top = np.sort(m[np.argpartition(m, -2)[-2:]])[::-1] if len(m) > 1 else np.append(m, [-2.0] * (2 - len(m)))
        return np.array([*np.clip(top, -2, 1), *(np.log1p((m > t).sum()) for t in (0, 0.5, 0.8)), 1.0])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.document_features(text) @ self.document, -30, 30))))


DOCUMENT = 6


def newton_sums(z: np.ndarray, bad: np.ndarray, good: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The sums of a Newton step of the squared hinge loss over some words, as one matrix: Gram matrix and, as its last
    column, the right-hand side. Words within the margin of a class count with their weight in it; the last entry of w
    is the bias."""
    z = np.column_stack([z, np.ones(len(z), np.float32)]).astype(np.float64)
    f = z @ w
    a, c = bad * (f < 1), good * (f > -1)
    return np.column_stack([(z * (a + c)[:, None]).T @ z, z.T @ (a - c)])


def newton_step(sums: np.ndarray, ridge: float = 1e-5) -> np.ndarray:
    return np.linalg.solve(sums[:, :-1] + ridge * np.eye(len(sums)), sums[:, -1])


def fit_words(words: list[bytes], bad: np.ndarray, good: np.ndarray, marks: list[bytes], steps: int = 10) -> tuple[np.ndarray, float]:
    """Weights of the subsequences and bias of the machine for words with their weights in both classes, in memory."""
    turn = nystroem(feature_rows(unpacked_words(marks)))
    z, w = folded(unpacked_words(words), turn), np.zeros(turn.shape[1] + 1)
    for _ in range(steps):
        w, old = newton_step(newton_sums(z, bad / bad.sum(), good / good.sum(), w)), w
        if np.allclose(w, old, atol=1e-5):
            break
    return (turn @ w[:-1]).astype(np.float64), float(w[-1])


def fit_documents(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; rows of label 1 weigh RARE times as much."""
    w, cost = np.zeros(x.shape[1]), np.where(y == 1, RARE, 1.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (cost * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (cost * (y - p)) - 0.1 * w)
    return w


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, sentence, words): each sentence of labelled texts, as a hash, with its words of three letters or more."""
    for batch in batches:
        labels, keys, words = [], [], []
        for y, text in zip(batch.column(1).to_pylist(), batch.column(2)):
            r = read_text(text.as_py())
            cut = np.append(np.searchsorted(r.words, r.sentences), len(r.words)).tolist()
            packed = packed_words(r)
            for a, b in zip(cut, cut[1:]):
                long = [w for w in packed[a:b] if len(w) >= 18]
                if long:
                    labels.append(y), words.append(long), keys.append(b"|".join(packed[a:b]))
        yield pa.record_batch([pa.array(labels, pa.float64()), pa.array(keys, pa.binary()), pa.array(words, pa.list_(pa.binary()))], ["y", "sentence", "words"])


def _sums(shared, w: np.ndarray, n_bad: float, n_good: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = shared.value
        total = np.zeros((len(w), len(w) + 1))
        for batch in batches:
            words = batch.column(0).to_pylist()
            for k in range(0, len(words), 2048):
                z = folded(unpacked_words(words[k : k + 2048]), turn)
                bad, good = (batch.column(c).to_numpy(zero_copy_only=False)[k : k + 2048] / n for c, n in ((1, n_bad), (2, n_good)))
                total += newton_sums(z, bad, good, w)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return run


def _document_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.document_features(text.as_py()).tolist() for text in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    return run


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([shared.value.score(text.as_py()) for text in batch.column(1)], pa.float64())], ["doc_id", "score"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, sample_rows: int = 6000, landmarks: int = 512, steps: int = 100, tasks: int = 8) -> StringMachine:
    """Trains on at most sample_rows labelled documents, all their sentences and words, until a Newton step changes nothing.

    There are as many landmarks as the root of the number of distinct words, at most `landmarks`. Half of them are the words whose share of weight in toxic sentences is the most surprising, half the most
    used others. The words are dealt to `tasks` tasks; of each Newton step the driver gets one matrix for each task.
    """
    spark = docs.sparkSession
    texts = sampled_texts(docs, labelled_sample(labels, "toxic", folds, out, sample_rows))
    size = texts.agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")).first()
    n_bad, n_good = float(size["bad"] or 0), float(size["good"] or 0)
    silent = StringMachine(np.zeros(1 << BITS), -1.0, np.array([0.0] * (DOCUMENT - 1) + [np.log((n_bad + 1) / (n_good + 1))]))
    if not n_bad or not n_good:
        return silent
    sentences = texts.mapInArrow(_sentences, "y double, sentence binary, words array<binary>").select("y", F.sha2("sentence", 256).alias("sentence"), "words").dropDuplicates(["y", "sentence"])
    each = sentences.select("y", (1 / F.size("words")).alias("share"), F.explode("words").alias("word"))
    types = materialize(each.groupBy("word").agg(F.sum(F.col("y") * F.col("share")).alias("bad"), F.sum((1 - F.col("y")) * F.col("share")).alias("good")), "toxicity_words")
    whole = types.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n")).first()
    if not whole["bad"] or not whole["good"]:
        return silent
    landmarks = min(landmarks, int(np.ceil(np.sqrt(whole["n"]))) + 2)
    both = F.col("bad") + F.col("good")
    expected = both * (whole["bad"] / (whole["bad"] + whole["good"]))
    first = lambda df, order, n: [bytes(r["word"]) for r in df.orderBy(order, "word").limit(n).collect()]
    uneven = first(types, F.desc((F.col("bad") - expected) / F.sqrt(expected + 1)), landmarks // 2)
    common = [w for w in first(types, F.desc(both), landmarks) if w not in set(uneven)][: landmarks // 2]
    turn = nystroem(feature_rows(unpacked_words(uneven + common)))
    w, dealt, shared = np.zeros(turn.shape[1] + 1), types.repartition(tasks), spark.sparkContext.broadcast(turn)
    for _ in range(steps):
        sums = sum(np.frombuffer(r["sums"]).reshape(len(w), -1) for r in dealt.mapInArrow(_sums(shared, w, whole["bad"], whole["good"]), "sums binary").collect())
        w, old = newton_step(sums), w
        if np.allclose(w, old, atol=1e-5):
            break
    else:
        raise ArithmeticError(f"{steps} Newton steps did not converge")
    shared.destroy()
    discard(types)
    machine = StringMachine((turn @ w[:-1]).astype(np.float64), float(w[-1]), silent.document)
    rows = texts.mapInArrow(_document_rows(spark.sparkContext.broadcast(machine)), "doc_id long, y double, x array<double>")
    _, y, x = sample_matrix(rows, DOCUMENT)
    machine.document = fit_documents(x, y)
    return machine


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, whole texts.

    score is in [0, 1], higher where label 1 is likelier. A null or empty text, or one without letters, has no sentences
    and gets the score of a document without any; without labelled rows of both classes every row gets the share of
    toxic rows. held_out marks ids of the fold that training never sees (null ids: false). Rows that repeat an id are
    scored each. Labels, languages, sources and ids are no inputs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, folds, out))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(shared), "doc_id long, score double")
    return with_fold(scored, folds, out)
