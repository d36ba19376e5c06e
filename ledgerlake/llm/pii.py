r"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidate spans: the four base kinds, and looser forms (addresses spelled with "at" and "dot", phone numbers
without a country code, card-like numbers that the base kind rejects). Five labelers vote on each candidate for, against or not at all: the strict
format, gazetteers (domains, reserved address blocks, issuer prefixes, area codes), words of the context, the characters next to
it, and its shape. Votes are counted over all documents by pattern, a table of bounded size. Expectation-maximisation on it estimates
each labeler's reliability and the probability of each pattern, and a logistic span classifier is fitted to these
probabilities. Base spans always stay; a looser candidate is added where the classifier gives it at least one half.

The patterns match what the plain ones do but start only where a run starts, so that long runs are read once:
e-mail at the start of a run or where the last match ended; card numbers by their bounded number of digits. The labels
of an address repeat possessively: nothing follows them, so the match is the same, and the loop takes no stack. Places
come from running sums in blocks, and contexts from the pieces between matches, so a text with very many matches costs
in proportion to its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.storage import discard, materialize

KINDS = ["email", "ip", "card", "phone"]
#: Candidate types: kind, pattern, and lower-case text, or else a pattern, without which the pattern cannot match.
TYPES = {
    "email": ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@"),
    "ip": ("ip", r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "."),
    "card": ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])", None),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "mail_words": ("email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,4}", "dot"),
    "phone_plain": ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", None),
    "card_other": ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])", None),
}
#: For types without such text. The digits of a card number may all stand apart.
NEEDS = {"card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "card_other": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone_plain": "[0-9]{3}"}
BASE = ["email", "ip", "card", "phone"]
LABELERS = ["format", "gazetteer", "context", "neighbours", "shape"]

#: Gazetteers and cue words; fixed values.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|eu|de|fr|es|it|uk|us|ca|au|nl|ch|at|be|pt|br|mx|ar|pl|se|no|fi|dk|jp|kr|cn|in"
FOR = r"(?i)(?:e-?mail|mailto|contact|write|courriel|correo|call|phone|tel|mobile|cell|fax|telefon|teléfono|téléphone|card|visa|mastercard|amex|credit|payment|karte|tarjeta|carte|ip|address|host|server|login)\W{0,3}\w{0,12}\W{0,3}$"
AGAINST = r"(?i)(?:version|release|v|isbn|issn|section|chapter|figure|fig|order|invoice|no|id|ref|build|sku|part|serial)[\W_]{0,3}$"


def _matches(name: str, text: Column) -> Column:
    _, pattern, hint = TYPES[name]
    none = F.array().cast("array<string>")
    there = text.rlike(NEEDS[name]) if hint is None else F.contains(F.lower(text) if hint.isalpha() else text, F.lit(hint))
    return F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(c: Column) -> Column:
    """Whether a string of digits passes the Luhn check; false for the empty string."""
    back = F.reverse(c)
    at = F.sequence(F.lit(1), F.length(c))
    digit = lambda i: F.substr(back, i, F.lit(1)).cast("int")
    twice = lambda d: F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)))
    return (F.length(c) > 0) & (F.when(F.length(c) > 0, total % 10 == 0))


#: Parts of an address up to 255, whatever their leading zeros.
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "card_other":  # what the base kind rejects
        return (F.length(_digits(m)) < 16) | ~luhn(_digits(m))
    return F.lit(True)


def _votes(kind: str, m: Column, before: Column, after: Column) -> list[Column]:
    """The labelers' votes on a candidate: 1, -1 or 0."""
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    d = _digits(m)
    strict = F.lit(1) if kind in BASE else vote(F.lit(False), ~luhn(d)) if kind == "card_other" else F.lit(0)
    known = {
        "email": m.rlike(rf"(?i)\.(?:{DOMAINS})$"), "mail_words": m.rlike(rf"(?i)(?:dot[)\]]? ?)(?:{DOMAINS})$"),
        "ip": ~m.rlike(r"^0*(?:0|22[4-9]|2[3-5][0-9])\."), "card": d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"),
        "phone": d.rlike("^(?:1[2-9]|[2-9])"), "phone_plain": d.rlike("^[2-9]"), "card_other": d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"),
    }[kind]
    apart = ~(before.rlike(r"[\w@]$") | after.rlike(r"^[\w@]"))
    typical = {"phone": m.rlike(r"[0-9]{3}[\x20.-][0-9]{4}$"), "phone_plain": m.rlike(r"^\([0-9]{3}\)|^([0-9]{3})([-.])[0-9]{3}\2[0-9]{4}$"), "email": m.rlike("^[A-Za-z]"), "card": F.length(d) == 16, "card_other": F.length(d) == 15}
    dull = d.rlike(r"^([0-9])\1+$") | d.rlike("^(?:0123456789|1234567890)") if kind not in ("email", "mail_words") else F.lit(False)
    return [strict, vote(known, ~known), vote(before.rlike(FOR), before.rlike(AGAINST)), vote(apart, ~apart), vote(typical.get(kind, F.lit(False)) & ~dull, dull)]


#: Entries of a block of a running fold.
BLOCK = 128


def _sizes(found: Column, rest: Column) -> Column:
    return F.transform(found, lambda x, i: F.length(x) + F.length(F.get(rest, i)))


def _blocks(items: Column, fold) -> Column:
    """For each block of an array, the fold of all entries before it; items must be a column, not an expression."""
    n = F.ceil(F.size(items) / F.lit(BLOCK)).cast("int")
    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    return F.transform(at, lambda b: fold(F.slice(items, F.lit(1), b * BLOCK)))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _before(items: Column, blocks: Column, i: Column, fold, join) -> Column:
    """The fold of the entries before place i, from the blocks' folds and the rest of its own block.

    blocks is read in two places: the optimizer copies a column that is read once into its reader, here into the lambda,
    where it would be computed for every entry again."""
    b = F.floor(i / F.lit(BLOCK)).cast("int")
    return join(F.coalesce(F.get(blocks, b), F.get(blocks, F.lit(0))), fold(F.slice(items, b * BLOCK + 1, i % BLOCK)))


def _candidates_of(name: str, found: Column, rest: Column, sizes: Column, blocks: Column) -> Column:
    """Structs of the valid candidates of one type, from its matches, the pieces of text before and behind them, the
    sizes of piece and match together and their running sums. A context reaches back over one earlier match at most."""
    kind = TYPES[name][0]

    def one(m: Column, i: Column) -> Column:
        piece = F.get(rest, i)
        start = _before(sizes, blocks, i, _sum, lambda a, b: a + b) + F.length(piece)
        back = F.concat(F.coalesce(F.get(rest, i - 1), F.lit("")), F.coalesce(F.get(found, i - 1), F.lit("")), piece)
        front = F.concat(F.get(rest, i + 1), F.coalesce(F.get(found, i + 1), F.lit("")))
        return F.struct(m.alias("m"), start.alias("start"), F.right(back, F.lit(32)).alias("before"), F.left(front, F.lit(2)).alias("after"))

    def voted(c: Column) -> Column:
        m = c["m"]
        bucket = F.when(F.length(m) < 14, 0).when(F.length(m) < 20, 1).otherwise(2)
        votes = _votes(name, m, c["before"], c["after"])
        return F.struct(F.lit(name).alias("type"), F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), (c["start"] + F.length(m)).alias("end"), bucket.alias("bucket"), *(v.cast("int").alias(x) for v, x in zip(votes, LABELERS)))

    none = F.array().cast(f"array<struct<type:string,kind:int,start:int,end:int,bucket:int,{','.join(f'{x}:int' for x in LABELERS)}>>")
    return F.when(F.size(found) > 0, F.transform(F.filter(F.transform(found, one), lambda c: _valid(name, c["m"])), voted)).otherwise(none)


def with_candidates(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with `base` and `loose`: arrays of candidate structs with their votes. Null text counts as empty.

    Base candidates of a kind are the leftmost matches without overlap that pass the kind's check; matches that fail it
    are dropped and not tried again. Loose candidates that overlap a base candidate are left out.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    m, p, n, b = ({name: f"_{k}_{name}" for name in TYPES} for k in "mpnb")
    # each step keeps the last one's columns: so Spark computes them once for a row, not once for an entry
    out = docs.select("*", *(_matches(name, text).alias(m[name]) for name in TYPES))
    # pieces only where there is a match; -1 keeps empty pieces at the end
    out = out.select("*", *(F.when(F.size(m[name]) > 0, F.split(text, pattern, -1)).alias(p[name]) for name, (_, pattern, _) in TYPES.items()))
    out = out.select("*", *(F.when(F.size(m[name]) > 0, _sizes(F.col(m[name]), F.col(p[name]))).alias(n[name]) for name in TYPES))
    out = out.select("*", *(F.when(F.size(m[name]) > 0, _blocks(F.col(n[name]), _sum)).alias(b[name]) for name in TYPES))
    made = {name: _candidates_of(name, *(F.col(x[name]) for x in (m, p, n, b))) for name in TYPES}
    out = out.select("*", F.concat(*(made[k] for k in BASE)).alias("base"), F.concat(*(made[k] for k in TYPES if k not in BASE)).alias("_loose"))
    # blocks of base candidates with their reach, so that a loose one is compared with those of few blocks only
    some = lambda b: F.slice("base", b * BLOCK + 1, F.lit(BLOCK))
    reach = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("base") / F.lit(BLOCK)).cast("int")),
        lambda b: F.struct(F.array_min(F.transform(some(b), lambda c: c["start"])).alias("low"), F.array_max(F.transform(some(b), lambda c: c["end"])).alias("high"), b.alias("b")),
    )
    out = out.select("*", F.when(F.size("_loose") > 0, reach).alias("_reach"))
    meet = lambda x, low, high: (low < x["end"]) & (x["start"] < high)
    hit = lambda x: F.exists("_reach", lambda r: meet(x, r["low"], r["high"]) & F.exists(some(r["b"]), lambda c: meet(x, c["start"], c["end"])))
    clear = F.filter("_loose", lambda x: ~F.coalesce(hit(x), F.lit(False)))
    out = out.withColumn("loose", F.when((F.size("_loose") > 0) & F.col("_reach").isNotNull(), clear).otherwise(F.col("_loose")))
    return out.drop("_loose", "_reach", *(x[name] for x in (m, p, n, b) for name in TYPES))


@dataclass
class SpanModel:
    """Reliabilities of the labelers and weights of the span classifier."""

    reliability: dict[str, tuple[float, float]] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)

    def probability(self, c: Column) -> Column:
        """The classifier's probability that a candidate struct is personal data."""
        w = lambda k: F.lit(float(self.weights.get(k, 0.0)))
        z = w("bias")
        for name in TYPES:
            z = z + F.when(c["type"] == name, w(f"type:{name}")).otherwise(0.0)
        for x in LABELERS:
            z = z + w(f"vote:{x}") * c[x]
        for b in range(3):
            z = z + F.when(c["bucket"] == b, w(f"size:{b}")).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _features(row: dict) -> dict[str, float]:
    return {"bias": 1.0, f"type:{row['type']}": 1.0, f"size:{row['bucket']}": 1.0} | {f"vote:{x}": float(row[x]) for x in LABELERS}


def expectation_maximisation(rows: list[dict], rounds: int = 60) -> tuple[dict[str, tuple[float, float]], list[float]]:
    """Reliabilities (P(for | personal), P(for | not)) of each labeler and the probability of each pattern of votes.

    rows: type, bucket, votes and n (how many candidates). Abstentions say nothing. Starts from the share of votes for.
    """
    cast = [[row[x] for x in LABELERS] for row in rows]
    p = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes)) for votes in cast]
    rates: dict[str, tuple[float, float]] = {}
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        for row, q in zip(rows, p):
            t = prior.setdefault(row["type"], [1.0, 2.0])
            t[0] += q * row["n"]
            t[1] += row["n"]
        for j, x in enumerate(LABELERS):
            yes, no = [4.0, 5.0], [1.0, 5.0]  # a labeler is taken to be better than chance until counts say otherwise
            for row, votes, q in zip(rows, cast, p):
                if votes[j]:
                    for pair, share in ((yes, q), (no, 1 - q)):
                        pair[0] += share * row["n"] * (votes[j] > 0)
                        pair[1] += share * row["n"]
            rates[x] = yes[0] / yes[1], no[0] / no[1]
        for k, (row, votes) in enumerate(zip(rows, cast)):
            a, b = prior[row["type"]]
            z = math.log(a / (b - a))
            for j, x in enumerate(LABELERS):
                if votes[j]:
                    s, t = rates[x]
                    z += math.log(s / t) if votes[j] > 0 else math.log((1 - s) / (1 - t))
            p[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return rates, p


def fit_classifier(rows: list[dict], p: list[float], steps: int = 400) -> dict[str, float]:
    """Logistic regression of the probabilities p on type, votes and size, by gradient steps with a small ridge.

    A pattern weighs the logarithm of its count, so that rare patterns are heard."""
    weights: dict[str, float] = {}
    data = [(_features(row), q, math.log1p(row["n"])) for row, q in zip(rows, p)]
    total = sum(n for _, _, n in data) or 1.0
    for step in range(steps):
        gradient: dict[str, float] = {}
        for x, q, n in data:
            z = sum(weights.get(k, 0.0) * v for k, v in x.items())
            d = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - q) * n / total
            for k, v in x.items():
                gradient[k] = gradient.get(k, 0.0) + d * v
        for k, g in gradient.items():
            weights[k] = weights.get(k, 0.0) - 2.0 * (g + 1e-4 * weights.get(k, 0.0))
    return weights


def fit_span_model(candidates: DataFrame) -> SpanModel:
    """Fits the model to the votes of all candidates; what reaches the driver is one row for each pattern of votes (at
    most types x sizes x 3 ** labelers). Without candidates nothing is added to the base spans."""
    keys = ["type", "bucket", *LABELERS]
    counted = candidates.select(F.explode(F.concat("base", "loose")).alias("c")).select("c.*").groupBy(*keys).agg(F.count("*").alias("n"))
    rows = sorted((r.asDict() for r in counted.collect()), key=lambda r: [str(r[k]) for k in keys])
    if not rows:
        return SpanModel(weights={"bias": -1.0})
    rates, p = expectation_maximisation(rows)
    return SpanModel(rates, fit_classifier(rows, p))


def with_spans(candidates: DataFrame, model: SpanModel) -> DataFrame:
    """candidates with `spans`: base candidates and the loose ones that the classifier takes, by kind and place.

    No span comes twice: a type's matches do not overlap, and no two types beside the base ones have one kind."""
    plain = lambda a: F.transform(a, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    taken = F.when(F.size("loose") > 0, F.filter("loose", lambda c: model.probability(c) >= 0.5)).otherwise(F.col("loose"))
    return candidates.withColumn("spans", F.array_sort(F.concat(plain(F.col("base")), plain(taken))))


def _joined(a: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda c: c["kind"] == kind))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of docs, whole texts.

    The counts and base_sha256 (hash of kind:start:end, comma-joined, by kind and start) are of the base spans; spans
    joins all spans likewise. Places are in code points, the end is exclusive. Null and empty texts have no spans; null
    ids and repeated rows pass through; no text gives the hash of the empty string.
    """
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    found = materialize(with_candidates(base).select("doc_id", "base", "loose"), "pii_candidates")
    out = with_spans(found, fit_span_model(found))
    ordered = F.array_sort(F.transform("base", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    return out.select("doc_id", *(_count(k).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)), F.sha2(_joined(ordered), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def mask_personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with every span of its text replaced by its kind in angle brackets; overlapping spans become the first's kind.

    Null and empty texts stay as they are, and so do all other columns; rows that repeat stay as often. The candidates
    are found once and kept with their rows in a table, from which the model is fitted and the texts are masked.
    """
    # all columns of a row travel in one struct, so that their names cannot clash with those added here
    packed = docs.select(F.struct("*").alias("row"), F.col(text_column).cast("string").alias("text"))
    found = materialize(with_candidates(packed).select("row", "text", "base", "loose"), "pii_candidates")
    text, spans = F.col("text"), with_spans(found, fit_span_model(found))
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # each step keeps the last one's columns, as in with_candidates()
    out = spans.select("*", by_place.alias("_s"), F.transform(by_place, lambda s: s["end"]).alias("_ends"))
    furthest = lambda a: F.coalesce(F.array_max(a), F.lit(0))
    # a text with many spans is cut by signs, so that no cut reads it from its start
    out = out.select("*", _blocks(F.col("_ends"), furthest).alias("_far"), F.when(F.size("_s") > 64, F.split(text, "")).alias("_signs"))
    cut = lambda a, n: F.when(F.col("_signs").isNotNull(), F.array_join(F.slice("_signs", a + 1, n), "")).otherwise(F.substr(text, a + 1, n))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def piece(s: Column, i: Column) -> Column:
        done = _before(F.col("_ends"), F.col("_far"), i, furthest, F.greatest)
        return F.when(s["start"] < done, "").otherwise(F.concat(cut(done, F.greatest(s["start"] - done, F.lit(0))), F.get(names, s["kind"])))

    end = furthest(F.col("_ends"))
    masked = F.concat(F.array_join(F.transform("_s", piece), ""), cut(end, F.greatest(F.length(text) - end, F.lit(0))))
    out = out.select("*", F.when(F.size("_s") > 0, masked).otherwise(text).alias("_masked"))
    field = lambda c: F.col("row").getField(c)
    return out.select(*(F.col("_masked").alias(c) if c == text_column else field(c).alias(c) for c in docs.columns))
