"""From raw documents to token ids, in five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.decontaminate import keep_clean
from ledgerlake.llm.ngram_join import keep_one_of_each
from ledgerlake.llm.pii import mask_personal_data
from ledgerlake.llm.quality import keep_quality
from ledgerlake.llm.queries import piece_model, table
from ledgerlake.llm.sentencepieces import encode_digests
from ledgerlake.storage import discard, frugal, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Null and empty texts have all-zero features and are judged like
    others; rows that repeat are judged each; an empty table stays empty."""
    return keep_quality(docs, table(spark, sf_dir, "labels"), folds=3, out=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 80 % of their 5-word shingles, the document with the smallest id stays.

    Null and empty texts have no shingles and stay; of equal rows one stays; a row without id stays if no linked row has one."""
    return keep_one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go, or with all words of a shorter item. Null and empty
    texts stay, and so do rows that repeat."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"), size=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows where there is such a column. Null texts stay null, with a
    null n_chars; rows that repeat stay."""
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as counts and digests of ids and of the decoded texts; null counts as empty."""
    return encode_digests(docs, piece_model())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("SentencePiece encoding", tokens),
]

#: The classifier and the encoder are no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's output is written, and what the stage and the one before it wrote is deleted then. Arrow batches are
    bounded by bytes in all stages."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with frugal(spark), scratch() as keep:
            done = keep(stage(spark, docs, sf_dir), "corpus_stage")
        discard(docs)
        docs = done
    return docs
