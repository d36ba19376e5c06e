"""The corpus pipeline against its stages put together by hand from brute-force parts."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import pii, quality, queries
from tests.llm.test_ops import brute_components, brute_contamination

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    kept = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good)
    first = {d for d, _, c in brute_components(kept, 5, 80) if d == c}
    kept = [x for x in kept if x[0] in first]
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    dirty = {r[0] for r in brute_contamination(kept, items, 10) if r[5]}
    kept = [x for x in kept if x[0] not in dirty]
    masked = pii.mask_personal_data(spark.createDataFrame(kept, "doc_id long, text string")).collect()
    library = __import__("sentencepiece").SentencePieceProcessor(model_file=queries.piece_model())
    want = []
    for d, t in masked:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(want)
    assert 0 < len(want) < docs.count()


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "some words are here " * 5, None, None, None)]])
def test_stages_on_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("spans", F.lit(1)).withColumn("cls", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert out.count() <= max(len(rows), 0)


def test_near_duplicate_stage(spark):
    own = [f"w{i}" for i in range(500)]
    edited = [f"e{i}" if i % 50 == 25 else w for i, w in enumerate(own)]
    longer = own[:300] + [f"n{i}" for i in range(90)] + own[300:]
    other = [f"o{i}" if i % 40 == 20 else w for i, w in enumerate(own)]
    texts = [(i, " ".join(w)) for i, w in enumerate([own, edited, longer, other])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == [d for d, _, c in brute_components(texts, 5, 80) if d == c] == [0, 3]
