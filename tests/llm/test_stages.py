"""The pipeline's stages on a whole small table, each against what its input says by itself."""

import numpy as np
import pandas as pd

import corpus_pipeline
from starmill.llm import common
from starmill.llm import decontaminate as D
from starmill.llm.common import read, stage


def test_stages_one_after_another(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    work, before = dict(corpus_pipeline.STAGES), docs.collect()
    assert list(work) == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for name in ("toxicity", "near_duplicates", "decontamination", "secrets"):
        docs = stage(work[name](spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == read(spark, sf_dir, "documents").columns
        after = docs.collect()
        ids = {r.doc_id for r in after}
        if name == "near_duplicates":  # of equal texts one stays, and no text without a like goes whole
            texts = [r.text for r in after if r.text]
            assert len(texts) == len(set(texts)) and len(after) >= 0.5 * len(before)
        if name == "decontamination":
            items = [np.array(D.words(r.text), dtype=object) for r in read(spark, sf_dir, "benchmark").collect()]
            for r in before:
                words = np.array(D.words(r.text or ""), dtype=object)
                text = b" ".join([b"", *words, b""])
                if any(b" ".join([b"", *item, b""]) in text for item in items):
                    assert r.doc_id not in ids
                elif r.doc_id not in ids:  # the whole text holds at least what a region of it holds
                    assert any(D.verified(item, words) for item in items)
        if name == "secrets":
            assert ids == {r.doc_id for r in before} and len(after) == len(before)
        else:
            assert {tuple(r) for r in after} <= {tuple(r) for r in before}
        before = after
    pieces = work["packing"](spark, docs, sf_dir).collect()
    lengths, wanted = {}, {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
        wanted[p.doc_id] = p.doc_tokens
    assert lengths == wanted and set(lengths) == {r.doc_id for r in before}


def test_texts_go_to_python_in_small_batches(spark, sf_dir):
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    held, docs = {k: spark.conf.get(k) for k in (rows, size)}, read(spark, sf_dir, "documents")
    try:
        for _, work in corpus_pipeline.STAGES:
            spark.conf.set(rows, "10000")
            spark.conf.set(size, str(1 << 30))
            work(spark, docs, sf_dir)
            texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('x', 20000) AS text")
            counted = texts.mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n long")
            sizes = [r.n for r in counted.collect()]
            assert max(sizes) <= common.BATCH_ROWS and max(sizes) * 20_000 < 2 * common.BATCH_BYTES
    finally:
        for k, value in held.items():
            spark.conf.set(k, value)
