"""Each stage of the pipeline against a brute-force version on its input."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from tallyflow.llm import decontamination, language_id, mixing
from tallyflow.llm.common import staged
from tests.llm.helpers import SCHEMA, jaccard_components, words
import random

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(100_000, None, "en", "s", 0), (100_001, "12 34", "en", "s", 5), (100_002, "", None, None, 0)], docs.schema)
    docs = staged(docs.unionByName(extra), "test_pipeline")
    columns = docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        results.append((name, docs, stage(spark, docs, SF)))
        docs = staged(results[-1][2], "test_pipeline")
        if name != "sharding":
            assert docs.columns == columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    _, before, after = results[0]
    model = language_id.fit(before.where(~language_id.held_out()))
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(before, model).collect()}
    assert ids(after) == sorted(d for d, (lang, score) in told.items() if lang != "und" and score >= 0.5)
    assert not {100_000, 100_001, 100_002} & set(ids(after)) and len(ids(after)) >= 0.98 * len(told)

    _, before, after = results[1]
    found = jaccard_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted({c for _, c in found.values()})

    _, before, after = results[2]
    bench = [decontamination.normalise(np.frombuffer(r["text"].encode(), np.uint8)).tobytes() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {
        r["doc_id"] for r in before.collect()
        if any(b in decontamination.normalise(np.frombuffer(r["text"].encode(), np.uint8)).tobytes() for b in bench)
    }
    assert dirty and ids(after) == sorted(set(ids(before)) - dirty)

    _, before, after = results[3]
    assert ids(after) == sorted(r["doc_id"] for r in mixing.mix(before).collect() for _ in range(r["copies"]))

    _, before, after = results[4]
    rows = after.collect()
    assert sorted(r["doc_id"] for r in rows) == ids(before) and {r["shard"] for r in rows} <= set(range(40))


def test_empty_documents(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    body = " ".join(words(rng, 60))
    rows = [(1, body, "en", "s", 1, "x"), (1, body, "en", "s", 1, "x"), (None, body, None, None, None, None), (2, body + " end", "en", "s", 1, "x"),
            (3, " ".join(words(rng, 30_000)), "en", "s", 1, "x"), (4, None, "fr", None, 0, None), (5, " ".join(words(rng, 50)), "fr", "s", 1, "x")]
    spark.createDataFrame(rows, SCHEMA + ", shard string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, " ".join(words(rng, 20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} <= {1, 3, 5, None}
