from __future__ import annotations

import numpy as np
import pytest

from tallyflow.llm import language_id
from tests.llm.helpers import SCHEMA


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = language_id.op9_language_id(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    got = got.merge(docs, on="doc_id")
    held = got[got.held_out]
    assert len(got) == len(docs) and len(held) > 150
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    model = language_id.fit(docs.where(~language_id.held_out()))
    changed = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    again = language_id.fit(changed.where(~language_id.held_out()))
    assert model[0] == again[0] and np.array_equal(model[2], again[2])


def test_pieces_have_the_n_grams_of_the_whole_text():
    text = np.frombuffer(("Aé" * 3000 + "ß漢x" * 500).encode(), np.uint8)
    whole = np.sort(np.concatenate([g for g, _ in language_id._pieces(text, 1 << 30)]))
    cut = np.sort(np.concatenate([g for g, _ in language_id._pieces(text, 101)]))
    assert np.array_equal(whole, cut) and len(whole) == 3 * len(text.tobytes().decode()) - 3


def test_scores_equal_a_plain_computation(spark):
    rows = [(k, t, lang, "s", 0) for k, (t, lang) in enumerate([("aa ab", "x"), ("ba bb", "y"), ("aab", "x"), ("bba b", "y")])]
    languages, prior, table = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    assert languages == ["x", "y"]
    text = "AAB b"
    logs = prior.copy()
    for n in (1, 2, 3):
        for k in range(len(text) - n + 1):
            cp = np.array([ord(c) for c in text.lower()[k : k + n]], np.uint32)
            logs = logs + table[language_id._grams(cp)[-1]]
    got = language_id.predict(spark.createDataFrame([(9, text)], "doc_id long, text string"), (languages, prior, table)).first()
    p = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    assert got["lang_pred"] == languages[int(np.argmax(p))] and got["score"] == pytest.approx(p.max())


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.predict(empty, language_id.fit(empty)).collect() == []
    rows = [(1, "the cat", "en", "s", 0), (2, None, "en", "s", 0), (3, "123 !?", None, "s", 0), (None, "", "fr", "s", 0), (4, "漢字", "zh", "s", 0), (1, "the cat", "en", "s", 0)]
    df = spark.createDataFrame([(*r, "q") for r in rows], SCHEMA + ", lang_pred string")
    out = language_id.predict(df, language_id.fit(df)).collect()
    assert len(out) == 6
    assert sorted(r["lang_pred"] for r in out) == ["en", "en", "und", "und", "und", "zh"]
    assert all(r["score"] == 0 for r in out if r["lang_pred"] == "und")
    nothing = language_id.predict(df, language_id.fit(empty)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert sorted(r["doc_id"] for r in language_id.accepted(df.where("text like 'the%' or text like '1%'")).collect()) == [1, 1]
