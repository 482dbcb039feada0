from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyflow.llm import mixing
from tests.llm.helpers import SCHEMA, words


def corpus(spark, n=1500):
    rng = random.Random(2)
    rows = []
    for k in range(n):
        text = " ".join(words(rng, rng.randint(1, 40)))
        text += rng.choice(["", "", "", " a | b", " MIT License", " x@y.org"])
        source = "big" if k % 3 == 0 else f"s{rng.randint(0, 4)}"
        rows.append((k, text, rng.choice(["en", "en", "fr", None]), source, len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def test_raked_tokens_meet_the_three_targets(spark):
    rows = mixing.described(corpus(spark))
    cells = rows.groupBy("cell", "source", "lang", "topic").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    got = cells.join(mixing.rake(cells, rounds=30), "cell").toPandas()
    total = got.tokens.sum()
    got["w"] = got.tokens * got.ratio
    for name in ("source", "lang"):
        have = got.groupby(name).tokens.sum() ** mixing.TEMPER
        want = have / have.sum() * total
        assert got.groupby(name).w.sum().to_dict() == pytest.approx(want.to_dict(), rel=1e-3)
    assert got.groupby("topic").w.sum().to_dict() == pytest.approx(
        {k: v * total for k, v in mixing.TOPIC_WEIGHTS.items()}, rel=1e-3
    )


def test_draws_follow_the_probabilities_and_repeat(spark):
    docs = corpus(spark)
    out = mixing.mix(docs).toPandas()
    assert len(out) == docs.count() and out.probability.between(0, 1).all()
    assert abs(out.kept.mean() - out.probability.mean()) < 0.05
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert dict(zip(out.doc_id, out.kept, strict=True)) == dict(zip(again.doc_id, again.kept, strict=True))
    kept = {r["doc_id"] for r in mixing.mixed(docs).collect()}
    assert kept == set(out.doc_id[out.kept])


def test_tokens_of_the_copies_meet_the_targets(spark):
    docs = corpus(spark)
    topics = {"prose": 0.3, "tabular": 0.1, "legal": 0.5, "contact": 0.1}
    out = mixing.mix(docs, topics=topics).toPandas()
    assert out.copies.max() > 1 and (out.kept == (out.copies > 0)).all()
    total = out.tokens.sum()
    out["taken"] = out.tokens * out.copies
    assert out.taken.sum() / total == pytest.approx(mixing.RATE, abs=0.03)
    share = lambda name: (out.groupby(name).taken.sum() / out.taken.sum()).to_dict()
    assert share("topic") == pytest.approx(topics, abs=0.03)
    for name in ("source", "lang"):
        want = out.groupby(name).tokens.sum() ** mixing.TEMPER
        assert share(name) == pytest.approx((want / want.sum()).to_dict(), abs=0.03)
    rows = Counter(r["doc_id"] for r in mixing.repeated(docs, topics=topics).collect())
    assert rows == Counter({d: c for d, c in zip(out.doc_id, out.copies, strict=True) if c})


def test_repeated_edges(spark):
    assert mixing.repeated(spark.createDataFrame([], SCHEMA)).collect() == []
    # Equal ids of different cells have their own copies each.
    rows = [(None, "a | b", None, None, 5), (1, "word " * 900, "en", "s", 4), (1, "MIT License", "en", "s", 5)]
    odd = spark.createDataFrame(rows, SCHEMA)
    want = Counter()
    for r in mixing.mix(odd).collect():
        want[r["doc_id"], r["tokens"]] += r["copies"]
    got = Counter((r["doc_id"], len(r["text"].split())) for r in mixing.repeated(odd).collect())
    assert got == +want and max(got.values()) > 1


def test_clashing_names(spark):
    names = ["_mixed_id", "_mixed_cell", "_mixed_copies", "_mixed_copy", "copies"]
    odd = corpus(spark, 60)
    for name in names:
        odd = odd.withColumn(name, F.lit("own"))
    for out in (mixing.mixed(odd), mixing.repeated(odd)):
        rows = out.collect()
        assert out.columns == odd.columns and rows
        assert {r[name] for r in rows for name in names} == {"own"}


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []
    odd = spark.createDataFrame(
        [(1, None, None, None, 3, "x"), (1, None, None, None, 3, "x"), (None, "", "en", "s", 0, "y"), (2, "word", "en", "s", 4, "z")],
        SCHEMA + ", topic string",
    )
    out = mixing.mix(odd).collect()
    assert len(out) == 4 and {r["tokens"] for r in out} == {0, 1}
    assert mixing.mixed(odd).columns == odd.columns


def test_no_python_on_the_executors(spark):
    plan = mixing.op8_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
