from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyflow.llm import common, exact_dedup
from tests.llm.helpers import documents, words


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    return sorted(
        (d, min(g), len(g), d == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g
    )


def run(df, **kw):
    out = exact_dedup.exact_dedup(df, **kw)
    return sorted(tuple(r) for r in out.withColumn("digest", F.lower(F.hex("digest"))).collect())


def some_texts():
    rng = random.Random(3)
    base = [" ".join(words(rng, rng.randint(0, 30))) for _ in range(40)]
    texts = [rng.choice(base) for _ in range(200)] + ["hot text"] * 150 + ["", "  ", "\t", "é\x0b\x0cé", "é é", "x " * 50_000]
    return [t.replace(" ", rng.choice([" ", "  ", "\n", " \t\r\n"]), 1) for t in texts] + [None, None]


def test_equals_brute_force(spark):
    texts = some_texts()
    df = documents(spark, texts).repartition(7)
    assert run(df) == brute(list(enumerate(texts)))


def test_hot_groups_and_many_salts_agree(spark, monkeypatch):
    texts = some_texts()
    monkeypatch.setattr(common, "HOT_SHARE", 3)  # the group of 150 is hot, the others are not
    assert run(documents(spark, texts).repartition(9), salts=3) == brute(list(enumerate(texts)))


def test_texts_with_equal_digests_are_compared_whole(spark):
    texts = some_texts()
    weak = lambda body: F.length(body) % 3
    got = exact_dedup.exact_dedup(documents(spark, texts), digest=weak).drop("digest").collect()
    assert sorted(tuple(r) for r in got) == [r[:4] for r in brute(list(enumerate(texts)))]


def test_empty_null_ids_repeated_rows_and_clashing_names(spark):
    assert run(documents(spark, [])) == []
    df = spark.createDataFrame(
        [(5, "a", "x"), (5, "a", "y"), (None, "a", "z"), (None, "b", "z"), (None, "b", "q")], "doc_id long, text string, keep_id string"
    ).withColumns({c: F.lit(1) for c in ("digest", "salt", "body", "n", "id", "kept", "group_size")})
    got = sorted((tuple(r)[:4] for r in exact_dedup.exact_dedup(df).collect()), key=str)
    assert got == sorted([(5, 5, 3, True), (5, 5, 3, True), (None, 5, 3, False), (None, None, 2, True), (None, None, 2, True)], key=str)


def test_no_python_on_the_executors(spark):
    plan = exact_dedup.op1_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
