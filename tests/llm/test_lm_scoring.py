from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from tallyflow.llm import lm_scoring
from tests.llm.helpers import documents, split, words


def brute(texts, min_count, bits):
    docs = [split(t) for t in texts]
    n = Counter(w for d in docs for w in d)
    total = sum(n.values())
    known = {w for w, c in n.items() if c * 2**bits >= total}
    docs = [[w if w in known else None for w in d] for d in docs]
    one = Counter(w for d in docs for w in d)
    two = Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    out = []
    for d in docs:
        s = math.log(one[d[0]] / total) if d else 0.0
        for v, w in zip(d, d[1:], strict=False):
            c = two[v, w]
            s += math.log(c / one[v]) if c >= min_count else math.log(0.4 * one[w] / total)
        out.append((len(d), s / len(d) if d else None))
    return out


def texts():
    rng = random.Random(4)
    some = [" ".join(words(rng, rng.randint(0, 50))) for _ in range(150)]
    return some + some[:20] + ["", None, "  ", "Ta TA ta", "ta " * 5000]


@pytest.mark.parametrize(("bits", "head", "min_count"), [(20, 1024, 2), (6, 1024, 2), (6, 3, 1), (20, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, bits, head, min_count):
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    t = texts()
    got = lm_scoring.lm_scores(documents(spark, t).repartition(4), min_count=min_count, bits=bits).collect()
    want = brute(t, min_count, bits)
    assert len(got) == len(t)
    for r in got:
        n, score = want[r["doc_id"]]
        assert r["n_words"] == n and r["score"] == (None if score is None else pytest.approx(score, abs=1e-9))


def test_edges(spark):
    assert lm_scoring.lm_scores(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (None, "a", 5), (2, None, 5)], "doc_id long, text string, row int")
    got = sorted((tuple(r)[:2] for r in lm_scoring.lm_scores(df).collect()), key=str)
    assert got == sorted([(1, 2), (1, 2), (None, 1), (2, 0)], key=str)
    none = lm_scoring.lm_scores(documents(spark, [None, ""])).collect()
    assert [(r["n_words"], r["score"]) for r in none] == [(0, None), (0, None)]


def scores_equal(spark, t, bits=60, **params):
    got = lm_scoring.lm_scores(documents(spark, t).repartition(4), **params).collect()
    want = brute(t, params.get("min_count", lm_scoring.MIN_COUNT), bits)
    assert len(got) == len(t)
    for r in got:
        n, score = want[r["doc_id"]]
        assert r["n_words"] == n and r["score"] == (None if score is None else pytest.approx(score, abs=1e-9))


def test_rare_words_of_a_large_corpus_count_as_themselves(spark):
    # More than 2**20 words, so that a single one is under one in 2**20.
    scores_equal(spark, ["ta " * 1_100_000, "rare pair", "rare pair", "ta once", "odd", "lone word pair ta", "word ta left"])


@pytest.mark.parametrize(("vocabulary_bits", "head", "min_count"), [(0, 1024, 2), (4, 1024, 2), (6, 3, 1), (8, 2, 3)])
def test_words_without_a_number_equal_brute_force(spark, monkeypatch, vocabulary_bits, head, min_count):
    monkeypatch.setattr(lm_scoring, "VOCABULARY_BITS", vocabulary_bits)
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    scores_equal(spark, texts(), min_count=min_count)
