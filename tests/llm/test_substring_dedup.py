from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from tallyflow.llm import substring_dedup as sub
from tests.llm.helpers import documents, words


def brute(text_list, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in text_list]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1, 4096])
def test_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sub, "HOT", hot)  # 1: nearly every anchor is dealt to salts
    rng = random.Random(11)
    passage = words(rng, 60)
    texts = []
    for k in range(40):
        w = words(rng, rng.randint(0, 80))
        if k % 2:
            a = rng.randint(0, 20)
            w += passage[a : a + rng.randint(30, 40)] + words(rng, rng.randint(0, 20))
        texts.append(" ".join(w))
    texts += [None, "", " \t", "one", texts[0], texts[0], "a " * 90, " ".join(passage + words(rng, 3) + passage)]
    texts += [" ".join(words(rng, 300_000) + passage), "Café\n" + " ".join(passage).upper()]
    df = documents(spark, texts).selectExpr("*", "1 as row", "2 as id", "'x' as places").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sub.without_repeats(df).collect()}
    assert got == dict(enumerate(brute(texts, sub.WINDOW)))


def test_empty_table_and_equal_ids(spark):
    assert sub.without_repeats(documents(spark, [])).count() == 0
    text = " ".join(words(random.Random(1), 50))
    twice = documents(spark, [text]).union(documents(spark, [text])).selectExpr("cast(null as long) as doc_id", "text")
    assert [r["n_removed"] for r in sub.without_repeats(twice).collect()] == [50, 50]
