from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tallyflow.llm import collocations as col
from tests.llm.helpers import SCHEMA, documents, lower


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        rows = []
        for p, a in cands.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("share", [1, 4096])
def test_matches_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(col, "HOT_SHARE", share * 2)  # few: hardly a hot prefix; many: all are cut into blocks
    rng = random.Random(2)
    some = ["The", "of", "in", "new", "York", "é", "zu", "x-y", "9", "tab\tbed"]
    text = lambda: "".join(rng.choice(some) + rng.choice([" ", " ", " ", " ", "  ", ", ", ".\n", "\r"]) for _ in range(rng.randint(0, 60)))
    rows = [(k, text(), rng.choice(["en", "de", None, "und"]), "s", 0) for k in range(80)]
    rows += [(90, None, "en", "s", 0), (91, "", "fr", "s", 0), (92, "new york city " * 40_000, "en", "s", 0), rows[0], rows[0]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as phrase", "2 as a", "3 as xs").repartition(4)
    got = sorted(tuple(r) for r in col.collocations(df, min_count=5, top=25).collect())
    assert got == brute([(r[2], r[1]) for r in rows], 5, 25)


def test_empty_table(spark):
    assert col.collocations(documents(spark, [])).count() == 0


def test_pages_that_go_on_over_many_rows_and_batches(spark, monkeypatch):
    monkeypatch.setattr(col, "_HOLD", 64)
    monkeypatch.setattr(col, "HOT_SHARE", 20)
    monkeypatch.setattr(col, "PAGES", 2)
    monkeypatch.setattr(col, "PAGE_PLACES", 1 << 12)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rng = random.Random(5)
    text = lambda: " ".join(f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randint(0, 90)))
    rows = [(k, text(), rng.choice(["en", None]), "s", 0) for k in range(300)]
    try:
        got = sorted(tuple(r) for r in col.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count=4, top=400).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute([(r[2], r[1]) for r in rows], 4, 400)


def test_rows_handed_on_grow_as_the_words_do(monkeypatch):
    monkeypatch.setattr(col, "_HOLD", 1 << 13)
    sent = SimpleNamespace(value=(np.full(1 << 24, 255, np.uint8), np.zeros(0, np.uint64)))

    def made(docs, vocabulary):
        rng = random.Random(docs)
        texts = [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(500)) for _ in range(docs)]
        batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 10), pa.array(texts[k : k + 10])], ["lang", "text"]) for k in range(0, docs, 10)]
        out = list(col._stripes(sent, 2)(iter(batches)))
        assert sum(np.sum(b["counts"].flatten().to_numpy()) for b in out) == docs * 499
        return sum(b.num_rows for b in out)

    # five times the words, and with them more different words, as in any text
    assert made(1000, 30_000) <= 6 * made(200, 6000)
