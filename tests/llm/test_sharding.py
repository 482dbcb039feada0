from __future__ import annotations

import random
import zlib
from collections import defaultdict

from tallyflow.llm import sharding
from tests.llm.helpers import documents, words


def check(rows, texts, shards):
    """rows: (doc_id, size, crc, shard, slot)."""
    assert len(rows) == len(texts)
    slots, where, load = defaultdict(list), defaultdict(set), [0] * shards
    for d, size, crc, shard, slot in rows:
        t = texts[d]
        assert size == len((t or "").encode()) + 16 and crc == zlib.crc32((t or "").encode())
        slots[shard].append(slot)
        where[t].add(shard)
        load[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    return load


def some_texts(n=400):
    rng = random.Random(11)
    base = [" ".join(words(rng, rng.randint(0, 60))) for _ in range(n // 2)]
    return [rng.choice(base) for _ in range(n)] + [None, None, "", "é" * 50]


def lpt(texts, shards):
    size = defaultdict(int)
    for t in texts:
        size[t] += len((t or "").encode()) + 16
    load = [0] * shards
    for s in sorted(size.values(), reverse=True):
        load[load.index(min(load))] += s
    return sorted(load)


def test_loads_are_those_of_the_plain_schedule(spark):
    texts = some_texts()
    rows = [tuple(r) for r in sharding.shard_documents(documents(spark, texts), shards=5, bins=1 << 16).collect()]
    # So many bins that no two groups share one: the loads are LPT's own.
    assert sorted(check(rows, texts, 5)) == lpt(texts, 5)


def test_few_bins_keep_groups_together_and_sizes_near(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 8)  # several blocks a shard
    texts = some_texts(1500)
    rows = [tuple(r) for r in sharding.shard_documents(documents(spark, texts), shards=5, bins=40).collect()]
    load = check(rows, texts, 5)
    assert max(load) - min(load) <= 0.05 * sum(load) / 5


def test_longest_first_ties_are_settled():
    assert sharding.longest_first([(3, "a"), (3, "b"), (5, "c"), (1, "d")], 2) == {"c": 0, "a": 1, "b": 1, "d": 0}


def test_query_and_edges(spark):
    out = sharding.op4_sharding(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = out.collect()
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (None, None, 0)], "doc_id long, text string, shard int")
    got = sharding.shard_documents(df, shards=2).collect()
    assert sorted(r["slot"] for r in got if r["text_crc32"]) == [0, 1] and len(got) == 3
