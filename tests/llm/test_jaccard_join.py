from __future__ import annotations

import random

import numpy as np
import pytest

from tallyflow.llm import components, jaccard_join, textarrays
from tests.llm.helpers import documents, jaccard_components, shingles, words

import pyarrow as pa


def corpus(seed: int, groups: int, size: int, passage: bool = True) -> list[str | None]:
    """Groups of near copies with sims around the threshold, exact copies,
    a shared passage, short texts."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    shared = words(rng, 40)
    for _ in range(groups):
        base = words(rng, rng.randint(30, 90))
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["neu", "alt", "zwei"])
            if passage and rng.random() < 0.3:
                w = shared + w[: rng.randint(1, 12)]
            texts.append(" ".join(w))
    texts += rng.choices(texts, k=len(texts) // 3)
    texts += ["", None, "   ", "one", "One", "one two three", "a b c d e", "A  B\nc d e", "a b c d e f", "x " * 30_000, "x " * 29_999]
    rng.shuffle(texts)
    return texts


def run(spark, texts):
    return {r[0]: (r[1], r[2]) for r in jaccard_join.jaccard_components(documents(spark, texts).repartition(5)).collect()}


def test_equals_brute_force(spark):
    texts = corpus(1, 12, 9)
    assert run(spark, texts) == jaccard_components(list(enumerate(texts)))


def test_large_clusters_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 6)  # many blocks, and leftovers
    texts = corpus(2, 3, 60)
    assert run(spark, texts) == jaccard_components(list(enumerate(texts)))


def test_frequent_shingles_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 1 << 20)  # every class counts as frequent
    texts = corpus(3, 4, 20)
    assert run(spark, texts) == jaccard_components(list(enumerate(texts)))


@pytest.mark.parametrize("often", [0, 3, 1 << 19])
def test_frequent_shingles_come_last(spark, monkeypatch, often):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)  # most pairs share some shingles that are not counted
    monkeypatch.setattr(jaccard_join, "OFTEN", often)
    texts = corpus(4, 8, 10)
    assert run(spark, texts) == jaccard_components(list(enumerate(texts)))


def test_a_common_passage_and_copies_make_no_clusters(spark, monkeypatch):
    """What many unlike texts share, and copies dealt over tasks, must not
    bring texts together: the rows and texts that meet grow with the near
    copies, not with the square of a passage's texts."""
    monkeypatch.setattr(jaccard_join, "SKETCH_BITS", 4)  # classes as full as those of a large input
    monkeypatch.setattr(jaccard_join, "SKETCH", 1 << 4)
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 1)  # none of them is split
    rng = random.Random(6)
    passage = words(rng, 20)
    texts = [" ".join([*words(rng, 40), *passage, *words(rng, 40)]) for _ in range(120)]
    texts = [t for t in texts for _ in range(5)]
    rows = {}

    def counted(df, name, staged=jaccard_join.staged):
        out = staged(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "staged", counted)
    df = documents(spark, texts).repartition(8)
    got = {r[0]: r[2] for r in jaccard_join.jaccard_components(df).collect()}
    assert got == {k: k // 5 * 5 for k in range(600)}
    assert rows["jaccard_texts"] == 0 and rows["jaccard_shared"] < 600


def test_edges(spark):
    assert jaccard_join.jaccard_components(documents(spark, [])).collect() == []
    df = spark.createDataFrame(
        [(7, "a b c", "x"), (7, "a b c", "y"), (None, "a b c", "z"), (None, "q", "z"), (3, None, "n")], "doc_id long, text string, component_id string"
    )
    got = sorted((tuple(r) for r in jaccard_join.jaccard_components(df).collect()), key=str)
    assert got == sorted([(7, 1, 7), (7, 1, 7), (None, 1, 7), (None, 1, None), (3, 0, 3)], key=str)
    kept = jaccard_join.one_per_component(df)
    assert kept.columns == df.columns and kept.count() == 5


def test_shingle_sets_of_cut_and_whole_texts():
    rng = random.Random(5)
    long = " ".join(words(rng, 400_000))
    texts = [long, "", "a b", "A\tb", None, "c"]
    data, offsets = textarrays.texts(pa.array(texts))
    sets = [s for *_, b, at in textarrays.slices(data, offsets) for s in textarrays.shingle_sets(b, at)]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert np.array_equal(sets[2], sets[3])
    words_of, _ = textarrays._hashes(np.frombuffer(long.encode(), np.uint8), np.array([0, len(long)]))
    assert np.array_equal(textarrays.word_hashes(np.frombuffer(long.encode(), np.uint8), np.array([0, len(long)]))[0], words_of)


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 400
    edges = [(k, k + 1) for k in range(0, 150)] + [(rng.randrange(200, n), rng.randrange(200, n)) for _ in range(120)]
    edges += [(180, k) for k in range(160, 200) if k != 180]
    edges = [(a, b) for a, b in edges if a != b]
    rng.shuffle(edges)
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges for x in e}
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {r[0]: r[1] for r in components.components(df).collect()} == want
    node, root = components.roots(*(np.array(x) for x in zip(*edges, strict=True)))
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == want


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
