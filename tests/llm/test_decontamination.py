from __future__ import annotations

import random
import tracemalloc

import numpy as np

from tallyflow.llm import decontamination as dec
from tests.llm.helpers import documents, words


def distance(p: bytes, t: bytes) -> int:
    """Fewest edits between p and any passage of t."""
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        row = [i] + [0] * len(t)
        for j, e in enumerate(t, 1):
            row[j] = min(before[j - 1] + (c != e), before[j] + 1, row[j - 1] + 1)
        before = row
    return min(before)


def array(text: str) -> np.ndarray:
    return dec.normalise(np.frombuffer(text.encode(), np.uint8))


def edited(rng, text: str, n: int) -> str:
    s = list(text)
    for _ in range(n):
        at = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("qxz ")
        elif kind == 1:
            del s[at]
        else:
            s.insert(at, rng.choice("qxz "))
    return "".join(s)


def test_finds_what_brute_force_finds():
    rng = random.Random(8)
    for _ in range(80):
        item = " ".join(words(rng, rng.randint(3, 30)))
        k = dec.budget(len(array(item)))
        text = " ".join(words(rng, 20)) + " " + edited(rng, item, rng.choice([0, 1, k // 2, k, k + 1, 2 * k])) + " " + " ".join(words(rng, 20))
        body = array(text)
        items = dec.Items([0], [item.encode()])
        want = distance(array(item).tobytes(), body.tobytes())
        got = [o[1] for o in dec.occurrences(body, items)]
        assert (min(got) if got else None) == (want if want <= k else None)


def test_places_across_pieces(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(dec, "PIECE", 600)
    item = " ".join(words(rng, 20))
    body = array(" ".join(words(rng, 300)) + " " + item.upper() + "! " + " ".join(words(rng, 300)))
    found = dec.occurrences(body, dec.Items([4], [item.encode()]))
    assert [(i, e) for i, e, _, _ in found] == [(0, 0)]
    _, _, start, end = found[0]
    assert body[start:end].tobytes() == array(item).tobytes()


def test_slices_of_hits_change_nothing(monkeypatch):
    rng = random.Random(12)
    common = " ".join(words(rng, 4))
    bodies = [" ".join([common, *words(rng, 30), common]) for _ in range(4)] + ["ab" * 20, "a" * 24]
    items = dec.Items(list(range(len(bodies))), [b.encode() for b in bodies])
    docs = [array(" ".join([common] * 6 + [edited(rng, b, 1)] + [common] * 6)) for b in bodies]
    docs += [array("ab" * 30 + " " + "a" * 40), array("xyz")]
    whole = [dec.occurrences(d, items) for d in docs]
    assert all(whole[: len(bodies)])
    for most in (50, 400):
        monkeypatch.setattr(dec, "HITS", most)
        assert [dec.occurrences(d, items) for d in docs] == whole


def test_memory_does_not_follow_the_shared_places():
    rng = random.Random(13)
    common = " ".join(words(rng, 4))
    bodies = [" ".join([*words(rng, 6), common, *words(rng, 6)]) for _ in range(2500)]
    items = dec.Items(list(range(len(bodies))), [b.encode() for b in bodies])
    doc = array(" ".join([common] * 400))
    found = items.shared(doc)[1]
    assert (items.end[found] - items.start[found]).sum() > 10 * dec.HITS
    tracemalloc.start()
    dec.occurrences(doc, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_operator_in_blocks_equals_brute_force(spark):
    rng = random.Random(10)
    items = [" ".join(words(rng, rng.randint(12, 30))) for _ in range(12)]
    texts: list[str | None] = []
    for k in range(60):
        body = words(rng, 40)
        if k % 3 == 0:
            body.insert(rng.randrange(40), edited(rng, rng.choice(items), rng.choice([0, 2, 4])))
        texts.append(" ".join(body))
    texts += [None, "", items[0], items[0].upper().replace(" ", " ,\n")]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "ta ri")], "item_id long, text string")
    got = {(r[0], r[1]): r[2] for r in dec.contaminated(documents(spark, texts), bench, block_bytes=300).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            a = array(item)
            e = distance(a.tobytes(), array(t or "").tobytes())
            if e <= dec.budget(len(a)):
                want[d, i] = e
    assert got == want
    kept = [r["doc_id"] for r in dec.clean(documents(spark, texts), bench).collect()]
    assert sorted(kept) == sorted(set(range(len(texts))) - {d for d, _ in want})


def test_edges(spark):
    bench = spark.createDataFrame([(1, "some benchmark passage of words")], "item_id long, text string")
    assert dec.contaminated(documents(spark, []), bench).collect() == []
    assert dec.contaminated(documents(spark, ["x"]), bench.limit(0)).collect() == []
    df = spark.createDataFrame(
        [(None, "Some benchmark, passage of words", "a"), (2, "Some benchmark, passage of words", "b"), (2, "other", "c")],
        "doc_id long, text string, item_id string",
    )
    assert sorted((tuple(r)[:3] for r in dec.contaminated(df, bench).collect()), key=str) == [(2, 1, 0), (None, 1, 0)]
    assert dec.clean(df, bench).columns == df.columns
    assert [tuple(r) for r in dec.clean(df, bench).collect()] == [(2, "other", "c")]
    own = df.withColumnRenamed("item_id", "_clean_key")
    assert [tuple(r) for r in dec.clean(own, bench).collect()] == [(2, "other", "c")]
    empty = spark.createDataFrame([(1, None), (None, None), (3, "")], "doc_id long, text string")
    assert dec.clean(empty, bench).count() == 3
    assert dec.budget(5) == 0 and dec.budget(8) == 0 and dec.budget(100) == 8
