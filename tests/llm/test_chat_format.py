from __future__ import annotations

import random

from tallyflow.llm import chat_format as chat

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows, schema=SCHEMA):
    out = chat.link_quotes(spark.createDataFrame(rows, schema)).collect()
    return {(r["conv_id"], r["turn"]): r for r in out}, out


def test_parse():
    own, quotes = chat.parse("Hi\nBob wrote:\n> one\n>two\n> > deep\n>> er\n> three\nmine\n")
    assert own == "Hi\nmine"
    assert quotes == [(1, "one\ntwo"), (2, "deep\ner"), (1, "three")]
    assert chat.parse("") == ("", []) and chat.parse("a > b") == ("a > b", [])


def test_links_levels_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort  a list?\n\nAnd how do I filter it by key?"),
        (1, 1, "assistant", "Use sorted for that."),
        (1, 2, "user", "> use SORTED for\n> that.\nThanks, and this?\n\n> and how do I filter it by key?"),
        (1, 3, "assistant", "With a comprehension."),
        (1, 4, "user", "> nobody ever wrote this line here\nnew topic"),
        (1, 5, "assistant", "> > How do I sort a list?\n> something else entirely unknown here\nStill the first."),
        (2, 0, "user", "Use sorted for that."),
        (2, 1, "user", "> How do I sort a list?\nother conversation"),
    ]
    got, out = run(spark, rows)
    facts = {k: (r["n_quotes"], r["n_linked"], r["reply_to"], r["thread"]) for k, r in got.items()}
    assert facts == {
        (1, 0): (0, 0, None, 0), (1, 1): (0, 0, 0, 0), (1, 2): (2, 2, 1, 0), (1, 3): (0, 0, 2, 0),
        (1, 4): (1, 0, None, 4), (1, 5): (2, 1, 0, 0), (2, 0): (0, 0, None, 0), (2, 1): (1, 0, None, 1),
    }
    order = [r["turn"] for r in sorted(out, key=lambda r: (r["conv_id"], r["position"])) if r["conv_id"] == 1]
    assert order == [0, 1, 2, 3, 5, 4]
    assert got[1, 2]["text"] == "Thanks, and this?" and ">" not in "".join(r["text"] for r in out)


def test_quotes_of_short_lines_link(spark):
    rows = [
        (1, 0, "user", "Hello all\nWhen?\nAgreed, let's ship\nbye"),
        (1, 1, "assistant", "At noon, I would say."),
        (1, 2, "user", "> WHEN?\nStill open."),
        (1, 3, "assistant", "This line has enough words\nThanks"),
        (1, 4, "user", "> hello all\n> agreed, let's ship\nFine."),
        (1, 5, "assistant", "Thanks\nAnything else?"),
        (1, 6, "user", "> this line has enough words\n> thanks\n> and more\nThe longer line tells."),
        (1, 7, "user", "> never said\nnew topic"),
    ]
    got, _ = run(spark, rows)
    facts = {t: (r["n_linked"], r["reply_to"], r["thread"], r["position"]) for (_, t), r in got.items()}
    assert facts == {
        0: (0, None, 0, 0), 1: (0, 0, 0, 1), 2: (1, 0, 0, 2), 3: (0, 2, 0, 3),
        4: (1, 0, 0, 4), 5: (0, 4, 0, 5), 6: (1, 3, 0, 6), 7: (0, None, 7, 7),
    }


def brute(rows):
    """Replies by looking through all earlier messages."""
    out = {}
    for c, t, _, text in rows:
        earlier = [(u, x) for d, u, _, x in rows if d == c and u < t]
        _, quotes = chat.parse(text or "")
        linked = []
        for level, q in quotes:
            hits = [(g, -u) for u, x in earlier for g, key in chat.keys(q) if key in {k for _, k in chat.keys(chat.parse(x or "")[0])}]
            if hits:
                linked.append((level, *min(hits)))
        previous = max((u for u, _ in earlier), default=None)
        out[c, t] = (len(linked), -min(linked)[2] if linked else None) if quotes else (0, previous)
    return out


def test_equals_brute_force_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 5)
    rng = random.Random(7)
    lines = [f"line number {k} of the talk" for k in range(12)]
    rows = []
    for c in range(4):
        for t in range(60):
            body = [rng.choice(lines) for _ in range(rng.randint(1, 3))]
            if rng.random() < 0.4:
                body = [f"{'> ' * rng.randint(1, 2)}{rng.choice(lines)}" for _ in range(rng.randint(1, 2))] + body
            rows.append((c, t * 3, "user", "\n".join(body)))
    got, out = run(spark, rows)
    want = brute(rows)
    assert {k: (r["n_linked"], r["reply_to"]) for k, r in got.items()} == want

    def root(key):
        while want[key][1] is not None:
            key = (key[0], want[key][1])
        return key[1]

    assert all(r["thread"] == root((r["conv_id"], r["turn"])) for r in out)
    for c in range(4):
        placed = sorted((r for r in out if r["conv_id"] == c), key=lambda r: r["position"])
        assert [r["position"] for r in placed] == list(range(60))
        assert [(r["thread"], r["turn"]) for r in placed] == sorted((r["thread"], r["turn"]) for r in placed)


def test_edges(spark):
    assert run(spark, [])[1] == []
    rows = [(None, 0, None, "hello there my friend", 1), (None, 1, "a", "> hello there my friend\nyes", 1), (5, None, "b", None, 1), (5, 0, "b", "x", 1), (5, 0, "b", "x", 1)]
    got, out = run(spark, rows, SCHEMA + ", position int")
    assert len(out) == 5 and got[None, 1]["reply_to"] == 0 and got[None, 1]["thread"] == 0
    assert sorted(r["position"] for r in out if r["conv_id"] == 5) == [0, 1, 2]
    assert got[5, None]["reply_to"] is None


def test_query_keeps_every_message(spark):
    sf = "/root/testdata/sf0.001"
    out = chat.op2_chat_format(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/conversations.parquet").count()
