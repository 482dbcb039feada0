"""Operator 2, chat formatting by quotation linking.

1. Parse: lines that begin with ``>`` marks are quoted, at the level of their
   number of marks (``> >`` and ``>>`` are level 2). Consecutive lines of one
   level are a passage; an attribution line ("... wrote:") before a quote is
   dropped with it. What is left is the message's own text.
2. Hash: a passage is hashed whole, per paragraph and per line after
   normalisation: A-Z lower-cased, white space collapsed. Messages' own texts
   are hashed the same way.
3. Link: a quoted passage belongs to the latest earlier message of its
   conversation that has one of its hashes, whole passages before paragraphs
   before lines of at least LINE_WORDS words before shorter ones. This is an as-of match (per hash, the last original before
   the quote), not a join of all pairs that share a hash.
4. Order: a message replies to the message that its lowest linked quote level
   belongs to; a message without quotes replies to the one before it; a
   message whose quotes link with nothing starts a thread, as the first one
   does. Threads are ordered by their first turn, and a thread's messages by
   turn, so every message comes after the one it answers. ``position`` is the
   place in that order.

Windows run per block of BLOCK turns with the blocks' ends carried by a table
of one row per block, so a conversation that holds a third of all messages,
or a line that all of them quote, is many tasks' work.

Defined cases: a null text is empty; a null conversation id is a conversation
of its own; messages with a null turn come first, answer nothing, and cannot
be quoted; messages of equal turn do not answer each other; repeated rows are
messages each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches, staged

LINE_WORDS = 4
#: Turns per window block.
BLOCK = 4096
WHOLE, PARAGRAPH, LINE, SHORT = range(4)

_MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
#: How an attribution line ends.
_WROTE = re.compile(r"(wrote|schrieb|a écrit|escribió)[ \t]*:[ \t]*$")


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, quoted passages as (level, text))."""
    own: list[str] = []
    quotes: list[tuple[int, list[str]]] = []
    last = 0
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks[1].count(">") if marks else 0
        if not level:
            own.append(line)
        else:
            if not last and own and _WROTE.search(own[-1]):
                own.pop()
            if level == last:
                quotes[-1][1].append(line[marks.end() :])
            else:
                quotes.append((level, [line[marks.end() :]]))
        last = level
    return "\n".join(own).strip(), [(level, "\n".join(lines)) for level, lines in quotes]


def normal(text: str) -> str:
    return " ".join(re.sub("[A-Z]+", lambda m: m[0].lower(), text).split())


def keys(text: str) -> list[tuple[int, int]]:
    """(grain, hash) of a passage: whole, its paragraphs, its lines."""
    found: dict[str, int] = {}
    for grain, parts in ((WHOLE, [text]), (PARAGRAPH, re.split(r"\n[ \t]*\n", text)), (LINE, text.split("\n"))):
        for part in map(normal, parts):
            if part:
                found.setdefault(part, SHORT if grain == LINE and part.count(" ") + 1 < LINE_WORDS else grain)
    return [(grain, int.from_bytes(hashlib.blake2b(part.encode(), digest_size=8).digest(), "big", signed=True)) for part, grain in found.items()]


_PARSED = "row long, conv_id long, turn long, role string, text string, quotes int, own array<long>, quoted array<struct<passage:int,level:int,grain:int,key:long>>"
_QUOTED = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("grain", pa.int32()), ("key", pa.int64())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, count, own, quoted = [], [], [], []
        for t in batch.column(4):
            body, quotes = parse(t.as_py() or "")
            text.append(body)
            count.append(len(quotes))
            own.append(sorted({key for _, key in keys(body)}))
            quoted.append(
                [{"passage": p, "level": level, "grain": grain, "key": key} for p, (level, q) in enumerate(quotes) for grain, key in keys(q)]
            )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(4)), pa.array(text, pa.string()), pa.array(count, pa.int32()), pa.array(own, pa.list_(pa.int64())), pa.array(quoted, _QUOTED)],
            ["row", "conv_id", "turn", "role", "text", "quotes", "own", "quoted"],
        )


def _last_before(df: DataFrame, by: list[str], value: Column, name: str, own: bool = False) -> DataFrame:
    """``df`` with ``name``: the largest ``value`` (null where a row has none;
    it grows with the turn) of the rows of the group ``by`` with a smaller
    turn (or an equal one, with ``own``). Blocks of turns are separate tasks;
    what precedes a block comes from a table with one row per block."""
    df = df.withColumn("_block", F.floor(F.col("turn") / BLOCK)).withColumn("_value", value)
    near = Window.partitionBy(*by, "_block").orderBy("turn").rangeBetween(Window.unboundedPreceding, 0 if own else -1)
    ends = df.groupBy(*by, "_block").agg(F.max("_value").alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_far", F.max("_end").over(earlier)).where("_far is not null").drop("_end")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, "_block")]
    joined = df.withColumn("_near", F.max("_value").over(near)).alias("l").join(carried.alias("r"), on, "left")
    kept = [F.col(f"l.{c}") for c in df.columns if c not in ("_block", "_value")]
    return joined.select(*kept, F.coalesce(F.col("l._near"), F.col("r._far")).alias(name))


def _links(parsed: DataFrame) -> DataFrame:
    """(row, passage, level, grain, answers): the message each passage of
    each row belongs to, by the passage's best grain."""
    timed = parsed.where("turn is not null")
    quoted = timed.where("quotes > 0").select("row", "conv_id", "turn", F.explode("quoted").alias("q")).select("row", "conv_id", "turn", "q.*")
    originals = timed.select("conv_id", "turn", F.explode("own").alias("key")).distinct()
    # Only hashes that some quote has; each is one row per conversation.
    asked = quoted.select("conv_id", "key").distinct().alias("a")
    originals = originals.alias("o").join(
        asked, F.col("o.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("o.key") == F.col("a.key")), "left_semi"
    )
    none = F.lit(None)
    events = quoted.withColumn("original", none.cast("long")).unionByName(
        originals.select(
            none.cast("long").alias("row"), "conv_id", "turn", none.cast("int").alias("passage"), none.cast("int").alias("level"),
            none.cast("int").alias("grain"), "key", F.col("turn").alias("original"),
        )
    )
    asof = _last_before(events, ["conv_id", "key"], F.col("original"), "answers").where("row is not null and answers is not null")
    best = F.struct("grain", -F.col("answers"))
    return asof.groupBy("row", "passage", "level").agg(F.min_by("answers", best).alias("answers"), F.min("grain").alias("grain"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message (conv_id, turn, role, text): conv_id, turn, role,
    text (without quotes), n_quotes, n_linked, reply_to, thread, position."""
    base = bounded_batches(messages).select(
        F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    parsed = staged(base.mapInArrow(_parse, _PARSED), "chat_parsed")
    per_row = (
        _links(parsed)
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("linked"), F.min_by("answers", F.struct("level", "grain", -F.col("answers"))).alias("answers"))
    )
    known = parsed.select("row", "conv_id", "turn", "quotes").join(per_row, "row", "left")
    known = _last_before(known, ["conv_id"], F.col("turn"), "previous")
    # A message with quotes begins a segment, and so does a first one; the
    # others belong to the segment of the message before them.
    begins = F.when((F.col("quotes") > 0) | F.col("previous").isNull(), F.col("turn"))
    known = staged(_last_before(known, ["conv_id"], begins, "segment", own=True), "chat_known")
    # The segment of the message that a segment's first message answers.
    heads = known.where("answers is not null").groupBy("conv_id", F.col("turn").alias("segment")).agg(F.max("answers").alias("turn")).alias("h")
    places = known.select("conv_id", "turn", F.col("segment").alias("up")).distinct().alias("p")
    up = staged(
        heads.join(places, F.col("h.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("h.turn") == F.col("p.turn")))
        .select(F.col("h.conv_id").alias("conv_id"), "segment", "up"),
        "chat_segments",
    )
    while True:  # each round doubles how far a segment sees; answers point back, so it ends
        a, b = up.alias("a"), up.alias("b")
        further = staged(
            a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.up") == F.col("b.segment")), "left").select(
                F.col("a.conv_id").alias("conv_id"), F.col("a.segment").alias("segment"),
                F.coalesce("b.up", "a.up").alias("up"), F.col("b.up").isNotNull().alias("moved"),
            ),
            "chat_segments",
        )
        up = further.drop("moved")
        if further.where("moved").isEmpty():
            break
    k, u = known.alias("k"), up.alias("u")
    threads = k.join(u, F.col("k.conv_id").eqNullSafe(F.col("u.conv_id")) & (F.col("k.segment") == F.col("u.segment")), "left").select(
        "k.row", "k.conv_id", "k.turn", F.coalesce("linked", F.lit(0)).alias("n_linked"),
        F.when(F.col("quotes") > 0, F.col("answers")).otherwise(F.col("previous")).alias("reply_to"),
        F.coalesce("u.up", "k.segment").alias("thread"),
    )
    placed = _positions(threads)
    return placed.join(parsed.select("row", "role", "text", "quotes"), "row").select(
        "conv_id", "turn", "role", "text", F.col("quotes").alias("n_quotes"), F.col("n_linked").cast("int").alias("n_linked"),
        "reply_to", "thread", "position",
    )


def _positions(threads: DataFrame) -> DataFrame:
    """``threads`` with ``position``: the place by (thread, turn, row) in the
    conversation, counted block by block."""
    df = threads.withColumn("_block", F.floor(F.col("turn") / BLOCK))
    by = ["conv_id", "thread", "_block"]
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("thread", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).alias("r")
    within = df.withColumn("at", F.row_number().over(Window.partitionBy(*by).orderBy("turn", "row")) - 1).alias("l")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    kept = [F.col(f"l.{c}") for c in threads.columns]
    return within.join(starts, on).select(*kept, (F.col("r.start") + F.col("l.at")).alias("position"))


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
