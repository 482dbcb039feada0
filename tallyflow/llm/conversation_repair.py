"""Operator 13, conversation structure repair by branch and bound.

A conversation is legal when the initials of its roles spell ``(s?(ua)+)?``.
Edits, in row order: Keep a row (cost 0), Rerole it to user or assistant (3),
Delete it (4; the only edit of a blank or repeated row), Insert a user or
assistant message without text (3). A truncated row that is not deleted adds
3. Of the cheapest repairs the one whose audit (the edits' initials) is
ASCII-least is taken; which role a re-roled or inserted message gets follows
from the place.

``search`` is a depth-first branch and bound: an explicit stack, a lower bound
for every suffix and state, the incumbent, and per node (row, state) the cheapest
prefix that got there. Children are pushed so that they are visited in ASCII
order. Complete audits of the same rows are never prefixes of each other, so
leaves come in audit order and whatever comes later must be strictly cheaper,
than the incumbent and than the prefix in its node's table; the search ends
with an empty stack, that is, with the optimum proved.

Rows are range-partitioned by (conversation, turn, role, text) and sorted, so a
partition's size does not depend on a conversation's. Conversations that lie in
one partition are repaired there. Those that a partition border cuts (at most
one per border, but one may hold a third of all rows) are searched in blocks:
each block for every entry and exit state, blocks chained by (cost, rank of the
audit), and the chosen edits go back to the rows by their place. Their text is
streamed once more in order to write the messages; nothing but one byte per row
of a block is held.

Defined cases: null id, turn, role and text count as one space (null ids are one
conversation; null turns come first); rows of one turn are ordered by role and
text; a role without characters has no initial and cannot be kept; equal rows
are repetitions of the first; a conversation without rows after damage, or
whose rows all go, has no messages; texts of any length are read whole; an
empty table gives empty results; only the four named columns are read, so
others' names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.llm.common import bounded_batches, read, staged

#: States: nothing yet, after a system, a user, an assistant message.
START, S, U, A = range(4)
#: The state after an inserted or re-roled message, and that message's role.
FORCED = (U, U, A, U)
ROLE = {U: "user", A: "assistant"}
#: The state after keeping a row with this initial.
KEPT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: Cost of the messages that complete a conversation in each state.
CLOSING = (0, 6, 3, 0)
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}
#: Rows of a block of a conversation that several tasks share.
BLOCK_BITS = 16
LONGS = T.ArrayType(T.LongType())

CLEAN, BLANK, DUPLICATE, OPEN = range(4)
Row = tuple[str, int]  # initial, fault


def bounds(rows: list[Row], closing: tuple) -> list[tuple]:
    """For every suffix and state the least cost of the rest."""
    after = tuple(closing)
    out = [after]
    for initial, fault in reversed(rows):
        here = []
        for q in range(4):
            least = DELETE + after[q]
            if fault in (CLEAN, OPEN):
                extra = TRUNCATED if fault == OPEN else 0
                least = min(least, extra + REROLE + after[FORCED[q]])
                if (q, initial) in KEPT:
                    least = min(least, extra + after[KEPT[q, initial]])
            here.append(least)
        for _ in range(2):  # a third insert in a row repeats a state
            here = [min(here[q], INSERT + here[FORCED[q]]) for q in range(4)]
        out.append(after := tuple(here))
    return out[::-1]


def search(rows: list[Row], entry: int = START, closing: tuple = CLOSING) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest, then ASCII-least edits; None if no edits
    lead from ``entry`` to a state that ``closing`` allows."""
    n, suffix = len(rows), bounds(rows, closing)
    best, leaf, table = NEVER, None, {}
    stack = [(0, entry, 0, None)]
    while stack:
        i, q, cost, edits = stack.pop()
        if cost + suffix[i][q] >= best or table.get((i, q), NEVER) <= cost:
            continue
        table[i, q] = cost
        if i == n:
            best, leaf = cost + closing[q], (q, edits)
            continue
        initial, fault = rows[i]
        if fault in (CLEAN, OPEN):
            extra = cost + (TRUNCATED if fault == OPEN else 0)
            stack.append((i + 1, FORCED[q], extra + REROLE, (edits, "R")))
            if (q, initial) in KEPT:
                stack.append((i + 1, KEPT[q, initial], extra, (edits, "K")))
        stack.append((i, FORCED[q], cost + INSERT, (edits, "I")))
        stack.append((i + 1, q, cost + DELETE, (edits, "D")))
    if leaf is None:
        return None
    q, edits = leaf
    audit = ["I" * (closing[q] // INSERT)]
    while edits:
        edits, edit = edits
        audit.append(edit)
    return best, "".join(reversed(audit))


def messages(edits: Iterable[str], rows: Iterator[tuple], q: int = START) -> Iterator[tuple]:
    """(role, text, edit, state) of each message that the edits leave; ``rows``
    yields (role, text) of the rows they speak of."""
    for edit in edits:
        if edit == "I":
            q = FORCED[q]
            yield ROLE[q], "", edit, q
            continue
        role, text = next(rows)
        if edit == "K":
            q = KEPT[q, role[:1]]
            yield role, text, edit, q
        elif edit == "R":
            q = FORCED[q]
            yield ROLE[q], text, edit, q


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))  # noqa: B905


# Rows -----------------------------------------------------------------------


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``convs`` with crc32(``id:turn``) % 20 deciding the damage: 0 drops the
    row (``copies`` 0), 1 empties its text, 2 takes its ``.!?``, 3 repeats it
    (``copies`` 2), 4 makes it the user's."""
    hit = F.crc32(F.concat(_spaced(F.col(id_col)), F.lit(":"), _spaced(F.col(turn_col)))) % 20
    role, text = _spaced(F.col(role_col)), _spaced(F.col(text_col))
    return convs.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations as they are, in the columns that ``repair`` takes."""
    return convs.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        _spaced(F.col(role_col)).alias("role"),
        _spaced(F.col(text_col)).alias("text"),
        F.lit(1).alias("copies"),
    )


def _with_fault(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "fault",
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CLEAN)
        .otherwise(OPEN),
    )


def _sorted(rows: DataFrame) -> DataFrame:
    order = ["conv_id", "turn", "role", "text", "tie"]
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _schema(id_type: T.DataType) -> T.StructType:
    whole = T.ArrayType(T.StructType().add("role", "string").add("text", "string").add("edit", "string"))
    out = T.StructType().add("conv_id", id_type)
    for name in COUNTS:
        out = out.add(name, "long")
    return out.add("audit", "string").add("messages", whole).add("edge", "boolean")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _whole(rows: list[tuple]) -> tuple:
    """The counts, the audit and the messages of one conversation's rows
    (turn, role, text, copies, fault)."""
    turns, kept, codes, seen = set(), [], [], set()
    for turn, role, text, copies, fault in rows:
        for _ in range(copies):
            if turn is not None:
                turns.add(turn)
            if fault != BLANK and (role, text) in seen:
                codes.append((role[:1], DUPLICATE))
            else:
                codes.append((role[:1], fault))
            seen.add((role, text))
            kept.append((role, text))
    cost, audit = search(codes)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults = [f for _, f in codes]
    return (
        gaps,
        *(faults.count(f) for f in (BLANK, DUPLICATE, OPEN)),
        illegal([c for c, _ in codes]),
        cost,
        audit,
        [dict(zip(("role", "text", "edit"), m)) for m in messages(audit, iter(kept))],  # noqa: B905
    )


def _one_partition(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out, size, first = None, [], [], 0, True

        def result(edge: bool) -> tuple:
            return (at[0], *_whole(rows), edge)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)  # noqa: B905

        for b in batches:
            for conv, *row in zip(*(c.to_pylist() for c in b.columns)):  # noqa: B905
                if at is not None and at[0] != conv:
                    out.append(result(first))
                    first, rows = False, []
                    if size > 1 << 22 or len(out) >= 4096:
                        yield batch()
                        out, size = [], 0
                at = (conv,)
                rows.append(row)
                size += len(row[2])
        if at is not None:
            out.append(result(True))
            yield batch()

    return run


# Conversations that several partitions hold ---------------------------------


def _block(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("at")
    rows = list(zip(group["initial"], group["fault"].astype(int)))  # noqa: B905
    costs, ranks, audits = [], [], []
    for entry in range(4):
        found = [search(rows, entry, tuple(0 if q == x else NEVER for q in range(4))) for x in range(4)]
        order = sorted({f[1] for f in found if f})
        for f in found:
            costs.append(f[0] if f else NEVER)
            ranks.append(order.index(f[1]) if f else 0)
            audits.append(f[1] if f else "")
    initials = list(group["initial"])
    return pd.DataFrame(
        {
            "conv_id": [group["conv_id"].iloc[0]],
            "block": [group["block"].iloc[0]],
            "first_at": [group["at"].iloc[0]],
            "costs": [costs],
            "ranks": [ranks],
            "audits": [audits],
            "head": [initials[0]],
            "tail": [initials[-1]],
            "illegal": [illegal(initials)],
        }
    )


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """The entry and exit state of every block of one conversation."""
    group = group.sort_values("block")
    here, back = {START: (0, 0)}, []
    for costs, ranks in zip(group["costs"], group["ranks"]):  # noqa: B905
        reached, came = {}, {}
        for x in range(4):
            ways = [(c + int(costs[4 * q + x]), rank, q) for q, (c, rank) in here.items() if costs[4 * q + x] < NEVER]
            if ways:
                cost, rank, q = min(ways)
                reached[x], came[x] = (cost, (rank, int(ranks[4 * q + x]))), q
        order = sorted({r for _, r in reached.values()})
        here = {x: (c, order.index(r)) for x, (c, r) in reached.items()}
        back.append(came)
    cost, _, q = min((c + CLOSING[x], rank, x) for x, (c, rank) in here.items())
    closing, path = CLOSING[q] // INSERT, []
    for came in reversed(back):
        path.append(4 * came[q] + q)
        q = came[q]
    heads, tails = list(group["head"])[1:], list(group["tail"])[:-1]
    between = sum(a + b not in LEGAL for a, b in zip(tails, heads))  # noqa: B905
    last = [0] * (len(path) - 1)
    return pd.DataFrame(
        {
            "conv_id": group["conv_id"].array,
            "block": group["block"].array,
            "way": path[::-1],
            "closing": last + [closing],
            "cost": last + [cost],
            "illegal": last + [int(group["illegal"].sum()) + between],
        }
    )


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of sorted rows (conv_id, at, role, text, edits), as a stream."""
    at, q = None, START
    for b in batches:
        out = []
        for conv, key, role, text, edits in zip(*(c.to_pylist() for c in b.columns)):  # noqa: B905
            if at is None or at != (conv,):
                at, q = (conv,), START
            for n, (r, t, e, q) in enumerate(messages(edits, iter([(role, text)]), q)):  # noqa: B020
                out.append((conv, key, n, r, t, e))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (b.column(0).type, pa.int64(), pa.int32(), *[pa.string()] * 3))],  # noqa: B905
                ["conv_id", "at", "n", "role", "text", "edit"],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, h, kind = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([at[0]], kind), pa.array([h.hexdigest()])], ["conv_id", "sha256"])

    for b in batches:
        kind = b.column(0).type
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):  # noqa: B905
            if at is None or at != (conv,):
                if at is not None:
                    yield row()
                at, h = (conv,), hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
    if at is not None:
        yield row()


class Repaired(NamedTuple):
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and, for
    #: conversations that lay in one partition, their messages.
    summary: DataFrame
    #: Messages of the others: conv_id, at, n (their order), role, text, edit.
    others: DataFrame

    def messages(self) -> DataFrame:
        """conv_id, at, n (the order), role, text, edit of every message."""
        whole = self.summary.where("messages is not null").select(
            "conv_id", F.posexplode("messages").alias("at", "m")
        )
        return whole.select("conv_id", F.col("at").cast("long"), F.lit(0).alias("n"), "m.role", "m.text", "m.edit").unionByName(
            self.others
        )

    def digests(self) -> DataFrame:
        """conv_id, sha256 of the messages ``role:text`` joined by newlines."""
        lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
        whole = self.summary.where("messages is not null").select("conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"))
        streamed = bounded_batches(self.others.repartition("conv_id").sortWithinPartitions("conv_id", "at", "n"))
        kind = T.StructType().add("conv_id", self.others.schema["conv_id"].dataType).add("sha256", "string")
        return whole.unionByName(streamed.mapInArrow(_digests, kind))


def _across(rows: DataFrame, kind: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Summary and messages of conversations that are cut by borders."""
    rows = rows.withColumn("conv_key", F.struct("conv_id"))  # a struct is never null
    present = rows.where("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1), "copies"))).drop("_")
    placed = staged(_sorted(present).withColumn("at", F.monotonically_increasing_id()), "repair_rows")
    text = F.sha2("text", 256)
    firsts = placed.groupBy("conv_key", "role", text.alias("digest")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    fault = F.when((F.col("fault") != BLANK) & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    codes = staged(
        placed.join(firsts, "at", "left").select(
            "conv_key", "conv_id", "turn", "at", F.shiftright("at", BLOCK_BITS).alias("block"),
            F.substring("role", 1, 1).alias("initial"), fault.alias("fault"),
        ),
        "repair_codes",
    )
    fields = T.StructType().add("conv_id", kind).add("block", "long")
    found = fields.add("first_at", "long").add("costs", LONGS).add("ranks", LONGS).add("audits", T.ArrayType(T.StringType()))
    found = found.add("head", "string").add("tail", "string").add("illegal", "long")
    blocks = staged(
        codes.select("conv_id", "block", "at", "initial", "fault").groupBy("conv_id", "block").applyInPandas(_block, found), "repair_blocks"
    )
    ways = T.StructType().add("conv_id", kind).add("block", "long").add("way", "integer").add("closing", "integer").add("cost", "long").add("illegal", "long")
    chosen = staged(
        blocks.drop("audits", "first_at").groupBy("conv_id").applyInPandas(_chain, ways), "repair_chain"
    )
    c = chosen.select(F.struct("conv_id").alias("conv_key"), "block", "way", "closing", "cost", F.col("illegal").alias("bad"))
    decided = staged(
        blocks.withColumn("conv_key", F.struct("conv_id")).join(c, ["conv_key", "block"]).select(
            "conv_key", "block", "first_at", "cost", "bad",
            F.concat(F.element_at("audits", F.col("way") + 1), F.repeat(F.lit("I"), F.col("closing"))).alias("audit"),
        ),
        "repair_decided",
    )
    # Inserts belong to the row they precede; those that close go to the last.
    edits = decided.select(
        "first_at", F.posexplode(F.expr(r"regexp_extract_all(audit, '(I*[DKR](?:I+\\z)?)', 1)")).alias("n", "edits")
    ).select((F.col("first_at") + F.col("n")).alias("at"), "edits")
    written = (
        placed.join(edits, "at").select("conv_id", "at", "role", "text", "edits")
        .repartition("conv_id").sortWithinPartitions("conv_id", "at")
    )
    out = T.StructType().add("conv_id", kind).add("at", "long").add("n", "integer").add("role", "string").add("text", "string").add("edit", "string")
    others = staged(bounded_batches(written).mapInArrow(_write, out), "repair_messages")
    count = lambda f: F.sum((F.col("fault") == f).cast("long"))
    turns = codes.groupBy("conv_key", "turn").agg(
        count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(OPEN).alias("truncated")
    )
    counts = turns.groupBy("conv_key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")),
    )
    audits = decided.groupBy("conv_key").agg(
        F.sum("bad").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), "").alias("audit"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    summary = (
        rows.select("conv_key").distinct().join(counts, "conv_key", "left").join(audits, "conv_key", "left")
        .select("conv_key.conv_id", *(zero(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"))
    )
    return summary, others


def repair(rows: DataFrame) -> Repaired:
    """Repair conversations: ``rows`` as ``damaged`` or ``undamaged`` give them."""
    kind = rows.schema["conv_id"].dataType
    rows = _with_fault(rows)
    schema = _schema(kind)
    arrow = T.StructType(schema.fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = bounded_batches(_sorted(rows).select("conv_id", "turn", "role", "text", "copies", "fault"))
    done = staged(ordered.mapInArrow(_one_partition(to_arrow_schema(arrow)), schema), "repair_whole")
    # At most two conversations of a partition may go on in another one.
    cut = staged(
        done.where("edge").groupBy(F.struct("conv_id").alias("key")).count().where("count > 1").select("key"), "repair_cut"
    )
    key = F.struct("conv_id").eqNullSafe(F.col("key"))
    whole = done.join(F.broadcast(cut), key, "left_anti").drop("edge")
    summary, others = _across(rows.join(F.broadcast(cut), key, "left_semi"), kind)
    return Repaired(whole.unionByName(summary, allowMissingColumns=True), others)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    fixed = repair(damaged(read(spark, sf_dir, "conversations")))
    digests = fixed.digests().select(F.struct("conv_id").alias("key"), "sha256")
    return (
        fixed.summary.withColumn("key", F.struct("conv_id"))
        .join(digests, "key", "left")
        .select("conv_id", *COUNTS, "audit", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    )
