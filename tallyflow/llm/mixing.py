"""Operator 8, mixing sources to target weights: iterative proportional fitting.

The tokens of the corpus are summed into cells (source, language, topic).
Raking multiplies the cells by one factor per source, then per language, then
per topic, again and again, until the three marginal sums meet their targets.
A cell's ratio (raked tokens / its own tokens) times ``rate`` is how often
each of its documents is to be taken: ``copies`` is the whole part of it, and
one more when the document's draw is below the remainder, so the tokens of
the copies meet the targets however far a cell has to be scaled up. A
document's draw is the first 32 bits of the MD5 of its id, so that a retried
task, or the same document in another run, draws the same number.

``kept`` and ``probability`` (the ratio times ``rate``, but 1 at most) say
whether a document is taken at all. A cell to be scaled up by more than
1 / ``rate`` meets its targets by the copies only: the registered query
returns them, and the pipeline's stage returns a document as often
(``repeated``). ``mixed`` takes each document once and has too few tokens of
such cells.

Targets: the share of a source and of a language is its token share to the
power ``temper`` (rescaled), so large ones are scaled down and small ones up;
topics have the weights of ``TOPIC_WEIGHTS``, rescaled over the topics that
occur. ``ROUNDS`` rounds run at any size.

Only DataFrame functions: no Python runs on the executors. The raking works
on the cells (a staged table), never on rows, and every step is a window sum
over them; only the totals (four numbers) reach the driver. A cell's probability reaches its documents
through ``skew_lookup``, so a cell with a third of all rows is not one task.

Defined cases: null source, language or topic is a value of its own
(``MISSING``); a null or empty text has no tokens, and a cell without tokens
has probability ``rate``; a null id draws as the text ``null`` would; repeated
rows draw alike; an empty table gives an empty result; other columns are not
read, whatever their names (``mixed`` and ``repeated`` return them untouched);
a text of any length is only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import BROADCAST_ROWS, one_row, skew_lookup, staged

RATE = 0.7
TEMPER = 0.7
ROUNDS = 12
MISSING = "(none)"
#: Target weights of the topics, as shares of the kept tokens.
TOPIC_WEIGHTS = {"prose": 0.8, "tabular": 0.08, "legal": 0.08, "contact": 0.04}


def topic(text: Column) -> Column:
    """The topic of a text, by marks that it holds."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "tabular")
        .when(F.contains(text, F.lit("icense")), "legal")
        .when(F.contains(text, F.lit("@")), "contact")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_col: Column) -> Column:
    """A number in [0, 1) from the id."""
    first = F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary")), 1, 8)
    return F.conv(first, 16, 10).cast("double") / F.lit(4294967296.0)


def marginals() -> list[Column]:
    """source, lang and topic of a document."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c)
    return [value("source"), value("lang"), topic(F.coalesce("text", F.lit(""))).alias("topic")]


def described(docs: DataFrame) -> DataFrame:
    """id, source, lang, topic, cell and tokens of every document, staged."""
    return staged(
        docs.select("doc_id", *marginals(), tokens(F.col("text")).alias("tokens"), F.to_json(F.array(*marginals())).alias("cell")),
        "mixing_rows",
    )


def rake(cells: DataFrame, rounds: int = ROUNDS, temper: float = TEMPER, topics: dict | None = None) -> DataFrame:
    """``cells`` (cell, source, lang, topic, tokens, docs) with ``ratio``:
    raked tokens / tokens. A marginal without a target keeps its share."""
    weights = TOPIC_WEIGHTS if topics is None else topics
    live = cells.where("tokens > 0")

    def total(df: DataFrame, column: str) -> Column:
        return F.lit(float(one_row(df, [F.sum(column).alias("t")])["t"] or 1))

    whole = total(live, "tokens")

    def share(name: str, weight: Column) -> DataFrame:
        # One row per value of the marginal, rescaled to add up to 1.
        scaled = live.groupBy(name).agg(F.sum("tokens").alias("t")).withColumn("w", weight)
        return scaled.select(name, (F.col("w") / total(scaled, "w")).alias(f"{name}_share"))

    given = F.lit(None).cast("double")
    for name, weight in weights.items():
        given = F.when(F.col("topic") == name, F.lit(float(weight))).otherwise(given)
    tempered = F.pow(F.col("t").cast("double"), F.lit(temper))
    # Topics without a weight of their own share what their tokens ask for.
    topical = F.coalesce(given, F.col("t") / whole)
    w = live.withColumn("w", F.col("tokens").cast("double"))
    for name, weight in (("source", tempered), ("lang", tempered), ("topic", topical)):
        w = w.join(share(name, weight), name)
    w = staged(w, "mixing_rake")
    for i in range(rounds):
        for name in ("source", "lang", "topic"):
            have = F.sum("w").over(Window.partitionBy(name))
            w = w.withColumn("w", F.col("w") * F.col(f"{name}_share") * whole / have)
        if i % 3 == 2:
            w = staged(w, "mixing_rake")
    return w.select("cell", (F.col("w") / F.col("tokens")).alias("ratio"))


def _placed(docs: DataFrame, rate: float, rounds: int, temper: float, topics: dict | None) -> DataFrame:
    """``described`` with ``times``: how often a document is to be taken."""
    rows = described(docs)
    cells = staged(
        rows.groupBy("cell", "source", "lang", "topic").agg(
            F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
        ),
        "mixing_cells",
    )
    raked = rake(cells, rounds, temper, topics)
    chance = cells.join(raked, "cell", "left").select(
        "cell", "docs", (F.lit(rate) * F.coalesce("ratio", F.lit(1.0))).alias("times")
    )
    placed = skew_lookup(rows, staged(chance, "mixing_chance"), "cell", "docs", rows.count(), F.col("doc_id"))
    whole = F.floor("times")
    extra = draw(F.col("doc_id")) < F.col("times") - whole
    return placed.withColumn("copies", whole + extra.cast("long"))


def mix(docs: DataFrame, rate: float = RATE, rounds: int = ROUNDS, temper: float = TEMPER, topics: dict | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept, copies."""
    placed = _placed(docs, rate, rounds, temper, topics).withColumn("probability", F.least(F.lit(1.0), F.col("times")))
    return placed.select(
        "doc_id", "source", "lang", "topic", "tokens", "probability",
        (draw(F.col("doc_id")) < F.col("probability")).alias("kept"), "copies",
    )


def _free(docs: DataFrame, *names: str) -> list[str]:
    """``names``, made longer until no column of ``docs`` has them."""
    taken = {c.lower() for c in docs.columns}
    tail = ""
    while any(f"{n}{tail}" in taken for n in names):
        tail += "_"
    return [f"{n}{tail}" for n in names]


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the calibrated draw keeps, once each, all
    columns."""
    return _taken(docs, once=True, **params)


def repeated(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, all columns, as many times as their copies."""
    return _taken(docs, once=False, **params)


def _taken(
    docs: DataFrame, once: bool, rate: float = RATE, rounds: int = ROUNDS, temper: float = TEMPER, topics: dict | None = None
) -> DataFrame:
    # Copies are a function of the cell and the id (null ids: as "null").
    id_, cell, copies, copy = _free(docs, "_mixed_id", "_mixed_cell", "_mixed_copies", "_mixed_copy")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = staged(
        _placed(docs, rate, rounds, temper, topics).where("copies > 0")
        .select(text_id.alias(id_), F.col("cell").alias(cell), F.col("copies").alias(copies)).distinct(),
        "mixing_kept",
    )
    few = kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    keyed = docs.withColumns({id_: text_id, cell: F.to_json(F.array(*marginals()))})
    taken = keyed.join(F.broadcast(kept) if few else kept, [id_, cell])
    if not once:
        taken = taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return taken.select(*(F.col(f"`{c}`") for c in docs.columns))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("probability", F.round("probability", 6))


def _sql() -> str:
    """The same raking as one chain of CTEs."""
    given = " ".join(f"when '{k}' then {v!r}" for k, v in TOPIC_WEIGHTS.items())
    parts = [
        r"""with rows as (
  select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang,
    case when contains(coalesce(text, ''), ' | ') then 'tabular' when contains(coalesce(text, ''), 'icense') then 'legal'
      when contains(coalesce(text, ''), '@') then 'contact' else 'prose' end as topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as tokens from documents
), cells as (select source, lang, topic, sum(tokens)::bigint as tokens from rows group by all having sum(tokens) > 0)""",
        f"ss as (select source, pow(sum(tokens)::double, {TEMPER}) as w from cells group by source)",
        f"ls as (select lang, pow(sum(tokens)::double, {TEMPER}) as w from cells group by lang)",
        f"""ts as (select topic, coalesce(case topic {given} end,
    sum(tokens)::double / sum(sum(tokens)) over ()) as w from cells group by topic)""",
        """r0 as materialized (select source, lang, topic, tokens, sum(tokens) over ()::double as total, tokens::double as w,
    ss.w / sum_s as source_share, ls.w / sum_l as lang_share, ts.w / sum_t as topic_share
  from cells join ss using (source) join ls using (lang) join ts using (topic),
    (select sum(w) as sum_s from ss), (select sum(w) as sum_l from ls), (select sum(w) as sum_t from ts))""",
    ]
    k = 0
    for _ in range(ROUNDS):
        for name in ("source", "lang", "topic"):
            parts.append(
                f"r{k + 1} as materialized (select * replace (w * {name}_share * total / sum(w) over (partition by {name}) as w) from r{k})"
            )
            k += 1
    return ",\n".join(parts) + f"""
, p as (select rows.*, {RATE} * coalesce(w / r{k}.tokens, 1.0) as times,
    ('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 8))::bigint / 4294967296.0 as draw
  from rows left join r{k} using (source, lang, topic))
select doc_id, source, lang, topic, tokens, round(least(1.0, times), 6) as probability, draw < least(1.0, times) as kept,
  floor(times)::bigint + (draw < times - floor(times))::bigint as copies from p"""


SQL = _sql()
