"""Operator 1, exact dedup: skew-safe combining of equal texts.

Three combines, each of which groups by the whole normalised text (the digest
only routes rows):

1. local: the map side of the first aggregate leaves one row per distinct
   text and task;
2. salted: those rows meet by (digest, salt), the salt being the task's
   number modulo ``salts``, so a text with copies in every task is merged by
   ``salts`` reducers and not by one;
3. global: at most ``salts`` winners per text meet by digest.

The winners of groups with more than one row then label the rows by digest
(a hot group's winner is broadcast, see ``skew_lookup``). Texts that differ
but share a digest are told apart there by their whole text as well.

Only DataFrame functions: no Python runs on the executors.

Defined cases: a null text counts as empty; a null id never wins against an
id, and a group of null ids has a null ``keep_id`` and keeps its rows;
repeated rows (same id and text) get the same decision; an empty table gives
an empty result; columns other than the id and the text are not read, so
their names do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import skew_lookup, staged

#: A run of white space that is not already one space.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalise(text: Column) -> Column:
    """Every run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUN, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id (smallest id of the equal
    texts), group_size, kept, digest (binary)."""
    rows = docs.select(F.col(id_col).alias("id"), normalise(F.col(text_col)).alias("body")).withColumn(
        "digest", digest(F.col("body"))
    )
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "body")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    # Dealt by digest alone, so that the texts of one digest can be counted
    # where they are; a digest has at most `salts` rows per text here.
    whole = (
        salted.repartition("digest").groupBy("digest", "body").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    )
    winners = staged(
        whole.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("digest")))
        .where((F.col("n") > 1) | (F.col("texts") > 1))
        .select("digest", "keep_id", "n", F.when(F.col("texts") > 1, F.col("body")).alias("body")),
        "exact_dedup",
    )
    narrow = rows.select("id", "digest")
    plain = winners.where(F.col("body").isNull()).select("digest", "keep_id", F.col("n").alias("group_size"), "n")
    labelled = skew_lookup(narrow, plain, on="digest", weight="n", total=docs.count(), spread=F.col("id"))
    clashing = winners.where(F.col("body").isNotNull())
    if not clashing.isEmpty():
        # Different texts under one digest: these rows compare whole texts.
        clash = clashing.select(F.col("digest").alias("d"), F.col("body").alias("b"), "keep_id", F.col("n").alias("group_size"))
        among = clashing.select("digest").distinct()
        whole_rows = rows.join(among, "digest", "left_semi")
        labelled = labelled.join(among, "digest", "left_anti").unionByName(
            whole_rows.join(clash, (F.col("digest") == F.col("d")) & (F.col("body") == F.col("b")), "left").select(
                "id", "digest", "keep_id", "group_size"
            )
        )
    keep_id = F.coalesce("keep_id", "id")
    return labelled.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        "digest",
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
), g as (
  select body, min(doc_id) as keep_id, count(*) as group_size from n group by body
)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, sha256(n.body) as text_sha256
from n join g using (body)
"""
