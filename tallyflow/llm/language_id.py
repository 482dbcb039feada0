"""Operator 9, language identification: multinomial naive Bayes over hashed
character n-grams.

Fitting counts the n-grams (1 to ORDERS characters, lower-cased, hashed to
BUCKETS) of labelled documents per language. The documents are a sample of
about ``sample`` per language: those whose id's hash is under sample / (rows
of the language), which needs one count per language and is the same in
every run. The counts become a matrix of log probabilities (BUCKETS rows,
one column per language) of a size that does not depend on the corpus; it is
broadcast. Scoring adds up, for each text, the matrix rows of its n-grams
(whole texts, slice by slice, sums in numpy); the score is the posterior
probability of the best language.

Defined cases: a null text, and one without a letter, is ``und`` with score
0; so is every text when there is nothing to learn from. Null labels are not
learnt. Equal scores go to the first language in alphabetical order. More
than MAX_LANGUAGES labels is an error (the matrix would have no size bound).
Repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches
from tallyflow.llm.textarrays import mix, slices, texts

BUCKETS = 1 << 15
ORDERS = 3
SAMPLE = 2000
MAX_LANGUAGES = 1024
UNKNOWN = "und"
_LOW = 0x3000  # code points that have a table of lower case and letters

_U = np.uint64
_tables: dict[str, np.ndarray] = {}


def _table(kind: str) -> np.ndarray:
    if not _tables:
        chars = [chr(c) for c in range(_LOW)]
        _tables["lower"] = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32)
        _tables["letter"] = np.array([c.isalpha() for c in chars])
    return _tables[kind]


def _characters(b: np.ndarray) -> tuple[np.ndarray, bool]:
    """Lower-case code points of UTF-8 bytes, and whether one is a letter."""
    cp = np.frombuffer(b.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    low = np.minimum(cp, _LOW - 1)
    known = cp < _LOW
    letter = bool(_table("letter")[low][known].any())
    if not letter and not known.all():
        letter = any(unicodedata.category(chr(c))[0] == "L" for c in np.unique(cp[~known]).tolist())
    return np.where(known, _table("lower")[low], cp), letter


def _grams(cp: np.ndarray, seen: int = 0) -> np.ndarray:
    """Bucket of every n-gram of 1 to ORDERS characters that does not lie
    within the first ``seen`` characters."""
    wide = cp.astype(np.uint64)
    out, code = [], np.zeros(len(cp), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(cp) < n:
            break
        code = code[: len(cp) - n + 1] * _U(0x110000) + wide[n - 1 :]
        fresh = code[max(0, seen - n + 1) :]
        out.append((mix(fresh + _U(n << 60)) >> _U(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def _pieces(b: np.ndarray, size: int = 1 << 18) -> Iterator[tuple[np.ndarray, bool]]:
    """(n-gram buckets, whether there is a letter) of a text, piece by piece;
    the pieces' n-grams are together those of the whole text."""
    at, tail = 0, np.zeros(0, np.uint32)
    while at < len(b):
        to = min(len(b), at + size)
        while to < len(b) and (b[to] & 0xC0) == 0x80:  # cut between characters
            to += 1
        cp, letter = _characters(b[at:to])
        if len(tail):
            cp = np.concatenate((tail, cp))
        yield _grams(cp, len(tail)), letter
        at, tail = to, cp[max(0, len(cp) - ORDERS + 1) :]


def _count(languages: list[str]):
    index = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for (text_from, text_to), lang in zip(zip(offsets[:-1], offsets[1:], strict=True), batch.column(1).to_pylist(), strict=True):
                row = counts.setdefault(index[lang], np.zeros(BUCKETS, np.int64))
                for grams, _ in _pieces(data[text_from:text_to]):
                    row += np.bincount(grams, minlength=BUCKETS)
        for k, row in counts.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(row[at])], ["k", "bucket", "n"]
            )

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE):
    """(languages, log prior, log probability matrix) from labelled rows."""
    rows = bounded_batches(labelled).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    found = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    languages = [r["lang"] for r in found]
    if not languages:
        return [], np.zeros(0), np.zeros((BUCKETS, 0))
    spark = labelled.sparkSession
    share = spark.createDataFrame([(r["lang"], min(1.0, sample / r["count"])) for r in found], "lang string, share double")
    # The id's hash as a number in [0, 1).
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(F.broadcast(share), "lang").where(draw < F.col("share"))
    counted = (
        chosen.select("text", "lang")
        .mapInArrow(_count(languages), "k int, bucket int, n long")
        .groupBy("k", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((BUCKETS, len(languages)))
    counts[counted["bucket"].to_numpy(), counted["k"].to_numpy()] = counted["n"].to_numpy()
    prior = np.log(np.array([r["count"] for r in found], float) / sum(r["count"] for r in found))
    smooth = 0.5
    table = np.log(counts + smooth) - np.log(counts.sum(axis=0) + smooth * BUCKETS)
    return languages, prior, table


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prior, table = model.value
        for batch in batches:
            data, offsets = texts(batch.column(1))
            best = np.full(batch.num_rows, -1)
            score = np.zeros(batch.num_rows)
            for i, j, b, at in slices(data, offsets):
                for k in range(i, j) if languages else ():
                    logs, letter = prior.copy(), False
                    for grams, found in _pieces(b[at[k - i] : at[k - i + 1]]):
                        letter |= found
                        logs += np.ones(len(grams)) @ table.take(grams, axis=0)
                    if letter:
                        best[k] = int(np.argmax(logs))
                        score[k] = 1.0 / np.exp(logs - logs[best[k]]).sum()
            names = [*languages, UNKNOWN]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([names[k] for k in best.tolist()], pa.string()), pa.array(score)],
                ["id", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score for every row of ``docs``."""
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(_score(sent), f"id {id_type}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """The fold that is not learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language can be told: their
    text has a letter, and one language is more likely than the others
    together. Rows keep their order of columns; repeated rows stay."""
    model = fit(docs.where(~held_out()))
    fields = [f.name for f in docs.schema.fields]
    text_at = fields.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    score = _score(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_at)
            for out in score(iter([pa.RecordBatch.from_arrays([text, text], ["id", "text"])])):
                keep = (out.column(2).to_numpy() >= 0.5) & (np.array(out.column(1).to_pylist(), object) != UNKNOWN)
                yield batch.filter(pa.array(keep.astype(bool)))

    return docs.mapInArrow(run, docs.schema) if model[0] else docs.limit(0)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
