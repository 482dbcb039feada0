"""Operator 10, language-model scoring: stupid backoff with bigrams, computed
relationally from counts over all documents.

A word after another scores log(c(v w) / c(v)) when the bigram occurs at least
``min_count`` times in the corpus, and log(BACKOFF * c(w) / N) otherwise; a
text's first word scores log(c(w) / N). A document's score is the mean over
its words.

Every word and every bigram is counted exactly, however rare. The words with
at least one in 2**VOCABULARY_BITS of all N words, so at most
2**VOCABULARY_BITS of them at any size of the corpus, are broadcast with their
counts and numbered by falling count; a bigram of two of them is one integer.
Any other word is its hash, and its count comes to its bigrams by a shuffle:
they are dealt by that word, which has less than one in 2**VOCABULARY_BITS of
the words, and meet its row of the count table there. A bigram of two such
words goes to both; c(v w) is known at either, so the first word's place adds
the seen value and the second word's the unseen one.

Bigrams of the HEAD most frequent words only (at most HEAD * HEAD kinds) are
counted with a map-side combine and their table is broadcast. All other
bigrams are exploded, one row per document and kind. Counts and rows share one
exchange: a bigram's count is summed where its rows are and joined to them
there (a window sum, since a count table of its own would move the same rows
a second time), and each task sums up what it has of a document before the
last shuffle. Frequent words are thus never a shuffle key by themselves: a key
holds a word outside the HEAD most frequent.

With ``bits``, words with less than one in 2**bits of all words count together
as one unknown word. Neither the query nor ``SQL`` has such a bound.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, told apart by 64-bit
hash (see ``textarrays``).

Defined cases: a text without words (null, empty, white space) has 0 words
and a null score; repeated rows and equal ids count as separate documents and
are scored each; a null id keeps its row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches, one_row, staged
from tallyflow.llm.textarrays import slices, texts, word_hashes

VOCABULARY_BITS = 20
HEAD = 1024
MIN_COUNT = 2
BACKOFF = 0.4
_ID_BITS = 21  # numbers of words, 0 being a word without one
#: What a row's ``at`` is: a bigram of two numbered words, the hash of a
#: bigram's first or second word or of a text's first one, a text, a count.
_BOTH, _FIRST, _SECOND, _START, _TEXT, _COUNT = range(6)
#: Distinct words a task holds before it hands them on.
_HOLD = 1 << 20


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[at], np.add.reduceat(n, at)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, counts, held = [], [], 0

    def out(h, n):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        data, offsets = texts(batch.column(0))
        for _, _, b, at in slices(data, offsets):
            h, n = np.unique(word_hashes(b, at)[0], return_counts=True)
            hashes.append(h)
            counts.append(n.astype(np.int64))
            held += len(h)
            if held > 2 * _HOLD:
                h, n = _summed(np.concatenate(hashes), np.concatenate(counts))
                if len(h) > _HOLD:
                    yield out(h, n)
                    h, n = h[:0], n[:0]
                hashes, counts, held = [h], [n], len(h)
    if held:
        yield out(*_summed(np.concatenate(hashes), np.concatenate(counts)))


class _Vocabulary:
    """Word numbers by hash: 1 is the most frequent word, 0 has no number.
    With ``pooled`` the words without a number are one word, numbered 0."""

    def __init__(self, words: np.ndarray, pooled: bool):
        order = np.argsort(words)
        self.words, self.number = words[order], (order + 1).astype(np.int64)
        self.least = 0 if pooled else 1

    def numbers(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.number[at], 0)


def _bigrams(vocabulary: _Vocabulary, b: np.ndarray, at: np.ndarray):
    """(numbers of all words, their hashes, each text's first place, places
    whose word has one before it in its text)."""
    h, first = word_hashes(b, at)
    inner = np.ones(len(h), bool)
    inner[first[:-1][first[:-1] < len(h)]] = False
    return vocabulary.numbers(h), h.view(np.int64), first, np.flatnonzero(inner)


def _head_counts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(*sent.value)
        counts = np.zeros(HEAD * HEAD, np.int64)
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for _, _, b, at in slices(data, offsets):
                w, _, _, inner = _bigrams(vocabulary, b, at)
                v, w = w[inner - 1], w[inner]
                both = (np.minimum(v, w) >= vocabulary.least) & (np.maximum(v, w) < HEAD)
                counts += np.bincount(v[both] * HEAD + w[both], minlength=HEAD * HEAD)
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["gram", "n"])

    return run


def _explode(sent):
    """Rows (at, kind, other, row, n) of the bigrams outside the head and of
    first words without a number, and one row per text of kind _TEXT: its id,
    its words and what its head bigrams and numbered first word score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, log_count, log_total, head, min_count = sent.value
        vocabulary = _Vocabulary(*words)
        least = vocabulary.least
        for batch in batches:
            data, offsets = texts(batch.column(2))
            keys, ids = batch.column(0).to_numpy(), batch.column(1)
            for i, j, b, at in slices(data, offsets):
                w, h, first, inner = _bigrams(vocabulary, b, at)
                text = np.repeat(np.arange(j - i), np.diff(first))
                base = np.zeros(j - i)
                starts = first[:-1][np.diff(first) > 0]
                rare = starts[w[starts] < least]
                starts = starts[w[starts] >= least]
                np.add.at(base, text[starts], log_count[w[starts]] - log_total)
                v, u, t = w[inner - 1], w[inner], text[inner]
                both = (np.minimum(v, u) >= least) & (np.maximum(v, u) < HEAD)
                c = head[v[both] * HEAD + u[both]]
                seen = c >= min_count
                value = np.where(
                    seen, np.log(np.maximum(c, 1)) - log_count[v[both]], np.log(BACKOFF) + log_count[u[both]] - log_total
                )
                base += np.bincount(t[both], weights=value, minlength=j - i)
                v, u, t, inner = v[~both], u[~both], t[~both], inner[~both]
                one, two = v < least, u < least
                # A word without a number is its hash, which is no number (see ``lm_scores``).
                v, u = np.where(one, h[inner - 1], v), np.where(two, h[inner], u)
                packed = ~one & ~two
                parts = (
                    (_BOTH, (v[packed] << _ID_BITS) | u[packed], np.zeros(packed.sum(), np.int64), t[packed]),
                    (_FIRST, v[one], u[one], t[one]),
                    (_SECOND, u[two], v[two], t[two]),
                    (_START, h[rare], np.zeros(len(rare), np.int64), text[rare]),
                )
                kind = np.concatenate([np.full(len(p[1]), p[0], np.int32) for p in parts])
                key, other, t = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
                order = np.lexsort((other, key, kind, t))
                kind, key, other, t = kind[order], key[order], other[order], t[order]
                new = np.ones(len(t), bool)
                new[1:] = (kind[1:] != kind[:-1]) | (key[1:] != key[:-1]) | (other[1:] != other[:-1]) | (t[1:] != t[:-1])
                new = np.flatnonzero(new)
                n = np.diff(np.append(new, len(t)))
                own = keys[i:j]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((key[new], -1 - own))),
                        pa.array(np.concatenate((kind[new], np.full(j - i, _TEXT, np.int32)))),
                        pa.array(np.concatenate((other[new], np.zeros(j - i, np.int64)))),
                        pa.array(np.concatenate((own[t[new]], own))),
                        pa.concat_arrays([pa.nulls(len(new), ids.type), ids.slice(i, j - i)]),
                        pa.array(np.concatenate((n, np.diff(first))).astype(np.int64)),
                        pa.array(np.concatenate((np.zeros(len(new)), base))),
                    ],
                    ["at", "kind", "other", "row", "id", "n", "base"],
                )

    return run


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, bits: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, score (mean log score)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    text = bounded_batches(docs).select(F.col(text_col).alias("text"))
    words = staged(
        text.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm_words"
    )
    total = one_row(words, [F.sum("n").alias("n")])["n"] or 0
    numbered = F.col("n") * F.lit(1 << (VOCABULARY_BITS if bits is None else bits)) >= F.lit(total)
    if bits is None:
        # Hashes that could be taken for a number have one, so no other word's hash is a number.
        numbered |= F.col("word").between(0, (1 << _ID_BITS) - 1)
    known = words.where(numbered).orderBy(F.desc("n"), "word").toArrow()
    # Arrays only: a broadcast is pickled by reference, so it holds no class of this package.
    vocabulary = (known["word"].to_numpy().astype(np.int64).view(np.uint64), bits is not None)
    counts = known["n"].to_numpy()
    counts = np.concatenate(([total - int(counts.sum())], counts))
    log_count = np.log(np.maximum(counts, 1).astype(float))
    log_total = float(np.log(max(total, 1)))
    heads = text.mapInArrow(_head_counts(sc.broadcast(vocabulary)), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    head = np.zeros(HEAD * HEAD, np.int64)
    head[heads["gram"].to_numpy()] = heads["n"].to_numpy()
    sent = sc.broadcast((vocabulary, log_count, log_total, head, min_count))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    exploded = rows.mapInArrow(_explode(sent), f"at long, kind int, other long, row long, id {kind}, n long, base double")
    if bits is None:
        rare = words.where(~numbered).select(F.col("word").alias("at"), F.lit(_COUNT).alias("kind"), "n")
        exploded = exploded.unionByName(rare, allowMissingColumns=True)
    # Dealt by ``at`` alone, so that both windows find their rows in one place.
    joined = (
        exploded.repartition("at")
        .withColumn("c", F.sum("n").over(Window.partitionBy("at", "kind", "other")))
        .withColumn("log_at", F.log(F.max(F.when(F.col("kind") == _COUNT, F.col("n"))).over(Window.partitionBy("at")).cast("double")))
        .where(F.col("kind") != _COUNT)
    )
    numbers = spark.createDataFrame(
        pa.table({"number": np.arange(len(log_count), dtype=np.int64), "log_c": log_count})
    )
    first = numbers.select(F.col("number").alias("v"), F.col("log_c").alias("log_v"))
    second = numbers.select(F.col("number").alias("w"), F.col("log_c").alias("log_w"))
    mask = F.lit((1 << _ID_BITS) - 1)
    is_ = lambda k: F.col("kind") == k
    unseen = F.lit(float(np.log(BACKOFF)) - log_total)
    # Null where the other word has no number: its own row adds the value.
    seen_log: Column = F.when(is_(_FIRST), F.col("log_at")).otherwise(F.col("log_v"))
    unseen_log: Column = F.when(is_(_SECOND), F.col("log_at")).otherwise(F.col("log_w"))
    summed = (
        joined.withColumn("v", F.when(is_(_BOTH), F.shiftright("at", _ID_BITS)).when(is_(_SECOND), F.col("other")))
        .withColumn("w", F.when(is_(_BOTH), F.col("at").bitwiseAND(mask)).when(is_(_FIRST), F.col("other")))
        .join(F.broadcast(first), "v", "left")
        .join(F.broadcast(second), "w", "left")
        .withColumn(
            "value",
            F.when(is_(_TEXT), F.col("base"))
            .when(is_(_START), F.col("log_at") - F.lit(log_total))
            .when(F.col("c") >= min_count, F.col("n") * (F.log(F.col("c").cast("double")) - seen_log))
            .otherwise(F.col("n") * (unseen + unseen_log)),
        )
        .groupBy("row")
        .agg(
            F.max("id").alias("id"),
            F.sum("value").alias("value"),
            F.sum(F.when(is_(_TEXT), F.col("n"))).cast("long").alias("n_words"),
        )
    )
    return summed.select(
        F.col("id").alias(id_col), "n_words", F.when(F.col("n_words") > 0, F.col("value") / F.col("n_words")).alias("score")
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    scored = lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.withColumn("score", F.round("score", 6))


SQL = rf"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
), t as (select r, unnest(ws) as w, generate_subscripts(ws, 1) as i from d),
u as (select w, count(*) as n from t group by w), total as (select sum(n)::double as s from u),
b as (select t.r, t.i, t.w, p.i is not null as inner_word, p.w as v from t left join t p on p.r = t.r and p.i = t.i - 1),
bc as (select v, w, count(*) as n from b where inner_word group by v, w),
s as (
  select b.r, sum(case when not inner_word then ln(uw.n / s)
    when bc.n >= {MIN_COUNT} then ln(bc.n::double) - ln(uv.n::double)
    else ln({BACKOFF} * uw.n / s) end) as value, count(*) as n
  from b join u uw on uw.w is not distinct from b.w
  left join bc on inner_word and bc.v is not distinct from b.v and bc.w is not distinct from b.w
  left join u uv on inner_word and uv.w is not distinct from b.v, total group by b.r)
select doc_id, coalesce(s.n, 0) as n_words, round(value / s.n, 6) as score from d left join s using (r)
"""
