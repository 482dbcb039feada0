"""Operator 11, phrase collocation mining with stripes.

A stripe is a phrase's counter of next words. Level k has the stripes of the
prefixes of k - 1 words; stripes of a prefix from different tasks are merged by
adding them word by word. From the merged stripes come the phrases of k words
and their counts (extensions), the counts of the prefixes of the next level,
and, as the largest count that a phrase has in a stripe of its own or of a
longer phrase that ends in it, the subsumption maxima.

A phrase of k words that occurs ``min_count`` times has two parts of k - 1 words
that do, so a level only gathers places where both are in the level before.
Tasks test that with ``keyset.bitmap``, which has a fixed size and no false
negatives, and count within the task before the shuffle. Stripes of prefixes
with more than one in HOT_SHARE of all words (fewer than HOT_SHARE of them) are
cut into BLOCKS by next word; the others are dealt whole. A task hands stripes on
in pages by hash, one row per page, so the rows follow the entries handed on and
not the number of prefixes. There are PAGES, or as many as keep a page at
PAGE_PLACES places. Merging streams over sorted pages and holds one at a time.

Words are ``[^\\x20\\x09]+`` of pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z
lower-cased, told apart by 64-bit hash; a phrase is its words' hashes. A cut's
score is floor(2000000 * a / (l + r)) in decimals.

Defined cases: null text counts as empty and adds nothing; null lang is
``und``; repeated rows count as often as they are there; ties go to the
smallest cut, then to the phrase first in UTF-8 byte order; texts of any length
are read whole; an empty table gives an empty result; only the two named
columns are read, so others' names do not matter.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm import keyset
from tallyflow.llm.common import HOT_SHARE, bounded_batches, read, staged
from tallyflow.llm.textarrays import FOLDED, mix, slices, texts, tokens

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
BLOCKS = 64
PAGES = 1024
PAGE_PLACES = 1 << 23
#: Tasks that first rank on their own before a language's rows meet.
SALTS = 64
#: Entries that a task holds before it adds them up, and hands them on.
_HOLD = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
#: A-Z to a-z and everything that ends a word to a space.
_PLAIN = bytes(32 if _GAP[c] else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _joined(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a phrase from those of its prefix and its last word."""
    return mix(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out():
        for lang, counter in held.items():
            if counter:
                words = pa.array([w.decode("utf-8", "replace") for w in counter])
                counts = pa.array(list(counter.values()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, counts], ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counter, data = held.setdefault(lang, Counter()), (text.as_py() or "").encode()
            while data:  # a long text in pieces that end with a word
                at = len(data)
                if at > _HOLD:
                    cuts = [c for c in (data.find(s, _HOLD) for s in (b" ", b"\n", b".", b",")) if c >= 0]
                    at = min(cuts, default=at)
                counter.update(data[:at].translate(_PLAIN).split())
                data = data[at:]
        if sum(map(len, held.values())) > _HOLD // 2:
            yield from out()
            held = {}
    yield from out()


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = []
        data, offsets = texts(batch.column(1))
        langs = np.array([_seed(x) for x in batch.column(0).to_pylist()], np.uint64)
        for i, j, b, at in slices(data, offsets):
            keys.append(mix(tokens(b, at, FOLDED, _GAP)[0] + langs[i:j]).view(np.int64))
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["lang", "word", "n", "key"])


def _added(prefix: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((word, prefix))
    prefix, word, n = prefix[order], word[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1]))))
    return prefix[new], word[new], np.add.reduceat(n, new)


def _total(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _added(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def _page_rows(prefix: np.ndarray, word: np.ndarray, n: np.ndarray, hot: np.ndarray, pages: int) -> pa.RecordBatch:
    """Stripes of entries sorted by prefix and word, one row per page: the
    prefixes, how many words each has, and these words and their counts."""
    block = np.where(np.isin(prefix, hot), word % np.uint64(BLOCKS), 0).astype(np.uint64)
    page = _joined(prefix, block) % np.uint64(pages)
    order = np.argsort(page.astype(np.uint16) if pages <= 1 << 16 else page, kind="stable")
    page, prefix, word, n = page[order], prefix[order], word[order], n[order]
    other = page[1:] != page[:-1]
    row = np.flatnonzero(np.concatenate(([True], other)))
    stripe = np.flatnonzero(np.concatenate(([True], other | (prefix[1:] != prefix[:-1]))))
    at = pa.array(np.append(row, len(page)).astype(np.int32))
    first = pa.array(np.append(np.searchsorted(stripe, row), len(stripe)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(page[row].astype(np.int32)),
            pa.ListArray.from_arrays(first, pa.array(prefix[stripe].view(np.int64))),
            pa.ListArray.from_arrays(first, pa.array(np.diff(np.append(stripe, len(page))).astype(np.int32))),
            pa.ListArray.from_arrays(at, pa.array(word.view(np.int64))),
            pa.ListArray.from_arrays(at, pa.array(n.astype(np.int32))),
        ],
        ["page", "prefixes", "sizes", "words", "counts"],
    )


def _stripes(sent, k: int, pages: int = PAGES):
    """Pages of the stripes of the prefixes of k - 1 words in each task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = sent.value
        parts, held = [], 0
        for batch in batches:
            data, offsets = texts(batch.column(1))
            langs = np.array([_seed(x) for x in batch.column(0).to_pylist()], np.uint64)
            for i, j, b, at in slices(data, offsets):
                h, start, first = tokens(b, at, FOLDED, _GAP)
                if len(h) < k:
                    continue
                text = np.repeat(np.arange(j - i), np.diff(first))
                word = mix(h + langs[i:j][text])
                piece = np.cumsum(_BREAK[b], dtype=np.int64)[start] + text
                prefix = word
                for m in range(1, k - 1):
                    prefix = _joined(prefix[:-1], word[m:])
                known = keyset.may_hold(bits, prefix)
                ok = np.flatnonzero(known[:-1] & known[1:] & (piece[: len(h) - k + 1] == piece[k - 1 :]))
                if len(ok):
                    entries = _added(prefix[ok], word[ok + k - 1], np.ones(len(ok), np.int64))
                    parts.append(entries)
                    held += len(entries[0])
                if held > 2 * _HOLD:
                    entries = _total(parts)
                    parts, held = [entries], len(entries[0])
                    if held > _HOLD:
                        yield _page_rows(*entries, hot, pages)
                        parts, held = [], 0
        if held:
            yield _page_rows(*_total(parts), hot, pages)

    return run


def _merge(min_count: int):
    """Merge sorted pages; entries that occur ``min_count`` times."""

    def out(parts):
        prefix, word, n = _total(parts)
        keep = n >= min_count
        prefix, word = prefix[keep], word[keep]
        columns = (prefix.view(np.int64), word.view(np.int64), _joined(prefix, word).view(np.int64), n[keep])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["prefix", "word", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, held, most = None, [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            page = batch.column(0).to_numpy()
            prefix = np.repeat(batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()).view(np.uint64)
            word = batch.column(3).flatten().to_numpy().view(np.uint64)
            n = batch.column(4).flatten().to_numpy().astype(np.int64)
            at = batch.column(3).offsets.to_numpy()
            at = at - at[0]
            new = np.flatnonzero(np.concatenate(([True], page[1:] != page[:-1])))
            for i, j in zip(new, np.append(new[1:], len(page)), strict=True):
                if parts and last != page[i]:
                    yield out(parts)
                    parts, held = [], 0
                last, some = page[i], slice(at[i], at[j])
                most = max(most, _HOLD) if parts else _HOLD
                parts.append((prefix[some], word[some], n[some]))
                held += at[j] - at[i]
                if held > most:  # at most twice what is left when added up
                    parts = [_total(parts)]
                    held = len(parts[0][0])
                    most = 2 * held
        if parts:
            yield out(parts)

    return run


def phrase_counts(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, xs, phrase, a) of every phrase of up
    to ``max_words`` words that occurs ``min_count`` times; xs are its words'
    keys."""
    sc = docs.sparkSession.sparkContext
    rows = bounded_batches(docs).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    counted = rows.mapInArrow(_count_words, "lang string, word string, n long")
    words = staged(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase_words")
    totals = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase_totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    pages = max(PAGES, -(-total // PAGE_PLACES))
    keyed = words.where(F.col("n") >= min_count).mapInArrow(_with_keys, "lang string, word string, n long, key long")
    one = staged(
        keyed.select("key", "lang", F.array("key").alias("xs"), F.col("word").alias("phrase"), F.col("n").alias("a")), "phrase_1"
    )
    levels = [one]
    last_word = one.select(F.col("key").alias("word"), F.col("phrase").alias("last"))
    for k in range(2, max_words + 1):
        before = levels[-1]
        hot = before.where(F.col("a") * HOT_SHARE > total).select("key").toArrow()["key"].to_numpy()
        sent = sc.broadcast((keyset.bitmap(before), hot.view(np.uint64)))
        stripes = rows.mapInArrow(
            _stripes(sent, k, pages), "page int, prefixes array<long>, sizes array<int>, words array<long>, counts array<int>"
        )
        dealt = stripes.repartition("page").sortWithinPartitions("page")
        grown = dealt.mapInArrow(_merge(min_count), "prefix long, word long, key long, n long")
        prefixes = before.select(F.col("key").alias("prefix"), "lang", "xs", "phrase")
        level = (
            grown.join(prefixes, "prefix")
            .join(last_word, "word")
            .select("key", "lang", F.concat("xs", F.array("word")).alias("xs"), F.concat_ws(" ", "phrase", "last").alias("phrase"), F.col("n").alias("a"))
        )
        levels.append(staged(level, f"phrase_{k}"))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return totals, phrases.drop("key")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's ``top`` phrases."""
    totals, phrases = phrase_counts(docs, lang_col, text_col, min_count, max_words)
    m = F.size("xs")
    many = phrases.where(m > 1)
    inner = many.where(m > 2).select(
        F.explode(F.array(F.expr("slice(xs, 1, size(xs) - 1)"), F.expr("slice(xs, 2, size(xs) - 1)"))).alias("xs"), "a"
    )
    around = inner.groupBy("xs").agg(F.max("a").alias("longer"))
    free = many.join(around, "xs", "left").where(
        F.col("longer").isNull()
        | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * 80)
    )
    cuts = free.select("xs", "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.select(
        "*", F.expr("slice(xs, 1, k)").alias("left_part"), F.expr("slice(xs, k + 1, size(xs) - k)").alias("right_part")
    )
    known = phrases.select("xs", "a")
    scored = (
        cuts.join(known.select(F.col("xs").alias("left_part"), F.col("a").alias("l")), "left_part")
        .join(known.select(F.col("xs").alias("right_part"), F.col("a").alias("r")), "right_part")
        .withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
        .groupBy("xs", "lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("xs"), F.lit(SALTS)).alias("salt"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    within = Window.partitionBy("lang", "salt").orderBy(*order)
    overall = Window.partitionBy("lang").orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top).drop("rank", "salt")
    return (
        best.withColumn("rank", F.row_number().over(overall).cast("long"))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def _gram(k: int) -> str:
    words = " || ' ' || ".join(["w", *(f"lead(w, {j}) over p" for j in range(1, k))])
    return rf"select lang, {words} as phrase, {k} as m from t window p as (partition by d, piece order by i)"


SQL = rf"""
with s as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps
  from documents
), q as (select d, lang, unnest(ps) as p, generate_subscripts(ps, 1) as piece from s),
v as (select d, lang, piece, regexp_extract_all(p, '[^\x20\x09]+') as ws from q),
t as (select d, lang, piece, unnest(ws) as w, generate_subscripts(ws, 1) as i from v),
total as (select lang, count(*) as n from t group by lang),
g as ({" union all ".join(_gram(k) for k in range(1, MAX_WORDS + 1))}),
f as (select lang, phrase, m, count(*) as a from g where phrase is not null group by all having count(*) >= {MIN_COUNT}),
c as (select *, string_split(phrase, ' ') as ws from f),
inner_parts as (
  select lang, unnest([array_to_string(ws[1:m - 1], ' '), array_to_string(ws[2:m], ' ')]) as phrase, a from c where m > 2),
around as (select lang, phrase, max(a) as longer from inner_parts group by all),
cut as (
  select c.lang, c.phrase, c.a, l.a as l, r.a as r, k, (2000000::hugeint * c.a) // (l.a + r.a) as score
  from (select *, unnest(range(1, m)) as k from c where m > 1) c
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1:k], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[k + 1:c.m], ' ')),
best as (select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (
  select best.* from best left join around using (lang, phrase) where longer is null or 100::hugeint * longer < 80::hugeint * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept join total using (lang) qualify rank <= {TOP}
"""
