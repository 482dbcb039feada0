"""Operator 12, substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of a text. Every word is removed that a
window covers whose words also start anywhere else, in the same text too.

1. Anchors. Each window picks, of its GRAM-word phrases, the one with the
   smallest hash (the first of equal ones). Equal windows pick equal phrases, so
   a window can only recur if its anchor is picked in two places. Anchors are
   counted over all documents; ``keyset.bitmap`` of those picked twice has a
   fixed size and no false negatives.
2. Segments. Consecutive windows with one anchor place make a segment, of at
   most 2 * window - GRAM words. Segments whose anchor may recur go, as 32-bit
   word hashes, to the shard of their anchor: there all places of a window meet.
3. Shards. A shard streams over its sorted anchors. It confirms the windows that
   occur twice, takes the longest runs of them in each segment as recurring
   passages, compiles these into an Aho-Corasick automaton, and runs every
   segment through it: each match is a place whose words go.
4. Places come back to their documents, whose words outside them are kept.

Anchors picked in more than HOT places (also a bitmap) can have any number of
segments. Their windows are counted by a grouping with map-side combine, and
the recurring ones are copied to each of SALTS shards over which the anchor's
segments are dealt.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Windows are equal when anchor and
windows have equal 64-bit hashes.

Defined cases: null counts as empty; a text without words has 0 words and the
hash of the empty string; fewer words than a window are never removed; repeated
rows are each other's copies (no place of them stays); null and equal ids keep
their rows apart; texts of any length are read whole; an empty table gives an
empty result; only the two named columns are read, so others' names do not
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm import keyset
from tallyflow.llm.common import bounded_batches, read, staged
from tallyflow.llm.textarrays import mix, slices, texts, tokens

WINDOW = 35
#: Words of an anchor.
GRAM = 16
#: Places above which an anchor's segments are dealt to SALTS shards.
HOT = 4096
SALTS = 64
#: Distinct keys that a task holds, and words of segments that it works on.
_HOLD = 1 << 20
_WORK = 1 << 19

_U = np.uint64


def _rolled(words: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hashes of each k consecutive words."""
    n = len(words) - k + 1
    out = np.full(n, salt, np.uint64)
    for j, step in enumerate(mix(np.arange(1, k + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(salt)) | _U(1)):
        out += words[j : j + n] * step
    return mix(out)


def _segments(b: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Segments of a slice of texts: (words, text, first word, windows, anchor
    hash, first word within its text)."""
    h, _, first = tokens(b, offsets)
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return h, none, none, none, none.view(np.uint64), none
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    value = _rolled(h, gram, 1)
    place = np.arange(len(value))
    reach, wanted = 1, window - gram + 1
    while reach < wanted:  # the smallest, then first, of ``reach`` phrases
        step = min(reach, wanted - reach)
        left = value[: len(value) - step] <= value[step:]
        value, place = (np.where(left, x[: len(x) - step], x[step:]) for x in (value, place))
        reach += step
    at = np.flatnonzero(text[: len(h) - window + 1] == text[window - 1 :])
    if not len(at):
        return h, none, none, none, none.view(np.uint64), none
    value, place = value[at], place[at]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    start = at[new]
    return h, text[start], start, np.diff(np.append(new, len(at))), value[new], start - first[text[start]]


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[new], np.add.reduceat(n, new)


def _anchors(window: int, gram: int):
    def out(key, n):
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for _, _, b, at in slices(data, offsets):
                key, n = np.unique(_segments(b, at, window, gram)[4], return_counts=True)
                keys.append(key)
                counts.append(n.astype(np.int64))
                held += len(key)
                if held > _HOLD:
                    key, n = _summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, held = [key], [n], len(key)
                    if held > _HOLD // 2:
                        yield out(key, n)
                        keys, counts, held = [], [], 0
        if held:
            yield out(*_summed(np.concatenate(keys), np.concatenate(counts)))

    return run


def _gathered(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of several runs, one after the other, and where each begins."""
    at = np.concatenate(([0], np.cumsum(length)))
    return words[np.arange(at[-1]) + np.repeat(start - at[:-1], length)], at


def _fingerprints(flat: np.ndarray, at: np.ndarray, windows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, segment) of every window of segments that lie in ``flat``."""
    starts, w = _gathered(np.arange(len(flat)), at[:-1], windows)
    prints = _rolled(flat.astype(np.uint64), window, 2)
    return prints[starts], np.repeat(np.arange(len(windows)), np.diff(w))


def _hot_windows(sent, window: int, gram: int):
    """(anchor, print, n) of the windows of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for _, _, b, at in slices(data, offsets):
                h, _, start, windows, anchor, _ = _segments(b, at, window, gram)
                ok = np.flatnonzero(keyset.may_hold(hot, anchor))
                if not len(ok):
                    continue
                flat, w = _gathered(h.astype(np.uint32), start[ok], windows[ok] + window - 1)
                prints, segment = _fingerprints(flat, w, windows[ok], window)
                pair = np.stack((anchor[ok][segment], prints))
                pair, n = np.unique(pair, axis=1, return_counts=True)
                columns = (pair[0].view(np.int64), np.ascontiguousarray(pair[1]).view(np.int64), n.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["anchor", "print", "n"])

    return run


def _segment_rows(sent, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, hot = sent.value
        for batch in batches:
            rows = batch.column(0).to_numpy()
            data, offsets = texts(batch.column(1))
            for i, j, b, at in slices(data, offsets):
                h, text, start, windows, anchor, first = _segments(b, at, window, gram)
                ok = np.flatnonzero(keyset.may_hold(twice, anchor))
                for part in np.array_split(ok, max(1, len(ok) // 20_000)):
                    if not len(part):
                        continue
                    flat, w = _gathered(h.astype(np.uint32), start[part], windows[part] + window - 1)
                    row = rows[i:j][text[part]]
                    spread = mix(row.view(np.uint64) * _U(31) + first[part].astype(np.uint64)) % _U(SALTS)
                    salt = np.where(keyset.may_hold(hot, anchor[part]), spread.astype(np.int32) + 1, 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor[part].view(np.int64)),
                            pa.array(salt.astype(np.int32)),
                            pa.array(np.zeros(len(part), np.int64)),
                            pa.array(row),
                            pa.array(first[part].astype(np.int64)),
                            pa.ListArray.from_arrays(pa.array(w.astype(np.int32)), pa.array(flat.view(np.int32))),
                        ],
                        ["anchor", "salt", "print", "row", "first", "words"],
                    )

    return run


def passages(flat: np.ndarray, at: np.ndarray, recurs: np.ndarray, w: np.ndarray, window: int) -> list[tuple]:
    """The distinct longest runs of recurring windows: ``recurs`` says of each
    window whether it does, segment s has the windows w[s] to w[s + 1]."""
    edge = np.zeros(len(recurs) + 1, bool)
    edge[w] = True
    begins = np.flatnonzero(recurs & (edge[:-1] | ~np.concatenate(([False], recurs[:-1]))))
    ends = np.flatnonzero(recurs & (edge[1:] | ~np.concatenate((recurs[1:], [False])))) + 1
    segment = np.searchsorted(w, begins, "right") - 1
    start = at[segment] + begins - w[segment]
    out = set()
    for s, n in zip(start.tolist(), (ends - begins).tolist(), strict=True):
        out.add(flat[s : s + n + window - 1].tobytes())
    return [tuple(np.frombuffer(p, np.uint32).tolist()) for p in out]


def automaton(phrases: list[tuple]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase in phrases:
        found.add_word(phrase, len(phrase))
    found.make_automaton()
    return found


def located(find: ahocorasick.Automaton, words: tuple) -> list[tuple[int, int]]:
    """The places (from, to) of the passages in a segment, overlaps joined."""
    out: list[tuple[int, int]] = []
    for end, length in find.iter(words):
        begin = end - length + 1
        while out and out[-1][1] >= begin:
            begin = min(begin, out.pop()[0])
        out.append((begin, end + 1))
    return out


def _shard(window: int):
    """Sorted rows of a shard: of an anchor (and salt) first the windows known
    to recur (no words), then its segments. Places (row, from, to)."""

    def work(anchor, flat, at, row, first, hot, known) -> pa.RecordBatch | None:
        windows = np.diff(at) - window + 1
        prints, segment = _fingerprints(flat, at, windows, window)
        w = np.concatenate(([0], np.cumsum(windows)))
        key = mix(prints + anchor[segment] * _U(0x9E3779B97F4A7C15))
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        recurs = np.where(hot[segment], np.isin(key, known), n[inverse] > 1)
        phrases = passages(flat, at, recurs, w, window)
        if not phrases:
            return None
        find, seen, out = automaton(phrases), {}, []
        for s, (a, z) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            words = flat[a:z]
            name = words.tobytes()
            if name not in seen:
                seen[name] = located(find, tuple(words.tolist()))
            out += [(s, f, t) for f, t in seen[name]]
        if not out:
            return None
        s, f, t = np.array(out, np.int64).T
        columns = (row[s], first[s] + f, first[s] + t)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # parts of segments not worked on
        known = of = np.zeros(0, np.uint64)  # windows known to recur, and their anchors
        size = 0

        def flush(parts):
            anchor, salt, row, first, flat, length = (np.concatenate(c) for c in zip(*parts, strict=True))
            return work(anchor, flat, np.concatenate(([0], np.cumsum(length))), row, first, salt > 0, known)

        for batch in batches:
            anchor = batch.column(0).to_numpy().view(np.uint64)
            salt = batch.column(1).to_numpy()
            if not len(anchor):
                continue
            words = batch.column(5)
            is_segment = np.asarray(words.is_valid())
            prints = batch.column(2).to_numpy().view(np.uint64)
            fresh = mix(prints[~is_segment] + anchor[~is_segment] * _U(0x9E3779B97F4A7C15))
            known, of = np.concatenate((known, fresh)), np.concatenate((of, anchor[~is_segment]))
            at = np.flatnonzero(is_segment)
            if len(at):
                lists = words.take(pa.array(at))
                flat = lists.flatten().to_numpy().view(np.uint32)
                length = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                row, first = (batch.column(c).take(pa.array(at)).to_numpy() for c in (3, 4))
                held.append((anchor[at], salt[at], row, first, flat, length))
                size += len(flat)
            if size < _WORK or not held:
                continue
            # An anchor without salts may go on in the next batch; a salted
            # one needs only the windows known to recur.
            parts = [np.concatenate(c) for c in zip(*held, strict=True)]
            ends = np.cumsum(parts[5])
            later = (parts[0] == anchor[-1]) & (parts[1] == salt[-1]) & (parts[1] == 0)
            cut = int(np.argmax(later)) if later.any() else len(later)
            if cut:
                f = int(ends[cut - 1])
                now = (*(p[:cut] for p in parts[:4]), parts[4][:f], parts[5][:cut])
                rest = (*(p[cut:] for p in parts[:4]), parts[4][f:], parts[5][cut:])
                found = flush([now])
                if found is not None:
                    yield found
                held, size = ([rest], len(rest[4])) if len(rest[0]) else ([], 0)
                mine = of == anchor[-1]  # a salted anchor may go on, the others are over
                known, of = known[mine], of[mine]
        if held:
            found = flush(held)
            if found is not None:
                yield found

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, digests = [], [], []
        for text, places in zip(batch.column(1), batch.column(2), strict=True):
            words = (text.as_py() or "").encode().split()
            cover = np.zeros(len(words) + 1, np.int64)
            if places.is_valid:
                spans = places.values
                np.add.at(cover, spans.field(0).to_numpy(), 1)
                np.add.at(cover, spans.field(1).to_numpy(), -1)
            stays = np.cumsum(cover[:-1]) == 0
            totals.append(len(words))
            removed.append(int(len(words) - stays.sum()))
            digests.append(hashlib.sha256(b" ".join([w for w, s in zip(words, stays.tolist(), strict=True) if s])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["id", "n_words", "n_removed", "kept_sha256"],
        )


def repeated_places(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, begin, end) of the repeated passages, in words, of ``rows``
    (row long, text); one place may be given in overlapping pieces."""
    gram = min(GRAM, window)
    sc = rows.sparkSession.sparkContext
    text = bounded_batches(rows).select("text")
    anchors = staged(
        text.mapInArrow(_anchors(window, gram), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1"),
        "repeat_anchors",
    )
    twice, hot = keyset.bitmap(anchors), keyset.bitmap(anchors.where(F.col("n") > HOT))
    segments = rows.select("row", "text").mapInArrow(
        _segment_rows(sc.broadcast((twice, hot)), window, gram),
        "anchor long, salt int, print long, row long, first long, words array<int>",
    )
    if hot.any():
        windows = text.mapInArrow(_hot_windows(sc.broadcast(hot), window, gram), "anchor long, print long, n long")
        recurring = windows.groupBy("anchor", "print").agg(F.sum("n").alias("n")).where("n > 1")
        salts = F.explode(F.sequence(F.lit(1), F.lit(SALTS))).alias("salt")
        segments = segments.unionByName(recurring.select("anchor", salts, "print"), allowMissingColumns=True)
    # Null words (windows known to recur) sort first.
    dealt = segments.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", F.col("words").isNotNull())
    return dealt.mapInArrow(_shard(window), "row long, begin long, end long")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept_sha256."""
    rows = staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")),
        "repeat_rows",
    )
    places = repeated_places(rows, window).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("places"))
    joined = rows.join(places, "row", "left").select("id", "text", "places")
    kind = rows.schema["id"].dataType.simpleString()
    kept = joined.mapInArrow(_kept, f"id {kind}, n_words long, n_removed long, kept_sha256 string")
    return kept.withColumnRenamed("id", id_col)


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))


SQL = rf"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), w as (
  select r, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) as h
  from (select r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from d)),
again as (select h from w group by h having count(*) > 1),
hits as (select r, i, true as hit from w where h in (select h from again)),
t as (select r, unnest(ws) as word, generate_subscripts(ws, 1) as i from d),
c as (
  select r, i, word, coalesce(bool_or(hit) over (partition by r order by i rows between {WINDOW - 1} preceding and current row), false) as gone
  from t left join hits using (r, i)),
k as (
  select r, count(*) as n_words, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept
  from c group by r)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (r)
"""
