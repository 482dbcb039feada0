"""Operator 5, benchmark decontamination by q-gram lemma filtering.

A benchmark item of m bytes occurs in a document when some passage of it is
within ``budget(m)`` edits (insert, delete, replace) of the item. Both texts
are normalised first: A-Z lower-cased, every run of ASCII characters that are
neither letters nor digits one space, other characters as they are (UTF-8).

The q-gram lemma: an occurrence with at most k edits shares at least
m + 1 - (k + 1) * q of the item's q-grams, and its shared q-grams lie on at
most 2 k + 1 neighbouring diagonals (place in the document minus place in the
item). So, per document and item, shared q-grams are counted in bands of
4 k + 2 diagonals that overlap by half, and a band that meets the bound is
verified by a banded alignment of the whole item against the document: the
band's diagonals are computed, widened by k on both sides.

The items are sent to the tasks in blocks of at most ``block_bytes`` of text
(a benchmark of any size takes as many passes as it has blocks); a bit table
of their q-grams passes over most places of a document at once. Documents
are scanned whole, piece by piece with an overlap, and never shuffled. The
places that a piece shares with the items are listed for a range of items, and
within one item for a range of the piece's places, such that at most ``HITS``
are in memory however often a q-gram occurs on both sides.

Defined cases: null and empty documents and items occur nowhere; an item of
fewer than Q bytes after normalisation has no q-gram, and does not count as
evidence; repeated documents and items get rows of their own; of equal
distances in a band the first end is reported; of overlapping passages of
one item the one with the fewest edits is; empty tables give an empty result; other
columns are not read. ``clean`` judges a row by its text, so rows with null or
repeated ids are kept or removed each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches, keep_ids, staged
from tallyflow.llm.textarrays import texts

Q = 8  # a q-gram is one 64-bit number
#: Edits allowed, as a share of the item's bytes.
EDITS = 0.08
#: Bytes of benchmark text per pass.
BLOCK_BYTES = 8 << 20
#: Bytes of a document scanned at once.
PIECE = 1 << 19
#: Shared q-grams (place in the document, place in an item) listed at once.
HITS = 1 << 20

_U = np.uint64
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_BITS = 22


def normalise(b: np.ndarray) -> np.ndarray:
    """Folded bytes without repeated, leading or trailing spaces."""
    f = _FOLD[b]
    space = f == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    f = f[keep]
    if len(f) and f[0] == 32:
        f = f[1:]
    return f[:-1] if len(f) and f[-1] == 32 else f


def budget(m: int) -> int:
    """Edits allowed for m bytes: EDITS * m, as far as the lemma still asks
    for a shared q-gram."""
    return max(0, min(int(EDITS * m), m // Q - 1))


def _grams(b: np.ndarray) -> np.ndarray:
    """The 64-bit number of the Q bytes at each place."""
    if len(b) < Q:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(b, Q).copy().view("<u8").ravel()


def _slot(g: np.ndarray) -> np.ndarray:
    return ((g * _U(0x9E3779B97F4A7C15)) >> _U(64 - _BITS)).astype(np.int64)


class Items:
    """A block of benchmark items, with an index of their q-grams."""

    def __init__(self, ids: list, bodies: list[bytes]):
        kept = [(i, n) for i, t in zip(ids, bodies, strict=True) if len(n := normalise(np.frombuffer(t, np.uint8))) >= Q]
        self.ids = [i for i, _ in kept]
        self.bytes = [n for _, n in kept]
        self.size = np.array([len(n) for n in self.bytes], np.int64)
        self.k = np.array([budget(len(n)) for n in self.bytes], np.int64)
        self.need = self.size + 1 - (self.k + 1) * Q
        grams = [_grams(n) for n in self.bytes]
        g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(x) for x in grams]) if grams else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(x)) for x in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(g, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.start = np.unique(g[order], return_index=True)
        self.end = np.append(self.start[1:], len(g)) if len(g) else self.start
        # Ascending: the q-gram's number, then the item.
        self.key = np.repeat(np.arange(len(self.grams)), self.end - self.start) * len(self.size) + self.item
        self.table = np.zeros(1 << _BITS, bool)
        self.table[_slot(self.grams)] = True

    def shared(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``b`` whose q-gram is in an item, and its number."""
        g = _grams(b)
        at = np.flatnonzero(self.table[_slot(g)]) if len(self.grams) else np.zeros(0, np.int64)
        found = np.minimum(np.searchsorted(self.grams, g[at]), max(0, len(self.grams) - 1))
        real = self.grams[found] == g[at] if len(at) else np.zeros(0, bool)
        return at[real], found[real]

    def ranges(self, found: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of items with at most HITS shared q-grams each, or one item."""
        everything = [(0, len(self.size))]
        if int((self.end[found] - self.start[found]).sum()) <= HITS:
            return everything
        g, count = np.unique(found, return_counts=True)
        times = self.end[g] - self.start[g]
        row = np.repeat(self.start[g] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        per_item = np.bincount(self.item[row], weights=np.repeat(count, times), minlength=len(self.size))
        cuts, held = [0], 0.0
        for i, n in enumerate(per_item.tolist()):
            if held and held + n > HITS:
                cuts.append(i)
                held = 0.0
            held += n
        return list(zip(cuts, [*cuts[1:], len(self.size)], strict=True))

    def hits(self, at: np.ndarray, found: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, place in b, place in the item) of the q-grams that ``b``
        shares with the items low to high - 1, at most HITS (or one place's) at
        a time."""
        n = len(self.size)
        start = np.searchsorted(self.key, found * n + low)
        times = np.searchsorted(self.key, found * n + high) - start
        total = np.cumsum(times)
        x = 0
        while x < len(at):
            before = int(total[x - 1]) if x else 0
            y = max(x + 1, int(np.searchsorted(total, before + HITS, "right")))
            t = times[x:y]
            row = np.repeat(start[x:y] - (total[x:y] - t - before), t) + np.arange(int(total[y - 1]) - before)
            if len(row):
                yield self.item[row], np.repeat(at[x:y], t), self.place[row]
            x = y


def align(item: np.ndarray, b: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best passage of ``b`` on the diagonals low
    to high (place in b minus place in the item) within k edits of the item.

    Row i of the table holds the edits of item[:i] against passages that end
    at i + low .. i + high; only those diagonals are kept."""
    width = high - low + 1
    far = k + 1
    d = np.arange(low, high + 1)
    cost = np.where((d >= 0) & (d <= len(b)), 0, far)
    start = d.copy()
    span = np.arange(width)
    for i, c in enumerate(item.tolist(), 1):
        end = d + i  # passage ends before this place of b
        inside = (end >= 1) & (end <= len(b))
        same = np.zeros(width, bool)
        same[inside] = b[end[inside] - 1] == c
        best = np.where(inside, cost + ~same, far)
        came = start
        # An item byte without a partner: from the next diagonal of row i - 1.
        skip = np.append(cost[1:] + 1, far)
        skip = np.where((end >= 0) & (end <= len(b)), skip, far)
        better = skip < best
        best = np.where(better, skip, best)
        came = np.where(better, np.append(start[1:], 0), came)
        # Bytes of b without a partner: from lower diagonals of this row.
        low_at = np.minimum.accumulate(best * width - span * width + span)
        run = low_at // width + span
        extra = run < best
        from_at = low_at % width
        came = np.where(extra & inside, came[from_at], came)
        best = np.where(extra & inside, run, best)
        cost, start = np.minimum(best, far), came
        if cost.min() > k:
            return None
    at = int(np.argmin(cost))
    return (int(cost[at]), int(start[at]), int(d[at] + len(item))) if cost[at] <= k else None


def unedited(item: np.ndarray, b: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """The first passage equal to the item, if there is one: no alignment can
    be better."""
    first = max(0, low)
    at = b[first : max(first, high + len(item))].tobytes().find(item.tobytes())
    return None if at < 0 else (0, first + at, first + at + len(item))


def _bands(items: Items, places: np.ndarray, grams: np.ndarray, low: int, high: int, shift: int) -> Iterator[tuple[int, int]]:
    """(item, lowest diagonal) of the bands that meet the bound, of the items
    low to high - 1."""
    span = 2 * shift + 4
    longest = int(items.size[low:high].max())
    key, n, slices = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for item, place, own in items.hits(places, grams, low, high):
        slices += 1
        # Bands overlap by half, so 2 k + 1 neighbouring diagonals share one.
        band = item * span + (place - own + shift) // (2 * items.k[item] + 1)
        # The bound holds for q-grams of the item, however often each is met.
        met = np.unique(np.concatenate((band, band + 1)) * longest + np.concatenate((own, own)))
        new, times = np.unique(met // longest, return_counts=True)
        key, at = np.unique(np.concatenate((key, new)), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate((n, times))).astype(np.int64)
    which = key // span
    for at in np.flatnonzero(n >= items.need[which]).tolist():
        i = int(which[at])
        h = int(2 * items.k[i] + 1)
        edge = int(key[at] % span - 1) * h - shift
        if slices == 1:
            yield i, edge
            continue
        # Slices may have met the same q-gram: count it once.
        x, y = np.searchsorted(places, [edge, edge + 2 * h + int(items.size[i])])
        met = np.zeros(int(items.size[i]), bool)
        for _, place, own in items.hits(places[x:y], grams[x:y], i, i + 1):
            met[own[(place - own >= edge) & (place - own < edge + 2 * h)]] = True
        if met.sum() >= items.need[i]:
            yield i, edge


def occurrences(b: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(item, edits, start, end) in the normalised document ``b``."""
    if not len(items.size):
        return []
    reach = int((items.size + 2 * items.k).max()) + Q
    out: list[tuple[int, int, int, int]] = []
    step = max(PIECE, 2 * reach)
    for at in range(0, max(1, len(b)), step):
        piece = b[at : at + step + reach]
        places, grams = items.shared(piece)
        for low, high in items.ranges(grams) if len(places) else ():
            for i, edge in _bands(items, places, grams, low, high, len(piece) + reach):
                k, h = int(items.k[i]), int(2 * items.k[i] + 1)
                found = unedited(items.bytes[i], piece, edge - k, edge + 2 * h - 1 + k)
                found = found or align(items.bytes[i], piece, edge - k, edge + 2 * h - 1 + k, k)
                if found:
                    out.append((i, at + found[1], at + found[2], found[0]))
    # Of overlapping passages of an item, the one with the fewest edits.
    best: list[tuple[int, int, int, int]] = []
    for o in sorted(set(out)):
        if best and best[-1][0] == o[0] and o[1] < best[-1][2]:
            if o[3] < best[-1][3]:
                best[-1] = o
        else:
            best.append(o)
    return [(i, edits, start, end) for i, start, end, edits in best]


def _find(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*sent.value)
        for batch in batches:
            data, offsets = texts(batch.column(1))
            rows = []
            for k, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if y - x >= Q:
                    rows += [(k, *o) for o in occurrences(normalise(data[x:y]), items)]
            if rows:
                k, i, edits, start, end = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(k)), pa.array([items.ids[x] for x in i], pa.int64()), pa.array(edits, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["id", "item_id", "edits", "start", "end"],
                )

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """The benchmark in blocks that the driver holds one at a time."""
    ids, bodies, size = [], [], 0
    for r in items.toLocalIterator():
        ids.append(r["item_id"])
        bodies.append(r["text"].encode())
        size += len(bodies[-1])
        if size >= block_bytes:
            yield ids, bodies
            ids, bodies, size = [], [], 0
    if ids:
        yield ids, bodies


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per occurrence: id_col, item_id, edits, start, end (byte places
    in the normalised document)."""
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item_id long, edits int, start long, end long"
    found = None
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    for block in _blocks(items, block_bytes):
        part = staged(rows.mapInArrow(_find(docs.sparkSession.sparkContext.broadcast(block)), schema), "decontamination")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("id", id_col)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no item occurs in. Rows are told
    by their text (its SHA-256), so a contaminated row without an id goes and a
    clean row that shares a contaminated row's id stays."""
    key = "_clean_key"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    keyed = docs.withColumn(key, F.sha2("text", 256))
    away = staged(contaminated(keyed, benchmark, id_col=key).select(key).distinct(), "decontamination_away")
    return keep_ids(keyed, away, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
