"""Operator 3, n-gram Jaccard join on 5-word shingles.

Two documents link when 100 * |intersection| >= 75 * |union| of their shingle
sets. The result is each document's component under links.

1. Describe: one pass hashes the shingles of every whole text, leaving per
   document the size and a 128-bit digest of its set, and per task how many
   sets hold a shingle of each of SKETCH hash classes. Documents with equal
   sets are one class from here on (they link with all that one links with).
2. Rare first: the class counts order all shingles (rare classes first, then
   by hash). The sketch has a fixed size and is broadcast. A class holds many
   shingles of a large input, so what one of them adds does not show: the
   prefixes of this order are counted by shingle, and the most frequent ones
   (OFTEN at most, each in more than SMALL / 8 prefixes) come last.
3. Prefixes: a set of n shingles posts its n - ceil(0.75 n) + 1 first ones
   with their positions, once for a class of equal sets as far as a bitmap of
   the classes' ids tells. Two linked sets share a posted shingle, and their
   first shared one satisfies the length filter (n_small >= 0.75 n_large) and
   the positional filter (what is left after it still allows the overlap
   that the link needs).
4. Candidates. The posted prefixes of a linked pair share not one shingle but
   at least overlap - ceil(0.75 n_large) + 1 of them (the part of a prefix
   that the unshared shingles cannot fill), for sizes alike a tenth of n. A
   shingle posted by at most SMALL documents gives its pairs, which are
   counted per pair and kept when they reach that number; it gives at most
   SMALL / 2 pairs per posting. A more frequent one joins neighbours, ordered
   by n, into one cluster as far as both filters allow: one row per posting.
   A shingle of a frequent class is split by salt, and the heads of its parts
   are joined. If the first posted shingle that a linked pair shares is a
   frequent one, its cluster has both; if not, the pair is counted, and what
   it lacks of the number are frequent ones: no more than either posted.
5. Verification: the texts of a cluster meet once, in blocks. A pair whose
   documents are already connected needs no test; the others pass the length
   filter and the suffix filter (set sizes within fixed ranges of the hash
   bound the overlap) before their sets are intersected. Every pair is
   tested at most once in a block, and only links that connect something new
   are written, so a group of copies leaves one link per member.
   Clusters of more than one block: first neighbouring blocks, then what is
   not in the cluster's largest component is tested against all the rest.

Steps 4 and 5 lose no link: a linked pair shares a cluster, and there the two
are either connected through verified links or tested themselves.

Shingles are compared by 64-bit hash. Two different shingles of one pair of
documents collide with a chance of about n * n / 2**64.

Defined cases: null and empty texts and texts of white space have an empty
set, link with nothing, and are components of their own; fewer than five
words are one shingle; repeated rows are in one component; rows with a null
id link through an equal set only (their component is null when no row with
an id has that set) and are never the smallest; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import BROADCAST_ROWS, HOT_SHARE, bounded_batches, keep_ids, skew_lookup, staged
from tallyflow.llm.components import components
from tallyflow.llm.keyset import bitmap, may_hold
from tallyflow.llm.textarrays import mix, shingle_sets, slices, texts

SKETCH_BITS = 18
SKETCH = 1 << SKETCH_BITS
#: Documents and shingles of a cluster that one block holds, about.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1 << 20
#: Salts of a frequent class, for each 1 / HOT_SHARE of all shingles.
HOT_SALTS = 4
#: Documents up to which a posted shingle gives its pairs.
SMALL = 64
#: Frequent shingles that are ordered by their own count, at most (broadcast).
OFTEN = 1 << 19
#: The first rank of these; classes rank below.
_LAST = 192
_U = np.uint64
_KEY = _U(0x9E6C63D0876A9A4B)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, digest) per text, then this task's sketch as (class, count)."""
    sketch = np.zeros(SKETCH, np.int64)

    def rows(ids, n, d1, d2, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), kind, np.int8)), ids, pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())],
            ["kind", "id", "n", "d1", "d2"],
        )

    for batch in batches:
        data, offsets = texts(batch.column(1))
        n, d1, d2 = (np.zeros(batch.num_rows, np.uint64) for _ in range(3))
        for i, _, b, at in slices(data, offsets):
            sets = list(shingle_sets(b, at))
            for k, s in enumerate(sets, i):
                n[k], d1[k], d2[k] = _digest(s)
            sketch += np.bincount((np.concatenate(sets) >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=SKETCH)
        yield rows(batch.column(0), n.view(np.int64), d1.view(np.int64), d2.view(np.int64), 0)
    at = np.flatnonzero(sketch)
    if len(at):
        none = np.zeros(len(at), np.int64)
        yield rows(pa.array(at), sketch[at], none, none, 1)


def _digest(s: np.ndarray) -> tuple[int, int, int]:
    """Size and two sums of a set of hashes."""
    return len(s), int(s.sum(dtype=np.uint64)), int(mix(s ^ _KEY).sum(dtype=np.uint64))


def _prefixes(batches: Iterator[pa.RecordBatch], sent) -> Iterator[tuple]:
    """(ids, sizes, prefixes) of runs of sets of the rows (id, text, key)."""
    rank, bits, often, level = sent
    held = np.zeros(SKETCH, bool)  # classes with a shingle of ``often``
    held[_class(often)] = True
    seen: set = set()  # sets this task has posted: copies post once
    for batch in batches:
        mine = pa.array(may_hold(bits, batch.column(2).to_numpy().view(np.uint64)))
        batch = batch.filter(mine)
        data, offsets = texts(batch.column(1))
        ids = batch.column(0).to_numpy()
        for i, _, b, at in slices(data, offsets):
            tokens, sizes, rows = [], [], []
            for k, s in enumerate(shingle_sets(b, at), i):
                d = _digest(s)
                if not d[0] or d in seen:
                    continue
                seen.add(d)
                size = d[0]
                of = (s >> _U(64 - SKETCH_BITS)).astype(np.int64)
                order = (rank[of].astype(np.uint64) << _U(56)) | (s >> _U(8))
                if len(often):
                    maybe = np.flatnonzero(held[of])
                    place = np.minimum(np.searchsorted(often, order[maybe]), len(often) - 1)
                    hit = often[place] == order[maybe]
                    order[maybe[hit]] = (level[place[hit]].astype(np.uint64) << _U(56)) | (s[maybe[hit]] >> _U(8))
                order.sort()
                tokens.append(order[: size + (-75 * size // 100) + 1])
                sizes.append(size)
                rows.append(k)
            if rows:
                yield ids[rows], np.array(sizes, np.int64), tokens


def _class(token: np.ndarray) -> np.ndarray:
    """The hash class of tokens: it is in the bits below the rank."""
    return ((token << _U(8)) >> _U(64 - SKETCH_BITS)).astype(np.int64)


def _tokens(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, tokens in _prefixes(batches, sent.value):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64))], ["token"])

    return run


def _post(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts, *order = sent.value
        for ids, sizes, tokens in _prefixes(batches, order):
            length = np.array([len(t) for t in tokens])
            token = np.concatenate(tokens)
            n = np.repeat(sizes, length)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length) + 1
            doc = np.repeat(ids, length)
            # The largest partner that both filters allow.
            reach = np.minimum(n * 100 // 75, 7 * (n - pos + 1) // 3 - n)
            s = salts[_class(token)]
            salt = np.where(s > 0, (mix(doc.astype(np.uint64)) % np.maximum(s, 1).astype(np.uint64)).astype(np.int64), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(doc), pa.array(n.astype(np.int32)), pa.array(reach.astype(np.int32))],
                ["token", "salt", "doc", "n", "reach"],
            )

    return run


class _Union:
    def __init__(self, labels):
        first: dict = {}
        self.up = [first.setdefault(x, k) for k, x in enumerate(labels)]

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _ranges(s: np.ndarray) -> np.ndarray:
    """How many hashes lie in each of 64 fixed ranges."""
    return np.bincount((s >> _U(58)).astype(np.int64), minlength=64)


def links(docs: np.ndarray, sets: list[np.ndarray], labels) -> list[tuple[int, int]]:
    """Links that connect the labels: pairs not connected yet are tested."""
    known = _Union(labels)
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    size = np.array([len(sets[k]) for k in order])
    shape = np.array([_ranges(sets[k]) for k in order])
    root = np.array([known.find(k) for k in order])
    out = []
    for y in range(1, len(order)):
        k, n = order[y], int(size[y])
        low = int(np.searchsorted(size, -(-75 * n // 100)))
        # Suffix filter: |x| + |y| - 2 * overlap is at least the ranges' difference.
        need = -(-3 * (size[low:y] + n) // 7)
        apart = np.abs(shape[low:y] - shape[y]).sum(axis=1)
        maybe = low + np.flatnonzero((apart <= size[low:y] + n - 2 * need) & (root[low:y] != root[y]))
        for x in maybe.tolist():
            if root[x] == root[y]:
                continue
            a, b = sets[order[x]], sets[k]
            found = np.searchsorted(b, a)
            same = int((b[np.minimum(found, n - 1)] == a).sum())
            if 100 * same >= 75 * (len(a) + n - same):
                out.append((int(docs[order[x]]), int(docs[k])))
                root[root == root[y]] = root[x]
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each (cluster, block); rows come sorted by them."""
    key, docs, labels, sets = None, [], [], []

    def tested():
        found = links(np.array(docs), sets, labels) if len(docs) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"]
        )

    for batch in batches:
        data, offsets = texts(batch.column(4))
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        doc, label = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for i, _, b, at in slices(data, offsets):
            for k, s in enumerate(shingle_sets(b, at), i):
                if keys[k] != key:
                    if len(docs) > 1:
                        yield tested()
                    key, docs, labels, sets = keys[k], [], [], []
                docs.append(doc[k])
                labels.append(label[k])
                sets.append(s)
    if len(docs) > 1:
        yield tested()


def _tested(blocks: DataFrame) -> DataFrame:
    """Links of ``blocks`` (cluster, block, doc, label, text), staged."""
    return staged(
        blocks.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "doc")
        .select("cluster", "block", "doc", "label", "text")
        .mapInArrow(_verify, "a long, b long"),
        "jaccard_links",
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id."""
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = staged(rows.mapInArrow(_describe, "kind byte, id long, n long, d1 long, d2 long"), "jaccard_described")
    sets = described.where("kind = 0").select("id", "n", F.concat_ws(" ", "n", "d1", "d2").alias("set"))
    # Equal sets are one class, named by its smallest id.
    classes = staged(
        sets.where("n > 0").groupBy("set").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")), "jaccard_classes"
    )
    edges = _candidates(rows, described, sets, classes)
    clusters = components(edges).withColumnRenamed("node", "doc").withColumnRenamed("label", "cluster")
    verified = _verified(rows, clusters, sets)
    label = components(verified).withColumnRenamed("node", "rep").withColumnRenamed("label", "component_id")
    named = staged(
        classes.join(label, "rep", "left")
        .select("set", F.coalesce("component_id", "rep").alias("component_id"), "rep", "rows")
        .where((F.col("rows") > 1) | (F.col("component_id") != F.col("rep")))
        .select("set", "component_id", "rows"),
        "jaccard_named",
    )
    out = skew_lookup(sets, named, "set", "rows", sets.count(), F.col("id"))
    return out.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def _candidates(rows: DataFrame, described: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between class representatives whose clusters hold every pair
    that shares a posted shingle and may pass the filters."""
    spark = rows.sparkSession
    # At most SKETCH rows, whatever the input.
    counted = described.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    sketch = np.zeros(SKETCH, np.int64)
    sketch[counted["id"].to_numpy()] = counted["n"].to_numpy()
    total = max(1, int(sketch.sum()))
    rank = np.minimum(_LAST - 1, np.round(8 * np.log2(sketch + 1.0))).astype(np.uint8)
    share = sketch * HOT_SHARE / total
    salts = np.where(share > 1, np.ceil(share * HOT_SALTS), 0).astype(np.int64)
    # An id that shares its bit with a class's id posts too; see the end.
    bits = bitmap(classes.where("rep is not null").select(F.xxhash64("rep").alias("key")))
    keyed = rows.where(F.col("id").isNotNull()).select("id", "text", F.xxhash64("id").alias("key"))
    often, level = _often(keyed, spark.sparkContext.broadcast((rank, bits, np.zeros(0, np.uint64), np.zeros(0, np.uint8))))
    sent = spark.sparkContext.broadcast((salts, rank, bits, often, level))
    posted = keyed.mapInArrow(_post(sent), "token long, salt int, doc long, n int, reach int")
    bucket = Window.partitionBy("token", "salt")
    shared = staged(
        posted.withColumn("df", F.count(F.lit(1)).over(bucket)).where("df > 1 or salt >= 0"), "jaccard_shared"
    )
    is_small = (F.col("salt") < 0) & (F.col("df") <= SMALL)
    large = shared.where(~is_small)
    uncounted = staged(large.groupBy("doc").agg(F.count(F.lit(1)).alias("more")), "jaccard_uncounted")
    edges = _counted(shared.where(is_small), uncounted).unionByName(_chained(large)).distinct()
    # Tasks posted copies of a class under different ids: name it alike.
    other = staged(
        skew_lookup(
            sets.where("id is not null and n > 0"),
            classes.where("rows > 1").select("set", "rep", "rows"),
            "set", "rows", max(1, sets.count()), F.col("id"),
        ).where("rep is not null and rep != id").select("id", "rep"),
        "jaccard_copies",
    ).distinct()
    for end in ("prev", "doc"):
        edges = edges.join(other.select(F.col("id").alias(end), F.col("rep").alias(f"{end}_rep")), end, "left")
    return edges.select(F.coalesce("prev_rep", "prev").alias("a"), F.coalesce("doc_rep", "doc").alias("b")).where("a != b")


def _often(keyed: DataFrame, sent) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the class order that more than SMALL / 8 sets post, ascending,
    and the ranks that they get instead: the more sets, the later. (A set posts
    a quarter of its shingles; what is frequent is posted by more sets yet.)"""
    least = max(1, SMALL // 8)
    counted = (
        keyed.mapInArrow(_tokens(sent), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") > least).orderBy(F.desc("df"), "token").limit(OFTEN).toArrow()
    )
    token = counted["token"].to_numpy().view(np.uint64)
    level = np.minimum(255, _LAST + np.round(4 * np.log2(counted["df"].to_numpy() / least))).astype(np.uint8)
    order = np.argsort(token)
    return token[order], level[order]


def _counted(small: DataFrame, uncounted: DataFrame) -> DataFrame:
    """Pairs of small buckets that share as many posted shingles as a link
    needs (see step 4), by at least one that may be their first shared one.
    ``uncounted``: how many a document posted to other buckets."""
    before = Window.partitionBy("token").orderBy("n", "doc").rowsBetween(-(SMALL - 1), -1)
    pairs = (
        small.withColumn("earlier", F.collect_list(F.struct("n", "doc", "reach")).over(before))
        .withColumn("x", F.explode("earlier"))
        .where(F.col("x.n") * 100 >= F.col("n") * 75)
        .groupBy(F.col("x.doc").alias("prev"), "doc", F.col("x.n").alias("nx"), "n")
        .agg(
            F.count(F.lit(1)).alias("same"),
            F.max((F.col("x.reach") >= F.col("n")) & (F.col("reach") >= F.col("x.n"))).alias("first"),
        )
    )
    overlap = F.expr("(3 * (nx + n) + 6) div 7")
    need = overlap - F.expr("(75 * n + 99) div 100") + 1
    first = pairs.where("first").select("prev", "doc", (need - F.col("same")).alias("lack"))
    if uncounted.isEmpty():
        return first.where("lack <= 0").select("prev", "doc")
    few = uncounted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for end in ("prev", "doc"):
        more = uncounted.select(F.col("doc").alias(end), F.col("more").alias(f"{end}_more"))
        first = first.join(F.broadcast(more) if few else more, end, "left")
    may = F.least(F.coalesce("prev_more", F.lit(0)), F.coalesce("doc_more", F.lit(0)))
    return first.where(F.col("lack") <= may).select("prev", "doc")


def _chained(large: DataFrame) -> DataFrame:
    """Neighbours by size in large buckets, as far as the filters let a pair
    reach across them; parts of a split bucket are joined whole."""
    by = Window.partitionBy("token", "salt").orderBy("n", "doc")
    split = F.col("salt") >= 0
    chains = staged(
        large.select(
            "token", "salt", "doc", "n", F.lag("doc").over(by).alias("prev"),
            F.max("reach").over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        )
        .where(F.when(F.col("prev").isNull(), split).otherwise(split | (F.col("before") >= F.col("n"))))
        .select("token", "prev", "doc"),
        "jaccard_chains",
    )
    heads = chains.where("prev is null").select("token", "doc", F.lag("doc").over(Window.partitionBy("token").orderBy("doc")).alias("prev"))
    return chains.select("prev", "doc").unionByName(heads.select("prev", "doc")).where("prev is not null")


def _verified(rows: DataFrame, clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is linked within ``clusters``."""
    sizes = sets.select(F.col("id").alias("doc"), "n")
    known = keep_ids(sizes, clusters.select("doc"), "doc").groupBy("doc").agg(F.max("n").alias("n"))
    members = clusters.join(known, "doc")
    per = staged(
        members.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n")).select(
            "cluster", "docs",
            F.ceil(F.greatest(F.col("docs") / BLOCK_DOCS, F.col("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        ),
        "jaccard_clusters",
    )
    total = max(1, clusters.count())
    # Each cluster member's text, once; repeated rows of an id give one.
    bodies = (
        keep_ids(rows.select(F.col("id").alias("doc"), "text"), clusters.select("doc"), "doc")
        .groupBy("doc").agg(F.first("text").alias("text"))
    )
    placed = skew_lookup(clusters, per, "cluster", "docs", total, F.col("doc"))
    texts_of = staged(placed.join(bodies, "doc"), "jaccard_texts")
    chunk = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    # Chunk i is in the blocks i and i - 1: neighbours meet.
    around = F.when(F.col("blocks") <= 2, F.array(F.lit(0))).otherwise(F.array(chunk, F.pmod(chunk - 1, F.col("blocks")).cast("int")))
    first = _tested(texts_of.withColumn("block", F.explode(around)).withColumn("label", F.col("doc")))
    large = texts_of.where("blocks > 2")
    if large.isEmpty():
        return first
    found = components(first)
    parts = staged(
        large.drop("text").join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc")),
        "jaccard_parts",
    )
    of = parts.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("docs"))
    largest = of.groupBy("cluster").agg(F.max_by("label", F.struct("docs", "label")).alias("main"), F.sum("docs").alias("docs"))
    marked = staged(
        skew_lookup(parts, staged(largest, "jaccard_largest"), "cluster", "docs", total, F.col("doc")), "jaccard_marked"
    )
    rest = marked.where("label != main")
    more = staged(
        rest.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"))
        .withColumn("groups", F.ceil(F.col("docs") / BLOCK_DOCS).cast("int")), "jaccard_rest"
    )
    if more.isEmpty():
        return first
    # Block (i, j): chunk i of the cluster and part j of what is left over.
    dealt = skew_lookup(marked, more.select("cluster", "groups", "docs"), "cluster", "docs", total, F.col("doc")).where("groups is not null")
    part = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("groups")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("groups") - 1), lambda j: chunk * F.col("groups") + j)
    mine = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i * F.col("groups") + part)
    blocks = dealt.withColumn(
        "block", F.explode(F.when(F.col("label") == F.col("main"), every).otherwise(F.array_union(every, mine)))
    )
    second = _tested(blocks.join(large.select("doc", "text"), "doc"))
    return first.unionByName(second)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each
    component the row with the smallest id stays. Rows with a null id and
    texts without words stay."""
    found = jaccard_components(docs)
    away = staged(found.where("doc_id != component_id").select("doc_id").distinct(), "jaccard_away")
    return keep_ids(docs, away, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
