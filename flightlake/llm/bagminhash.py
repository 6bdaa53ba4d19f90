"""Operator 3: near duplicates by BagMinHash signatures, bands and exact verification.

A text is the multiset of its runs of five words (a shorter text: one run). Its
weighted-Jaccard signature comes from hierarchical Poisson processes: a shingle's
weight axis is cut into [0,1), [1,2), [2,4), [4,8), ..., each with a process of its own of a
rate equal to its length, whose points carry a time, a slot and, by halving, one of the
discrete weight steps. A slot keeps its earliest point below the shingle's weight, so two
texts agree in a slot with a chance of their multisets' overlap. Points are drawn only up to
the time by which all slots of the text are filled.

Equal texts are one node. Nodes with an equal band are candidates, on two levels (LEVELS):

1. Bands of 6 slots. In each bucket the other nodes are verified (exact overlap of the multisets, at least
   `similarity`) against its hub, the node whose buckets are the largest. Where a group grew from one
   text, that text is a hub of most of its buckets, so a group of n costs about n pairs.
2. In buckets whose nodes are not all one component by then, every pair of different components is verified if the
   bucket holds at most `limit` nodes. The nodes of larger ones go on to
3. the next level: signatures of more slots and bands of 20, in which texts that are alike by less
   than 0.8 meet far more rarely. There every pair of different components that shares a band is verified.

So no bucket is capped, and the pairs of a crowd of n texts a little less than 0.8 alike grow far less than as n * n. A class
is a component. A pair at 0.8 shares a band with a chance of 0.9999 on the first level and 0.92 on the second
(at 0.85: 0.9998); a link in a crowd is also found through the hub or any chain of others.

Null and empty texts (no word) are classes of their own; documents of the same text are one class, ties between them have no order;
rows with the same doc_id and other texts are nodes of their own; a very long text is one node, signed
and verified whole; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.components import components
from flightlake.llm.runtime import bounded_batches, id_and_text, stored

U64 = np.uint64


def shingles(buf: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), sorted by text; texts of 1 to n-1 words have one shingle of all words."""
    start, end, doc = T.words(buf, off)
    word = T.span_hash(T.prefix_hash(buf), start, end)
    h, at = T.ngram_hash(word, doc, n)
    doc_of = doc[at]
    sizes = np.bincount(doc, minlength=len(off) - 1)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = np.array([T.mix64(np.bitwise_xor.reduce(T.mix64(word[f:f + sizes[d]] + np.arange(1, sizes[d] + 1, dtype=U64)), keepdims=True))[0] for d, f in zip(short, first)], U64)
        h, doc_of = np.concatenate((h, whole)), np.concatenate((doc_of, short))
    order = np.lexsort((h, doc_of))
    h, doc_of = h[order], doc_of[order]
    if not len(h):
        return doc_of, h, doc_of
    new = np.append(True, (h[1:] != h[:-1]) | (doc_of[1:] != doc_of[:-1]))
    at = np.flatnonzero(new)
    return doc_of[at], h[at], np.diff(np.append(at, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> U64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """docs x slots: the earliest point in each slot (its time); infinite for texts without shingles."""
    sig = np.full(docs * slots, np.inf)
    if not len(doc):
        return sig.reshape(docs, slots)
    # a row for each dyadic interval of the weight axis that the shingle's weight reaches into
    levels = np.where(count > 1, np.floor(np.log2(np.maximum(count - 1, 1))).astype(np.int64) + 1, 0) + 1
    of = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    rate = np.maximum(low, 1)
    seed = T.mix64(shingle[of] + T.mix64(level.astype(U64) + U64(77)))
    weight, text = count[of], doc[of]
    total = np.bincount(doc, count, minlength=docs)
    limit = np.where(total > 0, slots * (np.log(slots) + 3.0) / np.maximum(total, 1), 0.0)
    turn = np.zeros(len(of), U64)
    state = T.mix64(seed)
    time = -np.log(_unit(state)) / rate
    live = np.arange(len(of))
    unfilled = total > 0
    while True:
        now = live[time[live] <= limit[text[live]]]
        while len(now):
            extra = T.mix64(state[now] ^ U64(0xA5A5A5A5A5A5A5A5))
            slot = ((extra >> U64(32)) * U64(slots)) >> U64(32)
            step = low[now] + ((extra & U64(0xFFFFFFFF)) * rate[now].astype(U64) >> U64(32)).astype(np.int64)
            hit = step < weight[now]
            np.minimum.at(sig, text[now[hit]] * slots + slot[hit].astype(np.int64), time[now[hit]])
            turn[now] += U64(1)
            state[now] = T.mix64(seed[now] + turn[now] * U64(0x9E3779B97F4A7C15))
            time[now] -= np.log(_unit(state[now])) / rate[now]
            now = now[time[now] <= limit[text[now]]]
        unfilled = np.isinf(sig.reshape(docs, slots)).any(1) & (total > 0)
        if not unfilled.any():
            return sig.reshape(docs, slots)
        limit = np.where(unfilled, limit * 2, 0.0)
        live = live[unfilled[text[live]]]


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """docs x bands."""
    docs, slots = sig.shape
    bits = sig.view(U64).reshape(docs, slots // rows, rows)
    h = np.zeros(bits.shape[:2], U64) + np.arange(1, slots // rows + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    for k in range(rows):
        h = T.mix64(h ^ bits[:, :, k]).reshape(h.shape)
    return h


SIGNED = "doc_id long, text_key binary, n long, bands array<long>"


def signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per document: the key of its text, its number of shingles and its band hashes (none without words)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, buf, off in T.text_blocks(b.column(1)):
                size = len(off) - 1
                doc, h, count = shingles(buf, off, n)
                total = np.bincount(doc, count, minlength=size).astype(np.int64)
                hashes = band_hashes(signatures(doc, h, count, size, bands * rows), rows).view(np.int64)
                offsets = np.concatenate(([0], np.cumsum(np.where(total > 0, bands, 0)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[total > 0].ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, size), b.column(2).slice(first, size), pa.array(total), lists], ["doc_id", "text_key", "n", "bands"])

    return docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("text_key")).mapInArrow(sign, SIGNED)


def overlap(a: pa.Array, b: pa.Array, n: int) -> np.ndarray:
    """Weighted Jaccard of the shingle multisets of a's and b's texts, row by row."""
    out = np.zeros(len(a))
    for first, buf, off in T.text_blocks(a):
        size = len(off) - 1
        doc_a, h_a, c_a = shingles(buf, off, n)
        parts = list(T.text_blocks(b.slice(first, size), 1 << 62))
        doc_b, h_b, c_b = shingles(parts[0][1], parts[0][2], n)
        doc, h, c = np.concatenate((doc_a, doc_b)), np.concatenate((h_a, h_b)), np.concatenate((c_a, c_b))
        order = np.lexsort((h, doc))
        doc, h, c = doc[order], h[order], c[order]
        both = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1]))
        shared = np.bincount(doc[both], np.minimum(c[both], c[both + 1]), minlength=size)
        total = np.bincount(doc, c, minlength=size)
        out[first:first + size] = shared / np.maximum(total - shared, 1)
    return out


def verified(pairs: DataFrame, texts: DataFrame, n: int, similarity: float) -> DataFrame:
    """The pairs (pivot, node) whose texts overlap by at least similarity."""
    with_texts = (pairs.join(texts.select(F.col("node"), F.col("text").alias("text_a")), "node")
                  .join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("text_b")), "pivot"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array(overlap(b.column("text_a"), b.column("text_b"), n) >= similarity - 1e-12)
            yield b.select(["x", "y"]).filter(keep)

    return with_texts.select(F.col("pivot").alias("x"), F.col("node").alias("y"), "text_a", "text_b").mapInArrow(check, "x long, y long")


def of_node(roots: DataFrame, node: str, root: str) -> DataFrame:
    return roots.select(F.col("node").alias(node), F.col("root").alias(root))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links: only the links between the old roots are contracted."""
    between = (links.join(of_node(roots, "x", "rx"), "x", "left").join(of_node(roots, "y", "ry"), "y", "left")
               .select(F.coalesce("rx", "x").alias("x"), F.coalesce("ry", "y").alias("y")))
    new = stored(components(between), "bag-merge")
    moved = roots.join(of_node(new, "root", "new_root"), "root", "left").select("node", F.coalesce("new_root", "root").alias("root"))
    return moved.unionByName(new.join(roots, "node", "left_anti").select("node", "root"))


#: slots of a band, bands, and the nodes of a bucket up to which all its pairs are verified on this level
LEVELS: tuple[tuple[int, int, int | None], ...] = ((6, 32, 4), (20, 220, None))

BANDED = "node long, n long, bands array<long>"


def banded(texts: DataFrame, n: int, rows: int, bands: int) -> DataFrame:
    """(node, n, bands) of nodes with their texts, on another level than the first."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, buf, off in T.text_blocks(b.column(2)):
                size = len(off) - 1
                hashes = band_hashes(signatures(*shingles(buf, off, n), size, bands * rows), rows).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * bands), pa.array(hashes.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, size), b.column(1).slice(first, size), lists], ["node", "n", "bands"])

    return texts.select("node", "n", "text").mapInArrow(sign, BANDED)


def buckets(signed_nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, size) of the buckets that hold more than one node."""
    members = signed_nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(sizes, "bucket")


def hub_pairs(shared: DataFrame, near: Column) -> DataFrame:
    """(pivot, node): each bucket's nodes against its hub."""
    degree = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = shared.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node", "n")).alias("h"))
    stars = shared.join(hubs.select("bucket", F.col("h.node").alias("pivot"), F.col("h.n").alias("pivot_n")), "bucket")
    return stars.where("pivot <> node").where(near).select("pivot", "node").distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8, n: int = 5, levels: tuple = LEVELS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, text_key, class_id (least doc_id of its class), class_docs, is_first.

    is_first marks one row of each class (for equal doc_ids the least text key).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = id_and_text(docs, id_col, text_col)
    rows, bands, _ = levels[0]
    sign = stored(signed(source, n, bands, rows), "bag-signed")
    # one node for each text with words
    nodes = stored(sign.where("n > 0").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "bag-nodes")
    shared = stored(buckets(nodes), "bag-buckets")
    near = F.least("n", "pivot_n") >= F.lit(similarity) * F.greatest("n", "pivot_n")     # a bound on the overlap
    wanted = shared.select("node").distinct().join(nodes.select("node", "n", "doc_id", "text_key"), "node")
    same = F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.unhex(F.md5("text")) == F.col("w.text_key"))
    texts = stored(source.alias("s").join(wanted.alias("w"), same).select("node", "n", "text").dropDuplicates(["node"]), "bag-texts")
    roots = stored(components(stored(verified(hub_pairs(shared, near), texts, n, similarity), "bag-stars")), "bag-roots")
    for level, (_, _, limit) in enumerate(levels):
        placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", F.col("node")))
        apart = placed.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
        opened = stored(placed.join(apart.select("bucket"), "bucket"), f"bag-open-{level}")
        few = opened if limit is None else opened.where(F.col("size") <= limit)
        pivot = few.select("bucket", *[F.col(c).alias(f"pivot{x}") for c, x in (("node", ""), ("n", "_n"), ("root", "_root"))])
        pairs = (few.join(pivot, (few["bucket"] == pivot["bucket"]) & (F.col("pivot") < F.col("node")) & (F.col("pivot_root") != F.col("root")) & near)
                 .select("pivot", "node").distinct())
        found = stored(verified(pairs, texts, n, similarity), f"bag-links-{level}")
        if not found.isEmpty():
            roots = stored(merged(roots, found), f"bag-roots-{level}")
        if limit is None:
            break
        crowd = opened.where(F.col("size") > limit).select("node").distinct()
        if level + 1 == len(levels) or crowd.isEmpty():
            break
        rows, bands, _ = levels[level + 1]
        shared = stored(buckets(stored(banded(texts.join(crowd, "node"), n, rows, bands), f"bag-signed-{level + 1}")), f"bag-buckets-{level + 1}")
    # classes of all documents; texts without words stay alone
    rooted = nodes.select("text_key", "node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", F.col("node")))
    firsts = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("f"))
    classes = rooted.join(firsts, "root").select("text_key", "root", F.col("f.doc_id").alias("first_id"), F.col("f.text_key").alias("first_key"))
    docs_of = sign.where("n > 0").select("doc_id", "text_key").join(classes, "text_key")
    sizes = docs_of.groupBy("root").agg(F.count("*").alias("class_docs"))
    grouped = docs_of.join(sizes, "root").select(
        "doc_id", "text_key", F.col("first_id").alias("class_id"), "class_docs",
        (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))).alias("is_first"))
    alone = sign.where("n = 0").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_docs"), F.lit(True).alias("is_first"))
    return grouped.unionByName(alone)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each class, all columns kept, whatever their names."""
    firsts = stored(near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("is_first").groupBy(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.count("*").alias("rows")), "bag-firsts")
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    # the row travels as one value, so its columns can't clash with these
    packed = docs.select(F.col(id_col).cast("long").alias("own_id"), key.alias("own_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = packed.join(firsts.select("id", "key"), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")), "left_semi")
    if not firsts.where("rows > 1").isEmpty():      # rows with the same doc_id and text
        kept = kept.dropDuplicates(["own_id", "own_key"])
    return kept.select("row.*")
