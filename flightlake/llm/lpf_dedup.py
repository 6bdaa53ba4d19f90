"""Operator 5: removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of `length` bytes that covers it also starts in a document
with a smaller id. Sorting all suffixes of a corpus would move each text many
times over, so suffixes are sorted only where two documents can share such a string:

1. Every window of `length` bytes holds an anchor, the smallest hash of its
   `gram`-byte strings (winnowing): equal windows have equal anchors at equal places. A
   chunk of documents asks, once for each anchor and context (all bytes of the windows
   around it), the bucket that owns the anchor.
2. A context that a smaller document also has is covered whole. An anchor with
   several contexts needs its windows compared: each context is sent once, by its
   least document.
3. A bucket sorts the suffixes of its contexts to a depth of `length` bytes (prefix
   doubling), and takes for each the nearest suffixes before and after it in that order that
   belong to a smaller document (previous and next smaller positions). Its longest
   previous factor is the longer common prefix with one of them; where that is `length`, the
   window is covered.
4. A string that is an anchor in very many contexts would gather them all in one bucket. Where a
   chunk has over `crowd` contexts of it, or the bucket over `max_contexts`, its windows are asked
   for one by one instead, dealt by their own hash.
5. Chunks join the answers, union the covered bytes and hash what is left.

So a passage that thousands of documents share is sorted as one context. Contexts
and single windows are equal by 80 bits of hash, those compared in step 3 by their bytes.

Null and empty texts keep nothing and lose nothing; texts shorter than `length` stay whole;
documents with the same id do not remove each other's bytes; an empty table gives no row;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.corpus import blocks_of, bucket_bounds, chunk_texts, chunked, pack, sizes, text_bytes, unpack
from flightlake.llm.runtime import bounded_batches, id_and_text, stored, stored_at
from flightlake.session import remove_scratch

U64 = np.uint64
#: states of an anchor's context in a chunk, from its bucket
ALONE, COVERED, COMPARE, CROWDED = 0, 1, 2, 3
#: stands for all contexts of an anchor that a chunk has too many of
_MARK = (1 << 40) - 1
#: kinds of answers: of contexts, of compared windows, of windows asked for one by one; a chunk's own entries and their anchors
CONTEXT, WINDOWS, SINGLE, ENTRIES, ANCHORS = 0, 1, 2, 3, 4
#: contexts are sorted in blocks of about so many bytes
SORT_BYTES = 1 << 20


def _forty(h: np.ndarray) -> np.ndarray:
    """The upper 40 bits of a hash, never the mark."""
    return np.minimum(h >> U64(24), U64(_MARK - 1))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over x[i], ..., x[i + width - 1]; the last width - 1 places are left out."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:len(x) - step], x[step:])
        have += step
    return x


def anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, place, anchor hash, context start, context end, context hash) of every anchor."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64))
    n = len(buf)
    if n < length:
        return none
    h = T.prefix_hash(buf)
    _, down = T._power_tables(n + 1)
    grams = T.mix64((h[gram:] - h[:n + 1 - gram]) * down[:n + 1 - gram])
    grams[grams == 0] = U64(1)
    width = length - gram + 1
    least = _sliding(grams, width, np.minimum)              # of the window that starts here
    inside = np.zeros(len(least) + 1, np.int64)
    long = np.diff(off) >= length
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, off[1:][long] - length + 1, -1)
    least[np.cumsum(inside[:-1]) == 0] = U64(0)             # no window of one text
    padded = np.zeros(len(least) + 2 * (width - 1), U64)
    padded[width - 1:width - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(padded, width, np.maximum) == grams)
    doc = np.searchsorted(off, at, "right") - 1
    reach = length - gram
    start, end = np.maximum(off[doc], at - reach), np.minimum(off[doc + 1], at + length)
    context = T.mix64(T.span_hash(h, start, end) + (at - start).astype(U64))
    # anchors are the least hashes of their windows: mixed again, they spread over all buckets
    return doc, at, T.mix64(grams[at]), start, end, context


def chunk_anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchors() of a chunk, with places in the whole chunk."""
    parts = []
    for first, b, o in blocks_of(buf, off):
        doc, at, gram_hash, start, end, context = anchors(b, o, length, gram)
        parts.append((doc + first, at + off[first], gram_hash, start + off[first], end + off[first], context))
    if not parts:
        return anchors(np.zeros(0, np.uint8), np.zeros(1, np.int64), length, gram)
    return tuple(np.concatenate(p) for p in zip(*parts))


@dataclass(frozen=True)
class Params:
    length: int
    gram: int
    buckets: int
    crowd: int
    max_contexts: int


def entered(row: dict, p: Params) -> tuple[bytes, bytes, bytes]:
    """A chunk's distinct (anchor, context), ascending by anchor: packed for _Entries, their anchors, and what more is asked of buckets."""
    buf, off = chunk_texts(row["n_bytes"], row["offsets"], row["texts"])
    ids, rank = _ranked(row["doc_ids"])
    doc, at, gram_hash, _, _, context = chunk_anchors(buf, off, p.length, p.gram)
    # 40 bits of each, beside the bucket, are what is sent
    anchor, context = _forty(gram_hash), _forty(context)
    rank = rank[doc]
    order = np.lexsort((rank, context, anchor))
    a, c = anchor[order], context[order]
    new = np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1]))[:len(a)]
    entry = np.empty(len(order), np.int64)                 # of each occurrence
    entry[order] = np.cumsum(new) - 1
    a, c, least = a[new], c[new], rank[order[new]]
    # what is asked: each entry, or one mark for the entries of an anchor with too many
    begins = np.flatnonzero(np.append(True, a[1:] != a[:-1])[:len(a)])
    size = np.diff(np.append(begins, len(a)))
    crowded = np.repeat(size > p.crowd, size)
    begin = np.zeros(len(a), bool)
    begin[begins] = True
    asked = ~crowded | begin
    own = pack(np.diff(at, prepend=0).astype("<u4"), entry.astype("<u4"), asked.astype("u1"))
    return own, pack(np.diff(a, prepend=U64(0))), pack(np.where(crowded, U64(_MARK), c)[asked], least[asked].astype("<u4"), ids)


def _ranked(doc_ids: list) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's ids and each document's place among them; one without an id comes before all others."""
    return np.unique(np.array([-(1 << 63) if d is None else d for d in doc_ids], np.int64), return_inverse=True)


class _Entries:
    """A chunk's distinct (anchor, context), ascending by anchor, and each one's least document."""

    def __init__(self, row: dict, reply: pa.Table, p: Params):
        self.buf, self.off = chunk_texts(row["n_bytes"], row["offsets"], row["texts"])
        self.ids, self.rank = _ranked(row["doc_ids"])
        (step, entry, asked), = answers_of(reply, ENTRIES)
        at = np.cumsum(step.astype(np.int64))
        self.entry = entry.astype(np.int64)
        self.question = np.cumsum(asked.astype(np.int64)) - 1                         # each entry's
        self.doc = np.searchsorted(self.off, at, "right") - 1
        reach = p.length - p.gram
        self.start, self.end = np.maximum(self.off[self.doc], at - reach), np.minimum(self.off[self.doc + 1], at + p.length)
        # the occurrence in the least document: written last, from the greatest down
        down = np.argsort(self.rank[self.doc], kind="stable")[::-1]
        self.first = np.empty(len(asked), np.int64)
        self.first[self.entry[down]] = down
        self.least = self.rank[self.doc[self.first]]

    def states(self, reply: pa.Table) -> np.ndarray:
        """Each entry's state, from the answers to the chunk's questions."""
        got = np.concatenate([np.zeros(0, np.uint8), *(a[0] for a in answers_of(reply, CONTEXT))])
        return got[self.question] if len(got) else np.zeros(len(self.question), np.uint8)

    def single_windows(self, state: np.ndarray, p: Params) -> tuple[np.ndarray, ...]:
        """Windows around crowded anchors: (start, which window, distinct windows' two hashes and least document)."""
        at = np.flatnonzero(state[self.entry] == CROWDED) if len(self.entry) else np.zeros(0, np.int64)
        n = np.maximum(self.end[at] - self.start[at] - p.length + 1, 0)
        start = np.repeat(self.start[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rank = np.repeat(self.rank[self.doc[at]], n)
        h = np.zeros(len(start), U64)
        for first, last in self._pieces(start, p.length):
            h[first:last] = self._hash(start[first:last], p.length)
        other = T.mix64(h ^ U64(0x94D049BB133111EB))
        order = np.lexsort((rank, h))
        new = np.append(True, h[order][1:] != h[order][:-1])[:len(order)]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        pick = order[new]
        return start, rank, which, _forty(h[pick]), _forty(other[pick]), rank[pick]

    def _pieces(self, start: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
        """Stretches of the windows, which stand in order, over about a block of text each."""
        i = 0
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(start, start[i] + T.BLOCK_BYTES)))
            yield i, j
            i = j

    def _hash(self, start: np.ndarray, length: int) -> np.ndarray:
        low, high = int(start.min()), int(start.max()) + length
        return T.span_hash(T.prefix_hash(self.buf[low:high]), start - low, start - low + length)


def answers_of(reply: pa.Table, kind: int) -> list[list[np.ndarray]]:
    reply = reply.filter(pc.equal(reply["kind"], kind)).sort_by("bucket")
    return [unpack(a) for a in reply["answer"].to_pylist()]


def packed_questions(anchor: np.ndarray, context: np.ndarray, least: np.ndarray, ids: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed entries) of ascending 40-bit hashes with a second hash and the rank of a document."""
    bounds = bucket_bounds(anchor << U64(24), buckets)
    for i in np.flatnonzero(np.diff(bounds)):
        s = slice(bounds[i], bounds[i + 1])
        used, local = np.unique(least[s], return_inverse=True)
        low, high = (context[s] & U64(0xFFFFFFFF)).astype("<u4"), (context[s] >> U64(32)).astype("u1")
        yield int(i), pack(np.diff(anchor[s], prepend=U64(0)), low, high, local.astype("<u4"), np.diff(ids[used].astype(U64), prepend=U64(0)))


ENTERED = "chunk long, answer binary, anchors binary, asks binary"


def entries(chunks: DataFrame, p: Params) -> DataFrame:
    """A row for each chunk: its entries, hashed and sorted once for all later steps, and what they ask."""
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                parts = [pa.array([x], pa.binary()) for x in entered(row, p)]
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]], pa.int64()), *parts], ["chunk", "answer", "anchors", "asks"])

    return stored(chunks.mapInArrow(enter, ENTERED), "lpf-entries", codec="uncompressed")


QUESTIONS = "bucket int, chunk long, ask binary"


def questions(entered: DataFrame, p: Params) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                (_, _, asked), (anchor,), (context, least, ids) = (unpack(row[k]) for k in ("answer", "anchors", "asks"))
                asks = list(packed_questions(np.cumsum(anchor.astype(U64))[asked > 0], context.astype(U64), least, ids, p.buckets))
                yield pa.RecordBatch.from_arrays([pa.array([a[0] for a in asks], pa.int32()), pa.array([row["chunk"]] * len(asks), pa.int64()), pa.array([a[1] for a in asks], pa.binary())], ["bucket", "chunk", "ask"])

    return entered.mapInArrow(ask, QUESTIONS)


STATES = "chunk long, bucket int, answer binary"


def states(asked: DataFrame, max_contexts: int) -> DataFrame:
    """For each question, what each context is: alone, covered by a smaller document, to be compared, or one
    of a crowd."""
    def answer(group: pa.Table) -> pa.Table:
        parts = []
        for ask in group["ask"].to_pylist():
            step, low, high, local, ids = unpack(ask)
            ids = np.cumsum(ids.astype(U64)).astype(np.int64)
            parts.append((np.cumsum(step.astype(U64)), low.astype(U64) | (high.astype(U64) << U64(32)), ids[local]))
        anchor, context, doc = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((doc, context, anchor))
        a, c, d = anchor[order], context[order], doc[order]
        new_anchor = np.append(True, a[1:] != a[:-1])
        new = new_anchor | np.append(True, c[1:] != c[:-1])
        place = np.arange(len(a))
        least = d[np.maximum.accumulate(np.where(new, place, 0))]
        of = np.cumsum(new_anchor) - 1
        contexts = np.bincount(of, new)[of]
        crowded = ((contexts > max_contexts) | (np.bincount(of, c == U64(_MARK))[of] > 0))
        state = np.empty(len(a), np.uint8)
        state[order] = np.where(crowded, CROWDED, np.where(d > least, COVERED, np.where(contexts > 1, COMPARE, ALONE)))
        ends = np.cumsum([len(p[0]) for p in parts])
        replies = [pack(x) for x in np.split(state, ends[:-1])]
        return pa.table({"chunk": group["chunk"], "bucket": group["bucket"], "answer": pa.array(replies, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(answer, STATES)


SENT = "bucket int, chunk long, ask binary, kind int"


def second_questions(chunks: DataFrame, replies: DataFrame, p: Params) -> DataFrame:
    """A row for each chunk, bucket and kind: the bytes of the contexts to be compared with their least documents,
    and the windows of crowded anchors one by one."""
    def send(chunk: pa.Table, reply: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for row in chunk.to_pylist():
            e = _Entries(row, reply, p)
            state = e.states(reply)
            anchor = np.cumsum(answers_of(reply, ANCHORS)[0][0].astype(U64))
            wanted = np.flatnonzero(state == COMPARE)
            edge = bucket_bounds(anchor[wanted] << U64(24), p.buckets)
            for i in np.flatnonzero(np.diff(edge)):
                some = wanted[edge[i]:edge[i + 1]]
                at = e.first[some]
                size = e.end[at] - e.start[at]
                rows.append((int(i), row["chunk"], pack(some.astype("<u4"), size.astype("<u2"), e.buf[_laid_out(e.start[at], size)], e.ids[e.least[some]], np.diff(anchor[some], prepend=U64(0))), WINDOWS))
            _, _, _, first, second, least = e.single_windows(state, p)
            rows += [(i, row["chunk"], ask, SINGLE) for i, ask in packed_questions(first, second, least, e.ids, p.buckets)]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "chunk": pa.array(columns[1], pa.int64()), "ask": pa.array(columns[2], pa.binary()), "kind": pa.array(columns[3], pa.int32())})

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(send, SENT)


# ---- suffixes of the contexts -------------------------------------------------------------------


def _dense(x: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones."""
    order = np.argsort(x)
    ordered = x[order]
    rank = np.empty(len(x), np.int64)
    rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])[:len(x)])
    return rank


def prefix_ranks(buf: np.ndarray, depth: int, places: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """[(k, rank by the first k bytes)] for k = 8, 16, ... and `depth`, for every place with depth bytes after it.

    buf ends with depth zero bytes or more. Ranks of 8 bytes come from the bytes themselves; each further
    one ranks pairs of the one before. With places, `depth` alone, ranked at these from up to four ranks of a quarter of it or more.
    """
    n = len(buf) - depth + 1
    wide = len(buf) - 7
    eight = np.zeros(wide, U64)
    for k in range(8):
        eight = (eight << U64(8)) | buf[k:k + wide]
    rank = _dense(eight)
    levels, k = [(8, rank[:n])], 8
    while k < (depth if places is None else -(-depth // 4)):
        step = min(k, depth - k)
        size = len(rank) - step
        rank = _dense(rank[:size] * np.int64(len(rank) + 1) + rank[step:])
        k += step
        levels.append((k, rank[:n]))
    if places is None:
        return levels
    distinct = int(rank.max(initial=0)) + 1
    key, bound = rank[places].astype(U64), distinct
    for at in range(k, depth, k):
        if bound * distinct >= 1 << 64:
            key = _dense(key).astype(U64)
            bound = len(key)
        key = key * U64(distinct) + rank[places + min(at, depth - k)].astype(U64)
        bound *= distinct
    last = np.zeros(n, np.int64)
    last[places] = _dense(key)
    return [(depth, last)]


def shared_prefix(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The longest of the ranked depths to which suffixes a and b agree (0: not even the first)."""
    out = np.zeros(len(a), np.int64)
    for k, rank in levels:
        out = np.where(rank[a] == rank[b], k, out)
    return out


def nearest_smaller(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place, the longest common prefix with the nearest place before it with a smaller value (0: none).

    lcp[i]: with the place before. Places jump over what is not smaller, carrying the least common prefix on
    the way; a common prefix of 0 ends the way.
    """
    n = len(value)
    to = np.arange(n) - 1
    held = lcp.copy()
    live = np.flatnonzero((held > 0) & (to >= 0))
    while len(live):
        t = to[live]
        live = live[value[t] >= value[live]]
        t = to[live]
        # t's own way leads past all places that are not smaller than t, and so not smaller than this one
        nearer, carried = to[t].copy(), held[t].copy()
        held[live] = np.minimum(held[live], carried)
        to[live] = nearer
        held[live[nearer < 0]] = 0
        live = live[(held[live] > 0) & (to[live] >= 0)]
    return np.where(to >= 0, held, 0)


def longest_previous_factors(levels: list[tuple[int, np.ndarray]], places: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each suffix (place), the longest common prefix with a suffix of a smaller document."""
    rank, docs = levels[-1][1][places], int(doc.max(initial=0)) + 1
    small = len(doc) > 0 and int(doc.min()) >= 0 and docs < 1 << 31 and int(rank.max()) < 1 << 31
    order = np.argsort(rank * docs + doc) if small else np.lexsort((doc, rank))
    suffix = places[order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = shared_prefix(levels, suffix[1:], suffix[:-1])
    before = nearest_smaller(doc[order], lcp)
    # the same from the other end: there, a place's common prefix is the one with its successor
    after = nearest_smaller(doc[order][::-1], np.append(lcp[1:], 0)[::-1])[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def _laid_out(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, ..., start + size - 1 of every row, one row after the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _repeated(h: np.ndarray) -> np.ndarray:
    """Whether a hash may stand twice: never False for one that does."""
    bits = max(10, int(len(h)).bit_length() + 3)
    slot = (h >> U64(64 - bits)).astype(np.int64)
    last = np.zeros(1 << bits, np.int32)
    place = np.arange(len(h), dtype=np.int32)
    last[slot] = place
    twice = np.zeros(1 << bits, bool)
    twice[slot[last[slot] != place]] = True
    return twice[slot]


def _compare(size: np.ndarray, buf: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For each context (size bytes of buf, one after the other) a bit for each covered window.

    Windows with a hash of their own equal no other, so they and contexts of such windows alone are not sorted.
    """
    start = np.cumsum(size) - size
    windows = np.maximum(size - length + 1, 0)
    of = np.repeat(np.arange(len(size)), windows)
    shift = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = start[of] + shift
    some = np.flatnonzero(_repeated(T.mix64(T.span_hash(T.prefix_hash(buf), at, at + length))))
    mask = np.zeros(len(size), U64)
    if not len(some):
        return mask
    of, shift = of[some], shift[some]
    context, own = np.unique(of, return_inverse=True)
    held = size[context]
    sorted_bytes = np.concatenate([buf[_laid_out(start[context], held)], np.zeros(length + 8, np.uint8)])
    places = (np.cumsum(held) - held)[own] + shift
    factor = longest_previous_factors(prefix_ranks(sorted_bytes, length, places), places, _dense(doc[context])[own])
    np.bitwise_or.at(mask, of, (factor >= length).astype(U64) << shift.astype(U64))
    return mask


def covered_windows(asked: DataFrame, length: int) -> DataFrame:
    """For each sent context, a bit for each of its windows that a smaller document also has.

    Equal windows have equal anchors, so contexts are sorted anchor after anchor, in blocks.
    """
    def compare(group: pa.Table) -> pa.Table:
        parts = [unpack(a) for a in group["ask"].to_pylist()]
        size = np.concatenate([p[1] for p in parts]).astype(np.int64)
        buf, doc = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
        anchor = np.concatenate([np.cumsum(p[4].astype(U64)) for p in parts])
        start = np.cumsum(size) - size
        order = np.argsort(anchor, kind="stable")
        ends = np.cumsum(size[order])
        last = np.append(anchor[order][1:] != anchor[order][:-1], True)
        mask = np.zeros(len(size), U64)
        i = 0
        while i < len(order):
            # up to the end of the anchor at which the block is full
            j = min(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SORT_BYTES)), len(order) - 1)
            j += int(np.argmax(last[j:])) + 1
            some = order[i:j]
            mask[some] = _compare(size[some], buf[_laid_out(start[some], size[some])], doc[some], length)
            i = j
        split = np.split(mask, np.cumsum([len(p[0]) for p in parts])[:-1])
        return pa.table({"chunk": group["chunk"], "bucket": group["bucket"], "answer": pa.array([pack(p[0], m) for p, m in zip(parts, split)], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(compare, STATES)


# ---- result ---------------------------------------------------------------------------------------

REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(e: _Entries, reply: pa.Table, p: Params) -> np.ndarray:
    """Whether each byte of the chunk goes."""
    change = np.zeros(len(e.buf) + 1, np.int32)
    if not len(e.entry):
        return change[:-1] > 0
    state = e.states(reply)
    crowded = state[e.entry] == CROWDED
    whole = ~crowded & ((state[e.entry] == COVERED) | (e.rank[e.doc] > e.least[e.entry]))
    np.add.at(change, e.start[whole], 1)
    np.add.at(change, e.end[whole], -1)
    mask = np.zeros(len(state), U64)
    for places, bits in answers_of(reply, WINDOWS):
        mask[places] = bits
    some = np.flatnonzero(~whole & ~crowded & (mask[e.entry] > 0))
    for shift in range(p.length - p.gram + 1):
        hit = some[(mask[e.entry[some]] >> U64(shift)) & U64(1) > 0]
        np.add.at(change, e.start[hit] + shift, 1)
        np.add.at(change, e.start[hit] + shift + p.length, -1)
    if crowded.any():
        start, rank, which, _, _, least = e.single_windows(state, p)
        got = np.concatenate([a[0] for a in answers_of(reply, SINGLE)])
        hit = start[(got[which] == COVERED) | (rank > least[which])]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + p.length, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 18, chunk_bytes: int = 2 << 20, bucket_bytes: int = 8 << 20,
                   crowd: int = 64, max_contexts: int = 20_000, with_text: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: bytes, bytes and runs removed, the kept bytes' sha256, and with_text what is kept.

    Kept bytes are given as binary: a cut can fall inside a character.
    """
    if not 0 <= length - gram < 64:
        raise ValueError("a context holds at most 64 windows")
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    size = sizes(text_bytes(texts), chunk_bytes, bucket_bytes)
    p = Params(length, gram, size.buckets, crowd, max_contexts)
    chunks = chunked(texts, size.chunk_bytes)
    bounded_batches(spark, 1)               # rows are whole chunks from here on
    kind = lambda df, k: df.withColumn("kind", F.lit(k))
    own = entries(chunks, p)
    known = stored(kind(states(questions(own, p), max_contexts), CONTEXT), "lpf-states")
    own_row = lambda c, k: kind(own.select("chunk", F.lit(0).alias("bucket"), F.col(c).alias("answer")), k)
    known = known.unionByName(own_row("answer", ENTRIES))
    sent, sent_at = stored_at(second_questions(chunks, known.unionByName(own_row("anchors", ANCHORS)), p), "lpf-questions", codec="uncompressed")
    compared = stored(kind(covered_windows(sent.where(F.col("kind") == WINDOWS), length), WINDOWS), "lpf-windows")
    # a window is its own context: no limit on how many share the first hash
    single = stored(kind(states(sent.where(F.col("kind") == SINGLE), 1 << 62), SINGLE), "lpf-single")

    remove_scratch(spark, sent_at)          # both its readers are written

    def cut(chunk: pa.Table, reply: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in chunk.to_pylist():
            e = _Entries(row, reply, p)
            goes = _covered(e, reply, p)
            for i, d in enumerate(row["doc_ids"]):
                part = goes[e.off[i]:e.off[i + 1]]
                kept = e.buf[e.off[i]:e.off[i + 1]][~part].tobytes()
                runs = int((part[1:] & ~part[:-1]).sum()) + int(len(part) and part[0])
                out.append((d, len(part), int(part.sum()), runs, hashlib.sha256(kept).hexdigest(), kept)[:5 + with_text])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:5 + with_text]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_text]
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    replies = known.unionByName(compared).unionByName(single)
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(cut, REMOVED + ", kept binary" * with_text)
