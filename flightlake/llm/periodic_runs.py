"""Operator 13: periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with least period q and at least
`min_power` periods long that no neighbouring word extends keeping period q. For every dyadic
scale t a synchronising set is chosen by hash: of the windows of t words a
position is taken if its own window, or the one t further, has the least
hash among the t + 1 windows that begin there to t further. What is taken depends on the next 2t words alone, so a run
takes the same positions in each of its periods. Taken positions with equal contexts of 2t words
propose the distance to the next such position as a period, if it is
over t and at most 2t: two such contexts make a stretch whose least period is that distance.
Left and right, the stretch grows by common extensions of prefix hashes.

Windows with a period of t / 4 or less take no part in the choice, or long
repeats of a short period would be taken whole. These highly periodic regions are
the runs of smaller scales, found before; period 1, which no scale has, is read off
equal neighbours. A run of period q and four or more periods has a taken position
among its first q + 1 at its scale, or all of it would lie in one highly periodic region.

The words of a text are `[^\\x20\\x09-\\x0D]+`, told apart by 64-bit hashes within the
text. Texts are handled in blocks of about a megabyte, one longer text alone; nothing is
shuffled. Null and empty texts have no word and no run and collapse to the empty text. Repeated
rows and null ids are answered each for itself; runs of equal length all count; an
empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.runtime import bounded_batches, id_and_text

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_NONE = np.iinfo(np.uint64).max
#: periods a run must have for the method to find each one
LEAST_POWER = 4


def _prefix(h: np.ndarray) -> np.ndarray:
    """Prefix hashes over words, for textkit.span_hash."""
    up, _ = T._power_tables(len(h) + 1)
    return np.concatenate((np.zeros(1, T.U64), np.cumsum(h * up[:len(h)], dtype=T.U64)))


def _least(ids: np.ndarray, t: int) -> np.ndarray:
    """Least of each t + 1 neighbours."""
    w = t + 1
    if t <= 16:
        m, have = ids, 1
        while have < t:
            m = np.minimum(m[:-have], m[have:])
            have *= 2
        return np.minimum(m[:-1], m[1:]) if t == 1 else np.minimum(m[:len(ids) - t], ids[t:])
    n = -(-len(ids) // w) * w
    cells = np.full(n, _NONE, T.U64)
    cells[:len(ids)] = ids
    cells = cells.reshape(-1, w)
    ahead = np.minimum.accumulate(cells, axis=1).ravel()
    back = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(ids) - t], ahead[t:len(ids)])


def _extend(prefix: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from i and j on (step 1) or before them (step -1) are equal, at most room."""
    got = np.zeros(len(i), np.int64)
    bit = 1 << int(room.max(initial=0)).bit_length()
    while bit:
        try_ = np.flatnonzero(got + bit <= room)
        n = got[try_] + bit
        a, b = (i[try_], j[try_]) if step > 0 else (i[try_] - n, j[try_] - n)
        same = T.span_hash(prefix, a, a + n) == T.span_hash(prefix, b, b + n)
        got[try_[same]] += bit
        bit >>= 1
    return got


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    steps = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _proposals(h: np.ndarray, first: np.ndarray, last: np.ndarray, prefix: np.ndarray, t: int,
               periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the stretches that equal contexts of scale t propose, grown to their ends."""
    none = (np.zeros(0, np.int64),) * 3
    n = len(h)
    if n < 2 * t:
        return none
    at = np.arange(n - t + 1)
    ids = T.span_hash(prefix, at, at + t)
    ids[(at + t > last[at]) | periodic[at]] = _NONE
    least = _least(ids, t)
    here = np.arange(len(least))
    taken = np.flatnonzero((here + 2 * t <= last[here]) & (least != _NONE) & ((ids[here] == least) | (ids[here + t] == least)))
    if len(taken) < 2:
        return none
    context = T.span_hash(prefix, taken, taken + 2 * t) ^ T.mix64(first[taken].astype(T.U64) + T.U64(1))
    order = np.argsort(context, kind="stable")
    a, b = taken[order[:-1]], taken[order[1:]]
    d = b - a
    pair = np.flatnonzero((context[order[:-1]] == context[order[1:]]) & (first[a] == first[b]) & (d > t) & (d <= 2 * t))
    if not len(pair):
        return none
    a, d = a[pair], d[pair]
    order = np.lexsort((a, d))
    a, d = a[order], d[order]
    # stretches of one period that share that many words are one: their first and last context are enough
    new = np.append(True, (np.diff(a) > 2 * t) | (np.diff(d) != 0) | (first[a[1:]] != first[a[:-1]]))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(a)) - 1
    d = d[head]
    left = _extend(prefix, a[head], a[head] + d, a[head] - first[a[head]], -1)
    right = _extend(prefix, a[tail], a[tail] + d, last[a[tail]] - a[tail] - d, 1)
    return a[head] - left, a[tail] + d + right, d


def find_runs(h: np.ndarray, off: np.ndarray, min_power: int = LEAST_POWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run of at least min_power periods, by start, then period.

    h: the words' hashes, text after text; off: where each text's words begin and end.
    """
    place = np.arange(len(h))                       # of the words still looked at
    starts, ends, periods = [], [], []
    size = np.diff(off)

    def bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upto = np.cumsum(sizes)
        return np.repeat(upto - sizes, sizes), np.repeat(upto, sizes)

    first, last = bounds(size)
    same = np.flatnonzero((h[1:] == h[:-1]) & (first[1:] == first[:-1]))
    if len(same):
        cut = np.flatnonzero(np.append(True, np.diff(same) > 1))
        s, e = same[cut], same[np.append(cut[1:], len(same)) - 1] + 2
        long = e - s >= LEAST_POWER
        starts, ends, periods = [s[long]], [e[long]], [np.ones(long.sum(), np.int64)]
    prefix, t = _prefix(h), 1
    while True:
        enough = size >= LEAST_POWER * (t + 1)
        if not enough.any():
            break
        if size[enough].sum() < 0.7 * len(h):
            kept = np.repeat(enough, size)
            h, place, size = h[kept], place[kept], size[enough]
            first, last = bounds(size)
            prefix = _prefix(h)
        periodic = np.zeros(len(h), bool)
        if starts:
            s, e, q = (np.concatenate(x) for x in (starts, ends, periods))
            s, e = s[(q <= t // 4) & (e - s >= t)], e[(q <= t // 4) & (e - s >= t)]
            i = np.minimum(np.searchsorted(place, s), len(place) - 1)
            s, e, i = (x[place[i] == s] for x in (s, e, i))
            if len(i):
                periodic = _covered(len(h), i, i + (e - s) - t + 1)
        s, e, q = _proposals(h, first, last, prefix, t, periodic)
        long = e - s >= LEAST_POWER * q
        if long.any():
            s, e, q = s[long], e[long], q[long]
            _, once = np.unique(np.stack((s, q)), axis=1, return_index=True)
            s, e, q = s[once], e[once], q[once]
            starts.append(place[s])
            ends.append(place[s] + (e - s))
            periods.append(q)
        t *= 2
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    s, e, q = (np.concatenate(x) for x in (starts, ends, periods))
    long = e - s >= min_power * q
    order = np.lexsort((q[long], s[long]))
    return s[long][order], e[long][order], q[long][order]


def _joined(buf: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, docs: int) -> pa.Array:
    """Each text's words joined by one space."""
    blank = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
    size = end - start + blank
    upto = np.cumsum(size)
    at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - size), size)
    out = buf[np.minimum(at, max(len(buf) - 1, 0))] if len(at) else np.zeros(0, np.uint8)
    out[upto[blank] - 1] = 0x20
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc, size, minlength=docs))))
    return pa.Array.from_buffers(pa.string(), docs, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


def _block(ids: pa.Array, buf: np.ndarray, off: np.ndarray, min_power: int, min_words: int) -> pa.RecordBatch:
    docs = len(off) - 1
    start, end, doc = T.words(buf, off)
    count = np.bincount(doc, minlength=docs)
    upto = np.concatenate(([0], np.cumsum(count)))
    h = T.span_hash(T.prefix_hash(buf), start, end) if len(start) else np.zeros(0, T.U64)
    s, e, q = find_runs(h, upto, min_power)
    long = e - s >= min_words
    s, e, q = s[long], e[long], q[long]
    kept = ~_covered(len(h), s + q, e)
    of = np.searchsorted(upto, s, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (s - upto[of], e - s, q)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(of, minlength=docs)))), pa.int32()), spans)
    text = _joined(buf, start[kept], end[kept], doc[kept], docs)
    return pa.RecordBatch.from_arrays([ids, pa.array(count, pa.int64()), runs, text], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_power: int = LEAST_POWER, min_words: int = 6,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, its runs by start, then period, and the text without what
    any run repeats after its first period (words joined by one space)."""
    if min_power < LEAST_POWER:
        raise ValueError(f"runs of fewer than {LEAST_POWER} periods can't be found by this method")
    bounded_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, buf, off in T.text_blocks(b.column(1)):
                yield _block(b.column(0).slice(i, len(off) - 1), buf, off, min_power, min_words)

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, RUNS)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != F.lit(""))


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with a known periodic tail in a tenth of the texts, by the id's crc32 h, g = h div 10, where h mod 10 = 0:
    of n words each one from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    Rows with a null id or without a word stay as they are."""
    h = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    rows = docs.withColumn("__words", F.when(h % 10 == 0, words(F.col(text_col))))
    n, g, w = F.size("__words").cast("long"), F.floor(h / 10), F.col("__words")
    a = (g % n).cast("int")
    tail = (n - a).cast("int")
    p = F.lit(1) + F.floor(tail / (F.lit(3) + g % 8)).cast("int")
    times = F.ceil(tail / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), tail)
    planted = F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")
    return rows.withColumn(text_col, F.when(w.isNotNull() & (n > 0), planted).otherwise(F.col(text_col))).drop("__words")


def run_digests(runs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: least start, then period; null without a run) and two sha256."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.concat(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), F.lit(""))
    r = runs.select("doc_id", "n_words", "runs", "collapsed", longest.alias("top"))
    return r.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"), F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
