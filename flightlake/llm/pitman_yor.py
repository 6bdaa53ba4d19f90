"""Operator 10: language-model scores from a hierarchical Pitman-Yor model.

Words (lower-cased ASCII) and one end mark a text are tokens. A token's context is the token
before it (a text's first token follows a start mark). Every context is a restaurant over
words, so their number grows with the vocabulary; all share one root restaurant, whose
base is uniform over the V known words and one unknown. A restaurant's tables are customers of
the root.

The corpus is dealt by word: a bucket holds all counts of its words by context and the words'
places in the root, and reseats them by Metropolis-within-Gibbs sweeps over numbers of tables, which are
kept from sweep to sweep and round to round, with the
totals of the other buckets' words held. What a restaurant's words in all buckets have in common
are its totals (customers and tables): after each round each bucket sends its restaurants' tables to
their owners (buckets of contexts), which sum them and send each bucket the totals of the restaurants it has words in.
Customers of one word are indistinguishable, so a seating is kept as
its number of tables t, of posterior weight S(n, t) f(t) with a generalised Stirling number S: from a table up to STIRLING
customers, by a contour integral beyond. A Metropolis step moves t given the rest, by a step as wide as its spread.
Up to PASSES contexts of a word are reseated in turn, given the others; more in PASSES groups,
each at once. The root's tables of a word move by one, up or down. The first tables come from seat(), which
only starts the chain. Predictive
probabilities are averaged over the sweeps after burn-in.

Draws are seeded by bucket, place in it, sweep and step, so a lost task gives the same
result again. Counts are exact over all training texts. Words and contexts are known by a 56-bit hash. Null and empty texts hold the end mark alone; a null doc_id hashes as an empty text (and is held out);
repeated rows count each for itself; with no training text every word is unknown
(V = 0 and N = 0: the base score is that of one unknown type); an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import textkit as T
from flightlake.llm.corpus import blocks_of, bucket_bounds, chunk_texts, chunked, pack, sizes, text_bytes, unpack
from flightlake.llm.runtime import bounded_batches, id_and_text, stored, stored_at
from flightlake.session import remove_scratch

U64 = np.uint64
_WORD = U64(0xFFFFFFFFFFFFFF00)
_END = T.mix64(np.array([0xE2D], U64))[0] & _WORD
_START = T.mix64(np.array([0x57A27], U64))[0] & _WORD


@dataclass(frozen=True)
class Prior:
    """Discount and concentration of the root and of the context restaurants."""

    root_discount: float = 0.7
    root_strength: float = 10.0
    discount: float = 0.8
    strength: float = 10.0
    sweeps: int = 4
    burn_in: int = 2
    rounds: int = 3


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, text) of every token in order."""
    docs = len(off) - 1
    start, end, doc = T.words(buf, off)
    word = T.span_hash(T.prefix_hash(T.lower_ascii(buf)), start, end) if len(start) else np.zeros(0, U64)
    n = np.bincount(doc, minlength=docs)
    ends = np.cumsum(n + 1) - 1
    token = np.full(len(word) + docs, _END, U64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = word & _WORD
    before = np.empty(len(token), U64)
    before[1:] = token[:-1]
    before[np.append(0, ends[:-1] + 1)[:docs]] = _START
    return token, before, np.repeat(np.arange(docs), n + 1)


def distinct(word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in ascending order: (words, contexts, word's and context's place of each pair; place of each given pair)."""
    words, w = np.unique(word, return_inverse=True)
    contexts, c = np.unique(context, return_inverse=True)
    pair, place = np.unique(w.astype(np.int64) * max(len(contexts), 1) + c, return_inverse=True)
    return words, contexts, *np.divmod(pair, max(len(contexts), 1)), place


def chunk_pairs(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct pairs as (word, context), and of every token the pair and the text."""
    parts = [(w, c, d + first) for first, b, o in blocks_of(buf, off) for w, c, d in [tokens(b, o)]]
    if not parts:
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    words, contexts, w, c, place = distinct(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))
    return words[w], contexts[c], place, np.concatenate([p[2] for p in parts])


def held_out(doc_ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d in doc_ids], bool)


def split_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending keys as (words, keys a word, classes)."""
    word = keys & U64(0xFFFFFFFFFFFFFF00)
    at = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(keys) else np.zeros(0, np.int64)
    return word[at], np.diff(np.append(at, len(keys))), (keys & U64(0xFF)).astype(np.uint8)


def packed_pairs(word: np.ndarray, context: np.ndarray, *more: np.ndarray) -> bytes:
    word, n, _ = split_keys(word)
    return pack(np.diff(word, prepend=U64(0)), n.astype("<u4"), context, *more)


def unpacked_pairs(value: bytes) -> list[np.ndarray]:
    step, n, *more = unpack(value)
    return [np.repeat(np.cumsum(step.astype(U64)), n), *more]


QUESTIONS = "bucket int, chunk long, ask binary"


def questions(chunks: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's distinct pairs of word and context with their counts in training texts, a row for each bucket."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                buf, off = chunk_texts(row["n_bytes"], row["offsets"], row["texts"])
                word, context, place, doc = chunk_pairs(buf, off)
                train = ~held_out(row["doc_ids"])
                counts = np.bincount(place, train[doc], minlength=len(word)).astype("<u4")
                edge = bucket_bounds(word, buckets)
                at = np.flatnonzero(edge[1:] > edge[:-1])
                asks = [packed_pairs(*(a[edge[i]:edge[i + 1]] for a in (word, context, counts))) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.full(len(at), row["chunk"]), pa.int64()), pa.array(asks, pa.binary())], ["bucket", "chunk", "ask"])

    return chunks.mapInArrow(ask, QUESTIONS)


STATE = ("bucket int, state binary, train_tokens long, known long, pairs long, owners array<int>, edges array<long>, "
         "contexts array<binary>, customers array<binary>, tables array<binary>, chunks array<long>, asks array<binary>")


def bucket_states(asked: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket: its words' counts by context, its contexts and their totals in the bucket by owner,
    and the questions, as places of the pairs asked for.

    Pairs of held-out texts alone have a count of 0. Each word starts with one table in each of its contexts.
    """
    def merge(group: pa.Table) -> pa.Table:
        asks = [unpacked_pairs(a) for a in group["ask"].to_pylist()]
        words, contexts, w, c, place = distinct(*(np.concatenate([a[k] for a in asks]) for k in (0, 1)))
        total = np.bincount(place, np.concatenate([a[2] for a in asks]), minlength=len(w)).astype("<u8")
        edge = bucket_bounds(contexts, buckets)
        owners = np.flatnonzero(edge[1:] > edge[:-1])
        edges = np.append(edge[owners], len(contexts))
        by_owner = lambda a: [pack(a[i:j]) for i, j in zip(edges[:-1], edges[1:])]
        at = np.cumsum([0, *(len(a[0]) for a in asks)])
        row = {"bucket": group["bucket"][0].as_py(), "state": pack(np.bincount(w, minlength=len(words)).astype("<u4"), c.astype("<u4"), total),
               "train_tokens": int(total.sum()), "known": int((np.bincount(w, total, minlength=len(words)) > 0).sum()), "pairs": int((total > 0).sum()), "owners": owners, "edges": edges,
               "contexts": by_owner(contexts), "customers": by_owner(np.bincount(c, total, minlength=len(contexts)).astype("<u8")),
               "tables": by_owner(np.bincount(c, total > 0, minlength=len(contexts)).astype("<u8")), "chunks": group["chunk"].to_pylist(),
               "asks": [pack(np.diff(place[i:j], prepend=0).astype("<u4")) for i, j in zip(at[:-1], at[1:])]}
        kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.list_(pa.binary())] * 3, pa.list_(pa.int64()), pa.list_(pa.binary())]
        return pa.table([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

    return asked.groupBy("bucket").applyInArrow(merge, STATE)


def _rows(table: pa.Table) -> list[dict]:
    return table.sort_by("bucket").to_pylist()


PLACES = "owner int, bucket int, place binary, customers binary"


def context_places(states: DataFrame) -> DataFrame:
    """For each owner of contexts and each bucket: the owner's places of the bucket's contexts, and all their customers."""
    def place(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        parts = [unpack(r["context"])[0].astype(U64) for r in rows]
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        customers = np.bincount(at, np.concatenate([unpack(r["n"])[0] for r in rows])).astype("<u8")
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        out = [(pack(p.astype("<u4")), pack(customers[p])) for p in np.split(at, cuts)]
        return pa.table([pa.array([r["owner"] for r in rows], pa.int32()), pa.array([r["bucket"] for r in rows], pa.int32()),
                         pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())], names=["owner", "bucket", "place", "customers"])

    parts = states.select("bucket", F.explode(F.arrays_zip("owners", "contexts", "customers")).alias("p"))
    return parts.select("bucket", F.col("p.owners").alias("owner"), F.col("p.contexts").alias("context"), F.col("p.customers").alias("n")).groupBy("owner").applyInArrow(place, PLACES)


TOLD = "bucket int, owner int, customers binary, tables binary"


def told(places: DataFrame, seated: DataFrame) -> DataFrame:
    """Each bucket's contexts with their customers and tables in all buckets; seated has a bucket's own tables by owner."""
    def add(place: pa.Table, part: pa.Table) -> pa.Table:
        rows, own = _rows(place), {r["bucket"]: unpack(r["n"])[0] for r in part.to_pylist()}
        at = [unpack(r["place"])[0] for r in rows]
        total = np.zeros(max((int(a.max()) + 1 for a in at), default=0), U64)
        for a, r in zip(at, rows):
            total[a] += own[r["bucket"]].astype(U64)
        return pa.table([pa.array([r["bucket"] for r in rows], pa.int32()), pa.array([r["owner"] for r in rows], pa.int32()),
                         pa.array([r["customers"] for r in rows], pa.binary()), pa.array([pack(total[a]) for a in at], pa.binary())], names=["bucket", "owner", "customers", "tables"])

    parts = seated.select("bucket", F.explode(F.arrays_zip("owners", "tables")).alias("p"))
    parts = parts.select("bucket", F.col("p.owners").alias("owner"), F.col("p.tables").alias("n"))
    return places.groupBy("owner").cogroup(parts.groupBy("owner")).applyInArrow(add, TOLD)


@dataclass(frozen=True)
class Totals:
    """What buckets share: customers and tables of each restaurant (in a bucket, of those it has words in) and of the root."""

    customers: np.ndarray
    tables: np.ndarray
    root_tables: float
    known: int
    train_tokens: int
    root_customers: float | None = None      # the tables of all restaurants; None if `tables` has them all

    @property
    def root(self) -> float:
        return float(self.tables.sum()) if self.root_customers is None else self.root_customers

    @property
    def base(self) -> float:
        return 1.0 / (self.known + 1)

    def new_root(self, prior: Prior) -> float:
        """The root's probability of an unknown word."""
        return (prior.root_strength + prior.root_discount * self.root_tables) / (prior.root_strength + self.root) * self.base

    def back_off(self, prior: Prior) -> np.ndarray:
        return (prior.strength + prior.discount * self.tables) / (prior.strength + self.customers)


def _uniform(seed: np.ndarray, turn: int) -> np.ndarray:
    step = U64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return ((T.mix64(seed + step) >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables after each row's customers have sat down; opening is the weight of a new table
    against one customer's weight at a table."""
    tables = np.minimum(customers, 1).astype(np.float64)
    live = np.flatnonzero(customers > 1)
    seated, turn = 1, 0
    while len(live):
        step = max(1, seated // 16)
        n = np.minimum(step, customers[live] - seated)
        p = opening[live] / (opening[live] + np.maximum(seated - discount * tables[live], 1e-9))
        u = _uniform(seed[live], turn)
        if step == 1:
            tables[live] += u < p
        else:       # a step's new tables: a normal draw with the binomial's mean and spread
            v = _uniform(seed[live] ^ U64(0x5DEECE66D), turn)
            z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
            tables[live] += np.clip(np.rint(n * p + z * np.sqrt(n * p * (1 - p))), 0, n)
        seated, turn = seated + step, turn + 1
        live = live[customers[live] > seated]
    return tables


#: groups in which the contexts of a word are reseated
PASSES = 16
#: customers up to which generalised Stirling numbers are in a table
STIRLING = 1024


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0."""
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    y = x + 7
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z / 1260)) / y - np.log(low)


@lru_cache
def _stirling_table(discount: float) -> np.ndarray:
    out = np.full((STIRLING + 1, STIRLING + 1), -np.inf)
    out[0, 0] = 0.0
    k = np.arange(1, STIRLING + 1)
    for n in range(STIRLING):
        with np.errstate(divide="ignore"):
            out[n + 1, 1:] = np.logaddexp(out[n, 1:] + np.log(np.maximum(n - discount * k, 0)), out[n, :-1])
    return out


#: nodes of the contour on which Stirling numbers of many customers are integrated
NODES = 64


def _contour(n: np.ndarray, t: np.ndarray, discount: float, steps: tuple[int, ...]) -> list[np.ndarray]:
    """Log of the generalised Stirling numbers of n customers at t + step < n tables, for each step.

    They are the coefficients of ((1 - (1 - z)^d) / d)^t / t! in z^n / n!. Cauchy's integral in u = -log z is taken along
    the steepest descent through the saddle, or past 1/n where the saddle lies nearer to the branch point than that.
    """
    n, t, d = n.astype(np.float64), t.astype(np.float64), discount

    def slope(u: np.ndarray) -> np.ndarray:
        w = -np.expm1(-u)
        return n + t * d * w ** (d - 1) * np.exp(-u) / np.expm1(d * np.log(w))

    low, high = -np.log(n), np.full(len(n), 4.0)
    for _ in range(24):
        mid = (low + high) / 2
        left = slope(np.exp(mid)) < 0
        low, high = np.where(left, mid, low), np.where(left, high, mid)
    c = np.exp(high)
    width = 8 / np.sqrt(np.maximum((slope(c * 1.001) - slope(c * 0.999)) / (c * 0.002), 1e-300))
    far = c > 1             # there the path is upright, and closed by the period
    reach = np.minimum(np.where(far, width, width / c), np.pi)
    angle = reach[:, None] * np.arange(NODES) / NODES
    with np.errstate(invalid="ignore", divide="ignore"):
        log_radius = np.log(np.sin(d * angle) / (d * np.sin(angle))) / (1 - d)
        turn = (d / np.tan(d * angle) - 1 / np.tan(angle)) / (1 - d)
    log_radius[:, 0] = turn[:, 0] = 0
    u = c[:, None] * np.exp(np.minimum(log_radius, np.log(30 / c)[:, None])) * np.exp(1j * angle)
    du = np.where(far[:, None], 1j, u * (turn + 1j))
    u = np.where(far[:, None], c[:, None] + 1j * angle, u)
    log_f = np.log1p(-np.exp(d * np.log(-np.expm1(-u))))
    out = []
    for step in steps:
        e = (t + step)[:, None] * log_f + n[:, None] * u
        top = e[:, 0].real
        v = (np.exp(e - top[:, None]) * du).imag
        v[:, 0] /= 2
        out.append(lgamma(n + 1) - lgamma(t + step + 1) - (t + step) * np.log(d) + top + np.log(v.sum(axis=1) * reach / (NODES * np.pi)))
    return out


def log_stirling(n: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Log of the generalised Stirling number of n customers at so many tables: from a table up to STIRLING customers,
    else by a contour integral (error below 1e-3)."""
    n, tables = n.astype(np.int64), tables.astype(np.int64)
    out = _stirling_table(discount)[np.clip(n, 0, STIRLING), np.clip(tables, 0, STIRLING)]
    out = np.where((tables < 0) | (tables > n), -np.inf, np.where(tables == n, 0.0, out))
    more = np.flatnonzero((n > STIRLING) & (tables > 0) & (tables < n))
    if len(more):
        out[more] = _contour(n[more], tables[more], discount, (0,))[0]
    return out


def one_more_table(n: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Log of the ratio of the Stirling numbers of n customers at tables + 1 and at tables, 1 <= tables < n."""
    n, tables = n.astype(np.int64), tables.astype(np.int64)
    low = _stirling_table(discount)
    at, t = np.minimum(n, STIRLING), np.minimum(tables, STIRLING - 1)
    with np.errstate(invalid="ignore"):
        out = low[at, t + 1] - low[at, t]
    more = np.flatnonzero((n > STIRLING) & (tables < n - 1))
    if len(more):
        here, next_ = _contour(n[more], tables[more], discount, (0, 1))
        out[more] = next_ - here
    last = np.flatnonzero((n > STIRLING) & (tables == n - 1))      # n customers at n - 1 tables: one pair of them
    out[last] = -np.log(n[last] * (n[last] - 1.0) / 2 * (1 - discount))
    return out


def shift_of(n: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """What one more than n customers at so many tables multiply the Stirling number by, taken from n (the recursion's factor)."""
    several = np.minimum(np.maximum(tables - 1, 1), n - 1)
    return discount * tables - np.where(tables > 1, np.exp(-one_more_table(n, several, discount)), 0.0)


def more_customers(n: np.ndarray, change: np.ndarray, tables: np.ndarray, discount: float, shift: np.ndarray) -> np.ndarray:
    """Log of the ratio of the Stirling numbers of n + change and of n customers at so many tables; where either passes
    STIRLING, by the factor n - shift for each further customer (shift is computed where it is not a number): for changes and
    tables that are few against n, to within 5e-3."""
    n, new, tables = n.astype(np.int64), (n + change).astype(np.int64), tables.astype(np.int64)
    low = _stirling_table(discount)
    t = np.clip(tables, 0, STIRLING)
    with np.errstate(invalid="ignore"):
        out = low[np.clip(new, 0, STIRLING), t] - low[np.minimum(n, STIRLING), t]
    many = np.flatnonzero(np.maximum(n, new) > STIRLING)
    shift = shift[many]
    unknown = np.flatnonzero(np.isnan(shift))
    if len(unknown):
        shift[unknown] = shift_of(n[many[unknown]], tables[many[unknown]], discount)
    out[many] = lgamma(np.maximum(new[many] - shift, 1e-9)) - lgamma(np.maximum(n[many] - shift, 1e-9))
    return np.where(new < tables, -np.inf, out)


@dataclass(frozen=True)
class Rest:
    """What a word's customers in a restaurant see when they have left, a row for each: the restaurant's tables, the
    word's customers and tables in the root; and the root's customers and tables. shift: the word's shift_of() in the
    root, not a number (or None) where it is not known."""

    tables: np.ndarray
    customers: np.ndarray
    root_tables: np.ndarray
    all_customers: float
    all_tables: float
    base: float
    shift: np.ndarray | None = None


def rising(a: np.ndarray | float, t: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Log of gamma(a + new) / gamma(a + t)."""
    return lgamma(a + new) - lgamma(a + t)


def reseat(customers: np.ndarray, tables: np.ndarray, rest: Rest, prior: Prior, seed: np.ndarray) -> np.ndarray:
    """One Metropolis step of each row's tables, a symmetric one of up to a width near their spread; leaves their
    posterior given the rest as it is."""
    d = prior.discount
    parent = (np.maximum(rest.customers - prior.root_discount * np.minimum(rest.root_tables, rest.customers), 0)
              + (prior.root_strength + prior.root_discount * rest.all_tables) * rest.base) / (prior.root_strength + rest.all_customers)
    opening = np.maximum((prior.strength + d * rest.tables) * parent, 1e-9)
    width = np.floor(1 + 0.8 * np.sqrt(np.minimum(opening * np.log1p(customers / opening), customers)))
    draw = _uniform(seed, 1) - 0.5
    new = tables + np.sign(draw) * np.ceil(np.abs(draw) * 2 * width)
    i = np.flatnonzero((new >= 1) & (new <= customers) & (rest.customers + new >= rest.root_tables))
    n, t, new = customers[i], tables[i], new[i]
    shift = np.full(len(tables), np.nan) if rest.shift is None else rest.shift
    both = log_stirling(np.concatenate([n, n]), np.concatenate([new, t]), d)
    gain = (rising(prior.strength / d + rest.tables[i], t, new) - rising(prior.root_strength + rest.all_customers, t, new) + (new - t) * np.log(d)
            + both[:len(i)] - both[len(i):] + more_customers(rest.customers[i] + t, new - t, rest.root_tables[i], prior.root_discount, shift[i]))
    moved = np.log(_uniform(seed[i], 2)) < gain
    out = tables.copy()
    out[i[moved]] = new[moved]
    return out


def root_step(root: np.ndarray, root_tables: np.ndarray, all_tables: float, base: float, prior: Prior, seed: np.ndarray, turn: int) -> np.ndarray:
    """One Metropolis step of each word's tables in the root, by one up or down."""
    d = prior.root_discount
    up = _uniform(seed, 2 * turn) >= 0.5
    new = root_tables + np.where(up, 1.0, -1.0)
    i = np.flatnonzero((new >= 1) & (new <= root))
    fewer = np.minimum(new, root_tables)[i]
    gain = (one_more_table(root[i], fewer, d) + np.log(d * base)
            + np.log(prior.root_strength / d + all_tables - ~up[i]))
    i = i[np.log(_uniform(seed[i], 2 * turn + 1)) < np.where(up[i], gain, -gain)]
    out = root_tables.copy()
    out[i] = new[i]
    return out


def sweep_bucket(keys: np.ndarray, counts: np.ndarray, totals: Totals, prior: Prior, kind: np.ndarray | None = None,
                 state: tuple[np.ndarray, np.ndarray] | None = None, turn: int = 0, averages: bool = True) -> dict[str, np.ndarray]:
    """Gibbs sweeps over a bucket's words; averages over the sweeps after burn-in.

    A key holds a word above its low byte; kind is the place of its restaurant in the totals (if not
    given, the low byte). state: each key's tables and each word's tables in the root, from which the sweeps go on (if not
    given, seat() draws them); turn numbers the rounds. Gives the state after the last sweep and, if `averages`, tables by restaurant,
    root tables, each key's and each word's predictive probability.
    """
    word, n, low = split_keys(keys)
    of, kind = np.repeat(np.arange(len(word)), n), (low if kind is None else kind).astype(np.int64)
    places = len(totals.customers)
    counts = counts.astype(np.int64)
    live = np.flatnonzero(counts > 1)           # a customer alone sits at a table of its own
    seed = T.mix64((keys[live] + kind[live].astype(U64) * U64(0x9E3779B97F4A7C15)) ^ T.mix64(np.full(1, turn + 1, U64)))
    word_seed = T.mix64(word ^ T.mix64(np.full(1, 1000 + turn, U64)))
    by_word = lambda t: np.bincount(of, t, minlength=len(word))
    if state is None:
        tables = np.minimum(counts, 1).astype(np.float64)
        parent = 1.0 * (n[of[live]] > 1) / (prior.root_strength + max(totals.root, 1.0)) + totals.new_root(prior)
        tables[live] = seat(counts[live], (prior.strength + prior.discount * totals.tables[kind[live]]) * parent, prior.discount, seed)
        root_tables = seat(by_word(tables).astype(np.int64), np.full(len(word), (prior.root_strength + prior.root_discount * totals.root_tables) * totals.base), prior.root_discount, word_seed)
    else:
        tables, root_tables = (a.astype(np.float64) for a in state)
    root = by_word(tables)
    # the totals as they are now; without a state it is not known what they hold of these words, and they stay as told
    told = state is not None
    seen, root_all, tables_all = np.array(totals.tables, np.float64), totals.root, float(totals.root_tables)
    rank = live - (np.cumsum(n) - n)[of[live]]
    passes = [(i, of[i], kind[i], counts[i], seed[k]) for p in range(PASSES) for k in [np.flatnonzero(rank % PASSES == p)] for i in [live[k]] if len(k)]
    out = {"tables": np.zeros(places), "root_tables": 0.0, "word": np.zeros(len(word)), "key": np.zeros(len(keys))}
    kept = 0
    for s in range(prior.sweeps):
        step = T.mix64(np.full(1, (turn << 16) + s + 7, U64))
        shift, frequent = np.full(len(word), np.nan), np.flatnonzero(root > STIRLING // 2)
        shift[frequent] = shift_of(root[frequent], root_tables[frequent], prior.root_discount)      # hardly moves in a sweep
        for i, at, k, c, own_seed in passes:
            t = tables[i]
            rest = Rest(np.maximum(seen[k] - t, 0), root[at] - t, root_tables[at], max(root_all - float(t.mean()), 0.0), tables_all, totals.base, shift[at])
            new = reseat(c, t, rest, prior, T.mix64(own_seed ^ step))
            m = np.flatnonzero(new != t)
            change, at = new[m] - t[m], at[m]
            tables[i[m]] = new[m]
            np.add.at(root, at, change)
            if told:
                np.add.at(seen, k[m], change)
                root_all += change.sum()
            # several contexts of a word reseated at once may leave fewer customers than tables in the root
            short = np.unique(at[root_tables[at] > root[at]])
            if told:
                tables_all -= (root_tables[short] - root[short]).sum()
            root_tables[short] = root[short]
        several = np.flatnonzero(root > 1)
        for k in range(4):
            new = root_step(root[several], root_tables[several], tables_all, totals.base, prior, T.mix64(word_seed[several] ^ step), k)
            if told:
                tables_all += (new - root_tables[several]).sum()
            root_tables[several] = new
        if averages and s >= prior.burn_in:
            kept += 1
            held = prior.root_strength + root_all
            p_root = (root - prior.root_discount * root_tables) / held + (prior.root_strength + prior.root_discount * tables_all) / held * totals.base
            held = prior.strength + totals.customers
            out["word"] += p_root
            out["key"] += (counts - prior.discount * tables) / held[kind] + ((prior.strength + prior.discount * seen) / held)[kind] * p_root[of]
            out["tables"] += np.bincount(kind, tables, minlength=places)
            out["root_tables"] += root_tables.sum()
    return {k: v / max(kept, 1) for k, v in out.items()} | {"state": (tables, root_tables)}


@dataclass(frozen=True)
class Shared:
    """The totals of the whole model."""

    root_customers: float
    root_tables: float
    known: int
    train_tokens: int


def swept(state: dict, told_rows: pa.Table, shared: Shared, prior: Prior, turn: int, averages: bool = True) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """A bucket's sweeps with the totals it was told: (averages, places of the words, counts)."""
    n, kind, counts = unpack(state["state"])
    rows = told_rows.sort_by("owner").to_pylist()
    customers, tables = (np.concatenate([unpack(r[k])[0] for r in rows]).astype(np.float64) for k in ("customers", "tables"))
    totals = Totals(customers, tables, shared.root_tables, shared.known, shared.train_tokens, shared.root_customers)
    of = np.repeat(np.arange(len(n)), n)
    # a word's name in its bucket: its place, and the bucket
    keys = (of.astype(U64) << U64(8)) + (U64(state["bucket"]) << U64(40))
    seats = None if state["seats"] is None else tuple(unpack(state["seats"]))
    return sweep_bucket(keys, counts.astype(np.int64), totals, prior, kind, seats, turn, averages), of, counts.astype(np.int64)


def own_tables(state: dict, tables: np.ndarray) -> np.ndarray:
    """A bucket's tables by context."""
    kind = unpack(state["state"])[1]
    return np.bincount(kind, tables, minlength=state["edges"][-1]).astype("<u8")


SEATED = "bucket int, owners array<int>, tables array<binary>, root_customers long, root_tables long, seats binary"


def learn(states: DataFrame, places: DataFrame, prior: Prior) -> tuple[DataFrame, Shared]:
    """Rounds of sweeps; after each the restaurants' tables are summed over the buckets by their owners."""
    first = states.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("train_tokens", "known", "pairs"))).first()
    seated = states.select("bucket", "owners", "tables", F.lit(None).cast("binary").alias("seats"))

    def sit(shared: Shared, turn: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def seat_bucket(state: pa.Table, rows: pa.Table) -> pa.Table:
            row = state.to_pylist()[0]
            got, _, _ = swept(row, rows, shared, prior, turn, averages=False)
            tables, root_tables = got["state"]
            here, edges = own_tables(row, tables), row["edges"]
            out = {"bucket": row["bucket"], "owners": row["owners"], "tables": [pack(here[i:j]) for i, j in zip(edges[:-1], edges[1:])],
                   "root_customers": int(tables.sum()), "root_tables": int(root_tables.sum()), "seats": pack(tables.astype("<u4"), root_tables.astype("<u4"))}
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.binary()]
            return pa.table([pa.array([v], k) for v, k in zip(out.values(), kinds)], names=list(out))

        return seat_bucket

    shared = Shared(float(first["pairs"]), float(first["known"]), int(first["known"]), int(first["train_tokens"]))
    slim = states.select("bucket", "state", "owners", "edges")
    before = None
    for k in range(prior.rounds):
        seated, path = stored_at(slim.join(seated.select("bucket", "seats"), "bucket").groupBy("bucket").cogroup(told(places, seated).groupBy("bucket")).applyInArrow(sit(shared, k), SEATED), f"pitman-yor-round-{k}", codec="uncompressed")
        if before:
            remove_scratch(states.sparkSession, before)       # the round before is read
        before = path
        sums = seated.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("root_customers", "root_tables"))).first()
        shared = Shared(float(sums["root_customers"]), float(sums["root_tables"]), shared.known, shared.train_tokens)
    return seated, shared


ANSWERS = "chunk long, bucket int, answer binary"


def answers(states: DataFrame, places: DataFrame, seated: DataFrame, shared: Shared, prior: Prior) -> DataFrame:
    """For every question: each pair's averaged predictive probability, each word's count."""
    def reply(state: pa.Table, rows: pa.Table) -> pa.Table:
        row = state.to_pylist()[0]
        got, of, counts = swept(row, rows, shared, prior, prior.rounds)
        word_count = np.bincount(of, counts).astype("<u8")
        out = []
        for ask in row["asks"]:
            at = np.cumsum(unpack(ask)[0].astype(np.int64))
            word = of[at]
            out.append(pack(got["key"][at].astype("<f4"), word_count[word[np.append(True, word[1:] != word[:-1])]]))
        return pa.table([pa.array(row["chunks"], pa.int64()), pa.array([row["bucket"]] * len(out), pa.int32()), pa.array(out, pa.binary())], names=["chunk", "bucket", "answer"])

    slim = states.select("bucket", "state", "chunks", "asks").join(seated.select("bucket", "seats"), "bucket")
    return slim.groupBy("bucket").cogroup(told(places, seated).groupBy("bucket")).applyInArrow(reply, ANSWERS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def chunk_scores(chunks: DataFrame, replies: DataFrame, totals: Shared) -> DataFrame:
    def score(chunk: pa.Table, reply: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        buf, off = chunk_texts(row["n_bytes"], row["offsets"], row["texts"])
        unique, _, inverse, doc = chunk_pairs(buf, off)
        got = [unpack(a) for a in reply.sort_by("bucket")["answer"].to_pylist()]
        p = np.concatenate([g[0] for g in got]).astype(np.float64)
        _, n, _ = split_keys(unique)
        count = np.repeat(np.concatenate([g[1] for g in got]), n).astype(np.float64)
        assert len(p) == len(unique) == len(count)
        docs = len(off) - 1
        base = np.log10((count + 0.1) / (totals.train_tokens + 0.1 * (totals.known + 1)))
        return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": held_out(row["doc_ids"]),
                         "n_tokens": np.bincount(doc, minlength=docs), "n_known": np.bincount(doc, (count > 0)[inverse], minlength=docs).astype(np.int64),
                         "train_tokens": np.full(docs, totals.train_tokens), "base_score": np.bincount(doc, base[inverse], minlength=docs),
                         "score": np.bincount(doc, np.log10(p)[inverse], minlength=docs)})

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, SCORES)


def language_model_scores(docs: DataFrame, prior: Prior = Prior(), chunk_bytes: int = 2 << 20, bucket_bytes: int = 8 << 20,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains on the texts whose crc32(doc_id) mod 10 is not 0 and scores all."""
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    size = sizes(text_bytes(texts), chunk_bytes, bucket_bytes)
    chunks = chunked(texts, size.chunk_bytes)
    bounded_batches(spark, 1)           # rows are whole chunks and buckets from here on
    states = stored(bucket_states(questions(chunks, size.buckets), size.buckets), "pitman-yor", codec="uncompressed")
    places = stored(context_places(states), "pitman-yor-contexts", codec="uncompressed")
    seated, shared = learn(states, places, prior)
    return chunk_scores(chunks, answers(states, places, seated, shared, prior), shared)


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity of the held-out and the training texts, by the model and by the base."""
    each = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), each("score").alias("perplexity"), each("base_score").alias("base_perplexity"))
