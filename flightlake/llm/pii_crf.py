"""Operator 4: personal data by patterns and a skip-chain conditional random field.

Base: four patterns, applied only where a match can lie (runs of the characters a
pattern may hold), so a text costs linear time whatever it holds.

Method: a text's suspicious tokens become nodes of a conditional random field over the labels none,
email, ip, card, phone: every base span, and in the text between them every word with an at sign and
every number that some kind's check lets through (8 digits or more, or four parts of at most 255). A run of
digits, blanks and marks that no kind can bear as a whole, as two cards side by side, is cut into the numbers
in it. A token has a potential from its shape, from the word
before it and, along the chain, from the label of the suspicious token before it. Tokens that repeat
or are alike (same digits, or the same letters before and after the at sign) share a
skip potential over any distance, and loopy message passing makes their labels agree.
Potentials are trained piecewise over all documents: a shape's from its share among a kind's base spans
against its share among the tokens that the base left out though they stand alone, a cue's and the chain's from base spans alone. Each speaks
for a kind or not at all, so however many tokens the base left out, none speaks against a kind. Against it speak the labels' prior,
which is never better than even, and the kind's own check (digits, Luhn), which holds in any writing. An alike token has
a proven token's label with log odds of `skip`, whatever the prior: if it differs, it is drawn from the prior; `skip` is
learnt from base spans alike in one text, unless given. A token that
the base left out becomes a span when its marginal passes `min_marginal`; base spans stay.

Null and empty texts have no spans; repeated rows are searched each for itself; an
empty table gives no row; other columns are not read (redact() keeps them all).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.runtime import bounded_batches, id_and_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: buckets of each feature's hash; with the labels they bound the trained table
FEATURE_BUCKETS = 4096

Span = tuple[str, int, int]

_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can't begin inside a run of digits: the run's first digit would have begun it
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HAS_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _AT_DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            yield "email", start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by kind, then start."""
    out: list[Span] = list(_emails(text)) if "@" in text else []
    if not _HAS_DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p[-400:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub(r"[ -]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---- tokens and features ------------------------------------------------------------------

_NUMBERS = re.compile(r"[+(0-9][0-9 ().+-]*")
_GROUP = re.compile(r"\+?[^ +]+")
_DIGIT_RUN = re.compile(r"[0-9]+")
_EDGE = " \t\r\n.,;:!?()[]{}<>\"'+-"
#: digits up to which a number that no kind can bear goes on
_LONGEST = 19


def _free(spans: Iterable[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The stretches of n characters outside the spans."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s > at:
            out.append((at, s))
        at = max(at, e)
    return [*out, (at, n)] if at < n else out


def _trimmed(text: str, s: int, e: int) -> tuple[int, int]:
    """Without punctuation at the ends; a phone number may begin with a plus or a bracket."""
    while s < e and text[s] in _EDGE and text[s] not in "(+":
        s += 1
    while e > s and text[e - 1] in _EDGE:
        e -= 1
    return s, e


def _addresses(text: str, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Words with an at sign in text[low:high]."""
    at, free = text.find("@", low, high), low
    while at >= 0:
        s, e = at, at + 1
        while s > free and not text[s - 1].isspace():
            s -= 1
        while e < high and text[e] != "@" and not text[e].isspace():
            e += 1
        free = e
        s, e = _trimmed(text, s, e)
        if e - s >= 6:
            yield s, e
        at = text.find("@", free, high)


def _numbers(text: str, low: int, high: int) -> Iterator[tuple[int, int, bool]]:
    """A run of digits and marks as one number, if some kind can bear it, else as the numbers in it (True).

    A plus begins a number; 8 digits or more without a blank are one of their own; a card ends where its digits pass
    Luhn's check, a number with a plus before the group that would give it over 15 digits.
    """
    s, e = _trimmed(text, low, high)
    if any(bearable(text[s:e])[1:]):
        yield s, e, False
        return
    parts: list[tuple[int, int]] = []
    digits, alone = "", True
    for m in _GROUP.finditer(text, s, e):
        own = "".join(_DIGIT_RUN.findall(m.group()))
        plus = bool(parts) and text[parts[-1][0]] == "+"
        ends = alone or m.group()[0] == "+" or len(own) >= 8 or len(digits) + len(own) > _LONGEST \
            or (16 <= len(digits) and luhn(digits)) or (plus and 8 <= len(digits) and len(digits) + len(own) > 15)
        if ends:
            parts.append(m.span())
            digits = own
        else:
            parts[-1] = parts[-1][0], m.end()
            digits += own
        alone = len(own) >= 8
    for part in parts:
        s, e = _trimmed(text, *part)
        if any(bearable(text[s:e])[1:]):
            yield s, e, True


def tokens(text: str, base: list[Span]) -> tuple[list[tuple[int, int]], list[int], list[bool]]:
    """The suspicious tokens in order; their labels: base spans have their kind's, the others 0; and whether a number
    stands beside another one, so that the base patterns could not see it by itself."""
    found = [(s, e, LABELS.index(kind), False) for kind, s, e in base]
    outside = lambda: _free([x[:2] for x in found], len(text))
    if "@" in text:
        found += [(s, e, 0, False) for low, high in outside() for s, e in _addresses(text, low, high)]
    if _HAS_DIGITS.search(text):
        for low, high in outside():
            for m in _NUMBERS.finditer(text, low, high):
                beside = (low > 0 and m.start() - low <= 4 and not text[low:m.start()].strip(_EDGE)) or m.end() == high < len(text)
                found += [(s, e, 0, cut or beside) for s, e, cut in _numbers(text, *m.span())]
    found.sort()
    return [x[:2] for x in found], [x[2] for x in found], [x[3] for x in found]


def alike(text: str, toks: list[tuple[int, int]]) -> list[list[int]]:
    """Groups of two or more alike tokens."""
    groups: dict[str, list[int]] = defaultdict(list)
    for i, (s, e) in enumerate(toks):
        key = similarity_key(text[s:e])
        if len(key) >= 6:
            groups[key].append(i)
    return [g for g in groups.values() if len(g) > 1]


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}\0{value}".encode()) % FEATURE_BUCKETS


def shape(token: str) -> str:
    """Characters by class; runs of letters shrink to one, runs of digits keep their length up to 20."""
    s = re.sub(r"[^\W\d_]+", "a", token)
    return _DIGIT_RUN.sub(lambda m: f"9{min(len(m.group()), 20)}.", s)[:60]


def features(text: str, span: tuple[int, int]) -> tuple[int, int]:
    s, e = span
    before = text[max(0, s - 40):s].split()
    cue = before[-1].lower().strip(_EDGE) if before else ""
    return _bucket("shape", shape(text[s:e])), _bucket("cue", cue[:20])


def similarity_key(token: str) -> str:
    """Alike tokens have one key: the same digits in any writing, or the same address in any case."""
    if "@" in token:
        return "@" + re.sub(r"[^a-z0-9@]+", "", token.lower())
    return re.sub(r"[^0-9]", "", token)


def bearable(token: str) -> list[bool]:
    """For each label: does the token pass the kind's check, in whatever writing."""
    if "@" in token:
        return [True, True, False, False, False]
    runs = _DIGIT_RUN.findall(token)
    digits = "".join(runs)
    ip = len(runs) == 4 and all(len(r.lstrip("0")) <= 3 and int(r[-400:]) <= 255 for r in runs)
    return [True, False, ip, 16 <= len(digits) <= 19 and luhn(digits), 8 <= len(digits) <= 15]


# ---- training: counts over all documents ------------------------------------------------------

COUNTS = "piece string, key long, label int, n long"


def potential_counts(docs: DataFrame) -> DataFrame:
    """How often each feature (or label before) meets each proven label, each shape an unproven token that stands alone, tokens by label,
    and how often proven tokens alike in one text agree (1) or not (0); at most 8192 + 7 keys times 5 labels."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for text in b["text"]:
                base = base_spans(text)
                toks, labels, beside = tokens(text, base)
                last = 0
                for span, label, lost in zip(toks, labels, beside):
                    total["prior", 0, label] += 1
                    a, c = features(text, span)
                    if not lost:
                        total["shape", a, label] += 1
                    if label:
                        total["cue", c, label] += 1
                        if last:
                            total["chain", last, label] += 1
                    last = label
                for group in alike(text, toks):
                    known = [labels[i] for i in group if labels[i]]
                    for one, other in zip(known, known[1:]):
                        total["skip", 0, int(one == other)] += 1
        yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["piece", "key", "label", "n"])

    return docs.mapInPandas(count, COUNTS).groupBy("piece", "key", "label").agg(F.sum("n").alias("n"))


def train_potentials(docs: DataFrame, smoothing: float = 0.5) -> dict[str, np.ndarray]:
    """Piecewise training, of log ratios where they speak for a kind, else 0. Shapes: the share among a kind's base spans to that among unproven tokens;
    cues and chain: a kind's share among the proven tokens of a feature to its share
    among all proven ones. prior: log shares of the labels among all tokens; skip: log odds that alike proven tokens agree."""
    rows = potential_counts(docs).collect()      # bounded: see potential_counts
    sizes = {"shape": FEATURE_BUCKETS, "cue": FEATURE_BUCKETS, "chain": len(LABELS), "prior": 1, "skip": 1}
    tables = {p: np.full((n, len(LABELS)), 0.0) for p, n in sizes.items()}
    for r in rows:
        tables[r["piece"]][r["key"], r["label"]] += r["n"]
    strength = 4.0       # a key seen less often than this stays near the share
    differ, agree = tables.pop("skip")[0, :2]
    # as if 20 pairs with log odds of 3 had been seen before; no odds over 6, so a tie never outweighs all else
    skip = min(np.log((agree + 20 / (1 + np.exp(-3.0))) / (differ + 20 / (1 + np.exp(3.0)))), 6.0)
    prior = tables.pop("prior") + smoothing
    share = prior[0, 1:] / prior[0, 1:].sum()
    out = {p: np.zeros(t.shape) for p, t in tables.items()}
    for p, t in tables.items():
        ratio = (t[:, 1:] + strength * share) / (t[:, 1:].sum(1, keepdims=True) + strength) / share
        out[p][:, 1:] = np.maximum(np.log(ratio), 0.0)
    shapes = tables["shape"]
    pooled = (shapes.sum(1, keepdims=True) + smoothing) / (shapes.sum() + smoothing * len(shapes))
    of = np.log((shapes + strength * pooled) / (shapes.sum(0) + strength))
    out["shape"] = np.maximum(of - of[:, :1], 0.0)
    return out | {"prior": np.log(prior / prior.sum()), "skip": np.array(skip)}


# ---- inference -----------------------------------------------------------------------------------

def marginals(nodes: np.ndarray, groups: list[list[int]], chain: np.ndarray, skip: float, rounds: int = 8,
              prior: np.ndarray | None = None) -> np.ndarray:
    """Loopy sum-product over the chain and the skip factors; nodes: log potentials (tokens x labels).

    The tokens of one group (repeated or alike) are tied through one hub variable, so a group of m
    tokens costs m messages, not m * m. Two of them have one label with log odds of `skip`, else each
    is drawn from `prior` (log shares of the labels; equal ones if not given): a tie outweighs any
    prior, and tied tokens of which nothing more is known tell each other nothing.
    """
    def normal(x: np.ndarray) -> np.ndarray:
        x = x - x.max(-1, keepdims=True)
        return x - np.log(np.exp(x).sum(-1, keepdims=True))

    def through(m: np.ndarray, pair: np.ndarray) -> np.ndarray:
        return normal(np.log(np.exp(normal(m)) @ np.exp(pair) + 1e-300))

    n, k = nodes.shape
    shares = np.full(k, 1.0 / k) if prior is None else np.exp(normal(prior))
    edge = np.sqrt(1.0 / (1.0 + np.exp(-skip)))         # from token to hub and from hub to token
    agree = np.log1p(edge * (np.eye(k) / shares - 1.0))
    group = np.full(n, -1)
    for g, members in enumerate(groups):
        group[members] = g
    tied = np.flatnonzero(group >= 0)
    left = np.zeros((n, k))      # message from the token before
    right = np.zeros((n, k))     # from the token after
    hub = np.zeros((n, k))       # from the group's hub
    for _ in range(rounds):
        own = nodes + hub
        if n > 1:
            left[1:], right[:-1] = through((own + left)[:-1], chain), through((own + right)[1:], chain.T)
        if len(tied):
            sent = through((nodes + left + right)[tied], agree)
            total = np.zeros((len(groups), k))
            np.add.at(total, group[tied], sent)
            new = through(total[group[tied]] - sent + np.log(shares), agree)
            hub[tied] = 0.5 * hub[tied] + 0.5 * new       # damped
    return np.exp(normal(nodes + left + right + hub))


def all_spans(text: str, potentials: dict[str, np.ndarray], skip: float | None, min_marginal: float) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that the field adds)."""
    base = base_spans(text)
    toks, labels, _ = tokens(text, base)
    if all(labels):
        return base, []
    feats = [features(text, t) for t in toks]
    shapes, cues = map(list, zip(*feats))
    prior = potentials["prior"][0]
    nodes = potentials["shape"][shapes] + potentials["cue"][cues] + np.minimum(prior, prior[0])
    for i, label in enumerate(labels):
        if label:                       # what a base pattern proves is observed
            nodes[i] = -60.0
            nodes[i, label] = 0.0
        else:
            nodes[i, ~np.array(bearable(text[slice(*toks[i])]))] = -60.0
    p = marginals(nodes, alike(text, toks), potentials["chain"], float(potentials["skip"]) if skip is None else skip, prior=prior)
    best = p.argmax(1)
    added = [(LABELS[k], *toks[i]) for i, k in enumerate(best) if not labels[i] and k and p[i, k] >= min_marginal]
    return base, added


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_pii(docs: DataFrame, skip: float | None = None, min_marginal: float = 0.9,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: base counts, the base spans' hash, and all spans."""
    bounded_batches(docs.sparkSession)
    docs = id_and_text(docs, id_col, text_col)
    potentials = train_potentials(docs)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                base, added = all_spans(text, potentials, skip, min_marginal)
                n = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append((doc_id, *(n[k] for k in KINDS), digest, _written(base + added), len(added)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return docs.mapInPandas(find, FOUND)


def redact(docs: DataFrame, skip: float | None = None, min_marginal: float = 0.9, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind, as [EMAIL]; null texts stay null, all columns stay."""
    bounded_batches(docs.sparkSession)
    potentials = train_potentials(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t, potentials, skip, min_marginal))

    return docs.withColumn(text_col, clean(F.col(text_col)))


def redacted(text: str, potentials: dict[str, np.ndarray], skip: float | None, min_marginal: float) -> str:
    base, added = all_spans(text, potentials, skip, min_marginal)
    out, at = [], 0
    for kind, s, e in sorted(base + added, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]
