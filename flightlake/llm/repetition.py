"""Operator 7: quality rules with suffix-array repetition.

Base rules count words, symbols, repeated lines and words in repeated three-word
windows. The method sorts all word suffixes of a text, takes the intervals of
suffixes with a common prefix, keeps those that are maximal repeats (longer to
neither side) of at least `min_repeat` words, and unions their places. A text is
refused when these places cover more than `max_covered` of its words, or
its longest repeat is over `max_longest` words.

Many texts are sorted at once: suffixes are ranked by doubling prefixes, and a
suffix that is alone with its prefix leaves the sort, so clean texts cost two or
three rounds. Null and empty texts have no word and fail the base rule; repeated
rows are judged each for itself; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flightlake.llm import textkit as T
from flightlake.llm.runtime import bounded_batches, id_and_text

RULES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, kept boolean, n_covered long, longest_repeat long")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CONTINUES = (np.arange(256) & 0xC0) == 0x80



def suffix_ranks(word: np.ndarray, doc: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """[(k, ranks)] for k = 1, 2, 4, ...: suffixes have one rank in common as long as
    their first k words are the same words of the same text; the last ranks are the suffix order.

    Prefix doubling: a rank is the number of smaller suffixes, so a group that falls
    apart keeps its range, and suffixes alone in their group are not sorted again.
    A suffix ends with its text; one that has ended comes first in its group.
    """
    n = len(word)
    last = np.append(doc[1:] != doc[:-1], True)
    end = np.flatnonzero(last)[np.cumsum(last) - last] + 1
    _, group, size = np.unique(T.mix64(word ^ T.mix64(doc.astype(T.U64) + T.U64(1))), return_inverse=True, return_counts=True)
    rank = (np.cumsum(size) - size)[group]
    live = np.flatnonzero(size[group] > 1)
    levels, k = [(1, rank)], 1
    while len(live):
        ahead = live + k
        second = np.where(ahead < end[live], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(rank[live] * (n + 2) + second)
        old, second, live = rank[live][order], second[order], live[order]
        place = np.arange(len(live))
        new_old = np.append(True, old[1:] != old[:-1])
        new = new_old | np.append(True, second[1:] != second[:-1])
        rank = rank.copy()
        rank[live] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(new_old, place, 0))
        alone = new & np.append(new[1:], True)
        live = live[~alone]
        k *= 2
        levels.append((k, rank))
    return levels


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, from the ranks of the doubling."""
    n, total = len(levels[0][1]), np.zeros(len(a), np.int64)
    for k, rank in reversed(levels):
        x, y = a + total, b + total
        inside = (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[inside] = rank[x[inside]] == rank[y[inside]]
        total += k * same
    return total


def repeats(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest repeat (in its text) that starts with it.

    The suffix lies in the intervals of suffixes with a common prefix; the deepest
    one has the larger of the common prefixes with its neighbours in suffix order.
    """
    longest = np.zeros(len(word), np.int64)
    if len(word) < 2:
        return longest
    levels = suffix_ranks(word, doc)
    order = np.argsort(levels[-1][1])
    first = levels[0][1]
    near = np.flatnonzero(first[order[1:]] == first[order[:-1]])
    a, b = order[near], order[near + 1]
    lcp = common_prefixes(levels, a, b)
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest


def covered_words(longest: np.ndarray, doc: np.ndarray, min_repeat: int) -> np.ndarray:
    """Whether each word lies in a maximal repeat of at least min_repeat words.

    A repeat that its left neighbour's continues is not maximal: the longer one covers it.
    """
    n = len(longest)
    longer_left = np.zeros(n, bool)
    longer_left[1:] = (doc[1:] == doc[:-1]) & (longest[:-1] > longest[1:])
    at = np.flatnonzero((longest >= min_repeat) & ~longer_left)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.cumsum(change[:-1]) > 0


def _again(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found before in the same text, found twice or more in it) for each key."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    _, first, group, size = np.unique(T.mix64(keys ^ T.mix64(doc.astype(T.U64) + T.U64(1))), return_index=True, return_inverse=True, return_counts=True)
    return first[group] != np.arange(len(keys)), size[group] > 1


def measure(buf: np.ndarray, off: np.ndarray, min_repeat: int, max_covered: float, max_longest: int) -> dict[str, np.ndarray]:
    """The rules' columns for the texts of one block."""
    docs = len(off) - 1
    count = lambda doc, mask=None: np.bincount(doc if mask is None else doc[mask], minlength=docs)
    start, end, doc = T.words(buf, off)
    h = T.prefix_hash(buf)
    word = T.span_hash(h, start, end)
    n_words = count(doc)
    sums = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[off])
    inner = ~T._SPACE[buf]
    # lines: cut at every line end and at every text's end
    breaks = np.flatnonzero(buf == 10)
    edges = np.unique(np.concatenate((breaks, breaks + 1, off)))
    line_start, line_end = edges[:-1], edges[1:]
    chars = np.concatenate(([0], np.cumsum(inner)))
    has_word = chars[line_end] > chars[line_start]
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_doc = np.searchsorted(off, line_start, "right") - 1
    dup_line, _ = _again(T.span_hash(h, line_start, line_end), line_doc)
    windows, at = T.ngram_hash(word, doc, 3)
    _, twice = _again(windows, doc[at])
    in_window = np.zeros(len(word) + 2, bool)
    for k in range(3):
        in_window[at[twice] + k] = True
    n_repeat = count(doc, in_window[:len(word)])
    longest = repeats(word, doc)
    covered = count(doc, covered_words(longest, doc, min_repeat))
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, doc, longest)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    refused = (covered > max_covered * n_words) | (top > max_longest)
    return {"n_words": n_words, "word_chars": sums(inner & ~_CONTINUES[buf]), "n_symbols": sums(_SYMBOL[buf]),
            "n_dup_lines": count(line_doc, dup_line), "n_repeat_words": n_repeat, "base_failed": failed,
            "kept": ~failed & ~refused, "n_covered": covered, "longest_repeat": top}


def quality_rules(docs: DataFrame, min_repeat: int = 10, max_covered: float = 0.3, max_longest: int = 200,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document with the base counts, the repeats and the verdict."""
    bounded_batches(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, buf, off in T.text_blocks(b.column(1)):
                out = measure(buf, off, min_repeat, max_covered, max_longest)
                columns = [b.column(0).slice(first, len(off) - 1)]
                columns += [pa.array(v) if v.dtype == bool else pa.array(v.astype(np.int64)) for v in out.values()]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *out])

    return id_and_text(docs, id_col, text_col).mapInArrow(judge, RULES)
