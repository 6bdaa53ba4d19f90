"""Exact encoding with the tokenizers library, each distinct piece of text once.

Both vocabularies split a text at white space before they merge, so what stands between
two such splits can be encoded alone and its ids be used wherever it stands again. The
pieces of a block of texts are found and told apart by 64-bit hashes in whole-array
passes; only pieces that the worker has not met yet go to the tokenizer. Texts in
which white space is not single, or not ASCII, go through a slower, equally exact path.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from flightlake.llm import textkit as T

#: entries a worker keeps (about 150 bytes each), and the longest piece it keeps
CACHE_ENTRIES, CACHE_BYTES = 1_000_000, 48

_SAFE_SPLIT = re.compile(r"(?<=\S)(?= \S)")
#: the white space of Unicode (str.split() also takes \x1c-\x1f, which the tokenizer does not)
_WHITE = re.compile(r"[\t-\r \x85\xa0  -     　]+")
_TAILS = frozenset(",.;:!?")
#: capital I with dot: its lower case ends in a combining mark, which joins the mark after it
_DOTTED_I = "\u0130"
_TAIL = np.isin(np.arange(256), list(b",.;:!?"))
#: letters of ASCII, and the lead byte of those up to U+00FF
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), 0xC3])

_GAP = {"words": T._SPACE, "spaces": np.isin(np.arange(256), [0x20, 0x0A])}
#: bytes that make a text take the slow path, alone or with the byte after
_ODD = {"words": np.zeros(256, bool), "spaces": np.isin(np.arange(256), [9, 11, 12, 13, 28, 29, 30, 31])}
_ODD_PAIRS = ((0xC2, (0x85, 0xA0)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,)))
#: what a span is: a piece as it stands, a piece after a blank, or a whole text for the slow path
PLAIN, SPACED, WHOLE = 0, 1, 2


class CachedEncoder:
    """style "spaces": byte-level BPE whose pieces carry their leading blank.
    style "words": white space is dropped, case ignored, words are encoded alone.
    """

    def __init__(self, path: str, style: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.style = style
        # tokens that begin with a blank (byte-level vocabularies write it as this letter) or end a word
        vocab = self.tok.get_vocab()
        mark = (lambda t: t.startswith("\u0120")) if style == "spaces" else (lambda t: t.endswith("</w>"))
        self.marked = np.zeros(max(vocab.values()) + 1, bool)
        self.marked[[i for token, i in vocab.items() if mark(token)]] = True
        self._forget()

    def _forget(self) -> None:
        """The cache: ascending names, where each one's ids begin in `table`, and how many they are."""
        self.names, self.place, self.size = np.zeros(0, T.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.table, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin and end in them."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for _, buf, off in T.text_blocks(texts):
            got, n = self._block(buf, off)
            ids.append(got)
            counts.append(n)
        return np.concatenate(ids), np.cumsum(np.concatenate(counts))

    def _slow_texts(self, buf: np.ndarray, off: np.ndarray, gap: np.ndarray) -> np.ndarray:
        odd = _ODD[self.style][buf]
        for lead, seconds in _ODD_PAIRS:
            at = np.flatnonzero(buf[:-1] == lead)
            odd[at[np.isin(buf[at + 1], seconds)]] = True
        if self.style == "spaces":          # white space at an end of a text or beside other white space
            odd[:-1] |= gap[:-1] & gap[1:]
            size = np.diff(off) > 0
            for at in (off[:-1][size], off[1:][size] - 1):
                odd[at] |= gap[at]
        return np.bincount(np.searchsorted(off, np.flatnonzero(odd), "right") - 1, minlength=len(off) - 1) > 0

    def _block(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        docs = len(off) - 1
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
        gap = _GAP[self.style][buf]
        slow = self._slow_texts(buf, off, gap)
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        start = np.flatnonzero(~gap & (np.append(True, gap[:-1]) | edge[:-1]))
        end = np.flatnonzero(~gap & (np.append(gap[1:], True) | edge[1:])) + 1
        kind = np.zeros(len(start), np.int64)
        if self.style == "spaces":
            kind[1:] = (buf[start[1:] - 1] == 0x20) & ~edge[start[1:]]
            breaks = np.flatnonzero(buf == 0x0A)
            start, end, kind = np.concatenate((start, breaks)), np.concatenate((end, breaks + 1)), np.concatenate((kind, np.zeros(len(breaks), np.int64)))
        if slow.any():
            fast = ~slow[np.searchsorted(off, start, "right") - 1]
            n = int(slow.sum())
            start, end, kind = np.concatenate((start[fast], off[:-1][slow])), np.concatenate((end[fast], off[1:][slow])), np.concatenate((kind[fast], np.full(n, WHOLE)))
        order = np.argsort(start, kind="stable")
        start, end, kind = start[order], end[order], kind[order]
        name = T.span_hash(T.prefix_hash(buf), start, end) ^ (kind.astype(T.U64) * T.U64(0x9E3779B97F4A7C15))
        unique, first, inverse = np.unique(name, return_index=True, return_inverse=True)
        at, size = self._ids(buf, unique, start[first], end[first], kind[first])
        n, at = size[inverse], at[inverse]
        ids = self.table[np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)]
        doc = np.searchsorted(off, start, "right") - 1
        return ids, np.bincount(doc, n, minlength=docs).astype(np.int64)

    def _ids(self, buf: np.ndarray, names: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct span begin in the table, and how many they are; names are ascending."""
        if len(self.names) > CACHE_ENTRIES:
            self._forget()
        found = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        hit = self.names[found] == names if len(self.names) else np.zeros(len(names), bool)
        at, size = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        at[hit], size[hit] = self.place[found[hit]], self.size[found[hit]]
        kept = ~hit & (kind != WHOLE) & (end - start <= CACHE_BYTES)
        keep, rest = np.flatnonzero(kept), np.flatnonzero(~hit & ~kept)

        def encode(some: np.ndarray) -> None:
            joined = self._joinable(buf, start[some], end[some], kind[some])
            for part, how in ((some[joined], self._encode_joined), (some[~joined], self._encode_alone)):
                for i in range(0, len(part), 1 << 16):
                    p = part[i:i + (1 << 16)]
                    at[p], size[p] = self._add(*how(buf, start[p], end[p], kind[p]))

        if len(keep):
            encode(keep)
            joint = [np.concatenate(x) for x in ((self.names, names[keep]), (self.place, at[keep]), (self.size, size[keep]))]
            order = np.argsort(joint[0], kind="stable")
            self.names, self.place, self.size = (x[order] for x in joint)
        used = self.used
        encode(rest)
        self.used = used            # what isn't kept stands behind what is, and the next block overwrites it
        return at, size

    def _add(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.used + len(ids) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros(max(len(self.table), len(ids)), np.uint32)))
        self.table[self.used:self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        return at, size

    def _joinable(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Spans that may stand in one text and be told apart in its ids: those after a blank,
        or words of Latin letters with at most one mark after them."""
        if self.style == "spaces":
            return kind == SPACED
        ok = _LETTER[buf]
        ok[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        bad = np.concatenate(([0], np.cumsum(~ok)))
        core = end - self._has_tail(buf, start, end)
        return (kind == PLAIN) & (bad[core] == bad[start])

    def _has_tail(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (_TAIL[buf[end - 1]] & (end - start > 1)).astype(np.int64) if len(end) else np.zeros(0, np.int64)

    def _encode_joined(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each span) of joinable spans, encoded as one text with a blank before each."""
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        length = end - start + 1
        upto = np.cumsum(length)
        raw = buf[np.maximum(np.arange(upto[-1]) + np.repeat(start - 1 - (upto - length), length), 0)]
        raw[upto - length] = 0x20
        ids = np.array(self.tok.encode_batch_fast([raw.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        marks = np.flatnonzero(self.marked[ids])
        each = np.ones(len(start), np.int64) if self.style == "spaces" else 1 + self._has_tail(buf, start, end)
        if len(marks) != each.sum():
            return self._encode_alone(buf, start, end, kind)
        if self.style == "spaces":
            return ids, np.diff(np.append(marks, len(ids)))
        return ids, np.diff(np.concatenate(([0], marks[np.cumsum(each) - 1] + 1)))

    def _encode_alone(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of any spans."""
        raw = buf.tobytes() if len(start) > 64 else None
        text = [(raw[s:e] if raw is not None else buf[s:e].tobytes()).decode() for s, e in zip(start.tolist(), end.tolist())]
        got: list[bytes] = [b""] * len(text)
        for what, blank in ((PLAIN, ""), (SPACED, " ")):
            some = np.flatnonzero(kind == what).tolist()
            for i, ids in zip(some, self._encode_pieces([text[i] for i in some], blank)):
                got[i] = ids
        for i in np.flatnonzero(kind == WHOLE).tolist():
            parts = [w for w in _WHITE.split(text[i]) if w] if self.style == "words" else _SAFE_SPLIT.split(text[i])
            got[i] = b"".join(self._encode_pieces(parts, ""))
        return np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), np.int64, len(got)) >> 2

    def _core(self, piece: str) -> tuple[str, str]:
        """(what is encoded, the mark after it): after a letter the mark is split off in every text."""
        tail = ""
        if piece[-1] in _TAILS and len(piece) > 1 and piece[-2] < "ɐ" and piece[-2].isalpha() and piece[-2] != _DOTTED_I:
            piece, tail = piece[:-1], piece[-1]
        if self.style == "words" and piece.isascii():
            piece = piece.lower()
        return piece, tail

    def _encode_pieces(self, pieces: list[str], blank: str) -> list[bytes]:
        cores = [self._core(p) for p in pieces]
        new = list({core for core, _ in cores})
        ids: dict[str, bytes] = {}
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            ids.update(zip(part, self._raw([blank + p for p in part])))
        tails = {t: self._raw([t])[0] if t else b"" for t in {t for _, t in cores}}
        return [ids[core] + tails[tail] for core, tail in cores]

    def _raw(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]


_encoders: dict[tuple[str, str], CachedEncoder] = {}


def encoder(path: str, style: str) -> CachedEncoder:
    """One encoder (and cache) a worker process."""
    if (path, style) not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")        # Spark already runs a task a core
        _encoders[path, style] = CachedEncoder(path, style)
    return _encoders[path, style]
