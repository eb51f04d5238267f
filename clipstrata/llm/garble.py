"""Text that was decoded with the wrong encoding: found with a hidden Markov model, restored where nothing was lost.

The model has a clean state, a state for each pair (true encoding, encoding it was read with), and one for characters that
stand for lost bytes. It labels every character of a document:

* The clean state emits a character with its probability after the character before it, as counted over all documents.
* A pair's state emits what the inverse transform makes of the characters: they are turned back to bytes and decoded. A
  piece that decodes has the probability of the decoded character after the decoded one before it, under the same counts;
  what can't come from the pair is all but impossible. Pieces of several characters share their probability.
* Plain ASCII says nothing in any state, unless it is the second byte of a piece. Changing state costs ``SWITCH``.

The best path is found exactly. Each labelled span gets its state's inverse transform; a pair of one-byte encodings must
also make more likely words when letter case is left aside.

A path leaves the clean state only if a pair gains more over it, in one stretch, than entering and leaving costs. So a first
look finds, for each document and pair, the most that a stretch can gain; it runs over whole batches of documents as
arrays. Only documents where that is enough, or that have lost characters, are labelled, and only by those pairs: the first
look leaves out none that the model would label.

Counts come from all documents but those that a first model finds garbled; the first model is that of the documents without
pieces of UTF-8 read as a one-byte encoding and without lost characters, and judges all of them. A pair of characters is
weighed against ``WEIGHT`` of all characters: what follows a character that is rare in the whole corpus is no more certain
than the character itself is frequent. Garbled text, some of which is in the counts too, doesn't vouch for itself that way,
and no pair is left out for being rare, so correct text in a language with few documents keeps its own counts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstrata.session import bounded_batches, cut

#: Natural logarithms: the cost of a change of state, and of what a state can't emit.
SWITCH, NEVER = 4.6, -25.0
#: Share of all characters that stands against the counts of what follows a character.
WEIGHT = 1e-3
#: Pairs whose counts change no probability by more than this share are not sent to the driver.
FINE = 0.02
TOP = 0x110000
LOST = "lost"
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}")
_HIGH = re.compile("[\x80-\xff]")
_GB = re.compile("[\xa1-\xf7][\xa1-\xfe]")
_SJIS = re.compile("[\x81-\x9f\xe0-\xef][\x40-\x7e\x80-\xfc]")


def _bytes_of(*codecs: str) -> dict[int, str]:
    """Character to byte (as a character below 256), for one-byte encodings; bytes without a character stand for themselves."""
    table: dict[int, str] = {}
    for codec in codecs:
        for b in range(0x80, 0x100):
            try:
                c = bytes([b]).decode(codec)
            except UnicodeDecodeError:
                c = chr(b)
            table.setdefault(ord(c), chr(b))
    for b in range(0x80, 0x100):  # what the encoding lacks is read as Latin-1 by lenient decoders, or is no byte at all
        table.setdefault(b, chr(b) if b < 0xA0 and chr(b) not in table.values() else "Ā")
    return table


class _Map(dict):
    def __missing__(self, key: int) -> str:
        self[key] = got = chr(key) if key < 0x80 else "Ā"
        return got


class _Wide(dict):
    """Character to its bytes in an encoding of several bytes a character."""

    def __init__(self, codec: str) -> None:
        self.codec = codec

    def __missing__(self, key: int) -> str:
        try:
            got = chr(key).encode(self.codec).decode("latin-1")
        except UnicodeEncodeError:
            got = "Ā"
        self[key] = got
        return got


@dataclass(frozen=True)
class Pair:
    name: str
    true: str
    read: tuple[str, ...]
    piece: re.Pattern
    rounds: int = 1

    @property
    def one_byte(self) -> bool:
        return self.piece is _HIGH


#: Latin-1 and Windows-1252 differ only where one of them has control characters, so one table reads both.
WESTERN = ("cp1252", "latin-1")
PAIRS = (
    Pair("utf-8 as windows-1252", "utf-8", WESTERN, _UTF8),
    Pair("utf-8 as windows-1252 twice", "utf-8", WESTERN, _UTF8, 2),
    Pair("utf-8 as windows-1250", "utf-8", ("cp1250",), _UTF8),
    Pair("utf-8 as windows-1251", "utf-8", ("cp1251",), _UTF8),
    Pair("utf-8 as windows-1254", "utf-8", ("cp1254",), _UTF8),
    Pair("utf-8 as cp437", "utf-8", ("cp437",), _UTF8),
    Pair("utf-8 as cp850", "utf-8", ("cp850",), _UTF8),
    Pair("utf-8 as mac-roman", "utf-8", ("mac_roman",), _UTF8),
    Pair("utf-8 as gbk", "utf-8", ("gbk",), _UTF8),
    Pair("utf-8 as shift-jis", "utf-8", ("cp932",), _UTF8),
    Pair("utf-8 as big5", "utf-8", ("big5",), _UTF8),
    Pair("gbk as windows-1252", "gbk", WESTERN, _GB),
    Pair("shift-jis as windows-1252", "cp932", WESTERN, _SJIS),
    Pair("windows-1251 as windows-1252", "cp1251", WESTERN, _HIGH),
    Pair("koi8-r as windows-1252", "koi8-r", WESTERN, _HIGH),
    Pair("koi8-r as windows-1251", "koi8-r", ("cp1251",), _HIGH),
    Pair("windows-1251 as koi8-r", "cp1251", ("koi8-r",), _HIGH),
    Pair("windows-1251 as cp866", "cp1251", ("cp866",), _HIGH),
    Pair("cp866 as windows-1251", "cp866", ("cp1251",), _HIGH),
)
_WIDE = ("gbk", "cp932", "big5")
_TABLES = {p.read: _Wide(p.read[0]) if p.read[0] in _WIDE else _Map(_bytes_of(*p.read)) for p in PAIRS}
_DECODED: dict[tuple[str, str], str] = {}


def _decoded(piece: str, codec: str) -> str:
    """The character that the bytes make, empty if none."""
    got = _DECODED.get((piece, codec))
    if got is None:
        try:
            got = piece.encode("latin-1").decode(codec)
        except UnicodeDecodeError:
            got = ""
        if len(_DECODED) < 1 << 20:
            _DECODED[piece, codec] = got
    return got


def pieces(text: str, pair: Pair) -> list[tuple[int, int, str]]:
    """(start, stop, decoded) of the stretches of ``text`` that the pair can have made."""
    if pair.read[0] in _WIDE:
        table = _TABLES[pair.read]
        view = text.translate(table)
        owner: list[int] = []
        for i, c in enumerate(text):
            owner += [i] * len(table[ord(c)])
        found = [(owner[m.start()], owner[m.end() - 1] + 1, _decoded(m.group(), pair.true)) for m in pair.piece.finditer(view)]
        return [x for x in found if x[2]]
    view = text.translate(_TABLES[pair.read])
    found = [(m.start(), m.end(), c) for m in pair.piece.finditer(view) if (c := _decoded(m.group(), pair.true))]
    for _ in range(pair.rounds - 1):
        once = "".join(c for _, _, c in found)
        again = []
        view = once.translate(_TABLES[pair.read])
        for m in pair.piece.finditer(view):
            part = found[m.start() : m.end()]
            if all(x[1] == y[0] for x, y in zip(part, part[1:])) and (c := _decoded(m.group(), pair.true)):
                again.append((part[0][0], part[-1][1], c))
        found = again
    return found


def inverse(text: str, pair: Pair) -> str:
    """The whole of ``text`` put back to bytes and decoded; characters that are no piece stay."""
    out, at = [], 0
    if pair.read[0] in _WIDE:
        raw = text.translate(_TABLES[pair.read]).replace("Ā", "\xff")
        return raw.encode("latin-1").decode(pair.true, "replace")
    for a, b, c in pieces(text, pair):
        out += [text[at:a], c]
        at = b
    return "".join([*out, text[at:]])


class Language:
    """Probabilities of characters, from counts: of characters by code, of pairs by ``code before << 21 | code``."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        keys, counts = np.asarray(keys, np.int64)[order], np.asarray(counts, np.int64)[order]
        one = keys < TOP
        self.codes, self.held = keys[one], counts[one]
        self.keys, self.counts = keys[~one], counts[~one]
        self.clear()

    def clear(self) -> None:
        self.kept: dict[str, float] = {}
        self.dense: tuple[np.ndarray, np.ndarray] | None = None
        self.fold: dict[str, int] | None = None

    def __getstate__(self) -> dict:
        return {"codes": self.codes, "held": self.held, "keys": self.keys, "counts": self.counts}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.clear()

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(how often each character stands, its probability), by code."""
        if self.dense is None:
            held = np.zeros(TOP)
            held[self.codes] = self.held
            blocks = np.repeat(held.reshape(-1, 128).sum(1), 128)
            self.n = max(1.0, float(held.sum()))
            self.dense = held, (0.98 * held + 0.02 * blocks / 128 * 0.02) / self.n + 1e-9
        return self.dense

    def one(self, c: str) -> float:
        return float(self.tables()[1][ord(c)])

    def joint(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def after_all(self, before: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The logarithms of the probabilities of codes ``c`` after ``before``; 0 stands for the start of a text."""
        held, one = self.tables()
        weight = WEIGHT * self.n
        p = one[c]
        return np.log(np.where(before == 0, p, (self.joint(before.astype(np.int64) << 21 | c) + weight * p) / (held[before] + weight)))

    def after(self, before: str, c: str) -> float:
        """The logarithm of the probability of ``c`` after ``before``."""
        key = before + c
        got = self.kept.get(key)
        if got is None:
            got = float(self.after_all(np.array([ord(before) if before else 0]), np.array([ord(c)]))[0])
            if len(self.kept) < 1 << 20:
                self.kept[key] = got
        return got

    def words(self, text: str) -> float:
        """The logarithm of the probability of the text's letters, case left aside."""
        if self.fold is None:
            fold: Counter = Counter()
            for k, n in zip(self.keys.tolist(), self.counts.tolist()):
                fold[(chr(k >> 21) + chr(k & 0x1FFFFF)).lower()] += n
            self.fold = fold
        text = text.lower()
        return sum(math.log(self.fold.get(a + b, 0) + 0.1) for a, b in zip(text, text[1:]) if not (a.isascii() and b.isascii()))


def restore(text: str, spans: list[tuple[int, int, str]], lang: Language, pairs: tuple[Pair, ...] = PAIRS) -> tuple[str, str, bool] | None:
    """(restored text, states, whole?) of a text with these spans, None for a clean one. Not whole: something was lost for
    good."""
    named = {p.name: p for p in pairs}
    out, at, states, whole = [], 0, [], True
    for a, b, state in spans:
        if state == LOST:
            states.append(state)
            whole = False
            continue
        p = named[state]
        got = inverse(text[a:b], p)
        if p.one_byte and lang.words(got) <= lang.words(text[a:b]):
            continue
        states.append(state)
        whole &= "�" not in got
        out += [text[at:a], got]
        at = b
    return ("".join([*out, text[at:]]), ", ".join(sorted(set(states))), whole) if states else None


@lru_cache(maxsize=64)
def _byte_table(read: tuple[str, ...]) -> np.ndarray:
    """Code to byte of a one-byte encoding; 0 for what has none."""
    table = _TABLES[read]
    out = np.zeros(TOP, np.uint8)
    out[:0x80] = np.arange(0x80)
    for c, b in list(table.items()):
        if c >= 0x80 and b != "Ā":
            out[c] = ord(b)
    return out


@lru_cache(maxsize=64)
def _wide_table(codec: str) -> np.ndarray:
    """Code to its bytes (two of them as first << 8 | second); 0 for what has none."""
    out = np.zeros(TOP, np.uint16)
    out[:0x80] = np.arange(0x80)
    for c in range(0x80, 0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        try:
            b = chr(c).encode(codec)
        except UnicodeEncodeError:
            continue
        out[c] = int.from_bytes(b, "big") if len(b) < 3 else 0
    return out


@lru_cache(maxsize=64)
def _two_table(codec: str) -> np.ndarray:
    """First byte << 8 | second byte to the code they make; 0 for none."""
    out = np.zeros(1 << 16, np.int64)
    for k in range(0x8100, 1 << 16):
        try:
            c = k.to_bytes(2, "big").decode(codec)
        except UnicodeDecodeError:
            continue
        out[k] = ord(c) if len(c) == 1 else 0
    return out


@lru_cache(maxsize=64)
def _high_table(codec: str) -> np.ndarray:
    """Byte to the code it makes, for bytes from 0x80; 0 for none."""
    out = np.zeros(256, np.int64)
    for b in range(0x80, 0x100):
        out[b] = ord(_decoded(chr(b), codec) or "\0")
    return out


def _shifted(x: np.ndarray, k: int) -> np.ndarray:
    """``x`` at the places k further on (before, for k below 0); 0 beyond the ends."""
    out = np.zeros_like(x)
    if k > 0:
        out[:-k] = x[k:]
    else:
        out[-k:] = x[:k]
    return out


def _utf8_pieces(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, codes) of the characters in UTF-8 of more than one byte. They can't overlap."""
    b1, b2, b3 = (_shifted(b, k) for k in (1, 2, 3))
    more1, more2, more3 = ((x & 0xC0) == 0x80 for x in (b1, b2, b3))
    two = (b >= 0xC2) & (b <= 0xDF) & more1
    three = (b >= 0xE0) & (b <= 0xEF) & more1 & more2 & ~((b == 0xE0) & (b1 < 0xA0)) & ~((b == 0xED) & (b1 > 0x9F))
    four = (b >= 0xF0) & (b <= 0xF3) & more1 & more2 & more3 & ~((b == 0xF0) & (b1 < 0x90))
    at = np.flatnonzero(two | three | four)
    n = np.where(two[at], 2, np.where(three[at], 3, 4))
    x, x1, x2, x3 = (v[at].astype(np.int64) for v in (b, b1 & 0x3F, b2 & 0x3F, b3 & 0x3F))
    code = np.where(n == 2, (x & 0x1F) << 6 | x1, np.where(n == 3, (x & 0xF) << 12 | x1 << 6 | x2, (x & 7) << 18 | x1 << 12 | x2 << 6 | x3))
    return at, n, code


class View:
    """The characters beyond ASCII of many texts with a neighbour on each side, as arrays of codes."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        high = codes > 0x7F
        keep = np.flatnonzero(high | _shifted(high, 1) | _shifted(high, -1))
        self.codes, self.lengths = codes, lengths
        self.v, self.keep = codes[keep], keep
        self.doc = np.searchsorted(np.cumsum(lengths), keep, "right")
        self.before = np.where(self.v > 0x7F, _shifted(self.v, -1), 0)
        self.at = np.flatnonzero(self.v > 0x7F)

    def docs(self, at: np.ndarray) -> np.ndarray:
        """Which texts hold any of the places."""
        out = np.zeros(len(self.texts), bool)
        out[self.doc[at]] = True
        return out

    def suspect(self) -> np.ndarray:
        """Texts with a piece of UTF-8 read as a one-byte encoding, or lost characters: a model has to tell."""
        out = self.docs(np.flatnonzero(self.v == 0xFFFD))
        for read in {p.read for p in PAIRS if p.piece is _UTF8 and p.read[0] not in _WIDE}:
            out |= self.docs(_utf8_pieces(_byte_table(read)[self.v])[0])
        return out

    def counts(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, counts) of the characters and pairs of the texts that ``keep`` marks."""
        mine = self.codes[np.repeat(keep, self.lengths)]
        mine = mine[mine > 0]
        low = np.bincount(mine[mine < 0x80], minlength=0x80)
        high, n = np.unique(mine[mine >= 0x80], return_counts=True)
        at = self.at[keep[self.doc[self.at]]]
        at = at[self.before[at] > 0]
        two, m = np.unique(self.before[at] << 21 | self.v[at], return_counts=True)
        some = np.flatnonzero(low)
        return np.concatenate([some, high, two]), np.concatenate([low[some], n, m])

    def look(self, lang: Language, pairs: tuple[Pair, ...] = PAIRS) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """(marks, scores). Marks, texts x (pairs + 1): which pairs may draw a text's best path from the clean state, and last
        whether it has lost characters; no text whose best path leaves the clean state is without a mark. Scores, for pairs
        whose pieces can't overlap: (places, logarithms) in the texts marked."""
        v, at = self.v, self.at
        lost = self.docs(np.flatnonzero(v == 0xFFFD))
        marks = np.zeros((len(self.texts), len(pairs) + 1), bool)
        marks[:, -1] = lost
        scores: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        clean = self.clean = np.zeros(len(v))
        clean[at] = lang.after_all(self.before[at], v[at])
        plain = np.flatnonzero((v <= 0x7F) & (v > 0))
        clean[plain] = np.log(lang.tables()[1][v[plain]])
        beyond = v > 0x7F

        def add(places: np.ndarray, s: np.ndarray, exact: bool = True) -> None:
            """Marks texts with a stretch in which the pair gains enough: the steepest rise of the running sum of gains."""
            gain = s - clean[places]
            up = gain > 0
            some = np.bincount(self.doc[places[up]], gain[up], len(self.texts)) > 2 * SWITCH - 1e-3
            if some.any():
                mine = some[self.doc[places]]
                places, s = places[mine], s[mine]
                top = np.full(len(v), -np.inf)
                top[places] = s
                there = np.flatnonzero((np.isfinite(top) | beyond) & some[self.doc])
                gains = np.where(np.isfinite(top[there]), top[there], NEVER) - clean[there]
                doc = self.doc[there]
                # each text starts so far below the one before that the lowest sum so far is always one of its own
                fall = np.where(doc[1:] != doc[:-1], 64.0 * (self.lengths[doc[1:]] + self.lengths[doc[:-1]]), 0.0)
                sums = np.cumsum(gains) - np.concatenate([[0.0], np.cumsum(fall)])
                rise = sums - np.minimum.accumulate(sums - gains)
                marks[doc[rise > 2 * SWITCH - 1e-3], number] = True
            if exact:
                mine = marks[:, number][self.doc[places]]
                scores[number] = places[mine], s[mine]

        for number, p in enumerate(pairs):
            if p.read[0] in _WIDE:
                marks[:, number] = lost  # their bytes may be among what was lost
                wide = _wide_table(p.read[0])[v]
                n = np.where(wide > 0xFF, 2, 1)
                owner = np.repeat(np.arange(len(v)), n)
                second = np.ones(len(owner), bool)
                second[np.cumsum(n) - n] = False
                both = wide[owner]
                stream = np.where(second | (n[owner] == 1), both & 0xFF, both >> 8).astype(np.uint8)
            else:
                stream = _byte_table(p.read)[v]
                owner = None
            if p.piece is _UTF8:
                first, n, code = _utf8_pieces(stream)
                if not len(first):
                    continue
                a = first if owner is None else owner[first]
                b = (first + n - 1 if owner is None else owner[first + n - 1]) + 1
                follows = np.zeros(len(a), bool)
                follows[1:] = a[1:] == b[:-1]
                if p.rounds > 1:  # a piece of pieces: rare enough to be looked at
                    byte = _byte_table(p.read)[code]
                    marks[:, number] = self.docs(a[(byte >= 0xC2) & _shifted(follows, 1) & ((_shifted(byte, 1) & 0xC0) == 0x80)])
                    continue
                before = np.where(follows, _shifted(code, -1), _shifted(v, -1)[a])
                s = lang.after_all(before, code) / (b - a)
                score, has = np.zeros(len(v)), np.zeros(len(v), bool)
                for k in range(int((b - a).max())):
                    on = b - a > k
                    score += np.bincount(a[on] + k, s[on], len(v))
                    has[a[on] + k] = True
                add(np.flatnonzero(has), score[has])
                continue
            if p.one_byte:
                code = _high_table(p.true)[stream]
                i = np.flatnonzero((code > 0) & beyond)
                prior = np.where(_shifted(code, -1)[i] > 0, _shifted(code, -1)[i], _shifted(v, -1)[i])
                add(i, lang.after_all(prior, code[i]))
                continue
            nxt = _shifted(stream, 1)
            if p.piece is _GB:
                start = (stream >= 0xA1) & (stream <= 0xF7) & (nxt >= 0xA1) & (nxt <= 0xFE)
            else:
                start = (((stream >= 0x81) & (stream <= 0x9F)) | ((stream >= 0xE0) & (stream <= 0xEF))) & (((nxt >= 0x40) & (nxt <= 0x7E)) | ((nxt >= 0x80) & (nxt <= 0xFC)))
            code = np.where(start, _two_table(p.true)[stream.astype(np.int64) << 8 | nxt], 0)
            i = np.flatnonzero(code > 0)
            # which pieces a row is cut into depends on where it starts; the better of both is what can be gained
            s = lang.after_all(_shifted(v, -1)[i], code[i])
            chained = _shifted(code, -2)[i]
            s = np.maximum(s, np.where(chained > 0, lang.after_all(chained, code[i]), NEVER)) / 2
            top = np.full(len(v) + 1, -np.inf)
            top[i] = s
            top[i + 1] = np.maximum(top[i + 1], s)
            places = np.flatnonzero(np.isfinite(top[:-1]))
            add(places, top[places], exact=False)
        return marks, scores

    def spans(self, lang: Language, pairs: tuple[Pair, ...] = PAIRS) -> dict[int, list[tuple[int, int, str]]]:
        """For each text, by number, the (start, stop, state) that the best path gives to other states than the clean one."""
        marks, scores = self.look(lang, pairs)
        begin = np.cumsum(self.lengths) - self.lengths
        out = {}
        for i in np.flatnonzero(marks.any(1)).tolist():
            lo, hi = np.searchsorted(self.doc, [i, i + 1]).tolist()
            v, clean, home = self.v[lo:hi], self.clean[lo:hi], self.keep[lo:hi] - begin[i]
            beyond = v > 0x7F
            rows: list[tuple[str, np.ndarray]] = []
            if marks[i, -1]:
                rows.append((LOST, np.where(v == 0xFFFD, -1.0, np.where(beyond, NEVER, -np.inf))))
            for number in np.flatnonzero(marks[i, :-1]).tolist():
                p, row = pairs[number], np.full(hi - lo, -np.inf)
                if number in scores:
                    places, s = scores[number]
                    x, y = np.searchsorted(places, [lo, hi])
                    row[places[x:y] - lo] = s[x:y]
                else:
                    self._score("".join(map(chr, v.tolist())), p, lang, row)
                if p.read[0] in _WIDE and marks[i, -1]:  # bytes lost on the way leave their neighbours undecoded
                    gone = np.flatnonzero(v == 0xFFFD)
                    near = np.concatenate([gone - 1, gone + 1])
                    near = near[(near >= 0) & (near < hi - lo)]
                    near = near[beyond[near] & np.isneginf(row[near])]
                    row[near] = clean[near] - 1.0
                    row[gone] = -3.0
                row = np.where(np.isneginf(row) & beyond, NEVER, row)
                there = np.isfinite(row)
                sums = np.cumsum(row[there] - clean[there])
                if len(sums) and (sums - np.minimum.accumulate(np.minimum(np.concatenate([[0.0], sums[:-1]]), 0.0))).max() > 2 * SWITCH:
                    rows.append((p.name, row))
            if rows and (found := _path(np.array([r for _, r in rows]), clean)):
                out[i] = [(int(home[a]), int(home[b]) + 1, rows[k][0]) for a, b, k in found]
        return out

    @staticmethod
    def _score(text: str, p: Pair, lang: Language, row: np.ndarray) -> None:
        """Fills in the scores of pairs whose pieces depend on where a row of them starts."""
        last, before = -1, ""
        for a, b, c in pieces(text, p):
            row[a:b] = lang.after(before if a == last else text[a - 1] if a else "", c) / (b - a)
            last, before = b, c

    def restored(self, lang: Language) -> dict[int, tuple[str, str, bool]]:
        """The garbled texts by their number, restored."""
        found = {i: restore(self.texts[i], spans, lang) for i, spans in self.spans(lang).items()}
        return {i: r for i, r in found.items() if r}


def _path(rows: np.ndarray, clean: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, state) of the stretches of the best path that aren't clean. ``rows``: what each state emits by place;
    places that no state has anything to say about, which are plain, are passed over."""
    there = np.flatnonzero(np.isfinite(rows).any(0))
    plain = clean[there]
    emitted = [plain.tolist(), *(np.where(np.isfinite(r[there]), r[there], plain).tolist() for r in rows)]
    value, back = [0.0] + [-SWITCH] * len(rows), []
    for column in zip(*emitted):
        best = max(value)
        least, top = best - SWITCH, value.index(best)
        back.append([k if x >= least else top for k, x in enumerate(value)])
        value = [(x if x >= least else least) + e for x, e in zip(value, column)]
    state = max(range(len(value)), key=lambda k: value[k] - (SWITCH if k else 0.0))
    out: list[list[int]] = []
    for t in range(len(there) - 1, -1, -1):
        if state:
            if out and out[-1][2] == state - 1 and out[-1][3] == t + 1:
                out[-1][0], out[-1][3] = int(there[t]), t
            else:
                out.append([int(there[t]), int(there[t]), state - 1, t])
        state = back[t][state]
    return [(a, b, k) for a, b, k, _ in reversed(out)]


def views(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, View]]:
    """(number of the first text, view) of runs of texts with about so many characters, which bounds the arrays."""
    at = 0
    while at < len(texts):
        stop, n = at, 0
        while stop < len(texts) and (stop == at or n + len(texts[stop]) <= size):
            n += len(texts[stop])
            stop += 1
        yield at, View(texts[at:stop])
        at = stop


def _plain_bytes(column: pa.Array) -> np.ndarray:
    """How often each ASCII character stands in the texts of a column."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0x80, np.int64)
    return np.bincount(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]], minlength=0x100)[:0x80]


def _counted(docs: DataFrame, text: str, first=None) -> DataFrame:
    """(k, n): how often characters and pairs of characters stand in the documents.

    Without a first model: those of all documents that aren't suspect. With one: what has to be added for suspect
    documents that it finds clean, less those of the others that it finds garbled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in kept]) if kept else np.zeros(0, np.int64)
            n = np.concatenate([n for _, n in kept]) if kept else np.zeros(0, np.int64)
            keys, at = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, n)
            return keys, total

        for b in batches:
            texts = b.column(0).to_pylist()
            if first is None:
                low = np.flatnonzero(plain := _plain_bytes(pa.array([t for t in texts if t.isascii()], pa.large_string())))
                kept.append((low[low > 0], plain[low[low > 0]]))
            for _, view in views([t for t in texts if not t.isascii()]):
                odd = view.suspect()
                if first is None:
                    kept.append(view.counts(~odd))
                    continue
                bad = np.zeros(len(view.texts), bool)
                bad[list(view.restored(first.value))] = True
                kept.append(view.counts(odd & ~bad))
                keys, n = view.counts(~odd & bad)
                kept.append((keys, -n))
            size = sum(len(k) for k, _ in kept)
            if size > 2_000_000:
                kept = [merged()]
                if len(kept[0][0]) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(kept[0][0]), pa.array(kept[0][1])], names=["k", "n"])
                    kept = []
        keys, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["k", "n"])

    return docs.select(F.col(text).alias("t")).dropna().mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def _model(counts: DataFrame) -> Language:
    """At most as many rows as there are characters come to the driver, and for each 1 / (FINE x WEIGHT) of what precedes it."""
    chars = counts.filter(F.col("k") < TOP)
    own = chars.select(F.col("k").alias("_c"), F.col("n").alias("_n"))
    code = F.col("k").bitwiseAND(F.lit((1 << 21) - 1))
    pairs = counts.filter(F.col("k") >= TOP).withColumn("_c", code).join(F.broadcast(own), "_c")
    pairs = pairs.filter(F.col("n") > FINE * WEIGHT * F.col("_n")).select("k", "n")
    got = chars.unionByName(pairs).toArrow()
    return Language(got["k"].to_numpy(), got["n"].to_numpy())


def language(docs: DataFrame, text: str) -> Language:
    """Counts over all documents but those that a first model, of the documents without any suspect piece, finds garbled."""
    sure = cut(_counted(docs, text))
    first = docs.sparkSession.sparkContext.broadcast(_model(sure))
    counts = sure.unionByName(_counted(docs, text, first)).groupBy("k").agg(F.sum("n").alias("n")).filter("n > 0")
    return _model(cut(counts))


def garbled(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text, states, whole): the garbled documents with their restored text, the pairs met, and whether all of the
    original could be recovered (a lost character can't).

    Null, empty and plain ASCII texts are clean. Rows with a null id are left out. Repeated rows are judged each. Extra
    columns are ignored. An empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[doc]
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(language(docs, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = held.value
        for b in batches:
            texts = b.column(1).to_pylist()
            high = [i for i, t in enumerate(texts) if not t.isascii()]
            rows = [(high[at + i], *r) for at, view in views([texts[i] for i in high]) for i, r in view.restored(lang).items()]
            if rows:
                at, whole_texts, states, whole = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(whole_texts), pa.array(states), pa.array(whole)], names=["d", "t", "s", "w"])

    # plain ASCII texts can't be garbled and stay where they are
    d = docs.select(F.col(doc).alias("d"), F.col(text).alias("t")).dropna().filter(F.length("t") < F.octet_length("t"))
    return d.mapInArrow(run, f"d {kind}, t string, s string, w boolean").select(F.col("d").alias(doc), F.col("t").alias(text), F.col("s").alias("states"), F.col("w").alias("whole"))
