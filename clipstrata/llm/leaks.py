"""Passages of held-out items in documents: a prefix-filtered set join with exact verification.

A passage is ``least`` words in a row of an item (``least_chars`` characters for an item in a script without spaces), of
which at most one in ``one_in`` is changed, dropped or added in the document. Typography and layout don't count: texts are
compared without mark-up, case, punctuation, width variants and invisible characters.

* *Shingles.* An item's words (characters) give shingles of five. A passage of n words with e edits keeps at least
  n - 4 - 5e of its shingles, which is what makes the filters below complete: 5 for words, 8 for characters.
* *Rarity.* One pass over all documents counts in how many each shingle of an item stands.
* *Short windows suffice.* A passage of any length holds one that is shorter than ``Passage.longest`` words: cut it into
  stretches of half of that; one of them has no more edits for its length than the whole, and after edits at its ends are
  trimmed it is still ``least`` words long. So windows up to that length are all that has to be looked at, and no step costs
  more than the items' length times a constant.
* *Prefixes.* For every window of an item that could be a passage, the shingles are ordered by rarity; a document that
  holds the window must share one of the rarest 5e + 1. Only these are looked up to make candidates, so shingles that
  stand in many documents make none. Of windows with equal e the shortest have the others' prefixes in theirs.
* *Bounds.* A candidate needs that many shared shingles whose places in item and document run in step, up to the edits
  allowed, within a stretch as long as a window.
* *Verification.* In that band an alignment finds whether any window of the item has few enough edits, exactly.

Wording that stands in ``common`` or more items (``wording`` words in a row of a sentence) is no item's own and is cut out
of the items before. It is counted over all items, however many
blocks they fill. Items come in blocks of bounded size, and documents are read where they lie: no text is shuffled.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstrata.session import bounded_batches, stored

_INLINE = re.compile(r"</?(?:a|b|i|u|s|em|strong|span|sub|sup|mark|small|code|font|q)(?:\s[^<>]*)?>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?。！？]+(?=\s|$|[^\x00-\x7f])|[。！？\n]+|[!?]+")
_UNSPACED = re.compile(r"[぀-ヿ㐀-鿿豈-﫿฀-๿]")
_UNSEEN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(0x10000) if unicodedata.category(chr(c)) == "Cf") + "]+")
#: Characters of items that are kept as one broadcast block.
BLOCK_CHARS = 4 << 20


@dataclass(frozen=True)
class Passage:
    least: int = 20
    least_chars: int = 30
    one_in: int = 8
    common: int = 3
    wording: int = 10
    wording_chars: int = 20
    shingle: int = 5

    def longest(self, least: int) -> int:
        """Twice the words that still leave ``least`` when as many as may be edited are trimmed."""
        return 2 * -(-least * self.one_in // (self.one_in - 2)) if self.one_in > 2 else 1 << 40


def plain(text: str) -> str:
    """The text without mark-up, width and case variants, and invisible characters."""
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKC", text).casefold()
    return _UNSEEN.sub("", text)


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def chars(text: str) -> list[str]:
    return [c for c in text if c.isalnum()]


def unspaced(text: str) -> bool:
    """More than a third of the letters belong to a script without spaces."""
    return 3 * len(_UNSPACED.findall(text)) > sum(map(str.isalnum, text))


def _sentences(text: str) -> tuple[bool, list[list[str]]]:
    """(by characters?, words of each sentence)."""
    text = plain(text)
    zh = unspaced(text)
    return zh, [w for s in _SENTENCE.split(text) if (w := chars(s) if zh else words(s))]


def _wordings(s: list[str], zh: bool, p: Passage) -> list[tuple]:
    k = p.wording_chars if zh else p.wording
    return [tuple(s[i : i + k]) for i in range(max(1, len(s) - k + 1))]


def _digest(g: tuple) -> bytes:
    return hashlib.blake2b("\0".join(g).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def own_stretches(items: list[tuple[int, str]], p: Passage, shared: set[bytes] | None = None) -> list[tuple[int, bool, list[str]]]:
    """(item, by characters?, words): what is left of each item without the wording of several items.

    ``shared``: digests of that wording, where there are more items than these.
    """
    read = [(item, *_sentences(text)) for item, text in items if text]
    size = lambda zh: p.wording_chars if zh else p.wording
    grams = lambda s, zh: _wordings(s, zh, p)
    holders: dict[tuple, set[int]] = defaultdict(set)
    for item, zh, sentences in read if shared is None else []:
        for s in sentences:
            for g in grams(s, zh):
                holders[g].add(item)
    common = (lambda g: len(holders[g]) >= p.common) if shared is None else lambda g: _digest(g) in shared
    out = []
    for item, zh, sentences in read:
        k, run = size(zh), []
        for s in sentences:
            cut = [False] * len(s)
            for i, g in enumerate(grams(s, zh)):
                if common(g):
                    cut[i : i + k] = [True] * len(cut[i : i + k])
            for w, c in zip(s, cut):
                if not c:
                    run.append(w)
                elif run:
                    out.append((item, zh, run))
                    run = []
        if run:
            out.append((item, zh, run))
    return [(i, z, r) for i, z, r in out if len(r) >= (p.least_chars if z else p.least)]


class Index:
    """The shingles of one block of items."""

    def __init__(self, items: list[tuple[int, str]], p: Passage, shared: set[bytes] | None = None) -> None:
        self.p, self.parts = p, own_stretches(items, p, shared)
        self.ids: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.at: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        self.seqs = []
        for n, (_, zh, run) in enumerate(self.parts):
            ids = self.ids[zh]
            seq = [ids.setdefault(w, len(ids) + 1) for w in run]
            self.seqs.append(seq)
            for i, g in self._grams(zh, seq):
                self.at[g].append((n, i))
        self.number = {g: i for i, g in enumerate(self.at)}
        self.prefix: set[tuple] = set(self.at)

    def _grams(self, zh: bool, seq: list[int]) -> Iterator[tuple[int, tuple]]:
        k = self.p.shingle
        for i in range(len(seq) - k + 1):
            yield i, (zh, *seq[i : i + k])

    def streams(self, text: str) -> Iterator[tuple[bool, list[int]]]:
        text = plain(text)
        if self.ids[0]:
            yield False, [self.ids[0].get(w, 0) for w in words(text)]
        if self.ids[1] and _UNSPACED.search(text):
            yield True, [self.ids[1].get(c, 0) for c in chars(text)]

    def hits(self, zh: bool, seq: list[int]) -> list[tuple[int, tuple]]:
        """Places of the stream where a shingle of an item stands."""
        k = self.p.shingle
        out, run = [], 0
        for j, w in enumerate(seq):
            run = run + 1 if w else 0
            if run >= k and (g := (zh, *seq[j - k + 1 : j + 1])) in self.at:
                out.append((j - k + 1, g))
        return out

    def keep_prefixes(self, held_by: dict[int, int]) -> None:
        """Leaves, for look-up, the shingles that are in the prefix of any window which could be a passage."""
        self.prefix = set()
        for n, (_, zh, run) in enumerate(self.parts):
            p, least = self.p, self.p.least_chars if zh else self.p.least
            grams = [g for _, g in self._grams(zh, self.seqs[n])]
            rarity = np.array([held_by.get(self.number[g], 0) for g in grams])
            order = np.lexsort((np.arange(len(grams)), rarity)).argsort()
            most = min(p.longest(least), len(run) + 1)
            kept = np.zeros(len(grams), bool)
            for words_ in [least, *range(-(-(least + 1) // p.one_in) * p.one_in, most, p.one_in)]:
                wide, room = words_ - p.shingle + 1, p.shingle * (words_ // p.one_in) + 1
                if room >= wide:
                    kept[:] = True
                for at in range(0, len(grams) - wide + 1, 4096):
                    view = np.lib.stride_tricks.sliding_window_view(order[at : at + 4096 + wide - 1], wide)
                    first = np.argpartition(view, min(room, wide) - 1, axis=1)[:, :room] + np.arange(at, at + len(view))[:, None]
                    kept[first.ravel()] = True
            self.prefix.update(g for g, k in zip(grams, kept.tolist()) if k)

    def found(self, text: str) -> set[int]:
        out: set[int] = set()
        for zh, seq in self.streams(text):
            hits = self.hits(zh, seq)
            ask = {n for _, g in hits if g in self.prefix for n, _ in self.at[g] if self.parts[n][0] not in out}
            if not ask:
                continue
            by: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for j, g in hits:
                for n, i in self.at[g]:
                    if n in ask:
                        by[n].append((i, j))
            for n, pairs in by.items():
                if self.parts[n][0] not in out and self._holds(n, zh, seq, pairs):
                    out.add(self.parts[n][0])
        return out

    def _holds(self, n: int, zh: bool, stream: list[int], pairs: list[tuple[int, int]]) -> bool:
        seq, p = self.seqs[n], self.p
        least, k = p.least_chars if zh else p.least, p.shingle
        most = min(len(seq), p.longest(least))
        slack = most // p.one_in
        need = max(1, min(m - k + 1 - k * (m // p.one_in) for m in range(least, most + 1)))
        i, j = np.array(pairs).T
        order = np.lexsort((j, j - i))
        diag, j = (j - i)[order], j[order]
        whole = least - k  # that many steps from one shingle to the next along a diagonal: a passage without edits
        if len(diag) > whole and ((diag[whole:] == diag[: len(diag) - whole]) & (j[whole:] == j[: len(j) - whole] + whole)).any():
            return True
        # shared shingles of a passage lie on diagonals at most ``slack`` apart, and in the text within a window and its
        # additions; what starts on one of the diagonals up to ``slack`` is looked for at once
        at = 0
        while at < len(diag):
            low = int(diag[at])
            near = np.sort(j[at : np.searchsorted(diag, low + 2 * slack, "right")])
            if len(near) >= need and (near[need - 1 :] - near[: len(near) - need + 1] <= most + slack).any():
                if aligned(seq, stream, low - slack, low + 2 * slack, least, p.one_in, most):
                    return True
            at = int(np.searchsorted(diag, low + slack, "right"))
        return False


def aligned(item: list[int], text: list[int], low: int, high: int, least: int, one_in: int, most: int | None = None) -> bool:
    """True if some window of at least ``least`` words of ``item``, which starts and ends with words that are in the text,
    aligns with a stretch of ``text`` at no more edits than one in ``one_in`` of its words, with its start on one of the
    diagonals low..high (text place less item place). Ids above 0 are equal or not; 0 equals nothing.

    From every start of a run of equal words, the furthest item place is kept for each number of edits and diagonal, and
    extended along equal words: of windows with one start and as many edits, the longest is all that matters. ``most``:
    windows up to this length are enough.
    """
    n, m = len(item), len(text)
    at: dict[int, list[int]] = defaultdict(list)
    for j in range(max(0, low), min(m, n + high)):
        if text[j]:
            at[text[j]].append(j)
    for i0, w in enumerate(item):
        if n - i0 < least:
            return False
        there = at.get(w, ())
        for j0 in there[bisect.bisect_left(there, i0 + low) : bisect.bisect_right(there, i0 + high)] if there else ():
            if (i0 and j0 and item[i0 - 1] == text[j0 - 1]):
                continue  # out of the band, or a run that starts earlier is the longer window
            reach = {j0 - i0: i0}
            for edits in range(min(n - i0, most or n) // one_in + 1):
                far: dict[int, int] = {}
                for d, i in reach.items():
                    start = i
                    while i < n and i + d < m and item[i] == text[i + d] and item[i]:
                        i += 1
                    if i > start and i - i0 >= max(least, one_in * edits):
                        return True
                    # with more edits than this the window's end alone is a passage, or no end makes it one
                    if i - i0 + least < one_in * (edits + 1):
                        continue
                    # changed, dropped, added
                    for e, k in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):
                        if k <= n and k > far.get(e, -1):
                            far[e] = k
                if not far:
                    break
                reach = far
    return False


def _shared(own: DataFrame, kind: str, blocks: int, p: Passage) -> DataFrame:
    """(b, h): for each block of items the digests of wording in it that stands in several items of any block."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in enumerate(batch.column(1).to_pylist()):
                zh, sentences = _sentences(t)
                h = list({_digest(g) for s in sentences for g in _wordings(s, zh, p)})
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([row] * len(h), pa.int64())), pa.array(h, pa.binary())], names=["i", "h"])

    held = stored(own.mapInArrow(grams, f"i {kind}, h binary").distinct(), "wording")
    several = held.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= p.common)
    return stored(held.join(several, "h", "left_semi").select(_block(blocks).alias("b"), "h").distinct(), "shared")


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("i"), F.lit(blocks))


def leaks(docs: DataFrame, items: DataFrame, *, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", passage: Passage | None = None) -> DataFrame:
    """(doc, item): each document with each item of which it holds a passage, once.

    Null and empty texts hold nothing; items that are shorter than a passage, or null, are never found. Rows with a null
    id are left out. Repeated documents or items change nothing. Extra columns are ignored.
    """
    p = passage or Passage()
    spark = docs.sparkSession
    bounded_batches(spark)
    own = items.select(F.col(item).alias("i"), F.col(item_text).alias("t")).dropna()
    chars_ = own.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars_ // BLOCK_CHARS))
    d = docs.select(F.col(doc).alias("d"), F.col(text).alias("t")).dropna()
    kind = dict(docs.dtypes)[doc], dict(items.dtypes)[item]
    out = None
    several = _shared(own, kind[1], blocks, p) if blocks > 1 else None
    for b in range(blocks):
        part = own if blocks == 1 else own.filter(_block(blocks) == b)
        shared = None if several is None else {bytes(r.h) for r in several.filter(F.col("b") == b).collect()}
        index = Index([(r.i, r.t) for r in part.collect()], p, shared)  # a block is bounded by BLOCK_CHARS
        held = spark.sparkContext.broadcast(index)

        def rarity(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ix, n = held.value, Counter()
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    n.update({ix.number[g] for zh, s in ix.streams(t) for _, g in ix.hits(zh, s)})
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], names=["g", "n"])

        counts = d.select("t").mapInArrow(rarity, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
        index.keep_prefixes({r.g: r.n for r in counts.collect()})  # one row a shingle of the block
        ready = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], ready=ready) -> Iterator[pa.RecordBatch]:
            ix = ready.value
            for batch in batches:
                ids, hit = batch.column(0), []
                for row, t in enumerate(batch.column(1).to_pylist()):
                    hit += [(row, i) for i in sorted(ix.found(t))]
                if hit:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array([r for r, _ in hit])), pa.array([i for _, i in hit])], names=["d", "i"])

        one = d.mapInArrow(search, f"d {kind[0]}, i {kind[1]}")
        out = one if out is None else out.unionByName(one)
    return out.select(F.col("d").alias(doc), F.col("i").alias(item)).distinct()
