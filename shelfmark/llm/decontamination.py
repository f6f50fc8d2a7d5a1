"""Benchmark decontamination by the q-gram lemma and banded alignment.

A text of m characters with at most k edits keeps at least m + 1 - q - k*q of
its q-grams, and they lie on diagonals at most k apart. So a document is read
three times, each time less of it: regions with enough q-grams of any benchmark
item, then bands of diagonals of one item with the starts at which a passage has
enough of them, then the alignment of these passages inside that band.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import MIX_1, small_batches, text_slices

Q = 12
WINDOW = 80
EDITS_PER = 20
SHORTEST = Q
ALIGNED = 4_096
NOTHING = 0xFFFFFFFF
TABLE_BITS = 22
MAX_PART_BYTES = 16 * 1024 * 1024
BASE = 0x9E3779B97F4A7C15
POWERS = [np.uint64(pow(BASE, n, 1 << 64)) for n in range(5)]
LEAKS = "doc_id long, item_id long, item_at int, begin int, end int, edits int"


def normal_codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a text in lower case, with every run of other signs than letters and digits as one space.

    The second array holds each one's place in the lower-cased text.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _word_table()[codes]
    keep = word.copy()
    keep[1:] |= word[:-1]
    codes = np.where(word, codes, np.uint32(32))
    places = np.flatnonzero(keep)
    return codes[places], places


@functools.cache
def _word_table() -> np.ndarray:
    """Which code points are letters or digits."""
    return np.array([chr(c).isalnum() for c in range(0x110000)], bool)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the q-grams of 12 characters."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    one = codes.astype(np.uint64)
    two = one[:-1] * POWERS[1] + one[1:]
    four = two[:-2] * POWERS[2] + two[2:]
    eight = four[:-4] * POWERS[4] + four[4:]
    return (eight[:-4] * POWERS[4] + four[8:]) * MIX_1


def searched_items(items: list[tuple[int, str]]) -> list[tuple[int, np.ndarray, int, int, int]]:
    """(item_id, codes, passage length, edits, least shared q-grams) of every item to search for.

    A passage is 80 characters with one edit per 20, or a whole shorter item; below
    24 characters it has no edits. Items of fewer than 12 characters hold no q-gram
    and are left out.
    """
    found = []
    for item_id, text in items:
        codes, _ = normal_codes(text or "")
        codes = codes[1:] if len(codes) and codes[0] == 32 else codes
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        if item_id is None or len(codes) < SHORTEST:
            continue
        length = min(WINDOW, len(codes))
        edits = min(length // EDITS_PER, length // Q - 1)
        found.append((item_id, codes, length, edits, length + 1 - Q - edits * Q))
    return found


def passages(items: list[tuple[int, str]]) -> Iterator[tuple[int, int, np.ndarray, int, int]]:
    """(item_id, place, codes, edits, least shared q-grams) of every passage that is searched: one at each start of an item."""
    for item_id, codes, length, edits, least in searched_items(items):
        for at in range(len(codes) - length + 1):
            yield item_id, at, codes[at : at + length], edits, least


def banded_distances(
    text: np.ndarray, passages: np.ndarray, firsts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, begin, end) of the best match of each row of ``passages`` on ``width`` diagonals of ``text``.

    The first diagonal of a row begins at the place ``firsts`` of the text; a match may begin and end on any of them.
    """
    n, length = passages.shape
    steps = np.arange(width)
    # one row per character of the passage; begins carries the diagonal on which each best path entered
    cost, begins = np.zeros((n, width), np.int64), np.tile(steps, (n, 1))
    places = firsts[:, None] + steps
    for i in range(length):
        at = places + i
        inside = (at >= 0) & (at < len(text))
        signs = np.where(inside, text[np.clip(at, 0, len(text) - 1)], NOTHING) if len(text) else np.full(at.shape, NOTHING)
        new, start = cost + (signs != passages[:, i, None]), begins.copy()
        # a character of the passage that the text lacks leads to the diagonal below
        better = cost[:, 1:] + 1 < new[:, :-1]
        new[:, :-1] = np.where(better, cost[:, 1:] + 1, new[:, :-1])
        start[:, :-1] = np.where(better, begins[:, 1:], start[:, :-1])
        # a run of insertions: the cheapest cell to the left, one edit per step
        slope = new - steps
        lowest = np.minimum.accumulate(slope, axis=1)
        origin = np.maximum.accumulate(np.where(slope == lowest, steps, 0), axis=1)
        cost, begins = lowest + steps, np.take_along_axis(start, origin, axis=1)
    rows, best = np.arange(n), cost.argmin(axis=1)
    begin = np.clip(firsts + begins[rows, best], 0, len(text))
    return cost[rows, best], begin, np.clip(firsts + best + length, 0, len(text))


def banded_distance(text: np.ndarray, passage: np.ndarray, band: int) -> tuple[int, int, int]:
    """(edits, begin, end) of the best match of ``passage`` inside ``text``, which may begin and end anywhere."""
    first = np.array([-len(passage)])
    return tuple(int(x[0]) for x in banded_distances(text, passage[None, :], first, len(text) + len(passage) + 1))


class Searcher:
    """The q-gram index of the items, and the three steps over one document."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = searched_items(items)
        grams = [gram_hashes(i[1]) for i in self.items]
        sizes = [len(g) for g in grams]
        hashes = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in sizes]])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hashes >> np.uint64(64 - TABLE_BITS)] = True
        self.least = np.array([i[4] for i in self.items], np.int64)
        self.edits = np.array([i[3] for i in self.items], np.int64)
        self.reach = WINDOW + int(self.edits.max(initial=0))
        self.fewest = int(self.least.min()) if len(sizes) else 1

    def regions(self, grams: np.ndarray) -> np.ndarray:
        """The places of q-grams of any item that lie in a window with enough of them."""
        near = np.flatnonzero(self.table[grams >> np.uint64(64 - TABLE_BITS)])
        if len(near) < self.fewest:
            return near[:0]
        ahead = np.searchsorted(near, near + self.reach)
        full = np.flatnonzero(ahead - np.arange(len(near)) >= self.fewest)
        if not len(full):
            return near[:0]
        cover = np.zeros(len(near) + 1, np.int64)
        np.add.at(cover, full, 1)
        np.add.at(cover, ahead[full], -1)
        return near[np.cumsum(cover[:-1]) > 0]

    def bands(self, grams: np.ndarray, near: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(item, diagonal, starts) of every band of diagonals and the starts at which a passage shares enough q-grams there."""
        left = np.searchsorted(self.hashes, grams[near], "left")
        count = np.searchsorted(self.hashes, grams[near], "right") - left
        at = np.repeat(near, count)
        entry = np.repeat(left - (np.cumsum(count) - count), count) + np.arange(len(at))
        owner, place = self.owner[entry], self.place[entry]
        diagonal = at - place
        order = np.lexsort((diagonal, owner))
        owner, diagonal, place = owner[order], diagonal[order], place[order]
        # bands overlap: each begins at a diagonal with a hit and is 2k+1 wide
        key = owner * (1 << 40) + diagonal
        ends = np.searchsorted(key, key + 2 * self.edits[owner] + 1)
        good = np.flatnonzero(ends - np.arange(len(key)) >= self.least[owner])
        found, last = [], (-1, 0)
        for i in good.tolist():
            n, d = int(owner[i]), int(diagonal[i])
            if n != last[0] or d > last[1] + int(self.edits[n]):
                last = (n, d)
                starts = self.starts(n, np.sort(place[i : ends[i]]))
                if len(starts):
                    found.append((n, d, starts))
        return found

    def starts(self, n: int, places: np.ndarray) -> np.ndarray:
        """The starts in item ``n`` of all passages that hold enough of the q-grams at the sorted ``places``."""
        _, codes, length, _, least = self.items[n]
        first, last = places[: len(places) - least + 1], places[least - 1 :]
        low, high = np.maximum(last - (length - Q), 0), np.minimum(first, len(codes) - length)
        full = low <= high
        cover = np.zeros(len(codes) - length + 2, np.int64)
        np.add.at(cover, low[full], 1)
        np.add.at(cover, high[full] + 1, -1)
        return np.flatnonzero(np.cumsum(cover[:-1]) > 0)

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item_id, item_at, begin, end, edits) of every passage found, in places of the text."""
        codes, places = normal_codes(text)
        grams = gram_hashes(codes)
        near = self.regions(grams)
        if not len(near):
            return []
        found = set()
        for n, diagonal, starts in self.bands(grams, near):
            item_id, item, length, edits, _ = self.items[n]
            # most copies are verbatim on one diagonal: only the other starts are aligned
            low, high = max(0, -diagonal), min(len(item), len(codes) - diagonal)
            other = np.ones(len(item) + 1, np.int64)
            other[low:high] = codes[low + diagonal : high + diagonal] != item[low:high]
            wrong = np.concatenate([[0], np.cumsum(other)])
            same = wrong[starts + length] == wrong[starts]
            for at in starts[same].tolist():
                found.add((item_id, at, int(places[at + diagonal]), int(places[at + diagonal + length - 1]) + 1, 0))
            rest = starts[~same]
            for a in range(0, len(rest), ALIGNED):
                part = rest[a : a + ALIGNED]
                wanted = item[part[:, None] + np.arange(length)]
                cost, begin, end = banded_distances(codes, wanted, part + diagonal - edits, 3 * edits + 1)
                for i in np.flatnonzero(cost <= edits).tolist():
                    found.add((item_id, int(part[i]), int(places[begin[i]]), int(places[end[i] - 1]) + 1, int(cost[i])))
        return sorted(found)


def benchmark_parts(benchmark: DataFrame, most: int = MAX_PART_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in parts of at most ``most`` bytes of text, so that what a task holds is bounded.

    A single longer item is a part of its own. There is always one part, if an empty one.
    """
    part, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        length = len((row.text or "").encode())
        if part and size + length > most:
            yield part
            part, size = [], 0
        part.append((row.item_id, row.text))
        size += length
    yield part


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_at, begin, end, edits): each benchmark passage found in a document.

    A passage is 80 characters of an item from any start (or a whole shorter item
    of 12 or more) after lower-casing and joining signs and spaces; a document
    leaks it where it holds it with at most one edit per 20 characters, or none
    below 24. ``item_at`` is the start, so a longer piece gives a row for each of
    its starts. ``begin`` and ``end`` are places in the lower-cased text. The benchmark is sent to every
    task, 16 MB of its text at a time; a larger one costs more passes over the
    documents, which are neither shuffled nor held together. Null or empty texts
    leak nothing; null item ids are left out; repeated rows and null doc ids each
    give their own rows; other columns are ignored; empty tables give no rows.
    """
    texts = small_batches(documents).selectExpr("cast(doc_id as long) as doc_id", "text")
    found = (texts.mapInArrow(_finder(texts, part), LEAKS) for part in benchmark_parts(benchmark))
    return reduce(DataFrame.unionByName, found)


def _finder(texts: DataFrame, part: list[tuple[int, str]]):
    """The search of one part of the benchmark over batches of (doc_id, text)."""
    items = texts.sparkSession.sparkContext.broadcast(part)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items.value)
        names = ["doc_id", "item_id", "item_at", "begin", "end", "edits"]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                rows = [
                    (doc_id, *leak)
                    for doc_id, text in zip(batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b])
                    for leak in searcher.find(text.as_py() or "")
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return search


def remove_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark passage.

    Decided row by row, so rows without an id can leave as well.
    """
    at = documents.columns.index("text")
    for part in benchmark_parts(benchmark):
        documents = small_batches(documents).mapInArrow(_cleaner(documents, part, at), documents.schema)
    return documents


def _cleaner(documents: DataFrame, part: list[tuple[int, str]], at: int):
    """Drops the rows whose text leaks one part of the benchmark."""
    items = documents.sparkSession.sparkContext.broadcast(part)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items.value)
        for batch in batches:
            for a, b in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                keep = [not searcher.find(text.as_py() or "") for text in part.column(at)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return clean
