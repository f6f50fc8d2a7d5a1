"""Language-model scores from Brown classes.

Words are put into classes by exchange clustering: from first classes, words move
to the class in which the likelihood of neighbouring classes gains most, in rounds,
until none gains. The first classes come from merging those of the most frequent
words and of word shapes where mutual information falls least. A text's probability is
the product of its class transitions and of each word's share in its class,
both smoothed by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import crc_remainder, mix, small_batches, stored, text_slices, utf8_bytes
from shelfmark.llm.terms import count_terms, sum_rare
from shelfmark.llm.words64 import hash_spans

CLASSES = 50
SEEDS = 400
LEAST_COUNT = 5
ROUNDS = 20
TOLERANCE = 1e-3
LENGTHS, ENDINGS = 16, 8
SHAPES = LENGTHS * ENDINGS
END, FIRST = SHAPES, SHAPES + 1
WORDS_AT_ONCE = 1_000
PAIRS_AT_ONCE = 500_000
PAIR_PARTS = "bucket int, a binary, b binary, c binary"
PACKED_PAIRS = "m long, a binary, b binary, c binary"
PACKED_CONTEXTS = "a binary, b binary, c binary, d binary"
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, rest double, rare array<struct<term:binary,n:int>>"


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split()


def _endings() -> list[int]:
    """The kind of each possible last byte: vowels, five runs of other letters, digits, and all else."""
    kinds = [7] * 256
    for i in range(26):
        kinds[ord("a") + i] = 1 + i % 5
    for c in "aeiouy":
        kinds[ord(c)] = 0
    for c in "0123456789":
        kinds[ord(c)] = 6
    return kinds


ENDING = _endings()


def shape_of(word: bytes) -> int:
    """The shape group, from length and last byte, in which a word below the least count stands."""
    return min(len(word), LENGTHS) * ENDINGS - ENDINGS + ENDING[word[-1]]


def held_out(doc_id: str = "doc_id") -> Column:
    """The seventh of the documents that the model does not learn from."""
    return crc_remainder(doc_id, 7) == 2


def brown_classes(bigrams: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each item, from the counts of neighbouring items.

    Items enter by falling frequency, each as a class of its own; whenever there
    is one class too many, the two are merged whose merging loses least mutual
    information, the first such pair on a tie. Items that never occur join class 0.
    """
    total = max(1.0, float(bigrams.sum()))
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    order = [int(i) for i in np.argsort(-weight, kind="stable") if weight[i] > 0]
    groups: list[list[int]] = []
    table = np.zeros((0, 0))

    def information(joint: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(joint > 0, joint / total * np.log(joint * total / (left * right)), 0.0)

    for item in order:
        groups.append([item])
        k = len(groups)
        grown = np.zeros((k, k))
        grown[:-1, :-1] = table
        grown[-1, :] = [bigrams[item, g].sum() for g in groups]
        grown[:, -1] = [bigrams[g, item].sum() for g in groups]
        table = grown
        if k <= classes:
            continue
        left, right = table.sum(axis=1), table.sum(axis=0)
        own = information(table, left[:, None], right[None, :])
        rows, columns = own.sum(axis=1), own.sum(axis=0)
        # what is lost of the two rows and columns, less what the merged ones have
        lost = rows[:, None] + rows[None, :] + columns[:, None] + columns[None, :]
        diagonal = np.diag(own)
        lost = lost - (diagonal[:, None] + diagonal[None, :] + own + own.T)
        merged_rows = information(table[:, None, :] + table[None, :, :], (left[:, None] + left[None, :])[:, :, None], right[None, None, :])
        merged_columns = information(
            (table[:, :, None] + table[:, None, :]).transpose(1, 2, 0), (right[:, None] + right[None, :])[:, :, None], left[None, None, :]
        )
        both = np.arange(k)
        kept = np.zeros((k, k))
        for merged in (merged_rows, merged_columns):
            kept += merged.sum(axis=2) - merged[both[:, None], both[None, :], both[:, None]] - merged[both[:, None], both[None, :], both[None, :]]
        corner = table + table.T + np.diag(table)[:, None] + np.diag(table)[None, :]
        kept += information(corner, left[:, None] + left[None, :], right[:, None] + right[None, :])
        loss = lost - kept
        loss[np.tril_indices(k)] = np.inf
        a, b = np.unravel_index(int(loss.argmin()), loss.shape)
        groups[a] += groups.pop(b)
        table[a, :] += table[b, :]
        table[:, a] += table[:, b]
        table = np.delete(np.delete(table, b, axis=0), b, axis=1)
    out = np.zeros(len(bigrams), np.int64)
    for number, group in enumerate(groups):
        out[group] = number
    return out


@dataclass(frozen=True)
class Vocabulary:
    """The words that have numbers of their own, from ``FIRST`` on, by their 64-bit hashes in order; 8 bytes a word."""

    keys: np.ndarray

    @property
    def size(self) -> int:
        return FIRST + len(self.keys)

    def code(self, column: pa.Array) -> CodedTexts:
        """The words of texts by number; a word without one has that of its shape group."""
        data, places = utf8_bytes(column)
        key, owner, start, end = hash_spans(data, places)
        number = _shapes(data, start, end)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            number = np.where(self.keys[at] == key, FIRST + at, number)
        return CodedTexts(len(column), data, number, owner, start, end)


@dataclass(frozen=True)
class CodedTexts:
    """The words of some texts in order: their numbers, the text each is of, and where each lies in ``data``."""

    texts: int
    data: np.ndarray
    number: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def line(self) -> np.ndarray:
        """All numbers in a row, with an end before the first text, between any two, and behind the last one."""
        begins = np.searchsorted(self.owner, np.arange(self.texts))
        return np.concatenate([np.insert(self.number, begins, END), [END]])

    def words(self, which: np.ndarray) -> list[bytes]:
        """The words at some places, A-Z lower-cased."""
        capital = (self.data >= ord("A")) & (self.data <= ord("Z"))
        lower = np.where(capital, self.data | 32, self.data).astype(np.uint8).tobytes()
        return [lower[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist())]


ENDINGS_OF_BYTES = np.array(ENDING, np.int64)
ENDINGS_OF_BYTES[ord("A") : ord("Z") + 1] = ENDINGS_OF_BYTES[ord("a") : ord("z") + 1]


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``shape_of`` for words given by their places."""
    if not len(start):
        return np.zeros(0, np.int64)
    return np.minimum(end - start, LENGTHS) * ENDINGS - ENDINGS + ENDINGS_OF_BYTES[data[end - 1]]


@dataclass(frozen=True)
class ClassModel:
    """All that scoring needs beside the counts of the rarer words."""

    vocabulary: Vocabulary
    logs: np.ndarray  # log10(count + 1) by number; 0 for the shape groups, whose words are counted apart
    word_class: np.ndarray  # by number
    end_class: int
    end_log: float
    transitions: np.ndarray  # log10 of each class after each
    shares: np.ndarray  # log10 of the divisor of a word's share in its class
    base_divisor: float
    train_tokens: int


def _word_keys(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash, the shape group and the count of each word of ``counts``, by hash."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                data, places = utf8_bytes(batch.column(0))
                key, _, start, end = hash_spans(data, places)
                columns = [pa.array(key.view(np.int64)), pa.array(_shapes(data, start, end).astype(np.int16))]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["key", "shape", "n"])

    # a term holds no white space, so it is one word
    terms = counts.select(F.col("term").cast("string"), "n")
    rows = terms.mapInArrow(hashed, "key long, shape short, n long").toArrow()
    key, shape, n = (rows.column(i).to_numpy() for i in range(3))
    key = key.view(np.uint64)
    order = np.argsort(key, kind="stable")
    return key[order], shape[order].astype(np.int64), n[order]


def _narrow(numbers: np.ndarray) -> bytes:
    """The numbers' bytes in the least of 1, 2, 4 or 8 that hold them all, with that size first."""
    kind = np.dtype(np.min_scalar_type(int(numbers.max(initial=0))))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def _column(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    """The numbers of all rows of a packed column."""
    return np.concatenate([np.zeros(0, np.int64), *(_wide(v) for v in table.column(name).to_pylist())])


def _packed_rows(names: str, rows: list[list]) -> pa.RecordBatch:
    """Rows of a whole number, or two, and packed arrays, as ``names`` gives their types."""
    fields = [f.split() for f in names.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _dealt(bucket: np.ndarray, columns: list[np.ndarray], names: str) -> pa.RecordBatch:
    """One row per bucket: its number and its share of each column, packed."""
    order = np.argsort(bucket, kind="stable")
    numbers, begins = np.unique(bucket[order], return_index=True)
    ends = [*begins[1:].tolist(), len(order)]
    columns = [c[order] for c in columns]
    rows = [[b, *(_narrow(c[i:j]) for c in columns)] for b, i, j in zip(numbers.tolist(), begins.tolist(), ends)]
    return _packed_rows(names, rows)


def _buckets(rows: int) -> int:
    """Parts of about a million rows."""
    return max(1, -(-rows // (2 * PAIRS_AT_ONCE)))


def count_pairs(texts: DataFrame, vocabulary: Vocabulary, tokens: int) -> DataFrame:
    """(m, left, right, n) in packed rows of ``m`` pairs: how often each word number follows each, over all texts.

    An end stands around every text. A task counts its pairs in parts and deals each
    part out by the pairs' hashes; a bucket's parts are then added up. So pairs are
    moved as arrays, and no more than about a million are brought together.
    """
    known, size = texts.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.size
    buckets = _buckets(tokens)

    def part(held: list[np.ndarray]) -> pa.RecordBatch:
        places, n = np.unique(np.concatenate(held), return_counts=True)
        bucket = (mix(places.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        return _dealt(bucket, [places // size, places % size, n], PAIR_PARTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, length = [], 0
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                line = known.value.code(batch.column(0)[a:b]).line()
                held.append(line[:-1] * size + line[1:])
                length += len(line)
                if length > PAIRS_AT_ONCE:
                    yield part(held)
                    held, length = [], 0
        if held:
            yield part(held)

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        places, n = _summed(_column(table, "a") * size + _column(table, "b"), _column(table, "c"))
        cuts = range(0, len(places), PAIRS_AT_ONCE)
        chunks = [(places[i : i + PAIRS_AT_ONCE], n[i : i + PAIRS_AT_ONCE]) for i in cuts]
        rows = [[len(p), _narrow(p // size), _narrow(p % size), _narrow(m)] for p, m in chunks]
        return pa.Table.from_batches([_packed_rows(PACKED_PAIRS, rows)])

    partial = small_batches(texts).select("text").mapInArrow(count, PAIR_PARTS)
    return partial.groupBy("bucket").applyInArrow(add, PACKED_PAIRS)


def _summed(places: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places in order, and the sum of ``n`` of each."""
    if not len(places):
        return places, n
    order = np.argsort(places)
    places, n = places[order], n[order]
    begins = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return places[begins], np.add.reduceat(n, begins)


def _grouped_bigrams(pairs: DataFrame, group: np.ndarray, groups: int) -> np.ndarray:
    """The pairs' counts by the groups of their words; the driver receives at most groups x groups numbers."""
    known = pairs.sparkSession.sparkContext.broadcast(group)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(groups * groups, np.int64)
        for batch in batches:
            left, right, n = (_column(batch, name) for name in "abc")
            seen += np.bincount(known.value[left].astype(np.int64) * groups + known.value[right], n, len(seen)).astype(np.int64)
        places = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(seen[places])], ["place", "n"])

    parts = pairs.select("a", "b", "c").mapInArrow(count, "place long, n long")
    rows = parts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(groups * groups)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out.reshape(groups, groups)


def _plogp(x: np.ndarray) -> np.ndarray:
    """x log x of counts, 0 at 0."""
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """The log-likelihood of the neighbouring classes in ``table``, but for a constant of the words."""
    return float(_plogp(table).sum() - _plogp(table.sum(axis=1)).sum() - _plogp(table.sum(axis=0)).sum())


def move_gains(right: np.ndarray, left: np.ndarray, own: np.ndarray, current: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What the likelihood gains if a word moves to a class: one row per word, one column per class.

    ``right`` and ``left`` have how often words of each class follow and precede the
    word, without itself; ``own`` how often it follows itself.
    """
    rows, total = np.arange(len(right)), np.zeros(right.shape)
    for mine, across, cells in ((right, left, table), (left, right, table.T)):
        i, d = np.nonzero(mine)
        if not len(i):
            continue
        # the cells of each class with class d, after the word has left its own
        n, e, inside = mine[i, d], np.arange(len(i)), current[i] == d
        base = cells.T[d]
        base[inside] -= across[i[inside]]
        base[e, current[i]] -= n + np.where(inside, own[i], 0)
        more = _plogp(base + n[:, None]) - _plogp(base)
        word, begin = np.unique(i, return_index=True)
        total[word] += np.add.reduceat(more, begin, axis=0)
    # a class with itself is a cell of both
    both = np.repeat(np.diag(table)[None, :], len(right), axis=0)
    both[rows, current] -= right[rows, current] + left[rows, current] + own
    total += _plogp(both + right + left + own[:, None]) + _plogp(both) - _plogp(both + right) - _plogp(both + left)
    for mine, sums in ((right, table.sum(axis=1)), (left, table.sum(axis=0))):
        n = mine.sum(axis=1) + own
        base = np.repeat(sums[None, :], len(right), axis=0)
        base[rows, current] -= n
        total -= _plogp(base + n[:, None]) - _plogp(base)
    return total - total[rows, current][:, None]


def word_contexts(pairs: DataFrame) -> DataFrame:
    """Each clustered word's neighbours, in packed rows of words, numbers of neighbours, neighbours and counts.

    A neighbour is 2 x number if it follows the word and 1 more if it precedes it.
    The pairs are dealt out by word as arrays, as they are in ``count_pairs``.
    """
    found = pairs.agg(F.sum("m")).first()[0] or 0
    buckets = _buckets(2 * found)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                left, right, n = (_column(batch.slice(at, 1), name) for name in "abc")
                after, before = left >= FIRST, right >= FIRST
                word = np.concatenate([left[after], right[before]])
                other = np.concatenate([2 * right[after], 2 * left[before] + 1])
                if len(word):
                    yield _dealt(word % buckets, [word, other, np.concatenate([n[after], n[before]])], PAIR_PARTS)

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        word, other, n = (_column(table, name) for name in "abc")
        order = np.argsort((word << 32) + other)
        word, other, n = word[order], other[order], n[order]
        words, begins = np.unique(word, return_index=True)
        sizes = np.diff(np.concatenate([begins, [len(word)]]))
        part = np.arange(len(words)) // WORDS_AT_ONCE + begins // PAIRS_AT_ONCE
        rows = []
        for chosen in np.split(np.arange(len(words)), np.flatnonzero(np.diff(part)) + 1):
            i, j = begins[chosen[0]], begins[chosen[-1]] + sizes[chosen[-1]]
            rows.append([_narrow(words[chosen]), _narrow(sizes[chosen]), _narrow(other[i:j]), _narrow(n[i:j])])
        return pa.Table.from_batches([_packed_rows(PACKED_CONTEXTS, rows)])

    dealt = pairs.select("a", "b", "c").mapInArrow(deal, PAIR_PARTS)
    return dealt.groupBy("bucket").applyInArrow(gather, PACKED_CONTEXTS)


def _best_moves(contexts: DataFrame, classes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, class) of every word that gains by moving, by falling gain."""
    known = contexts.sparkSession.sparkContext.broadcast((classes, table))
    k = len(table)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = known.value
        for batch in batches:
            for at in range(len(batch)):
                word, sizes, other, n = (_wide(c[at].as_py()) for c in batch.columns)
                m = len(word)
                row = np.repeat(np.arange(m), sizes)
                after, other = other % 2 == 0, other // 2
                self = other == word[row]
                place = row * k + classes[other]
                right, left = (np.bincount(place[at], n[at], m * k).reshape(m, k) for at in (after & ~self, ~after & ~self))
                own = np.bincount(row[after & self], n[after & self], m)
                gains = move_gains(right, left, own, classes[word].astype(np.int64), table)
                to = gains.argmax(axis=1)
                gain = gains[np.arange(m), to]
                moved = np.flatnonzero(gain > 1e-6)
                columns = [pa.array(word[moved], pa.int64()), pa.array(to[moved], pa.int16()), pa.array(gain[moved], pa.float32())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "class", "gain"])

    rows = contexts.mapInArrow(best, "word long, class short, gain float").toArrow()
    word, to, gain = (rows.column(i).to_numpy() for i in range(3))
    order = np.lexsort((word, -gain))
    return word[order], to[order]


def exchange(pairs: DataFrame, contexts: DataFrame, classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes after exchange, and how often each follows each.

    A round moves all words that gain, each by its own gain; if the likelihood then
    falls, as moves can stand against each other, only the better half of them, and
    so on. It ends when no word gains, when a round gains less than 0.001 of the
    first, or after 20 rounds. The driver holds one small number per word.
    """
    table, first = _grouped_bigrams(pairs, classes, k), None
    for _ in range(ROUNDS):
        word, to = _best_moves(contexts, classes, table)
        before, n = likelihood(table), len(word)
        while n:
            trial = classes.copy()
            trial[word[:n]] = to[:n]
            new = _grouped_bigrams(pairs, trial, k)
            if likelihood(new) > before:
                break
            n //= 2
        if not n:
            break
        classes, table, gained = trial, new, likelihood(new) - before
        first = first or gained
        if gained < TOLERANCE * first:
            break
    return classes, table


def _shape_sizes(rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per shape group the distinct words and their tokens, of the words below the least count."""

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tokens = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for batch in batches:
            shape = np.array([shape_of(t) for t in batch.column(0).to_pylist()], np.int64)
            words += np.bincount(shape, minlength=SHAPES)
            np.add.at(tokens, shape, np.asarray(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES)), pa.array(words), pa.array(tokens)], ["shape", "words", "tokens"])

    partial = rare.select("term", "n").mapInArrow(size, "shape long, words long, tokens long")
    words, tokens = np.zeros(SHAPES), np.zeros(SHAPES)
    for row in partial.groupBy("shape").agg(F.sum("words").alias("w"), F.sum("tokens").alias("t")).collect():
        words[row["shape"]], tokens[row["shape"]] = row.w, row.t
    return words, tokens


def train(texts: DataFrame, counts: DataFrame, classes: int = CLASSES) -> ClassModel:
    """Learns from all rows of ``texts`` (text); ``counts`` is their (term, n).

    All words that occur 5 times or more are clustered; the rarer ones stand in one of
    128 shape groups. The pairs and the words' neighbours are tables; the driver and
    each task hold the hash, the class and the count of every clustered word. Words
    of one 64-bit hash would be taken for one word.
    """
    documents = texts.count()
    keys, key_shape, key_count = _word_keys(counts.where(F.col("n") >= LEAST_COUNT))
    distinct, key_at = np.unique(keys, return_inverse=True)
    vocabulary = Vocabulary(distinct)
    tokens = (counts.agg(F.sum("n")).first()[0] or 0) + documents
    pairs = stored(count_pairs(texts, vocabulary, tokens), "word-pairs")

    # the first classes: of the most frequent words, the shape groups and the end
    weight = np.bincount(key_at, key_count, len(distinct))
    ranked = FIRST + np.argsort(-weight, kind="stable")[:SEEDS]
    shapes = np.concatenate([np.arange(FIRST), np.zeros(len(distinct), np.int64)])
    shapes[FIRST + key_at] = key_shape
    seeds = shapes.astype(np.int16)
    seeds[ranked] = FIRST + np.arange(len(ranked))
    seed_class = brown_classes(_grouped_bigrams(pairs, seeds, FIRST + len(ranked)), classes)
    groups = int(seed_class.max(initial=0)) + 1
    first_classes = seed_class[seeds].astype(np.min_scalar_type(groups))
    contexts = stored(word_contexts(pairs), "word-contexts")
    word_class, table = exchange(pairs, contexts, first_classes, groups)
    word_class = word_class.astype(np.int64)

    shape_words, shape_tokens = _shape_sizes(counts.where(F.col("n") < LEAST_COUNT))
    item_class = np.concatenate([word_class[:FIRST], word_class[FIRST + key_at]])
    words = np.concatenate([shape_words, [float(documents > 0)], np.ones(len(keys))])
    sums = np.concatenate([shape_tokens, [documents], key_count])
    class_words, class_tokens = np.bincount(item_class, words, groups), np.bincount(item_class, sums, groups)
    return ClassModel(
        vocabulary=vocabulary,
        logs=np.concatenate([np.zeros(FIRST), np.log10(weight + 1)]),
        word_class=word_class,
        end_class=int(word_class[END]),
        end_log=log10(documents + 1),
        transitions=np.log10((table + 1) / (table.sum(axis=1, keepdims=True) + groups)),
        shares=np.log10(class_tokens + class_words + 1),
        base_divisor=log10(sums.sum() + words.sum() + 1),
        train_tokens=int(sums.sum()),
    )


def _text_scores(model: ClassModel, column: pa.Array) -> list[pa.Array]:
    """Per text: its tokens, the clustered ones and the end, their logs, the rest of the class model's logs, and its other words."""
    texts = model.vocabulary.code(column)
    n, number, owner = texts.texts, texts.number, texts.owner
    clustered = number >= FIRST
    sizes = np.bincount(owner, minlength=n) + 1
    known = np.bincount(owner[clustered], minlength=n) + (model.end_log > 0)
    logs = np.bincount(owner, model.logs[number], n) + model.end_log
    line = model.word_class[texts.line()]
    steps = model.transitions[line[:-1], line[1:]] - model.shares[line[1:]]
    rest = np.bincount(np.repeat(np.arange(n), sizes), steps, n)
    others = np.flatnonzero(~clustered)
    # by text, as the words are
    counted = Counter(zip(owner[others].tolist(), texts.words(others)))
    owners = np.array([o for o, _ in counted], np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))])
    pairs = pa.StructArray.from_arrays([pa.array([w for _, w in counted], pa.binary()), pa.array(counted.values(), pa.int32())], ["term", "n"])
    rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
    return [pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(logs), pa.array(rest), rare]


def score_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the rows that are not held out and scores all of them. A text is
    its words and then one end; a null text is empty. ``score`` is the class
    model's log10 probability: each class given the one before (the end's before
    the first), times (count + 1) / (class tokens + class words + 1). A word that
    was never seen has the count 0 in the class of its shape. Without a training
    row all counts are 0. Repeated rows and null ids keep their rows; an empty
    table gives none. Whole texts are read, however long; columns other than doc_id
    and text are ignored. Four tables are written to the shared folder.
    """
    training = documents.where(~held_out()).select("text")
    counts = stored(count_terms(training, lambda: words_of), "word-counts")
    model = train(training, counts)
    known = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(3)):
                part = batch.slice(a, b - a)
                columns = [*part.columns[:3], *_text_scores(known.value, part.column(3))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "rest", "rare"])

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out().alias("held_out"), "text"
    )
    rows = stored(numbered.mapInArrow(score, SCORED), "word-scores")
    rarer = counts.where(F.col("n") < LEAST_COUNT)
    sums = sum_rare(rows, rarer.withColumn("log", F.log10(F.col("n") + 1)), "log")
    logs = F.col("logs") + F.coalesce("total", F.lit(0.0))
    return (
        rows.drop("rare")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"),
            F.lit(model.train_tokens).cast("long").alias("train_tokens"),
            (logs - F.col("n_tokens") * model.base_divisor).alias("base_score"),
            (logs + F.col("rest")).alias("score"),
        )
    )
