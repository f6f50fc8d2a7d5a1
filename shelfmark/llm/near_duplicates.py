"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document's signature is 32 symbols of 16 bits. Two texts with a similarity of
0.75 differ in about 8 of them, and in more than 19 once in some 125,000 such
pairs. The symbols are split into six chunks with an allowance of errors each,
so that by the pigeonhole any pair with at most 19 differing symbols stays
within the allowance of some chunk. Every choice of the chunk's symbols that may
differ is left out in turn, and the others make a key; such a pair shares a key.
A second signature of 128 single bits picks the pairs that are tried first, in
stars around hubs. Where that leaves the texts of a key in several components,
every pair of them is compared by a third signature of 4,096 single bits, which
is worked out for these texts alone: two texts with a similarity of 0.75 differ
in about 512 of its bits, and in more than 614 once in some 850,000 such pairs,
while most pairs below 0.7 differ in more. What is left is a link only once the
full shingle sets confirm it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import mix, small_batches, stored, text_slices, utf8_bytes
from shelfmark.llm.components import components
from shelfmark.llm.words64 import hash_words
from shelfmark.operators.sizing import fits_broadcast

WORDS = 5
SYMBOLS = 32
ALLOWED = 19
# (first symbol, symbols, errors allowed); the allowances plus one add up to more than ALLOWED
CHUNKS = ((0, 6, 3), (6, 6, 3), (12, 5, 2), (17, 5, 2), (22, 5, 2), (27, 5, 2))
SHARE = 75
BITS, BITS_APART = 128, 35
LONG_BITS, LONG_APART = 4_096, 614
SEEDS = mix(np.arange(1, LONG_BITS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
PLACES = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
LONGEST_RUN = 64
# a bucket is worked on in parts of about so many rows; of a hot key so many rows are sampled per part
BUCKET_ROWS, SAMPLED = 50_000, 100
HUBS = 1_000
SPREAD_AT_ONCE = 500
# further hubs are tried in so many turns, each by one of as many parts of the keys
TURNS, KEY_PARTS = 2, 4
SIGNED = "doc_id long, n int, h1 long, h2 long, " + ", ".join(
    f"{name} long" for name in (*(f"s{i}" for i in range(SYMBOLS // 4)), "a", "b")
)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text's shingles, sorted within the text, and where each text's begin.

    A shingle is five words in a row; a text of one to four words is one shingle;
    a text without words has none.
    """
    data, places = utf8_bytes(texts)
    word, owner = hash_words(data, places)
    n = len(texts)
    per_text = np.bincount(owner, minlength=n)
    begin = np.cumsum(per_text) - per_text
    count = len(word) - WORDS + 1
    if count > 0:
        whole = sum((mix(word[k : k + count] * PLACES[k]) for k in range(WORDS)), np.zeros(count, np.uint64))
        inside = owner[:count] == owner[WORDS - 1 :]
        shingle, of = mix(whole[inside]), owner[:count][inside]
    else:
        shingle, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((per_text > 0) & (per_text < WORDS))
    if len(short):
        values = np.full(len(short), 0x5BD1E995, np.uint64)
        for k in range(WORDS - 1):
            there = per_text[short] > k
            values[there] += mix(word[begin[short[there]] + k] * PLACES[k])
        shingle = np.concatenate([shingle, mix(values + per_text[short].astype(np.uint64))])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        shingle, of = shingle[order], of[order]
    sizes = np.bincount(of, minlength=n)
    ends = np.cumsum(sizes)
    parts = [_distinct(shingle[b - s : b]) for s, b in zip(sizes.tolist(), ends.tolist())]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum(sizes)])


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _least_hashes(sets: np.ndarray, starts: np.ndarray, orders: int) -> Iterator[tuple[int, np.ndarray]]:
    """The least hash of each non-empty set, mixed, under one order after the other."""
    ordered = np.empty_like(sets)
    for k, seed in enumerate(SEEDS[:orders]):
        np.bitwise_xor(sets, seed, out=ordered)
        np.multiply(ordered, seed | np.uint64(1), out=ordered)
        yield k, mix(np.minimum.reduceat(ordered, starts))


def signatures(sets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 symbols and 128 bits per non-empty set, from its least hashes under 128 orders.

    A symbol is 16 bits of a least hash, a bit one other.
    """
    starts = places[:-1][np.diff(places) > 0]
    symbols, bits = np.empty((len(starts), SYMBOLS), np.uint16), np.zeros((len(starts), BITS // 64), np.uint64)
    if len(starts):
        for k, least in _least_hashes(sets, starts, BITS):
            if k < SYMBOLS:
                symbols[:, k] = least >> np.uint64(48)
            bits[:, k // 64] |= (least & np.uint64(1)) << np.uint64(k % 64)
    return symbols, bits


def long_bits(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """4,096 bits per non-empty set, one of its least hash under each of 4,096 orders."""
    bits = np.zeros((len(starts), LONG_BITS // 64), np.uint64)
    for k, least in _least_hashes(sets, starts, LONG_BITS):
        bits[:, k // 64] |= (least & np.uint64(1)) << np.uint64(k % 64)
    return bits


def sign_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, n, h1, h2, s0..s7, a, b) per row: the set's size, its 128-bit digest and the two signatures."""
    names = [part.split()[0] for part in SIGNED.split(", ")]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                sets, places = shingle_sets(batch.column(1)[a:b])
                sizes = np.diff(places)
                full = sizes > 0
                long = np.zeros((b - a, 2 + SYMBOLS // 4 + BITS // 64), np.int64)
                if full.any():
                    starts = places[:-1][full]
                    with np.errstate(over="ignore"):
                        for k in range(2):
                            long[full, k] = np.add.reduceat(mix(sets + PLACES[k]), starts).view(np.int64)
                    signed = signatures(sets, places)
                    long[full, 2:] = np.concatenate([part.view(np.int64) for part in signed], axis=1)
                arrays = [batch.column(0)[a:b], pa.array(sizes, pa.int32()), *(pa.array(c) for c in long.T.copy())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return small_batches(documents).select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, SIGNED)


def _patterns() -> list[tuple[int, ...]]:
    """The symbols that each key is made of."""
    return [
        kept
        for first, size, errors in CHUNKS
        for kept in combinations(range(first, first + size), size - errors)
    ]


def _keys_of(packed: np.ndarray) -> np.ndarray:
    """The 80 keys of each row of packed symbols, in the order of the patterns."""
    patterns = _patterns()
    wide = packed.view(np.uint16).astype(np.uint64)
    keys = np.empty((len(wide), len(patterns)), np.uint64)
    for i, kept in enumerate(patterns):
        value = np.full(len(wide), i + 1, np.uint64)
        for k in kept:
            value = mix(value * np.uint64(0x2545F4914F6CDD1D) + wide[:, k] + np.uint64(1))
        keys[:, i] = value
    return keys


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, node, n, a, b): every class under each of its 80 keys, with its size and bits for the first comparison."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # a row becomes 80, so few are worked on at a time
            for at in range(0, len(whole), SPREAD_AT_ONCE):
                batch = whole.slice(at, SPREAD_AT_ONCE)
                keys = _keys_of(np.stack([np.asarray(c) for c in batch.columns[4:]], axis=1))
                carried = (np.repeat(np.asarray(c), keys.shape[1]) for c in batch.columns[:4])
                arrays = [pa.array(keys.ravel().view(np.int64)), *map(pa.array, carried)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "node", "n", "a", "b"])

    columns = ["node", "n", "a", "b", *(f"s{i}" for i in range(SYMBOLS // 4))]
    return classes.select(*columns).mapInArrow(spread, "key long, node long, n int, a long, b long")


def _sizes_near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two sets of these sizes can be as alike as a link's."""
    return 100 * np.minimum(x, y).astype(np.int64) >= SHARE * np.maximum(x, y).astype(np.int64)


def _alike(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether pairs of (n, a, b) can be links: sizes near enough, and at most 35 of the 128 bits differ."""
    apart = np.bitwise_count(x[1] ^ y[1]).astype(np.int64) + np.bitwise_count(x[2] ^ y[2])
    return (apart <= BITS_APART) & _sizes_near(x[0], y[0])


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    key, node, n, a, b, *more = (np.asarray(c) for c in batch.columns)
    return [key, node, n, a.view(np.uint64), b.view(np.uint64), *more]


def _salted(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds ``salt``, which deals the rows of a key with far more than 50,000 among several tasks, and the number of ``salts``.

    Hot keys are told from a sample, for which salts a row gets only decides
    which links are found first. Each key deals its nodes in another way, so that
    a group of near copies is still linked to one star through other keys.
    """
    sample = index_keys(classes.sample(SAMPLED / BUCKET_ROWS, seed=1))
    hot = sample.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / SAMPLED).alias("_salts")).where("_salts > 1")
    hot = stored(hot.withColumnRenamed("key", "_hot"), "hot-buckets")
    if hot.isEmpty():
        return keys.withColumns({"salt": F.lit(0), "salts": F.lit(1)})
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    salts = F.coalesce("_salts", F.lit(1)).cast("int")
    salt = F.pmod(F.xxhash64("key", "node"), salts).cast("int")
    return keys.join(hot, F.col("key") == F.col("_hot"), "left").withColumns({"salt": salt, "salts": salts}).drop("_hot", "_salts")


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in some column; true for the first."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def star_links(keys: DataFrame) -> DataFrame:
    """(key, node, n, a, b, hub): the rows of keys that several nodes share, each with a hub of its key or null.

    ``keys`` also has salt and salts, and a bucket is the rows of one key and salt.
    All rows of a salted key are given, as others of the key may be elsewhere. In it
    the first node is a hub, and so is each that no earlier hub is like, up to
    1,000 hubs. A bucket gives at most one link per row, however large it is, and
    a task keeps only the hubs of the bucket at hand. A row without a hub is
    tried with all others by ``open_pairs``.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the hubs of the bucket that the last batch broke off, and whether they were given out
        held: list[np.ndarray] | None = None
        shown = False
        for batch in batches:
            rows = _columns(batch)
            if not len(rows[0]):
                continue
            old = 0
            if held is not None and held[0][0] == rows[0][0] and held[5][0] == rows[5][0]:
                old = len(held[0])
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            run = np.cumsum(_runs(rows[0], rows[5])) - 1
            sizes = np.bincount(run)
            hub = np.full(len(run), -1, np.int64)
            is_hub = np.zeros(len(run), bool)
            is_hub[:old] = True
            waiting = np.flatnonzero(sizes[run] > 1)
            waiting = waiting[waiting >= old]
            # the bucket's known hubs come first, then the first row of each run that no hub was like
            for h in range(old):
                mine = waiting[run[waiting] == 0]
                good = _alike([r[mine] for r in rows[2:5]], [r[h : h + 1] for r in rows[2:5]])
                hub[mine[good]] = rows[1][h]
                waiting = waiting[hub[waiting] < 0]
            if old >= HUBS:
                waiting = waiting[run[waiting] != 0]
            for _ in range(HUBS):
                if not len(waiting):
                    break
                first = _runs(run[waiting])
                centre = waiting[first][np.cumsum(first) - 1]
                is_hub[waiting[first]] = True
                good = _alike([r[waiting] for r in rows[2:5]], [r[centre] for r in rows[2:5]]) & ~first
                hub[waiting[good]] = rows[1][centre[good]]
                waiting = waiting[~good & ~first]
            last = run == run[-1]
            is_hub[np.flatnonzero(last)[:1]] = True
            give = (sizes[run] > 1) | (rows[6] > 1)
            if old and shown:
                give[:old] = False
            if give.any():
                hubs = pa.array(hub[give], pa.int64(), mask=hub[give] < 0)
                made = [pa.array(r[give].view(np.int64) if r.dtype == np.uint64 else r[give]) for r in rows[:5]]
                yield pa.RecordBatch.from_arrays([*made, hubs], ["key", "node", "n", "a", "b", "hub"])
            shown = bool(sizes[-1] > 1 or rows[6][-1] > 1)
            keep = np.flatnonzero(last & is_hub)
            held = [r[keep] for r in rows]

    columns = ["key", "node", "n", "a", "b", "salt", "salts"]
    dealt = keys.select(*columns).repartition("key", "salt").sortWithinPartitions("key", "salt", "node")
    return dealt.mapInArrow(link, "key long, node long, n int, a long, b long, hub long")


def _with_components(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The bucket rows with the component of their node, which is the node itself where nothing is linked."""
    known = buckets.drop("hub").join(labels, "node", "left")
    return known.withColumn("component", F.coalesce("component", "node")).select("key", "node", "n", "a", "b", "component")


def other_hubs(buckets: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(x, y): rows paired with a node of their key that is not yet in their component, at most one pair per row.

    The node is another for every key, so that a document that the first star
    missed meets several members of its group before all pairs are tried.
    """
    part = F.pmod(F.xxhash64("key"), F.lit(KEY_PARTS)) == turn % KEY_PARTS
    known = _with_components(buckets.where(part), labels)
    order = F.xxhash64("node", "key", F.lit(turn)).alias("order")
    hubs = known.groupBy("key").agg(F.min(F.struct(order, "node", "n", "a", "b", "component")).alias("_hub"))
    met = known.join(hubs, "key").where(F.col("component") != F.col("_hub.component"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("_hub.a"))) + F.bit_count(F.col("b").bitwiseXOR(F.col("_hub.b")))
    sizes = 100 * F.least("n", "_hub.n").cast("long") >= SHARE * F.greatest("n", "_hub.n").cast("long")
    alike = met.where((apart <= BITS_APART) & sizes)
    return alike.select(F.least("node", "_hub.node").alias("x"), F.greatest("node", "_hub.node").alias("y")).distinct()


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, n, component, _blocks): the rows of keys whose nodes are in several components.

    ``_blocks`` is the number of parts that a key with far more than 50,000 rows is cut into.
    """
    known = _with_components(buckets, labels).drop("a", "b")
    sizes = known.groupBy("key").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_rows")
    )
    mixed = sizes.where("_low < _high").select("key", F.ceil(F.col("_rows") / BUCKET_ROWS).cast("int").alias("_blocks"))
    return known.join(mixed, "key")


def open_pairs(buckets: DataFrame, labels: DataFrame, documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, y): the pairs of a key that can be links and are not yet in one component.

    ``labels`` has (node, component) of the linked nodes; others are on their own.
    Keys of one component are left out before they are dealt out. Only for the
    nodes that are left the long signatures are worked out, from the text of one
    document each. A key with far more than 50,000 rows is cut into blocks, and
    each pair of its blocks goes to a task of its own. A pair that shares several
    keys is given by the first of them alone.
    """
    mixed = stored(_mixed(buckets, labels), "mixed-buckets")
    symbols = [f"s{i}" for i in range(SYMBOLS // 4)]
    signed = _long_signatures(documents, classes, mixed.select("node").distinct())
    signed = stored(signed.join(classes.select("node", *symbols), "node"), "long-signatures")
    cut = mixed.join(signed, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cut = cut.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = [np.asarray(c) for c in batch.columns[:7]]
            rows.append(np.stack([np.frombuffer(bits.as_buffer(), np.uint64) for bits in batch.columns[7]]))
            rows.append(np.stack([np.asarray(c) for c in batch.columns[8:]], axis=1))
            if held is not None:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            at = int(np.flatnonzero(_runs(rows[0], rows[4], rows[5]))[-1])
            held = [r[at:] for r in rows]
            yield from _pairs([r[:at] for r in rows])
        if held is not None:
            yield from _pairs(held)

    columns = ["key", "node", "n", "component", "low", "high", "block", "bits", *symbols]
    dealt = cut.select(*columns).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(pair, "x long, y long").distinct()


def _pairs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The open pairs of whole buckets: small ones all at once by their distance in the bucket, large ones row by row."""
    key, node, n, component, low, high, block, bits, symbols = rows
    if not len(key):
        return
    body = (key.view(np.uint64), node, n, bits, _keys_of(symbols))
    begin = np.flatnonzero(_runs(key, low, high))
    size = np.diff(np.concatenate([begin, [len(key)]]))
    end_of = np.repeat(begin + size, size)
    small = np.repeat(size <= LONGEST_RUN, size)
    for step in range(1, int(min(LONGEST_RUN, size.max(initial=1)))):
        left = np.flatnonzero(small & (np.arange(len(key)) + step < end_of))
        left = left[(component[left] != component[left + step]) & _met(left, left + step, low, high, block)]
        yield from _found(left, left + step, body)
    for start, length in zip(begin[size > LONGEST_RUN].tolist(), size[size > LONGEST_RUN].tolist()):
        # rows of the largest component need no turn of their own: the others meet them
        values, counts = np.unique(component[start : start + length], return_counts=True)
        largest = values[counts.argmax()]
        every = np.arange(start, start + length)
        for i in every[component[every] != largest].tolist():
            other = every[(component[every] != component[i]) & ((every > i) | (component[every] == largest))]
            mine = np.full(len(other), i)
            kept = _met(mine, other, low, high, block)
            yield from _found(mine[kept], other[kept], body)


def _met(left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Where two blocks meet, rows of one block leave each other to the block's own task."""
    return (block[left] != block[right]) | (low[left] == high[left])


def _found(left: np.ndarray, right: np.ndarray, body: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """The pairs of sizes near enough whose long signatures differ in at most 614 bits and whose first common key this is."""
    key, node, n, bits, keys = body
    near = _sizes_near(n[left], n[right])
    left, right = left[near], right[near]
    good = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64) <= LONG_APART
    left, right = left[good], right[good]
    if len(left):
        first = (keys[left] == keys[right]).argmax(axis=1)
        here = keys[left, first] == key[left]
        x, y = node[left[here]], node[right[here]]
        arrays = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]
        yield pa.RecordBatch.from_arrays(arrays, ["x", "y"])


def _of_one_text(documents: DataFrame, classes: DataFrame, nodes: DataFrame, made: str, make: Callable[[np.ndarray, np.ndarray], pa.Array]) -> DataFrame:
    """(node, ``made``) of the classes in ``nodes``, by ``make`` from the shingles of one text of each, worked out anew."""
    wanted = classes.join(nodes, "node").select("node", "h1", "h2", "first_doc")
    ids = wanted.select("first_doc").distinct()
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")
    name = made.split()[0]

    def work_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                sets, places = shingle_sets(batch.column(0)[a:b])
                starts = places[:-1][np.diff(places) > 0]
                if not len(starts):
                    continue
                digests = [np.add.reduceat(mix(sets + PLACES[k]), starts).view(np.int64) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, digests), make(sets, starts)], ["h1", "h2", name])

    found = texts.select("text").mapInArrow(work_out, f"h1 long, h2 long, {made}")
    return found.join(wanted.select("node", "h1", "h2"), ["h1", "h2"]).dropDuplicates(["node"]).select("node", name)


def _sets_of(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the classes in ``nodes``."""

    def lists(sets: np.ndarray, starts: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([starts, [len(sets)]]), pa.int32()), pa.array(sets.view(np.int64)))

    return _of_one_text(documents, classes, nodes, "shingles array<long>", lists)


def _long_signatures(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, bits): the long signatures of the classes in ``nodes``, 512 bytes each."""

    def packed(sets: np.ndarray, starts: np.ndarray) -> pa.Array:
        return pa.array([line.tobytes() for line in long_bits(sets, starts)], pa.binary())

    return _of_one_text(documents, classes, nodes, "bits binary", packed)


def confirm(pairs: DataFrame, documents: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (x, y) whose full sets have 100 * intersection >= 75 * union."""
    # a node of many pairs is told once per side before the sides meet
    sides = [pairs.select(F.col(side).alias("node")).distinct() for side in ("x", "y")]
    nodes = sides[0].unionByName(sides[1]).distinct()
    sets = stored(_sets_of(documents, classes, nodes), "shingle-sets")
    left = pairs.join(sets.select(F.col("node").alias("x"), F.col("shingles").alias("_x")), "x")
    both = left.join(sets.select(F.col("node").alias("y"), F.col("shingles").alias("_y")), "y")
    shared = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - shared
    return both.where(100 * shared >= SHARE * union).select("x", "y")


def link_classes(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of every class that is linked with another one.

    First each bucket is linked like a star. Then nodes are tried with other hubs
    of their keys, which brings near copies of near copies together. At last, for
    keys whose nodes are still in several components, every pair of different
    components is tried.
    A pair within one component needs no link, so no link that shares a key and that
    the long signatures pass is lost.
    """
    buckets = stored(star_links(_salted(index_keys(classes), classes)), "buckets")
    stars = stored(buckets.where("hub is not null").select(F.least("hub", "node").alias("x"), F.greatest("hub", "node").alias("y")).distinct(), "stars")
    links, tried = stored(confirm(stars, documents, classes), "links"), stars
    labels = components(links)
    for turn in range(TURNS + 1):
        pairs = other_hubs(buckets, labels, turn) if turn < TURNS else open_pairs(buckets, labels, documents, classes)
        pairs = stored(pairs.join(tried, ["x", "y"], "left_anti"), "pairs-to-try")
        if pairs.isEmpty():
            continue
        found = stored(confirm(pairs, documents, classes), "links")
        tried = tried.unionByName(pairs)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
    return labels


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    Words are split at ASCII white space with A-Z lower-cased. Texts with equal
    sets form a class at once, so that copies are never paired; classes are
    joined by signature and confirmed on full sets. ``component_id`` is the
    smallest doc_id of the component. Whole texts are read, however long; columns
    other than doc_id and text are ignored. A null or empty text, and one of white
    space, has no shingle and is its own component. Rows with a null id are
    linked too, but name no component unless all its ids are null. Repeated rows
    are copies. An empty table gives no rows.
    """
    return label(*_linked(documents))


def _linked(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stored(sign_documents(documents), "signatures")
    symbols = [F.max(name).alias(name) for name in (*(f"s{i}" for i in range(SYMBOLS // 4)), "a", "b")]
    grouped = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("n").alias("n"), *symbols)
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    linked = stored(link_classes(documents, classes), "components")
    ids = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    return rows, ids.join(least, "component").select("h1", "h2", "component_id")


def label(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Gives each row its component; rows without shingles never meet the join."""
    rows = rows.select("doc_id", "n", "h1", "h2")
    full = rows.where("n > 0").join(ids, ["h1", "h2"]).select("doc_id", "n", "component_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each group of near-duplicates, that of the smallest id.

    Texts without words all stay. Of rows with the kept id, equal ones stay as
    one. An id that is kept in one group and not in another keeps its rows.
    """
    found = stored(near_duplicates(documents).where("n_shingles > 0").select("doc_id", "kept"), "decided")
    by_id = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    leave = by_id.where("not kept").select(F.col("doc_id").alias("_id"))
    again = by_id.where("kept and rows > 1").select(F.col("doc_id").alias("_id"))
    leave, again = (F.broadcast(ids) if fits_broadcast(ids) else ids for ids in (leave, again))
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    stay = documents.join(leave, same & ~empty, "left_anti")
    if again.isEmpty():
        return stay
    once = stay.join(again, same, "left_semi").where(~empty).dropDuplicates(["doc_id", "text"])
    return stay.join(again, same & ~empty, "left_anti").unionByName(once)
