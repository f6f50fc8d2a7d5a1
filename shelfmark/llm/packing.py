"""Best-fit packing of token sequences, improved by a local search over swaps."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import small_batches, stored, text_slices
from shelfmark.llm.pretokens import pretokenizer

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
CACHED = 200_000
GROUP = 4_000
PAIRED = 60
STUCK = 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


class KnownIds:
    """The ids of the pre-tokens that a task has met, at most about ``most`` of them.

    When there are more, those met in one slice of texts only are forgotten; they
    are encoded again should they return.
    """

    def __init__(self, tokenizer: str, most: int = CACHED):
        self.maker, self.most = pretokenizer(tokenizer), most
        self.ids: dict[str, bytes] = {}
        self.met_again: set[str] = set()

    def of(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts that were split into pre-tokens, as little-endian words."""
        here: dict[str, bytes] = {}
        new = []
        for word in set().union(*texts):
            ids = self.ids.get(word)
            if ids is None:
                new.append(word)
            else:
                here[word] = ids
        self.met_again.update(here)
        if len(self.ids) + len(new) > self.most:
            kept = self.met_again if len(self.met_again) + len(new) <= self.most else here
            self.ids = {w: self.ids[w] for w in kept}
            self.met_again = set()
        made = dict(zip(new, self.maker.encode_words(new)))
        self.ids.update(made)
        here.update(made)
        # the words of a slice are few, so they are found faster than among all
        find = here.__getitem__
        return [b"".join(map(find, text)) for text in texts]


def cut_documents(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32, row) of every document's ids.

    The ids of a text and then ``end_id``; only longer documents are cut. A null
    text is empty. ``row`` numbers the pieces; repeated rows stay apart. A task keeps
    the ids of about 200,000 pre-tokens, and nothing when it has ended.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = KnownIds(tokenizer), np.array([end_id], "<u4").tobytes()
        split = known.maker.split
        for batch in batches:
            out = []
            for begin, stop in text_slices(batch.column(1)):
                part = batch.slice(begin, stop - begin)
                texts = known.of([split(text or "") for text in part.column(1).to_pylist()])
                for doc_id, whole in zip(part.column(0).to_pylist(), texts):
                    whole += end
                    for piece in range(-(-len(whole) // (4 * capacity))):
                        ids = whole[4 * capacity * piece : 4 * capacity * (piece + 1)]
                        out.append((doc_id, piece, capacity * piece, len(ids) // 4, zlib.crc32(ids)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = small_batches(documents).select(F.col("doc_id").cast("long"), "text")
    pieces = texts.mapInArrow(cut, PIECES.rpartition(",")[0])
    return pieces.withColumn("row", F.monotonically_increasing_id())


def _best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the fullest bin that holds it."""
    bins, free = [], []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        at = bisect_left(free, (size, -1))
        if at == len(free):
            bins.append([item])
            insort(free, (capacity - size, len(bins) - 1))
        else:
            gap, b = free.pop(at)
            bins[b].append(item)
            insort(free, (gap - size, b))
    return bins


def _improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empties the emptiest bins into the gaps of the others.

    A step gives one item or two of the emptiest bin to another underfull bin,
    for nothing or for one of its items, such that the sum of the squared fills
    rises most. What a bin gives stays given when it can't be emptied, and the next
    emptiest is tried. It ends when the sum of all lengths allows no fewer bins,
    or after 16 bins in a row that can't be emptied.
    """
    bins = [list(b) for b in bins]
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    least = -(-int(fill.sum()) // capacity)
    alive, stuck = set(range(len(bins))), set()
    while len(alive) > max(1, least) and len(stuck) < min(STUCK, len(alive)):
        donor = min(alive - stuck, key=lambda b: (fill[b], b))
        others = [b for b in alive if b != donor and fill[b] < capacity]
        # what another bin can give back: nothing, or one of its items
        owner = np.array([b for b in others for _ in range(len(bins[b]) + 1)], np.int64)
        back = np.array([i for b in others for i in [-1, *bins[b]]], np.int64)
        back_size = np.where(back < 0, 0, lengths[back]) if len(back) else back
        while bins[donor]:
            mine = bins[donor]
            gifts = [(i,) for i in mine]
            if len(mine) <= PAIRED:
                gifts += [(mine[x], mine[y]) for x in range(len(mine)) for y in range(x)]
            best = (0, None, None)
            for gift in gifts:
                gain = int(lengths[list(gift)].sum()) - back_size
                # squared fill rises if the receiver ends fuller than the donor was
                good = (gain > 0) & (gain <= capacity - fill[owner]) & (fill[owner] + gain > fill[donor])
                if good.any():
                    rise = np.where(good, gain * (gain + fill[owner] - fill[donor]), 0)
                    at = int(rise.argmax())
                    if rise[at] > best[0]:
                        best = (int(rise[at]), gift, at)
            if best[1] is None:
                break
            _, gift, at = best
            b, returned = int(owner[at]), int(back[at])
            size = int(lengths[list(gift)].sum()) - int(back_size[at])
            bins[donor] = [i for i in mine if i not in gift] + ([returned] if returned >= 0 else [])
            bins[b] = [i for i in bins[b] if i != returned] + list(gift)
            fill[donor] -= size
            fill[b] += size
            keep = owner != b
            owner = np.concatenate([owner[keep], np.full(len(bins[b]) + 1, b)])
            back = np.concatenate([back[keep], np.array([-1, *bins[b]])])
            back_size = np.where(back < 0, 0, lengths[back])
        if bins[donor]:
            stuck.add(donor)
        else:
            alive.discard(donor)
            stuck.clear()
    return [bins[b] for b in sorted(alive) if bins[b]]


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers for one bounded group of lengths."""
    return _improve(_best_fit(lengths, capacity), lengths, capacity)


def _placer(columns: list[str], capacity: int, turn: int, last: bool):
    """Packs one group; only the last turn closes underfull bins."""

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        lengths = table.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        closed = np.ones(len(lengths), bool)
        first = (turn * (1 << 34) + key[0].as_py()) << 20
        for number, items in enumerate(pack_group(lengths, capacity)):
            sequence[items] = first + number
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
            closed[items] = last or lengths[items].sum() * 64 >= capacity * 63
        kept = table.select(columns)
        for name, values in (("sequence_id", sequence), ("offset", offset), ("closed", closed)):
            kept = kept.append_column(name, pa.array(values))
        return kept

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (length, row and any other columns).

    The pieces are dealt out by number in groups of about ``group``, and each is
    packed alone. Bins that stay less than 63/64 full are opened, and their
    pieces dealt out again in fewer groups, until one group holds the rest; so at
    most a small share of a group is lost to dealing. The numbers of pieces in a
    group, not in the table, bound the memory of a task. Lengths must not exceed
    the capacity. Each round is written to the shared folder.
    """
    columns = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    open_pieces, done, turn, left = pieces, [], 0, pieces.count()
    while True:
        groups = max(1, -(-left // group))
        last = groups == 1

        dealt = open_pieces.withColumn("_group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)))
        place = _placer(columns, capacity, turn, last)
        packed = dealt.groupBy("_group").applyInArrow(place, f"{schema}, sequence_id long, offset long, closed boolean")
        packed = stored(packed, "packed")
        done.append(packed.where("closed").drop("closed"))
        if last:
            break
        open_pieces = packed.where("not closed").select(*columns)
        before, left = left, open_pieces.count()
        turn += 1
        if left == 0:
            break
        if left > before * 3 // 4:  # the lengths leave gaps in any packing
            done.append(packed.where("not closed").drop("closed"))
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document.

    An empty or null text is its end id alone; an empty table gives no rows;
    repeated rows, repeated ids and null ids are documents of their own.
    """
    pieces = stored(cut_documents(documents, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity).drop("row")
