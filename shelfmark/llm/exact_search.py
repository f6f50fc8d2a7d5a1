"""Exact top-k search by inner product with cover trees over queries and data.

Vectors are dealt to blocks by their nearest centre, so that a block is a ball of
near vectors; the block is the tree's top node, and a cover tree splits it
further. A pair of nodes is visited only while its greatest possible product,
from the centres' product, their norms and the two covering radii, can still
beat the worst kth score of the query node's vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

SCALE = 256
CENTRES = 64
SAMPLE = 2_000
BLOCK, QUERIES = 4_000, 2_000
LEAST_SHARES, BLOCKS_PER_SHARE = 24, 64
LEAF = 128
FAN = 48
BLOCK_TYPE = "side int, block int, part int, ids array<long>, width int, vectors binary"


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component, as an array of longs."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE))


def usable(embedding: Column) -> Column:
    """A vector with components, none of them null, NaN or infinite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(True))


@dataclass
class Node:
    """A ball around a centre; ``items`` are rows of the block's matrix."""

    centre: np.ndarray
    radius: float
    norm: float
    items: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(vectors: np.ndarray, items: np.ndarray | None = None, centre: np.ndarray | None = None) -> Node:
    """A cover tree of the rows of ``vectors``.

    A node's children are balls of at most half its radius around rows that lie
    apart; each row goes to the first child that covers it. Where more than 48
    children would be needed, as among far-apart rows of many dimensions, the
    rest is divided among the nearest of those there are. A ball of up to 128
    rows, or of equal rows, is a leaf.
    """
    items = np.arange(len(vectors)) if items is None else items
    rows = vectors[items]
    centre = rows[0] if centre is None else centre
    radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max(initial=0.0)))
    node = Node(centre, radius, float(np.sqrt((centre**2).sum())), items)
    if len(items) <= LEAF or radius == 0:
        return node
    # farthest-first, so that centres lie at least half the radius apart while that holds
    nearest = ((rows - centre) ** 2).sum(axis=1)
    owner = np.zeros(len(items), np.int64)
    centres = [centre]
    while len(centres) < FAN and nearest.max() > (radius / 2) ** 2:
        far = rows[int(nearest.argmax())]
        distance = ((rows - far) ** 2).sum(axis=1)
        owner[distance < nearest] = len(centres)
        nearest = np.minimum(nearest, distance)
        centres.append(far)
    for number, middle in enumerate(centres):
        mine = items[owner == number]
        if len(mine) == len(items):
            return node
        if len(mine):
            node.children.append(cover_tree(vectors, mine, middle))
    return node


def bound(query: Node, data: Node) -> float:
    """No product of a vector of one node and one of the other is greater, even after rounding."""
    most = float(query.centre @ data.centre) + query.norm * data.radius + data.norm * query.radius + query.radius * data.radius
    return most + 1 + 1e-9 * (query.norm + query.radius) * (data.norm + data.radius)


class TopK:
    """The best k of every query of a block so far: score falling, then id rising."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def worst(self, node: Node) -> float:
        return float(self.scores[node.items, -1].min())

    def meet(self, mine: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compares some queries with some rows, but none with itself."""
        scores = self.vectors[mine] @ vectors.T
        scores[self.ids[mine][:, None] == ids[None, :]] = -np.inf
        for row, q in enumerate(mine.tolist()):
            good = np.flatnonzero(scores[row] >= max(self.scores[q, -1], -1e300))
            if len(good):
                s = np.concatenate([self.scores[q], scores[row, good]])
                i = np.concatenate([self.found[q], ids[good]])
                best = np.lexsort((i, -s))[: self.k]
                self.scores[q], self.found[q] = s[best], i[best]

    def visit(self, query: Node, data: Node, ids: np.ndarray, vectors: np.ndarray) -> None:
        """The dual descent; equal bounds are visited, for ties are decided by id."""
        if bound(query, data) < self.worst(query):
            return
        if not query.children and not data.children:
            self.meet(query.items, ids[data.items], vectors[data.items])
        elif query.children and (not data.children or query.radius > data.radius):
            for child in query.children:
                self.visit(child, data, ids, vectors)
        else:
            for child in sorted(data.children, key=lambda d: -bound(query, d)):
                self.visit(query, child, ids, vectors)


def _centres(rows: DataFrame) -> np.ndarray:
    """Up to 64 centres from a sample of at most 2,000 rows, the ones with the least hash of their id."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    points = np.array([r.vector for r in sample], float)
    if not len(points):
        return points
    chosen = [points[0]]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < CENTRES and nearest.max() > 0:
        chosen.append(points[int(nearest.argmax())])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _blocks(rows: DataFrame, side: int, centres: np.ndarray, most: int) -> DataFrame:
    """(side, block, part, ids, width, vectors): the rows in blocks of about ``most`` vectors, each around one centre.

    A centre that holds more is divided by hash of the row's number, so one
    vector that fills a third of the table fills as many blocks as it needs.
    """
    known = rows.sparkSession.sparkContext.broadcast(centres)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = known.value
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(len(batch), middle.shape[1])
            block = ((middle**2).sum(axis=1)[None, :] - 2 * x @ middle.T).argmin(axis=1)
            arrays = [*batch.columns, pa.array(block, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "vector", "block"])

    placed = rows.select("vec_id", "vector").mapInArrow(nearest, "vec_id long, vector array<long>, block int")
    placed = stored(placed.withColumn("number", F.monotonically_increasing_id()), "placed-vectors")
    parts = placed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("number"), F.col("parts")).cast("int")
    dealt = placed.join(F.broadcast(parts), "block").select(F.lit(side).alias("side"), "block", part.alias("part"), "vec_id", "vector")

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        matrix = np.array(table.column("vector").to_pylist(), np.int64)
        arrays = [[k.as_py()] for k in key]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        arrays += [[table.column("vec_id").to_pylist()], [matrix.shape[1]], [matrix.tobytes()]]
        names = [part.split()[0] for part in BLOCK_TYPE.split(", ")]
        return pa.table([pa.array(a, kind) for a, kind in zip(arrays, kinds)], names)

    return stored(dealt.groupBy("side", "block", "part").applyInArrow(gather, BLOCK_TYPE), "vector-blocks")


def _unpacked(ids, width: int, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block; products of whole numbers this size are exact in doubles."""
    return np.array(ids, np.int64), np.frombuffer(raw, np.int64).reshape(-1, width).astype(float)


def search(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows by integer inner product.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows but the query's own, ties go to the smaller vec_id. Vectors that are
    null, empty, or hold a null or non-finite component take no part, nor do rows
    without an id. The others must have one length. A query with fewer candidates
    returns all. Rows that repeat an id are candidates of their own, but never of
    a query with that id, and a repeated query is answered once, for its least
    vector. An empty table gives no rows. Scores are exact while the products of
    whole vectors stay below 2^53, as with components within 16,384.

    Every query block meets every data block in the trees' top nodes; blocks
    are joined in pairs, nearest first, and each query block works through its
    share of the data blocks with its own best scores so far.
    """
    kept = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = stored(kept.select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("vector")), "quantised")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    total, wanted = rows.count(), asked.count()
    if not wanted:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres = _centres(rows)
    data = _blocks(rows, 0, centres[: max(1, total // BLOCK)], BLOCK)
    queries = _blocks(asked, 1, centres[: max(1, wanted // QUERIES)], QUERIES).select(
        F.concat_ws("-", "block", "part").alias("query"),
        F.col("block").alias("query_block"),
        F.col("ids").alias("query_ids"),
        "width",
        F.col("vectors").alias("query_vectors"),
    )
    blocks = data.count()
    share = F.pmod(F.xxhash64("block", "part"), F.lit(min(blocks, max(LEAST_SHARES, blocks // BLOCKS_PER_SHARE))))
    # a stated query set against all rows, in blocks
    pairs = data.select("block", "part", "ids", "vectors", share.alias("share")).crossJoin(queries)
    far = F.col("query_block") != F.col("block")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best, tree = None, None, None
        for batch in batches:
            for query, share_no, query_ids, width, query_raw, ids, raw in zip(*(c for c in batch.columns)):
                here = (query.as_py(), share_no.as_py())
                if here != at:
                    if best is not None:
                        yield _answers(best)
                    at = here
                    mine = _unpacked(query_ids.as_py(), width.as_py(), query_raw.as_py())
                    best, tree = TopK(*mine, k), cover_tree(mine[1])
                ids, vectors = _unpacked(ids.as_py(), width.as_py(), raw.as_py())
                best.visit(tree, cover_tree(vectors), ids, vectors)
        if best is not None:
            yield _answers(best)

    dealt = pairs.withColumn("far", far).repartition("query", "share").sortWithinPartitions("query", "share", "far", "block", "part")
    found = dealt.select("query", "share", "query_ids", "width", "query_vectors", "ids", "vectors").mapInArrow(
        answer, "query_id long, vec_id long, score long"
    )
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k)
    return (
        found.groupBy("query_id")
        .agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.less")).alias("score"))
    )


def _answers(best: TopK) -> pa.RecordBatch:
    there = np.isfinite(best.scores)
    query = np.repeat(best.ids, there.sum(axis=1))
    arrays = [pa.array(query), pa.array(best.found[there]), pa.array(best.scores[there].astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])
