"""Operator 2: nearest neighbours by a forest of hash prefixes.

Each tree gives every vector a long hash string: signs of its projections on random
directions, packed into one number.  The vectors lie in blocks of bounded size; a block's
forest is one sorted array of these numbers per tree.  A stated set of queries meets all
blocks, a block of queries at a time.  A query descends to its longest prefix match in
each array; then all trees are ascended together, to shorter and shorter prefixes, which
adds candidates.  The ascent ends when a vector as near as the k-th best candidate would,
by the chance that its bits agree, have been met in some tree with probability
1 - ``MISS``.  Near neighbours are thus found deep in the trees, while vectors without near
ones admit much of a block.  Only what a prefix adds is scored, once for each query.  What a
block returns is scored again, in double precision on the original vectors.

Equal vectors are one entry with its smallest ids, as ties go to the smaller id; a vector
held by a third of all rows is one entry too.  Rows that share an id but not the vector are
candidates of their own, so one id can be several neighbours; as queries they share one list,
of the nearest to any of them.  Rows without an id take no part.  Vectors that are NULL, empty, zero or hold
NULL or non-finite components take no part, as queries or candidates; vectors of different
dimension don't meet.  A query gets fewer rows only if there are fewer candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import cut

TREES, BITS, SEED = 24, 62, 42
#: Lengths of prefixes at which an ascent pauses, and the chance of missing a neighbour at which it ends.
LEVELS = (62, 50, 40, 32, 26, 22, 18, 15, 13, 11, 9, 8, 7, 6, 5, 4, 3, 2, 1, 0)
MISS = 0.05
#: Entries of a block, queries of a block, and scores in memory at once, about.
BLOCK_ROWS, ASK_ROWS, SCORES = 16_384, 2_048, 2_000_000


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, scaled first: squares neither overflow nor vanish."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return np.clip((a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))), -1.0, 1.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def directions(dimension: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension, trees * bits))


def hash_strings(vectors: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """One number per vector and tree; its highest bits are the first of the string."""
    signs = (vectors @ directions(vectors.shape[1], trees, bits) > 0).reshape(len(vectors), trees, bits)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64))


class Forest:
    """Sorted arrays of hash strings of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES):
        self.ids, self.vectors, self.trees = ids, vectors, trees
        self.unit = unit(vectors)
        #: Entries scored so far, for all queries.
        self.scored = 0
        hashes = hash_strings(self.unit, trees)
        self.order = np.argsort(hashes, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(hashes, self.order.T, axis=0).T.copy()

    def search(self, asks: np.ndarray, k: int, miss: float = MISS) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``asks``, row of the block): the ``k`` best candidates of each query."""
        asks = unit(asks)
        hashes = hash_strings(asks, self.trees)
        rows = max(1, SCORES // len(self.ids))
        found = [self._chunk(asks[at : at + rows], hashes[at : at + rows], k, miss) for at in range(0, len(asks), rows)]
        return np.concatenate([q + i * rows for i, (q, _) in enumerate(found)]), np.concatenate([e for _, e in found])

    def _chunk(self, asks: np.ndarray, hashes: np.ndarray, k: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
        known = np.full((len(asks), len(self.ids)), -np.inf)
        active = np.arange(len(asks))
        low = np.zeros((len(asks), self.trees), np.int64)
        high = np.zeros_like(low)
        for level in LEVELS:
            shift = BITS - level
            prefix = hashes[active] >> shift
            new_low, new_high = np.empty_like(prefix), np.empty_like(prefix)
            for t in range(self.trees):
                new_low[:, t] = np.searchsorted(self.sorted[t], prefix[:, t] << shift)
                new_high[:, t] = np.searchsorted(self.sorted[t], (prefix[:, t] + 1) << shift)
            old_low, old_high = low[active], high[active]
            begun = old_high > old_low
            added = np.zeros((len(active), len(self.ids)), bool)
            # what the shorter prefix adds on either side
            for first, last in ((new_low, np.where(begun, old_low, new_high)), (np.where(begun, old_high, new_high), new_high)):
                size = (last - first).ravel()
                at = np.repeat(first.ravel() - (np.cumsum(size) - size), size) + np.arange(size.sum())
                query, tree = (np.repeat(x.ravel(), size) for x in np.indices(first.shape))
                entry = self.order[tree, at]
                added[query, entry] = True
            for q, some in zip(active.tolist(), added, strict=True):
                entry = np.flatnonzero(some & (known[q] == -np.inf))
                known[q, entry] = self.unit[entry] @ asks[q]
                self.scored += len(entry)
            low[active], high[active] = new_low, new_high
            if len(self.ids) >= k:
                worst = np.partition(known[active], len(self.ids) - k, axis=1)[:, len(self.ids) - k]
            else:
                worst = np.full(len(active), -np.inf)
            agree = 1 - np.arccos(np.clip(worst, -1, 1)) / np.pi
            active = active[(1 - agree**level) ** self.trees > miss] if level else active[:0]
            if not len(active):
                break
        queries, entries = [], []
        for q, row in enumerate(known):
            worst = np.partition(row, len(row) - k)[len(row) - k] if len(row) >= k else -np.inf
            near = np.flatnonzero((row > -np.inf) & (row >= worst - 1e-12))
            best = near[np.lexsort((self.ids[near], -np.round(row[near], 12)))[:k]]
            queries.append(np.full(len(best), q))
            entries.append(best)
        return np.concatenate(queries), np.concatenate(entries)


def _blocks(rows: DataFrame, count: int, name: str) -> DataFrame:
    """``dim, block`` and the rows' ids and vectors, one after the other, as ``<name>_ids`` and ``<name>``."""
    block = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    packed = rows.groupBy(F.size("vector").alias("dim"), block.alias("block")).agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
    return packed.select("dim", "block", F.col("rows.id").alias(f"{name}_ids"), F.flatten(F.col("rows.vector")).alias(name))


def block_neighbours(entries: DataFrame, asks: DataFrame, total: int, asked: int, k: int) -> DataFrame:
    """``query_id, id, score``: the ``k`` best of each block for each query; both are ``id, vector`` tables."""
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, flat, ask_ids, ask_flat = (c[i].values.to_numpy(zero_copy_only=False) for c in batch.columns)
                vectors, wanted = (x.astype(np.float64).reshape(len(y), -1) for x, y in ((flat, ids), (ask_flat, ask_ids)))
                query, entry = Forest(ids, vectors).search(wanted, k)
                score = cosine(wanted[query], vectors[entry])
                yield pa.RecordBatch.from_arrays([pa.array(ask_ids[query]), pa.array(ids[entry]), pa.array(score)], schema=schema)

    blocks = -(-total // BLOCK_ROWS)
    index = _blocks(entries, blocks, "entry")
    # every block of queries goes to every block of entries: not pairs of rows
    wanted = _blocks(asks, -(-asked // ASK_ROWS), "ask").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = index.join(wanted, ["dim", "block"])
    return met.select("entry_ids", "entry", "ask_ids", "ask").mapInArrow(run, "query_id long, id long, score double")


def nearest(vectors: DataFrame, k: int, every: int) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest of each row of ``id, vector`` whose id is divisible by ``every``."""
    rows = vectors.filter(F.col("id").isNotNull() & usable(F.col("vector"))).select("id", "vector")
    first = Window.partitionBy("vector").orderBy("id")
    copies = rows.withColumn("n", F.dense_rank().over(first)).filter(F.col("n") <= k + 1)
    entries = cut(copies.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "ids", "vector"), "entries")
    asks = cut(rows.filter(F.col("id") % every == 0).distinct(), "asks")
    total, asked = entries.count(), asks.count()
    if not total or not asked:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score")).filter("false")
    # one more than asked for: a query may find its own entry
    near = block_neighbours(entries.select("id", "vector"), asks, total, asked, k + 1)
    found = near.join(entries.select("id", "ids"), "id").select("query_id", F.explode("ids").alias("id"), "score").filter("id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
