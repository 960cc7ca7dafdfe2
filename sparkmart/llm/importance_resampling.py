"""Operator 12: resampling by importance towards a target distribution.

Documents and target texts are read as bags of hashed features: runs of ``n`` words, each
in bucket crc32 mod ``buckets``.  The gain of a bucket is the logarithm of its share in the
target over its share in the corpus; a document's weight is the mean gain of its features;
and the documents are drawn without replacement by weight plus Gumbel noise of their id.

Checksums are computed in matrices: the distinct features of a batch are grouped by length,
each group is a two-dimensional array of bytes whose checksums advance together, column by
column, and the results are scattered back to the features.  Long features are cut into
chunks of ``CHUNK`` bytes, which are rows of one matrix; their checksums are joined by the
table that moves a checksum over ``CHUNK`` bytes.

The corpus is read twice: for the counts (one array of ``buckets`` sums per task) and for the
weights.  Ranking sorts small rows by ranges, numbers each range and adds the sizes of those
before it; no task sees all rows.

To the driver come ``buckets`` counts of each side: a number that doesn't grow with the data.
NULL texts have no features and weight 0; a NULL ``doc_id`` counts as the empty text in the noise and
comes last among equals.  Rows that repeat a ``doc_id`` are documents of their own; if score
and id are equal, the one with fewer features goes first.  An empty table gives no rows, an
empty target is no features.  Only the named columns are read, so others can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, utf8, word_pieces, word_table

WORDS = word_table("abcdefghijklmnopqrstuvwxyz0123456789")
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Longest feature that is one row of a matrix, and most distinct features whose buckets a task keeps.
CHUNK, HELD_FEATURES = 256, 500_000
#: Features kept by a task are also forgotten when their bytes pass this.
HELD_BYTES = 64_000_000
#: Features are turned into arrays when so many have come together.
SLICE_WORDS = 2_000_000


# -- checksums ------------------------------------------------------------------------------


def _byte_table() -> np.ndarray:
    """How a checksum's low byte changes it when a byte is taken in."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


TABLE = _byte_table()


def advance(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Raw checksums after the bytes of each row: all rows at once, column by column."""
    for column in rows.T:
        state = TABLE[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


def _moved() -> list[list[int]]:
    """Per byte of a raw checksum, what it becomes after ``CHUNK`` zero bytes."""
    zeros = np.zeros((256, CHUNK), np.uint8)
    return [advance(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), zeros).tolist() for k in range(4)]


MOVED = _moved()


def checksums(features: list[bytes]) -> np.ndarray:
    """The unsigned CRC-32 of each feature.

    A feature of more than ``CHUNK`` bytes is a head, in the matrix of its length, and chunks.
    """
    heads: dict[int, list[int]] = {}
    for i, feature in enumerate(features):
        size = len(feature)
        heads.setdefault(size if size <= CHUNK else (size - 1) % CHUNK + 1, []).append(i)
    state = np.full(len(features), 0xFFFFFFFF, np.uint32)
    for length, at in heads.items():
        rows = np.frombuffer(b"".join([features[i][:length] for i in at]), np.uint8).reshape(len(at), length)
        state[at] = advance(state[at], rows)
    for i, feature in enumerate(features):
        if len(feature) > CHUNK:
            rows = np.frombuffer(feature, np.uint8, offset=(len(feature) - 1) % CHUNK + 1).reshape(-1, CHUNK)
            raw = int(state[i])
            for own in advance(np.zeros(len(rows), np.uint32), rows).tolist():
                raw = own ^ MOVED[0][raw & 255] ^ MOVED[1][raw >> 8 & 255] ^ MOVED[2][raw >> 16 & 255] ^ MOVED[3][raw >> 24]
            state[i] = raw
    return state ^ np.uint32(0xFFFFFFFF)


class Buckets:
    """Buckets of features; those met before are kept, up to ``HELD_FEATURES``."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.known: dict[bytes, int] = {}
        self.size = 0

    def __call__(self, features: list[bytes]) -> np.ndarray:
        if len(self.known) > HELD_FEATURES or self.size > HELD_BYTES:
            self.known, self.size = {}, 0
        new = [f for f in set(features) if f not in self.known]
        self.size += sum(map(len, new))
        self.known.update(zip(new, (checksums(new) % np.uint32(self.buckets)).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))


# -- features -------------------------------------------------------------------------------


def runs(before: list[bytes], found: list[bytes], n: int) -> list[bytes]:
    """Runs of 1 to ``n`` words that end in ``found``; ``before`` are the ``n - 1`` words that precede it."""
    words, first = before + found, len(before)
    out = list(found)
    for k in range(2, n + 1):
        out += [b" ".join(words[end - k : end]) for end in range(max(k, first + 1), len(words) + 1)]
    return out


def feature_slices(texts: list[bytes], n: int) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """(texts, words of each, features of each, features); a long text may come in several slices."""
    owners: list[int] = []
    words: list[int] = []
    sizes: list[int] = []
    flat: list[bytes] = []
    for i, data in enumerate(texts):
        tail: list[bytes] = []
        for found in word_pieces(data, WORDS):
            if not found:
                continue
            features = found if n == 1 else runs(tail, found, n)
            tail = (tail + found)[1 - n :] if n > 1 else tail
            owners.append(i)
            words.append(len(found))
            sizes.append(len(features))
            flat += features
            if len(flat) >= SLICE_WORDS:
                yield owners, words, sizes, flat
                owners, words, sizes, flat = [], [], [], []
    if flat:
        yield owners, words, sizes, flat


def bucket_counts(docs: DataFrame, n: int, buckets: int, text: str = "text") -> np.ndarray:
    """How many features of all texts are in each bucket.  A task ships one sum per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, features in feature_slices(batch.column(0).to_pylist(), n):
                counts += np.bincount(place(features), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])

    found = docs.select(utf8(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in found.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of the smoothed shares' ratio per bucket, floored."""
    buckets, all_of, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (all_of + buckets) / ((s + 1.0) * (all_target + buckets)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = Buckets(len(gain))
        for batch in batches:
            totals = np.zeros((3, batch.num_rows), np.int64)
            for owners, words, sizes, features in feature_slices(batch.column(1).to_pylist(), n):
                ends = np.cumsum(sizes)
                sums = np.add.reduceat(gain[place(features)], np.concatenate([[0], ends[:-1]]))
                for total, part in zip(totals, (words, sizes, sums), strict=True):
                    np.add.at(total, owners, part)
            mean = totals[2] // np.maximum(totals[1], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (totals[0], totals[1], mean))], names=names)

    names = ["doc_id", "n_words", "n_features", "weight"]
    schema = f"doc_id {docs.schema[key].dataType.simpleString()}, n_words long, n_features long, weight long"
    return docs.select(F.col(key).alias("doc_id"), utf8(text)).mapInArrow(run, schema)


# -- drawing --------------------------------------------------------------------------------


def noise(key: Column, seed: int) -> Column:
    """A thousand times a Gumbel number that ``seed`` and ``key`` fix, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def drawn(scored: DataFrame, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the drawn, NULL for the others.

    ``scored`` must be a table: its ranges are sampled before its rows are sorted.  Rows that
    are equal in all that orders them are told apart by their place, so many copies are many ranges.
    """
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    ranges = scored.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "copy").sortWithinPartitions(*order)
    # the id has the number of the range in its upper bits and the place within it in the lower 33
    placed = cut(ranges.drop("copy").withColumn("place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    n = scored.filter("eligible").count() * percent // 100
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(sizes, part == F.col("part")).withColumn("rank", F.when(rank <= n, rank)).drop("place", "part", "before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, n: int = 1, buckets: int = 10_000, seed: int = 2024,
    key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``.

    ``percent`` of the documents with at least ``least`` words are drawn.
    """
    gain = gains(bucket_counts(docs, n, buckets, text), bucket_counts(target, n, buckets, target_text))
    weighed = weights(docs, gain, n, key, text)
    scored = weighed.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "eligible": F.col("n_words") >= least})
    return drawn(cut(scored, "scores"), percent).select("doc_id", "n_features", "weight", "score", "rank")
