"""Operator 11: audit of how far the sources of a language diverge in their words.

Counting: each task counts the terms of its documents by (lang, source, term) and ships
the counts, so a source with a third of all rows is folded before the shuffle.  Counts
meet by (lang, term): there the documents with the term are known, and rare terms go.

Terms that stand out (part ``term``) are found by a dominance skyband.  The value of a
term grows with its count in the group and falls with its count in the language, and ties
go to the earlier UTF-8; so a term with ``k`` others that are no worse in both counts and
earlier in UTF-8 can't be among the first ``k``.  Every partition keeps only terms
dominated by fewer than ``k`` others, the partitions' skybands are merged the same way,
and what is left is ranked exactly.

Distances of sources (part ``pair``) are sums over all kept terms.  Sources are numbered
per language and cut into tiles of ``TILE``; a task takes two tiles and a bucket of terms
and adds up a dense matrix.  No pair meets a term as a row: rows are repeated once per
tile, not once per source, and only sums leave a task.

All arithmetic is in whole numbers.  NULL lang, source and text count as ''.  Repeated
rows and ids are documents of their own; ``doc_id`` is not read, nor is any other column,
so extra ones can't clash.  Texts of any length are counted whole; bytes that are no UTF-8
are letters like others above 127.  A group without terms has pair rows only; a language
of one source has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, utf8, word_table

LETTERS = word_table("abcdefghijklmnopqrstuvwxyz")
#: A task ships its counts when it holds so many terms, or has read so many bytes since.
HELD_TERMS, HELD_BYTES = 200_000, 256_000_000
#: Sources of a tile, and terms of a bucket: they bound the matrix of one task.
TILE, BUCKET = 64, 1024
#: Points of a skyband that are compared at once, and rows a task holds per group before it thins them.
BLOCK, HELD_ROWS = 256, 4096


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs`` as the tasks counted them; a key may come from many tasks."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def told(seen: dict) -> Iterator[pa.RecordBatch]:
        for (of_lang, of_source), (times, within) in seen.items():
            size = len(times)
            columns = [[of_lang] * size, [of_source] * size, list(times), list(times.values()), [within[t] for t in times]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        terms = size = 0
        for batch in batches:
            for of_lang, of_source, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = data.translate(LETTERS).split()
                times, within = seen.setdefault((of_lang, of_source), (Counter(), Counter()))
                terms -= len(times)
                times.update(found)
                within.update(set(found))
                terms += len(times)
                size += len(data)
                if terms > HELD_TERMS or size > HELD_BYTES:
                    yield from told(seen)
                    seen, terms, size = {}, 0, 0
        yield from told(seen)

    rows = docs.select(_named(lang).alias("lang"), _named(source).alias("source"), utf8(text))
    return rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def _named(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """``lang, source, term, g, l, head`` of terms in at least ``least`` documents of the lang.

    ``g`` and ``l`` are occurrences in the group and in the lang; ``head`` marks one row per
    (lang, term).  One shuffle: the rows of a term stay where their counts have met.
    """
    counted = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("g"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    told = counted.select(
        "lang", "source", "term", "g", F.sum("g").over(whole).alias("l"),
        F.sum("docs").over(whole).alias("docs"), (F.min("source").over(whole) == F.col("source")).alias("head"),
    )
    return told.filter(F.col("docs") >= least).drop("docs")


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (lang, source): ``total`` and ``lang_total`` of kept terms, ``terms`` of the lang, ``at`` (number in the lang), ``of`` (sources)."""
    own = kept.groupBy("lang", "source").agg(F.sum("g").alias("total"))
    langs = kept.filter("head").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("l").alias("lang_total"))
    told = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    return told.withColumns({
        "at": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1,
        "of": F.count(F.lit(1)).over(Window.partitionBy("lang")),
    })


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)), exact.

    Three digits at a time, as in long division: no product passes a thousand times the total.
    """
    over = F.greatest(total + 5 * terms, F.lit(1))
    found, rest = F.lit(0).cast("long"), count + 5
    for _ in range(3):
        step = rest * 1000
        found, rest = found * 1000 + _div(step, over), step % over
    return 1 + found


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


# -- terms that stand out ---------------------------------------------------------------


def skyband(more: np.ndarray, less: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Positions of the points that fewer than ``k`` others dominate.

    One point dominates another if its ``more`` is at least as high, its ``less`` at most as
    high and its name earlier.  In the order of (more down, less up, name up) dominators come
    first, and the first ``k`` of a point are themselves in the skyband; so each block is
    compared with what is kept and with itself.
    """
    late = np.unique(names, return_inverse=True)[1].reshape(-1)
    order = np.lexsort((late, less, -more))
    kept: list[np.ndarray] = []
    low, early = np.empty(0, less.dtype), np.empty(0, late.dtype)
    for start in range(0, len(order), BLOCK):
        part = order[start : start + BLOCK]
        x, y = less[part], late[part]
        before = ((low <= x[:, None]) & (early < y[:, None])).sum(1)
        inside = np.tril((x <= x[:, None]) & (y < y[:, None]), -1).sum(1)
        stays = before + inside < k
        kept.append(part[stays])
        low, early = np.concatenate([low, x[stays]]), np.concatenate([early, y[stays]])
    return np.concatenate(kept) if kept else order


def partition_skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows of ``lang, source, term, g, l, value`` that fewer than ``k`` of their partition dominate.

    A task holds at most twice a group's skyband and ``HELD_ROWS`` rows of it.
    """

    def thin(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.iloc[skyband(frame["g"].to_numpy(), frame["l"].to_numpy(), frame["term"].to_numpy(object), k)]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        for frame in frames:
            for key, part in frame.groupby(["lang", "source"], sort=False):
                parts, size, limit = held.get(key, ([], 0, HELD_ROWS))
                parts, size = [*parts, part], size + len(part)
                if size > limit:
                    parts = [thin(pd.concat(parts))]
                    size = len(parts[0])
                    limit = HELD_ROWS + 2 * size
                held[key] = (parts, size, limit)
        for parts, _, _ in held.values():
            yield thin(pd.concat(parts))

    return rows.mapInPandas(run, rows.schema)


def standing_out(kept: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """Part ``term``: the first ``k`` terms per group whose share is above the language's."""
    both = kept.join(totals, ["lang", "source"])
    own, all_of = share(F.col("g"), F.col("total"), F.col("terms")), share(F.col("l"), F.col("lang_total"), F.col("terms"))
    rows = both.select("lang", "source", "term", "g", "l", (own - all_of).alias("value")).filter("value > 0")
    merged = partition_skybands(partition_skybands(rows, k).repartition("lang", "source"), k)
    return _ranked(merged.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")).filter(F.col("rank") <= k)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order).cast("int"))


# -- distances of sources -------------------------------------------------------------------


def source_distances(kept: DataFrame, totals: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """Part ``pair``: to each other source of the lang, the sum of differences over all kept terms.

    A source without a term has the same share of every such term, its base.  A group of rows is
    two tiles and a bucket of terms; it gets the bases of its sources besides the terms, and gives
    for each pair the differences less those of the bases.  Bucket 0 adds the latter for all terms.
    """
    base = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    tiles, buckets = F.ceil(F.col("of") / tile).cast("int"), (1 + _div(F.col("terms"), F.lit(bucket))).cast("int")
    numbered = totals.select("lang", "source", "at", "total", "terms", tiles.alias("tiles"), buckets.alias("buckets"), base.alias("base"))
    nothing = F.lit(None).cast("binary").alias("term")
    bases = numbered.select(
        "lang", "at", "source", "terms", "tiles", nothing, F.col("base").alias("p"), F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    shares = kept.join(numbered, ["lang", "source"]).select(
        "lang", "at", F.lit(None).cast("string").alias("source"), "terms", "tiles", "term", share(F.col("g"), F.col("total"), F.col("terms")).alias("p"),
        F.pmod(F.hash("term"), F.col("buckets")).alias("bucket"))
    own = F.floor(F.col("at") / tile).cast("int")
    placed = bases.unionByName(shares).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumns({"low": F.least(own, F.col("other")), "high": F.greatest(own, F.col("other"))})
    sums = placed.groupBy("lang", "low", "high", "bucket").applyInPandas(lambda key, rows: _tile_sums(key, rows, tile), "lang string, a string, b string, value long")
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return _ranked(pairs.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value"))


def _tile_sums(key: tuple, rows: pd.DataFrame, tile: int) -> pd.DataFrame:
    lang, low, high, bucket = key
    is_base = rows["term"].isna()
    bases = rows[is_base].sort_values("at")
    at, names, base = bases["at"].to_numpy(), bases["source"].to_numpy(object), bases["p"].to_numpy()
    seen = rows[~is_base]
    codes, terms = pd.factorize(seen["term"])
    matrix = np.repeat(base[None, :], len(terms), axis=0)
    matrix[codes, np.searchsorted(at, seen["at"].to_numpy())] = seen["p"].to_numpy()
    of_all = rows["terms"].iloc[0] if bucket == 0 else 0
    out = []
    # of two tiles, the sources of the first meet those of the second
    of_low = len(at) if low == high else int((at < high * tile).sum())
    for i in range(of_low):
        first = i + 1 if low == high else of_low
        apart = np.abs(base[first:] - base[i])
        value = np.abs(matrix[:, first:] - matrix[:, i : i + 1]).sum(0) + (of_all - len(terms)) * apart
        out.append(pd.DataFrame({"lang": lang, "a": names[i], "b": names[first:], "value": value.astype("int64")}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []}).astype({"value": "int64"})


def audit(docs: DataFrame, least: int = 30, k: int = 50, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` of all groups of ``docs``."""
    kept = cut(kept_terms(term_counts(docs, text, lang, source), least), "kept_terms")
    groups = docs.select(_named(lang).alias("lang"), _named(source).alias("source")).distinct()
    totals = cut(group_totals(groups, kept), "group_totals")
    return source_distances(kept, totals).unionByName(standing_out(kept, totals, k))
