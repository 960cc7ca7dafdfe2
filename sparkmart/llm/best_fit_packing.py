"""Operator 6: packing documents into sequences by the configuration linear program.

Lengths are at most ``CAPACITY``, so the corpus enters the program as a histogram of
that many bins at most, whatever its size.  A configuration says how many pieces of each
length share a sequence.  The program - fewest configurations that cover the histogram -
is solved by multiplicative weights: lengths have prices, and a knapsack by dynamic
programming prices the best filling of every room.  A round takes whole configurations of
nearly the best value, as long as what they name is left; then prices of what was covered
fall and those of what stays behind rise.  Any prices give a lower bound on all plans.  The fractional solution is rounded to whole configurations, and the program
runs again on what is left, until the bound is met or a run settles less than ``PROGRESS`` of it.
The shortest pieces, ``ASIDE`` of all tokens, stay out of the program: they and what is left go
by best fit into the room that is left and into new sequences, again on counts.

Spark does the rest: it cuts and tokenizes, counts lengths, ranks the pieces of a length
(in buckets, so that a length held by a third of all pieces is no single task's sort) and
looks each rank up in the plan.

NULL and empty texts are one piece of the end token alone.  Pieces of one length are
exchangeable: ties and repeated rows each get a place of their own.  An empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, map_texts, to_arrow
from sparkmart.llm.tokenizer_memo import word_token_ids

CAPACITY = 2048
#: Rounds of a run, how fast prices move, and what counts as nothing left.
ROUNDS, STEP, EPSILON = 20, 1.0, 1e-9
#: How far below the best value a configuration may be; after a round that covers less than ``SLOW`` of the pieces it is ``EASED`` times as far.
SLACK, SLOW, EASED = 0.01, 0.02, 1.5
#: Share of the pieces left that a run must settle for another one to follow, and of all tokens that the shortest pieces hold.
PROGRESS, ASIDE = 0.1, 0.005
#: Pieces that one bucket of a length has on average, were they all of that length.
BUCKET_PIECES = 4096

#: A configuration: (length, how many of it), and how many sequences use it.
Items = tuple[tuple[int, int], ...]
Plan = list[tuple[Items, int]]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens; a document ends with ``end_id``."""

    def rows(keys, texts):
        for key, ids in zip(keys, word_token_ids(path, texts), strict=True):
            data = np.append(ids, end_id).astype("<u4").tobytes()
            for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                own = data[at : at + 4 * capacity]
                yield key, piece, at // 4, len(own) // 4, zlib.crc32(own)

    return map_texts(docs, rows, PIECES)


def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each room, the value of its most valuable filling, and the length to take next in it (0: leave one token free)."""
    capacity = len(price) - 1
    lengths = np.flatnonzero(price)
    value = price[lengths]
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fitting[room]:
            values = value[: fitting[room]] + best[room - lengths[: fitting[room]]]
            k = int(values.argmax())
            if values[k] > best[room]:
                best[room], take[room] = values[k], lengths[k]
    return best, take


def configuration(length: int, take: list[int]) -> Items:
    """``length`` and the best filling of the room beside it, longest first."""
    items, room = Counter([length]), len(take) - 1 - length
    while room > 0:
        if take[room]:
            items[take[room]] += 1
        room -= take[room] or 1
    return tuple(sorted(items.items(), reverse=True))


def fractional_plan(need: np.ndarray, rounds: int = ROUNDS) -> tuple[list[tuple[Items, float]], float]:
    """(configurations and how often each is used, a lower bound on the sequences that ``need`` - pieces by length - takes).

    No length is covered more often than needed; with few ``rounds`` some are covered less.
    Configurations are begun by the longer half of the lengths: of pieces longer than half a
    sequence no two meet, so each begins one anyway, and shorter ones are kept to fill it.
    A length's price is its size times a weight.  Prices at which no configuration is worth
    more than one sequence prove that the pieces' total price is a lower bound.
    """
    capacity = len(need) - 1
    size = np.arange(capacity + 1) / capacity
    weight = np.ones(capacity + 1)
    left = need.astype(float)
    chosen: dict[Items, float] = defaultdict(float)
    bound, slack = 0.0, SLACK
    for _ in range(rounds):
        price = np.where(left > 0, size * weight, 0.0)
        best, take = knapsack(price)
        if not best[capacity]:
            break
        bound = max(bound, float(need @ price) / best[capacity])
        enough, take = (1 - slack) * best[capacity], take.tolist()
        open_ = left.copy()
        lengths = np.flatnonzero(left)[::-1]
        for length in lengths[lengths > lengths[0] // 2].tolist():
            items = configuration(length, take)
            if sum(price[k] * many for k, many in items) < enough:
                continue
            amount = min(open_[k] / many for k, many in items)
            if amount > EPSILON:
                chosen[items] += amount
                for k, many in items:
                    open_[k] -= amount * many
        covered, some = left - open_, left > 0
        part = covered[some] / left[some]
        weight[some] *= np.exp(STEP * (part.mean() - part))
        left = np.where(open_ > EPSILON, open_, 0.0)
        if covered.sum() < SLOW * need.sum():
            slack = min(1.0, slack * EASED)
    return list(chosen.items()), bound


def best_fit(need: np.ndarray, begun: Plan = ()) -> Plan:
    """Best fit, longest first, on counts, into sequences already ``begun`` and new ones; equal ones are filled alike."""
    capacity = len(need) - 1
    open_: dict[int, list] = defaultdict(list)
    for items, n in begun:
        open_[capacity - sum(length * many for length, many in items)].append((items, n))
    for length in range(capacity, 0, -1):
        left = int(need[length])
        while left:
            room = next((r for r in range(length, capacity) if open_.get(r)), None)
            if room is None:
                each = capacity // length
                for many, n in ((each, left // each), (left % each, 1)):
                    if many and n:
                        open_[capacity - many * length].append((((length, many),), n))
                break
            items, n = open_[room].pop()
            each = min(room // length, left)
            many = min(n, left // each)
            if many < n:
                open_[room].append((items, n - many))
            open_[room - each * length].append(((*items, (length, each)), many))
            left -= each * many
    return [group for groups in open_.values() for group in groups]


def rounded(left: np.ndarray, chosen: list[tuple[Items, float]]) -> Plan:
    """Whole configurations for fractional ones, as far as their pieces are ``left``, from which they are taken.

    What an amount has above a whole number is carried to the next configuration.
    """
    plan: Plan = []
    carry = 0.0
    for items, amount in chosen:
        carry += amount
        n = min(int(carry + EPSILON), *(int(left[k]) // many for k, many in items))
        carry = min(carry - n, 1.0)
        if n:
            plan.append((items, n))
            for k, many in items:
                left[k] -= many * n
    return plan


def packing_plan(need: np.ndarray, rounds: int = ROUNDS) -> Plan:
    """Configurations in whole numbers that hold every piece of ``need`` exactly once; of several runs the plan with fewest."""
    tokens = need * np.arange(len(need))
    aside = np.where(np.cumsum(tokens) <= ASIDE * tokens.sum(), need, 0)
    left = (need - aside).astype(np.int64)
    begun: Plan = []
    best: Plan | None = None
    bound = -(-int(tokens.sum()) // (len(need) - 1))
    while True:
        before = int(left.sum())
        chosen, least = fractional_plan(left, rounds)
        if not begun:
            bound = max(bound, int(np.ceil(least - 1e-6)))
        begun += rounded(left, chosen)
        plan = best_fit(left + aside, begun)
        best = plan if best is None else min(best, plan, key=sequences)
        if sequences(best) <= bound or before - left.sum() < max(1, PROGRESS * before):
            return best


def sequences(plan: Plan) -> int:
    return sum(n for _, n in plan)


class Places:
    """(length, rank among pieces of that length) -> sequence and offset, for a plan."""

    def __init__(self, plan: Plan):
        taken: dict[int, int] = defaultdict(int)
        rows, base = [], 0
        for items, n in plan:
            offset = 0
            for length, many in items:
                for _ in range(many):
                    rows.append((length, taken[length], base, offset))
                    taken[length] += n
                    offset += length
            base += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.length, self.rank, self.base, self.offset = table.T
        self.key = (self.length << np.int64(48)) | self.rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << np.int64(48)) | rank, side="right") - 1
        return self.base[at] + rank - self.rank[at], self.offset[at]


def histogram(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces by length: at most ``capacity`` rows come to the driver."""
    need = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        need[row["length"]] = row["count"]
    return need


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``pieces``, a table that gives the same rows again when re-read."""
    need = histogram(pieces, capacity)
    total = int(need.sum())
    if not total:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = Places(packing_plan(need, rounds))
    # rows of one id, or of none, are told apart by their content: together they can be many
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(-(-total // BUCKET_PIECES))).cast("int")
    keyed = pieces.withColumn("_bucket", bucket)
    before = F.sum("count").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = keyed.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_row", F.row_number().over(order)).join(sizes, ["length", "_bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_row") - 1).alias("_rank"))
    schema = f"{PIECES}, sequence_id long, offset long"
    arrow = to_arrow(pieces.sparkSession, schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.find(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], schema=arrow)

    names = [f.split()[0] for f in PIECES.split(", ")]
    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut, tokenize and pack ``doc_id, text``."""
    return pack(cut(cut_pieces(docs, path, capacity), "pieces"), capacity)
