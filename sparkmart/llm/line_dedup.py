"""Operator 3: line deduplication by a segment-partition edit join, in DataFrame functions only.

Equal lines are folded first.  A line of length L is cut into ``THRESHOLD`` + 1 segments;
whoever is within ``THRESHOLD`` edits of it holds one of them unchanged, at a place that
the lengths bound.  Each distinct line therefore puts its segments into an index keyed by
(length, number, segment), and probes the segments of all lengths up to ``THRESHOLD`` less
at the places that are possible.  Lines that meet there, and whose counts of letters and
digits are near enough, are verified by a banded bit-parallel edit distance.

A line goes if an equal line, or one within the threshold, occurs earlier; the order is
(``doc_id``, position).  Lines under ``MIN_CHARS`` characters are compared for equality
only, and lines without a word stay.  A line that a third of all rows hold is one row of
the join; meetings at a very common segment are split by the join and filtered inside it
by letter counts.

With ``words_each`` the threshold also grows with the length: a line of ``MIN_WORDS`` words
or more goes, too, if an earlier one is within one edited (replaced, inserted or deleted)
word per ``words_each`` words begun of the longer one.  Word pairs take the place of
segments (``word_lines``), the exact edit distance of the words decides.  White space at a line's ends doesn't count.  NULL and empty texts lose
nothing; rows that repeat a ``doc_id`` and text are treated alike; an empty table gives no
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, words

THRESHOLD, MIN_CHARS = 2, 24
#: Lines of at least so many words are near, if asked for, within one edited word per ``WORDS_EACH`` begun.
MIN_WORDS, WORDS_EACH = 10, 20
#: A word sketch: parities of words in so many bits, then the number of words up to a limit, then a mark.
_PARITIES, _MOST_WORDS = 51, 4095
#: Characters whose counts tell lines apart that share a segment, by the bits of a count: digits, as lines
#: often differ in a number only, and frequent letters.
DIGITS, LETTERS = [(c, 2) for c in "0123456789"], [(c, 3) for c in "etaonrsihdluc"]
#: Bits of a line's length in a sketch: what lines within the threshold can differ in.
LENGTH_BITS = 2
#: White space at a line's ends, which doesn't count.
BLANKS = " \t\x0b\x0c\r"
#: Most keys of lines that are broadcast; with more of them the lines are shuffled to their keys.
BROADCAST_KEYS = 1_000_000
#: Bits of the edit distance's window; the band is 2 x ``THRESHOLD`` + 1 of them.
WINDOW = 16
_MASK = (1 << WINDOW) - 1


def _bind(value: Column, use) -> Column:
    """``use(value)``, computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trimmed(line: Column) -> Column:
    """A line without white space at its ends: empty if it has no word."""
    return F.btrim(line, F.lit(BLANKS))


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, version, pos, line`` and the line's key ``a, b`` (96 bits) for every line with a word."""
    text = F.coalesce("text", F.lit(""))
    exploded = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split(text, "\n")).alias("pos", "whole"))
    words = exploded.select("doc_id", "version", "pos", trimmed(F.col("whole")).alias("line")).filter("line <> ''")
    return words.select("*", F.xxhash64("line").alias("a"), F.hash("line").alias("b"))


def place() -> Column:
    """Where a line stands: different texts with one ``doc_id``, or with none, are different documents."""
    return F.struct("doc_id", "pos", "version")


def distinct_lines(every: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """``a, b, sketch`` and the signatures ``s0, s1, ...`` of each different line of at least ``min_chars`` characters.

    The text itself isn't shuffled: what the join needs of it is computed where it is
    read, as numbers, so equal lines are folded by a hash aggregate.
    """
    measured = every.select("a", "b", "line", F.length("line").alias("n")).filter(F.col("n") >= min_chars)
    # bounds in a projection of their own: with signatures and sketch it would be a method too large to be compiled
    bounds = [bound(F.col("n") - less, i, threshold).alias(f"p{less}_{i}") for less in range(threshold + 1) for i in range(threshold + 2)]
    near = measured.select("a", "b", "line", "n", sketch(F.col("line"), F.col("n")).alias("sketch"), *bounds)
    signatures = [_signature(less, i, shift).alias(f"s{k}") for k, (less, i, shift) in enumerate(places(threshold))]
    told = near.select("a", "b", "sketch", *signatures)
    return told.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in told.columns[2:]])


def bound(length: Column, i: int, threshold: int) -> Column:
    """Where segment ``i`` of a line of ``length`` begins, from 0; the last ones are longer by one if it doesn't divide."""
    return F.lit(0) if i == 0 else length if i > threshold else (length * i / (threshold + 1)).cast("int")


def places(threshold: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift): where a longer line can hold a segment of a shorter one."""
    found = []
    for less in range(threshold + 1):
        for i in range(threshold + 1):
            low, high = max(-i, less - (threshold - i)), min(i, less + (threshold - i))
            found += [(less, i, shift) for shift in range(low, high + 1)]
    return found


def _signature(less: int, i: int, shift: int) -> Column:
    """Of the segment ``i`` of a line shorter by ``less``, looked for ``shift`` characters further on."""
    start, end = F.col(f"p{less}_{i}"), F.col(f"p{less}_{i + 1}")
    return F.xxhash64(F.col("n") - less, F.lit(i), F.substring(F.col("line"), start + shift + 1, end - start))


def _ring(count: Column, bits: int, at: int) -> Column:
    """A count, wrapping around at twice ``bits``, as bits of which one changes whenever it changes by one."""
    size = (1 << bits) - 1
    codes = [size & (((1 << n) - 1) ^ ((1 << max(n - bits, 0)) - 1)) for n in range(2 * bits)]
    # all codes in one number, so that a look is a shift
    packed = F.lit(sum(code << n * bits for n, code in enumerate(codes))).cast("long")
    code = F.call_function("shiftright", packed, count % (2 * bits) * bits).bitwiseAND(size)
    return F.shiftleft(code, at)


def sketch(line: Column, length: Column) -> Column:
    """The length's last bits, then counts of :data:`DIGITS` and :data:`LETTERS` as rings of bits.

    Two rings differ in as many bits as their counts differ, around the ring.
    """
    # what is counted is not read again: all letters go, then one look for digits, as most lines hold none
    rings, left, at = [], line, LENGTH_BITS + sum(bits for _, bits in DIGITS)
    for c, bits in LETTERS:
        less = F.replace(left, F.lit(c), F.lit(""))
        rings.append(_ring(F.octet_length(left) - F.octet_length(less), bits, at))
        left, at = less, at + bits
    numbers, at = [], LENGTH_BITS
    for c, bits in DIGITS:
        numbers.append(_ring(F.octet_length(left) - F.octet_length(F.replace(left, F.lit(c), F.lit(""))), bits, at))
        at += bits
    either = lambda x, y: x.bitwiseOR(y)
    digits = F.when(left.rlike("[0-9]"), reduce(either, numbers)).otherwise(F.lit(0).cast("long"))
    letters = reduce(either, rings)
    return (length % (1 << LENGTH_BITS)).cast("long").bitwiseOR(digits).bitwiseOR(letters)


def sketches_near(x: Column, y: Column, threshold: int) -> Column:
    """Whether counts differ by no more than ``threshold`` edits can change, two by one each: a necessary condition."""
    return F.bit_count(F.shiftrightunsigned(x.bitwiseXOR(y), LENGTH_BITS)) <= 2 * threshold


def within_distance(long: Column, short: Column, threshold: int) -> Column:
    """Whether two lines, ``long`` not the shorter one, are within ``threshold`` edits.

    What they have in common at both ends is dropped.  Of the rest, a window of the
    dynamic programming matrix slides along the diagonal, one column per character of
    ``short``: its vertical differences are two bit vectors, and the distance is followed
    down the window's lower edge, then along the last row.
    """
    def apart(x: Column, y: Column) -> Column:
        """The arrays without their common prefix, reversed (so that a second call drops the suffix)."""
        same = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p != q, F.lit(True))), F.lit(True))
        start = F.when(same == 0, F.size(x) + 1).otherwise(same).cast("int")
        return _bind(start, lambda start: F.struct(
            F.reverse(F.slice(x, start, F.greatest(F.size(x) - start + 1, F.lit(0)))).alias("x"),
            F.reverse(F.slice(y, start, F.greatest(F.size(y) - start + 1, F.lit(0)))).alias("y")))

    both = F.struct(F.split(long, "").alias("x"), F.split(short, "").alias("y"))
    ends = _bind(_bind(both, lambda s: apart(s["x"], s["y"])), lambda s: apart(s["x"], s["y"]))
    return _bind(ends, lambda s: _banded(s["x"], s["y"], threshold) <= threshold)


def _banded(x: Column, y: Column, threshold: int) -> Column:
    """The edit distance of two arrays, ``x`` not the shorter one by no more than ``threshold``; above it, some larger number."""
    top = WINDOW - 1
    diagonal = F.size(x) - threshold

    def matches(i: Column) -> Column:
        """Which characters of ``x`` around the diagonal equal character ``i`` of ``y``."""
        bits = [F.when(F.get(x, i + threshold - d) == F.get(y, i), F.lit(1 << (top - d))).otherwise(F.lit(0)) for d in range(2 * threshold + 1)]
        return reduce(lambda p, q: p + q, bits)

    def step(s: Column, match: Column) -> Column:
        vp, vn, i = s["vp"], s["vn"], s["i"]
        d0 = ((match.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(match).bitwiseOR(vn).bitwiseAND(_MASK)

        def after(d0: Column) -> Column:
            hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(_MASK)
            hn = d0.bitwiseAND(vp)
            down = F.shiftrightunsigned(d0, 1)
            along = F.call_function("shiftleft", F.lit(1), top - 1 - (i - F.greatest(diagonal, F.lit(0))))
            score = F.when(i < diagonal, (d0.bitwiseAND(1 << top) == 0).cast("int")).otherwise(
                (hp.bitwiseAND(along) != 0).cast("int") - (hn.bitwiseAND(along) != 0).cast("int"))
            return F.struct(
                hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(_MASK).alias("vp"),
                down.bitwiseAND(hp).alias("vn"), (i + 1).alias("i"), (s["score"] + score).alias("score"))

        return F.when(s["score"] > 3 * threshold, s).otherwise(_bind(d0, after))

    start = F.struct(F.lit((-1 << (top - threshold)) & _MASK).alias("vp"), F.lit(0).alias("vn"), F.lit(0).alias("i"), F.lit(threshold).alias("score"))
    some = F.aggregate(F.transform(F.sequence(F.lit(0), F.size(y) - 1), matches), start, step, lambda s: s["score"])
    # within the threshold the shorter one may be used up: what is left of the longer one are edits
    return F.when(F.size(x) - F.size(y) > threshold, F.lit(threshold + 1)).when(F.size(y) == 0, F.size(x)).otherwise(some)


def candidates(different: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``a, a2``: keys of lines that share a segment where they can and whose sketches are near, the longer one first."""
    own = [places(threshold).index((0, i, 0)) for i in range(threshold + 1)]
    every = F.array(*[f"s{k}" for k in sorted(range(len(places(threshold))), key=lambda k: k not in own)])
    # both sides read all signatures, so that they are one exchange and computed once
    entries = different.select(F.col("a").alias("a2"), F.col("sketch").alias("sketch2"), F.explode(F.slice(every, 1, len(own))).alias("signature"))
    asks = different.select("a", "sketch", F.explode(every).alias("signature"))
    near = sketches_near(F.col("sketch"), F.col("sketch2"), threshold)
    # either of two lines of one length finds the other: one direction is enough
    length = lambda c: F.col(c).bitwiseAND((1 << LENGTH_BITS) - 1)
    once = (length("sketch") != length("sketch2")) | (F.col("a") > F.col("a2"))
    return asks.join(entries, "signature").filter(near & once).select("a", "a2").distinct()


def meetings(different: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """:func:`candidates` once a pair, as a table."""
    return cut(candidates(different, threshold).select(F.greatest("a", "a2").alias("a"), F.least("a", "a2").alias("a2")).distinct(), "candidates")


def members(pairs: DataFrame) -> DataFrame:
    """``a`` of the lines that have a candidate."""
    return cut(pairs.select("a").unionByName(pairs.select(F.col("a2").alias("a"))).distinct(), "wanted")


def confirmed(pairs: DataFrame, met: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``a, b, a2, b2`` of the ``pairs`` within ``threshold`` edits; ``met`` has ``a, b, line`` of their members, any number of times."""
    texts = cut(met.groupBy("a", "b").agg(F.first("line").alias("line")), "texts")
    both = pairs.join(texts, "a").join(texts.toDF("a2", "b2", "line2"), "a2")
    longer = F.length("line") >= F.length("line2")
    ordered = both.select("a", "b", "a2", "b2", F.when(longer, F.col("line")).otherwise(F.col("line2")).alias("x"), F.when(longer, F.col("line2")).otherwise(F.col("line")).alias("y"))
    return ordered.filter(within_distance(F.col("x"), F.col("y"), threshold)).select("a", "b", "a2", "b2")


def line_links(every: DataFrame, different: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``a, b, a2, b2``: keys of different lines within ``threshold`` edits, once a pair."""
    pairs = meetings(different, threshold)
    return confirmed(pairs, every.select("a", "b", "line").join(members(pairs), "a", "left_semi"), threshold)


def word_edits(n: Column, words_each: int) -> Column:
    """Edited words that make no difference, for a pair whose longer line has ``n`` words."""
    return F.ceil(n / words_each).cast("int")


def word_lines(every: DataFrame, words_each: int) -> DataFrame:
    """``a, b, first, sketch, signatures`` of each different line of at least ``MIN_WORDS`` words.

    An edited word changes two word pairs at most.  Of two lines within ``k`` of them, each
    has at most 2 ``k`` different pairs that the other one lacks, so the first 2 ``k`` + 1
    of both, in any common order, meet.  The order is longest first, as long pairs are rare.
    """
    split = every.select("a", "b", place().alias("first"), words(F.col("line")).alias("ws")).withColumn("n", F.size("ws")).filter(F.col("n") >= MIN_WORDS)

    def pair(x: Column, y: Column) -> Column:
        size = F.least(F.octet_length(x) + F.octet_length(y), F.lit(127))
        return F.call_function("shiftleft", (127 - size).cast("long"), F.lit(56)).bitwiseOR(F.shiftrightunsigned(F.xxhash64(x, y), 8))

    pairs = F.zip_with(F.slice("ws", F.lit(1), F.col("n") - 1), F.slice("ws", F.lit(2), F.col("n") - 1), pair)
    # the longer partner's edits are no more than these
    most = 2 * (F.floor(F.col("n") / (words_each - 1)).cast("int") + 1) + 1
    parities = F.aggregate("ws", F.lit(0).cast("long"), lambda s, w: s.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(w), F.lit(_PARITIES)))))
    n = F.shiftleft(F.least(F.col("n"), F.lit(_MOST_WORDS)).cast("long"), _PARITIES)
    told = split.select("a", "b", "first", parities.bitwiseOR(n).alias("sketch"), F.slice(F.sort_array(F.array_distinct(pairs)), F.lit(1), most).alias("signatures"))
    return told.groupBy("a", "b").agg(F.min("first").alias("first"), F.first("sketch").alias("sketch"), F.first("signatures").alias("signatures"))


def word_sketches_near(x: Column, y: Column, words_each: int) -> Column:
    """Whether numbers and parities of words differ by no more than the edits can change: a necessary condition."""
    size = lambda c: F.shiftrightunsigned(c, _PARITIES).bitwiseAND(_MOST_WORDS).cast("int")
    longer = F.greatest(size(x), size(y))
    edits = word_edits(longer, words_each)
    flips = F.bit_count(x.bitwiseXOR(y).bitwiseAND((1 << _PARITIES) - 1))
    return (longer == _MOST_WORDS) | ((F.abs(size(x) - size(y)) <= edits) & (flips <= 2 * edits))


def words_within(x: Column, y: Column, words_each: int) -> Column:
    """Whether two lines, as arrays of words, are within their edits; each different word is one character."""
    def told(all_: Column) -> Column:
        def spelt(some: Column) -> Column:
            codes = F.transform(some, lambda w: F.lpad(F.hex(F.array_position(all_, w) + 0xFFFF), 8, "0"))
            return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")
        return F.call_function("levenshtein", spelt(x), spelt(y), word_edits(F.greatest(F.size(x), F.size(y)), words_each)) >= 0

    return _bind(F.array_distinct(F.concat(x, y)), told)


def _confirmed(every: DataFrame, met: DataFrame, known: DataFrame, words_each: int) -> DataFrame:
    """``a, b`` of the lines of ``met`` (``a, a2``) that come after their partner and are near it."""
    firsts = known.select("a", "b", "first")
    pairs = met.distinct().join(firsts, "a").join(firsts.toDF("a2", "b2", "first2"), "a2").filter("first2 < first")
    pairs = cut(pairs.select("a", "b", "a2", "b2"), "word_pairs")
    wanted = cut(pairs.select("a").unionByName(pairs.select(F.col("a2").alias("a"))).distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    texts = every.select("a", "b", "line").join(wanted, "a", "left_semi").groupBy("a", "b").agg(F.first("line").alias("line"))
    texts = cut(texts.select("a", "b", words(F.col("line")).alias("ws")), "texts")
    both = pairs.join(texts, ["a", "b"]).join(texts.toDF("a2", "b2", "ws2"), ["a2", "b2"])
    return both.filter(words_within(F.col("ws"), F.col("ws2"), words_each)).select("a", "b").distinct()


def repeated_by_words(every: DataFrame, words_each: int) -> DataFrame:
    """``a, b`` of the lines that have an earlier one within their edited words.

    Each line first meets the earliest one at its first two word pairs.  That settles
    nearly all of a large group of near copies; only lines that are not settled ask on, at
    all their pairs, so a group's pairs are not all made.
    """
    known = cut(word_lines(every, words_each), "word_lines")
    two = known.select("a", "first", "sketch", F.explode(F.slice("signatures", 1, 2)).alias("signature"))
    heads = two.groupBy("signature").agg(F.min(F.struct("first", "a", "sketch")).alias("head"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    near = word_sketches_near(F.col("sketch"), F.col("head.sketch"), words_each)
    met = two.join(heads, "signature").filter((F.col("a") != F.col("head.a")) & near).select("a", F.col("head.a").alias("a2"))
    settled = cut(_confirmed(every, met, known, words_each), "settled")
    marks = settled.withColumn("settled", F.lit(True))
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_KEYS else marks
    # the mark is the sketch's sign, so that both sides are one exchange
    sketch_ = F.when(F.col("settled"), F.col("sketch").bitwiseOR(-(1 << 63))).otherwise(F.col("sketch"))
    entries = known.join(marks, ["a", "b"], "left").select("a", sketch_.alias("sketch"), F.explode("signatures").alias("signature"))
    near = word_sketches_near(F.col("sketch"), F.col("sketch2"), words_each)
    met = entries.join(entries.toDF("a2", "sketch2", "signature"), "signature").filter((F.col("sketch") >= 0) & (F.col("a") != F.col("a2")) & near).select("a", "a2")
    return settled.unionByName(cut(_confirmed(every, met, known, words_each), "settled"))


def verdicts(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, words_each: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, version, pos, a, b`` of lines that repeat or have a candidate, ``a, b, first, links, near`` of those that repeat or have a link)."""
    every = lines(docs)
    pairs = meetings(distinct_lines(every, threshold, min_chars), threshold)
    times = every.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
    worded = F.lit(False)
    if words_each:
        times = times.join(repeated_by_words(every, words_each).withColumn("worded", F.lit(True)), ["a", "b"], "left")
        worded = F.coalesce("worded", F.lit(False))
    wanted = members(pairs)
    wanted = (F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted).withColumn("wanted", F.lit(True))
    asked = times.withColumn("worded", worded).join(wanted, "a", "left")
    asked = cut(asked.filter("times > 1 OR wanted OR worded").select("a", "b", "worded", (F.col("times") > 1).alias("repeated"), F.coalesce("wanted", F.lit(False)).alias("wanted")), "asked")
    # places of these lines alone are kept, texts of those with a candidate; documents stay where they are while the lines are few
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS else asked
    line = F.when(F.col("wanted"), F.col("line")).alias("line")
    met = cut(every.join(asked, ["a", "b"]).select("doc_id", "version", "pos", "a", "b", "worded", "repeated", "wanted", line), "places")
    links = cut(confirmed(pairs, met.filter("wanted"), threshold), "line_links")
    ends = links.unionByName(links.select(F.col("a2").alias("a"), F.col("b2").alias("b"), F.col("a").alias("a2"), F.col("b").alias("b2")))
    linked = ends.select("a", "b").distinct().withColumn("linked", F.lit(True))
    told = met.groupBy("a", "b", "worded", "repeated").agg(F.min(place()).alias("first")).join(linked, ["a", "b"], "left")
    told = cut(told.filter("repeated OR linked OR worded"), "first_places")
    firsts = told.filter("linked").select("a", "b", "first")
    later = ends.join(firsts, ["a", "b"]).join(firsts.toDF("a2", "b2", "first2"), ["a2", "b2"]).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("links"), F.max(F.col("first2") < F.col("first")).alias("near"))
    told = told.join(later, ["a", "b"], "left")
    told = told.select("a", "b", "first", F.coalesce("links", F.lit(0)).alias("links"), (F.coalesce("near", F.lit(False)) | F.col("worded")).alias("near"))
    return met.select("doc_id", "version", "pos", "a", "b"), told


def removals(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, words_each: int | None = None) -> DataFrame:
    """``doc_id, version, removed`` (positions), ``n_exact, n_near, n_links`` of documents with a line to remove or a link."""
    found, told = verdicts(docs, threshold, min_chars, words_each)
    met = found.join(told, ["a", "b"])
    exact = ~place().eqNullSafe(F.col("first"))
    marked = met.select("doc_id", "version", "pos", exact.alias("exact"), (~exact & F.col("near")).alias("near"), "links")
    gone = F.when(F.col("exact") | F.col("near"), F.col("pos"))
    # rows that repeat a document are one here
    return marked.distinct().groupBy("doc_id", "version").agg(
        F.sort_array(F.collect_list(gone)).alias("removed"), F.sum(F.col("exact").cast("long")).alias("n_exact"),
        F.sum(F.col("near").cast("long")).alias("n_near"), F.sum("links").alias("n_links"))


def _with_removals(docs: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(F.col("doc_id").alias("_doc_id"), F.col("version").alias("_version"), "removed", "n_exact", "n_near", "n_links")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("version") == F.col("_version"))
    return docs.join(found, same, "left").drop("_doc_id", "_version")


def line_report(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_exact, n_near, n_links`` and ``removed``, the positions joined by commas."""
    sizes = docs.select("doc_id", F.xxhash64("text").alias("version"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    told = _with_removals(sizes, removals(docs.select("doc_id", "text"), threshold, min_chars))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    removed = F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit(""))
    return told.select("doc_id", "n_lines", zero("n_exact"), zero("n_near"), zero("n_links"), removed.alias("removed"))


def without_repeated_lines(
    docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, words_each: int | None = None, min_left: float = 0.0,
) -> DataFrame:
    """``docs``, same columns, without the lines that go.  A document of which no word is left goes too.

    So does one that has lost lines and keeps less than ``min_left`` of its words: what repeats
    earlier documents for the most part is a near copy, and a stub of it is of no use.
    """
    texts = docs.select("doc_id", "text")
    # the row is carried as one value: none of its columns can meet a name used here
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("version"))
    told = _with_removals(keyed, removals(texts, threshold, min_chars, words_each))
    text = F.col("row.text")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(F.col("removed"), i)), "\n")
    lost = F.size(F.coalesce("removed", F.array().cast("array<int>"))) > 0
    new = told.select("row", lost.alias("lost"), F.when(lost, left).otherwise(text).alias("text"))
    of = lambda some: F.size(words(some))
    enough = (F.btrim("text", F.lit(BLANKS + "\n")) != "") & (of(F.col("text")) >= min_left * of(F.col("row.text")))
    kept = new.filter(~F.col("lost") | enough)
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
