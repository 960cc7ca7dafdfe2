"""Operator 4: quality rules, with a rule on lines that many documents of a host share.

Base counts are array expressions over the whole text; no rows are exploded for them.
For the cross-document rule each document gives its distinct normalised lines as hashes;
lines are counted per host by different documents, folded before the shuffle, so a host with a
third of all documents and a line they all share are one row per task.

A line is above the limit if more than ``MAX_DOCUMENTS`` documents of a host have it that differ
otherwise: whatever the size of the host.  Documents differ otherwise if the two longest of their
other lines do (ties: the earlier UTF-8), and so must three quarters of the line's documents: copies
count once, and near copies of four lines or more, one of them changed, share most long lines.  Both
are left to deduplication.

A document that keeps less than ``MIN_LEFT`` of its words without the lines above the limit is
depleted and rejected; ``without_frequent_lines`` gives the texts of the others without them.

NULL and empty texts have no words and fail the base rules.  A NULL host is a host of its
own.  Repeated rows give repeated results; an empty table gives no rows.  Very long texts are
arrays of words and lines of one row, with some 16 bytes a line in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, words

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: A line is above the limit in more documents of a host than this.
MAX_DOCUMENTS = 10
#: A document must keep this share of its words.
MIN_LEFT = 0.3
#: Most hosts and lines that are broadcast; with more of them the tables are joined by shuffle.
BROADCAST_HOSTS, BROADCAST_LINES = 20_000, 1_000_000
SYMBOLS = "#*$%&|<>"
#: White space at the ends of a line.
BLANKS = " \t\x0b\x0c\r"


def normalised(line: Column) -> Column:
    """A line as it is counted: lower case, digits alike, white space at the ends dropped."""
    return F.translate(F.lower(F.btrim(line, F.lit(BLANKS))), "123456789", "000000000")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.trim(F.translate(line, "\t\x0b\x0c\r", "    "))) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def n_repeat_words(found: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more.

    Windows are told apart by 64-bit hashes of their words' hashes.  Sorted by hash, equal
    windows stand together; positions of those with an equal neighbour, in order, cover
    the words, each ``WINDOW`` long or up to the next position.
    """
    last = F.size(found) - WINDOW

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def repeated(order: Column) -> Column:
        same = lambda x, i, k: F.get(order, i + k)["h"].eqNullSafe(x["h"])
        return F.sort_array(F.transform(F.filter(order, lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("p")), lambda s, p: F.struct(
            (s["n"] + F.least(p - s["p"], F.lit(WINDOW))).alias("n"), p.alias("p")), lambda s: s["n"])

    def some(windows: Column) -> Column:
        order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(_let(order, repeated), covered))

    return F.when(last < 1, F.lit(0)).otherwise(_let(_let(F.transform(found, lambda w: F.xxhash64(w)), windows), some))


def _let(value: Column, use) -> Column:
    """``use(value)``, computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and ``base_failed`` to every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # the word array is built once, in a projection of its own
    split = docs.withColumn("_words", words(F.col(text)))
    counted = split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": n_dup_lines(whole).cast("long"),
        "n_repeat_words": n_repeat_words(F.col("_words")).cast("long"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop("_words")


def _lines(text: Column) -> Column:
    """Distinct normalised lines with a word: ``h`` (hash) and ``c`` (hash of the two longest other lines)."""
    nonblank = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), normalised), lambda line: line != "")
    ordered = F.sort_array(F.transform(F.array_distinct(nonblank), lambda line: F.struct((-F.length(line)).alias("n"), line.alias("line"))))

    def told(lines: Column) -> Column:
        longest = F.slice(lines, 1, 3)

        def companions(line: Column) -> Column:
            others = F.filter(longest, lambda x: x["line"] != line)
            return F.xxhash64(F.get(others, F.lit(0))["line"], F.get(others, F.lit(1))["line"])

        return F.transform(lines, lambda x: F.struct(F.xxhash64(x["line"]).alias("h"), companions(x["line"]).alias("c")))

    return _let(ordered, told)


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``host, hs``: hashes of the lines above the limit of their host; hosts without any are left out."""
    seen = docs.select(F.col(host).alias("host"), F.xxhash64(text).alias("copy"), _lines(F.col(text)).alias("lines"))
    single = seen.groupBy("host", "copy").agg(F.first("lines").alias("lines"))
    counted = single.select("host", F.inline("lines")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("different"))
    often = counted.filter((F.col("different") > MAX_DOCUMENTS) & (4 * F.col("different") > 3 * F.col("n")))
    return often.groupBy("host").agg(F.collect_list("h").alias("hs"))


def judge(docs: DataFrame, host: str = "source", text: str = "text", clean: bool = False) -> DataFrame:
    """All columns of ``docs``, the base counts, ``base_failed``, ``left_share`` and ``kept``.

    With ``clean``, also ``clean_text``: the text without the lines above the limit.
    """
    lines = cut(frequent_lines(docs, host, text), "frequent_lines").toDF("_host", "_above")
    # documents stay where they are while such lines are few
    hosts, total = lines.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_above")), F.lit(0))).first()
    lines = F.broadcast(lines) if hosts <= BROADCAST_HOSTS and total <= BROADCAST_LINES else lines
    judged = base_rules(docs, text).join(lines, F.col(host).eqNullSafe(F.col("_host")), "left")
    above = lambda line: F.array_contains(F.col("_above"), F.xxhash64(normalised(line)))
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    # a line's words are the text's words in it
    lost = F.aggregate(F.filter(split, above), F.lit(0), lambda s, line: s + F.size(words(line)))
    left = F.coalesce(F.try_divide(F.col("n_words") - lost, F.col("n_words")), F.lit(1.0))
    judged = judged.withColumn("left_share", F.when(F.col("_above").isNull(), F.lit(1.0)).otherwise(left))
    if clean:
        kept = F.array_join(F.filter(split, lambda line: ~above(line)), "\n")
        judged = judged.withColumn("clean_text", F.when(F.col("_above").isNull() | F.col(text).isNull(), F.col(text)).otherwise(kept))
    judged = judged.drop("_host", "_above")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("left_share") >= MIN_LEFT))


def without_frequent_lines(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs``, same columns, without the lines above the limit of their host and without rejected documents."""
    carried = docs.select(F.struct(*docs.columns).alias("row"))
    kept = judge(carried, f"row.`{host}`", f"row.`{text}`", clean=True).filter("kept")
    return kept.select(*[F.col("clean_text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
