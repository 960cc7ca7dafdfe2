"""Operators 11, 12 and 13."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import divergence_audit, importance_resampling, licence_scan, queries
from tests.llm.helpers import DOCS, EDGE_TEXTS, frame, saved

LOWER = {i: i + 32 for i in range(65, 91)}


# -- divergence audit -----------------------------------------------------------------------


def plain_audit(rows, least, k):
    """The contract, term by term and pair by pair."""
    groups, within, langs = {}, {}, {}
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups.setdefault((lang or "", source or ""), Counter()).update(terms)
        within.setdefault(lang or "", Counter()).update(set(terms))
        langs.setdefault(lang or "", Counter()).update(terms)
    out = set()
    for lang, counts in langs.items():
        kept = [t for t in counts if within[lang][t] >= least]

        def shares(of, kept=kept):
            total = sum(of[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 5) // total for t in kept}

        q = shares(counts)
        p = {s: shares(c) for (x, s), c in groups.items() if x == lang}
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            own = [(p[s][t] - q[t], t) for t in kept if groups[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, k)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(ordered[:most], 1)}
    return out


def audit_rows(size=260, sources=9):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß日😀") for _ in range(rng.randrange(1, 4))) for _ in range(120)]
    rows = []
    for _ in range(size):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if rng.random() < 0.34 else f"s{rng.randrange(sources)}"
        rows.append((" ".join(rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(40))), lang, source))
    return [*rows, *rows[:5], *((t, "en", None) for t in EDGE_TEXTS), (None, None, None), ("a", "only", "one"), (None, "none", "x"), ("", "none", "y")]


def test_audit_equals_plain_counts(spark):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "n", "g", "l", "value", "at", "part")})
    got = divergence_audit.audit(docs.repartition(5), least=3, k=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain_audit(rows, 3, 7))


def test_audit_without_terms_or_rows(spark):
    rows = [("", "en", "a"), (None, "en", "b"), ("x", "en", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = {tuple(r) for r in divergence_audit.audit(docs).collect()}
    assert got == plain_audit(rows, 30, 50) and {r[4] for r in got} == {0} and len(got) == 6
    assert divergence_audit.audit(docs.limit(0)).collect() == []


def test_audit_of_bytes_that_are_no_text_and_long_texts(spark):
    docs = spark.sql("select cast(x'61ff6220' as string) as text, 'l' as lang, 's' as source union all select repeat('long Words ', 400000), 'l', 't'")
    got = divergence_audit.audit(docs.union(docs), least=2)
    terms = {(r["source"], r["rank"]): r["item"] for r in got.filter("part = 'term'").withColumn("item", F.hex("item")).collect()}
    assert terms == {("s", 1): "61FF62", ("t", 1): b"long".hex().upper(), ("t", 2): b"words".hex().upper()}


def test_distances_over_many_tiles_and_buckets(spark):
    rows = audit_rows(400, 14)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = divergence_audit.kept_terms(divergence_audit.term_counts(docs), 2)
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    totals = divergence_audit.group_totals(groups, kept)
    got = Counter(tuple(r) for r in divergence_audit.source_distances(kept, totals, tile=4, bucket=10).collect())
    assert got == Counter(r for r in plain_audit(rows, 2, 50) if r[2] == "pair")


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = random.Random(3)
    for n in (0, 1, 50, 900):
        more, less = (np.array([rng.randrange(30) for _ in range(n)], np.int64) for _ in range(2))
        names = np.array([str(i).encode() for i in rng.sample(range(10 * n + 1), n)], object)
        points = list(zip(more.tolist(), less.tolist(), names.tolist(), strict=True))
        over = [sum(a[0] >= b[0] and a[1] <= b[1] and a[2] < b[2] for a in points) for b in points]
        for k in (1, 4):
            assert sorted(divergence_audit.skyband(more, less, names, k).tolist()) == [i for i in range(n) if over[i] < k]


def test_partition_skybands_thin_a_large_group(spark):
    df = spark.range(0, 40_000, 1, 2).select(
        F.lit("l").alias("lang"), F.lit("s").alias("source"), F.encode(F.sha2(F.col("id").cast("string"), 256), "utf-8").alias("term"),
        (F.col("id") * 7919 % 1009).alias("g"), (F.col("id") * 104729 % 1013).alias("l"), F.lit(0).cast("long").alias("value"))
    left = divergence_audit.partition_skybands(df, 3)
    assert left.count() < 4_000
    best = lambda d: d.orderBy(F.desc(F.col("g") - F.col("l")), "term").limit(3).collect()
    assert best(left) == best(df)


def test_shares_are_exact_for_large_counts(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(10**e), 0, rng.randrange(10**6)) for e in range(1, 16) for _ in range(5)]
    rows = [(c, c + rng.randrange(10 ** rng.randrange(1, 15)), v + 1) for c, _, v in rows]
    df = spark.createDataFrame(rows, "c long, n long, v long").withColumn("p", divergence_audit.share(F.col("c"), F.col("n"), F.col("v")))
    assert [r["p"] for r in df.collect()] == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]


def test_audit_ships_counts_and_not_words(spark):
    docs = spark.createDataFrame([("same words in all rows", "en", "hot")] * 3000, "text string, lang string, source string").repartition(4)
    counts = divergence_audit.term_counts(docs)
    assert counts.count() <= 5 * 4 and counts.agg(F.sum("n")).first()[0] == 15_000


# -- importance resampling -------------------------------------------------------------------


def plain_resample(rows, target, percent=10, least=20, n=1, buckets=10_000, seed=2024):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]

    own = [(key, *features(text)) for key, text in rows]
    s, t = Counter(b for _, _, bs in own for b in bs), Counter(b for text in target for b in features(text)[1])
    of_s, of_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (of_s + buckets) / ((s[b] + 1) * (of_t + buckets)))) for b in s}
    out = []
    for key, n_words, bs in own:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(bs), weight, score, None, n_words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return Counter(tuple(r[:5]) for r in out)


def resampling_rows():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcXYZ09é日😀") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", ",", "\n"]) for _ in range(rng.randrange(60)))
    rows = [(i, text()) for i in range(300)]
    rows += rows[:4] + [(7, text()), (None, text()), (None, None), (None, "x " * 30), (400, None), (401, "y" * 5000 + " z"), (402, "a b c " * 4000)]
    return rows + [(500 + i, t) for i, t in enumerate(EDGE_TEXTS)], [text() for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_plain_counts(spark, n):
    rows, target = resampling_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("rank", "part", "place", "copy", "n_words")})
    got = importance_resampling.resample(docs.repartition(3), spark.createDataFrame([(t,) for t in target], "text string"), n=n)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == plain_resample(rows, target, n=n)


def test_resampling_of_empty_tables(spark):
    docs, none = frame(spark, ["some words here", None]), spark.createDataFrame([], "text string")
    got = importance_resampling.resample(docs, none, least=1, percent=100)
    assert Counter(tuple(r) for r in got.collect()) == plain_resample([(0, "some words here"), (1, None)], [], 100, 1)
    assert importance_resampling.resample(docs.limit(0), none).collect() == []


def test_many_copies_of_a_row_are_ranked_in_many_ranges(spark):
    scored = spark.range(0, 20_000, 1, 4).select(F.lit(5).cast("long").alias("doc_id"), F.lit(30).cast("long").alias("n_features"), F.lit(1).cast("long").alias("score"), F.lit(True).alias("eligible"))
    got = importance_resampling.drawn(scored, 50)
    assert sorted(r[0] for r in got.filter("rank is not null").select("rank").collect()) == list(range(1, 10_001))
    assert got.count() == 20_000


def test_checksums_of_all_lengths():
    rng = random.Random(2)
    features = [rng.randbytes(n) for n in [0, *range(1, 40), 255, 256, 257, 511, 512, 513, 1024, 70_000] for _ in range(3)]
    rng.shuffle(features)
    assert importance_resampling.checksums(features).tolist() == [zlib.crc32(f) for f in features]
    assert importance_resampling.checksums([]).tolist() == []


def test_a_long_text_comes_in_slices(monkeypatch):
    monkeypatch.setattr(importance_resampling, "SLICE_WORDS", 10)
    monkeypatch.setattr(importance_resampling, "word_pieces", lambda data, table: (data.translate(table).split()[i : i + 4] for i in range(0, 37, 4)))
    text = " ".join(f"w{i}" for i in range(37)).encode()
    found = [f for *_, features in importance_resampling.feature_slices([text, b"", text], 2) for f in features]
    words = text.split()
    assert Counter(found) == Counter(words * 2 + [b" ".join(words[i : i + 2]) for i in range(36)] * 2)


# -- licence scan -----------------------------------------------------------------------------


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = sorted((i, label) for label, phrase in licence_scan.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None, labels


MIT = next(text for label, text in licence_scan.TEMPLATES if label == "mit" and len(text) > 200)
NOTICES = [
    "Licensed under CC BY-NC 4.0.", "x ALL rights\nreserved, cc by cc-by; General Public License\tv3", "all rights all rights reserved", "cc by", "rights reserved",
    "Released under the\n# MIT License.", "Copyright 2020\n\n" + MIT, "// " + "\n// ".join(MIT.split("\n")) + " All rights reserved", MIT * 40, "all rights reserved " * 500,
    "The permission of the software is the use of the work in the hope.", "This work is licensed under the GNU General Public License, version 2.", "ÄLL rights reserved cc byé",
]


def test_scan_of_base_phrases_equals_plain_search(spark):
    texts = [*EDGE_TEXTS, *NOTICES]
    docs = frame(spark, texts).withColumns({"n_words": F.lit(1), "labels": F.lit("x"), "spans": F.lit("y")})
    got = {r["doc_id"]: r for r in licence_scan.scan_documents(docs.union(docs)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_places(text), text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licence_scan.scan_documents(docs.limit(0)).collect() == []


def test_notices_are_labelled_though_edited(spark):
    rng = random.Random(1)
    words = MIT.split()
    for at in rng.sample(range(5, len(words) - 5), 6):
        words[at] = rng.choice(["changed", "two words"])
    del words[20:23]
    half = " ".join(MIT.split()[:60])
    texts = [*NOTICES, "Intro. " + " ".join(words) + " Outro.", half]
    got = [r for r in sorted(licence_scan.scan_documents(frame(spark, texts)).collect())]
    labels = {texts[r["doc_id"]]: r["labels"] for r in got}
    assert labels[NOTICES[0]] == "cc-by,cc-by-nc" and labels[NOTICES[5]] == "mit" and labels[NOTICES[6]] == "mit"
    assert labels[NOTICES[7]] == "mit,reserved" and labels[NOTICES[8]] == "mit" and labels[NOTICES[10]] == "" and labels[NOTICES[11]] == "gpl,gpl-2.0"
    assert got[8]["spans"].count("mit:") == 40
    edited, part = got[-2], got[-1]
    assert edited["labels"] == "mit" and 0.8 <= edited["score"] < 1 and part["labels"] == "" and 0.2 < part["score"] < 0.5


def test_matching_statistics_equal_all_substrings():
    rng = random.Random(11)
    vocabulary = ["a", "b", "c", "d"]
    for _ in range(60):
        templates = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 12)))) for i in range(rng.randrange(1, 5))]
        scanner = licence_scan.Scanner(templates, [("p", "a b")], least=3)
        words = [rng.choice([*vocabulary, "z"]) for _ in range(60)]
        sequences = [t.split() for _, t in templates]
        stands = lambda part: any(part == s[i : i + len(part)] for s in [*sequences, ["a", "b"]] for i in range(len(s)))  # noqa: E731, B023
        longest = [max((n for n in range(1, i + 2) if stands(words[i + 1 - n : i + 1])), default=0) for i in range(60)]
        want = set()
        for i, n in enumerate(longest):
            if n >= 3 and (i == 59 or longest[i + 1] <= n):
                part = words[i + 1 - n : i + 1]
                want |= {(t, i + 1 - n, at, n) for t, s in enumerate(sequences) for at in range(len(s)) if s[at : at + n] == part}
        places, matches = scanner.read(scanner.numbers(" ".join(words).encode()))
        assert {(m.template, m.start, m.at, m.size) for m in matches} == want and len(matches) == len(want)
        assert [p for p, _ in places] == [i for i in range(59) if words[i : i + 2] == ["a", "b"]]


def test_chains_cover_as_much_as_any_order_of_matches():
    rng = random.Random(13)
    scanner = licence_scan.Scanner([("t", " ".join(f"w{i % 23}" for i in range(40)))], least=2, gap=3)
    words = [f"w{i % 23}" for i in range(40)]
    for _ in range(40):
        text = [w if rng.random() < 0.8 else "new" for w in words if rng.random() < 0.9]
        _, matches = scanner.read(scanner.numbers(" ".join(text).encode()))

        def best(last, rest):
            found = last.size
            for i, m in enumerate(rest):
                over = max(m.start + m.size - last.start, m.at + m.size - last.at, 0)
                apart = max(last.start - m.start - m.size, last.at - m.at - m.size)
                if over < last.size and apart <= 3 and m.start < last.start and m.at < last.at:
                    found = max(found, last.size - over + best(m, rest[:i]))
            return found

        assert [s.covered for s in scanner.chains(matches)] == [best(m, matches[:i]) for i, m in enumerate(matches)]


def test_a_megabyte_of_notice_is_scanned_in_time(spark):
    text = (MIT + " ") * 1000
    got = licence_scan.scan_documents(frame(spark, [text, "the software " * 100_000])).collect()
    assert sorted((r["doc_id"], r["spans"].count(":")) for r in got) == [(0, 2000), (1, 0)]


def test_queries_read_whole_tables(spark, scratch):
    texts = [*EDGE_TEXTS, *NOTICES]
    folder = saved(spark, scratch, documents=frame(spark, texts).withColumn("lang", F.lit("en")), benchmark=spark.createDataFrame([(1, "one two")], "item_id long, text string"))
    assert queries.op13_licence_scan(spark, folder).count() == len(texts)
    assert queries.op12_importance_resampling(spark, folder).count() == len(texts)
    empty = saved(spark, scratch, documents=spark.createDataFrame([], DOCS), benchmark=spark.createDataFrame([], "item_id long, text string"))
    for query in (queries.op11_divergence_audit, queries.op12_importance_resampling, queries.op13_licence_scan):
        assert query(spark, empty).collect() == []
