"""Operators 3, 4, 7 and 10."""

import base64
import hashlib
import json
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import line_dedup, line_frequency, queries, rule_ensemble, secret_scan
from tests.llm.helpers import EDGE_TEXTS, frame, saved

# -- line dedup ---------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, times):
    chars = list(line)
    for _ in range(times):
        at = rng.randrange(len(chars)) if chars else 0
        kind = rng.randrange(3) if chars else 1
        if kind == 0:
            chars[at] = rng.choice("abcdé😀 xyz")
        elif kind == 1:
            chars.insert(at, rng.choice("abcdé😀 xyz"))
        else:
            del chars[at]
    return "".join(chars)


def plain_line_report(texts, threshold=2, least=24):
    """The contract of the operator, pair by pair."""
    seen = {}
    for i, text in enumerate(texts):
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\x0b\x0c\r"):
                seen.setdefault(line.strip(" \t\x0b\x0c\r"), (i, pos))
    links = {a: [b for b in seen if a != b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold] for a in seen}
    rows = []
    for i, text in enumerate(texts):
        own = [(pos, line) for pos, line in enumerate(x.strip(" \t\x0b\x0c\r") for x in (text or "").split("\n")) if line]
        exact = [pos for pos, line in own if seen[line] != (i, pos)]
        near = [pos for pos, line in own if seen[line] == (i, pos) and any(seen[o] < seen[line] for o in links[line])]
        rows.append((i, len((text or "").split("\n")), len(exact), len(near), sum(len(links[line]) for _, line in own), ",".join(map(str, sorted(exact + near)))))
    return rows


def line_texts():
    rng = random.Random(5)
    lines = ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randrange(20, 90))).strip() or "x" for _ in range(40)]
    many = [edited(rng, rng.choice(lines), rng.choice([0, 0, 1, 2, 3, 4])) for _ in range(160)]
    return [*EDGE_TEXTS, *("\n".join(many[i : i + 5]) for i in range(0, len(many), 5)), "short a\nshort b", "  padded line that is long enough here  \npadded line that is long enough here"]


def test_line_report_equals_all_pairs(spark):
    texts = line_texts()
    got = sorted(tuple(r) for r in line_dedup.line_report(frame(spark, texts)).collect())
    assert got == plain_line_report(texts)


def test_banded_distance_equals_the_matrix(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abc é") for _ in range(rng.randrange(0, 30)))
        b = edited(rng, a, rng.randrange(0, 5)) if a else "ab"[: rng.randrange(3)]
        pairs.append(tuple(sorted((a, b), key=len, reverse=True)))
    for threshold in (1, 2, 3):
        df = spark.createDataFrame(pairs, "a string, b string").withColumn("near", line_dedup.within_distance(F.col("a"), F.col("b"), threshold))
        wrong = [r for r in df.collect() if r["near"] != (distance(r["a"], r["b"]) <= threshold)]
        assert not wrong


def test_documents_without_repeated_lines(spark):
    first, near = "A line that is long enough to be compared.", "A line that is long enough to be compared!"
    docs = frame(spark, [f"{first}\nown words", first, near, "", None, "other\n\nother"]).withColumn("version", F.lit(1))
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {0: f"{first}\nown words", 3: "", 4: None, 5: "other\n"}


def test_line_join_is_native_and_pairs_of_a_hot_segment_stay_inside_it(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("etaoin shrdlu") for _ in range(120))
    variants = {base[:a] + "".join(rng.choice("zqxjk") for _ in range(9)) + base[a + 9 :] for a in [rng.randrange(100) for _ in range(300)]}
    docs = frame(spark, sorted(variants))
    every = line_dedup.lines(docs)
    different = line_dedup.distinct_lines(every)
    met, links = line_dedup.candidates(different), line_dedup.line_links(every, different)
    for df in (met, links):
        assert not re.search("Python|Pandas|ArrowEval|Cartesian|BroadcastNestedLoop", df._jdf.queryExecution().toString())
    assert met.count() < len(variants) ** 2 / 5
    assert links.count() < len(variants)


def test_lines_that_differ_in_a_number_are_told_apart_before_they_are_compared(spark):
    rng = random.Random(1)
    df = frame(spark, [f"The order with the number {rng.randrange(10**8):08d} has been shipped to you" for _ in range(300)])
    assert line_dedup.candidates(line_dedup.distinct_lines(line_dedup.lines(df))).count() < 0.15 * 300 * 299 / 2


def test_signatures_and_sketch_are_methods_that_the_virtual_machine_compiles(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        different = line_dedup.distinct_lines(line_dedup.lines(frame(spark, ["a line that is long enough to be compared"])))
        code = spark._jvm.PythonSQLUtils.explainString(different._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # HotSpot interprets methods above 8,000 bytes of bytecode
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_only_places_of_lines_that_repeat_or_have_a_link_are_kept(spark):
    near, other = "a line that is long enough to be near", "a line that is long enough to be neat"
    docs = frame(spark, [f"own words here\n{near}\nshort", f"words of another\nshort\n{other}", "nothing that repeats anywhere"])
    found, told = line_dedup.verdicts(docs)
    assert sorted((r["doc_id"], r["pos"]) for r in found.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert sorted((r["first"]["doc_id"], r["first"]["pos"], r["links"], r["near"]) for r in told.collect()) == [(0, 1, 1, False), (0, 2, 0, False), (1, 2, 1, True)]


def test_lines_with_replaced_words_go(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10)))
    lines = [[word() for _ in range(n)] for n in (10, 15, 21, 40, 41, 60, 150, 400)] + [["ab", "cd"] * 15]
    for line in list(lines):
        for edits in (1, 2, 3, 5, 8, 20, 25):
            new = list(line)
            for _ in range(edits):
                kind, at = rng.randrange(3), rng.randrange(len(new) - 1)
                new[at : at + (kind > 0)] = [word() + "x"] * (kind < 2)
            lines.append(new)
    rng.shuffle(lines)
    texts = [" ".join(x) for x in lines]
    left = line_dedup.without_repeated_lines(frame(spark, texts), words_each=20)
    earlier = lambda i: any(
        min(len(lines[i]), len(lines[j])) >= 10 and abs(len(lines[i]) - len(lines[j])) <= (k := -(-max(len(lines[i]), len(lines[j])) // 20))
        and distance(lines[i], lines[j]) <= k or distance(texts[i][:300], texts[j][:300]) <= 2 and distance(texts[i], texts[j]) <= 2 for j in range(i) if abs(len(texts[i]) - len(texts[j])) < 300)
    want = [i for i in range(len(texts)) if not earlier(i)]
    assert sorted(r["doc_id"] for r in left.collect()) == want and len(want) < len(texts) - 20


# -- quality rules --------------------------------------------------------------------------


def base_counts(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_base_counts_on_edges(spark):
    rng = random.Random(2)
    texts = [*EDGE_TEXTS, "a b c d e f g h " * 3, "a b c d e f g h", "a b c d e f g h a b c d e f g", *(" ".join(rng.choice("ab") for _ in range(60)) for _ in range(20)), "w " * 5000]
    got = {r["doc_id"]: tuple(r)[1:] for r in line_frequency.base_rules(frame(spark, texts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    for i, text in enumerate(texts):
        want = base_counts(text)
        assert got[i] == (*want, want[0] < 20 or 100 * want[4] > 30 * want[0])


def plain_normalised(line):
    return line.strip(" \t\x0b\x0c\r").lower().translate(str.maketrans("123456789", "000000000"))


def plain_frequent_lines(rows, limit=10):
    """(host, line) of the lines above the limit; ``rows`` are (text, host)."""
    seen = {}
    for text, host in rows:
        lines = {x for x in map(plain_normalised, (text or "").split("\n")) if x}
        longest = sorted(lines, key=lambda x: (-len(x), x.encode()))
        for line in lines:
            others = tuple(x for x in longest if x != line)[:2]
            texts, different = seen.setdefault((host, line), (set(), set()))
            texts.add(text)
            different.add(others)
    return {key for key, (texts, different) in seen.items() if len(different) > limit and 4 * len(different) > 3 * len(texts)}


def test_frequent_lines_equal_plain_counts(spark):
    rng = random.Random(8)
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    menus = ["Menu A 1", "About us\t", "\x0bimprint and rights of the host 2020\r", "x"]
    texts = ["\n".join(rng.sample([*rng.sample(menus, 2), own(5), own(8), own(3)], 5)) for _ in range(120)]
    base = [own(9) for _ in range(6)]
    near = ["\n".join([*base[:5], own(9)]) for _ in range(60)]
    rows = [(t, rng.choice(["hot", "hot", "b", None])) for t in texts] + [(t, "hot") for t in near] + [(texts[0], "hot")] * 40 + [(t, "hot") for t in EDGE_TEXTS]
    docs = spark.createDataFrame(rows, "text string, source string")
    got = {(r["host"], h) for r in line_frequency.frequent_lines(docs).collect() for h in r["hs"]}
    want = plain_frequent_lines(rows)
    hashed = {(r["host"], r["h"]) for r in spark.createDataFrame(list(want), "host string, line string").select("host", F.xxhash64("line").alias("h")).collect()}
    assert got == hashed and {"menu a 0", "about us", "x"} <= {line for _, line in want}
    # a group of near copies keeps its lines
    assert not {plain_normalised(x) for x in base} & {line for _, line in want}


def test_documents_of_common_lines_only_are_rejected_and_copies_kept(spark):
    rng = random.Random(4)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(25))
    common = "this menu line stands on very many pages of the host and has quite a few words in it to count as such"
    clean = [f"{common}\n{own()}" for _ in range(30)]
    copies = [own()] * 200
    texts = [*clean, *(f"{common} \n{common.upper()}\nlast {i}" for i in range(5)), *copies]
    judged = line_frequency.judge(frame(spark, texts, [None] * len(texts)))
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert all(kept[i] for i in range(30)) and not any(kept[i] for i in range(30, 35)) and all(kept[i] for i in range(35, 235))


def test_frequent_lines_are_taken_out_of_the_texts_that_stay(spark):
    rng = random.Random(6)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(25))
    common, owns = "Menu of host number 1", [own() for _ in range(30)]
    texts = [f"{common}\n{x}\n\n {common.upper().replace('1', '7')} " for x in owns]
    docs = frame(spark, [*texts, common, *texts[:2], None], ["a"] * 31 + ["b", None, "a"]).withColumn("kept", F.lit("x"))
    left = line_frequency.without_frequent_lines(docs)
    assert left.columns == docs.columns
    # another host, and none, have no frequent line
    want = {i: f"{x}\n" for i, x in enumerate(owns)} | {31: texts[0], 32: texts[1]}
    assert {r["doc_id"]: r["text"] for r in left.collect()} == want


# -- secrets --------------------------------------------------------------------------------


def der(tag, data):
    size = len(data)
    head = bytes([size]) if size < 128 else bytes([0x80 | (n := (size.bit_length() + 7) // 8)]) + size.to_bytes(n, "big")
    return bytes([tag]) + head + data


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([k + 1]) * 64) for k in range(8)))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48") + der(5, b"")) + der(4, KEY))
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"\1" * 80


def b64(data):
    return base64.b64encode(data).decode()


def signed(header, claims=None):
    return ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in (header, claims or {"sub": "1"})) + ".c2lnbmF0dXJl"


@pytest.mark.parametrize(("text", "kinds"), [
    (f"-----BEGIN RSA PRIVATE KEY-----\n{b64(KEY)}\n-----END RSA PRIVATE KEY-----", ["pem"]),
    (f"x {b64(PKCS8)} y", ["der"]), (f"x {PKCS8.hex().upper()} y", ["der", "hex"]), (b64(SSH), ["openssh"]), (signed({"alg": "HS256"}), ["token"]),
    (b64(KEY[:-3]), []), (b64(bytes(range(200))), []), (signed({"typ": "x"}), []), ("-----BEGIN PRIVATE KEY-----\nabcd\n-----END PRIVATE KEY-----", []),
    (KEY.hex(), ["hex", "der"]), ("no secret: here", []),
])
def test_structure_confirms_candidates(text, kinds):
    assert [kind for kind, _, _ in secret_scan.scan(text)] == kinds


def wrapped(text, width):
    return "\n".join(text[i : i + width] for i in range(0, len(text), width))


PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{wrapped(b64(KEY), 64)}\n-----END RSA PRIVATE KEY-----"
SPACED = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{ "alg": "HS256"}', b'\n{"sub": "1"}', b"signature"))
SSH_KEY = SSH[:-80] + b"".join(len(x).to_bytes(4, "big") + x for x in (b"public" * 9, b"private" * 50))
HEADED = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n%s\n-----END RSA PRIVATE KEY-----"


@pytest.mark.parametrize("around", ["%s", "the key:\n%s\nand so on", "x %s"])
@pytest.mark.parametrize(("text", "kind"), [
    (wrapped(b64(KEY), 64), "der"), (wrapped(b64(PKCS8), 76), "der"), (wrapped(KEY.hex().upper(), 64), "der"), (wrapped(b64(SSH_KEY), 70), "openssh"),
    (wrapped(b64(KEY), 76).replace("\n", "\r\n  "), "der"), (b64(PEM.encode()), "pem"), (wrapped(b64(PEM.encode()), 76), "pem"),
    (PEM, "pem"), (HEADED % wrapped(b64(bytes(range(64)) * 2), 64), "pem"), (PEM.replace("-----\n", "-----\nComment: a, b\n\n", 1), "pem"), (SPACED, "token"),
])
def test_keys_over_several_lines_and_within_encodings(around, text, kind):
    whole = around % text
    at = around.index("%s")
    assert secret_scan.confirmed_spans(whole) == [(kind, at, at + len(text))]
    # digits alone are a base span at the same place
    assert secret_scan.masked(whole) in (around % f"[{kind}]", around % "[hex]")


@pytest.mark.parametrize("text", [wrapped(b64(KEY[:-3]), 64), wrapped(b64(bytes(range(250))), 64), HEADED % b64(bytes(13)), b64(b"-----BEGIN PRIVATE KEY-----\nabcd\n-----END PRIVATE KEY-----"), "Ievidently.something.else"])
def test_lines_that_are_no_keys(text):
    assert secret_scan.confirmed_spans(text) == []


@pytest.mark.parametrize("head", [b"openssh-key-v1\0" + b"\0" * 33, b"-----BEGIN RSA PRIVATE KEY-----" + b"x" * 16, KEY[:48]])
def test_many_lines_that_begin_like_a_key_take_time_by_their_length(head):
    line = b64(head) + "\n"
    begun = time.process_time()
    assert secret_scan.confirmed_spans(line * (500_000 // len(line))) == []
    assert time.process_time() - begun < 8


def test_a_key_in_digits_is_found_before_lines_of_other_digits():
    text = wrapped(SSH_KEY.hex(), 60) + "\n" + wrapped(b64(bytes(range(250))), 60)
    assert ("openssh", 0, len(wrapped(SSH_KEY.hex(), 60))) in secret_scan.confirmed_spans(text)


def test_base_spans_and_masking():
    text = 'é PassWord = "hunter22" token:abc api_key=ABCDEF AKIA' + "Z" * 16 + " " + "0af" * 8 + " ſecret=abcdefgh"
    want = [("assign", m.start(), m.end()) for m in re.finditer(
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found = secret_scan.scan(text)
    assert [s for s in found if s[0] == "assign"] == want and {k for k, _, _ in found} == {"assign", "access", "hex"}
    masked = secret_scan.masked(text)
    assert masked.startswith('é PassWord = "[assign]" token:abc api_key=[assign] [access] [hex]') and not secret_scan.scan(masked)


def test_scan_of_a_table(spark, scratch):
    texts = [*EDGE_TEXTS, "secret=abcdef " * 3, f"password: {'a1' * 16} {signed({'alg': 'none'})}"]
    got = {r["doc_id"]: r for r in queries.op7_secret_scan(spark, saved(spark, scratch, documents=frame(spark, texts))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = secret_scan.ordered(secret_scan.base_spans(text or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert got[len(EDGE_TEXTS)]["n_assign"] == 3 and "token:" in got[len(texts) - 1]["spans"]


# -- quality classifier -----------------------------------------------------------------------


def quality_tables(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8)))
    texts, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        own = [word() for _ in range(rng.randrange(20, 90))]
        texts.append(" ".join(own) if good else " ".join(w + "$$$" for w in own) if i % 2 else " ".join(w for w in own for _ in range(8)))
        labels.append((i, int(good), 0))
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_is_right_on_held_out_rows(spark):
    docs, labels = quality_tables(spark)
    scored = rule_ensemble.quality_scores(docs, labels).join(labels, "doc_id")
    rows = scored.filter("held_out").collect()
    assert len(rows) > 80 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scores_need_no_labels_and_take_any_text(spark):
    docs = frame(spark, EDGE_TEXTS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in rule_ensemble.quality_scores(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    assert {r["predicted"] for r in rule_ensemble.quality_scores(docs, one).collect()} == {1}


def test_held_out_labels_do_not_change_scores(spark):
    docs, labels = quality_tables(spark)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in rule_ensemble.quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("query", ["op3_line_dedup", "op4_line_frequency", "op7_secret_scan", "op10_rule_ensemble"])
def test_empty_table_gives_no_rows(spark, scratch, query):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert queries.QUERIES[query](spark, saved(spark, scratch, documents=frame(spark, []), labels=labels)).count() == 0
