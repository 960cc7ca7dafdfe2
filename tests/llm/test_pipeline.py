"""The pipeline against a plain version of each stage, and the registered queries against their SQL."""

import random

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkmart.llm import line_dedup, secret_scan, simhash_tiles, tokenizer_memo
from sparkmart.llm.oracle import ORACLES
from sparkmart.llm.queries import QUERIES
from tests.llm.helpers import EDGE_TEXTS, frame, saved
from tests.llm.test_rules import base_counts, plain_frequent_lines, plain_line_report, plain_normalised
from tests.llm.test_search import plain_components

SMALL = "/root/testdata/sf0.001"


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared, passage = line(9), line(60)
    texts = []
    for i in range(40):
        texts.append("\n".join([line(25), shared if i % 3 else line(8), line(12), *([passage] if i % 10 == 0 else [])]))
    texts += [texts[1], texts[2].replace(" ", "  ", 1), texts[3] + "\npassword=abcdef123456", "bad " * 50, line(30) + " token: 0123456789abcdef"]
    texts += [line(400) for _ in range(3)]
    long = texts[-1].split()
    long[5] = "changed"
    # a near copy, most of whose lines stand in the first text
    texts.append("\n".join([*texts[0].split("\n"), line(3)]))
    return [*texts, " ".join(long), *EDGE_TEXTS]


def plain_pipeline(texts):
    """(doc_id, text) before packing."""
    kept = []
    frequent = plain_frequent_lines([(t, "s") for t in texts])
    for i, text in enumerate(texts):
        words, *_, repeated = base_counts(text)
        new = "\n".join(x for x in (text or "").split("\n") if ("s", plain_normalised(x)) not in frequent)
        if words >= 20 and 100 * repeated <= 30 * words and len(new.split()) >= 0.3 * words:
            kept.append((i, new))
    report = plain_line_report([dict(kept).get(i) for i in range(len(texts))])
    left = []
    for i, text in kept:
        gone = {int(p) for p in report[i][5].split(",") if p}
        new = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)
        if not gone or len(new.split()) >= max(0.3 * len(text.split()), 1):
            left.append((i, new))
    root = plain_components([simhash_tiles.fingerprint(t) % (1 << 64) for _, t in left])
    return [(i, secret_scan.masked(t)) for k, (i, t) in enumerate(left) if root[k] == k]


def test_pipeline_equals_the_plain_one(spark, scratch):
    texts = corpus()
    rows = corpus_pipeline.run(spark, saved(spark, scratch, documents=frame(spark, texts))).collect()
    tokenizer = tokenizer_memo.load(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in plain_pipeline(texts)}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_stages_keep_columns_and_take_empty_tables(spark, scratch):
    for texts in ([], corpus()[:6]):
        # names that stages use themselves
        extra = {c: F.lit(c) for c in ("version", "removed", "row", "kept", "n_words", "copy", "stays", "_host", "fp", "n_links")}
        docs = frame(spark, texts).withColumns(extra)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs_out = stage(spark, docs, "")
            assert docs_out.columns == docs.columns
            assert all(r[c] == c for r in docs_out.collect() for c in extra)
    folder = saved(spark, scratch, documents=frame(spark, []))
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert df.columns == columns
    assert sorted(tuple(r) for r in df.collect()) == sorted(want.fetchall())


def test_different_documents_stay_whatever_their_ids(spark):
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(6)) for _ in range(80))
    root, unique, one, two, three = (own() for _ in range(5))
    near = f"{root} end"
    rows = [(1, root), (2, near), (2, unique), (3, one), (3, two), (None, three), (None, own()), (None, three), (None, near), (3, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect())
    assert left == sorted({(i or 0, t) for i, t in rows if t != near})


def test_equal_lines_of_documents_with_one_id_or_none_are_repeats(spark):
    line = "a line that stands in several documents at one place"
    docs = spark.createDataFrame([(None, f"{line}\nx"), (None, f"{line}\ny"), (7, f"{line}\nz"), (7, f"{line}\nv")], "doc_id long, text string")
    left = [r["text"] for r in line_dedup.without_repeated_lines(docs).collect()]
    assert sum(line in t for t in left) == 1 and len(left) == 4
