"""Operators 1, 2 and 5."""

import itertools
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkmart.llm import components, mincut_extraction, prefix_forest, queries, simhash_tiles
from tests.llm.helpers import EDGE_TEXTS, frame, saved

# -- pages --------------------------------------------------------------------------------

LONG = "This paragraph has enough words in it to be taken for a part of the article by itself, I think."


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("<p", ""), ("<html><body></body></html>", ""),
    (f"<article><h1>Title</h1><p>{LONG}<p>a&lt;b &#233;\n x</article><footer>end</footer>", f"Title {LONG} a<b é x"),
    (f"<nav><ul><li><a href=/>Home<li><a href=/a>A</ul></nav><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>", f"{LONG} Short. {LONG}"),
    (f"<main><p>{LONG}</p><aside>{LONG}</aside><div class='ad-box'>{LONG}</div><p>{LONG}</p></main>", f"{LONG} {LONG}"),
    (f"<div id='comments'><p>{LONG}</p></div><div class='post-content'><p>{LONG}</p></div>", LONG),
    (f"<article><header><h1>T</h1></header><p>{LONG}</p><!-- <p>x</p> --><script>var a='</p>';</script><p hidden>no</p></article>", f"T {LONG}"),
    (f"<div class='cookie-notice'>{LONG}</div><form>{LONG}<textarea>no</textarea></form><article>{LONG}</article>", LONG),
    (f"<article><p>{LONG}</p><p>unclosed <b>bold<br>line", f"{LONG} unclosed bold line"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table><p>{LONG}</p></article>", f"one two c d {LONG}"),
])
def test_main_text(html, text):
    assert mincut_extraction.main_text(html) == text


@pytest.mark.parametrize("tag", ["div", "span", "li", "td", "a", "p"])
def test_long_pages_without_end_tags_take_time_by_their_length(tag):
    begun = time.process_time()
    text = mincut_extraction.main_text(f"<article><p>{LONG}</p>" + f"<{tag}>some text</b></q>" * 30_000)
    assert text.startswith(LONG) and time.process_time() - begun < 8


def test_tree_distance_equals_that_of_paths():
    rng, nodes, paths = random.Random(2), [None], [()]
    for i in range(60):
        k = rng.randrange(len(nodes))
        nodes.append(mincut_extraction.Node(nodes[k]))
        paths.append((*paths[k], i))
    for x, y in itertools.product(range(len(nodes)), repeat=2):
        common = sum(a == b for a, b in zip(paths[x], paths[y], strict=False))
        assert mincut_extraction.distance(nodes[x], nodes[y], 99) == len(paths[x]) + len(paths[y]) - 2 * common


def test_cut_is_minimal_on_all_small_graphs():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-1, 1]) * rng.randrange(0, 300) / 100 for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 150) / 100) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(side, scores=scores, edges=edges):
            lost = sum(max(s, 0) if not kept else max(-s, 0) for s, kept in zip(scores, side, strict=True))
            return lost + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(mincut_extraction.source_side(scores, edges)) == pytest.approx(best)


def test_pages_table(spark, scratch):
    pages = [(1, "u", f"<article>{LONG * 500}</article>"), (2, None, None), (3, "v", "<p>x</p>"), (3, "v", "<p>x</p>")]
    folder = saved(spark, scratch, pages=spark.createDataFrame(pages, "page_id long, url string, html string"))
    rows = queries.op1_mincut_extraction(spark, folder).collect()
    assert sorted(r["page_id"] for r in rows) == [1, 2, 3, 3] and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert next(r for r in rows if r["page_id"] == 1)["text"] == LONG * 500


# -- neighbours -----------------------------------------------------------------------------


def plain_nearest(vectors, k, every):
    found = {}
    arrays = {i: np.array(v, float) for i, v in vectors if v and None not in v and np.isfinite(v).all() and any(v)}
    for q, a in arrays.items():
        if q % every == 0:
            others = [(-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i) for i, b in arrays.items() if i != q and len(b) == len(a)]
            found[q] = [(i, -s) for s, i in sorted(others, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return found


def clustered(n, rng):
    centres = rng.standard_normal((12, 24))
    return [(i, (centres[i % 12] + 0.4 * rng.standard_normal(24)).astype("f4").tolist()) for i in range(n)]


def test_recall_and_scores(spark, scratch):
    vectors = clustered(4000, np.random.default_rng(1))
    folder = saved(spark, scratch, embeddings=spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    want, hits, rows = plain_nearest(vectors, 5, 50), 0, queries.op2_prefix_forest(spark, folder).collect()
    arrays = {i: np.array(v, float) for i, v in vectors}
    for r in rows:
        a, b = arrays[r["query_id"]], arrays[r["vec_id"]]
        assert r["score"] == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        hits += r["vec_id"] in [i for i, _ in want[r["query_id"]]]
    assert len(rows) == 5 * len(want) and hits >= 0.9 * len(rows)


def test_only_what_prefixes_add_is_scored():
    rng = np.random.default_rng(2)
    vectors = np.array([v for _, v in clustered(6000, rng)], float)
    forest = prefix_forest.Forest(np.arange(6000), vectors)
    query, entry = forest.search(vectors[:200], 6)
    assert forest.scored < 0.5 * 200 * 6000
    unit = prefix_forest.unit(vectors)
    best = np.argsort(-(unit[:200] @ unit.T), axis=1)[:, :6]
    assert len({*zip(query.tolist(), entry.tolist(), strict=True)} & {(q, e) for q in range(200) for e in best[q].tolist()}) >= 0.9 * 1200


def test_rows_that_share_an_id(spark):
    vectors = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 0.5]), (3, [0.5, 1.0]), (None, [1.0, 0.0])]
    rows = prefix_forest.nearest(spark.createDataFrame(vectors, "id long, vector array<double>"), 5, 50).orderBy("rank").collect()
    assert [(r["rank"], r["id"]) for r in rows] == [(1, 2), (2, 3), (3, 1), (4, 1), (5, 2)]
    assert [r["score"] for r in rows] == pytest.approx([0.8**0.5, 0.8**0.5, 0.5**0.5, 0.5**0.5, 0.2**0.5])


def test_copies_ties_and_unusable_vectors(spark, scratch):
    vectors = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [2.0, 4.0]), (101, [-1.0, 0.0]), (102, None), (103, []), (104, [0.0, 0.0]),
               (105, [float("nan"), 1.0]), (150, [None, 1.0]), (200, [float("inf"), 1.0]), (250, [1.0]), (300, [1e-30, 2e-30]), (300, [1e-30, 2e-30])]
    df = spark.createDataFrame(vectors, "id long, vector array<double>")
    got = {}
    for r in prefix_forest.nearest(df, 5, 50).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == {0: [1, 2, 3, 4, 5], 100: [0, 1, 2, 3, 4], 300: [0, 1, 2, 3, 4]}
    assert prefix_forest.nearest(df.filter("id < 3"), 5, 50).count() == 2
    assert prefix_forest.nearest(df.filter("id < 0"), 5, 50).count() == 0


# -- near-duplicates --------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    root = list(range(len(prints)))
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    return root


def test_fingerprints_and_groups_equal_all_pairs(spark, scratch):
    rng = random.Random(3)
    texts = [*EDGE_TEXTS]
    for _ in range(60):
        own = ["".join(rng.choice("etaoin") for _ in range(5)) for _ in range(rng.randrange(1, 200))]
        for _ in range(rng.randrange(1, 4)):
            texts.append(" ".join(own))
            own = list(own)
            own[rng.randrange(len(own))] = "CHANGED É"
    prints = [plain_fingerprint(t) for t in texts]
    rows = sorted(queries.op5_simhash(spark, saved(spark, scratch, documents=frame(spark, texts))).collect())
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == plain_components(prints)


@pytest.mark.parametrize("tile_rows", [3, 10_000])
def test_tiles_lose_no_link(spark, tile_rows):
    rng = random.Random(7)
    prints = list({rng.getrandbits(64) for _ in range(40)})
    for p in list(prints):
        for _ in range(rng.randrange(4)):
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                p ^= 1 << bit
            prints.append(p)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    links = simhash_tiles.fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), 4, tile_rows)
    roots = {r["node"]: r["root"] for r in components.component_roots(links).collect()}
    want = plain_components([p % (1 << 64) for p in prints])
    assert [roots.get(p, p) for p in prints] == [prints[r] for r in want]


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components.component_roots(links).collect()} == {0}


@pytest.mark.parametrize(("query", "table", "schema"), [
    ("op1_mincut_extraction", "pages", "page_id long, url string, html string"), ("op2_prefix_forest", "embeddings", "vec_id long, embedding array<float>"),
    ("op5_simhash", "documents", "doc_id long, text string"),
])
def test_empty_table_gives_no_rows(spark, scratch, query, table, schema):
    assert queries.QUERIES[query](spark, saved(spark, scratch, **{table: spark.createDataFrame([], schema)})).count() == 0
