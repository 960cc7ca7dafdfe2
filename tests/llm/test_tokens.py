"""Operators 6, 8 and 9 against the libraries on whole texts."""

import functools
import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm import best_fit_packing, common, merge_rounds, queries, sentencepieces, token_counts, tokenizer_memo
from tests.llm.helpers import EDGE_TEXTS, frame, saved

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
TEXTS = st.text(st.sampled_from("aeinst  \n\té▁.,'1<|>日😀ſİΣ́") | st.characters(exclude_categories=["Cs"]), max_size=60)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture
def documents(spark, scratch):
    words = [f"w{i} thing's ending{i % 7}" for i in range(9000)]
    texts = [*EDGE_TEXTS, " ".join(words), "repeat me " * 30, "repeat me " * 30]
    return texts, saved(spark, scratch, documents=frame(spark, texts))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_any_text_is_encoded_as_by_the_libraries(text):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    (ids,) = sentencepieces.encode(PIECE, [text])
    assert ids.tolist() == pieces.encode(text)
    assert sentencepieces.model(PIECE).decode(ids).decode() == pieces.decode(ids.tolist())
    load = tokenizer_memo.load
    assert tokenizer_memo.word_token_ids(WORD, [text])[0].tolist() == load(WORD).encode(text, add_special_tokens=False).ids
    assert tokenizer_memo.byte_token_counts(BYTE, [text]) == [len(load(BYTE).encode(text, add_special_tokens=False).ids)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("'sStTrReEvVlLmMdD ÀÞ×ÿĮµ²½12!\"<|日\u0301\u00a0\t\n"), max_size=40), max_size=5))
def test_words_are_taken_apart_as_by_the_library(texts):
    got = [ids.tolist() for ids in tokenizer_memo.word_token_ids(WORD, texts)]
    assert got == [tokenizer_memo.load(WORD).encode(text, add_special_tokens=False).ids for text in texts]


def test_a_long_text_is_taken_apart_by_pieces(monkeypatch):
    text = "I'll  say\n\n" + "it's 日本 <|endoftext|> two-fold Ÿ² " * 40 + "x" * 300 + " end"
    (whole,) = tokenizer_memo.word_token_ids(WORD, [text])
    sizes, plain = [], tokenizer_memo.split_words
    monkeypatch.setattr(tokenizer_memo, "split_words", lambda texts: sizes.extend(map(len, texts)) or plain(texts))
    monkeypatch.setattr(tokenizer_memo, "PIECE_CHARS", 50)
    got = tokenizer_memo.word_token_ids(WORD, ["short", text, ""])
    assert [ids.tolist() for ids in got[1:]] == [whole.tolist(), []]
    assert len(sizes) > 10 and max(sizes) < 400
    assert whole.tolist() == tokenizer_memo.load(WORD).encode(text, add_special_tokens=False).ids


def test_repeated_words_are_looked_up_once(monkeypatch):
    handed, plain = [], merge_rounds.WordTable.codes
    monkeypatch.setattr(merge_rounds.WordTable, "codes", lambda self, lists: handed.extend(map(len, lists)) or plain(self, lists))
    texts = ["Some words, 'some' words; and odd 日本 ones.\n" * 2000, "words " * 2000]
    got = tokenizer_memo.word_token_ids(WORD, texts)
    assert sum(handed) < 20
    assert [ids.tolist() for ids in got] == [tokenizer_memo.load(WORD).encode(text, add_special_tokens=False).ids for text in texts]


def test_merge_rounds_equal_one_at_a_time_merging():
    rng = random.Random(3)
    pairs = {(a, b): (rng.randrange(40), 8 + k) for k, (a, b) in enumerate([(rng.randrange(12), rng.randrange(12)) for _ in range(40)])}
    left, right = map(list, zip(*pairs, strict=True))
    table = merge_rounds.PairTable(left, right, [r for r, _ in pairs.values()], [m for _, m in pairs.values()])
    words = [[rng.randrange(8) for _ in range(rng.choice([0, 1, 2, 5, 30, 400]))] for _ in range(200)]

    def plain(word):
        word = list(word)
        while True:
            best = min(((pairs[p][0], i) for i, p in enumerate(zip(word, word[1:], strict=False)) if p in pairs), default=None)
            if best is None:
                return word
            i = best[1]
            word[i : i + 2] = [pairs[word[i], word[i + 1]][1]]

    flat, counts = merge_rounds.merge_words(np.array(sum(words, []), np.int64), np.array([len(w) for w in words]), table)
    got = [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [plain(w) for w in words]


def test_word_table_forgets_without_changing_results():
    texts = ["alpha beta gamma", "beta delta", "alpha alpha"] * 3
    table = merge_rounds.WordTable(sentencepieces.model(PIECE).encode_words, limit=2)
    got = [table.ids_of(codes).tolist() for t in texts for codes in table.codes([sentencepieces.split(t)])]
    assert got == [ids.tolist() for ids in sentencepieces.encode(PIECE, texts)]


def test_word_table_holds_few_words_and_few_characters():
    for length, words_each, most in ((8, 20_000, 280_000), (20_000, 100, 400)):
        table, held = merge_rounds.WordTable(lambda new: (np.zeros(len(new), np.int32), np.ones(len(new), np.int64))), 0
        for i in range(20):
            table.codes([[f"{i * words_each + k:0{length}d}" for k in range(words_each)]])
            held = max(held, len(table))
        assert held <= most


def test_tasks_take_a_batch_apart_before_it_is_a_list(spark):
    docs = frame(spark, [None, "", *["é" * 1000] * 3000, "x" * 3_000_000, None, "end"]).coalesce(1)
    got = common.map_texts(docs, lambda keys, texts: [(k, len(t), sum(map(len, texts)), len(texts)) for k, t in zip(keys, texts, strict=True)], "doc_id long, n long, chars long, texts long")
    rows = got.collect()
    assert [(r["doc_id"], r["n"]) for r in rows] == [(i, n) for i, n in enumerate([0, 0, *[1000] * 3000, 3_000_000, 0, 3])]
    assert max(r["texts"] for r in rows) <= 502 and all(r["chars"] <= 501_000 for r in rows if r["n"] == 1000 and r["doc_id"] < 2900)
    same = common.replace_text(docs, lambda t: t[:3]).collect()
    assert [r["text"] for r in same] == [t and t[:3] for t in [r["text"] for r in docs.collect()]]


@pytest.mark.parametrize(("chunk", "overlap"), [(700, 16), (97, 3), (64, 1)])
def test_spliced_counts_are_those_of_the_whole_text(chunk, overlap):
    for text in ("words and don't  stop\n\n" * 90, "y" * 700 + " z" + "é" * 400, " " * 500 + "x" + " " * 400, "a <|endoftext|>" * 120 + "\n" * 30):
        assert token_counts.count_long(BYTE, text, chunk, overlap) == len(tokenizer_memo.load(BYTE).encode(text, add_special_tokens=False))


def test_chunks_stay_small_beside_a_long_stretch_without_white_space(monkeypatch):
    sizes, plain = [], token_counts.token_edges
    monkeypatch.setattr(token_counts, "token_edges", lambda path, text: sizes.append(len(text)) or plain(path, text))
    text = "some words " * 40_000 + "ab1" * 23_000 + " more words" * 40_000
    assert token_counts.count_long(BYTE, text) == len(plain(BYTE, text))
    assert max(sizes) < 3 * 69_000 < len(text) / 4


def test_token_counts_of_a_table(spark, documents):
    texts, folder = documents
    got = {r["doc_id"]: r for r in queries.op8_token_counts(spark, folder).collect()}
    for i, text in enumerate(texts):
        n = len(tokenizer_memo.load(BYTE).encode(text or "", add_special_tokens=False))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((text or "").encode()), n, n > 512)


def test_piece_digests_of_a_table(spark, documents, pieces):
    texts, folder = documents
    got = {r["doc_id"]: r for r in queries.op9_sentencepiece(spark, folder).collect()}
    for i, text in enumerate(texts):
        ids = pieces.encode(text or "")
        decoded = pieces.decode(ids) if ids else ""
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want


def test_packed_pieces_hold_all_tokens_without_gaps(spark, documents):
    texts, folder = documents
    rows = queries.op6_best_fit_packing(spark, folder).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer_memo.load(WORD).encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 2048)) and sum(r["length"] for r in own) == len(ids)
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own]
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


@pytest.mark.parametrize("n", [1, 40, 4000])
def test_plan_packs_every_piece_near_the_bound(n):
    rng = np.random.default_rng(n)
    need = np.bincount(np.clip(rng.lognormal(5.5, 1.2, n).astype(int), 1, 2048), minlength=2049)
    plan = best_fit_packing.packing_plan(need)
    held = np.zeros(2049, np.int64)
    for items, times in plan:
        assert sum(length * many for length, many in items) <= 2048
        for length, many in items:
            held[length] += many * times
    assert (held == need).all()
    bound = -(-int((need * np.arange(2049)).sum()) // 2048)
    assert sum(times for _, times in plan) <= max(bound + 2, 1.02 * bound)


def test_fractional_plan_covers_the_histogram():
    need = np.bincount(np.random.default_rng(1).integers(1, 65, 5000), minlength=65)
    covered = np.zeros(65)
    chosen, bound = best_fit_packing.fractional_plan(need, rounds=500)
    for items, amount in chosen:
        assert sum(length * many for length, many in items) <= 64
        for length, many in items:
            covered[length] += many * amount
    assert np.allclose(covered, need, atol=1e-3)
    assert bound <= sum(amount for _, amount in chosen) + 1e-6 <= 1.03 * bound


def test_plan_and_bound_enclose_the_fewest_sequences():
    @functools.cache
    def fewest(pieces):
        """By trying every set of pieces that fits beside the longest one."""
        if not pieces:
            return 0
        first, rest = pieces[0], pieces[1:]
        sets = {tuple(sorted(some)) for n in range(len(rest) + 1) for some in itertools.combinations(range(len(rest)), n) if first + sum(rest[i] for i in some) <= 12}
        return 1 + min(fewest(tuple(x for i, x in enumerate(rest) if i not in some)) for some in sets)

    rng = np.random.default_rng(4)
    for _ in range(60):
        pieces = tuple(sorted(rng.integers(1, 13, rng.integers(1, 9)).tolist(), reverse=True))
        need = np.bincount(pieces, minlength=13)
        _, bound = best_fit_packing.fractional_plan(need)
        packed = best_fit_packing.sequences(best_fit_packing.packing_plan(need))
        assert bound - 1e-6 <= fewest(pieces) <= packed <= fewest(pieces) + 1


@pytest.mark.parametrize(("lengths", "most"), [((500, 1100), 0.98), ((300, 1024), 0.98), ((1, 2049), 1.01)])
def test_program_against_best_fit_alone(lengths, most):
    need = np.bincount(np.random.default_rng(3).integers(*lengths, 3000), minlength=2049)
    plan = best_fit_packing.packing_plan(need)
    assert best_fit_packing.sequences(plan) <= most * best_fit_packing.sequences(best_fit_packing.best_fit(need))


@pytest.mark.parametrize("query", ["op6_best_fit_packing", "op8_token_counts", "op9_sentencepiece"])
def test_empty_table_gives_no_rows(spark, scratch, query):
    folder = saved(spark, scratch, documents=frame(spark, []))
    assert queries.QUERIES[query](spark, folder).count() == 0
