"""Public BPE tokenizers in Spark tasks: loaded once per worker, distinct words encoded once.

Both functions cut a text only where the tokenizer itself always starts anew, keep the
result per distinct word (:class:`~sparkmart.llm.merge_rounds.WordTable`), and leave to
the library whatever their own rules don't cover.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex

from sparkmart.llm.merge_rounds import PairTable, WordTable, gather, merge_words


@lru_cache(4)
def load(path: str):
    """The tokenizer of a file, on one thread: Spark's tasks are the parallel part."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Words that go to the library at once: its results are many times as large as their ids.
BATCH_WORDS = 4096


def _library(path: str, words: list[str]) -> Iterator[np.ndarray]:
    for at in range(0, len(words), BATCH_WORDS):
        for found in load(path).encode_batch_fast(words[at : at + BATCH_WORDS], add_special_tokens=False):
            yield np.asarray(found.ids, np.int32)


def _flat(rows: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = list(rows)
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.concatenate([np.asarray(r, np.int32) for r in rows] or [np.empty(0, np.int32)]), counts


# -- byte-level BPE: white space belongs to the word behind it --------------------------

_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


@lru_cache(2)
def _byte_words(path: str) -> WordTable:
    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.empty(0, np.int32), np.fromiter(map(len, _library(path, new)), np.int64, len(new))

    return WordTable(encode)


def byte_token_counts(path: str, texts: list[str]) -> list[int]:
    """Tokens per text of a byte-level BPE with GPT-2's splitting.

    Where a character that is not white space is followed by white space, that splitting
    always starts anew, and special strings hold no white space.  A text with other white
    space than blanks and line ends is left to the library as a whole.
    """
    table = _byte_words(path)
    odd = [i for i, text in enumerate(texts) if _OTHER_SPACE.search(text)]
    whole = set(odd)
    codes = table.codes([[] if i in whole else _CHUNK.findall(text) for i, text in enumerate(texts)])
    counts = [int(table.counts[c].sum()) for c in codes]
    for i in odd:
        counts[i] = len(next(_library(path, [texts[i]])))
    return counts


# -- BPE with word ends: white space is dropped -----------------------------------------

#: The splitting pattern of word_bpe_49k.json cuts behind these, wherever a part begins with them.
_ENDINGS = {2: [b"'s", b"'t", b"'m", b"'d"], 3: [b"'re", b"'ve", b"'ll"]}
#: Where words end, and how many characters of a text are taken apart at once.
_BREAK = re.compile(r"[ \n]")
PIECE_CHARS = 1_000_000
#: Kinds of characters: what stands between words, what the pattern tells apart, and what is left to the library.
_BLANK, _LETTER, _NUMBER, _SIGN, _ODD = range(5)
#: Kind and lower case by code point.  None is odd that is its own composed form and has a lower case of one character.
_KIND, _LOWER = np.full(0x140, _ODD, np.uint8), np.arange(0x140)
for _c in chain(range(0x21, 0x7F), range(0xA1, 0x130)):
    _KIND[_c] = _LETTER if regex.match(r"\p{L}", chr(_c)) else _NUMBER if regex.match(r"\p{N}", chr(_c)) else _SIGN
    _LOWER[_c] = ord(chr(_c).lower())
_KIND[[10, 32]] = _BLANK
#: The same by byte, for ``bytes.translate``; bytes of longer characters are looked at apart.
_BYTE_KIND = bytes(_KIND[:128]) + bytes([_ODD] * 128)
_BYTE_LOWER = bytes(_LOWER[:128].tolist()) + bytes(range(128, 256))


def split_words(texts: list[str]) -> tuple[pa.BinaryArray, np.ndarray]:
    """The parts of all words in lower case, text behind text, and where each text begins in them, with the last one's end.

    Parts are those of the splitting pattern.  A word with an odd character or what may be a
    special string is one part, as it is written; the blank before it tells it from the others.
    """
    raw = [text.encode() for text in texts]
    data = b"\n".join([b"", *raw, b"\n"])
    plain = np.frombuffer(data, np.uint8)
    low, kind = (np.frombuffer(bytearray(data).translate(t), np.uint8) for t in (_BYTE_LOWER, _BYTE_KIND))
    lead = np.flatnonzero((plain >= 0xC2) & (plain <= 0xC4))
    point = ((plain[lead] & 31).astype(np.int64) << 6) | (plain[lead + 1] & 63)
    kind[lead] = kind[lead + 1] = _KIND[point]
    low[lead], low[lead + 1] = 0xC0 | (_LOWER[point] >> 6), 0x80 | (_LOWER[point] & 63)

    filled = kind != _BLANK
    start = kind == _NUMBER
    start[1:] |= kind[1:] != kind[:-1]
    start &= filled
    start[lead + 1] = False
    quote = np.flatnonzero(low == ord("'"))
    quote = quote[start[quote]]
    for size, endings in _ENDINGS.items():
        letters = [low[quote + k] for k in range(1, size)]
        for ending in endings:
            at = quote[np.logical_and.reduce([own == c for own, c in zip(letters, ending[1:], strict=True)])]
            start[at + 1] = False
            start[at + size] = filled[at + size]

    odd = np.flatnonzero((kind == _ODD) | ((plain == ord("<")) & (np.r_[plain[1:], 0] == ord("|"))))
    if len(odd):
        begin, end = (np.flatnonzero(np.diff(filled.view(np.int8)) == d) + 1 for d in (1, -1))
        word = np.unique(np.searchsorted(begin, odd, side="right") - 1)
        edge = np.zeros(len(plain), np.int8)
        edge[begin[word]], edge[end[word]] = 1, -1
        inside = np.cumsum(edge, dtype=np.int8).view(bool)
        start[inside], low[inside] = False, plain[inside]
        before = begin[word] - 1
        start[before], filled[before], low[before] = True, True, ord(" ")

    flat, places = low[filled], np.flatnonzero(start)
    offsets = np.r_[np.flatnonzero(start[filled]), len(flat)].astype(np.int32)
    parts = pa.BinaryArray.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    return parts, np.searchsorted(places, np.cumsum([0, *(len(r) + 1 for r in raw)]))


class _WordBpe:
    """Merges of the parts of words; those the library has to encode begin with a blank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        left, right = (np.array([vocab[pair[k]] for pair in merges]) for k in (0, 1))
        self.path, self.pairs = path, PairTable(left, right, np.arange(len(merges)), [vocab[a + b] for a, b in merges])
        # byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letter = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(own)))}
        self.inner = np.array([vocab[letter[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letter[b] + end] for b in range(256)], np.int32)

    def merge(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.frombuffer(b"".join(parts), np.uint8)
        symbols, ends = self.inner[flat], np.cumsum(counts) - 1
        symbols[ends] = self.last[flat[ends]]
        return merge_words(symbols, counts, self.pairs)

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        odd = [part[1:].decode() for part in parts if part[0] == 32]
        if not odd:
            return self.merge(parts)
        found = [self.merge([part for part in parts if part[0] != 32]), _flat(_library(self.path, odd))]
        flat, sizes = (np.concatenate(both) for both in zip(*found, strict=True))
        place = np.argsort([part[0] == 32 for part in parts], kind="stable")
        starts, counts = np.empty_like(sizes), np.empty_like(sizes)
        starts[place], counts[place] = np.cumsum(sizes) - sizes, sizes
        return gather(flat, starts, counts, np.arange(len(parts))), counts


@lru_cache(2)
def _parts(path: str) -> WordTable:
    return WordTable(_WordBpe(path).encode)


def word_token_ids(path: str, texts: list[str]) -> list[np.ndarray]:
    """Token ids per text of a BPE that drops white space; a very long text goes by pieces cut at white space."""
    short = iter(_token_ids(path, [text for text in texts if len(text) <= PIECE_CHARS]))
    return [
        next(short) if len(text) <= PIECE_CHARS else np.concatenate([_token_ids(path, [piece])[0] for piece in _pieces(text)])
        for text in texts
    ]


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE_CHARS)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _token_ids(path: str, texts: list[str]) -> list[np.ndarray]:
    """Each distinct part of the texts is looked up once."""
    parts, heads = split_words(texts)
    seen = parts.dictionary_encode()
    table = _parts(path)
    (known,) = table.codes([seen.dictionary.to_numpy(zero_copy_only=False).tolist()])
    codes = known[seen.indices.to_numpy()]
    ids, ends = table.ids_of(codes), np.r_[0, np.cumsum(table.counts[codes])][heads].tolist()
    return [ids[a:b] for a, b in pairwise(ends)]
