"""Operator 9: SentencePiece BPE encoding and decoding by vectorised merge rounds.

A piece never goes on past a word's end: only its first characters are the mark of white
space.  So a text falls into words (a run of marks and what follows up to the next mark),
each word is encoded alone, and equal words once.  A word's characters are merged by
:mod:`merge_rounds` with the pieces' scores as ranks; what stays unknown becomes bytes.

NULL and empty texts have no ids and decode to the empty text.  White space, repeated
words and characters outside the vocabulary come back as they were, but for the mark
character itself, which decodes to a blank, as the library does it.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from sparkmart.llm.common import map_texts
from sparkmart.llm.merge_rounds import PairTable, WordTable, gather, merge_words

#: The mark of white space, kinds of pieces in the model file.
MARK = "▁"
NORMAL, BYTE = 1, 6
_RUN = re.compile(" *[^ ]+| +")
_CODE_POINTS = 0x110000


class PieceModel:
    """The pieces of a model file with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rule = model.normalizer_spec
        if rule.precompiled_charsmap or not rule.add_dummy_prefix or rule.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation and a dummy prefix are supported")
        pieces = [(p.piece, p.type, p.score) for p in model.pieces]
        ids = {piece: i for i, (piece, kind, _) in enumerate(pieces) if kind == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in ids):
            raise ValueError("a piece goes on past a word's end")
        self.size = len(pieces)
        byte = {int(piece[1:-1], 16): i for i, (piece, kind, _) in enumerate(pieces) if kind == BYTE}
        self.byte_id = np.array([byte[b] for b in range(256)], np.int32)
        self.char_id = np.arange(self.size, self.size + _CODE_POINTS, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        # equal scores have equal ranks: the leftmost pair is first
        rank = {score: r for r, score in enumerate(sorted({pieces[i][2] for i in ids.values()}, reverse=True))}
        rows = [
            (ids.get(piece[:k], -1), ids.get(piece[k:], -1), rank[pieces[i][2]], i)
            for piece, i in ids.items() for k in range(1, len(piece))
        ]
        left, right, ranks, merged = map(np.array, zip(*rows, strict=True))
        known = (left >= 0) & (right >= 0)
        self.pairs = PairTable(left[known], right[known], ranks[known], merged[known])
        surface = [bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind == NORMAL else b"" for p, kind, _ in pieces]
        self.surface = _rows(surface)
        self.decimal = _rows([b"%d," % i for i in range(self.size)])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words as :func:`split` names them."""
        full = [word.replace(" ", MARK) if word[:1] == " " else MARK + word for word in words]
        points = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
        symbols, counts = merge_words(self.char_id[points], np.fromiter(map(len, full), np.int64, len(full)), self.pairs)
        unknown = symbols >= self.size
        if not unknown.any():
            return symbols, counts
        bytes_of = [chr(s - self.size).encode() for s in symbols[unknown]]
        flat = self.byte_id[np.frombuffer(b"".join(bytes_of), np.uint8)]
        width = np.ones(len(symbols), np.int64)
        width[unknown] = [len(b) for b in bytes_of]
        out = np.repeat(symbols, width)
        out[np.repeat(unknown, width)] = flat
        word = np.repeat(np.arange(len(words)), counts)
        return out, np.bincount(word, width, len(words)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, in UTF-8, without the dummy prefix."""
        text = gather(*self.surface, ids).tobytes()
        return text[1:] if text[:1] == b" " else text


def _rows(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.array([len(v) for v in values])
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(counts) - counts, counts


def split(text: str) -> list[str]:
    """The words of a text.  One behind a single blank is named without it; others keep their blanks."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    return [w[1:] if w[:1] == " " and w[1:2] != " " else w for w in _RUN.findall(" " + text)]


@lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(2)
def word_table(path: str) -> WordTable:
    return WordTable(model(path).encode_words)


def encode(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids per text."""
    table = word_table(path)
    return [table.ids_of(codes) for codes in table.codes([split(text) for text in texts])]


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text.  No shuffle."""

    def rows(keys, texts):
        pieces = model(path)
        for key, ids in zip(keys, encode(path, texts), strict=True):
            decimal = gather(*pieces.decimal, ids).tobytes()[:-1]
            yield key, len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(pieces.decode(ids)).hexdigest()

    return map_texts(docs, rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
