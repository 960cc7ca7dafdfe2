"""Operator 13: licence scans by matching statistics of a suffix automaton.

All templates, the base phrases among them, are words in one generalised suffix automaton.
A text is streamed through it word by word: the state and length give the longest stretch
that ends at the word and stands in some template.  Stretches that can't be extended are the
matches; those of at least ``least`` words are chained per template, in order in text and
template and with gaps of at most ``gap`` words, into spans.  A span that covers enough of its
template is reported; of spans that share words, the one that covers more words (then the
larger share, then the earlier template) stays.

Where two neighbouring words stand side by side in no template, no stretch of two words can
lie, so the automaton starts anew there: words become numbers for the whole text at once, and
only runs of neighbours that some template has are streamed.

A base phrase is a template whose places are all reported, by the states that end with it.

The automaton is built once on the driver and goes to the tasks with their code; its size
is at most twice the words of the templates.  No shuffle.  NULL texts are empty: no words, no
places, score 0, like texts without matches.  Ties between spans are settled as above, then by
place; repeated rows give repeated results; an empty table gives no rows.  Very long texts are
turned into numbers piece by piece, and chaining looks back over ``gap`` words only.  Only the
named columns are read, so others can't clash.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import utf8, word_pieces, word_table
from sparkmart.llm.licence_templates import TEMPLATES

WORDS = word_table("abcdefghijklmnopqrstuvwxyz0123456789")
#: The base phrases and their labels.
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
#: Words of a match that is chained, words between two of a chain, and the share of its template a span covers.
LEAST, GAP, COVER = 4, 12, 0.8


class Automaton:
    """Generalised suffix automaton of word sequences, with the places of its states."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        self.own = own
        for number, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                own[last].append((number, i + 1))
        self.below: list[list[int]] = [[] for _ in self.next]
        for state, link in enumerate(self.link[1:], 1):
            self.below[link].append(state)

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.next) - 1

    def _split(self, start: int, word: int, target: int) -> int:
        """A state for the shorter strings of ``target`` that ``start`` reaches by ``word``."""
        twin = self._state(self.length[start] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = twin
        while start >= 0 and self.next[start].get(word) == target:
            self.next[start][word] = twin
            start = self.link[start]
        return twin

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            # another sequence has been here
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest stretch ending with ``word`` that stands in a sequence, and its state."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return self.next[state][word], length + 1

    def places(self, state: int) -> list[tuple[int, int]]:
        """(sequence, end) of all places of a state's strings."""
        found, todo = [], [state]
        while todo:
            at = todo.pop()
            found += self.own[at]
            todo += self.below[at]
        return sorted(found)


@dataclass(frozen=True)
class Match:
    """``size`` words from ``start`` of the text are those from ``at`` of a template."""

    template: int
    start: int
    at: int
    size: int


@dataclass(frozen=True)
class Span:
    """A chain of matches: words ``start`` to ``end`` (exclusive) hold ``covered`` words of the template in order."""

    template: int
    start: int
    end: int
    covered: int


class Scanner:
    """Templates and phrases made ready; ``scan`` reads one text."""

    def __init__(
        self, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
        least: int = LEAST, gap: int = GAP, cover: float = COVER,
    ) -> None:
        self.least, self.gap, self.cover = least, gap, cover
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for label, _ in phrases]
        sequences = [text.encode().translate(WORDS).split() for _, text in [*templates, *phrases]]
        if any(len(s) < 2 for s in sequences):
            raise ValueError("templates and phrases have two words at least")
        self.vocabulary: dict[bytes, int] = {}
        numbered = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in s] for s in sequences]
        self.sizes = [len(s) for s in numbered]
        self.automaton = Automaton(numbered)
        n = len(self.vocabulary)
        #: Whether two words stand side by side in a template, and whether a phrase begins with them.
        self.beside, self.opens = np.zeros((n, n), bool), np.zeros((n, n), bool)
        for i, s in enumerate(numbered):
            self.beside[s[:-1], s[1:]] = True
            if i >= len(templates):
                self.opens[s[0], s[1]] = True
        # state -> phrases that end there; those of its links end there too
        self.ends: dict[int, list[int]] = {}
        for i, s in enumerate(numbered[len(templates) :]):
            state = length = 0
            for word in s:
                state, length = self.automaton.step(state, length, word)
            self.ends.setdefault(state, []).append(i)
        self.phrase_sizes = self.sizes[len(templates) :]
        self._ending = [self._phrases_of(state) for state in range(len(self.automaton.next))]
        self._places: dict[int, list[tuple[int, int]]] = {}

    def _phrases_of(self, state: int) -> list[int]:
        found = []
        while state > 0:
            found += self.ends.get(state, [])
            state = self.automaton.link[state]
        return found

    def numbers(self, data: bytes) -> np.ndarray:
        """The text's words as numbers, -1 for those of no template."""
        of = self.vocabulary.get
        return np.concatenate([np.fromiter(map(of, words, repeat(-1)), np.int32, len(words)) for words in word_pieces(data, WORDS)])

    def stretches(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, end) of runs in which neighbours stand side by side in templates, long enough to hold a match or a phrase."""
        a, b = words[:-1], words[1:]
        good = (a >= 0) & (b >= 0)
        good[good] = self.beside[a[good], b[good]]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return
        opening = np.zeros(len(good), bool)
        opening[good] = self.opens[a[good], b[good]]
        before = np.concatenate([[0], np.cumsum(opening)])
        wanted = (ends - starts + 1 >= self.least) | (before[ends] > before[starts])
        yield from zip(starts[wanted].tolist(), (ends[wanted] + 1).tolist(), strict=True)

    def read(self, words: np.ndarray) -> tuple[list[tuple[int, int]], list[Match]]:
        """(start, phrase) of all places of phrases, and the matches with templates, both in order of the text."""
        places: list[tuple[int, int]] = []
        matches: list[Match] = []
        for start, end in self.stretches(words):
            state = length = 0
            for i, word in enumerate(words[start:end].tolist(), start):
                ahead, longer = self.automaton.step(state, length, word)
                if longer <= length and length >= self.least:
                    matches += self._matches(i, state, length)
                state, length = ahead, longer
                for phrase in self._ending[state]:
                    if self.phrase_sizes[phrase] <= length:
                        places.append((i + 1 - self.phrase_sizes[phrase], phrase))
            if length >= self.least:
                matches += self._matches(end, state, length)
        return sorted(places), matches

    def _matches(self, end: int, state: int, length: int) -> list[Match]:
        if state not in self._places:
            self._places[state] = [p for p in self.automaton.places(state) if p[0] < len(self.labels)]
        return [Match(template, end - length, at - length, length) for template, at in self._places[state]]

    def chains(self, matches: list[Match]) -> list[Span]:
        """The best chain ending with each match: the most covered words, then the latest start.

        A match may overlap the one before it in text or template; the shared words count once.
        Matches of a text come in order of their ends and of their starts as well, so those that
        end more than ``gap`` words before one are of no use to the later ones.
        """
        done: dict[int, deque[tuple[Match, Span]]] = {}
        spans = []
        for m in matches:
            earlier = done.setdefault(m.template, deque())
            while earlier and earlier[0][0].start + earlier[0][0].size + self.gap < m.start:
                earlier.popleft()
            best = Span(m.template, m.start, m.start + m.size, m.size)
            for before, span in earlier:
                over = max(before.start + before.size - m.start, before.at + before.size - m.at, 0)
                apart = max(m.start - before.start - before.size, m.at - before.at - before.size)
                if over < m.size and apart <= self.gap and before.start < m.start and before.at < m.at:
                    joined = Span(m.template, span.start, m.start + m.size, span.covered + m.size - over)
                    best = max(best, joined, key=lambda s: (s.covered, s.start))
            earlier.append((m, best))
            spans.append(best)
        return spans

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], list[Span], float]:
        """Words, places of phrases, spans of templates, and the largest share of a template that is covered."""
        words = self.numbers(data)
        places, matches = self.read(words)
        chains = self.chains(matches) if matches else []
        share = lambda s: min(1.0, s.covered / self.sizes[s.template])
        score = max([1.0 if places else 0.0, *map(share, chains)])
        found: list[Span] = []
        taken = np.zeros(0, bool) if not chains else np.zeros(len(words), bool)
        for s in sorted(chains, key=lambda s: (-s.covered, -share(s), s.template, s.start)):
            if share(s) >= self.cover and not taken[s.start : s.end].any():
                taken[s.start : s.end] = True
                found.append(s)
        return len(words), places, sorted(found, key=lambda s: s.start), score


def scan_documents(docs: DataFrame, scanner: Scanner | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, places of the base phrases, labels, ``spans`` (label:start:end in words, comma-joined) and ``score``."""
    scanner = scanner or Scanner()
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score"]
    types = [pa.int64()] * 4 + [pa.string()] * 3 + [pa.float64()]

    def one(data: bytes) -> tuple:
        n_words, places, spans, score = scanner.scan(data)
        base = {scanner.phrase_labels[p] for _, p in places}
        found = base | {scanner.labels[s.template] for s in spans}
        told = ",".join(f"{scanner.labels[s.template]}:{s.start}:{s.end}" for s in spans)
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        return n_words, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(found)), told, score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(data) for data in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[key, *names])

    schema = f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, spans string, score double"
    return docs.select(F.col(key), utf8(text)).mapInArrow(run, schema)
