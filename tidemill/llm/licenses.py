"""Licence scans: matching statistics of a text against a generalised suffix automaton of licence wordings, long matches chained into spans.

The automaton knows every run of words of every template and phrase. A text is streamed through it word by word: at each word it holds the longest
run ending there that some template has. Runs that cannot be made longer and have LEAST_MATCH words or more are long matches; matches that go on in
the same order in text and template, with little between them, are chained to a span that covers part of the template. Phrases are met
at states whose run ends with them, so one stream finds both.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits
from tidemill.llm.license_texts import PHRASES, TEMPLATES

#: Words of a run that counts as a match of a template.
LEAST_MATCH = 4
#: Words that may lie between two matches of a chain, in the text and in the template.
GAP = 12
#: Share of a template that a chain must cover to be reported.
LEAST_SHARE = 0.6
#: Score of a text that names a licence in a phrase but holds no span.
PHRASE_SCORE = 0.5
#: Bytes of a text that are split into words at a time.
STREAM_BYTES = 1 << 20
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(data: bytes, at_once: int = STREAM_BYTES) -> Iterator[list[bytes]]:
    """Lists of the words of a UTF-8 text, A-Z in lower case; letters a-z, digits and all that is not ASCII make words."""
    low = 0
    while low < len(data):
        high = min(len(data), low + at_once)
        # the list ends where a word does
        while high < len(data) and _WORD_BYTES[data[high]] != 0x20:
            high += 1
        yield data[low:high].translate(_WORD_BYTES).split()
        low = high


def all_words(text: str) -> list[bytes]:
    return [w for part in words_of(text.encode("utf-8", "surrogatepass")) for w in part]


class SuffixAutomaton:
    """Generalised suffix automaton of sequences of numbers: a path from the root for each run of each sequence, states shared by equal sets of ends."""

    def __init__(self, sequences: Sequence[Sequence[int]], least: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
        #: for runs of `least` words and more: (sequence, place after the run) of each occurrence
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for number, sequence in enumerate(sequences):
            state = 0
            for place, symbol in enumerate(sequence, 1):
                state = at = self.next[state][symbol]
                while self.length[at] >= least:
                    self.ends[at].append((number, place))
                    at = self.link[at]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, symbol: int) -> int:
        """The state of the sequence's prefix that is longer by the symbol."""
        if symbol in self.next[last]:
            return self._whole(last, symbol)
        new, at = self._state(self.length[last] + 1, {}, 0), last
        while at != -1 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at != -1:
            self.link[new] = self._whole(at, symbol)
        return new

    def _whole(self, at: int, symbol: int) -> int:
        """The state whose longest run is that of `at` and the symbol; split off its state if longer runs share that."""
        target = self.next[at][symbol]
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(self.length[at] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while at != -1 and self.next[at].get(symbol) == target:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def read(self, sequence: Sequence[int]) -> int:
        state = 0
        for symbol in sequence:
            state = self.next[state][symbol]
        return state


@dataclass
class Chain:
    """Matches of one template in order: words [start, end) of the text, up to word `upto` of the template, `covered` words in matches."""

    start: int
    end: int
    upto: int
    covered: int
    extended: bool = field(default=False)


class Scanner:
    """The automaton of templates and phrases; made once per task."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, least_match: int = LEAST_MATCH, gap: int = GAP, least_share: float = LEAST_SHARE):
        self.least, self.gap, self.share = least_match, gap, least_share
        self.labels, sequences, self.numbers = [], [], {}
        for label, text in [*templates, *phrases]:
            self.labels.append(label)
            sequences.append([self.numbers.setdefault(w, len(self.numbers)) for w in all_words(text)])
        self.templates = len(templates)
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences, least_match)
        of_state = defaultdict(list)
        for label, sequence in zip(self.labels[self.templates:], sequences[self.templates:]):
            if sequence:
                of_state[self.automaton.read(sequence)].append((len(sequence), label))
        #: phrases that a run of a state may end with
        self.phrases: list[list[tuple[int, str]]] = []
        for state in range(len(self.automaton.next)):
            found, at = [], state
            while at > 0:
                found += of_state.get(at, [])
                at = self.automaton.link[at]
            self.phrases.append(found)
        self.least_run = min([least_match, *self.sizes[self.templates:]]) if self.sizes else least_match

    def scan(self, data: bytes) -> tuple[int, list[tuple[str, int]], list[dict]]:
        """(words, places of phrases, spans) of a UTF-8 text."""
        count, places, matches = 0, [], Matches(self)
        state, length = 0, 0
        moves, link, lengths, phrases = self.automaton.next, self.automaton.link, self.automaton.length, self.phrases
        for words in words_of(data):
            ids = np.fromiter((self.numbers.get(w, -1) for w in words), np.int64, len(words))
            edges = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False]))
            if len(ids) and (not len(edges) or edges[0] > 0):
                matches.add(count, state, length)
                state = length = 0
            for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if low and high < len(ids) and high - low < self.least_run:
                    continue
                for place, symbol in enumerate(ids[low:high].tolist(), count + low):
                    if symbol not in moves[state]:
                        matches.add(place, state, length)
                        while state and symbol not in moves[state]:
                            state = link[state]
                            length = lengths[state]
                    if symbol in moves[state]:
                        state, length = moves[state][symbol], length + 1
                        places += [(label, place - size + 1) for size, label in phrases[state] if size <= length]
                if high < len(ids):
                    matches.add(count + high, state, length)
                    state = length = 0
            count += len(ids)
        matches.add(count, state, length)
        return count, places, matches.spans()


class Matches:
    """Long matches of one text, chained by template as they come."""

    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.open: dict[int, list[Chain]] = defaultdict(list)
        self.good: list[tuple[int, Chain]] = []

    def add(self, end: int, state: int, length: int) -> None:
        """Adds the run of `length` words before `end` that cannot go on, at each place where a template has it or a long end of it."""
        scanner, automaton = self.scanner, self.scanner.automaton
        if length < scanner.least:
            return
        first, seen, found = end - length, set(), defaultdict(list)
        while length >= scanner.least:
            for number, upto in automaton.ends[state]:
                if number < scanner.templates and (number, upto) not in seen:
                    seen.add((number, upto))
                    found[number].append((length, upto))
            state = automaton.link[state]
            length = automaton.length[state]
        for number, runs in found.items():
            self._close(number, first - scanner.gap)
            self.open[number] += [self._chained(number, end, size, upto) for size, upto in runs]

    def _chained(self, number: int, end: int, length: int, upto: int) -> Chain:
        """The chain that has most words in matches among those the match can go on; itself alone if there is none."""
        start, gap, best, covered = end - length, self.scanner.gap, None, length
        for chain in self.open[number]:
            # what the chain covers already, in the text or in the template, is not counted again
            known = max(0, chain.end - start, chain.upto - (upto - length))
            if known < length and start - chain.end <= gap and upto - length - chain.upto <= gap and chain.covered + length - known > covered:
                best, covered = chain, chain.covered + length - known
        if best is None:
            return Chain(start, end, upto, length)
        best.extended = True
        return Chain(best.start, end, upto, covered)

    def _close(self, number: int, before: int) -> None:
        """Chains that end before that word cannot go on."""
        still = []
        for chain in self.open[number]:
            if chain.end >= before:
                still.append(chain)
            elif not chain.extended and chain.covered >= self.scanner.share * self.scanner.sizes[number]:
                self.good.append((number, chain))
        self.open[number] = still

    def spans(self) -> list[dict]:
        """The chains that cover enough of their template; of chains of one label that overlap in the text the one with most words."""
        for number in list(self.open):
            self._close(number, 1 << 62)
        labels, sizes = self.scanner.labels, self.scanner.sizes
        taken, spans = defaultdict(list), []
        for number, c in sorted(self.good, key=lambda g: (-g[1].covered, g[1].start, g[1].end, g[0])):
            label = labels[number]
            at = bisect_left(taken[label], (c.start, c.end))
            if any(a < c.end and c.start < b for a, b in taken[label][max(0, at - 1):at + 1]):
                continue
            insort(taken[label], (c.start, c.end))
            spans.append({"label": label, "start_word": c.start, "end_word": c.end, "covered": c.covered, "share": c.covered / sizes[number]})
        return sorted(spans, key=lambda s: (s["start_word"], s["end_word"], s["label"]))


FOUND = ("struct<n_words: long, places: array<struct<label: string, start_word: long>>, "
         "spans: array<struct<label: string, start_word: long, end_word: long, covered: long, share: double>>>")
_FOUND = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64())]))),
                    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()),
                                                  ("covered", pa.int64()), ("share", pa.float64())])))])


def find_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """The rows of docs with `licenses`: number of words, places of phrases (label, first word) and spans of templates.

    A span names its label, the words [start_word, end_word) of the text (from 0), the words of the template in matches and their share of it.
    Words are compared with A-Z in lower case. Null text counts as empty: no words, no places, no spans. All columns stay (one named licenses
    is replaced); ids, ties and repeated rows do not matter; an empty table gives no rows. Texts are streamed, however long.
    """
    arrow_limits(docs.sparkSession)

    @F.arrow_udf(FOUND)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates, phrases)
        for texts in batches:
            rows = []
            for text in texts.cast(pa.binary()):
                count, places, spans = scanner.scan(text.as_py() or b"")
                rows.append({"n_words": count, "places": [{"label": x, "start_word": n} for x, n in places], "spans": spans})
            yield pa.array(rows, _FOUND)
    return docs.withColumn("licenses", scanned(F.col("text").cast("string")))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of each row of docs.

    score is the largest share of a template that a span covers, PHRASE_SCORE at least where a phrase stands, else 0.
    """
    places, spans = F.col("licenses.places"), F.col("licenses.spans")
    joined = F.concat_ws(",", F.sort_array(F.array_distinct(places["label"])))
    every = F.concat_ws(",", F.sort_array(F.array_union(places["label"], spans["label"])))
    score = F.greatest(F.coalesce(F.array_max(spans["share"]), F.lit(0.0)), F.when(F.size(places) > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0)))
    return find_licenses(docs.select("doc_id", "text")).select(
        "doc_id", F.col("licenses.n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places["start_word"]).alias("first_word"), F.array_max(places["start_word"]).alias("last_word"),
        joined.alias("base_labels"), every.alias("labels"), score.alias("score"), spans.alias("spans"))
