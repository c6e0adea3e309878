"""Benchmark decontamination: SimHash of item-sized windows, found through multi-index Hamming blocks, verified exactly.

For each item every window of the item's word count that shares at least one shingle with the benchmark gets a
SimHash (a window that shares none has similarity 0, so none of the searched windows is lost). The items' fingerprints are
entered under blocks of their bits; a fingerprint within the radius agrees with the item on at least one block up to
a few bits, which are enumerated, so all items within the radius are candidates. The similarity of shingle multisets,
each shingle weighing as often as it occurs, then decides exactly.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import arrow_limits, materialize, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 a bit differs with probability 0.15; 24 of 64 lie five deviations above the mean of 10.
RADIUS = 24
BLOCKS = 8
#: The benchmark is sent to every task; beyond this many bytes of text it is searched in several passes. A task takes about 30 times as much.
PASS_BYTES = 4 << 20
_NOT_A_LETTER = re.compile(r"[\W_]+")


class Words(dict):
    """Raw token -> hash of its lower-cased letters and digits; 0 for a token that has none. Bounded in size."""

    bound = 300_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        plain = _NOT_A_LETTER.sub("", token.lower())
        value = self[token] = xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass"), 42) | 1 if plain else 0
        return value


def word_hashes(text: str, words: Words):
    """Hashes of the words of a text and the number of each among its raw tokens; punctuation alone is no word."""
    tokens = text.split()
    raw = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    at = np.nonzero(raw)[0]
    return raw[at], at


def bits_of(shingles) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    return np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def pack(sums) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def simhash(shingles) -> int:
    return int(pack(bits_of(shingles).sum(axis=0)[None, :])[0])


def similarity(left: Counter, right: Counter) -> float:
    """Sum of the smaller over the sum of the larger weights."""
    both = sum(min(n, right[k]) for k, n in left.items() if k in right)
    return both / (sum(left.values()) + sum(right.values()) - both)


class HammingIndex:
    """Fingerprints under `blocks` parts of their bits; find() gives all within the radius.

    Of `blocks` parts one differs in at most radius // blocks bits; each fingerprint is entered under all values of each part
    within that distance. A part's entries are one array of 32-bit numbers, ordered by value, so an index of n fingerprints takes
    4 * n * blocks * (values within the distance) bytes.
    """

    def __init__(self, values, radius: int = RADIUS, blocks: int = BLOCKS):
        self.values, self.radius, self.blocks, self.width = np.array(values, np.uint64), radius, blocks, 64 // blocks
        flips = np.array([sum(1 << b for b in c) for r in range(radius // blocks + 1) for c in combinations(range(self.width), r)], np.int64)
        self.starts, self.entries = [], []
        for n in range(blocks):
            keys = (self.part(self.values, n)[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            self.starts.append(np.searchsorted(keys[order], np.arange((1 << self.width) + 1)).astype(np.int64))
            self.entries.append((order // len(flips)).astype(np.int32))

    def part(self, values, n: int):
        return (values >> np.uint64(n * self.width) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def find(self, values: np.ndarray) -> list[tuple[int, int]]:
        """(place among the values, place among the fingerprints) of all pairs within the radius."""
        found, step = [], max(1, (1 << 21) // max(len(self.values), 1))
        for low in range(0, len(values), step):
            some = values[low:low + step]
            seen = np.zeros((len(some), len(self.values)), bool)
            for n in range(self.blocks):
                key = self.part(some, n)
                first, count = self.starts[n][key], self.starts[n][key + 1] - self.starts[n][key]
                upto = np.cumsum(count)
                at = np.repeat(first - (upto - count), count) + np.arange(int(count.sum()))
                seen[np.repeat(np.arange(len(some)), count), self.entries[n][at]] = True
            x, y = np.nonzero(seen)
            near = np.bitwise_count(some[x] ^ self.values[y]) <= self.radius
            found += zip((x[near] + low).tolist(), y[near].tolist())
        return found

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (*self.starts, *self.entries, self.values))


class Searcher:
    """The items of one pass, by word count; made once per task."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = SIMILARITY, radius: int = RADIUS):
        self.words, self.threshold, self.radius = Words(), threshold, radius
        self.counts: dict[int, Counter] = {}
        self.items: list[int] = []
        by_size, prints, self.of_size = defaultdict(list), defaultdict(list), defaultdict(list)
        for item, text in items:
            hashes, _ = word_hashes(text, self.words)
            if not len(hashes):
                continue
            shingles = shingle_hashes(hashes, SHINGLE)
            n = len(self.items)
            self.items.append(item)
            self.counts[n] = Counter(shingles.tolist())
            prints[len(hashes)].append(simhash(shingles))
            self.of_size[len(hashes)].append(n)
            by_size[len(hashes)].append(shingles)
        self.sizes = {size: HammingIndex(values, radius) for size, values in prints.items()}
        # shingles of SHINGLE words, and the whole items that have fewer
        self.known = {size: np.unique(np.concatenate(parts)) for size, parts in by_size.items()}
        full = [k for size, k in self.known.items() if size >= SHINGLE]
        self.any = np.unique(np.concatenate(full)) if full else np.zeros(0, np.uint64)
        self.short = [size for size in self.sizes if size < SHINGLE]

    @staticmethod
    def _within(values, table):
        if not len(table):
            return np.zeros(len(values), bool)
        at = np.searchsorted(table, values)
        at[at == len(table)] = 0
        return table[at] == values

    def _windows(self, shingles, size: int, count: int, hit):
        """First word of each window to look at: those that hold a shingle of an item of this size."""
        known = np.nonzero(hit)[0][self._within(shingles[hit], self.known[size])]
        if not len(known):
            return known
        last = max(0, count - size)
        edges = np.zeros(count + 2, np.int64)
        np.add.at(edges, np.clip(known - (size - SHINGLE), 0, last), 1)
        np.add.at(edges, np.minimum(known, last) + 1, -1)
        return np.nonzero(np.cumsum(edges) > 0)[0]

    def find(self, text: str | None) -> list[dict]:
        """For each item found: its id, the best similarity, and the tokens [start, end) of the first such window."""
        if not text:
            return []
        hashes, at = word_hashes(text, self.words)
        count, best = len(hashes), {}
        if not count:
            return []

        def offer(n: int, value: float, first: int, last: int) -> None:
            if value >= self.threshold and (n not in best or value > best[n][0]):
                best[n] = (value, int(at[first]), int(at[last]) + 1)

        if count >= SHINGLE:
            shingles = shingle_hashes(hashes, SHINGLE)
            hit = self._within(shingles, self.any)
            if hit.any():
                for size, index in self.sizes.items():
                    if size >= SHINGLE:
                        self._search(shingles, size, index, count, hit, offer)
        for size in self.short:
            # a window of fewer words is one shingle: equal or not
            if count >= size:
                shingles = shingle_hashes_of(hashes, size)
                for first in np.nonzero(self._within(shingles, self.known[size]))[0].tolist():
                    value = shingles[first:first + 1]
                    for n in (self.of_size[size][k] for _, k in self.sizes[size].find(np.array([simhash(value)], np.uint64))):
                        offer(n, similarity(Counter(value.tolist()), self.counts[n]), first, first + size - 1)
        return [{"item": self.items[n], "similarity": v, "start_word": a, "end_word": b} for n, (v, a, b) in sorted(best.items())]

    def _search(self, shingles, size, index, count, hit, offer) -> None:
        starts = self._windows(shingles, size, count, hit)
        if not len(starts):
            return
        width = min(size, count) - SHINGLE + 1
        # runs of neighbouring windows share their sums; a run is cut so that memory stays bounded
        cuts = np.nonzero(np.diff(starts) > width)[0] + 1
        for run in np.split(starts, cuts):
            for part in np.split(run, range(4096, len(run), 4096)):
                low, high = int(part[0]), int(part[-1]) + width
                sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits_of(shingles[low:high]), axis=0, dtype=np.int32)])
                prints = pack(sums[part - low + width] - sums[part - low])
                held, window = -1, None
                for at, k in index.find(prints):
                    first, n = int(part[at]), self.of_size[size][k]
                    if at != held:
                        held, window = at, Counter(shingles[first:first + width].tolist())
                    offer(n, similarity(window, self.counts[n]), first, first + width + SHINGLE - 2)


def shingle_hashes_of(hashes, size: int):
    """Windows of fewer than SHINGLE words as one shingle each, hashed like an item of that many words."""
    return shingle_hashes(hashes, size) if len(hashes) >= size else np.zeros(0, np.uint64)


def item_passes(benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> Iterator[pa.Table]:
    """The benchmark's rows (item_id, text) in parts of about `pass_bytes`; equal rows once, null texts not at all.

    The driver holds one part at a time, tasks hold the parts that they search. A benchmark larger than a part is searched in several passes.
    """
    rows = materialize(benchmark.filter(F.col("text").isNotNull()).select("item_id", F.col("text").cast("string").alias("text")).distinct(), "items")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // pass_bytes))
    for part in range(parts):
        yield rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").toArrow()


def matches_column(items: pa.Table, text, threshold: float = SIMILARITY, radius: int = RADIUS):
    """The items found in each text: place among the items, similarity, tokens [start_word, end_word)."""
    kind = pa.list_(pa.struct([("item", pa.int32()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
    texts = list(enumerate(items.column("text").to_pylist()))

    @F.arrow_udf("array<struct<item: int, similarity: double, start_word: long, end_word: long>>")
    def found_items(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = Searcher(texts, threshold, radius)
        for batch in batches:
            yield pa.array([search.find(t.as_py()) for t in batch], kind)
    return found_items(text.cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, item_id, similarity, start_word, end_word: one row for each row of docs and item found in it.

    A match is a window of as many words as the item has (or the whole text, if it has fewer) whose 5-word shingles have a
    weighted Jaccard similarity of at least `threshold` with the item's; the best window counts, the first of equals.
    Words are compared in lower case and without punctuation; start_word and end_word count white-space separated words. Items or texts without
    a word match nothing, as do null texts. Repeated documents are repeated in the result; null ids stay null, ids have any type.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    parts = []
    for items in item_passes(benchmark, pass_bytes):
        found = docs.select("doc_id", F.explode(matches_column(items, F.col("text"), threshold)).alias("m")).select("doc_id", "m.*")
        named = spark.createDataFrame(pa.table({"item": pa.array(range(items.num_rows), pa.int32()), "item_id": items.column("item_id")}),
                                      T.StructType([T.StructField("item", T.IntegerType()), benchmark.schema["item_id"]]))
        # a part has at most about pass_bytes / 64 items
        parts.append(found.join(F.broadcast(named), "item").select("doc_id", "item_id", "similarity", "start_word", "end_word"))
    return reduce(DataFrame.union, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of docs in which no item is found, all columns, also where names clash with ours.

    Rows with a null or empty text stay, and so do repeated ones; null ids do not matter; an empty benchmark drops nothing.
    """
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))
    for items in item_passes(benchmark, pass_bytes):
        rows = rows.filter(F.size(matches_column(items, F.col("row.text"), threshold)) == 0)
    return rows.select("row.*")
