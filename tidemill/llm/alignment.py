"""Alignment of the tokens of two tokenizers over one text: the smallest groups of tokens that cover the same bytes.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model; both see a space before the text (B adds its own).
The character offsets of A and the spans of B's immutable result are coarse cuts. Where several tokens share a character
(multibyte characters cut inside, byte-fallback pieces) the decoded bytes of the tokens refine them. Byte offsets where a token of A and one
of B both end part the text into groups.

A text is cut into parts that neither tokenizer joins (before a single space or line break between other characters), so that
a part that occurs often is encoded and aligned once. A vocabulary with a piece across such a place turns this off.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, materialize

#: Estimated bytes of remembered parts in one Python worker; half of it is one generation.
REMEMBERED_BYTES = 192 << 20
#: Texts are handled in slices of about so many bytes.
SLICE_BYTES = 1 << 20
#: Longer parts are not remembered.
LONGEST_PART = 128
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_TWO_SPACES = re.compile(r"\s\s")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Part:
    """The token ids of a part on both sides, with the byte offset where each token ends."""

    __slots__ = ("a", "b", "a_ends", "b_ends")

    def __init__(self, a, a_ends, b, b_ends):
        self.a, self.a_ends, self.b, self.b_ends = a, a_ends, b, b_ends

    def groups(self) -> Iterator[tuple[int, list[int], list[int]]]:
        """(end, ids of A, ids of B) of each group: a group ends wherever a token of each side does."""
        i = j = 0
        a_ends, b_ends = self.a_ends, self.b_ends
        for p, q in zip(*common(a_ends, b_ends)):
            yield a_ends[p], self.a[i:p + 1], self.b[j:q + 1]
            i, j = p + 1, q + 1


def common(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int]]:
    """The places in both ascending lists that hold the same offset."""
    if a_ends == b_ends:
        return (every := list(range(len(a_ends)))), every
    place = {e: n for n, e in enumerate(b_ends)}
    left = [n for n, e in enumerate(a_ends) if e in place]
    return left, [place[a_ends[n]] for n in left]


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, vocabulary_a: str, model_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.one = Tokenizer.from_file(vocabulary_a)
        self.one.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_file=model_b)
        stands = byte_of_character()
        names = [self.one.id_to_token(i) or "" for i in range(max(self.one.get_vocab().values()) + 1)]
        self.a_bytes = [bytes(stands[c] for c in name) if all(c in stands for c in name) else name.encode() for name in names]
        self.b_bytes = [self._piece(i) for i in range(self.two.get_piece_size())]
        self.size_b = len(self.b_bytes)
        self.a_sizes, self.b_sizes = [*map(len, self.a_bytes)], [*map(len, self.b_bytes)]
        self.a_names, self.b_names = [*map(str, range(len(self.a_bytes)))], [*map(str, range(len(self.b_bytes)))]
        pieces = [b.decode("utf-8", "replace") for i, b in enumerate(self.b_bytes) if not self.two.is_byte(i)]
        self.parted = not any("\n" in p or re.search("[^ ] ", p) for p in pieces)

    def _piece(self, number: int) -> bytes:
        name = self.two.id_to_piece(number)
        found = _BYTE_PIECE.fullmatch(name) if self.two.is_byte(number) else None
        return bytes([int(found[1], 16)]) if found else name.replace("▁", " ").encode()

    def parts(self, text: str) -> list[str]:
        """The space and the text, cut where no token of either side crosses."""
        whole = " " + text
        if not self.parted:
            return [whole]
        if "\0" in text or text[:1].isspace() or text[-1:].isspace() or _TWO_SPACES.search(text):
            return _CUT.split(whole)
        return whole.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def align(self, parts: list[str]) -> list[Part | None]:
        """Each part; None if the tokens of a side do not spell it.

        Parts that both sides cut off from each other are encoded together, which spares most of the cost of a call.
        """
        together = [n for n, p in enumerate(parts) if self.parted and not p[1:2].isspace() and not p[-1].isspace() and len(p) > 1]
        found: dict[int, Part | None] = {}
        for low in range(0, len(together), 4096):
            some = together[low:low + 4096]
            # the first word only stands where B puts its space
            cut = self._cut_at(" x" + "".join([parts[n] for n in some]), [2, *(len(parts[n].encode()) for n in some)])
            if cut:
                found.update(zip(some, cut[1:]))
        return [found[n] if n in found else self._alone(p) for n, p in enumerate(parts)]

    def _alone(self, part: str) -> Part | None:
        if part[0] == "\n":
            cut = self._cut_at(" x" + part, [2, len(part.encode())])
            return cut[1] if cut else None
        cut = self._cut_at(part, [len(part.encode())])
        return cut[0] if cut else None

    def _cut_at(self, whole: str, sizes: list[int]) -> list[Part] | None:
        """The tokens of a text that starts with a space, parted after so many bytes each; None if they do not spell it or cross a cut."""
        raw = whole.encode()
        code = self.one.encode(whole, add_special_tokens=False)
        pieces = self.two.encode(whole[1:], return_type="proto").pieces
        a, b = code.ids, [p.id for p in pieces]
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        ends = [e for _, e in code.offsets]
        if len(raw) != len(whole):
            # byte offset after each character: a character starts at each byte that continues none
            data = np.frombuffer(raw, np.uint8)
            at = np.append(np.nonzero((data & 0xC0) != 0x80)[0], len(raw))
            ends = at[ends].tolist()
        a_ends = refine(ends, a, self.a_sizes)
        b_ends = refine([p.end + 1 for p in pieces], b, self.b_sizes)
        edges = np.cumsum(sizes)
        p, q = np.searchsorted(a_ends, edges), np.searchsorted(b_ends, edges)
        if (np.array(a_ends)[p] != edges).any() or (np.array(b_ends)[q] != edges).any():
            return None
        found, i, j = [], 0, 0
        for start, p, q in zip([0, *edges.tolist()], (p + 1).tolist(), (q + 1).tolist()):
            found.append(Part(a[i:p], [e - start for e in a_ends[i:p]], b[j:q], [e - start for e in b_ends[j:q]]))
            i, j = p, q
        return found


def refine(coarse: list[int], ids: list[int], sizes: list[int]) -> list[int]:
    """The coarse ends, corrected by the decoded bytes where tokens share a character or have an empty span."""
    ends, last = [], 0
    for end, i in zip(coarse, ids):
        if end - last != sizes[i]:
            end = last + sizes[i]
        ends.append(end)
        last = end
    return ends


class Memory:
    """The entries of parts met before; at the bound those that were not used since the last half of it are forgotten."""

    def __init__(self, aligner: Aligner, bound: int = REMEMBERED_BYTES):
        self.aligner, self.bound = aligner, bound
        self.old: dict[str, tuple] = {}
        self.now: dict[str, tuple] = {}
        self.held = 0

    def entry(self, part: Part | None) -> tuple | None:
        """(tokens of A, tokens of B, groups, group text, pair of ids at each cut)."""
        if part is None:
            return None
        a, b, both = part.a, part.b, self.aligner
        left, right = common(part.a_ends, part.b_ends)
        # ids as text
        x, y = [both.a_names[n] for n in a], [both.b_names[n] for n in b]
        if len(left) == len(a) == len(b):
            text = ";".join([f"{p}|{q}" for p, q in zip(x, y)])
        else:
            i, j, groups = 0, 0, []
            for p, q in zip(left, right):
                groups.append(",".join(x[i:p + 1]) + "|" + ",".join(y[j:q + 1]))
                i, j = p + 1, q + 1
            text = ";".join(groups)
        return len(a), len(b), len(left), text.encode(), [a[p] * both.size_b + b[q] for p, q in zip(left, right)]

    def entries(self, parts: set[str]) -> dict[str, tuple | None]:
        """A table with the entry of each part; what is not remembered is aligned now."""
        if self.held > self.bound // 2:
            self.old, self.now, self.held = self.now, {}, 0
        now, old, passing = self.now, self.old, {}
        new = []
        for part in parts.difference(now):
            if part in old:
                self._keep(part, old[part])
            else:
                new.append(part)
        for low in range(0, len(new), 4096):
            some = new[low:low + 4096]
            for part, found in zip(some, map(self.entry, self.aligner.align(some))):
                if len(part) <= LONGEST_PART:
                    self._keep(part, found)
                else:
                    passing[part] = found
        return now | passing if passing else now

    def _keep(self, part: str, entry: tuple | None) -> None:
        self.now[part] = entry
        self.held += 400 + 2 * len(part) + (0 if entry is None else len(entry[3]) + 36 * len(entry[4]))


_aligners: dict[tuple, Aligner] = {}


def aligner(vocabulary_a: str, model_b: str) -> Aligner:
    """The tokenizers are loaded once per worker process; what a task remembers ends with the task."""
    key = (vocabulary_a, model_b)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*key)
    return _aligners[key]


GROUPS = "array<struct<start: int, end: int, a: array<int>, b: array<int>>>"


def token_groups(docs: DataFrame, vocabulary_a: str | None = None, model_b: str | None = None) -> DataFrame:
    """The rows of docs with `groups`: for each group its first byte, the byte after it, and the ids of both sides.

    Offsets count the bytes of the text with a space before it. Texts that are null or empty, or whose tokens do not spell that, have
    no groups. All columns stay (one named groups is replaced); ids, ties and repeated rows do not matter; an empty table gives no rows.
    """
    arrow_limits(docs.sparkSession)
    paths = vocabulary_a or default_vocabularies()[0], model_b or default_vocabularies()[1]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    @F.arrow_udf(GROUPS)
    def groups(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        both = aligner(*paths)
        for texts in batches:
            yield pa.array([text_groups(both, t.as_py()) for t in texts], kind)
    return docs.withColumn("groups", groups(F.col("text").cast("string")))


def text_groups(both: Aligner, text: str | None) -> list[dict]:
    if not text:
        return []
    parts, found, start = both.parts(text), [], 0
    for part, known in zip(parts, both.align(parts)):
        if known is None:
            return []
        for (a, _, _), (b, left, right) in pairwise([(0, [], []), *known.groups()]):
            found.append({"start": start + a, "end": start + b, "a": left, "b": right})
        start += len(part.encode())
    return found


def _report_rows(both: Aligner, memory: Memory, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    cut = [both.parts(t) if t else [] for t in texts]
    known = memory.entries(set().union(*cut))
    rows, keys, owners = [], [], []
    for n, parts in enumerate(cut):
        entries = list(map(known.__getitem__, parts))
        if not entries or None in entries:
            rows.append((0, 0, 0, ""))
            continue
        a, b, groups, text, pairs = zip(*entries)
        rows.append((sum(a), sum(b), sum(groups), hashlib.sha256(b";".join(text)).hexdigest()))
        before = len(keys)
        for some in pairs:
            keys += some
        owners.append((n, len(keys) - before))
    # each document's distinct pairs with how often it has them
    flat = np.array(keys, np.int64)
    if len(flat):
        owner = np.repeat(*np.array(owners, np.int64).T)
        order = np.lexsort((flat, owner))
        flat, owner = flat[order], owner[order]
        first = np.nonzero(np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])])[0]
        times, flat, owner = np.diff(np.r_[first, len(flat)]), flat[first], owner[first]
    else:
        times = owner = flat
    offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
    columns = [*map(list, zip(*rows))]
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string()),
         pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
        names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])


def aligned(docs: DataFrame, vocabulary_a: str, model_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, and the linked id pairs (id of A * pieces of B + id of B) with their number of times."""
    arrow_limits(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(vocabulary_a, model_b)
        memory = Memory(both)
        gc.disable()  # millions of small lists, none of them in a cycle
        try:
            for batch in batches:
                texts = batch.column(1)
                sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // SLICE_BYTES
                # slices of bounded text, as some texts are very long
                edges = [0, *(np.nonzero(np.diff(sizes))[0] + 1).tolist(), batch.num_rows]
                for low, high in pairwise(edges):
                    for at in range(low, high, 512):
                        count = min(512, high - at)
                        yield _report_rows(both, memory, batch.column(0).slice(at, count), texts.slice(at, count).to_pylist())
        finally:
            gc.enable()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        align, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """pair, n, best: the links of each id pair in all rows, and whether no other pair of its id of B has more."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    of_b = Window.partitionBy(F.col("pair") % F.lit(size_b))
    return each.withColumn("best", F.col("n") == F.max("n").over(of_b))


def alignment_report(docs: DataFrame, vocabulary_a: str | None = None, model_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs.

    A link is a token of A and one of B that end at the same byte. n_best counts the links of a row whose id pair is linked at least as often,
    over all rows, as any other pair with the same id of B; count_sum adds up those corpus-wide numbers. Texts that are null or empty, or
    whose tokens do not spell the text, have zeros and an empty digest. Each row counts, also repeated ones and those with a null id.

    Tokens that end together share their last bytes: one is a suffix of the other. So the number of different pairs is bounded by the
    vocabularies (each token with the suffixes of it that are tokens), whatever the corpus, and so is the table that tasks get.
    """
    spark = docs.sparkSession
    paths = vocabulary_a or default_vocabularies()[0], model_b or default_vocabularies()[1]
    both = aligner(*paths)
    rows = materialize(aligned(docs, *paths), "alignment")
    counts = pair_counts(rows, both.size_b).orderBy("pair").toArrow()
    if counts.num_rows > pair_bound(both):
        raise AssertionError("more id pairs than the vocabularies allow")
    table = spark.sparkContext.broadcast(tuple(counts.column(c).to_numpy() for c in ("pair", "n", "best")))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            each = times.flatten().to_numpy().astype(np.int64)
            ends = pairs.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]

            def total(values):
                upto = np.r_[0, np.cumsum(values)]
                return pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), total(each), total(each * best[at]),
                                              total(each * n[at]), batch.column("groups_sha256")],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def pair_bound(both: Aligner) -> int:
    """How many id pairs can end together at most: tokens of one side that are a suffix of a token of the other."""
    def suffixes(tokens, others):
        known: dict[bytes, int] = {}
        for t in others:
            known[t] = known.get(t, 0) + 1
        return sum(known.get(t[n:], 0) for t in tokens for n in range(len(t)))
    return suffixes(both.a_bytes, both.b_bytes) + suffixes(both.b_bytes, both.a_bytes)
