"""Token ids in raw binary shards, with a minimal perfect hash index from document keys to shard offsets.

Format of a folder:

* `shard-NNNNNN.bin`  ids of the documents of one shard, one after the other, little-endian unsigned 16 or 32 bits.
* `shard-NNNNNN.rec`  one record per document in the same order: first token (u64), number of tokens (u64).
* `index-NNNNNN.mph`  the keys of one hash range: a minimal perfect hash and, per slot, a 32-bit fingerprint of the key, shard and
  record of the key's first document, shard and record after its last one.

Shards hold the documents in ascending doc_id order (null first); NNNNNN ascends with them. Equal doc_ids lie next to each
other, so one index entry covers all rows of an id. All files are written by tasks under a name of the attempt and
renamed when complete, so a lost task is simply run again.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, file_system, materialize, mix64_array
from tidemill.session import work_path

END_ID = 2
#: Bytes of text per shard, about.
SHARD_BYTES = 32 << 20
#: Bytes of text that are encoded at a time, and estimated bytes of remembered pieces in one task.
SLICE_BYTES = 4 << 20
REMEMBERED_BYTES = 64 << 20
#: Unseen words that are encoded as one text.
TOGETHER = 32
KEYS_PER_INDEX = 65_536
GAMMA = 2.0
_CUT = re.compile(r" (?=[A-Za-z0-9À-ɏ])")
_ANY_SPACE = re.compile(r"\s")
_BREAK = re.compile(r"(?<=[A-Za-z.,;:!?])\n(?=[A-Za-zÀ-ɏ])")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library, with pieces of text remembered.

    The library's pre-tokenizer never joins what lies before a single space with a character after it that is no white space, so a
    text can be cut there and each piece encoded once. Texts with white space after a space are cut before letters and digits
    only. Tests compare with encoding whole texts. Memory is bounded: pieces that were not used for a while are forgotten, and all of
    them when a task ends.
    """

    def __init__(self, vocabulary: str, dtype: str, end_id: int, bound: int = REMEMBERED_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.dtype, self.kind, self.bound = dtype, {"<u2": "H", "<u4": "I"}[dtype], bound
        self.end = np.array([end_id], dtype).tobytes()
        names = self.tokenizer.get_vocab()
        # a byte-level token has a character for each of its bytes
        self.sizes = np.zeros(max(names.values()) + 1, np.int64)
        self.sizes[list(names.values())] = [*map(len, names)]
        self.forget()

    def forget(self) -> None:
        """Frees the remembered pieces."""
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian bytes, with the end id."""
        gc.disable()  # the many small lists of a batch are no cycles
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: pa.Array) -> list[bytes]:
        words = pc.split_pattern(texts, " ")
        ends = words.offsets.to_numpy()
        ends = ends - ends[0]
        coded = words.flatten().dictionary_encode()
        at, known = coded.indices.to_numpy(), coded.dictionary
        starts, rows = ends[:-1], len(texts)
        odd = pc.or_(pc.equal(pc.binary_length(known), 0), pc.match_substring_regex(known, "^[\\s\\x00-\\x20\\x7f-\\x{a0}\\pZ]")).to_numpy(zero_copy_only=False)[at]
        odd[starts] = False
        slow = {n: self._cut(texts[n].as_py()) for n in np.nonzero(np.add.reduceat(odd, starts) > 0)[0].tolist()} if rows else {}
        # a mark at the end of a word is a piece of its own, so that a word is encoded once whatever follows it
        marked = pc.match_substring_regex(known, "\\pL[.,;:!?]$")
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(known, 0, -1), known).dictionary_encode()
        tails = pc.if_else(marked, pc.utf8_slice_codeunits(known, -1), "").dictionary_encode()
        pieces, marks = [" " + k for k in cores.dictionary.to_pylist()], [*tails.dictionary.to_pylist(), ""]
        firsts = known.take(pa.array(at[starts])).to_pylist()
        ids = self._ids(set(pieces).union(firsts, marks, *slow.values()))
        # entries: words after a space without their mark, the first words of the texts, marks, the end id
        entries = [*map(ids.__getitem__, pieces), *map(ids.__getitem__, firsts), *map(ids.__getitem__, marks), self.end]
        base = len(pieces) + rows
        pair = np.stack([cores.indices.to_numpy(), np.int32(base) + tails.indices.to_numpy()], axis=1)[at]
        if rows:
            pair[starts, 0] = len(pieces) + np.arange(rows)
            pair[starts, 1] = base + marks.index("")
        size = np.fromiter(map(len, entries), np.int32, len(entries)) // np.int32(self.dtype[-1])
        order = np.insert(pair.ravel(), 2 * ends[1:], len(entries) - 1)
        # a slice has far fewer ids than 2 ** 31
        start, flat, count = np.cumsum(size, dtype=np.int32) - size, np.frombuffer(b"".join(entries), self.dtype), size[order]
        upto = np.cumsum(count, dtype=np.int32)
        tokens = flat[np.repeat(start[order] - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0, dtype=np.int32)]
        found = [part.tobytes() for part in np.split(tokens, upto[2 * ends[1:] + np.arange(rows)])[:rows]]
        for n, parts in slow.items():
            found[n] = b"".join(map(ids.__getitem__, parts)) + self.end
        return found

    def _ids(self, pieces: set[str]) -> dict[str, bytes]:
        """A table that holds the ids of each piece: those remembered and those encoded now."""
        if self.held > self.bound // 2:
            self.pieces, self.older, self.held = {}, self.pieces, 0
        now, older = self.pieces, self.older
        now.setdefault("", b"")
        again = pieces.difference(now).intersection(older)
        for piece in again:
            now[piece] = older[piece]
        new = pieces.difference(now)
        split = {p: self._parts(p) for p in new if "\n" in p}
        todo = new.difference(split).union(*split.values()).difference(now)
        # words after a space do not touch each other in one text either, which spares a call for each
        words = [p for p in todo if p[0] == " " and len(p) > 1 and not _ANY_SPACE.search(p, 1)]
        groups = [words[low:low + TOGETHER] for low in range(0, len(words), TOGETHER)]
        for low in range(0, len(groups), 64):
            some = groups[low:low + 64]
            for group, code in zip(some, self.tokenizer.encode_batch_fast(["".join(g) for g in some], add_special_tokens=False)):
                self._part(group, np.array(code.ids, self.dtype))
        todo = list(todo.difference(now))
        for low in range(0, len(todo), 2048):
            some = todo[low:low + 2048]
            for piece, code in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                now[piece] = array(self.kind, code.ids).tobytes()
                self.held += 2 * len(piece)
        for piece, some in split.items():
            now[piece] = b"".join(map(now.__getitem__, some))
        self.held += 260 * (len(again) + len(new))
        return now

    def _part(self, words: list[str], ids: np.ndarray) -> None:
        """Remembers the ids of each of the words that were encoded as one text; not if a token crosses their bounds."""
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        upto = np.cumsum(self.sizes[ids])
        at = np.searchsorted(upto, ends)
        if len(upto) and upto[-1] == ends[-1] and (upto[at] == ends).all():
            code, width, start = ids.tobytes(), int(self.dtype[-1]), 0
            self.held += len(code)
            for word, stop in zip(words, ((at + 1) * width).tolist()):
                self.pieces[word] = code[start:stop]
                start = stop

    @staticmethod
    def _parts(piece: str) -> list[str]:
        """A piece cut around single line breaks between words."""
        first, *rest = _BREAK.split(piece)
        return [first, *(x for r in rest for x in ("\n", r))]

    @staticmethod
    def _cut(text: str) -> list[str]:
        first, *rest = _CUT.split(text)
        return [first, *[" " + r for r in rest]]


_encoders: dict[tuple, Encoder] = {}


def encoder(vocabulary: str, dtype: str, end_id: int) -> Encoder:
    """One encoder for each worker process, so that a vocabulary is read once."""
    key = (vocabulary, dtype, end_id)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def slices(batch: pa.RecordBatch, column: int, size: int, most: int = 1024) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most about `size` bytes of one text column and `most` rows."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()) // size
    for low, high in pairwise([0, *(np.nonzero(np.diff(upto))[0] + 1).tolist(), batch.num_rows]):
        for at in range(low, high, most):
            yield batch.slice(at, min(most, high - at))


def id_type(vocabulary: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"


def _publish(files, temporary: str, final: str) -> None:
    files.move(temporary, final)


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards of docs (doc_id, text) into folder; (doc_id, shard, record, first, n_tokens), one row per row of docs.

    A null text counts as empty and gets the end id only. Equal doc_ids are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    dtype = id_type(vocabulary)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // shard_bytes))
    # equal ids are spread by what follows in the order, so one id may fill several shards
    order = ["doc_id", F.xxhash64("text"), F.pmod(F.monotonically_increasing_id(), F.lit(1024))]
    keyed = rows.select("doc_id", "text", order[1].alias("t"), order[2].alias("s"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "t", "s").sortWithinPartitions("doc_id", "t", "s").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        shard, coder = context.partitionId(), encoder(vocabulary, dtype, end_id)
        files, base = file_system(folder)
        name = f"{base}/shard-{shard:06d}"
        attempt = f"{name}.attempt-{context.taskAttemptId()}"
        width, at, record, out, records = int(dtype[-1]), 0, 0, None, []
        try:
            for part in (p for batch in batches for p in slices(batch, 1, SLICE_BYTES)):
                if out is None:
                    out = files.open_output_stream(attempt + ".bin")
                counts = []
                for ids in coder.encode(part.column(1)):
                    out.write(ids)
                    counts.append(len(ids) // width)
                n = np.array(counts, np.int64)
                first = at + np.cumsum(n) - n
                records.append(np.stack([first, n], axis=1).astype("<u8").tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(n), shard, np.int32)), pa.array(record + np.arange(len(n))),
                                                  pa.array(first), pa.array(n)], names=["doc_id", "shard", "record", "first", "n_tokens"])
                at, record = at + int(n.sum()), record + len(n)
        finally:
            coder.forget()
        if out is not None:
            out.close()
            with files.open_output_stream(attempt + ".rec") as recs:
                recs.write(b"".join(records))
            _publish(files, attempt + ".rec", name + ".rec")
            _publish(files, attempt + ".bin", name + ".bin")

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(ordered.mapInArrow(write, f"doc_id {kind}, shard int, record long, first long, n_tokens long"), "token-records")


# --- minimal perfect hash -------------------------------------------------------------------------------------------

@dataclass
class PerfectHash:
    """A minimal perfect hash of 128-bit keys by levels of bit arrays.

    At each level a key whose position no other key of the level shares sets its bit; the rest go on to the next level. A key's
    slot is the number of set bits before its own. About GAMMA * 1.6 bits a key.
    """

    sizes: np.ndarray
    words: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64_array(h1 ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) + h2) % np.uint64(size)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, gamma: float = GAMMA) -> PerfectHash:
        sizes, bits = [], []
        for level in range(64):
            if not len(h1):
                break
            size = max(64, int(gamma * len(h1)) + 63 & ~63)
            at = cls.place(h1, h2, level, size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        if len(h1):
            raise ValueError("equal keys have no perfect hash")
        words = np.concatenate(bits) if bits else np.zeros(0, np.uint64)
        ranks = np.cumsum(np.bitwise_count(words)) - np.bitwise_count(words)
        return cls(np.array(sizes, np.uint64), words, ranks.astype(np.uint64))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level holds it (then it is no key)."""
        found, todo, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self.place(h1[todo], h2[todo], level, size).astype(np.int64)
            word, bit = base + at // 64, (at % 64).astype(np.uint64)
            here = self.words[word] >> bit & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[todo[here]] = (self.ranks[word] + np.bitwise_count(below)).astype(np.int64)[here]
            todo, base = todo[~here], base + size // 64
        return found


_HEAD = struct.Struct("<4sIQQQ")  # mark, levels, words, keys, reserved
_SLOT = np.dtype([("fp", "<u4"), ("shard", "<u4"), ("record", "<u8"), ("last_shard", "<u4"), ("pad", "<u4"), ("last_record", "<u8")])


def fingerprints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (mix64_array(h2 ^ (h1 << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def index_bytes(h1, h2, entries) -> bytes:
    """One index file: head, level sizes, bit words, ranks, slots."""
    found = PerfectHash.build(h1, h2)
    slots = np.zeros(len(h1), _SLOT)
    at = found.slots(h1, h2)
    slots["fp"][at] = fingerprints(h1, h2)
    for name, values in entries.items():
        slots[name][at] = values
    return b"".join([_HEAD.pack(b"MPH1", len(found.sizes), len(found.words), len(h1), 0), found.sizes.astype("<u8").tobytes(),
                     found.words.astype("<u8").tobytes(), found.ranks.astype("<u8").tobytes(), slots.tobytes()])


def load_index(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    _, levels, words, keys, _ = _HEAD.unpack_from(data)
    at = _HEAD.size
    parts = []
    for n in (levels, words, words):
        parts.append(np.frombuffer(data, "<u8", n, at))
        at += 8 * n
    return PerfectHash(*parts), np.frombuffer(data, _SLOT, keys, at)


def lookup(index: tuple[PerfectHash, np.ndarray], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, known): each key's entry by one hash walk; a key whose fingerprint differs from the stored one is unknown."""
    hashes, slots = index
    at = hashes.slots(h1, h2)
    entries = slots[np.maximum(at, 0)] if len(slots) else np.zeros(len(h1), _SLOT)
    return entries, (at >= 0) & (entries["fp"] == fingerprints(h1, h2)) & bool(len(slots))


def key_hashes(key: str = "doc_id") -> list[Column]:
    """128 bits of a key; null is a key like any other."""
    text = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit("second")).alias("h2")]


def range_of(parts: int) -> Column:
    """The index file of a key."""
    return F.pmod(F.col("h1"), F.lit(parts)).cast("int").alias("range")


def write_index(records: DataFrame, folder: str, keys_per_index: int = KEYS_PER_INDEX) -> int:
    """Writes the index files of the records' keys; the number of files."""
    keys = records.groupBy("doc_id").agg(F.min(F.struct("shard", "record")).alias("a"), F.max(F.struct("shard", "record")).alias("b"))
    keys = materialize(keys.select(*key_hashes(), F.col("a.shard").alias("shard"), F.col("a.record").alias("record"),
                                   F.col("b.shard").alias("last_shard"), (F.col("b.record") + 1).alias("last_record")), "token-keys")
    parts = max(1, -(-keys.count() // keys_per_index))

    def write(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        from pyspark import TaskContext
        files, base = file_system(folder)
        name = f"{base}/index-{key[0].as_py():06d}"
        attempt = f"{name}.attempt-{TaskContext.get().taskAttemptId()}"
        data = {c: rows.column(c).to_numpy() for c in rows.column_names}
        with files.open_output_stream(attempt) as out:
            out.write(index_bytes(data["h1"].view(np.uint64), data["h2"].view(np.uint64),
                                  {c: data[c] for c in ("shard", "record", "last_shard", "last_record")}))
        _publish(files, attempt, name + ".mph")
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([rows.num_rows], pa.int64())})

    done = keys.select("*", range_of(parts)).groupBy("range").applyInArrow(write, "range int, keys long")
    done.agg(F.sum("keys")).collect()
    return parts


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
                 keys_per_index: int = KEYS_PER_INDEX) -> dict:
    """Encodes docs (doc_id, text) into folder: shards, record tables, index. Returns what a reader needs to know.

    The result's `shards` is a table (shard, records, tokens, base), base being the ids of all shards before it.
    """
    vocabulary = vocabulary or default_vocabulary()
    if folder.startswith("file:") or "://" not in folder:
        os.makedirs(file_system(folder)[1], exist_ok=True)
    else:
        file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    records = write_shards(docs, folder, vocabulary, end_id, shard_bytes)
    parts = write_index(records, folder, keys_per_index)
    return {"folder": folder, "dtype": id_type(vocabulary), "indexes": parts, "records": records}


def get(layout: dict, key, spark: SparkSession) -> list[np.ndarray]:
    """The ids of every row of one document key, by constant-time access; an empty list for an unknown key."""
    h = spark.range(1).select(F.lit(key).cast("string").alias("doc_id")).select(*key_hashes()).first()
    h1, h2 = (np.array([v], np.int64).view(np.uint64) for v in (h.h1, h.h2))
    files, base = file_system(layout["folder"])
    part = int(np.array([h.h1])[0] % layout["indexes"])
    info = files.get_file_info(f"{base}/index-{part:06d}.mph")
    if not info.is_file:
        return []
    with files.open_input_file(info.path) as f:
        entries, known = lookup(load_index(f.read()), h1, h2)
    if not known[0]:
        return []
    e, found = entries[0], []
    for shard in range(int(e["shard"]), int(e["last_shard"]) + 1):
        low = int(e["record"]) if shard == e["shard"] else 0
        high = int(e["last_record"]) if shard == e["last_shard"] else None
        found += [np.frombuffer(ids, layout["dtype"]) for _, ids in read_records(files, base, shard, low, high, layout["dtype"])]
    return found


def read_records(files, base: str, shard: int, low: int, high: int | None, dtype: str):
    """(first token, payload) of the records [low, high) of a shard; high None: to the shard's end. Reads that part only."""
    width, name = int(dtype[-1]), f"{base}/shard-{shard:06d}"
    with files.open_input_file(name + ".rec") as rec, files.open_input_file(name + ".bin") as data:
        high = rec.size() // 16 if high is None else high
        for at in range(low, high, 4096):
            table = np.frombuffer(rec.read_at(16 * (min(high, at + 4096) - at), 16 * at), "<u8").reshape(-1, 2)
            for first, count in table.tolist():
                yield first, data.read_at(width * count, width * first)


def read_tokens(keys: DataFrame, layout: dict) -> DataFrame:
    """(doc_id, shard, first, n_tokens, ids_crc32): the rows stored under each key of keys (doc_id, distinct), read through the index.

    crc32 is that of the ids as little-endian unsigned 32-bit integers. Keys that the index does not hold give no rows.
    """
    spark, folder, dtype, parts = keys.sparkSession, layout["folder"], layout["dtype"], layout["indexes"]
    arrow_limits(spark)
    kind = keys.schema["doc_id"].dataType.simpleString()

    def find(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        files, base = file_system(folder)
        with files.open_input_file(f"{base}/index-{key[0].as_py():06d}.mph") as f:
            index = load_index(f.read())
        entries, known = lookup(index, rows.column("h1").to_numpy().view(np.uint64), rows.column("h2").to_numpy().view(np.uint64))
        entries = entries[known]
        return pa.table([rows.column("doc_id").filter(pa.array(known))] + [pa.array(entries[c].astype(np.int64)) for c in
                                                                          ("shard", "record", "last_shard", "last_record")],
                        names=["doc_id", "shard", "record", "last_shard", "last_record"])

    found = keys.select("doc_id", *key_hashes()).select("*", range_of(parts)).groupBy("range").applyInArrow(
        find, f"doc_id {kind}, shard long, record long, last_shard long, last_record long")
    # an id with very many rows may fill several shards: each is read by its own task
    pieces = found.select("doc_id", "shard", "record", "last_shard", "last_record", F.explode(F.sequence("shard", "last_shard")).alias("at")).select(
        "doc_id", F.col("at").alias("shard"), F.when(F.col("at") == F.col("shard"), F.col("record")).otherwise(0).alias("low"),
        F.when(F.col("at") == F.col("last_shard"), F.col("last_record")).alias("high"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        for batch in batches:
            ids, shards, lows, highs = (batch.column(n) for n in range(4))
            out = [[], [], [], [], []]
            for row, (shard, low, high) in enumerate(zip(shards.to_pylist(), lows.to_pylist(), highs.to_pylist())):
                for first, payload in read_records(files, base, shard, low, high, dtype):
                    values = np.frombuffer(payload, dtype)
                    for column, value in zip(out, (row, shard, first, len(values), zlib.crc32(values.astype("<u4").tobytes()))):
                        column.append(value)
                    if len(out[0]) >= 10_000:
                        yield _batch(ids, out)
                        out = [[], [], [], [], []]
            yield _batch(ids, out)

    return pieces.repartition("shard", F.floor(F.col("low") / 65_536)).sortWithinPartitions("shard", "low").mapInArrow(
        read, f"doc_id {kind}, shard long, first long, n_tokens long, ids_crc32 long")


def _batch(ids: pa.Array, out: list[list[int]]) -> pa.RecordBatch:
    rows, *rest = (pa.array(c, pa.int64()) for c in out)
    return pa.RecordBatch.from_arrays([ids.take(rows), *rest], names=["doc_id", "shard", "first", "n_tokens", "ids_crc32"])


def token_report(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of docs, written to the file format and read back through the index.

    start counts the ids of all documents before it in ascending doc_id order (null first; equal ids by a hash of their text).
    Null text: the end id alone. Empty table: no rows.
    """
    spark = docs.sparkSession
    layout = write_tokens(docs, folder or work_path(spark, "llm-tokens"), vocabulary)
    shards = layout["records"].groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    # one row per shard: their running total is the only step in one task
    from pyspark.sql import Window
    base = shards.select(F.col("shard").cast("long").alias("shard"), F.coalesce(F.sum("tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    keys = layout["records"].select("doc_id").distinct()
    return read_tokens(keys, layout).join(base, "shard").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
