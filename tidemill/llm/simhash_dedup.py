"""SimHash near-duplicate groups, with pairs discarded by a table of distances to reference fingerprints.

Candidates come from bit blocks: fingerprints that differ in at most `radius` bits agree on at least two of
radius + 2 blocks, so each distinct fingerprint is entered once per pair of blocks. Within such a cell the pivot
table decides: by the triangle inequality two linked fingerprints have distances to any reference fingerprint that
differ by at most `radius`, so a pair whose largest coordinate difference is above that is discarded; survivors are
verified on all 64 bits. A cell emits a spanning forest of its links, never its pairs; a large cell is cut
into chunks, and pairs of chunks are compared in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import MASK, arrow_limits, materialize, mix64, with_row_id
from tidemill.llm.graph import components

SHINGLE = 3
SEED = 42
RADIUS = 3
PIVOTS = 32
CHUNK = 1024


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash of one text; 0 without words. Bit k is bit k of the unsigned XXH64 of the shingles."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    hashes = [digest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])]
    count, total = len(hashes), np.zeros(64, np.int64)
    for at in range(0, count, 65536):
        block = np.array(hashes[at:at + 65536], dtype="<u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def fingerprint(text: Column) -> Column:
    """The SimHash of a text column as a signed long."""
    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.fromiter((fingerprint_of(t.as_py()) for t in batch), np.uint64, len(batch))
            yield pa.array(values.view(np.int64))
    return simhash(text.cast("string"))


def block_masks(radius: int = RADIUS) -> list[int]:
    """Masks of all pairs out of radius + 2 blocks, as signed 64-bit numbers."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [((1 << high) - (1 << low)) & MASK for low, high in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (a | b for a, b in combinations(blocks, 2))]


def references(count: int = PIVOTS) -> list[int]:
    """The reference fingerprints: fixed pseudo-random 64-bit numbers."""
    return [mix64(1000 + k) for k in range(count)]


def link_cells(cell, prints, chunk, crossing, radius: int = RADIUS):
    """Links within runs of equal `cell` (sorted), as positions of a spanning forest of each run.

    crossing: a run that compares two chunks tests pairs of different chunks only.
    """
    count = len(cell)
    table = np.bitwise_count(prints[:, None] ^ np.array(references(), np.uint64)[None, :]).astype(np.int8)
    root = np.arange(count)
    at = np.arange(count)
    left, right = [], []
    for shift in range(1, count):
        at = at[at + shift < count]
        at = at[cell[at] == cell[at + shift]]
        if not len(at):
            break
        x = at[(root[at] != root[at + shift]) & ~(crossing[at] & (chunk[at] == chunk[at + shift]))]
        for part in (slice(0, 8), slice(8, None)):
            x = x[np.abs(table[x, part] - table[x + shift, part]).max(axis=1, initial=0) <= radius]
        x = x[np.bitwise_count(prints[x] ^ prints[x + shift]) <= radius]
        for i in x.tolist():
            a, b = i, i + shift
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + shift)
        if len(x):
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return left, right


def _link_tasks(batches: Iterator) -> Iterator:
    """Runs over rows sorted by cell; a run that continues in the next batch waits for it."""
    def links(rows):
        keys = rows.select(["t", "k", "i", "j"])
        cols = [keys.column(n).to_numpy() for n in range(4)]
        new = np.zeros(rows.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        prints = rows.column("fp").to_numpy().astype(np.int64)
        a, b = link_cells(np.cumsum(new), prints.view(np.uint64), rows.column("c").to_numpy(), cols[2] != cols[3])
        return pa.RecordBatch.from_arrays([pa.array(prints[a]), pa.array(prints[b])], names=["a", "b"])

    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([kept, table]).combine_chunks() if kept is not None else table
        if table.num_rows == 0:
            continue
        last = [table.column(n)[-1].as_py() for n in ("t", "k", "i", "j")]
        same = np.ones(table.num_rows, bool)
        for n, v in zip(("t", "k", "i", "j"), last):
            same &= table.column(n).to_numpy() == v
        cut = int(np.argmax(same))
        if cut:
            yield links(table.slice(0, cut).combine_chunks())
        kept = table.slice(cut)
    if kept is not None and kept.num_rows:
        yield links(kept.combine_chunks())


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between the distinct fingerprints of column fp, enough to connect every linked group."""
    arrow_limits(prints.sparkSession)
    fp = F.col("fp")
    cells = prints.select(fp, F.explode(F.array(*[
        F.struct(F.lit(n).alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for n, m in enumerate(block_masks(radius))
    ])).alias("x")).select("fp", "x.t", "x.k")
    shared = cells.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = (cells.join(shared, ["t", "k"])
            .select("t", "k", "fp", parts.alias("s"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("c"))
            .select("t", "k", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("o"))
            .select("t", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "fp"))
    sorted_rows = rows.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j", "fp")
    return sorted_rows.mapInArrow(_link_tasks, "a long, b long").distinct()


def near_duplicates(prints: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """(fp, least): each distinct fingerprint with the smallest key of its group.

    prints holds one row per document: fp and key. A fingerprint links to every other within `radius` bits, groups are
    what links reach. Null keys count only where a group has no other.
    """
    found = prints.groupBy("fp").agg(F.min(key).alias("own"))
    found = materialize(found, "prints")
    group = components(fingerprint_links(found.select("fp"), radius), "a", "b")
    linked = group.join(found, group["node"] == found["fp"]).select("fp", "component", "own")
    least = linked.groupBy("component").agg(F.min("own").alias("low"))
    low = linked.join(least, "component").select("fp", "low")
    return found.join(low, "fp", "left").select("fp", F.when(F.col("low").isNull(), F.col("own")).otherwise(F.col("low")).alias("least"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach, itself included).

    Rows: one per row of docs, repeated rows too. Null text: fingerprint zero, as for a text without words. Null doc_id: kept, never
    the smallest unless the whole group has null ids. Other columns are ignored. Empty table: no rows.
    """
    arrow_limits(docs.sparkSession)
    prints = materialize(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "simhash")
    least = near_duplicates(prints, "doc_id")
    return prints.join(least, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, the one with the smallest doc_id; all columns of docs, also where names clash with ours.

    Of repeated rows with that id one stays.
    """
    arrow_limits(docs.sparkSession)
    rows = with_row_id(docs, "simhash-rows")
    prints = materialize(rows.select("rid", F.col("row.doc_id").alias("doc_id"), fingerprint(F.col("row.text")).alias("fp")), "simhash")
    # an id is unique and orders as (null last, doc_id, row)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    kept = near_duplicates(prints.select("fp", order.alias("order")), "order").select(F.col("least.rid").alias("rid")).distinct()
    return rows.join(kept, "rid", "left_semi").select("row.*")
