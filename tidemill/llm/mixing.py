"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source, in an order drawn by a seeded hash, form a stream of words that is cut into blocks of equal size. What a
source contributes is a number of blocks: whole passes over its stream and a part of one more. A tree deals these blocks
out: its root holds each source's exact quota, each node splits its quotas between its two halves of the output shards
by one multivariate-hypergeometric draw. The draws depend on seed and node only, so each shard walks from
the root to its leaf by itself and knows which part of a source's permuted blocks is its own; parts of different shards are
disjoint. `mix` gives each piece its shard and its place in the shard, by a seeded hash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, arrow_limits, materialize, mix64, mix64_array, with_row_id

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK = 256
SHARD_BLOCKS = 8192
SEED = 20_240
_WORDS = re.compile(WORD)
#: Documents of one source that are put in order together.
RUN = 4096


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words wanted of each source: `share` of all words by weight; what is above `most` times a source is shared out again."""
    left, open_, found = share * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    weight = [weights[n % len(weights)] for n in range(len(sizes))]
    while open_:
        unit = left / sum(weight[n] for n in open_)
        over = [n for n in open_ if weight[n] * unit > most * sizes[n]]
        if not over:
            for n in open_:
                found[n] = weight[n] * unit
            break
        for n in over:
            found[n] = most * sizes[n]
            left -= found[n]
        open_ = [n for n in open_ if n not in set(over)]
    return found


def hypergeometric(good: int, bad: int, take: int, u: float) -> int:
    """How many of `take` drawn from good + bad are good: the value at which the distribution passes u.

    The probabilities come from their exact ratios, outward from the most likely value, as far as they show in a double (twelve
    deviations); so the draw takes about as many steps as the deviation is wide, at any size.
    """
    least, most = max(0, take - bad), min(good, take)
    if least == most:
        return least
    total = good + bad
    mode = min(max((take + 1) * (good + 1) // (total + 2), least), most)
    deviation = math.sqrt(take * (good / total) * (bad / total) * max(total - take, 1) / max(total - 1, 1))
    reach = int(12 * deviation) + 40
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) / (k + 1)) + np.log((take - k) / (bad - take + k + 1))
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    weight = np.exp(weight - weight.max())
    upto = np.cumsum(weight)
    return low + int(min(np.searchsorted(upto, u * upto[-1], side="right"), high - low))


def node_draw(quotas: np.ndarray, take: int, seed: int) -> np.ndarray:
    """One multivariate-hypergeometric draw: source by source, each from what the sources behind it leave."""
    chance, left, rest = np.random.Generator(np.random.PCG64(seed)).random(len(quotas)), take, int(quotas.sum())
    found = np.zeros(len(quotas), np.int64)
    for n, own in enumerate(quotas.tolist()):
        rest -= own
        found[n] = hypergeometric(own, rest, left, float(chance[n]))
        left -= int(found[n])
    return found


def split_path(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) per source: the part of each source's quota that falls to a shard.

    A node over shards [low, high) with quotas q hands its left half as many blocks as its shards take in an even
    deal; which sources they come from is a multivariate-hypergeometric draw from q. `known` keeps the draws of the last
    path, of which a neighbouring shard shares most.
    """
    known, path = {} if known is None else known, {}
    low, high, first, q = 0, shards, np.zeros(len(quotas), np.int64), quotas.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = known.get((low, high))
        if left is None:
            total = int(q.sum())
            left = node_draw(q, total * (middle - low) // (high - low), mix64(seed * 1_000_003 + mix64(low * 2_147_483_659 + high)))
        path[low, high] = left
        if shard < middle:
            high, q = middle, left
        else:
            low, first, q = middle, first + left, q - left
    known.clear()
    known.update(path)
    return first, q


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of range(size): a four-round Feistel network, walked until the value falls into the range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low, value = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        left, right = value[todo] >> np.uint64(half), value[todo] & low
        for turn in range(4):
            left, right = right, left ^ (mix64_array(right + np.uint64(mix64(key * 16 + turn) >> 8)) & low)
        value[todo] = left << np.uint64(half) | right
        todo = todo[value[todo] >= np.uint64(size)]
    return value.astype(np.int64)


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """rid, doc_id, source, size, place: the rows to mix; place is their order within the source.

    The order is a hash of what a row holds, so reruns agree whatever the partitions; rows that are equal in all of it are
    interchangeable.
    """
    text = F.col("text").cast("string")
    return docs.select("rid", "doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id", F.col("source").cast("string"), F.xxhash64(text)).alias("place"))


def source_plan(rows: DataFrame, block: int = BLOCK) -> list[dict]:
    """One record per source, by code point, null last: words, target, blocks, quota.

    Sources come to the driver: a source has a weight in the mix, so their number is that of the mix's settings.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect()
    sources = [{"source": r.source, "words": int(r.words), "docs": int(r.docs)}
               for r in sorted(found, key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))]
    for n, (s, target) in enumerate(zip(sources, targets([s["words"] for s in sources]))):
        s |= {"no": n, "target": target, "blocks": -(-s["words"] // block), "runs": -(-s["docs"] // RUN)}
        s["quota"] = quota(s["words"], target, s["blocks"])
    return sources


def placed(rows: DataFrame, sources: list[dict]) -> DataFrame:
    """rid, doc_id, source, size, no, start: start is the number of words of the source before the document.

    A source is cut into runs by the leading bits of the hash, so that none is put in order by one task; the runs' totals
    give each run its start.
    """
    known = rows.sparkSession.createDataFrame([(s["source"], s["no"], s["runs"]) for s in sources], "name string, no int, runs long")
    rows = (rows.join(F.broadcast(known), rows["source"].eqNullSafe(known["name"]))
            .withColumn("run", F.floor((F.col("place") / F.lit(2.0 ** 64) + 0.5) * F.col("runs")).cast("long")))
    runs = rows.groupBy("no", "run").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("no", "run", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("no", "run").orderBy("place", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(runs, ["no", "run"])
            .select("rid", "doc_id", "source", "size", "no", (F.col("base") + F.col("inner")).alias("start")))


def quota(words: int, target: float, blocks: int) -> int:
    """Blocks to take: whole passes, and of the last pass as many blocks as come nearest to what is left; at most two passes."""
    if not blocks:
        return 0
    passes = int(min(target // words, 2))
    rest = target - passes * words
    return min(passes * blocks + int(round(rest / words * blocks)), 2 * blocks)


def draw_blocks(spark, sources: list[dict], seed: int = SEED, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(shard, no, block, pass): the blocks of each output shard, drawn shard by shard in tasks."""
    quotas = np.array([s["quota"] for s in sources], np.int64)
    blocks = [s["blocks"] for s in sources]
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))

    def draws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, count = split_path(quotas, shards, shard, seed, known)
                for no in np.nonzero(count)[0].tolist():
                    at = np.arange(first[no], first[no] + count[no])
                    turn, inner = at // blocks[no], at % blocks[no]
                    found = np.concatenate([permuted(inner[turn == t], blocks[no], mix64(seed + no * 7 + t)) for t in np.unique(turn).tolist()])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard)), pa.array(np.full(len(at), no, np.int32)),
                                                      pa.array(found), pa.array(turn.astype(np.int32))], names=["shard", "no", "block", "pass"])

    tasks = min(shards, max(1, spark.sparkContext.defaultParallelism * 4))
    return spark.range(0, shards, 1, tasks).mapInArrow(draws, "shard long, no int, block long, pass int")


def mix(rows: DataFrame, block: int = BLOCK, seed: int = SEED, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame, list[dict]]:
    """(pieces, placed rows, sources) of rows made by sized().

    pieces: shard, place (the order within the shard), rid, doc_id, pass, first, last; a piece is the part [first, last) of a
    document's words that lies in a drawn block. Null texts have no words; documents without words are in no
    piece. Null sources form the last source. Repeated rows are documents of their own. Reruns agree.
    """
    spark = rows.sparkSession
    arrow_limits(spark)
    sources = source_plan(rows, block)
    if not sources:
        none, number = rows.filter("false"), F.lit(0).cast("long")
        return (none.select(number.alias("shard"), number.alias("place"), "rid", "doc_id", F.lit(0).alias("pass"), number.alias("first"), number.alias("last")),
                none.select("rid", "doc_id", "source", "size", F.lit(0).alias("no"), number.alias("start")), sources)
    where = materialize(placed(rows, sources), "mix-placed")
    drawn = draw_blocks(spark, sources, seed, shard_blocks)
    parts = where.filter("size > 0").select("rid", "doc_id", "no", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    low = F.col("block") * block
    pieces = parts.join(drawn, ["no", "block"]).select(
        "shard", F.xxhash64(F.lit(seed), "shard", "no", "block", "pass", "start").alias("place"), "rid", "doc_id", "pass",
        F.greatest(low - F.col("start"), F.lit(0)).alias("first"), F.least(low + block - F.col("start"), F.col("size")).alias("last"))
    return pieces, where, sources


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of docs; taken is summed from the pieces of the mix."""
    spark = docs.sparkSession
    rows = materialize(sized(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "source", "text")), "mix-sizes")
    pieces, where, sources = mix(rows)
    known = spark.createDataFrame([(s["no"], s["words"], float(s["target"])) for s in sources], "no int, source_size long, target double")
    taken = pieces.groupBy("rid").agg(F.sum(F.col("last") - F.col("first")).alias("words"))
    return (where.join(F.broadcast(known), "no").join(taken, "rid", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken")))


def stretches(text: str | None, pieces: list[tuple[int, int]]) -> list[str]:
    """The parts of a text that cover the given word ranges; ranges that touch make one part."""
    joined: list[list[int]] = []
    for first, last in sorted(pieces):
        if joined and joined[-1][1] >= first:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    spans = [m.span() for m in _WORDS.finditer(text or "")]
    if joined == [[0, len(spans)]]:
        return [text or ""]
    return [text[spans[first][0]:spans[last - 1][1]] for first, last in joined]


def _stretches(text: Column, pieces: Column) -> Column:
    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, parts in batches:
            yield pa.array([stretches(t, [(p["first"], p["last"]) for p in ps]) for t, ps in zip(texts.to_pylist(), parts.to_pylist())],
                           pa.list_(pa.string()))
    return cut(text, pieces)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of docs, all columns: the taken parts of a document's text, one row for each pass and stretch.

    A document that a pass takes whole is a row with its whole text; of one taken in part each stretch is a row, cut between words.
    n_chars, where docs has it, becomes the length of the row's text. Null texts and texts without words are in no mix; a null source is a
    source; ids may be null or repeated; repeated rows are documents of their own; an empty table gives no rows. The shards' order is not kept.
    """
    kept = with_row_id(docs, "mix-rows")
    rows = materialize(sized(kept.select("rid", "row.doc_id", "row.source", "row.text")), "mix-sizes")
    pieces, _, _ = mix(rows)
    taken = pieces.groupBy("rid", "pass").agg(F.collect_list(F.struct("first", "last")).alias("pieces"))
    cut = kept.join(taken, "rid").select("row", F.explode(_stretches(F.col("row.text").cast("string"), F.col("pieces"))).alias("cut"))
    fields = {"text": F.col("cut"), "n_chars": F.length("cut").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return cut.select(*[(fields[c] if c in fields else F.col("row")[c]).alias(c) for c in docs.columns])
