"""Ranked lexical search: presence masks of an item's terms group the documents of a block, masks are scored from the highest bound down.

A first pass counts terms and keeps, for each document, which benchmark terms it holds how often. A second pass goes through blocks of documents. For each
term of the benchmark a bitmap says which documents of the block hold it; the bitmaps of an item's terms, turned round, give each document a mask of
matched terms. Documents with one mask share an upper bound of their score (for each matched term the largest part that any document of the block
gets from it). Distinct masks are scored in descending order of that bound, until the bound is below the score of the last place so far: no document
with a mask that is left out can enter. Each task returns its best documents of each item; the best of all tasks are the result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, materialize

PLACES = 10
#: Documents of a block.
BLOCK = 8192
#: The benchmark is sent to every task; beyond so many bytes of text it is searched in several passes.
PASS_BYTES = 4 << 20
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters, digits and all that is not ASCII, A-Z in lower case."""
    return data.translate(_TERM_BYTES).split()


def item_parts(benchmark: DataFrame, pass_bytes: int) -> Iterator[DataFrame]:
    """The benchmark in parts of about `pass_bytes` of text, rows equal in id and text once, with `item`, their number in the part's order."""
    rows = materialize(benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct(), "lexical-items")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // pass_bytes))
    keyed = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    for part in range(parts):
        yield keyed.filter(F.col("part") == part).drop("part")


class Items:
    """The items of one pass as numbers of their terms and how often each occurs."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[bytes, int] = {}
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            count = Counter(terms_of(text.encode("utf-8", "surrogatepass")))
            ids = [self.numbers.setdefault(t, len(self.numbers)) for t in count]
            self.terms.append((np.array(ids, np.int64), np.array(list(count.values()), np.int64)))


def postings(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n (terms with repeats), terms and times (numbers of the known terms and how often the row has each)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            n, terms, times, ends = [], [], [], [0]
            for text in batch.column(1).cast(pa.binary()):
                found = terms_of(text.as_py() or b"")
                n.append(len(found))
                for term, often in Counter(filter(known.__contains__, found)).items():
                    terms.append(known[term])
                    times.append(often)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                                              pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], names=["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, times array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Block:
    """The postings of some documents, by term, with a bitmap for each term."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, documents: int, length: int):
        self.rows = len(n)
        size = np.array([25 + 75 * k * documents // length for k in n.tolist()], np.int64)
        order = np.lexsort((doc, term))
        self.doc, times = doc[order], times[order]
        self.part = 1_000_000_000 * times // (1000 * times + 8 * size[self.doc])
        self.terms, self.start = np.unique(term[order], return_index=True)
        self.end = np.r_[self.start[1:], len(order)]
        self.most = np.maximum.reduceat(self.part, self.start) if len(order) else self.part
        self.key = np.repeat(np.arange(len(self.terms)), self.end - self.start) * self.rows + self.doc
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, at: int) -> np.ndarray:
        """The bits of the documents that hold the term; kept, as items share terms."""
        if at not in self.bitmaps:
            bits = np.zeros(self.rows, np.uint8)
            bits[self.doc[self.start[at]:self.end[at]]] = 1
            self.bitmaps[at] = np.packbits(bits)
        return self.bitmaps[at]

    def best(self, terms: np.ndarray, worth: np.ndarray, floor: int, places: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of at least all documents that score `floor` or more and are among the block's first `places`, ties included."""
        at = np.searchsorted(self.terms, terms)
        here = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms) if len(self.terms) else np.zeros(len(terms), bool)
        at, worth = at[here], worth[here]
        keep = worth > 0
        at, worth = at[keep], worth[keep]
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # bitmaps of terms over documents, turned into masks of documents over terms
        held = np.unpackbits(np.stack([self.bitmap(a) for a in at.tolist()]), axis=1, count=self.rows)
        masks = np.ascontiguousarray(np.packbits(held, axis=0).T)
        distinct, group = np.unique(masks.view(np.dtype((np.void, masks.shape[1]))).ravel(), return_inverse=True)
        bits = np.unpackbits(distinct.view(np.uint8).reshape(len(distinct), -1), axis=1, count=len(at)).astype(np.int64)
        bound = bits @ (worth * self.most[at])
        members = np.argsort(group, kind="stable")
        first = np.r_[0, np.cumsum(np.bincount(group, minlength=len(distinct)))]
        order = np.argsort(-bound, kind="stable")
        docs, scores, low, floor = [], [], 0, max(floor, 1)
        while low < len(order) and bound[order[low]] >= floor:
            # masks whose documents fill the places, more of them each time
            high = min(len(order), low + max(places, low))
            some = order[low:high][bound[order[low:high]] >= floor]
            found = np.concatenate([members[first[g]:first[g + 1]] for g in some.tolist()])
            score = self.score(found, at, worth)
            docs.append(found)
            scores.append(score)
            every = np.concatenate(scores)
            if len(every) >= places:
                floor = max(floor, int(np.partition(every, len(every) - places)[len(every) - places]))
            low = high
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        keep = scores >= floor
        return docs[keep], scores[keep]

    def score(self, docs: np.ndarray, at: np.ndarray, worth: np.ndarray) -> np.ndarray:
        wanted = at[:, None] * self.rows + docs[None, :]
        place = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return (np.where(self.key[place] == wanted, self.part[place], 0) * worth[:, None]).sum(axis=0)


def _first(rows: list[tuple], places: int) -> list[tuple]:
    """The best of (score, doc_id) rows: high scores first, then small ids, null before all."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] if r[1] is not None else 0))[:places]


def rank_part(docs: DataFrame, items: DataFrame, places: int, block: int) -> DataFrame:
    """The ranking for one part of the benchmark."""
    spark = docs.sparkSession
    rows = items.orderBy("item_id", "text").toArrow()
    item_ids, known = rows.column("item_id"), Items(rows.column("text").to_pylist())
    held = materialize(postings(docs, spark.sparkContext.broadcast(known.numbers)), "lexical-postings")
    totals = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    holding = {r.term: r.n for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    documents, length = totals.documents or 0, totals.length or 0
    weights = np.array([weight(documents, holding.get(t, 0)) for t in range(len(known.numbers))], np.int64)
    sent = spark.sparkContext.broadcast([(t, weights[t] * often) for t, often in known.terms])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = defaultdict(list)
        floors: dict[int, int] = defaultdict(int)
        id_kind = None
        for ids, n, doc, term, times in blocks(batches, block):
            id_kind = ids.type
            part = Block(n, doc, term, times, documents, length)
            for item, (terms, worth) in enumerate(sent.value):
                rows, scores = part.best(terms, worth, floors[item], places)
                if len(rows):
                    found = list(zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist()))
                    best[item] = _first(best[item] + found, places)
                    if len(best[item]) == places:
                        floors[item] = best[item][-1][0]
        if id_kind is not None:
            flat = [(item, i, score) for item, some in best.items() for score, i in some]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], id_kind),
                                              pa.array([f[2] for f in flat], pa.int64())], names=["item", "doc_id", "score"])

    found = held.filter("size(terms) > 0").mapInArrow(rank, f"item int, doc_id {kind}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= places)
    named = spark.createDataFrame(pa.table({"item": pa.array(range(len(item_ids)), pa.int32()), "item_id": item_ids}))
    return top.join(named, "item").select("item_id", "rank", "doc_id", "score")


def blocks(batches: Iterator[pa.RecordBatch], size: int):
    """(ids, n, document, term, times) of up to about `size` documents at a time."""
    waiting, rows = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, size):
            waiting.append(batch.slice(low, size))
            rows += waiting[-1].num_rows
            if rows >= size:
                yield _block(waiting)
                waiting, rows = [], 0
    if waiting:
        yield _block(waiting)


def _block(waiting: list[pa.RecordBatch]):
    table = pa.Table.from_batches(waiting).combine_chunks()
    terms, times = table.column("terms").combine_chunks(), table.column("times").combine_chunks()
    ends = terms.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(table.num_rows), np.diff(ends))
    return (table.column("doc_id").combine_chunks(), table.column("n").to_numpy(), doc,
            terms.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy())


def ranked_documents(docs: DataFrame, benchmark: DataFrame, places: int = PLACES, pass_bytes: int = PASS_BYTES, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each benchmark item, from rank 1, equal scores by ascending doc_id (null first).

    A document's score adds up, over the item's terms with repeats, a term's weight times its share in the document; both fall with frequency in
    the corpus and length of the document, all in integers. Only scores above 0 are returned. Each row of docs is a document, also repeated ones
    and those with a null id; null text has no terms. Benchmark rows equal in id and text are one item; rows that share an id and differ in text
    are ranked apart. Null ids are ids like others; items without a term, and an empty table on either side, give no rows.

    What tasks get is a part of the benchmark of at most about `pass_bytes` of text; a larger benchmark is searched in several passes.
    """
    arrow_limits(docs.sparkSession)
    results = [materialize(rank_part(docs, items, places, block), "lexical-ranks") for items in item_parts(benchmark, pass_bytes)]
    whole = results[0]
    for part in results[1:]:
        whole = whole.union(part)
    return whole


#: The same in SQL.
LEXICAL_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS l FROM d),
wanted AS (SELECT item, item_id, term, count(*) AS often FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weighted AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term),
sized AS (SELECT r, doc_id, 25 + (75 * len(terms) * n_docs) // l AS m FROM d, totals WHERE l > 0),
scored AS (SELECT item, item_id, r, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM wanted JOIN held USING (term) JOIN weighted USING (term) JOIN sized USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
