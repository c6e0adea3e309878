"""Substring dedup: paragraphs that are near copies of each other, and passages that paragraphs share.

A paragraph is a line of a text. Equal paragraphs are one group by their hash; distinct ones meet through MinHash
bands tuned for recall, colliding ones are verified by the exact Jaccard similarity of their five-word shingles, and
connected components form the groups. Lines too short for a shingle are compared by their hash alone. A passage is a paragraph that
line breaks do not show: windows of PASSAGE words of the whole text, line breaks ignored, that start at positions chosen by content
alone (the least shingle hash of every NEIGHBOURS) are seeds. A run of LEAST_PASSAGE words always holds a seed chosen by its own words;
the runs whose seed occurs again are compared for equality at every place, and repeated runs that touch are joined. This marks
exactly the words of all runs of LEAST_PASSAGE words that occur twice, in two documents or in one. One occurrence of each group stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import WORD, WordHashes, arrow_limits, materialize, mix64, mix64_array, remove, shingle_hashes, store, with_row_id
from tidemill.llm.graph import components

SHINGLE, SIMILARITY = 5, 0.8
#: Lines with fewer words are left alone: those without any.
LEAST_WORDS = 1
#: An anchor lies among any NEIGHBOURS + SHINGLE - 1 words, and NEIGHBOURS - 1 + PASSAGE words hold its whole window: 50 words.
PASSAGE, NEIGHBOURS = 16, 35
LEAST_PASSAGE = NEIGHBOURS - 1 + PASSAGE
RECALL = 0.9995
CHUNK = 512
LINE, SEED = 0, 1
#: Texts whose words are handled together.
STEP = 256
_WORD = re.compile(WORD)


def tune(threshold: float = SIMILARITY, recall: float = RECALL, most: int = 8) -> tuple[int, int]:
    """(bands, rows): the longest bands of which at most `most` make two paragraphs at the threshold collide with the recall wanted."""
    for rows in range(8, 0, -1):
        for bands in range(1, most + 1):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches this recall with so few bands")


@dataclass
class Words:
    """The words of some texts, one after the other: hash, place in their text, and the lines and texts they form."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    line_first: np.ndarray  # place of a line's first word, and of the one after its last
    line_last: np.ndarray
    line_text: np.ndarray  # number of the text
    line_start: np.ndarray  # code points
    line_end: np.ndarray
    text_first: np.ndarray  # as for lines; texts without words are left out
    text_last: np.ndarray
    text_number: np.ndarray


def _plain(text: str) -> bool:
    """Whether single blanks and line breaks are all the white space there is between words."""
    return not ("  " in text or "\n " in text or " \n" in text or "\t" in text or "\r" in text or "\v" in text or "\f" in text
                or text[:1] == " " or text[-1:] == " ")


def words_of(texts: list[str | None], known: WordHashes) -> Words:
    """All words of the texts, and the lines that have one."""
    tokens: list[str] = []
    starts, lines = [], []
    odd: list[tuple[int, list[int]]] = []
    for n, text in enumerate(texts):
        if not text:
            continue
        plain, at = _plain(text), 0
        for line in text.split("\n"):
            if plain:
                found = line.split(" ")
            else:
                spans = [m.span() for m in _WORD.finditer(line)]
                found = [line[a:b] for a, b in spans]
            if line and len(found) >= LEAST_WORDS:
                if not plain:
                    odd.append((len(tokens), [at + a for a, _ in spans]))
                lines.append((len(tokens), len(tokens) + len(found), n, at, at + len(line)))
                tokens += found
            at += len(line) + 1
    first, last, owner, start, end = (np.array(c, np.int64) for c in zip(*lines)) if lines else (np.zeros(0, np.int64),) * 5
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    upto = np.cumsum(size + 1)
    word_start = upto - size - 1
    if len(first):
        word_start += np.repeat(start - word_start[first], last - first)
    for place, own in odd:
        word_start[place:place + len(own)] = own
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    opens = np.flatnonzero(np.diff(owner, prepend=-1))
    return Words(hashes, word_start, word_start + size, first, last, owner, start, end,
                 first[opens], np.append(first[opens[1:]], len(tokens))[:len(opens)], owner[opens])


def least_places(shingles: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """(place, place of the least hash among the `width` neighbouring shingles from there; among equals the first).

    first and last bound each text's shingles; windows lie inside a text.
    """
    count = len(shingles) - width + 1
    inside = last - first >= width
    if count < 1 or not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << 28) - 1)
    # hash and place in one number, so the least is unique; a batch has far fewer words than 2 ** 28
    least, span = (shingles & ~low) | np.arange(len(shingles), dtype=np.uint64), 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:count], least[width - span:width - span + count])
    sizes = (last - first - width + 1)[inside]
    windows = np.repeat(first[inside] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return windows, (least[windows] & low).astype(np.int64)


def anchors(shingles: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = NEIGHBOURS) -> np.ndarray:
    """Places that hold the least hash of some `width` neighbouring shingles of a text."""
    return np.unique(least_places(shingles, first, last, width)[1])


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each line's words in their order."""
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    size = last - first
    place = (np.arange(len(hashes)) - np.repeat(first, size)).astype(np.uint64)
    found = []
    for seed in (11, 12):
        mixed = mix64_array(hashes ^ mix64_array(place * np.uint64(2) + np.uint64(mix64(seed))))
        found.append(mix64_array(np.add.reduceat(mixed, first) + size.astype(np.uint64)))
    return found[0], found[1]


def passage_hashes(hashes: np.ndarray, at: np.ndarray, width: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the `width` words from each place."""
    one, two = np.zeros(len(at), np.uint64), np.full(len(at), 0x5851F42D4C957F2D, np.uint64)
    for k in range(width):
        word = hashes[at + k]
        one = mix64_array(one ^ word)
        two = mix64_array(two + word * np.uint64(0x9FB21C651E98DF25))
    return one, two


def band_hashes(shingles: np.ndarray, first: np.ndarray, last: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per line and band from the least values of `rows` hash functions over the line's shingles."""
    found = np.zeros((len(first), bands), np.uint64)
    if not len(first):
        return found
    bounds = np.stack([first, last], axis=1).ravel()
    if bounds[-1] == len(shingles):
        bounds = bounds[:-1]
    for band in range(bands):
        total = np.full(len(first), mix64(band), np.uint64)
        for row in range(rows):
            a, b = mix64(band * 97 + row) | 1, mix64(band * 89 + row + 5000)
            total = mix64_array(total ^ np.minimum.reduceat((shingles * np.uint64(a)) ^ np.uint64(b), bounds)[::2])
        found[:, band] = total
    return found


def _paragraph_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines and seeds of (doc_id, content, text); lines carry their band hashes, seeds the number of their first word as start."""
    known, (bands, rows) = WordHashes(), tune()
    for batch in batches:
        for low in range(0, batch.num_rows, STEP):
            part = batch.slice(low, STEP)
            words = words_of(part.column(2).to_pylist(), known)
            if not len(words.line_first):
                continue
            shingles = shingle_hashes(words.hashes, SHINGLE)
            h1, h2 = sequence_hashes(words.hashes, words.line_first, words.line_last)
            long = words.line_last - words.line_first >= SHINGLE
            for kind, keys in ((long, band_hashes(shingles, words.line_first[long], words.line_last[long] - SHINGLE + 1, bands, rows)), (~long, None)):
                yield _rows(part, words.line_text[kind], LINE, h1[kind], h2[kind], words.line_start[kind], words.line_end[kind], keys)
            at = anchors(shingles, words.text_first, words.text_last - SHINGLE + 1)
            text = np.searchsorted(words.text_first, at, "right") - 1
            fits = at + PASSAGE <= words.text_last[text]
            at, text = at[fits], text[fits]
            yield _rows(part, words.text_number[text], SEED, passage_hashes(words.hashes, at)[0], None, at - words.text_first[text], None, None)


def _run_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of LEAST_PASSAGE words in (content, none, id, copies, places, text) whose own seed is at one of the places.

    Neighbouring runs of one seed are one row: at is the place of the first, start its first character, seed the seed's hash; runs, starts
    and ends have each run's hash and the characters from start to its own start and end.
    """
    known = WordHashes()
    for batch in batches:
        for low in range(0, batch.num_rows, STEP):
            part = batch.slice(low, STEP)
            words = words_of(part.column(5).to_pylist(), known)
            seeded = np.zeros(len(words.hashes), bool)
            begin = np.zeros(part.num_rows, np.int64)
            begin[words.text_number] = words.text_first
            places = part.column(4)
            seeded[np.asarray(places.flatten()) + np.repeat(begin, np.asarray(places.value_lengths()))] = True
            at, seed = least_places(shingle_hashes(words.hashes, SHINGLE), words.text_first, words.text_last - SHINGLE + 1)
            text = np.searchsorted(words.text_first, at, "right") - 1
            keep = at + LEAST_PASSAGE <= words.text_last[text]
            keep[keep] = seeded[seed[keep]]
            at, text, seed = at[keep], text[keep], seed[keep]
            opens = np.flatnonzero((np.diff(seed, prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1))
            bounds = np.append(opens, len(at)).astype(np.int32)
            from_start = np.repeat(words.start[at[opens]], np.diff(bounds))
            lists = (passage_hashes(words.hashes, at, LEAST_PASSAGE)[1].view(np.int64), (words.start[at] - from_start).astype(np.int32),
                     (words.end[at + LEAST_PASSAGE - 1] - from_start).astype(np.int32))
            at, text, seed = at[opens], text[opens], seed[opens]
            owner = pa.array(words.text_number[text])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).take(owner) for k in range(4)), pa.array((at - words.text_first[text]).astype(np.int32)),
                 pa.array(words.start[at].astype(np.int32)), pa.array(passage_hashes(words.hashes, seed)[0].view(np.int64)),
                 *(pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)) for values in lists)],
                names=["content", "none", "id", "copies", "at", "start", "seed", "runs", "starts", "ends"])


def _rows(part, owner, kind: int, h1, h2, start, end, keys) -> pa.RecordBatch:
    at, count = pa.array(owner), len(owner)
    bands = pa.nulls(count, pa.list_(pa.int64())) if keys is None else pa.ListArray.from_arrays(
        pa.array(np.arange(count + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel().view(np.int64)))
    none, ids = pa.nulls(count, pa.int64()), part.column(0)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(count, ids.type) if kind == SEED else ids.take(at), part.column(1).take(at), pa.array(np.full(count, kind, np.int32)),
         pa.array(h1.view(np.int64)), none if h2 is None else pa.array(h2.view(np.int64)), pa.array(start), none if end is None else pa.array(end), bands],
        names=["doc_id", "content", "kind", "h1", "h2", "start", "end", "bands"])


def _shingle_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, shingles) of the lines of (text, lines) that have a shingle; lines bound the lines of the text that are asked for."""
    known = WordHashes()
    for batch in batches:
        for low in range(0, batch.num_rows, STEP):
            part = batch.slice(low, STEP).to_pydict()
            words = words_of([text[line["start"]:line["end"]] for text, lines in zip(part["text"], part["lines"]) for line in lines], known)
            h1, h2 = sequence_hashes(words.hashes, words.line_first, words.line_last)
            shingles = shingle_hashes(words.hashes, SHINGLE)
            long = words.line_last - words.line_first >= SHINGLE
            sets = [np.unique(shingles[a:b - SHINGLE + 1]).tobytes() for a, b in zip(words.line_first[long].tolist(), words.line_last[long].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(h1[long].view(np.int64)), pa.array(h2[long].view(np.int64)), pa.array(sets, pa.binary())],
                                             names=["h1", "h2", "shingles"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two sorted sets of shingles."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def link_run(sets: list[np.ndarray], chunk: list[int], crossing: bool, threshold: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets of one cell; pairs already connected are not compared again."""
    root, links = list(range(len(sets))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if crossing and chunk[i] == chunk[j]:
                continue
            a, b = find(i), find(j)
            small, large = sorted((len(sets[i]), len(sets[j])))
            if a != b and small >= threshold * large and jaccard(sets[i], sets[j]) >= threshold:
                root[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _link_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over rows (key, i, j, c, h1, h2, shingles) sorted by cell; the rows of one cell are bounded by its chunks."""
    def links(cell, rows):
        found = link_run([np.frombuffer(r[3], np.uint64) for r in rows], [r[0] for r in rows], cell[1] != cell[2])
        return pa.RecordBatch.from_arrays([pa.array([f"{rows[at][1]},{rows[at][2]}" for at in ends], pa.string()) for ends in zip(*found)]
                                          or [pa.array([], pa.string())] * 2, names=["a", "b"])

    cell, rows = None, []
    for batch in batches:
        for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, i, j) != cell:
                if len(rows) > 1:
                    yield links(cell, rows)
                cell, rows = (key, i, j), []
            rows.append(row)
    if len(rows) > 1:
        yield links(cell, rows)


def paragraph_links(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between distinct lines (h1, h2, content, start, end, bands) with similarity SIMILARITY or more; enough to connect each group.

    content is a hash of the text that holds the line from start to end. texts (content, text) is asked for those lines only that
    are in a shared cell. Cells that hold the same set of lines are compared once; a cell with many lines is cut into chunks whose pairs are compared
    in tasks of their own.
    """
    spark = lines.sparkSession
    distinct, lines_path = store(lines.groupBy("h1", "h2").agg(F.first("bands").alias("bands"), F.min(F.struct("content", "start", "end")).alias("line")), "distinct-lines")
    cells = distinct.select("h1", F.explode("bands").alias("key"))
    shared = (cells.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("h1")).alias("x")).filter("n > 1")
              .groupBy("n", "x").agg(F.min("key").alias("key")))
    parts = F.ceil(F.col("n") / CHUNK).cast("int")
    members, cells_path = store(cells.join(shared, "key").select("key", "h1", parts.alias("s"), F.pmod(F.xxhash64("h1"), parts).cast("int").alias("c")), "cells")
    wanted = distinct.join(members.select("h1").distinct(), "h1", "left_semi").groupBy("line.content").agg(
        F.collect_list(F.struct("line.start", "line.end")).alias("lines"))
    sets = texts.join(wanted, "content").select("text", "lines").mapInArrow(_shingle_tasks, "h1 long, h2 long, shingles binary")
    sets = sets.groupBy("h1", "h2").agg(F.first("shingles").alias("shingles"))
    rows = members.join(sets, "h1").select("*", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("o")).select(
        "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "h1", "h2", "shingles")
    links = materialize(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "h1", "h2")
                        .mapInArrow(_link_tasks, "a string, b string").distinct(), "links")
    for path in (lines_path, cells_path):
        remove(spark, path)
    return links


def _parts_of_classes(classes: DataFrame) -> DataFrame:
    """(seed, key, low, high, members, first): the stretches of repeated runs low to high of each class that share their first occurrence.

    classes (seed, key, copies, first, runs): the rows of one seed whose runs are all equal are one class. Only where a seed has several classes
    their runs are counted one by one.
    """
    several = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")

    def place(k: Column) -> Column:
        return F.struct("first.none", "first.id", (F.col("first.at") + k).alias("at"), "first.content", (F.col("first.start") + F.col("first.starts")[k]).alias("start"),
                        (F.col("first.start") + F.col("first.ends")[k]).alias("end"))

    alone = classes.filter("copies > 1").join(several, "seed", "left_anti").select(
        "seed", "key", F.lit(0).alias("low"), (F.size("runs") - 1).alias("high"), F.col("copies").alias("members"), place(F.lit(0)).alias("first"))
    each = classes.join(several, "seed", "left_semi").select("seed", "key", "copies", "first", F.posexplode("runs").alias("k", "run"))
    least = each.groupBy("seed", "run").agg(F.sum("copies").alias("members"), F.min(place(F.col("k"))).alias("first")).filter("members > 1")
    # stretches that have the same first occurrence go on as one row
    found = each.select("seed", "key", "k", "run").join(least, ["seed", "run"]).withColumn("shift", F.col("first.at") - F.col("k"))
    same = ["seed", "key", "first.content", "shift", "members"]
    found = found.repartition("seed", "key").withColumn("stretch", F.col("k") - F.row_number().over(Window.partitionBy(*same).orderBy("k")))
    stretches = found.groupBy("seed", "key", "first.content", "shift", "members", "stretch").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.min("first").alias("first"))
    return alone.union(stretches.select(alone.columns))


def repeated_runs(seeds: DataFrame, docs: DataFrame, texts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, start, end, members, group_doc_id, group_start, removed): spans of joined runs of LEAST_PASSAGE words that occur more than once.

    seeds (content, h1, start), docs (doc_id, rid, content), texts (rid, text). Equal texts are searched once and counted as often
    as they occur. A run that overlaps its own first occurrence gives the words behind that only.
    """
    spark = docs.sparkSession
    often, often_path = store(seeds.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1"), "seeds")
    # seeds that occur once are left out before their texts are moved
    places = seeds.join(often, "h1").groupBy("content").agg(F.collect_set(F.col("start").cast("int")).alias("places"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "rid")
    distinct = materialize(docs.groupBy("content").agg(F.min(own).alias("own"), F.count(F.lit(1)).alias("copies")), "distinct-texts")
    wanted = distinct.join(places, "content").select("content", "own", "copies", "places", F.col("own.rid").alias("rid"))
    runs = texts.join(wanted, "rid").select("content", "own.none", "own.id", "copies", "places", "text").mapInArrow(
        _run_tasks, f"content long, none boolean, id {kind}, copies long, at int, start int, seed long, runs array<long>, starts array<int>, ends array<int>")
    runs, runs_path = store(runs.withColumn("key", F.xxhash64("runs")), "runs")
    remove(spark, often_path)
    first = F.struct("none", "id", "at", "content", "start", "starts", "ends")
    classes, classes_path = store(runs.groupBy("seed", "key").agg(
        F.sum("copies").alias("copies"), F.min(first).alias("first"), F.first("runs").alias("runs")), "run-classes")
    parts, parts_path = store(_parts_of_classes(classes), "run-parts")
    remove(spark, classes_path)
    found = runs.select("content", "copies", "at", "start", "seed", "key", "starts", "ends").join(parts, ["seed", "key"]).select(
        "content", "copies", (F.col("at") + F.col("low")).alias("at"), (F.col("at") + F.col("high")).alias("until"), "members", "first",
        (F.col("start") + F.col("starts")[F.col("low")]).alias("start"), (F.col("start") + F.col("ends")[F.col("high")]).alias("end"))
    # the first of equal texts keeps what occurs in it first, the others keep nothing
    found = found.withColumn("copy", F.explode(F.when(F.col("copies") > 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    same = ~F.col("copy") & (F.col("content") == F.col("first.content"))
    found = found.withColumn("removed", ~(same & (F.col("at") == F.col("first.at"))))
    found = found.withColumn("start", F.when(same & F.col("removed"), F.greatest("start", "first.end")).otherwise(F.col("start")))
    text = Window.partitionBy("content", "copy", "removed")
    found = found.withColumn("begins", F.coalesce(F.col("at") > F.lag("until").over(text.orderBy("at")) + LEAST_PASSAGE, F.lit(True)))
    found = found.withColumn("span", F.count_if("begins").over(text.orderBy("at")))
    spans = found.groupBy("content", "copy", "removed", "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("members").alias("members"), F.min_by("first", "at").alias("first"))
    spans = materialize(spans, "spans")
    for path in (runs_path, parts_path):
        remove(spark, path)
    named = docs.join(distinct.select("content", "own"), "content").select("content", "doc_id", (F.col("rid") != F.col("own.rid")).alias("copy"))
    return spans.join(named, ["content", "copy"]).select(
        "doc_id", F.col("start").cast("long"), F.col("end").cast("long"), "members",
        F.col("first.id").alias("group_doc_id"), F.col("first.start").cast("long").alias("group_start"), "removed")


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, kind, group_doc_id, group_start, members, removed: one row per occurrence in a group of two or more.

    start and end are code points of the text. kind is paragraph (a line, near copies linked) or passage (equal words, across lines too).
    The group is named by its first occurrence, that with the smallest doc_id and start, which stays; the others are removed. Null ids
    come last. Texts that are null, empty or repeat nothing give no rows; repeated rows repeat each other. A passage is the longest
    stretch of touching runs of LEAST_PASSAGE words that are all first occurrences, or all removed; its group is that of the run it
    opens with, members the most occurrences of a run in it. Repeats inside one document count.
    """
    arrow_limits(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("row.text").cast("string")
    texts = with_row_id(docs, "texts").select(F.col("row.doc_id").alias("doc_id"), "rid", F.xxhash64(text).alias("content"), text.alias("text"))
    found = materialize(texts.select("doc_id", "content", "text").mapInArrow(
        _paragraph_tasks, f"doc_id {kind}, content long, kind int, h1 long, h2 long, start long, end long, bands array<long>"), "paragraphs", "kind")
    lines, seeds = found.filter(F.col("kind") == LINE), found.filter(F.col("kind") == SEED)
    group = components(paragraph_links(lines.filter("bands IS NOT NULL").select("h1", "h2", "content", "start", "end", "bands"), texts.select("content", "text")), "a", "b")
    passages = repeated_runs(seeds.select("content", "h1", "start"), materialize(texts.select("doc_id", "rid", "content"), "contents"),
                             texts.select("rid", "text"), kind)
    where = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("start").alias("start"))
    named = lines.select("doc_id", "start", "end", "h1", "h2").join(
        group.select(*[F.split("node", ",")[k].cast("long").alias(f"h{k + 1}") for k in (0, 1)], "component"), ["h1", "h2"], "left")
    named = named.select("doc_id", "start", "end", F.coalesce("component", F.concat_ws(",", "h1", "h2")).alias("group"))
    least = named.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.min(where).alias("first")).filter("members > 1")
    rows = named.join(least.select("group", "members", F.col("first.id").alias("group_doc_id"), F.col("first.start").alias("group_start")), "group")
    first = F.col("doc_id").eqNullSafe(F.col("group_doc_id")) & (F.col("start") == F.col("group_start"))
    columns = ["doc_id", "start", "end", "kind", "group_doc_id", "group_start", "members", "removed"]
    return (rows.withColumn("removed", ~first).withColumn("kind", F.lit("paragraph")).select(columns)
            .union(passages.withColumn("kind", F.lit("passage")).select(columns)))
