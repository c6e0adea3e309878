"""Ranked search against a plain version that scores every document."""

import math
import random
import re
from collections import Counter

import numpy as np

from tidemill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, places=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    documents, length = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            if c:
                m = 25 + 75 * sum(c.values()) * documents // length
                score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                            for t in terms(text) if t in c)
                if score > 0:
                    scores.append((-score, i is not None, i or 0))
        out += [(item, k, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scores)[:places], 1)]
    return Counter(out)


def ranked(spark, docs, items, **settings):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, item int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    return Counter(tuple(r) for r in lexical.ranked_documents(d, b, **settings).select("item_id", "rank", "doc_id", "score").collect())


def test_random_texts(spark):
    rng = random.Random(1)
    vocabulary = [*"abcdefghij", "é", "日本", "x1", "long"]
    weights = [2 ** -(k / 2) for k in range(len(vocabulary))]

    def text(n):
        return rng.choice([" ", "\n", "-"]).join(rng.choices(vocabulary, weights, k=rng.randrange(n)))
    docs = [(rng.randrange(400) if rng.random() < .98 else None, text(30) if rng.random() < .97 else None) for _ in range(500)]
    docs += docs[:30] + [(7, "A,b"), (8, "a b"), (9, "Ab_b"), (900, "a " * 200_000)]
    items = [(k, text(40).upper()) for k in range(20)] + [(3, "a b c"), (3, "a b c"), (None, "a é"), (50, None), (51, ""), (52, "unknown"), (53, " ".join(vocabulary) * 3)]
    for settings in ({}, {"block": 16}, {"pass_bytes": 300, "block": 100}, {"places": 3}):
        assert ranked(spark, docs, items, **settings) == plain(docs, items, settings.get("places", 10))


def test_empty_tables(spark):
    assert not ranked(spark, [], [(1, "a")]) and not ranked(spark, [(1, "a b")], []) and not ranked(spark, [(1, None), (2, "--")], [(1, "a")])


def test_masks_are_left_out_only_below_the_floor():
    """Items with many terms (masks of several bytes); few masks are scored, none that matters is left out."""
    rng = np.random.default_rng(5)
    rows, kinds = 3000, 40
    doc, term = np.nonzero(rng.random((rows, kinds)) < np.geomspace(.9, .002, kinds))
    times = rng.integers(1, 5, len(doc))
    n = np.bincount(doc, weights=times, minlength=rows).astype(np.int64) + 1
    block = lexical.Block(n, doc, term, times, rows, int(n.sum()))
    worth = np.array([lexical.weight(rows, int((term == t).sum())) for t in range(kinds)]) * rng.integers(1, 3, kinds)
    every = block.score(np.arange(rows), np.arange(len(block.terms)), worth[block.terms])
    scored = []
    whole = lexical.Block.score
    block.score = lambda docs, *a: (scored.append(len(docs)), whole(block, docs, *a))[1]
    docs, scores = block.best(np.arange(kinds), worth, 0, 10)
    tenth = np.sort(every)[-10]
    assert set(docs.tolist()) == set(np.nonzero(every >= tenth)[0].tolist()) and (every[docs] == scores).all()
    assert sum(scored) < rows
    assert len(block.best(np.arange(kinds), worth, int(every.max()) + 1, 10)[0]) == 0


def test_equal_masks_share_one_bound():
    block = lexical.Block(np.array([4, 8, 4]), np.array([0, 1, 2, 2]), np.array([5, 5, 5, 9]), np.array([1, 1, 2, 1]), 3, 16)
    docs, scores = block.best(np.array([5, 9, 11]), np.array([100, 50, 70]), 0, 2)
    assert docs.tolist()[np.argmax(scores)] == 2 and set(docs.tolist()) == {0, 2}
