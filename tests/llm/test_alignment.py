"""Token alignment against whole texts encoded by each library and aligned by the bytes of their tokens."""

import hashlib
import itertools
import random
from collections import Counter

import pytest

from tidemill.llm import alignment
from tidemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ALPHABET = [*"ab  \n\n\t.,'s1é日𝄞▁\0\r\xa0 <>|", "<|endoftext|>", "</s>", "<unk>", "<0x41>", "the ", "'ll", " ​", "é", "x" * 40]


@pytest.fixture(scope="module")
def both():
    return alignment.Aligner(*alignment.default_vocabularies())


def plain_groups(both, text):
    """(end, ids of A, ids of B), by encoding the whole text; none if the tokens do not spell it."""
    if not text:
        return []
    a, b, raw = both.one.encode(" " + text, add_special_tokens=False).ids, both.two.encode(text), (" " + text).encode()
    if b"".join(both.a_bytes[i] for i in a) != raw or b"".join(both.b_bytes[i] for i in b) != raw:
        return []
    left = list(itertools.accumulate(len(both.a_bytes[i]) for i in a))
    right = list(itertools.accumulate(len(both.b_bytes[i]) for i in b))
    found, i, j = [], 0, 0
    for cut in sorted(set(left) & set(right)):
        p, q = left.index(cut) + 1, right.index(cut) + 1
        found.append((cut, a[i:p], b[j:q]))
        i, j = p, q
    return found


def plain_report(both, rows):
    groups = [plain_groups(both, text) for _, text in rows]
    count = Counter((a[-1], b[-1]) for g in groups for _, a, b in g)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for (i, _), g in zip(rows, groups):
        links = [(a[-1], b[-1]) for _, a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for _, a, b in g)
        out.append((i, sum(len(a) for _, a, _ in g), sum(len(b) for _, _, b in g), len(g), len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return Counter(out)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def reported(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_registered_query(spark, both):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert reported(QUERIES["op13_alignment"][0](spark, SMALL)) == plain_report(both, rows)


def test_odd_texts(spark, both):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [None, "", " ", "\n", "\nword", "a▁b", "word " * 30_000, "x" * 50_000, "日本" * 5_000]
    rows = [(n // 2 if n % 7 else None, t) for n, t in enumerate(texts)]  # repeated and null ids
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert reported(alignment.alignment_report(df)) == plain_report(both, rows)
    assert reported(alignment.alignment_report(df.limit(0))) == Counter()


def test_groups_of_whole_rows(spark, both):
    texts = ["Hé 日本𝄞 a  b\n\nc", "", None, "a▁b"]
    df = spark.createDataFrame([(str(n), t, n, "old") for n, t in enumerate(texts)], "doc_id string, text string, pairs int, groups string")
    found = {r.doc_id: r for r in alignment.token_groups(df).collect()}
    assert [r.pairs for r in found.values()] == [0, 1, 2, 3]
    for n, text in enumerate(texts):
        groups = found[str(n)].groups
        assert [(g.end, list(g.a), list(g.b)) for g in groups] == plain_groups(both, text)
        assert [g.start for g in groups] == [0, *(g.end for g in groups)][:len(groups)]


def test_memory_is_bounded(both):
    memory = alignment.Memory(both, bound=200_000)
    for n in range(0, 20_000, 100):
        memory.entries({f" w{k}" for k in range(n, n + 100)} | {" " + "y" * 300})
        assert len(memory.now) + len(memory.old) < 1_000 and len(memory.now) <= 500
    assert not any(len(p) > alignment.LONGEST_PART for p in memory.now)
    assert alignment.pair_bound(both) < 500_000


def test_parts_of_other_vocabularies_stay_whole(both, monkeypatch):
    monkeypatch.setattr(both, "parted", False)
    assert both.parts("a b\nc") == [" a b\nc"]
    assert [(g["end"], g["a"], g["b"]) for g in alignment.text_groups(both, "a b\nc")] == plain_groups(both, "a b\nc")
