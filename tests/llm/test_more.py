"""Damaged archives, hostile texts, secrets that stay out of work folders; draws of any size, hot rows in the mix, benchmarks in parts."""

import glob
import io
import math
import os
import random
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import decontamination, mixing, secrets, warc
from tidemill.session import shared_folder


def test_cut_archives_are_refused():
    record = b"WARC/1.0\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for whole in (warc.member(record), warc.member(record) + warc.member(record)):
        assert b"".join(warc.inflated(io.BytesIO(whole))) in (record, record * 2)
        for cut in (1, 4, 7, 8, 9, 20):
            with pytest.raises((EOFError, zlib.error)):
                list(warc.inflated(io.BytesIO(whole[:-cut])))


@pytest.mark.parametrize("piece", ["a_", "token_", "secret-", "password=\"", "auth", "x9="])
def test_a_megabyte_of_key_names_takes_seconds(piece):
    text = piece * (1_000_000 // len(piece))
    start = time.process_time()
    list(secrets.CONTEXT.finditer(text))
    assert time.process_time() - start < 5


def test_names_with_more_in_front():
    for name in ("password", "db_password", "my-app_secret", "_token", "x__auth", "API-KEY-token"):
        assert [m.group(3) for m in secrets.CONTEXT.finditer(f"so {name}: zq81;")] == ["zq81"]
    assert not secrets.CONTEXT.search("mypassword: zq81")


def test_planted_values_are_found_and_leave_no_copy(spark):
    rng = random.Random(6)
    strong = ["".join(rng.choice("abcdefghkmnpqrstuvwxyzABCDEFGHKLMNPQRSTUVWXYZ23456789!$%&#") for _ in range(rng.randrange(9, 12))) for _ in range(60)]
    weak = ["password1", "qwertyuiop", "20240131", "aaaaaaaaaa", "admin123", "abcdefgh", "changeme"]
    rows = [(n, f"some words\nservice_pwd = '{v}' and more") for n, v in enumerate([*strong, *weak])]
    found = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, (_, text) in enumerate(rows):
        start = text.index("'") + 1
        span = f"guess:{start}:{text.index(chr(39), start)}"
        assert (span in found[n].spans.split(",")) == (n < len(strong)), text
    folder = shared_folder(spark).removeprefix("file:")
    for path in glob.glob(f"{folder}/llm-se*/**", recursive=True) + glob.glob(f"{folder}/llm-v*/**", recursive=True):
        if os.path.isfile(path):
            data = open(path, "rb").read()
            assert not any(v.encode() in data for v in strong)
    assert not glob.glob(f"{folder}/llm-secrets-*") and not glob.glob(f"{folder}/llm-values-*")


def test_hypergeometric_draws():
    """The shares of the values follow the exact distribution; very large draws keep their sums and their spread."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    for good, bad, take in ((5, 3, 4), (50, 30, 40), (1, 100, 7), (0, 9, 3), (12, 0, 5)):
        got = np.bincount([mixing.hypergeometric(good, bad, take, u) for u in grid], minlength=take + 1) / len(grid)
        exact = [math.comb(good, k) * math.comb(bad, take - k) / math.comb(good + bad, take) for k in range(take + 1)]
        assert abs(got - np.array(exact)).max() < 1e-4
    quotas = np.array([6 * 10 ** 10, 4 * 10 ** 10, 10 ** 9, 3, 0])
    shards, known = int(quotas.sum()) // 8192, {}
    for shard in (0, 1, 2, shards // 3, shards // 3 + 1, shards - 1):
        first, count = mixing.split_path(quotas, shards, shard, known=known)
        again = mixing.split_path(quotas, shards, shard)
        assert (first == again[0]).all() and (count == again[1]).all()
        assert abs(int(count.sum()) - 8192) <= 1 and abs(count[0] / count.sum() - quotas[0] / quotas.sum()) < 0.05
    assert (first + count == quotas).all()


def test_items_with_text_ids_in_several_passes(spark):
    rng = random.Random(8)
    items = [(f"item-{n}", " ".join(f"t{rng.randrange(4000)}" for _ in range(30 + n % 40))) for n in range(80)] + [(None, "a b c d e f g"), ("empty", ""), ("none", None)]
    docs = []
    for n, (_, text) in enumerate(items[:81]):
        w = text.split()
        docs.append((n, " ".join([*(f"z{k}" for k in range(20)), *w[:-1], "changed", "tail"])))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    one = sorted((tuple(r) for r in decontamination.contaminated(d, b).collect()), key=str)
    many = sorted((tuple(r) for r in decontamination.contaminated(d, b, pass_bytes=2_000).collect()), key=str)
    assert one == many and {(n, items[n][0]) for n in range(80)} <= {r[:2] for r in one}
    assert decontamination.drop_contaminated(d, b, pass_bytes=2_000).count() == 81 - len({r[0] for r in one})


def test_item_index_takes_little_memory():
    rng = random.Random(1)
    items = [(n, " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))) for n in range(1000)]
    tracemalloc.start()
    kept = decontamination.Searcher(items)
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert used < 32 * sum(len(t) + 64 for _, t in items) and kept.find(items[5][1])[0]["item"] == 5


def test_recall_of_the_radius():
    """Windows at or above the similarity are within the radius: recall of the index against exact similarity."""
    rng, hits, all_ = random.Random(9), 0, 0
    for _ in range(400):
        w = [f"t{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(20, 80))]
        changed = list(w)
        for k in rng.sample(range(len(w)), max(1, len(w) // 45)):
            changed[k] = "other"
        a, b = (decontamination.shingle_hashes(decontamination.word_hashes(" ".join(x), decontamination.Words())[0], 5) for x in (w, changed))
        if decontamination.similarity(Counter(a.tolist()), Counter(b.tolist())) >= 0.8:
            all_ += 1
            hits += (decontamination.simhash(a) ^ decontamination.simhash(b)).bit_count() <= decontamination.RADIUS
    assert all_ > 100 and hits / all_ > 0.999


def test_repeated_runs_are_kept_by_seed_and_work_tables_removed(spark, tmp_path, monkeypatch):
    """The stored runs have a row for each seed, not for each word; the work tables and shuffle files of a step go with it."""
    from tidemill.llm import common, substrings
    rows, paths, wrote = {}, {}, common.store

    def store(df, purpose, *by):
        assert df.sparkSession.conf.get(common.SHUFFLE_CLEANUP) == "false"
        table, path = wrote(df, purpose, *by)
        rows[purpose], paths[purpose] = table.count(), path
        return table, path

    monkeypatch.setattr(common, "store", store)
    monkeypatch.setattr(substrings, "store", store, raising=False)
    passage = " ".join(f"p{i}" for i in range(400))
    docs = spark.createDataFrame([(i, f"a{i} b{i} " + passage + f" y{i} z{i}") for i in range(6)], "doc_id long, text string")
    found = [r for r in substrings.repeated_paragraphs(docs).collect() if r.kind == "passage"]
    assert sorted(r.doc_id for r in found) == [*range(6)] and {r.members for r in found} == {6}
    assert {r.removed for r in found if r.doc_id} == {True} and not next(r for r in found if not r.doc_id).removed
    assert 0 < rows["runs"] < 6 * (400 - substrings.LEAST_PASSAGE) / 3
    import os
    gone = {p for p, path in paths.items() if not os.path.exists(path.removeprefix("file://").removeprefix("file:"))}
    assert gone >= {"distinct-lines", "cells", "seeds", "runs", "run-classes", "run-parts"}


def test_encoder_keeps_to_the_core_of_its_task(monkeypatch):
    """The tokenizer's own threads must not spin beside the task; groups of unseen words give the ids of whole texts."""
    import pyarrow as pa
    import public_tokenizers
    from tidemill.llm import tokens
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), "<u2", tokens.END_ID)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghij\u00e9\u4e2d", k=rng.randrange(1, 9))) for _ in range(500)) for _ in range(4)]
    for text, ids in zip(texts, coder.encode(pa.array(texts))):
        assert np.frombuffer(ids, "<u2").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids + [tokens.END_ID]
