"""Operators against plain versions of what they compute."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemill.llm import decontamination, mixing, secrets, simhash_dedup, substrings, tokens, toxicity, warc
from tidemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def grouped(items, linked):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def test_simhash_groups(spark, texts):
    def print_of(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        if not words:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    prints = {i: print_of(t) for i, t in texts.items()}
    group = grouped(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_dedup"][0](spark, SMALL).collect()}
    assert found == {i: (f"{p:016x}", group[i]) for i, p in prints.items()}


def test_links_of_a_dense_cell():
    rng, base = random.Random(3), 0x0123456789ABCDEF
    prints = np.array(sorted({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for _ in range(200)}), np.uint64)
    n = len(prints)
    a, b = simhash_dedup.link_cells(np.zeros(n, int), prints, np.zeros(n, int), np.zeros(n, bool))
    every = [(i, j) for i in range(n) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 3]
    assert grouped(range(n), zip(a, b)) == grouped(range(n), every) and len(a) < n
    # two chunks: own pairs are left to other tasks, across them nothing is lost
    chunk = np.arange(n) % 2
    links = []
    for crossing, members in ((True, np.arange(n)), (False, np.arange(0, n, 2)), (False, np.arange(1, n, 2))):
        x, y = simhash_dedup.link_cells(np.zeros(len(members), int), prints[members], chunk[members], np.full(len(members), crossing))
        links += [(int(members[p]), int(members[q])) for p, q in zip(x, y)]
    assert grouped(range(n), links) == grouped(range(n), every)


def test_components_of_chains_and_hubs(spark):
    from tidemill.llm.graph import components
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 3), (7, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


def test_secrets(spark, texts):
    for row in QUERIES["op1_secrets"][0](spark, SMALL).collect():
        text, spans = texts[row.doc_id], []
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
            spans += [(m.start(), 0, f"assign:{m.start()}:{m.end()}")] * (len(m[2]) >= 12)
        for n, (pattern, size) in enumerate((("AKIA[A-Z0-9]+", 18), ("[0-9a-f]+", 16)), 1):
            spans += [(m.start(), n, f"{('access', 'hex')[n - 1]}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= size]
        assert row.base_sha256 == hashlib.sha256(",".join(s[2] for s in sorted(spans)).encode()).hexdigest()
        assert {s[2] for s in spans} <= set(row.spans.split(","))


def test_guess_cost():
    cost = secrets.GuessCost()
    weak = ["password", "Password1", "changeme", "qwertyuiop", "20240131", "aaaaaaaaaa", "abcabcabc", "letmein2024"]
    assert all(cost(w) < secrets.GUESSES < cost("x9$Kq2!z") for w in weak)
    _, base_spans, _ = secrets.scan('pwd = "x9$Kq2!z" and pwd: changeme', cost)
    assert base_spans == [("guess", 7, 15)]
    value = "dragon7qwerty"
    assert [k for *_, k in cost.segments(value)[1]] == ["word", "brute", "word"]


def test_tokens_round_trip(spark, texts):
    from tokenizers import Tokenizer
    tokenizer, start, wanted = Tokenizer.from_file(tokens.default_vocabulary()), 0, {}
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i], add_special_tokens=False).ids + [2]
        wanted[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_output"][0](spark, SMALL).collect()} == wanted


def test_encoder_equals_whole_texts():
    from tokenizers import Tokenizer
    tokenizer, encoder, rng = Tokenizer.from_file(tokens.default_vocabulary()), tokens.Encoder(tokens.default_vocabulary(), "<u2", 2, bound=50), random.Random(5)
    parts = list("ab  \n\n\t'sé9.,-<|>  \x1c　 日") + ["<|endoftext|>", " 's", " 12", " Ab", "  ", "a.\nB", "b\nc", "é\n", "can't "]
    for _ in range(20):
        some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)]
        assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(pa.array(some))] == [
            tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in some]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    slots = tokens.PerfectHash.build(h1, h2).slots(h1, h2)
    assert sorted(slots.tolist()) == list(range(20_000))
    index = tokens.load_index(tokens.index_bytes(h1, h2, {"shard": h1 % np.uint64(7), "record": h2 % np.uint64(999)}))
    entries, known = tokens.lookup(index, h1, h2)
    assert known.all() and (entries["record"] == h2 % np.uint64(999)).all()
    assert not tokens.lookup(index, h1 + np.uint64(1), h2)[1].any()


def test_token_access_by_key(spark, tmp_path):
    rows = spark.createDataFrame([(1, "aa bb"), (1, "zz"), (None, None), (2, "")] * 50, "doc_id long, text string")
    layout = tokens.write_tokens(rows, str(tmp_path / "tokens"), shard_bytes=200, keys_per_index=1)
    assert [len(tokens.get(layout, k, spark)) for k in (1, None, 2, 77)] == [100, 50, 50, 0]
    assert sorted(tokens.read_tokens(rows.select("doc_id").distinct(), layout).groupBy("doc_id").count().collect(), key=str) == sorted(
        [(1, 100), (2, 50), (None, 50)], key=str)


def test_decontamination(spark, texts):
    def words(text):
        return [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in text.split()) if w]

    def shingles(w):
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    rng = random.Random(1)
    planted = {}
    for n, w in items.items():
        # a word changed near an end, words cut off, and a change in the middle that goes too far for short items
        cut = [*w[:1], "changed", *w[2:]], w[1:], [*w[:len(w) // 2], "x", *w[len(w) // 2 + 1:]]
        for k, some in enumerate(cut):
            planted[1000 + 3 * n + k] = " ".join([rng.choice(["alpha", "beta"]) for _ in range(9)] + some + ["omega", "psi"])
    frame = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(frame, bench).collect()}
    wanted = {}
    for i, text in planted.items():
        w = words(text)
        for n in {(i - 1000) // 3}:
            want = shingles(items[n])
            best = max(decontamination.similarity(shingles(w[a:a + len(items[n])]), want) for a in range(max(1, len(w) - len(items[n]) + 1)))
            if best >= 0.8:
                wanted[i, n] = best
    assert wanted and found == pytest.approx(wanted)


def test_hamming_index_is_complete():
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(50)]
    index = decontamination.HammingIndex(values)
    probes = [v ^ sum(1 << b for b in rng.sample(range(64), bits)) for v in values for bits in (0, 7, 16, 24)]
    found = index.find(np.array(probes, np.uint64))
    assert sorted(found) == [(n, k) for n, p in enumerate(probes) for k, x in enumerate(values) if (x ^ p).bit_count() <= 24]
    assert {(n, n // 4) for n in range(len(probes))} <= set(found) and index.find(np.zeros(0, np.uint64)) == []


def test_substring_groups(spark, texts):
    found = QUERIES["op4_substring_dedup"][0](spark, SMALL).collect()
    sets, places = {}, {}
    for i, text in texts.items():
        at = 0
        for line in text.split("\n"):
            w = line.encode().lower().split()
            if len(w) >= substrings.LEAST_WORDS:
                key = b" ".join(w)
                sets[key] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
                places.setdefault(key, []).append((i, at))
            at += len(line) + 1
    group = grouped(sets, [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    members = {}
    for key, root in group.items():
        members.setdefault(root, []).extend(places[key])
    wanted = {(*o, *min(m)) for m in members.values() if len(m) > 1 for o in m}
    assert {(r.doc_id, r.start, r.group_doc_id, r.group_start) for r in found if r.kind == "paragraph"} == wanted


def test_shared_passage_inside_lines(spark):
    rng = random.Random(4)
    def words(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    passage = words(51)
    frame = spark.createDataFrame([(i, " ".join(words(70) + passage + words(30 + i))) for i in range(6)] + [(9, " ".join(words(200)))], "doc_id long, text string")
    found = substrings.repeated_paragraphs(frame).collect()
    assert {r.doc_id for r in found} == set(range(6)) and {r.group_doc_id for r in found} == {0}
    assert substrings.tune() == (8, 2)


def test_secret_values_of_any_length():
    cost, rng = secrets.GuessCost(), random.Random(7)
    key = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(5000))
    for text, value in ((f'pwd="{key[:264]}"', key[:264]), (f"auth: {key}", key), ("passphrase: \"correct horse battery staple\"", "correct horse battery staple"),
                        ("pwd: x9$Kq", "x9$Kq")):
        at = text.index(value)
        assert secrets.scan(text, cost)[1] == [("guess", at, at + len(value))]
    assert secrets.scan('secret: "my password" pwd: "" pwd: ab', cost)[1] == []


def test_words_of_the_corpus_are_no_secrets(spark):
    plain = [(n, "Niemand kennt something wonderful, nobody knows whereabouts") for n in range(6)]
    texts = ["secret: whereabouts", "token: something", "auth=Niemand", 'passphrase: "nobody knows"', "pwd: qzvkxjwphtm", "pwd: x9$Kq2!z and token: wonderful"]
    frame = spark.createDataFrame(plain + [(10 + n, text) for n, text in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: (r.spans, r.n_guess, r.max_guess_log10 >= secrets.GUESSES) for r in secrets.find_secrets(frame).collect() if r.doc_id >= 10}
    assert found == {10: ("", 0, False), 11: ("", 0, False), 12: ("", 0, False), 13: ("", 0, False), 14: ("guess:5:16", 1, True), 15: ("guess:5:13", 1, True)}


def test_shared_passage_across_lines(spark):
    rng = random.Random(5)
    def words(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    passage, wrapped = words(51), words(60)
    broken = " ".join(passage[:26]) + "\n" + " ".join(passage[26:])
    lines = "\n".join(" ".join(wrapped[k:k + 12]) for k in range(0, 60, 12))
    frame = spark.createDataFrame([(1, " ".join(words(60)) + " " + broken + " " + " ".join(words(30))), (2, " ".join(words(41) + passage + words(9))),
                                   (3, " ".join(words(20)) + " " + lines), (4, " ".join(words(33) + wrapped)), (5, "tail " + lines),
                                   (6, "one\n\ntwo words"), (7, "two words\nthree")], "doc_id long, text string")
    found = substrings.repeated_paragraphs(frame).collect()
    assert {(r.doc_id, r.group_doc_id) for r in found if r.kind == "passage"} == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)}
    assert {(r.doc_id, r.start, r.removed) for r in found if r.kind == "paragraph" and r.doc_id > 5} == {(6, 5, False), (7, 0, True)}


def test_passages_are_whole(spark):
    rng = random.Random(6)
    def words(n):
        return [f"w{rng.randrange(40)}" if rng.random() < 0.5 else f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    one, two, inner = words(90), words(50), words(70)
    docs = {1: words(30) + two + words(10), 2: words(45) + one + words(20) + inner + words(5) + inner + words(11), 3: words(8) + one[:60] + words(40),
            4: one[20:] + two + words(3), 5: ["a", "b", "c"] * 60, 6: words(49), 7: words(80), 8: words(80)[:31] + one[:49] + words(9), 9: ["a", "b", "c"] * 60}
    docs[7] = docs[2]
    width, places = substrings.LEAST_PASSAGE, {}
    for i, w in docs.items():
        for k in range(len(w) - width + 1):
            places.setdefault(tuple(w[k:k + width]), []).append((i, k))
    wanted, kept = set(), set()
    for found in places.values():
        for n, (i, k) in enumerate(found if len(found) > 1 else []):
            own = found[0][1] + width if n and found[0][0] == i else 0
            (wanted if n else kept).update((i, x) for x in range(max(k, own), k + width))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {True: set(), False: set()}
    rows = substrings.repeated_paragraphs(frame).filter("kind = 'passage'").collect()
    for r in rows:
        text = " ".join(docs[r.doc_id])
        span, before = text[r.start:r.end].split(), len(text[:r.start].split())
        got[r.removed] |= {(r.doc_id, before + k) for k in range(len(span))}
    assert got[True] == wanted and got[False] == kept
    assert {(r.doc_id, r.removed) for r in rows if r.group_doc_id == 2} >= {(2, False), (2, True), (3, True), (4, True), (7, True)}
    assert [(r.start, r.end) for r in rows if r.doc_id == 7] != [] and 6 not in {r.doc_id for r in rows}


def test_mixing(spark):
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 500 / 3, 250 / 3])
    quotas = np.array([500, 300, 7])
    parts = [mixing.split_path(quotas, 13, s) for s in range(13)]
    assert (sum(c for _, c in parts) == quotas).all()
    for n in range(3):
        assert sorted((int(f[n]), int(c[n])) for f, c in parts if c[n])[0][0] == 0
        assert all(int(parts[s][0][n] + parts[s][1][n]) == int(parts[s + 1][0][n]) for s in range(12))
    for size in (1, 2, 3, 64, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 9).tolist()) == list(range(size))
    found = QUERIES["op8_mixing"][0](spark, SMALL).toPandas()
    for _, source in found.groupby("source_size"):
        assert abs(source.taken.sum() - source.target.iloc[0] * source.target.nunique()) <= 600 * max(1, source.target.nunique())
    assert (found.taken <= 2 * found["size"]).all()
    again = mixing.mix_report(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)).toPandas()
    assert (again.sort_values("doc_id").values == found.sort_values("doc_id").values).all()


def test_label_model_recovers_rates():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.1
    votes = np.where(truth[:, None], rng.random((20_000, toxicity.VOTERS)) < 0.5, rng.random((20_000, toxicity.VOTERS)) < 0.02)
    masks, counts = np.unique(votes.astype(int) @ (1 << np.arange(toxicity.VOTERS)), return_counts=True)
    known = votes[:200].astype(int) @ (1 << np.arange(toxicity.VOTERS))
    model = toxicity.fit_label_model(masks, counts, known, truth[:200].astype(int))
    assert abs(model.rates[1] - 0.5).max() < 0.08 and model.rates[0].max() < 0.05
    assert ((model.posterior(votes.astype(float)) > 0.5) == truth).mean() > 0.99
    copied = np.hstack([votes[:, :1]] * 4 + [votes[:, 4:]])
    masks, counts = np.unique(copied.astype(int) @ (1 << np.arange(toxicity.VOTERS)), return_counts=True)
    model = toxicity.fit_label_model(masks, counts, known, truth[:200].astype(int))
    assert model.weights[:4].max() < 0.5 < model.weights[4:].min()


def test_held_out_accuracy(spark):
    base = SMALL.replace("0.001", "0.01")
    found = QUERIES["op5_language"][0](spark, base).toPandas().merge(spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "lang").toPandas())
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.97
    found = QUERIES["op9_toxicity"][0](spark, base).toPandas().merge(spark.read.parquet(f"{base}/labels.parquet").toPandas())
    assert (found[found.held_out].predicted == found[found.held_out].toxic).mean() > 0.9


def test_warc_streams(tmp_path):
    data = [warc.record_bytes(n, f"http://x/{n}", (b"p%d" % n) * (50_000 * n), hashlib.sha256(b"").hexdigest(), None) for n in range(1, 6)]
    one, each = warc.member(b"".join(data)), b"".join(map(warc.member, data))
    for packed in (one, each):
        (tmp_path / "x").write_bytes(packed)
        with open(tmp_path / "x", "rb") as stream:
            assert [r for _, r in warc.records(warc.inflated(stream))] == data
    (tmp_path / "x").write_bytes(one[:len(one) // 2])
    with open(tmp_path / "x", "rb") as stream, pytest.raises(EOFError):
        list(warc.records(warc.inflated(stream)))


def test_quality_equals_sql(spark):
    from parity import compare, duck_connection
    build, sql = QUERIES["op6_quality"]
    assert compare(build(spark, SMALL), duck_connection(SMALL), sql) is None
    assert not any(w in build(spark, SMALL)._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow"))


def test_pipeline(spark):
    import corpus_pipeline
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [rows]
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept.append(stage(spark, kept[-1], SMALL).cache())
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    scores = {r.doc_id: r.predicted for r in QUERIES["op9_toxicity"][0](spark, SMALL).collect()}
    assert ids[1] == {i for i, p in scores.items() if not p}
    group = {r.doc_id: r.component_id for r in simhash_dedup.simhash_groups(kept[1]).collect()}
    assert ids[2] == set(group.values()) and kept[2].count() == len(ids[2])
    leaks = {r.doc_id for r in decontamination.contaminated(kept[2], spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert ids[3] == ids[2] - leaks
    taken = sum(r.taken for r in mixing.mix_report(kept[3]).collect())
    assert sum(len(r.text.split()) for r in kept[4].collect()) == taken
    final = corpus_pipeline.STAGES[4][1](spark, kept[4], SMALL)
    assert Counter(r.doc_id for r in final.collect()) == Counter(r.doc_id for r in kept[4].collect())
