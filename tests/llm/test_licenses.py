"""Licence scan against plain versions: matching statistics, phrases, spans of planted notices."""

import random
import re
from collections import Counter

from tidemill.llm import licenses
from tidemill.llm.license_texts import PHRASES, TEMPLATES
from tidemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def places(text):
    w = words(text)
    return sorted((n, label) for label, phrase in PHRASES for n in range(len(w)) if w[n:n + len(phrase.split())] == phrase.split())


def test_automaton_holds_every_run_with_its_places():
    rng = random.Random(2)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(9))] for _ in range(rng.randrange(1, 5))]
        automaton = licenses.SuffixAutomaton(sequences, 2)
        runs = {tuple(s[a:b]): set() for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for k, s in enumerate(sequences):
            for a in range(len(s)):
                for b in range(a + 1, len(s) + 1):
                    runs[tuple(s[a:b])].add((k, b))
        for run, ends in runs.items():
            state = automaton.read(run)
            assert automaton.length[automaton.link[state]] < len(run) <= automaton.length[state]
            if len(run) >= 2:
                assert set(automaton.ends[state]) == ends and len(automaton.ends[state]) == len(ends)
        assert len(automaton.next) <= 2 * sum(map(len, sequences)) + 1


def test_matching_statistics_of_streamed_texts(monkeypatch):
    """The matches reported are those right-maximal runs that a plain search finds, whatever the size of the stream's pieces."""
    rng = random.Random(3)
    templates = [("x", " ".join(rng.choice("abcd") for _ in range(14))) for _ in range(3)]
    known = [t.split() for _, t in templates]

    def longest(w, end):
        return max((n for n in range(end + 1) if any(w[end - n:end] == k[i:i + n] for k in known for i in range(len(k) - n + 1))), default=0)
    for piece in (1, 5, 1 << 20):
        monkeypatch.setattr(licenses.words_of, "__defaults__", (piece,))
        for _ in range(40):
            w = [rng.choice("abcdef") for _ in range(rng.randrange(40))]
            found = []
            monkeypatch.setattr(licenses.Matches, "add", lambda self, end, state, length: found.append((end, length)) if length >= 3 else None)
            licenses.Scanner(templates, [], least_match=3).scan(" ".join(w).encode())
            stats = [longest(w, e) for e in range(len(w) + 1)]
            assert found == [(e, n) for e, n in enumerate(stats) if n >= 3 and (e == len(w) or stats[e + 1] <= n)]


def test_registered_query(spark):
    found = {r.doc_id: r for r in QUERIES["op12_licenses"][0](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(found) == len(rows)
    for row in rows:
        got, at = found[row.doc_id], places(row.text)
        assert (got.n_words, got.n_base) == (len(words(row.text)), len(at))
        assert (got.first_word, got.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert got.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(got.base_labels.split(",")) - {""} <= set(got.labels.split(",")) and 0 <= got.score <= 1


def test_planted_notices(spark):
    rng = random.Random(4)
    prose = [f"w{n}" for n in range(50)]

    def filler(n):
        return " ".join(rng.choice(prose) for _ in range(n))
    rows, planted = [], {}
    for n, (label, text) in enumerate(TEMPLATES):
        for kind in range(3):
            w = text.split()
            if kind == 1 and len(w) > 20:
                # words of its own in every line, one in fifteen changed
                w = [x if i % 15 else "other" for i, x in enumerate(w)]
            elif kind == 2 and len(w) > 20:
                w = w[:len(w) // 3] + filler(8).split() + w[len(w) // 3:]
            rows.append((len(rows), filler(40) + " " + " ".join(w).upper() + "\n" + filler(30)))
            planted[len(rows) - 1] = label
    clean = [(10_000 + n, filler(60) + " the software is provided " + filler(20)) for n in range(50)]
    found = {r.doc_id: r for r in licenses.license_report(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    for i, label in planted.items():
        spans = [s for s in found[i].spans if s.label == label]
        assert len(spans) == 1 and label in found[i].labels.split(","), (label, found[i])
        assert 38 <= spans[0].start_word <= 42 and len(words(rows[i][1])) - spans[0].end_word in range(29, 34) and found[i].score >= 0.6
    assert all(found[i].labels == "" and found[i].score == 0 for i, _ in clean)


def test_odd_rows(spark):
    notice = TEMPLATES[1][1]
    texts = [None, "", "  \n", "MIT license", "mit-LICENSE_mit license", "CC BY-NC", "Ümit license", " mit license", notice * 400, "a " * 400_000 + "cc by", "x" * 1_500_000 + " mit license",
             "the above copyright notice " * 5_000]
    df = spark.createDataFrame([(n if n % 3 else None, t, "x") for n, t in enumerate(texts)] * 2, "doc_id long, text string, licenses string")
    result = licenses.license_report(df).collect()
    expected = [(n if n % 3 else None, len(words(t)), len(places(t)), ",".join(sorted({x for _, x in places(t)}))) for n, t in enumerate(texts)] * 2
    assert Counter((r.doc_id, r.n_words, r.n_base, r.base_labels) for r in result) == Counter(expected)
    assert max(len(r.spans) for r in result) == 400
    assert licenses.license_report(df.limit(0)).count() == 0
    assert licenses.find_licenses(df).columns == ["doc_id", "text", "licenses"]
