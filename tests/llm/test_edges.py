"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.llm import decontamination, language, mixing, quality, secrets, simhash_dedup, substrings, tokens, toxicity, warc


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with nulls in every column, empty and long texts, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"word{i % 977} term{i}" for i in range(6000))
    near = [f"the quick brown fox number {i} jumps over the lazy dog again and again near the old river bank" for i in range(3)]
    rows = [(1, long, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, near[0], "en", None), (5, near[0], "en", "b"),
            (None, near[1], "de", "c"), (None, None, None, None), (6, "   \n\t ", "en", "a"), (7, "é 1 2", "fr", "a"), (7, "é 1 2", "fr", "a"),
            (8, near[2] + "\n" + near[2], "en", "a"), (9, "!!! ???", "en", "c"), (10, long, "en", "a")]
    table = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", 1, 2) for i, t, lang, s in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, rid string, fp int, place int")
    return table


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, None, 0), (4, 1, 1), (5, 0, None), (None, 0, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "the quick brown fox number 1 jumps over the lazy dog again"), (2, None), (3, ""), (4, "é 1 2")], "item_id long, text string")


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_one_row_per_document(docs, labels):
    wanted = ids(docs)
    for found in (secrets.find_secrets(docs), simhash_dedup.simhash_groups(docs), language.identify_languages(docs), quality.quality_rules(docs),
                  toxicity.score_toxicity(docs, labels), mixing.mix_report(docs), tokens.token_report(docs)):
        assert ids(found) == wanted


def test_empty_tables(docs, empty, labels, benchmark):
    for found in (secrets.find_secrets(empty), simhash_dedup.simhash_groups(empty), language.identify_languages(empty), quality.quality_rules(empty),
                  toxicity.score_toxicity(empty, labels), toxicity.score_toxicity(empty, labels.limit(0)), mixing.mix_report(empty),
                  tokens.token_report(empty), substrings.repeated_paragraphs(empty), decontamination.contaminated(empty, benchmark),
                  decontamination.contaminated(docs, benchmark.limit(0))):
        assert found.count() == 0


def test_stages_keep_the_columns(docs, labels, benchmark):
    for found in (toxicity.drop_toxic(docs, labels), simhash_dedup.keep_one(docs), decontamination.drop_contaminated(docs, benchmark),
                  mixing.mixed_documents(docs)):
        assert found.columns == docs.columns and found.schema["rid"].dataType == docs.schema["rid"].dataType
        found.collect()


def test_keep_one(docs):
    kept = simhash_dedup.keep_one(docs)
    assert ids(kept) == Counter([1, 2, 4, 7, 8, 9]) + Counter({None: kept.filter("doc_id IS NULL").count()})


def test_values(docs, benchmark):
    groups = {r.doc_id: r for r in simhash_dedup.simhash_groups(docs).filter("doc_id IS NOT NULL").collect()}
    assert groups[2].fingerprint == "0" * 16 and groups[6].component_id == 2 and groups[10].component_id == 1
    assert {r.lang_pred for r in language.identify_languages(docs).filter("doc_id IN (2, 3, 6, 9)").collect()} == {"und"}
    found = decontamination.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.item_id == 4} == {(7, 4)} and (None, 1) in {(r.doc_id, r.item_id) for r in found}
    mixed = mixing.mix_report(docs).collect()
    assert all(r.taken <= 2 * r["size"] for r in mixed)
    first = tokens.token_report(docs).filter("doc_id = 2").first()
    assert first.n_tokens == 1


def test_pages(spark):
    rows = [(3, "u\r\nx", "y" * 150), (1, None, "y" * 150), (1, "a", "y" * 150), (None, "b", "y" * 150), (5, "c", None), (6, "d", ""), (7, "e", "y" * 99), (8, "f", "y" * 99)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    found = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.page_records(pages).collect()), key=str)
    assert found == sorted([(3, "revisit", 1, 150), (1, "response", None, 150), (1, "response", None, 150), (None, "revisit", 1, 150), (5, "response", None, 0),
                            (6, "response", None, 0), (7, "response", None, 99), (8, "response", None, 99)], key=str)
    assert warc.page_records(pages.limit(0)).count() == 0


def test_repeats(docs):
    found = substrings.repeated_paragraphs(docs).filter("kind = 'paragraph'")
    assert {(r.doc_id, r.group_doc_id, r.removed) for r in found.collect()} >= {(10, 1, True), (1, 1, False), (5, 4, True)}
    assert found.filter(F.col("doc_id") == 8).count() == 2
