"""Quality rules with thresholds that adapt to each language and source; DataFrame functions only.

Each text is measured once. Per (language, source) and measure a quantile sketch is a histogram of bounded relative error: a
value keeps its leading six bits, so a sketch has at most a few hundred buckets whatever the number of rows, and
sketches merge by adding counts: those of a language and of everything are sums of those of the groups. A document fails
where a measure lies beyond a fence drawn from the group's quantiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import SPACES, materialize, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
#: A group's fence is a mean of its own, weighed by its documents, and its language's, weighed by this many; a language's likewise with that of all.
BLEND = 100
#: Fences lie this many times the distance from the median to the 10th or 90th percentile beyond those, plus the slack.
REACH = 3
#: measure -> (slack, whether low values fail too)
MEASURES = {"word_length": (100, True), "symbols": (60, False), "dup_lines": (50, False), "repeats": (100, False)}
#: Repeated lines that any text may have besides: short texts have few lines, so that their shares are coarse.
FREE_LINES = 3


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang_key, source_key, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, one row per row of docs."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("none"))
    rows = docs.select("doc_id", key("lang").alias("lang_key"), key("source").alias("source_key"), text_of().alias("text"))
    rows = rows.select("doc_id", "lang_key", "source_key",
                       F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "").alias("words"),
                       F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
                       (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                       F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"))
    rows = rows.select("*", F.size("words").cast("long").alias("n_words"), F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    rows = rows.select("*", (F.size("windows") > F.size(F.array_distinct("windows"))).alias("repeats"))
    return rows.select("doc_id", "lang_key", "source_key", "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.when(F.col("repeats"), _covered("windows")).otherwise(0).cast("long").alias("n_repeat_words"))


def _covered(windows: str) -> Column:
    """Words inside windows whose hash occurs more than once: such windows sorted by place, overlaps counted once."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    twice = _let(placed, lambda p: F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                                            | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False))))
    starts = F.array_sort(F.transform(twice, lambda x: x["at"]))
    steps = _let(starts, lambda s: F.transform(s, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - at, F.lit(WINDOW)))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _let(value: Column, body) -> Column:
    """Evaluates `value` once and hands it to body: a lambda over an array of one element binds it."""
    return F.get(F.transform(F.array(value), body), 0)


def _measure(name: str) -> Column:
    """Whole numbers: characters a word in hundredths, the rest in thousandths."""
    words = F.greatest("n_words", F.lit(1))
    return {"word_length": F.floor(100 * F.col("word_chars") / words), "symbols": F.floor(1000 * F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
            "dup_lines": F.floor(1000 * F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
            "repeats": F.floor(1000 * F.col("n_repeat_words") / words)}[name].cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bucket(value: Column) -> Column:
    """The leading six bits of a whole number, the rest set to zero: at most 1/32 below the value."""
    cut = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return value - F.pmod(value, F.call_function("shiftleft", F.lit(1).cast("bigint"), cut))


def sketches(rows: DataFrame) -> DataFrame:
    """lang_key, source_key, measure, bucket, n over documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(_measure(m)).alias("bucket")) for m in MEASURES]))
    return (rows.filter(~base_failed()).select("lang_key", "source_key", each.alias("x"))
            .groupBy("lang_key", "source_key", "x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """keys, measure, docs, low, high from the sketches merged by keys."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    run = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("docs", F.sum("n").over(group))
    at = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("docs"), F.col("bucket")))
    found = run.groupBy(*keys, "measure").agg(F.max("docs").alias("docs"), at(10).alias("p10"), at(50).alias("p50"), at(90).alias("p90"))
    slack = F.coalesce(*[F.when(F.col("measure") == m, s) for m, (s, _) in MEASURES.items()])
    both = F.coalesce(*[F.when(F.col("measure") == m, F.lit(b)) for m, (_, b) in MEASURES.items()])
    return found.select(*keys, "measure", "docs", (F.col("p90") + REACH * (F.col("p90") - F.col("p50")) + slack).alias("high"),
                        F.when(both, F.col("p10") - REACH * (F.col("p50") - F.col("p10")) - slack).otherwise(-1).alias("low"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang_key, source_key, and low and high of each measure: a group's own fences, the more so the more documents it has."""
    own = fences(sketch, "lang_key", "source_key")
    lang = fences(sketch, "lang_key").select("lang_key", "measure", *[F.col(c).alias(f"lang_{c}") for c in ("docs", "low", "high")])
    every = fences(sketch).select("measure", *[F.col(c).alias(f"all_{c}") for c in ("low", "high")])
    joined = own.join(lang, ["lang_key", "measure"]).join(every, "measure")

    def mean(docs: str, inner: str, outer: Column) -> Column:
        return (F.col(docs) * F.col(inner) + F.lit(BLEND) * outer) / (F.col(docs) + F.lit(BLEND))
    chosen = joined.select("lang_key", "source_key", "measure", *[
        mean("docs", c, mean("lang_docs", f"lang_{c}", F.col(f"all_{c}"))).alias(c) for c in ("low", "high")])
    return chosen.groupBy("lang_key", "source_key").agg(*[F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}")
                                                          for m in MEASURES for c in ("low", "high")])


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept: one row per row of docs.

    Null text: no words, so it fails the base rules. A null language or source is a group of its own. Repeated rows and null ids give
    their own rows. In a group where no document passes the base rules there are no thresholds and nothing is kept.
    """
    rows = materialize(measured(docs), "quality")
    # one row per group, stored: its size is known, so rows meet a small one without a shuffle, and a large one by a join that AQE may split
    limits = materialize(thresholds(sketches(rows)), "quality-limits")
    inside = F.lit(True)
    for m in MEASURES:
        free = 1000 * FREE_LINES / F.greatest("n_lines", F.lit(1)) if m == "dup_lines" else F.lit(0)
        inside = inside & (_measure(m) <= F.col(f"{m}_high") + free) & (_measure(m) >= F.col(f"{m}_low"))
    return rows.join(limits, ["lang_key", "source_key"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"))


_WORD = "[^\\x20\\x09-\\x0D]+"
#: The same result in DuckDB.
QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, 'none') AS lang_key, coalesce('=' || source, 'none') AS source_key,
                  coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
win AS (SELECT rid, i, list_slice(ws, i, i + {WINDOW - 1}) AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT rid, i, unnest(range(0, {WINDOW})) AS k FROM twice) GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang_key, source_key, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN l USING (rid) LEFT JOIN r USING (rid)),
v AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
             [100 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1),
              1000 * n_repeat_words // greatest(n_words, 1)] AS vals FROM m),
b AS (SELECT lang_key, source_key, k AS measure, val - val % (1::BIGINT << greatest(length(bin(val)) - 6, 0)) AS bucket
      FROM (SELECT lang_key, source_key, unnest(range(1, 5)) AS k, unnest(vals) AS val FROM v WHERE NOT base_failed)),
g AS (SELECT lang_key, source_key, measure, bucket, count(*) AS n FROM b GROUP BY ALL),
levels AS (SELECT 1 AS level, * FROM g UNION ALL SELECT 2, lang_key, '', measure, bucket, sum(n) FROM g GROUP BY ALL
           UNION ALL SELECT 3, '', '', measure, bucket, sum(n) FROM g GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY level, lang_key, source_key, measure ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY level, lang_key, source_key, measure) AS docs FROM levels),
q AS (SELECT level, lang_key, source_key, measure, max(docs) AS docs, min(bucket) FILTER (100 * upto >= 10 * docs) AS p10,
             min(bucket) FILTER (100 * upto >= 50 * docs) AS p50, min(bucket) FILTER (100 * upto >= 90 * docs) AS p90 FROM run GROUP BY ALL),
f AS (SELECT *, p90 + {REACH} * (p90 - p50) + [{", ".join(str(s) for s, _ in MEASURES.values())}][measure] AS high,
             CASE WHEN measure = 1 THEN p10 - {REACH} * (p50 - p10) - {MEASURES["word_length"][0]} ELSE -1 END AS low FROM q),
t AS (SELECT a.lang_key, a.source_key, a.measure,
             (a.docs * a.high + {BLEND} * ((b.docs * b.high + {BLEND} * c.high) / (b.docs + {BLEND}))) / (a.docs + {BLEND}) AS high,
             (a.docs * a.low + {BLEND} * ((b.docs * b.low + {BLEND} * c.low) / (b.docs + {BLEND}))) / (a.docs + {BLEND}) AS low
      FROM f a JOIN f b ON b.level = 2 AND a.lang_key = b.lang_key AND a.measure = b.measure
      JOIN f c ON c.level = 3 AND a.measure = c.measure WHERE a.level = 1),
ok AS (SELECT rid, count(*) = 4 AS inside FROM v JOIN t ON v.lang_key = t.lang_key AND v.source_key = t.source_key
       AND vals[measure] >= low AND vals[measure] <= high + CASE WHEN measure = 3 THEN {1000 * FREE_LINES} / greatest(n_lines, 1) ELSE 0 END GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, false) AS kept
FROM v LEFT JOIN ok USING (rid)
"""
