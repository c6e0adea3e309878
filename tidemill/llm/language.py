"""Language identification by nearest centroid.

A text is a vector of hashed letter n-grams (1 to 3 letters, words apart) weighted by TF-IDF and scaled to length 1. Document
frequencies are counted over all training rows. Each language has several centroids, found by spherical k-means on a bounded
sample of its rows; a text gets the language of the centroid with the largest cosine. A text that lies farther from
that centroid than the sample's rows do is marked as rejected and its score is halved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, bucket_of_id

#: Rows of each language that the centroids are fitted on, at most; taken by a hash of the id.
SAMPLE_PER_LANGUAGE = 768
SAMPLE_PARTS = 64
HELD_OUT_OF, HELD_OUT = 4, 2
DIMENSIONS = 1 << 13
CLUSTERS = 4
TEMPERATURE = 0.05
#: A centroid's radius is this many times the distance that nearly all of its sample rows keep.
MARGIN = 1.3
#: Letters of a text are counted in pieces of this many, so memory does not grow with the text.
PIECE = 1 << 18

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams; None if the text has no letter. Whatever is no letter counts as one boundary."""
    if not text:
        return None
    counts, found = np.zeros(DIMENSIONS, np.int64), False
    for at in range(0, len(text), PIECE):
        # two characters more, for the n-grams across the cut
        codes = np.frombuffer(text[at:at + PIECE + 2].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[codes]
        found = found or bool(is_letter.any())
        codes = np.where(is_letter, codes, 0)
        codes = codes[is_letter | np.concatenate([[True], is_letter[:-1]])].astype(np.uint64)
        hashed = codes
        for n in range(3):
            if n:
                hashed = hashed[:-1] * np.uint64(0x9E3779B1) + codes[n:] if len(hashed) > 1 else hashed[:0]
            kept = hashed[hashed > 0] + np.uint64(n * 0x51ED270B)
            counts += np.bincount((kept * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - 13), minlength=DIMENSIONS)
    return counts if found else None


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the scaled TF-IDF vector."""
    at = np.nonzero(counts)[0]
    values = np.log1p(counts[at]) * idf[at]
    return at, (values / np.sqrt((values ** 2).sum())).astype(np.float32)


@dataclass
class Centroids:
    """Languages in order of code points; one row per centroid with its language and radius."""

    languages: list[str]
    owner: np.ndarray
    points: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool, float]:
        """(language, score, rejected, distance)."""
        counts = ngram_counts(text)
        if counts is None or not self.languages:
            return "und", 0.0, True, 1.0
        at, values = vector(counts, self.idf)
        cosine = self.points[:, at] @ values
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, cosine)
        language = int(np.argmax(best))
        share = np.exp((best - best[language]) / TEMPERATURE)
        nearest = int(np.argmax(np.where(self.owner == language, cosine, -2)))
        distance = float(1 - cosine[nearest])
        rejected = distance > self.radius[nearest]
        return self.languages[language], float(np.clip(1 / share.sum() * (0.5 if rejected else 1.0), 0, 1)), rejected, distance


def spherical_clusters(rows: np.ndarray, clusters: int = CLUSTERS, steps: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; starts from the mean and then the rows farthest from those chosen."""
    chosen = [rows[int(np.argmax(rows @ rows.mean(axis=0)))]]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(rows[int(np.argmin((rows @ np.array(chosen).T).max(axis=1)))])
    points = np.array(chosen)
    for _ in range(steps):
        owner = (rows @ points.T).argmax(axis=1)
        points = np.array([rows[owner == k].sum(axis=0) if (owner == k).any() else points[k] for k in range(len(points))])
        points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    return points.astype(np.float32)


def _learnable() -> Column:
    return (bucket_of_id(HELD_OUT_OF) != HELD_OUT) & F.col("lang").isNotNull()


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Training rows that hold each n-gram, over all of them, and their number."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py())
                if counts is not None:
                    total += counts > 0
                    rows += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(total, rows))], names=["place", "rows"])

    found = (docs.filter(_learnable()).select(F.col("text").cast("string").alias("text")).mapInArrow(count, "place long, rows long")
             .groupBy("place").agg(F.sum("rows").alias("rows")).toArrow())
    total = np.zeros(DIMENSIONS + 1, np.int64)
    total[found.column("place").to_numpy()] = found.column("rows").to_numpy()
    return total[:-1], int(total[-1])


def fit(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Centroids:
    """Learns from rows with a language whose crc32(doc_id) mod 4 is not 2; at most sample_per_language rows of each are clustered."""
    arrow_limits(docs.sparkSession)
    df, total = document_frequencies(docs)
    idf = np.log((1 + total) / (1 + df)) + 1
    text = F.col("text").cast("string")
    # the sample is cut in parts by hash, so that no task sees all rows of a language
    order = Window.partitionBy("lang", "part").orderBy("hash", "doc_id")
    picked = (docs.filter(_learnable()).select("doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("hash")).distinct()
              .withColumn("part", F.pmod("hash", F.lit(SAMPLE_PARTS))).withColumn("n", F.row_number().over(order))
              .filter(F.col("n") <= -(-sample_per_language // SAMPLE_PARTS)).select("doc_id", F.col("lang").alias("language")))

    @F.arrow_udf("struct<at: array<int>, v: array<float>>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for value in batch:
                counts = ngram_counts(value.as_py())
                at, v = vector(counts, idf) if counts is not None else ([], [])
                rows.append({"at": at, "v": v})
            yield pa.array(rows, pa.struct([("at", pa.list_(pa.int32())), ("v", pa.list_(pa.float32()))]))

    # sample_per_language ids for each language there is: this bound makes the broadcast safe
    sample = (docs.filter(_learnable()).join(F.broadcast(picked), "doc_id").filter(F.col("lang").cast("string") == F.col("language"))
              .select("doc_id", "language", vectors(text).alias("x")).dropDuplicates(["doc_id", "language"]).orderBy("language", "doc_id").toArrow())
    languages, by_language = [], {}
    for language, x in zip(sample.column("language").to_pylist(), sample.column("x")):
        if len(x["at"].values):
            by_language.setdefault(language, []).append((x["at"].values.to_numpy(), x["v"].values.to_numpy()))
    owner, points, radius = [], [], []
    for language in sorted(by_language):
        rows = np.zeros((len(by_language[language]), DIMENSIONS), np.float32)
        for n, (at, v) in enumerate(by_language[language]):
            rows[n, at] = v
        found = spherical_clusters(rows)
        cosine = rows @ found.T
        nearest = cosine.argmax(axis=1)
        for k in range(len(found)):
            away = 1 - cosine[nearest == k, k]
            radius.append(MARGIN * float(np.quantile(away, 0.995)) + 0.05 if len(away) else 0.05)
            owner.append(len(languages))
        points.append(found)
        languages.append(language)
    return Centroids(languages, np.array(owner, np.int64), np.vstack(points) if points else np.zeros((0, DIMENSIONS), np.float32),
                     np.array(radius), idf)


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, distance: one row per row of docs, repeated rows too.

    `und` with score 0 for a null text, one without letters, or where there was nothing to learn from. A null doc_id is predicted and
    never learned from; held_out is false. Of equal cosines the language first by code point wins. Only the text enters a
    prediction.
    """
    model = fit(docs)

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean, distance: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()), ("distance", pa.float64())])
        for batch in batches:
            yield pa.array([dict(zip(("lang_pred", "score", "rejected", "distance"), model.predict(t.as_py()))) for t in batch], kind)

    return docs.select("doc_id", F.coalesce(bucket_of_id(HELD_OUT_OF) == HELD_OUT, F.lit(False)).alias("held_out"),
                       predicted(F.col("text").cast("string")).alias("p")).select("doc_id", "held_out", "p.*")
