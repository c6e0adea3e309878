"""Toxicity by weak supervision.

Labelled training rows name the lexicons. Voters (word lexicons, word-start lexicons, text patterns) look at every
training document; a generative label model, fitted by expectation maximisation to the counts of all vote patterns,
estimates each voter's rates under either class and down-weights voters by the correlations that remain within a
class. A linear classifier over words and word starts learns the model's posterior labels and scores every text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, bucket_of_id, text_of

#: Rows of each class that the classifier and the lexicons are fitted on, at most; taken by a hash of the id.
SAMPLE_PER_CLASS = 3_000
HELD_OUT_OF = 5
WORD_VOTERS, START_VOTERS = 6, 6
WORDS_PER_VOTER, STARTS_PER_VOTER = 12, 24
PATTERNS = (re.compile(r"!{2,}"), re.compile(r"(?:\b[A-Z]{4,}\b[^A-Za-z]+){3}"),
            re.compile(r"\b(?:you|your|du|dich|tu|vous|usted)\b", re.I), re.compile(r"[A-Za-z][*#@$]{2,}[A-Za-z]"))
VOTERS = WORD_VOTERS + START_VOTERS + len(PATTERNS)
EDGES = ".,;:!?\"'()[]{}<>|*_#%&$~`-"
_WORDS, _STARTS = 1, 2


class Features(dict):
    """Raw token -> ids of its features (the word, its first 4 and 5 letters), bounded in size."""

    def __init__(self, wanted: set[int] | None = None, bound: int = 300_000):
        super().__init__()
        self.wanted, self.bound = wanted, bound

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.bound:
            self.clear()
        word = token.strip(EDGES)
        names = [(_WORDS, word)] if word else []
        if len(word) >= 6:
            names += [(_STARTS, word[:4]), (_STARTS, word[:5])]
        ids = tuple(xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass"), kind) * 2 + kind - 1 for kind, name in names)
        found = self[token] = ids if self.wanted is None else tuple(i for i in ids if i in self.wanted)
        return found


def feature_ids(text: str, features: Features) -> set[int]:
    ids: set[int] = set()
    for found in map(features.__getitem__, set(text.lower().split())):
        if found:
            ids.update(found)
    return ids


@dataclass
class LabelModel:
    """Latent class model over binary voters: prior, rate of a vote under each class, weight of each voter."""

    prior: float
    rates: np.ndarray  # 2 x voters
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.prior, self.prior]))[:, None] + np.stack([
            (self.weights * (votes * np.log(r) + (1 - votes) * np.log(1 - r))).sum(axis=1) for r in self.rates])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def votes_of(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS)[None, :] & 1).astype(float)


def fit_label_model(masks, counts, known_masks, known_labels, rounds: int = 4, steps: int = 30) -> LabelModel:
    """EM over counts of vote patterns of all training rows; rows with a label keep it as their posterior.

    Correlations: what two voters still share within a class, by the posterior, lowers the weight of both.
    """
    votes, known = votes_of(masks), votes_of(known_masks)
    labels = known_labels.astype(float)

    def rates(total_votes, total):
        return np.clip((total_votes + 0.05) / (total + 1.0), 1e-4, 1 - 1e-4)

    model = LabelModel(float(np.clip((labels.sum() + 0.5) / (len(labels) + 1.0), 1e-3, 0.5)),
                       np.stack([rates((known * (1 - labels)[:, None]).sum(0), (1 - labels).sum()),
                                 rates((known * labels[:, None]).sum(0), labels.sum())]), np.ones(VOTERS))
    weight = counts.astype(float)
    for _ in range(rounds):
        for _ in range(steps):
            p = model.posterior(votes) * weight
            q = weight - p
            model.rates = np.stack([rates((votes * q[:, None]).sum(0) + (known * (1 - labels)[:, None]).sum(0), q.sum() + (1 - labels).sum()),
                                    rates((votes * p[:, None]).sum(0) + (known * labels[:, None]).sum(0), p.sum() + labels.sum())])
        shared = np.zeros((VOTERS, VOTERS))
        for share, r in ((weight - model.posterior(votes) * weight, model.rates[0]), (model.posterior(votes) * weight, model.rates[1])):
            centred = (votes - r) * np.sqrt(share)[:, None]
            cov = centred.T @ centred / max(share.sum(), 1.0)
            scale = np.sqrt(np.clip(r * (1 - r), 1e-6, None))
            shared = np.maximum(shared, np.abs(cov / scale[:, None] / scale[None, :]) * (share.sum() >= 30))
        np.fill_diagonal(shared, 0)
        shared[shared < 0.1] = 0
        model.weights = 1 / (1 + np.clip(shared, 0, 1).sum(axis=1))
    return model


def fit_linear(rows: list[np.ndarray], soft: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 150):
    """Logistic regression on sets of feature ids and soft labels: (kept ids, their weights, bias)."""
    every = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    ids, at, support = np.unique(every, return_inverse=True, return_counts=True)
    # features whose log odds stand out from chance; the rest would only memorise rows
    bad = np.bincount(at, np.repeat(soft, [len(r) for r in rows]), minlength=len(ids))
    share, good = soft.sum() / max(len(soft), 1), support - bad
    surprise = 2 * (bad * np.log(np.maximum(bad, 1e-9) / (support * share + 1e-9)) + good * np.log(np.maximum(good, 1e-9) / (support * (1 - share) + 1e-9)))
    ids = ids[(support >= 3) & (surprise > 15) & (bad > support * share)]
    if not len(ids):
        return ids, np.zeros(0), float(np.log(0.01))
    at, owner = np.searchsorted(ids, every), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at[at == len(ids)] = 0
    fine = ids[at] == every
    at, owner = at[fine], owner[fine]
    size = np.bincount(owner, minlength=len(rows))
    value = 1 / np.sqrt(1 + np.log1p(size))[owner]
    w, bias, total = np.zeros(len(ids)), float(np.log((soft @ weight + 1e-3) / ((1 - soft) @ weight + 1e-3))), weight.sum()
    m, v, mb, vb = np.zeros(len(ids)), np.zeros(len(ids)), 0.0, 0.0
    for step in range(1, steps + 1):
        z = np.bincount(owner, value * w[at], minlength=len(rows)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - soft) / total
        grad, gb = np.bincount(at, error[owner] * value, minlength=len(ids)) + l2 * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb ** 2
        up, down = 1 - 0.9 ** step, 1 - 0.999 ** step
        w -= 0.1 * (m / up) / (np.sqrt(v / down) + 1e-8)
        bias -= 0.1 * (mb / up) / (np.sqrt(vb / down) + 1e-8)
    return ids, w, float(bias)


@dataclass
class Classifier:
    """Weights by feature id; the text's score is the logistic of their sum, scaled by the number of known features."""

    weights: dict[int, float]
    bias: float
    label_model: LabelModel | None = None

    def score(self, text: str | None, features: Features) -> float:
        ids = feature_ids(text, features) if text else ()
        total = math.fsum(map(self.weights.__getitem__, ids)) / np.sqrt(1 + np.log1p(len(ids))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _mask(text: str | None, voters: dict[int, int], features: Features) -> int:
    mask = 0
    if text:
        for i in feature_ids(text, features):
            mask |= 1 << voters[i]
        for n, pattern in enumerate(PATTERNS):
            if pattern.search(text):
                mask |= 1 << (WORD_VOTERS + START_VOTERS + n)
    return mask


def _lexicons(rows: list[np.ndarray], labels: np.ndarray) -> dict[int, int]:
    """Feature id -> voter: the features that tell toxic training rows most, dealt out to the lexicons in turn."""
    if not labels.any():
        return {}
    ids, at = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(labels, [len(r) for r in rows])
    bad = np.bincount(at, owner, minlength=len(ids))
    good = np.bincount(at, 1 - owner, minlength=len(ids))
    odds = np.log((bad + 0.1) / (labels.sum() + 0.2)) - np.log((good + 0.1) / ((1 - labels).sum() + 0.2))
    gain = np.where((bad >= 3) & (odds > 1), bad * odds, 0)
    found: dict[int, int] = {}
    for kind, first, groups, most in ((0, 0, WORD_VOTERS, WORDS_PER_VOTER), (1, WORD_VOTERS, START_VOTERS, STARTS_PER_VOTER)):
        own = np.nonzero((gain > 0) & (ids % 2 == kind))[0]
        best = own[np.lexsort((ids[own], -gain[own]))][:groups * most]
        found |= {int(ids[i]): first + n % groups for n, i in enumerate(best)}
    return found


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Classifier:
    """Learns from rows whose crc32(doc_id) mod 5 is not 0; texts come from docs, labels from labels.toxic.

    Lexicons and the linear model are fitted on at most sample_per_class labelled rows of each class; the label
    model sees the votes on all training rows of docs. Of conflicting labels of one id the larger counts. Without labels or
    without toxic rows the classifier scores every text near 0.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    learnable = bucket_of_id(HELD_OUT_OF) != 0
    known = (labels.filter(F.col("toxic").isNotNull() & learnable).groupBy("doc_id")
             .agg(F.max(F.when(F.col("toxic").cast("int") == 1, 1).otherwise(0)).alias("label")))
    order = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy(order, "doc_id").limit(sample_per_class)
        picked = part if picked is None else picked.union(part)

    @F.arrow_udf("array<long>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features()
        for batch in batches:
            yield pa.array([sorted(feature_ids(t.as_py() or "", features)) for t in batch], pa.list_(pa.int64()))

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # at most 2 x sample_per_class rows of two numbers: this bound makes the broadcast safe at any size
    sample = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "label", ids_of("text").alias("ids"))
    sample = sample.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("ids").alias("ids")).toArrow()
    sample = sample.sort_by("doc_id")
    y = sample.column("label").to_numpy().astype(np.int64)
    # views of one buffer; lists of numbers would take several times as much of the driver
    ids = sample.column("ids").combine_chunks() if sample.num_rows else pa.array([], pa.list_(pa.int64()))
    flat, ends = ids.flatten().to_numpy(), ids.offsets.to_numpy()
    rows = [flat[a - ends[0]:b - ends[0]] for a, b in pairwise(ends.tolist())]
    voters = _lexicons(rows, y)
    if not voters:
        return Classifier({}, float(np.log(0.01)))

    @F.arrow_udf("long")
    def mask_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(set(voters))
        for batch in batches:
            yield pa.array([_mask(t.as_py(), voters, features) for t in batch], pa.int64())

    # at most 2 ** VOTERS rows, whatever the size of docs
    patterns = texts.filter(learnable).groupBy(mask_of("text").alias("mask")).count().toArrow()
    known_masks = np.array([sum(1 << v for v in {voters[i] for i in r.tolist() if i in voters}) for r in rows], np.int64)
    model = fit_label_model(patterns.column("mask").to_numpy(), patterns.column("count").to_numpy(), known_masks, y)
    soft = model.posterior(votes_of(known_masks))
    # a label that contradicts the voters pulls the posterior half of the way
    soft = 0.5 * soft + 0.5 * y
    share = max(int(known_count(known, 1)), 1), max(int(known_count(known, 0)), 1)
    weight = np.where(y == 1, share[0] / max((y == 1).sum(), 1), share[1] / max((y == 0).sum(), 1))
    ids, w, bias = fit_linear(rows, soft, weight)
    large = np.abs(w) > 1e-3
    return Classifier(dict(zip(ids[large].tolist(), w[large].tolist())), bias, model)


def known_count(known: DataFrame, label: int) -> int:
    return known.filter(F.col("label") == label).count()


def score_column(classifier: Classifier, text):
    """Score of a text column, 0 to 1; null and empty texts get the score of no features."""
    @F.arrow_udf("double")
    def toxic_score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(set(classifier.weights))
        for batch in batches:
            yield pa.array([classifier.score(t.as_py(), features) for t in batch], pa.float64())
    return toxic_score(text.cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of docs, repeated rows too.

    Null text counts as empty. A null doc_id is scored and never learned from; held_out is false. Other columns are not read.
    """
    score = score_column(fit(docs, labels), text_of())
    return docs.select("doc_id", F.coalesce(bucket_of_id(HELD_OUT_OF) == 0, F.lit(False)).alias("held_out"), score.alias("score")
                       ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score below 0.5, all columns, also where names clash with ours.

    Null and empty texts have no features and stay; repeated rows stay or go together; rows with a null id are scored, not learned from. Without
    a toxic label nothing goes; an empty table gives no rows.
    """
    score = score_column(fit(docs, labels), text_of("row.text"))
    return docs.select(F.struct("*").alias("row")).filter(score < 0.5).select("row.*")
