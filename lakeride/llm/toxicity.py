"""Toxicity: cumulative-link ordinal regression over sparse word features.

P(grade >= k) = sigmoid(w . x - cut_k): one weight vector for all thresholds,
cut_1 <= cut_2 <= ... in order. The model is fitted on a bounded sample of
labelled documents and then scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import pieces

#: hash values of words and of their beginnings; so many that frequent words share theirs with next to none
BUCKETS, PREFIX = 1 << 31, 5
#: bounds of the fit: labelled documents per grade, features kept
SAMPLE_A_GRADE, FEATURES = 10_000, 8192
#: a feature is kept if the two shares differ by so many standard errors
LEAST_DOCS, LEAST_Z = 4, 6.0
#: distinct toxic features at which a document labelled only 'toxic' counts as more severe
SEVERE_AT = (5, 12)
#: a document is toxic if P(grade >= 1) reaches this
LIMIT = 0.5

#: bounds of a task's memory: bytes of text handled at once, words whose features it remembers
SLICE_BYTES, CACHE_WORDS = 2 << 20, 200_000
_WORD = re.compile(r"[^\W\d_]+")
_CODER: list[pieces.PieceCoder] = []


def _hash(words: list[str]) -> np.ndarray:
    from zlib import crc32

    return np.fromiter((crc32(w.encode()) % BUCKETS for w in words), np.int32, len(words))


def _code(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words in each piece: the word, and its beginning if it is longer."""
    words: list[str] = []
    counts = np.zeros(len(chunks), np.int64)
    for i, c in enumerate(chunks):
        for w in _WORD.findall(c.lower()):
            words.append(w)
            counts[i] += 1
            if len(w) > PREFIX:
                words.append(w[:PREFIX] + "*")
                counts[i] += 1
    return _hash(words), counts


def features(text: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end, distinct buckets of each of these texts)."""
    if not _CODER:
        _CODER.append(pieces.PieceCoder(pieces.split_dropping_spaces, _code, CACHE_WORDS))
    for b, e in pieces.slices(text, SLICE_BYTES):
        codes, count = _CODER[0](text.slice(b, e - b))
        owner = np.repeat(np.arange(e - b, dtype=np.int64), count)
        both = np.unique(owner * BUCKETS + codes)
        yield b, e, np.split((both % BUCKETS).astype(np.int32), np.searchsorted(both // BUCKETS, np.arange(1, e - b)))


@dataclass
class Model:
    buckets: np.ndarray  # ascending
    weights: np.ndarray
    cuts: np.ndarray  # ascending

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of a document with these distinct buckets."""
        at = np.minimum(np.searchsorted(self.buckets, x), max(0, len(self.buckets) - 1))
        hit = self.buckets[at] == x if len(self.buckets) else np.zeros(len(x), bool)
        return _sigmoid(self.weights[at[hit]].sum() - self.cuts)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit_cumulative(row: np.ndarray, col: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 600,
                   prior: float = 0.1, rate: float = 0.05, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts by Adam on the mean cumulative-link likelihood.

    ``row``/``col``: the ones of the sparse 0/1 matrix. Cuts are the first one
    and positive gaps (exponentials), so they stay in order. ``prior``: the
    precision of a weight's normal prior around zero. ``weight``: how many
    documents each one stands for (all the same if not given).
    """
    n, grades = len(grade), int(grade.max(initial=0)) + 1
    l2 = prior / max(1, n)
    part = np.full(n, 1 / max(1, n)) if weight is None else weight / weight.sum()
    share = np.array([np.clip(part[grade >= k].sum(), 1e-4, 1 - 1e-4) for k in range(1, grades)])
    start = np.log(1 / share - 1)
    theta = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, cuts = theta[:n_features], np.cumsum(np.concatenate([theta[n_features:n_features + 1], np.exp(theta[n_features + 1:])]))
        z = np.bincount(row, w[col], n)
        p = _sigmoid(z[:, None] - cuts[None, :])
        full = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], 1)
        slope = np.concatenate([np.zeros((n, 1)), p * (1 - p), np.zeros((n, 1))], 1)
        i = np.arange(n)
        chance = np.maximum(full[i, grade] - full[i, grade + 1], 1e-12)
        # the grade's interval has a lower and an upper cut; each pulls with its own slope
        low, high = part * slope[i, grade] / chance, part * slope[i, grade + 1] / chance
        gz = high - low
        g_cut = np.array([(low * (grade == k)).sum() - (high * (grade == k - 1)).sum() for k in range(1, grades)])
        tail = np.cumsum(g_cut[::-1])[::-1]  # a gap moves all cuts above it
        grad = np.concatenate([np.bincount(col, gz[row], n_features) + l2 * w, tail[:1], tail[1:] * np.exp(theta[n_features + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cuts = np.cumsum(np.concatenate([theta[n_features:n_features + 1], np.exp(theta[n_features + 1:])]))
    return theta[:n_features], cuts


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
          sample: int = SAMPLE_A_GRADE, n_features: int = FEATURES, severe_at: tuple[int, ...] = SEVERE_AT) -> Model:
    """Fits on at most ``sample`` labelled documents of each grade (0, 1, 2, ...), those of the smallest id hash.

    A row of the sample weighs as many labels of its grade as it stands for, so the
    share of each grade in the fit, and with it the verdict, does not depend on ``sample``.
    Rows without an id or grade are left out. Their features are written once;
    executors count them by grade and the driver gets the ``n_features`` that
    differ most between clean and graded documents and, for the sample, which
    of these each document has. No labelled rows: a model that calls nothing toxic.
    """
    spark = docs.sparkSession
    lab = labels.select(labels[id_col].alias("id"), labels[grade_col].cast("int").alias("grade")).where("id is not null and grade >= 0")
    labelled = dict(lab.groupBy("grade").count().collect())
    grades = sorted(labelled)
    if not grades:
        return Model(np.empty(0, np.int64), np.empty(0), np.array([20.0]))
    picked = None
    for g in grades:
        part = lab.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    picked = materialize(picked, "toxicity-sample")
    stands_for = {g: n / min(n, sample) for g, n in labelled.items()}
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).join(
        F.broadcast(picked), "id").select("grade", "text")  # at most sample x grades rows are broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e, found in features(pieces.as_text(batch.column(1))):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b, e - b), pa.array(found, pa.list_(pa.int32()))],
                                                 ["grade", "buckets"])

    seen = materialize(rows.mapInArrow(run, "grade int, buckets array<int>"), "toxicity-features")
    size = dict(seen.groupBy("grade").count().collect())
    bad, clean = sum(n for g, n in size.items() if g > 0), size.get(0, 0)
    all_bad = sum(n * stands_for[g] for g, n in size.items() if g > 0)
    share_bad = sum((F.col(f"g{g}") * (stands_for[g] / all_bad) for g in size if g > 0), F.lit(0.0))
    count = (seen.select("grade", F.explode("buckets").alias("bucket")).groupBy("bucket")
             .agg(*(F.sum((F.col("grade") == g).cast("long")).alias(f"g{g}") for g in size), F.count("*").alias("n"))
             .where(F.col("n") >= LEAST_DOCS).withColumn("share_bad", share_bad)
             .withColumn("share_clean", (F.col("g0") if clean else F.lit(0)) / max(1, clean)))
    gap = F.col("share_bad") - F.col("share_clean")
    pooled = F.col("n") / max(1, bad + clean)
    chosen = (count.withColumn("score", F.abs(gap) / F.sqrt(pooled * (1 - pooled) * (1 / max(1, bad) + 1 / max(1, clean)) + 1e-12))
              .where(F.col("score") >= LEAST_Z).orderBy(F.desc("score"), "bucket").limit(n_features).collect())
    buckets = np.array(sorted(r["bucket"] for r in chosen), np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # one row stays one row, with the chosen buckets it has
            kept = [x[np.isin(x, buckets)] for x in (v.values.to_numpy(zero_copy_only=False) for v in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.list_(pa.int32()))], ["grade", "buckets"])

    # at most sample x grades rows with the chosen buckets reach the driver; documents without any carry the base rate
    coded = sorted((r["grade"], r["buckets"]) for r in seen.mapInArrow(code, "grade int, buckets array<int>").collect())
    grade = np.array([g for g, _ in coded], np.int64)
    many = np.array([len(b) for _, b in coded], np.int64)
    row = np.repeat(np.arange(len(grade)), many)
    col = np.searchsorted(buckets, np.array([x for _, b in coded for x in b], np.int64))
    weight = np.array([stands_for[g] for g in grade.tolist()])
    if grades[-1] == 1:
        speaks = {r["bucket"] for r in chosen if r["share_bad"] > r["share_clean"]}
        toxic = np.isin(buckets, np.array(sorted(speaks), np.int64))
        hits = np.bincount(row, toxic[col], len(grade)) if len(row) else np.zeros(len(grade))
        for least in severe_at:
            grade = grade + ((grade > 0) & (hits >= least))
    if grade.max(initial=0) == 0:
        return Model(np.empty(0, np.int64), np.empty(0), np.array([20.0]))
    weights, cuts = fit_cumulative(row, col, grade, len(buckets), weight=weight)
    return Model(buckets, weights, cuts)


def grade_documents(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and expected_severity (sum of P(grade >= k)), grade (most likely), p_toxic, toxic.

    Null and empty texts have no features and get the base rate (not toxic
    unless most labelled documents are). Repeated rows give repeated rows, an
    empty table none. Columns not in ``keep`` are ignored, whatever their
    names; a name of the result in ``keep`` is an error. No shuffle.
    """
    new = ["expected_severity", "grade", "p_toxic", "toxic"]
    if set(new) & set(keep):
        raise ValueError(f"{new} are names of the result")
    rows = docs.select(*(docs[c] for c in keep), docs[text_col].cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e, found in features(pieces.as_text(batch.column(len(keep)))):
                p = np.array([model.probabilities(x) for x in found]).reshape(e - b, len(model.cuts))
                each = np.concatenate([np.ones((e - b, 1)), p], 1) - np.concatenate([p, np.zeros((e - b, 1))], 1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(b, e - b) for i in range(len(keep))), pa.array(p.sum(1)),
                     pa.array(each.argmax(1).astype(np.int32)), pa.array(p[:, 0]), pa.array(p[:, 0] >= LIMIT)], [*keep, *new])

    schema = rows.drop("__text").schema
    return rows.mapInArrow(run, schema.add("expected_severity", "double").add("grade", "integer").add("p_toxic", "double").add("toxic", "boolean"))


def severity_labels(labels: DataFrame) -> DataFrame:
    """The given toxic label as grade 0 or 1; a null label gives none."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("grade")).where("grade in (0, 1)")
