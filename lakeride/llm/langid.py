"""Language identification by rank-order n-gram profiles (out-of-place distance).

A profile is the list of a language's most frequent character n-grams, most
frequent first. A document's own list is compared with each profile: every
n-gram costs the difference of its two ranks, or the profile's length if the
profile lacks it; the smallest sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pieces

#: n-grams of one to three characters; so many ranks in a profile and of a document
LONGEST, RANKS = 3, 400
UNKNOWN = "und"
#: a text is in a language if its score reaches this share of the median score of the language's labelled
#: documents. Prose of the given tables scores 0.43 to 0.71 (medians 0.64 to 0.71), random letters up to 0.25
#: from 60 characters on.
FLOOR_SHARE = 0.5
#: distinct n-grams a training task holds for all languages before it hands them on
HELD = 2_000_000
_BITS = 21  # of a code point; three fit into an n-gram's code

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """1 for code points that are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of a text: letters lower-cased, anything between words one gap, a gap at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    x = np.where(_letters()[np.minimum(points, 0x10FFFF)], points, 1).astype(np.int64)
    x = np.concatenate([[1], x, [1]])
    x = x[np.concatenate([[True], (x[1:] != 1) | (x[:-1] != 1)])]
    if len(x) < 2:
        return np.empty(0, np.int64)
    one = x[x != 1] << (2 * _BITS)
    two = x[:-1] << (2 * _BITS) | x[1:] << _BITS
    three = x[:-2] << (2 * _BITS) | x[1:-1] << _BITS | x[2:]
    return np.concatenate([one, two, three][:LONGEST])


def counted(codes: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes ascending, their counts)."""
    if weight is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, weight = codes[order], weight[order]
    edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    many = np.diff(np.append(edge, len(codes))) if weight is None else np.add.reduceat(weight, edge) if len(edge) else edge
    return codes[edge], many


def ranked(codes: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(counts) > ranks:  # only those that can be among the first, before the full sort
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:ranks]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> dict[str, list[int]]:
    """Profiles of all languages in ``lang_col`` over whole texts; rows with a null text or language add nothing.

    Tasks count n-grams per language and hand on sums, so what is shuffled does
    not grow with the texts. The driver gets ``ranks`` codes per language.
    """
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")).where(
        "lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def hand_on():
            for lang, (codes, counts) in held.items():
                for k in range(0, len(codes), 100_000):
                    part = codes[k:k + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(counts[k:k + 100_000].astype(np.int64))],
                        ["lang", "code", "n"])
            held.clear()

        for batch in batches:
            text = pieces.as_text(batch.column(1))
            for b, e in pieces.slices(text, 1 << 20):
                own: dict[str, list[np.ndarray]] = {}
                for lang, t in zip(batch.column(0).slice(b, e - b).to_pylist(), text.slice(b, e - b).to_pylist(), strict=True):
                    own.setdefault(lang, []).append(ngram_codes(t))
                for lang, arrays in own.items():
                    codes, counts = counted(np.concatenate(arrays))
                    if lang in held:
                        codes, counts = counted(np.concatenate([held[lang][0], codes]), np.concatenate([held[lang][1], counts]))
                    held[lang] = codes, counts
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from hand_on()
        yield from hand_on()

    total = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # the first ranks of each language, found in two steps so that no task gets all n-grams of one
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("code"), F.lit(16))).orderBy(F.desc("n"), "code")
    some = total.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= ranks).drop("r")
    best = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("r") <= ranks)
    out: dict[str, list[int]] = {}
    for row in sorted(best.collect(), key=lambda x: (x["lang"], x["r"])):
        out.setdefault(row["lang"], []).append(row["code"])
    return out


class Profiles:
    """Profiles ready for comparison."""

    def __init__(self, profiles: dict[str, list[int]], ranks: int = RANKS):
        self.langs, self.ranks = sorted(profiles), ranks
        self.codes, self.rank = [], []
        for lang in self.langs:
            codes = np.array(profiles[lang], np.int64)
            order = np.argsort(codes)
            self.codes.append(codes[order])
            self.rank.append(order.astype(np.int64))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is how much nearer the winner is than a list without any common n-gram."""
        codes = ngram_codes(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(*counted(codes), self.ranks)
        best, least = UNKNOWN, None
        for lang, known, rank in zip(self.langs, self.codes, self.rank, strict=True):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            cost = np.where(known[at] == own, np.abs(rank[at] - np.arange(len(own))), self.ranks)
            total = int(cost.sum())
            if least is None or total < least:
                best, least = lang, total
        return best, min(1.0, max(0.0, 1.0 - least / (self.ranks * len(own))))


def predict(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of each row and lang_pred, score. No shuffle.

    A text that is null or has no letters gets ``und`` with score 0; ties go to
    the first language by name; repeated rows give repeated rows, an empty
    table none; without any profile all are ``und``. Columns of the input
    that are not in ``keep`` are ignored, whatever their names; one in ``keep``
    that is called lang_pred or score is an error.
    """
    if {"lang_pred", "score"} & set(keep):
        raise ValueError("lang_pred and score are names of the result")
    rows = docs.select(*(docs[c] for c in keep), docs[text_col].cast("string").alias("__text"))
    model = Profiles(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pieces.as_text(batch.column(len(keep)))
            for b, e in pieces.slices(text, 2 << 20):
                got = [model.predict(t) for t in text.slice(b, e - b).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(b, e - b) for i in range(len(keep))),
                     pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    [*keep, "lang_pred", "score"])

    kept = rows.drop("__text").schema
    return rows.mapInArrow(run, kept.add("lang_pred", "string").add("score", "double"))


def floors(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", lang_col: str = "lang",
           share: float = FLOOR_SHARE) -> dict[str, float]:
    """:func:`floors_of` the predictions for ``docs``."""
    labelled = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")).where("lang is not null")
    return floors_of(predict(labelled, profiles, ["lang"]), "lang", share)


def floors_of(predicted: DataFrame, lang_col: str = "lang", share: float = FLOOR_SHARE) -> dict[str, float]:
    """Least score of a text in each language, from the rows of :func:`predict` labelled so and predicted so.

    Counts by language and thousandths of the score reach the driver, not rows.
    A language without such documents has no floor, an empty table gives none.
    """
    counts = (predicted.where(F.col(lang_col) == F.col("lang_pred"))
              .groupBy(F.col("lang_pred").alias("lang"), F.floor(F.col("score") * 1000).cast("int").alias("at")).count().collect())
    out: dict[str, float] = {}
    for lang in {r["lang"] for r in counts}:
        own = sorted((r["at"], r["count"]) for r in counts if r["lang"] == lang)
        upto = np.cumsum([n for _, n in own])
        out[lang] = share * own[int(np.searchsorted(upto, upto[-1] / 2))][0] / 1000
    return out
