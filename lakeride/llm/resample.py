"""Target-distribution importance resampling with hashed n-grams.

A document's weight is the sum over its n-grams of how much more frequent
their bucket is in the target than in the corpus; Gumbel noise added to the
weight draws without replacement. A batch of texts is counted at once: the
texts are joined with a sentinel that no word contains but that the word rule
finds, one regex pass finds all words and sentinels, ``searchsorted`` over the
sentinels gives each word its document, n-grams that cross a document are
masked, and ``bincount`` counts the rest.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import pieces

#: hash buckets; longest n-gram; words that a document needs to be drawn; percent drawn; seed of the noise
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: bound of a task's memory: bytes of text counted at once
SLICE_BYTES = 4 << 20
#: letters, digits and all that is not ASCII; 0xFF is in no UTF-8 text
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SENTINEL = b"\xff"


def features(texts: pa.Array, longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end, words of each row, bucket of every n-gram, its row) of whole texts, A-Z lower-cased."""
    for b, e in pieces.slices(texts, SLICE_BYTES):
        # lower() of bytes changes A-Z only
        joined = (b"\x00" + _SENTINEL + b"\x00").join([t.encode().lower() for t in texts.slice(b, e - b).to_pylist()])
        coded = pa.array(_WORD.findall(joined), pa.binary()).dictionary_encode()
        distinct, word = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        mark = distinct.index(_SENTINEL) if e - b > 1 else -1
        ends = np.flatnonzero(word == mark)
        row = np.searchsorted(ends, np.arange(len(word)))
        real = word != mark
        gram = word  # number of the n-gram that starts at each word
        sums = np.fromiter(map(crc32, distinct), np.int64, len(distinct))
        valid = real
        found, owner = [sums[word[real]] % buckets], [row[real]]
        for n in range(2, longest + 1):
            gram, valid = gram[:-1], valid[:-1] & real[n - 1:]  # masked where a sentinel lies inside
            if not len(gram):
                break
            both = gram * len(distinct) + word[n - 1:]
            pair, gram = np.unique(both, return_inverse=True)
            sums = np.array([crc32(b" " + distinct[w], s) for w, s in zip((pair % len(distinct)).tolist(), sums[pair // len(distinct)].tolist(), strict=True)], np.int64)
            found.append(sums[gram[valid]] % buckets)
            owner.append(row[:len(gram)][valid])
        yield b, e, np.bincount(row[real], minlength=e - b), np.concatenate(found), np.concatenate(owner)


def bucket_counts(rows: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall in each bucket. Tasks hand on their sums: ``buckets`` rows each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, bucket, _ in features(pieces.as_text(batch.column(0)), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select(rows[text_col].cast("string")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Of each bucket, a thousand times the log ratio of its smoothed shares, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (s_all + size) / (float(s + 1) * (t_all + size))))
                     for t, s in zip(target.tolist(), corpus.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A thousand times a Gumbel variate that depends on the id only, rounded down. A null id is the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, n_features, weight, score (weight and noise). No shuffle."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e, words, bucket, row in features(pieces.as_text(batch.column(1)), longest, len(gain)):
                many = np.bincount(row, minlength=e - b)
                weight = np.zeros(e - b, np.int64)
                np.add.at(weight, row, gain[bucket])
                ids = batch.column(0).slice(b, e - b)
                score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.array(words.astype(np.int64)), pa.array(many.astype(np.int64)), pa.array(weight), pa.array(score)],
                                                 ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weighed`` with rank: 1, 2, 3, ... by falling score (ties to the smaller doc_id, null ids last) for
    the given percent, rounded down, of the rows with enough words; null for all others.

    Rows are dealt out by ranges of (score, doc_id), so no task orders them
    all: a rank is the rows of the ranges before and the place in the range.
    The driver gets one count per range.
    """
    spark = weighed.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    able = F.col("n_words") >= least_words
    ranged = materialize(weighed.where(able).repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "resample-ranges")
    before, total = [], 0
    for part, n in sorted(ranged.groupBy("range").count().collect()):
        before.append((part, total))
        total += n
    drawn = percent * total // 100
    first = spark.createDataFrame(before, "range int, before long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = ranged.withColumn("place", place).join(F.broadcast(first), "range").withColumn("rank", F.col("before") + F.col("place"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*weighed.columns, "rank")
    return ranked.unionByName(weighed.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null if not drawn).

    Null and empty texts have no features and weight 0; very long ones are
    counted whole; repeated rows give repeated rows, each with a rank of its own; a row
    without an id takes part with the noise of an empty id; an empty target
    leaves only how rare a bucket is; an empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    gain = gains(bucket_counts(target, longest, buckets, target_col), bucket_counts(docs, longest, buckets, text_col))
    return draw(materialize(weigh(docs, gain, longest, seed, id_col, text_col), "resample-weights"), percent, least_words)
