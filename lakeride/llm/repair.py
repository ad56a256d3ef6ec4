"""Token-ID output: shard files compressed by a Re-Pair grammar.

Documents are dealt by ranges of their id, so the files hold them in ascending
order. A shard takes whole documents up to a number of ids. Its grammar grows
in rounds: all neighbouring id pairs are counted, the frequent ones become
nonterminals and are replaced. The shard stores the rules, the expansion
length of each rule and the final string, so any range of ids can be decoded
without the rest.

File format: a Parquet row for each shard, written by Spark's committer (so a
lost executor leaves no half files): part, shard, n_ids, offset (ids before it
in its part), doc_ids, doc_tokens and payload. Payload, little-endian: magic
``RPR1``; uint32 terminals t, rules r, symbols s; t x uint32 terminal ids;
r x uint32 left, r x uint32 right (a symbol below t is a terminal, t + k is
rule k, which refers to lower symbols only); r x uint32 expansion lengths;
s x symbol, as uint16 if t + r < 65536, else uint32.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pieces

MAGIC = b"RPR1"
#: ids of a shard (a longer document has a shard of its own)
SHARD_IDS = 1 << 20
RULES_A_ROUND, LEAST_USES = 4096, 8
#: words whose ids a task remembers
CACHE_WORDS = 800_000

SHARD_SCHEMA = ("part int, shard int, n_ids long, offset long, doc_ids array<long>, "
                "doc_tokens array<long>, payload binary")


def compress(ids: np.ndarray, rules_a_round: int = RULES_A_ROUND, least_uses: int = LEAST_USES) -> bytes:
    """The payload of one shard: rounds of replacements until no pair has ``least_uses``. An empty shard has
    no terminals, rules or symbols."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) and int(ids.max()) < 1 << 24:
        seen = np.flatnonzero(np.bincount(ids)).astype(np.uint32)
        dense = np.zeros(int(ids.max()) + 1, np.uint32)
        dense[seen] = np.arange(len(seen), dtype=np.uint32)
        seq = dense[ids]
    else:
        seen, seq = np.unique(ids, return_inverse=True)
        seq = seq.astype(np.uint32)
    terminals = len(seen)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    symbols = terminals
    length = np.ones(terminals, np.uint32)
    while len(seq) >= 2 * least_uses:
        wide = symbols + rules_a_round > 0xFFFF
        code = (seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]) if wide else (seq[:-1] << np.uint32(16) | seq[1:])
        a, b, at, rule = _choose(code, rules_a_round, least_uses)
        if not len(a):
            break
        if wide:
            seq = seq.copy()
        seq[at] = symbols + rule
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        left.append(a)
        right.append(b)
        length = np.concatenate([length, length[a] + length[b]])
        symbols += len(a)
    first = np.concatenate(left).astype(np.uint32) if left else np.empty(0, np.uint32)
    second = np.concatenate(right).astype(np.uint32) if right else np.empty(0, np.uint32)
    return b"".join([MAGIC, np.array([terminals, len(first), len(seq)], "<u4").tobytes(),
                     seen.astype("<u4").tobytes(), first.astype("<u4").tobytes(), second.astype("<u4").tobytes(),
                     length[terminals:].astype("<u4").tobytes(),
                     seq.astype("<u2" if symbols < 1 << 16 else "<u4").tobytes()])


def _choose(code: np.ndarray, most: int, least_uses: int):
    """Frequent pairs and where to replace them: (left, right, positions, rule of each position)."""
    half = np.uint64(32) if code.dtype == np.uint64 else np.uint32(16)
    mask = code.dtype.type((1 << int(half)) - 1)
    none = (np.empty(0, np.uint32),) * 4
    # a pair with enough uses is the same that many places further on in the sorted list
    ordered = np.sort(code)
    same = np.flatnonzero(ordered[least_uses - 1:] == ordered[:len(ordered) - least_uses + 1])
    if not len(same):
        return none
    edge = np.flatnonzero(np.concatenate([[True], ordered[same[1:]] != ordered[same[:-1]]]))
    count, often = np.diff(np.append(edge, len(same))), np.arange(len(edge))
    if len(often) > most:
        often = often[np.argpartition(-count, most)[:most]]
    often = often[np.argsort(-count[often], kind="stable")]
    pair = ordered[same[edge[often]]]
    # a small hash table finds the chosen pairs; of pairs that meet in a cell, the more frequent stays this round
    mix, shift = (np.uint64(0x9E3779B97F4A7C15), np.uint64(46)) if code.dtype == np.uint64 else (np.uint32(0x9E3779B1), np.uint32(14))
    cell = lambda c: (c * mix) >> shift
    rule_of, pair_in = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, code.dtype)
    pair_in[0] = 1  # an empty cell holds a pair that belongs elsewhere
    where = cell(pair)[::-1]
    rule_of[where], pair_in[where] = np.arange(len(pair), dtype=np.int32)[::-1], pair[::-1]
    spot = cell(code)
    at = np.flatnonzero(pair_in[spot] == code)
    # neighbours overlap: in a run of touching positions every second one is taken
    run = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
    at = at[(np.arange(len(at)) - begin) % 2 == 0]
    hit = rule_of[spot[at]]
    uses = np.bincount(hit, minlength=len(pair))
    kept = np.flatnonzero(uses >= 3)
    rank = np.full(len(pair), -1, np.int64)
    rank[kept] = np.arange(len(kept))
    rule = rank[hit]
    at, rule = at[rule >= 0], rule[rule >= 0]
    return (pair[kept] >> half).astype(np.uint32), (pair[kept] & mask).astype(np.uint32), at, rule.astype(np.uint32)


class Shard:
    """A payload opened for random access."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a Re-Pair shard")
        t, r, s = np.frombuffer(payload, "<u4", 3, 4).tolist()
        u4 = np.frombuffer(payload, "<u4", t + 3 * r, 16)
        self.ids, left, right, length = np.split(u4, [t, t + r, t + 2 * r])
        self.symbols = np.frombuffer(payload, "<u2" if t + r < 1 << 16 else "<u4", s, 16 + 4 * (t + 3 * r)).astype(np.int64)
        self.length = np.concatenate([np.ones(t, np.int64), length.astype(np.int64)])
        self.end = np.cumsum(self.length[self.symbols])
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64) if t else np.empty(0, np.int64)
        self.flat = np.empty(int(self.length.sum()), np.uint32)
        self.flat[:t] = self.ids
        # rules that refer to known symbols only are expanded together: as many steps as the grammar had rounds
        newest, known = np.maximum.accumulate(np.maximum(left, right)) if r else left, 0
        while known < r:
            upto = int(np.searchsorted(newest, t + known))
            if upto == known:
                raise ValueError("a rule refers to a symbol that is not lower")
            for side, begin in ((left, self.start[t + known:t + upto]), (right, self.start[t + known:t + upto] + self.length[left[known:upto]])):
                many = self.length[side[known:upto]]
                self.flat[pieces.ragged(begin, many)] = self.flat[pieces.ragged(self.start[side[known:upto]], many)]
            known = upto

    def decode(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``begin`` up to ``end``; only the symbols that cover them are expanded."""
        end = (int(self.end[-1]) if len(self.end) else 0) if end is None else end
        if begin >= end:
            return np.empty(0, np.uint32)
        i, j = np.searchsorted(self.end, begin, "right"), np.searchsorted(self.end, end, "left") + 1
        own = self.symbols[i:j]
        out = self.flat[pieces.ragged(self.start[own], self.length[own])]
        skip = begin - (int(self.end[i - 1]) if i else 0)
        return out[skip:skip + end - begin]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, parts: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", keep_spaces: bool = True,
              shard_ids: int = SHARD_IDS) -> None:
    """Encodes whole texts and writes shard files in ascending id order (null ids first).

    Rows with the same id follow each other by text. A null text is empty (its
    end id alone). An empty table writes no shards. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range bounds come from the ids alone, so the texts are read and shuffled once
    bounds = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100_000)).head()[0] if parts > 1 else []
    bounds = sorted(set(bounds or []))
    spot = F.lit(0)
    if bounds:
        spot = F.coalesce(F.size(F.filter(F.lit(bounds), lambda b: b < F.col("doc_id"))), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces.library_coder(tokenizer, keep_spaces, CACHE_WORDS)
        part = TaskContext.get().partitionId()
        docs_here: list = []
        chunks: list[np.ndarray] = []
        counts: list[int] = []
        state = {"shard": 0, "offset": 0, "n": 0}

        def flush():
            if docs_here:
                payload = compress(np.concatenate(chunks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([state["shard"]], pa.int32()), pa.array([state["n"]], pa.int64()),
                     pa.array([state["offset"]], pa.int64()), pa.array([list(docs_here)], pa.list_(pa.int64())),
                     pa.array([list(counts)], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                    ["part", "shard", "n_ids", "offset", "doc_ids", "doc_tokens", "payload"])
                state.update(shard=state["shard"] + 1, offset=state["offset"] + state["n"], n=0)
                docs_here.clear(), chunks.clear(), counts.clear()

        for batch in batches:
            text = pieces.as_text(batch.column(1))
            for b, e in pieces.slices(text):
                ids, count = coder(text.slice(b, e - b))
                edge = np.concatenate([[0], np.cumsum(count)]).tolist()
                for k, doc in enumerate(batch.column(0).slice(b, e - b).to_pylist()):
                    if state["n"] and state["n"] + edge[k + 1] - edge[k] >= shard_ids:
                        yield from flush()
                    chunks += [ids[edge[k]:edge[k + 1]].astype(np.uint32), np.array([end_id], np.uint32)]
                    docs_here.append(doc)
                    counts.append(edge[k + 1] - edge[k] + 1)
                    state["n"] += counts[-1]
        yield from flush()

    (rows.repartitionById(parts, spot.cast("int")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(run, SHARD_SCHEMA).write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Only one row per file
    part meets in one task, for the running total of the parts.
    """
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    before = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    # one row per file part, so the broadcast is bounded by the number of parts
    shards = files.join(F.broadcast(before), "part").select((F.col("before") + F.col("offset")).alias("base"),
                                               "doc_ids", "doc_tokens", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, doc_ids, tokens, payload in zip(*(batch.column(i) for i in range(4)), strict=True):
                shard = Shard(payload.as_py())
                ids = shard.decode()
                many = np.array(tokens.as_py(), np.int64)
                edge = np.concatenate([[0], np.cumsum(many)])
                crc = [pieces.crc32_of(ids[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids.as_py(), pa.int64()), pa.array(base.as_py() + edge[:-1], pa.int64()),
                     pa.array(many, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
