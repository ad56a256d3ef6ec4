"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set is posted under each (coordinate, minimum) pair of
its signature. Two sets are candidates if they agree on ``least_match`` of
``coordinates`` pairs. Pairs that only one set has are dropped; of a set's m
other pairs the rarest m - least_match + 1 are its prefix, and two sets that
agree on enough pairs must share one of their prefix pairs, so only prefixes
are joined and the frequent pairs are skipped.

A posting list is not expanded into all pairs. First each of its sets is
compared with the list's hub only, the set whose pairs are the most frequent
(in a group of near copies: their origin). Links that the full shingle sets
confirm make components. Only sets of lists that hold several components can
still have links between components; an exact join over the rarest shingles
of these sets finds them. Sets in one component need no further comparison,
so no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import pieces
from .components import components

#: bounds of a task's memory: bytes of text handled at once, words whose hash it remembers
SLICE_BYTES, CACHE_WORDS = 3 << 20, 200_000
WORD_RULE = rb"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Params:
    """``least_match``: a pair at the similarity limit agrees on 51 of 64 coordinates on average,
    with a standard deviation of 3.2; fewer than 34 have a chance of about one in ten million."""

    words: int = 5
    percent: int = 80
    coordinates: int = 64
    least_match: int = 34
    seed: int = 7


_CODER: list[pieces.PieceCoder] = []


def _code(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each piece, A-Z lower-cased."""
    import re

    from xxhash import xxh3_64_intdigest

    find = re.compile(WORD_RULE).findall
    out: list[int] = []
    counts = np.zeros(len(chunks), np.int64)
    for i, c in enumerate(chunks):
        words = find(c.encode().lower())  # bytes: only A-Z change
        out += [xxh3_64_intdigest(w) for w in words]
        counts[i] = len(words)
    return np.array(out, np.uint64), counts


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(text: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, distinct shingle hashes ascending per text, their number per text)."""
    if not _CODER:
        _CODER.append(pieces.PieceCoder(pieces.split_dropping_spaces, _code, CACHE_WORDS, np.uint64))
    odd = (np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for b, e in pieces.slices(text, SLICE_BYTES):
        word, many = _CODER[0](text.slice(b, e - b))
        length = np.where(many >= words, many - words + 1, np.minimum(many, 1))
        first = np.cumsum(many) - many
        at = pieces.ragged(first, length)
        own = np.repeat(np.arange(e - b), length)
        size = np.minimum(many, words)[own]
        hashed = size.astype(np.uint64)
        for k in range(words):
            inside = size > k
            hashed = hashed + np.where(inside, _mix(word[np.where(inside, at + k, 0)] + odd[k]) * odd[k], np.uint64(0)) if len(word) else hashed
        hashed = _mix(hashed)
        edge = np.concatenate([[0], np.cumsum(length)]).tolist()
        sets = [np.unique(hashed[x:y]) for x, y in zip(edge, edge[1:], strict=False)]
        yield b, e, np.concatenate([np.empty(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the whole set, null if empty), pairs (coordinate-value pairs)."""
    rng = np.random.default_rng(p.seed)
    odd = rng.integers(0, 1 << 63, p.coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, p.coordinates, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e, flat, many in shingle_sets(pieces.as_text(batch.column(1)), p.words):
                full = np.flatnonzero(many)
                start = (np.cumsum(many) - many)[full]
                least = np.empty((len(full), p.coordinates), np.uint64)
                for i in range(p.coordinates if len(full) else 0):
                    least[:, i] = np.minimum.reduceat((flat ^ flip[i]) * odd[i], start)
                pairs = _mix(least + flip).view(np.int64)  # a value of its own for each coordinate
                rows: list = [None] * (e - b)
                ids: list = [None] * (e - b)
                for j, r in enumerate(full.tolist()):
                    rows[r] = pairs[j]
                    ids[r] = hashlib.blake2b(flat[start[j]:start[j] + many[r]].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b, e - b), pa.array(many), pa.array(ids, pa.binary()), pa.array(rows, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_id", "pairs"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, pairs array<long>")


def _sets(docs: DataFrame, p: Params) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, e, flat, many in shingle_sets(pieces.as_text(batch.column(1)), p.words):
                sets = np.split(flat, np.cumsum(many)[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(b, e - b), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["node", "shingles"])

    return docs.mapInArrow(run, "node long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (u, v) if len(u) <= len(v) else (v, u)
                at = np.minimum(np.searchsorted(large, small), max(0, len(large) - 1))
                same = int((large[at] == small).sum()) if len(large) else 0
                keep.append(100 * same >= percent * (len(u) + len(v) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    # two sets of very different sizes cannot be similar enough
    n_x, n_y = F.octet_length("x"), F.octet_length("y")
    return (both.where((100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y))).select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long"))


#: sets whose sizes differ by at most this factor are in one size class
CLASS = 1.05


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in ``rest(node, component)`` that can be similar enough.

    Two sets of sizes x and y need an overlap of o = t / (1 + t) * (x + y), so
    with one order of all shingles, rarest first, they share one among the
    first x - o + 1 of the one and y - o + 1 of the other. A shingle is posted
    under its own and each possible partner's size class only where its
    position allows that. Edited copies of one origin that are too far from
    it have more shingles of their own than that and are not posted at all,
    so a large family of them makes no pairs.
    """
    t = percent / 100
    few = rest.join(sets, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, component, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                token = np.frombuffer(data.as_buffer(), np.int64)
                k = len(token)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, node)), pa.array(np.full(k, component)),
                                                  pa.array(np.full(k, k)), pa.array(token)], ["node", "component", "n", "token"])

    tokens = few.select("node", "component", "shingles").mapInArrow(run, "node long, component long, n long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # at most the shingles of one set meet in a group here
    order = tokens.join(often, "token").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"))
    alone = F.col("n") - F.size("known")
    posted = (order.where(alone <= F.col("n") * (1 - t) + 1).select("node", "component", "n", alone.alias("alone"), F.posexplode("known"))
              .select("node", "component", "n", F.col("col.token").alias("token"), (F.col("alone") + F.col("pos") + 1).alias("at")))
    own = F.floor(F.log(F.col("n")) / F.log(F.lit(CLASS)) + 1e-9).cast("int")
    reach = int(np.ceil(np.log(1 / t) / np.log(CLASS))) + 1
    smallest = F.pow(F.lit(CLASS), F.col("partner")) * (1 - 1e-6)
    posted = (posted.where(F.col("at") <= F.col("n") * (1 - t) + 1 + 1e-6).withColumn("own", own)
              .withColumn("partner", F.explode(F.sequence(F.col("own") - reach, F.col("own") + reach)))
              .where(F.col("at") <= F.col("n") - t / (1 + t) * (F.col("n") + smallest) + 1 + 1e-6))
    left = posted.select("token", F.col("own").alias("i"), F.col("partner").alias("j"), F.col("node").alias("x"),
                         F.col("component").alias("p"), F.col("n").alias("n_x"), F.col("at").alias("at_x"))
    right = posted.select("token", F.col("partner").alias("i"), F.col("own").alias("j"), F.col("node").alias("y"),
                          F.col("component").alias("q"), F.col("n").alias("n_y"), F.col("at").alias("at_y"))
    # the classes allow a little more than the two sizes themselves do
    overlap = t / (1 + t) * (F.col("n_x") + F.col("n_y")) - 1e-6
    both = left.join(right, ["token", "i", "j"]).where((F.col("x") < F.col("y")) & (F.col("p") != F.col("q")) & (
        F.col("at_x") <= F.col("n_x") - overlap + 1) & (F.col("at_y") <= F.col("n_y") - overlap + 1))
    both = both.select(F.col("x").alias("a"), F.col("y").alias("b"))
    return both.distinct()


def _matching(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree on ``least`` coordinates."""
    agree = F.size(F.filter(F.zip_with("p", "q", lambda x, y: x == y), lambda same: same))
    return (pairs.join(nodes.select(F.col("node").alias("a"), F.col("pairs").alias("p")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("pairs").alias("q")), "b")
            .where(agree >= least).select("a", "b"))


def near_duplicates(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach; kept marks the
    document that has it. A null or empty text has no shingles and no links; a
    text with fewer words than a shingle is one shingle. A null id cannot be
    linked: its component is null and it is kept. Repeated rows give repeated
    rows; rows that share an id and are each the first of their copies count
    as one document. An empty table gives no rows. Other columns are ignored,
    whatever their names.
    """
    p = params
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    signed = materialize(signatures(rows, p), "minhash")
    # equal sets are one node, named by their smallest id
    classes = materialize(signed.where("set_id is not null and doc_id is not null").groupBy("set_id")
                          .agg(F.min("doc_id").alias("node")), "minhash-classes")
    nodes = materialize(signed.join(classes, "set_id").where("doc_id = node").groupBy("node").agg(
        F.min("pairs").alias("pairs")), "minhash-nodes")
    posted = nodes.select("node", F.explode("pairs").alias("pair"))
    shared = posted.groupBy("pair").agg(F.count("*").alias("df")).where("df > 1")
    # at most one entry per coordinate meets in a group here
    ranked = (posted.join(shared, "pair").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("df", "pair"))).alias("known"), F.sum("df").alias("weight"))
              .where(F.size("known") >= p.least_match))
    prefix = F.slice(F.col("known.pair"), F.lit(1), F.size("known") - (p.least_match - 1))
    postings = materialize(ranked.select("node", "weight", F.explode(prefix).alias("pair")), "minhash-postings")
    lists = postings.groupBy("pair").agg(F.max(F.struct("weight", (-F.col("node")).alias("least"))).alias("hub"), F.count("*").alias("n"))
    lists = lists.where("n > 1").select("pair", (-F.col("hub.least")).alias("hub"))
    nodes_here = materialize(postings.select("node").distinct(), "minhash-candidates")  # its size decides how it is joined
    held = nodes.join(nodes_here, "node", "left_semi")
    stars = postings.join(lists, "pair").where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    stars = materialize(_matching(stars, held, p.least_match), "minhash-stars")
    # full sets are made again only for nodes that have a candidate
    sets = materialize(_sets(rows.join(nodes_here, rows["doc_id"] == nodes_here["node"], "left_semi"), p).groupBy("node").agg(
        F.min("shingles").alias("shingles")), "minhash-sets")
    links = materialize(_confirmed(stars, sets, p.percent), "minhash-links")
    parts = materialize(components(links), "minhash-parts")
    # lists whose sets lie in different components: their sets are compared by an exact join
    placed = postings.join(parts, "node", "left").select("pair", "node", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("pair").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("pair")
    rest = materialize(placed.join(split, "pair", "left_semi").select("node", "component").distinct(), "minhash-rest")
    cross = _prefix_pairs(rest, sets, p.percent).join(stars, ["a", "b"], "left_anti")
    more = _confirmed(materialize(cross, "minhash-cross"), sets, p.percent)
    final = components(links.unionByName(materialize(more, "minhash-more")))
    named = classes.join(final, "node", "left").select("set_id", F.coalesce("component", "node").alias("first"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
