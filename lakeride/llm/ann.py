"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beam.

Vectors are dealt to shards by a hash of id and vector. A shard's graph is built in
batches: beam searches over the graph so far propose neighbours, relaxed
distance pruning keeps diverse edges, and reverse edges are pruned the same
way. Every node then gets in-edges from near nodes until the searches can reach
it. All searches of a batch advance together as numpy arrays. Equal vectors
are one node with a list of ids.

A built shard is kept as rows of at most PIECE_BYTES in small row groups, so
that writers and readers need little heap; the Python worker that searches a
shard puts its pieces together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .pieces import ragged

#: vectors of a shard on average; out-edges of a node; beam of the build; beam of a query
SHARD_ROWS, DEGREE, BUILD_BEAM, QUERY_BEAM = 4096, 24, 48, 256
#: in-edges that a node has at least, and further out-edges of a node that hold them
LEAST_IN, LINKS = 3, 8
#: pruning: an edge is dropped if a kept neighbour is ALPHA times nearer to its end
ALPHA = 1.2
#: queries that travel and search together
QUERY_BLOCK = 256
#: bytes of a built shard in one row
PIECE_BYTES = 256 << 10
#: a writer keeps a row group on the heap (by default 128 MB in each task), and looks at its size every hundred rows unless told otherwise
WRITER = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: where there are more than SEARCH_TASKS shards, a task searches several, HELD_SHARDS at most, for the queries that it gets once
SEARCH_TASKS, HELD_SHARDS = 128, 32


def _distances(x: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of each x[i] to data[at[i, j]]; at < 0: infinite."""
    out = np.einsum("ijk,ijk->ij", d := data[np.maximum(at, 0)] - x[:, None, :], d)
    return np.where(at >= 0, out, np.inf)


def beam_search(queries: np.ndarray, data: np.ndarray, graph: np.ndarray, entry: np.ndarray, beam: int):
    """(nodes, squared distances) of the ``beam`` nearest found, nearest first, for all queries at once.

    Each round opens the nearest unopened node of every beam and merges its
    out-neighbours; it ends when all beams are open. ``entry``: start nodes.
    """
    n = len(queries)
    nodes = np.full((n, beam), -1, np.int64)
    first = min(len(entry), beam)
    nodes[:, :first] = entry[:first]
    dist = _distances(queries, data, nodes)
    order = np.argsort(dist, axis=1, kind="stable")
    nodes, dist = np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)
    opened = nodes < 0
    # a node that a beam had or turned down is not new to it again; the last column is for -1
    known = np.zeros((n, len(data) + 1), bool)
    known[:, -1] = True
    known[np.arange(n)[:, None], nodes] = True
    active = np.arange(n)
    while len(active):
        at = np.argmax(~opened[active], 1)
        todo = ~opened[active, at]
        active, at = active[todo], at[todo]
        if not len(active):
            break
        opened[active, at] = True
        near = graph[nodes[active, at]]
        row, column = np.nonzero(~known[active[:, None], near])
        new, owner = near[row, column].astype(np.int64), active[row]
        known[owner, new] = True
        d = data[new] - queries[owner]
        d = np.einsum("ij,ij->i", d, d)
        # only what is nearer than the last of the beam comes in
        row, new, d = (x[d < dist[owner, -1]] for x in (row, new, d))
        if not len(row):
            continue
        rows, many = np.unique(row, return_counts=True)
        some, width = active[rows], int(many.max())
        slot = np.repeat(np.arange(len(rows)), many), beam + ragged(np.zeros(len(rows), np.int64), many)
        merged, far, done = (np.full((len(rows), beam + width), x) for x in (np.int64(-1), np.inf, True))
        merged[:, :beam], far[:, :beam], done[:, :beam] = nodes[some], dist[some], opened[some]
        merged[slot], far[slot], done[slot] = new, d, False
        keep = np.argsort(far, axis=1, kind="stable")[:, :beam]
        nodes[some] = np.take_along_axis(merged, keep, 1)
        dist[some] = np.take_along_axis(far, keep, 1)
        opened[some] = np.take_along_axis(done, keep, 1)
    return nodes, dist


def robust_prune(data: np.ndarray, owners: np.ndarray, candidates: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Out-edges of each owner from its candidates (-1: none): nearest first, and none that a
    kept one is ``alpha`` times nearer to than the owner is. All owners at once."""
    cand = np.where(candidates == owners[:, None], -1, candidates)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    dist = _distances(data[owners], data, cand)
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    alive = cand >= 0
    # distances between candidates from inner products, seen from their owner
    seen_from = data[np.maximum(cand, 0)] - data[owners][:, None, :]
    inner = seen_from @ seen_from.transpose(0, 2, 1)
    length = np.einsum("ijj->ij", inner)
    out = np.full((len(owners), degree), -1, np.int64)
    rows = np.arange(len(owners))
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        at = np.argmax(alive, 1)
        picked = np.where(has, cand[rows, at], -1)
        out[:, k] = picked
        to_picked = np.maximum(length + length[rows, at][:, None] - 2 * inner[rows, at], 0.0)
        alive &= ~((alpha * alpha * to_picked <= dist) & has[:, None])
        alive[rows, at] = False
    return out


def build_graph(data: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(graph: out-neighbours of each node, -1 for none; entry nodes)."""
    n = len(data)
    graph = np.full((n, degree), -1, np.int32)
    if not n:
        return graph, np.empty(0, np.int64)
    center = int(np.argmin(((data - data.mean(0)) ** 2).sum(1)))
    entry = np.unique(np.concatenate([[center], np.linspace(0, n - 1, min(n, 8)).astype(np.int64)]))
    rest = np.setdiff1d(np.arange(n), entry)
    order = np.concatenate([entry, np.random.default_rng(11).permutation(rest)])
    done = 0
    while done < n:  # each batch is at most as large as what is there already
        batch = order[done:done + max(len(entry), min(512, done))] if done else entry
        if done:
            found, _ = beam_search(data[batch], data, graph, entry, beam)
        else:
            found = np.tile(batch, (len(batch), 1))
        out = robust_prune(data, batch, found, degree)
        graph[batch] = out
        # reverse edges: each end takes its new sources, nearest first and in chunks, and is pruned again
        source, target = np.repeat(batch, degree), out.ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.lexsort((source, ((data[source] - data[target]) ** 2).sum(1), target))
        source, target = source[by], target[by]
        ends, many = np.unique(target, return_counts=True)
        rank = ragged(np.zeros(len(ends), np.int64), many)
        for low in range(0, int(many.max(initial=0)), 4 * degree):
            here = (rank >= low) & (rank < low + 4 * degree)
            some = ends[many > low]
            new = np.full((len(some), int(rank[here].max()) - low + 1), -1, np.int64)
            new[np.searchsorted(some, target[here]), rank[here] - low] = source[here]
            for x in range(0, len(some), 512):
                own = some[x:x + 512]
                graph[own] = robust_prune(data, own, np.concatenate([graph[own].astype(np.int64), new[x:x + 512]], 1), degree)
        done += len(batch)
    return link_unreached(data, graph, entry, beam), entry


def reachable(graph: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which nodes a walk from the entry nodes can come to."""
    seen = np.zeros(len(graph), bool)
    seen[entry] = True
    front = entry
    while len(front):
        near = np.unique(graph[front])
        front = near[(near >= 0) & ~seen[np.maximum(near, 0)]]
        seen[front] = True
    return seen


def link_unreached(data: np.ndarray, graph: np.ndarray, entry: np.ndarray, beam: int,
                   least_in: int = LEAST_IN, links: int = LINKS) -> np.ndarray:
    """``graph`` with ``links`` more out-edges a node, so that every node is reachable and has in-edges.

    Each unreached node is linked once, from the nearest node that a search
    finds and that has room. Every node so linked brings room of its own, so
    there is always a reachable node with room, and the rounds end with all
    nodes reachable. Then nodes with fewer than ``least_in`` in-edges get
    further ones from the nearest nodes with room.
    """
    n, degree = graph.shape
    wide = np.concatenate([graph, np.full((n, links), -1, np.int32)], 1)
    used = np.zeros(n, np.int64)

    def link(todo: np.ndarray, need: np.ndarray) -> int:
        placed = 0
        for at in range(0, len(todo), 512):
            part = todo[at:at + 512]
            hosts, _ = beam_search(data[part], data, wide, entry, beam)
            for node, near, many in zip(part.tolist(), hosts.tolist(), need[part].tolist(), strict=True):
                for host in near:
                    if many and host >= 0 and host != node and used[host] < links and node not in wide[host]:
                        wide[host, degree + used[host]] = node
                        used[host] += 1
                        placed, many = placed + 1, many - 1
        return placed

    while not (seen := reachable(wide, entry)).all():
        todo = np.flatnonzero(~seen)
        if not link(todo, np.ones(n, np.int64)):
            host = int(np.flatnonzero(seen & (used < links))[0])
            wide[host, degree + used[host]] = todo[0]
            used[host] += 1
    into = np.bincount(wide[wide >= 0], minlength=n)
    link(np.flatnonzero(into < least_in), least_in - into)
    return wide


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the rows that take part: no null, no zero vector, only finite components. Floats stay floats, all else is doubles."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("vec"))
    if v.schema["vec"].dataType.simpleString() != "array<float>":
        v = v.withColumn("vec", F.col("vec").cast("array<double>"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
                   & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))


def _hash(*columns: str) -> Column:
    """The same for a vector of floats and of doubles."""
    return F.xxhash64(*(F.col(c).cast("array<double>") if c == "vec" else F.col(c) for c in columns))


def _counted(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, copies): rows that repeat id and vector are counted, map-side first."""
    return vectors.groupBy("vec_id", "vec").agg(F.count("*").alias("copies"))


def _packed(ids: np.ndarray, copies: np.ndarray, sizes: np.ndarray, data: np.ndarray, graph: np.ndarray, entry: np.ndarray) -> bytes:
    """A built shard as bytes; vectors that floats hold exactly are kept as floats."""
    with np.errstate(over="ignore"):
        short = data.astype(np.float32)
    vecs = short if (short == data).all() else data
    head = np.array([len(ids), len(data), len(entry), vecs.itemsize], np.int64)
    return b"".join(x.tobytes() for x in (head, ids, copies, sizes, entry, vecs, graph))


def _unpacked(payload: bytes, dim: int) -> tuple[np.ndarray, ...]:
    """(ids, copies, sizes, data, graph, entry) of what ``_packed`` made."""
    n_ids, n, n_entry, width = np.frombuffer(payload, np.int64, 4).tolist()
    at, out = 32, []
    for kind, many in ((np.int64, n_ids), (np.int64, n_ids), (np.int64, n), (np.int64, n_entry), (f"f{width}", n * dim)):
        out.append(np.frombuffer(payload, kind, many, at))
        at += out[-1].nbytes
    ids, copies, sizes, entry, vecs = out
    return ids, copies, sizes, vecs.astype(np.float64).reshape(n, dim), np.frombuffer(payload, np.int32, offset=at).reshape(n, -1), entry


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """Shards by length of vector, each in rows (shard, dim, part, piece) of at most PIECE_BYTES; and the number of shards."""
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))

    def build(key, frame):
        import pandas as pd

        data = np.array(frame["vec"].tolist(), np.float64)
        ids, copies = frame["vec_id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
        _, first, group = np.unique(data, axis=0, return_index=True, return_inverse=True)
        data = data[first]  # in the order of the vectors, however the rows came
        order = np.lexsort((ids, group.ravel()))  # ids of a node ascend
        size = np.bincount(group.ravel(), minlength=len(first)).astype(np.int64)
        graph, entry = build_graph(data)
        payload = _packed(ids[order], copies[order], size, data, graph, entry)
        pieces = [payload[x:x + PIECE_BYTES] for x in range(0, len(payload), PIECE_BYTES)]
        return pd.DataFrame({"shard": key[0], "dim": key[1], "part": range(len(pieces)), "piece": pieces})

    dealt = _counted(vectors).select(F.pmod(_hash("vec_id", "vec"), F.lit(shards)).cast("int").alias("shard"),
                                     F.size("vec").alias("dim"), "vec_id", "vec", "copies")
    index = dealt.groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, part int, piece binary")
    return materialize(index, "ann-index", WRITER), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int = 10, beam: int = QUERY_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest found in all shards.

    Queries travel in blocks, and every block visits every shard. The shards
    are dealt to tasks; a task reads the pieces of its shards first and then
    block after block, which searches each of them. A task answers with its k
    best, so what is merged per query is k rows a task.
    """
    counted = _counted(queries)
    tasks = -(-shards // min(HELD_SHARDS, max(1, shards // SEARCH_TASKS)))
    # queries that share an id are told apart by a hash of their vector
    block = F.pmod(_hash("vec_id", "vec"), F.greatest(F.lit(1), F.ceil(F.lit(counted.count()) / QUERY_BLOCK))).cast("int")
    blocks = (counted.select(F.size("vec").alias("dim"), block.alias("block"), F.struct("vec_id", "vec", "copies", _hash("vec").alias("hash")).alias("q"))
              .groupBy("dim", "block").agg(F.collect_list("q").alias("q")))
    visits = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "dim", "q")
    pieces = index.select(F.pmod("shard", F.lit(tasks)).alias("task"), "dim", "shard", "part", "piece")
    # within a task and a length the pieces come before the queries, which have no shard
    both = (pieces.unionByName(visits, allowMissingColumns=True).repartitionById(tasks, F.col("task"))
            .sortWithinPartitions("dim", F.col("shard").asc_nulls_last(), "part").select("dim", "shard", "piece", "q"))

    def answers(held: dict[int, list[bytes]], dim: int, q: list[dict]) -> pa.RecordBatch:
        x = np.array([one["vec"] for one in q], np.float64)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in q]
        for payload in held.values():
            ids, copies, size, data, graph, entry = _unpacked(b"".join(payload), dim)
            nodes, _ = beam_search(x, data, graph, entry, max(beam, k + 1))
            first = np.cumsum(size) - size
            for j, one in enumerate(q):
                hit = nodes[j][nodes[j] >= 0]
                score = np.sqrt(((data[hit] - x[j]) ** 2).sum(1))
                many = np.minimum(size[hit], k + 1)  # the smallest ids of equal vectors are enough
                at = ragged(first[hit], many)
                score, vec = np.repeat(score, many), ids[at]
                # the query's own row is no candidate, its copies are
                times = np.minimum(copies[at] - ((vec == one["vec_id"]) & (score == 0)), k)
                score, vec = np.repeat(score, times), np.repeat(vec, times)
                best = np.lexsort((vec, score))[:k]
                found[j].append((vec[best], score[best]))
        out: list[list] = [[] for _ in range(5)]
        for one, parts in zip(q, found, strict=True):
            vec, score = (np.concatenate(c) for c in zip(*parts, strict=True))
            best = np.lexsort((vec, score))[:k]
            for column, part in zip(out, (np.full(len(best), one["vec_id"]), np.full(len(best), one["hash"]),
                                          np.full(len(best), one["copies"]), vec[best], score[best]), strict=True):
                column.append(part)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "hash", "times", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, held = None, {}
        for batch in batches:
            dims, owners = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (dim, shard) in enumerate(zip(dims, owners, strict=True)):
                if dim != length:
                    length, held = dim, {}
                if shard is not None:
                    held.setdefault(shard, []).append(batch.column(2)[i].as_py())
                elif held:  # no shard of this length: nothing to find here
                    yield answers(held, dim, batch.column(3)[i].as_py())

    found = both.mapInArrow(run, "query_id long, hash long, times long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "hash").orderBy("score", "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    # a query row that is there several times is answered as often
    return best.select("query_id", "rank", "vec_id", "score", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).drop("col")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Indexes all of ``vectors`` (vec_id, embedding) and finds the k nearest of each query row (Euclidean).

    A query's own row is no candidate; other rows with its id are, and each of
    them is a query of its own. Ties go to the smaller id. Rows whose vector is
    null, zero, or holds null or non-finite components take no part, nor do
    null ids; vectors are compared with those of their own length only. Empty
    tables give no rows. Other columns are ignored, whatever their names.
    """
    data, asked = materialize(valid_vectors(vectors), "ann-vectors", WRITER), valid_vectors(queries)
    index, shards = build_index(data)
    return search(index, shards, asked, k)
