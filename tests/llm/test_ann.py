"""Pruned-graph search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeride.llm import ann, catalog

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, queries, k=10):
    ids, x = np.array(sorted(data)), np.array([data[i] for i in sorted(data)], np.float64)
    out = {}
    for q in queries:
        s = np.sqrt(((x - np.array(data[q], np.float64)) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_over_several_shards(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    data = {r.vec_id: r.embedding for r in rows}
    vectors = spark.createDataFrame(rows, SCHEMA)
    index, shards = ann.build_index(ann.valid_vectors(vectors), shard_rows=600)
    assert shards == 4
    asked = ann.valid_vectors(vectors.where("vec_id % 20 = 0"))
    got = {}
    for r in ann.search(index, shards, asked).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(data, got)
    assert len(got) == 100 and all(len(g) == 10 for g in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in got)
    assert hits / 1000 >= 0.95
    for q, g in got.items():
        assert [s for _, s in g] == pytest.approx([np.linalg.norm(np.array(data[v]) - np.array(data[q])) for v, _ in g], abs=1e-12)


def test_equal_vectors_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    good = {i: [float(np.float32(x)) for x in rng.normal(size=8)] for i in range(1, 60)}
    good |= {i: [1.0] * 8 for i in range(100, 160)}
    bad = [(200, None, 1), (201, [0.0] * 8, 1), (202, [1.0, None] + [0.5] * 6, 1), (203, [float("nan")] * 8, 1),
           (204, [float("inf")] * 8, 1), (205, [], 1), (None, [1.0] * 8, 1), (206, [1.0, 2.0], 1)]
    rows = [(i, v, 0) for i, v in good.items()] + bad + [(100, [1.0] * 8, 3)]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash")).withColumn("q", F.lit(1)).repartition(4)
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id in (1, 2, 100, 130, 201, 206)")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == [1, 2, 100, 130]
    assert [v for v, _ in got[130]] == [100, *range(100, 109)] and [v for v, _ in got[100]][0::2] == list(range(100, 110))
    want = brute(good, [1, 2])
    for q in (1, 2):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_rows_that_repeat_an_id_all_take_part(spark):
    rows = [(100, [1.0, 0.0], 0), (100, [1.0, 0.0], 1), (100, [0.0, 1.0], 0), (7, [1.0, 0.5], 0), (9, [1.0, 0.0], 0)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ask = lambda: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.nearest(vectors, vectors.where("vec_id = 100")).collect())
    got = ask()
    twice = [(100, 1, 9, 0.0), (100, 2, 100, 0.0), (100, 3, 7, 0.5), (100, 4, 100, 1.414214)]
    other = [(100, 1, 7, 1.118034), (100, 2, 9, 1.414214), (100, 3, 100, 1.414214), (100, 4, 100, 1.414214)]
    assert got == sorted(twice * 2 + other) and ask() == got


def _fixtures():
    rng = np.random.default_rng(1)
    yield rng.normal(size=(1500, 256))
    yield np.concatenate([rng.normal(size=(200, 64)) * 5, rng.normal(size=64) + rng.normal(size=(2000, 64)) * 0.05])
    centres = rng.normal(size=(100, 64)) * 3
    yield centres[rng.integers(0, 100, 2000)] + rng.normal(size=(2000, 64)) * 0.3
    yield np.concatenate([np.zeros((1, 4)), np.eye(4)])
    yield np.ones((1, 3))


def test_every_node_is_reachable_and_recall_holds():
    for data in _fixtures():
        n = len(data)
        graph, entry = ann.build_graph(data)
        assert ann.reachable(graph, entry).all()
        assert n == 1 or (np.bincount(graph[graph >= 0], minlength=n) > 0).all()
        asked = np.arange(0, n, 20)
        found, _ = ann.beam_search(data[asked], data, graph, entry, ann.QUERY_BEAM)
        hits = possible = 0
        for i, near in zip(asked, found, strict=True):
            d = ((data - data[i]) ** 2).sum(1)
            d[i] = np.inf
            want = set(np.argsort(d)[:min(10, n - 1)].tolist())
            hits += len(want & {v for v in near.tolist() if v not in (i, -1)})
            possible += len(want)
        assert hits >= 0.95 * possible


def test_unreached_nodes_are_linked_even_where_lists_are_full():
    data = np.random.default_rng(2).normal(size=(60, 3))
    graph = np.full((60, 2), -1, np.int32)  # nothing but the entry is reachable
    wide = ann.link_unreached(data, graph, np.array([5]), beam=4, least_in=2, links=1)
    assert ann.reachable(wide, np.array([5])).all()


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)], SCHEMA)
    got = ann.nearest(few, few.where("vec_id = 1")).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(1, 1, 3), (1, 2, 2)]
    none = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(none, none).count() == 0 and ann.nearest(few, none).count() == 0


def test_pruning_keeps_diverse_edges():
    data = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [5, 5]], float)
    out = ann.robust_prune(data, np.array([0]), np.array([[1, 2, 3, 4, 0, 1]]), 3)
    assert out[0].tolist() == [1, 3, -1] or out[0].tolist()[:2] == [1, 3]


def test_query_covers_every_hundredth(spark):
    got = catalog.QUERIES["op4_pruned_graph"](spark, "/root/testdata/sf0.01")
    assert got.groupBy("query_id").count().where("count = 10 and query_id % 100 = 0").count() == 5


def _normal(n, dim, seed=6):
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32))]


def test_an_index_is_kept_in_small_rows_and_row_groups(spark):
    import pyarrow.parquet as pq

    vectors = spark.createDataFrame(_normal(3000, 512), SCHEMA)
    index, shards = ann.build_index(ann.valid_vectors(vectors), shard_rows=500)
    assert shards == 6
    kept = [c for c, kind in index.dtypes if kind == "binary"]
    sizes = index.select(sum(F.octet_length(c) for c in kept).alias("n")).agg(F.max("n"), F.sum("n")).head()
    assert sizes[0] <= ann.PIECE_BYTES and sizes[1] > 3000 * 512 * 4  # floats are kept as floats
    groups = [pq.ParquetFile(path.removeprefix("file:").replace("//", "")).metadata for path in index.inputFiles()]
    assert max(m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)) < 2 * ann.WRITER["parquet.block.size"]


def test_the_copy_of_the_vectors_is_written_in_small_row_groups(spark, monkeypatch):
    import pyarrow.parquet as pq

    kept = {}
    write = ann.materialize
    monkeypatch.setattr(ann, "materialize", lambda df, name, *options: kept.setdefault(name, write(df, name, *options)))
    vectors = spark.range(60_000).selectExpr("id as vec_id", "transform(sequence(1, 128), i -> cast(rand(3) + i as float)) as embedding").coalesce(1)
    few = spark.createDataFrame(_normal(5, 128), SCHEMA)
    monkeypatch.setattr(ann, "build_index", lambda data: (few, 1))
    monkeypatch.setattr(ann, "search", lambda index, shards, asked, k: asked)
    ann.nearest(vectors, few)
    groups = [pq.ParquetFile(path.removeprefix("file:").replace("//", "")).metadata for path in kept["ann-vectors"].inputFiles()]
    assert sum(m.num_rows for m in groups) == 60_000
    assert max(m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)) < 16 << 20


def test_tasks_that_search_several_shards_find_the_same(spark, monkeypatch):
    rows = _normal(900, 64) + [(i, v, 0) for i, v, _ in _normal(300, 7)] + [(5000 + i, [0.5] * 64, 0) for i in range(30)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    asked = ann.valid_vectors(vectors.where("vec_id % 50 = 0 or vec_id = 5001"))
    index, shards = ann.build_index(ann.valid_vectors(vectors), shard_rows=150)
    assert shards == 9
    ask = lambda: sorted(tuple(r) for r in ann.search(index, shards, asked).collect())
    want = ask()
    assert len(want) == 10 * (18 + 6 + 2)
    monkeypatch.setattr(ann, "SEARCH_TASKS", 2)
    monkeypatch.setattr(ann, "PIECE_BYTES", 5000)
    index, shards = ann.build_index(ann.valid_vectors(vectors), shard_rows=150)
    assert index.where("shard = 0 and dim = 64").count() > 1
    found = ann.search(index, shards, asked)
    assert sorted(tuple(r) for r in found.collect()) == want
    doubles = vectors.withColumn("embedding", F.expr("transform(embedding, x -> cast(x as double))"))
    index, shards = ann.build_index(ann.valid_vectors(doubles), shard_rows=150)
    got = ann.search(index, shards, ann.valid_vectors(doubles.where("vec_id % 50 = 0 or vec_id = 5001")))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_a_shard_is_unpacked_as_it_was():
    rng = np.random.default_rng(8)
    for data in (rng.normal(size=(70, 5)), rng.normal(size=(70, 5)).astype(np.float32).astype(float), np.array([[1e300, 1.0]])):
        graph, entry = ann.build_graph(data)
        size = np.full(len(data), 2)
        made = (np.arange(2 * len(data)), np.ones(2 * len(data), np.int64), size, data, graph, entry)
        for a, b in zip(made, ann._unpacked(ann._packed(*made), data.shape[1]), strict=True):
            assert a.dtype == b.dtype and np.array_equal(a, b)


def test_beam_search_opens_the_nearest_until_all_are_open():
    rng = np.random.default_rng(9)
    for data in (rng.integers(0, 4, (300, 3)).astype(float), rng.normal(size=(300, 8))):
        data = np.unique(data, axis=0)
        graph, entry = ann.build_graph(data, degree=6, beam=12)
        asked = np.concatenate([data[:20], data[-20:] + 0.25])
        nodes, dist = ann.beam_search(asked, data, graph, entry, 10)
        for x, found, far in zip(asked, nodes, dist, strict=True):
            d = ((data - x) ** 2).sum(1)
            beam, opened = sorted(entry.tolist(), key=lambda i: d[i])[:10], set()
            while left := [i for i in beam if i not in opened]:
                opened.add(left[0])
                # equal ones stay in the order they came
                beam = sorted(beam + [i for i in graph[left[0]].tolist() if i >= 0 and i not in beam], key=lambda i: d[i])[:10]
            want = beam + [-1] * (10 - len(beam))
            assert found.tolist() == want and far[found >= 0] == pytest.approx(d[beam], abs=1e-12)
