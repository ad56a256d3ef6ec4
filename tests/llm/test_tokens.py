"""Token operators against the tokenizers library, and exact round trips."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeride.llm import packing, pieces, repair, speculate
from lakeride.llm.catalog import vocabulary
from lakeride.session import scratch_path

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = ["", " ", "\n\n  a", "it's we'll", "<|endoftext|>", "a <|endoftext|>b", "<|startoftext|> x", "tab\tx\r\n", "é中😀ß½Σς", "a\0b", "x" * 500,
       "ab " * 3000, "  two  spaces ", "1234 56", "!!! ??", "A.B,c\nD", "Ünḯ", "\x1c y"]
TEXT = st.lists(st.sampled_from(list(" \n\t'sSteaT1é中!.<|\x1c\x00ß") + ["<|endoftext|>", " the", "ing", "'ll"]), max_size=30).map("".join)


def library(path, texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(path).encode_batch(list(texts), add_special_tokens=False)]


def coded(coder, texts):
    ids, count = coder(pieces.as_text(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_codes_equal_the_library(texts):
    assert coded(pieces.library_coder(BYTE, True), texts) == library(BYTE, texts)
    assert coded(pieces.library_coder(WORD, False), texts) == library(WORD, texts)
    assert coded(speculate.load(BYTE)[1], texts) == library(BYTE, texts)


def test_cache_starts_anew_without_changing_codes():
    bpe, coder = speculate.load(BYTE)
    small = pieces.PieceCoder(coder.split, coder.code_pieces, cap=5)
    for part in (ODD[:9], ODD[9:], ODD):
        assert coded(small, part) == library(BYTE, part)


def test_exact_merging_agrees_in_both_forms():
    bpe, _ = speculate.load(BYTE)
    words = [w.encode() for w in ["aaaa", "thanonontion", "été", "xxxxxyz", "a", "bananananana"]]
    ids, count = bpe.exact_many(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [bpe.exact(w) for w in words]
    assert bpe.exact(b"") == []


def test_speculation_only_merges_failing_words():
    bpe, _ = speculate.load(BYTE)
    ids, count, failed = bpe.encode([b"the", b"ing", b" and"])
    assert failed == 0 and count.tolist() == [1, 1, 1]


def test_bpe_query_digests(make, empty):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "null id"), (3, ODD[3])]
    got = speculate.digests(make(rows), BYTE).collect()
    assert len(got) == len(rows)
    want = {}
    for (i, t), ids in zip(rows, library(BYTE, [t or "" for _, t in rows]), strict=True):
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in got)
    decoded = {r.doc_id: r for r in speculate.encode_decode(make(rows), BYTE).collect()}
    assert decoded[8].decoded == ODD[8] and decoded[100].ids == []
    assert speculate.digests(empty, BYTE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_repair_round_trip_and_random_access(ids, a, b):
    shard = repair.Shard(repair.compress(np.array(ids, np.uint32), least_uses=2))
    assert shard.decode().tolist() == ids
    a, b = min(a, b, len(ids)), min(max(a, b), len(ids))
    assert shard.decode(a, b).tolist() == ids[a:b]


def test_repair_wide_ids_and_compression():
    ids = np.tile(np.array([1, 2**31, 7, 50000], np.uint32), 5000)
    payload = repair.compress(ids)
    assert len(payload) < len(ids) and (repair.Shard(payload).decode() == ids).all()
    many = np.arange(70000, dtype=np.uint32).repeat(2)
    assert (repair.Shard(repair.compress(many, least_uses=1)).decode() == many).all()
    with pytest.raises(ValueError):
        repair.Shard(b"nope" + bytes(12))


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_id_files_read_back(spark, make, empty, shard_ids):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(100, None), (None, "null id"), (9, "again")]
    path = scratch_path(spark, "t-ids")
    repair.write_ids(make(rows), path, BYTE, parts=4, shard_ids=shard_ids)
    got = sorted(repair.read_ids(spark, path).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (i, t), ids in zip(got, order, library(BYTE, [t or "" for _, t in order]), strict=True):
        data = np.array(ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(data), zlib.crc32(data.tobytes()))
        start += len(data)
    none = scratch_path(spark, "t-ids-none")
    repair.write_ids(empty, none, BYTE, parts=2)
    assert repair.read_ids(spark, none).count() == 0


def check_pieces(got, docs, max_tokens, max_segments):
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, ids in docs.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            data = np.array(ids[at:at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(data.tobytes()))
            at += r.length
        assert at == len(ids)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= max_tokens and len(rs) <= max_segments
    return [sum(r.length for r in rs) for rs in by_seq.values()]


def test_packing_places_every_id_once(make, empty):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, "lorem ipsum " * 9000)]
    docs = {i: ids + [2] for (i, _), ids in zip(rows, library(WORD, [t or "" for _, t in rows]), strict=True)}
    lengths = check_pieces(packing.pack_documents(make(rows), WORD).collect(), docs, 4096, 256)
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths)
    got = packing.pack_documents(make([(1, "same"), (1, "same"), (None, "x")]), WORD).collect()
    assert len(got) >= 3 and sum(r.length for r in got) == 6
    assert packing.pack_documents(empty, WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 150), st.integers(0, 150)), max_size=50), st.integers(1, 9), st.integers(1, 64))
def test_packer_keeps_all_limits(items, segments, loss):
    out, closed = [], {}
    p = packing.Packer(lambda *x: out.append(x), closed.__setitem__, 64, segments, loss, window=8)
    for i, (tokens, quiet) in enumerate(items):
        p.add(i, tokens, quiet)
    p.finish()
    for i, (tokens, _) in enumerate(items):
        at = 0
        for _, start, length, *_ in sorted(x for x in out if x[0] == i):
            assert start == at
            at += length
        assert at == tokens
    for s, total in closed.items():
        own = sorted((x[4], x[2], x[5]) for x in out if x[3] == s)
        assert total == sum(x[1] for x in own) <= 64 and len(own) <= segments and sum(x[2] for x in own) <= loss
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]


def test_prompts_bear_no_loss(spark):
    docs = spark.createDataFrame([(1, "what is it", "an answer here")], "doc_id long, prompt string, text string")
    rows = packing.pack_documents(docs, WORD, prompt_col="prompt").collect()
    (a, b) = library(WORD, ["what is it", "an answer here"])
    assert sum(r.length for r in rows) == len(a) + len(b) + 1 and sum(r.loss_tokens for r in rows) == len(b) + 1


def test_packer_rejects_bad_limits():
    with pytest.raises(ValueError):
        packing.Packer(print, print, max_tokens=100)
    with pytest.raises(ValueError):
        packing.Packer(print, print, max_loss=0)


def packed(examples, **limits):
    out, ends = [], {}
    packer = packing.Packer(lambda *x: out.append(x), ends.__setitem__, **limits)
    for key, (tokens, loss_from) in enumerate(examples):
        packer.add(key, tokens, loss_from)
    packer.finish()
    return out, ends


@pytest.mark.parametrize("tokens", [3, 5, 9, 12])
def test_short_examples_leave_little_padding(tokens):
    out, ends = packed([(tokens, 0)] * 20_000)
    assert sum(x[2] for x in out) == tokens * 20_000
    space = sum(n if n & (n - 1) == 0 else 4096 for n in ends.values())
    assert space < 1.01 * tokens * 20_000
    assert max(sum(1 for x in out if x[3] == s) for s in list(ends)[:50]) <= 256


def test_the_choice_is_the_largest_dot_product():
    rng = np.random.default_rng(4)
    examples = [(int(t), int(rng.integers(0, t + 1))) for t in rng.integers(1, 40, 120)]
    limits = dict(max_tokens=64, max_segments=64, max_loss=40, window=6)
    out, _ = packed(examples, **limits)
    # every whole example went in because no other one waiting then had a larger product with what was free
    waiting, coming, placed = [], list(range(len(examples))), {k: 0 for k in range(len(examples))}
    now, used, segments, loss = 0, 0, 0, 0
    for key, start, length, sequence, offset, own_loss in out:
        if sequence != now:
            now, used, segments, loss = sequence, 0, 0, 0
        while len(waiting) < 6 and coming:
            waiting.append(coming.pop(0))
        free = (64 - used, 64 - segments, 40 - loss)
        worth = {}
        for k in waiting:
            tokens, first = examples[k]
            rest, bears = tokens - placed[k], max(0, tokens - max(placed[k], first))
            if rest <= free[0] and bears <= free[2]:
                worth[k] = rest / 64 * free[0] + free[1] / 64 + bears / 40 * free[2]
        tokens, first = examples[key]
        if coming:  # the tail goes into smaller sequences
            assert not worth or worth[key] == pytest.approx(max(worth.values()))
        assert offset == used and key in waiting
        used, segments, loss = used + length, segments + 1, loss + own_loss
        placed[key] += length
        if placed[key] == tokens:
            waiting.remove(key)


def test_rounds_go_on_until_no_pair_is_frequent():
    ids = np.tile(np.random.default_rng(2).permutation(50_000).astype(np.uint32), 20)
    payload = repair.compress(ids)
    assert (repair.Shard(payload).decode() == ids).all()
    symbols = repair.Shard(payload).symbols
    pairs = np.unique(symbols[:-1] << 32 | symbols[1:], return_counts=True)[1]
    assert pairs.max(initial=0) < repair.LEAST_USES
    text = np.tile(np.minimum(np.random.default_rng(3).zipf(1.3, 50_000), 5000).astype(np.uint32), 20)
    assert len(repair.compress(text)) < 0.45 * len(text)
