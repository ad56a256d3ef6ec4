"""Substring dedup: Rabin-Karp hashes of every window of words, first documents by hash range, maximal intervals.

A window is a fixed number of consecutive words of one document. It repeats if
its words also start in a document with a smaller id. Three steps:

1. A task hashes all windows of its split (a rolling polynomial hash over
   word hashes), settles repeats that both lie in what it holds, and posts of
   every hash only the windows of the smallest id it saw. So a passage that
   is everywhere posts once per task, not once per document.
2. Posts meet by range of the hash, as blocks of columns. A range holds at most
   about as many windows as a task, whatever the size of the corpus. The windows
   that do not lie in the smallest document of their hash are sent back to the
   part of the input that posted them, where each document gets all of its own.
3. The starts of a document's repeated windows meet its text, become the
   windows they cover and maximal intervals, and the text is cut.

Equal words give equal hashes; different windows share one of 64 bits with a
chance of n * n / 2**65 for n windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces

#: words of a window
WORDS = 13
#: bounds of a task's memory: bytes of text hashed at once, windows held before they are posted
SLICE_BYTES, HELD = 2 << 20, 2_000_000
#: words longer than this are hashed one by one
LONG_WORD = 64
#: bytes whose prefix sums are held at once
BLOCK = 1 << 20

_rng = np.random.default_rng(13)
_LETTER = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _WORD_BASE = (int(x) * 2 + 1 for x in _rng.integers(1 << 40, 1 << 62, 2))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        held = both[0], both[1]
        if size <= 2 * BLOCK:  # a very long text does not stay in memory
            _POWERS[base] = held
    return held


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_spans(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word; ``edge`` are the texts' byte offsets in ``data``."""
    inside = ~_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(edge))
    first, last = edge[:-1][full], edge[1:][full] - 1
    begin[first], end[last] = inside[first], inside[last]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from prefix sums of a polynomial over its bytes."""
    out = np.empty(len(start), np.uint64)
    size = end - start
    power, inverse = _powers(_BASE, BLOCK + LONG_WORD)
    cut = np.searchsorted(start, np.arange(0, len(data) + BLOCK, BLOCK))
    for k, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if i == j:
            continue
        at = k * BLOCK
        value = _LETTER[data[at:at + BLOCK + LONG_WORD]]
        value *= power[:len(value)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
        s = start[i:j] - at
        out[i:j] = (total[np.minimum(s + size[i:j], len(value))] - total[s]) * inverse[s]
    out = _mix(out + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(size > LONG_WORD)
    if len(long):
        from xxhash import xxh3_64_intdigest

        for i in long.tolist():
            out[i] = xxh3_64_intdigest(data[start[i]:end[i]].tobytes())
    return out


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end and where each begins."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    first = int(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]) if len(texts) else 0
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[first:first + int(edge[-1])] if data is not None and edge[-1] else np.empty(0, np.uint8)), edge


def windows(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end, hashes of all windows in order, row of each, its first word's number in the text)."""
    for b, e in pieces.slices(texts, SLICE_BYTES):
        data, edge = _buffer(texts.slice(b, e - b))
        start, end = word_spans(data, edge)
        upto = np.searchsorted(start, edge)
        value = word_hashes(data, start, end)
        power, inverse = _powers(_WORD_BASE, len(value) + 1)
        value *= power[:len(value)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
        many = np.diff(upto)
        length = np.maximum(many - words + 1, 0)
        at = pieces.ragged(upto[:-1], length)
        row = np.repeat(np.arange(e - b, dtype=np.int32), length)
        yield b, e, _mix((total[at + words] - total[at]) * inverse[at]), row, (at - upto[:-1][row]).astype(np.int32)


def _not_first(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True where the same hash comes with a smaller id."""
    order = np.argsort(hashes)
    h = hashes[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
    alone = new & np.concatenate([new[1:], [True]]) if len(h) else new
    several = np.flatnonzero(~alone)  # only these can repeat
    out = np.zeros(len(h), bool)
    if len(several):
        own, begins = ids[order[several]], np.flatnonzero(new[several])
        least = np.minimum.reduceat(own, begins)
        out[order[several]] = own > np.repeat(least, np.diff(np.append(begins, len(own))))
    return out


def _planes(x: np.ndarray, keep: int) -> bytes:
    """The ``keep`` lowest bytes of all numbers, lowest bytes first, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :keep].T).tobytes()


def _unplanes(data: np.ndarray, n: int, keep: int, dtype) -> np.ndarray:
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :keep] = data.reshape(keep, n).T
    return out.reshape(-1).view(dtype)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _pack(ordinals: np.ndarray, starts: np.ndarray, ids: np.ndarray | None = None, hashes: np.ndarray | None = None) -> bytes:
    """One block of windows in runs of one document: ordinals, lengths and ids of the runs, starts, hashes without their highest byte."""
    first = np.flatnonzero(np.concatenate([[True], ordinals[1:] != ordinals[:-1]])) if len(ordinals) else np.empty(0, np.int64)
    many = np.diff(np.append(first, len(ordinals)))
    step = _steps(starts.astype(np.int32))
    step[first] = starts[first]
    parts = [np.array([len(first), len(ordinals)], "<i8").tobytes(), _planes(_steps(ordinals[first].astype("<i4")), 4),
             _planes(many.astype("<i4"), 4), _planes(step.astype("<i4"), 4)]
    if ids is not None:
        parts += [_planes(_steps(ids[first].astype("<i8")), 8), _planes(hashes.astype("<u8"), 7)]
    return b"".join(parts)


def _unpack(block: bytes, posted: bool) -> list[np.ndarray]:
    """Ordinals and starts; of posted windows also ids and hashes."""
    runs, n = np.frombuffer(block, "<i8", 2).tolist()
    at, parts = 16, []
    for k, size, kind in ((runs, 4, "<i4"), (runs, 4, "<i4"), (n, 4, "<i4"), (runs, 8, "<i8"), (n, 7, "<u8"))[:5 if posted else 3]:
        parts.append(_unplanes(np.frombuffer(block, np.uint8, k * size, at), k, size, kind))
        at += k * size
    many = parts[1].astype(np.int64)
    total, first = np.cumsum(parts[2].astype(np.int64)), np.cumsum(many) - many
    starts = total - np.repeat(total[first] - parts[2][first], many)
    out = [np.repeat(np.cumsum(parts[0], dtype=np.int32), many), starts.astype(np.int32)]
    return out + [np.repeat(np.cumsum(parts[3]), many), parts[4]] if posted else out


def _row(batch_range: int | None, part: int, kind: str, block: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([batch_range], pa.int32()), pa.array([part], pa.int64()), pa.array([kind], pa.string()),
                                       pa.array([block], pa.binary())], ["range", "part", "kind", "block"])


#: a part is what a task held at once; kind: 'docs' (ids and keys of a part's documents, in order), 'post', 'back'
_SCHEMA = "range int, part long, kind string, block binary"


def repeated_windows(docs: DataFrame, words: int = WORDS, held: int = HELD) -> DataFrame:
    """Rows (doc_id, key, starts): first words of windows of ``docs(doc_id, key, text)`` whose words also
    start in a document with a smaller id. Of the windows that a document itself repeats, one at
    least is named. Rows that repeat give repeated rows."""
    # about half of `held` windows to a range, so that a range fits a task; a word takes six bytes or so
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    bits = max(1, int(np.ceil(np.log2(max(2.0, size / 3 / held)))))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        table: list[tuple[np.ndarray, np.ndarray]] = []
        number = TaskContext.get().partitionId() << 24
        n_docs = count = 0

        def hand_on(part: int):
            hashes, ordinals, starts = (np.concatenate(x) for x in zip(*kept, strict=True))
            ids, keys = (np.concatenate(x) for x in zip(*table, strict=True))
            kept.clear()
            table.clear()
            yield _row(None, part, "docs", ids.astype("<i8").tobytes() + keys.astype("<i4").tobytes())
            again = _not_first(hashes, ids[ordinals])
            if again.any():
                yield _row(None, part, "back", _pack(ordinals[again], starts[again]))
            rest = np.flatnonzero(~again)
            where = (hashes[rest] >> np.uint64(64 - bits)).astype(np.int64)
            order = rest[np.argsort(where, kind="stable")]
            del again, rest, where
            there, first = np.unique(hashes[order] >> np.uint64(64 - bits), return_index=True)
            for r, x, y in zip(there.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                at = order[x:y]
                yield _row(r, part, "post", _pack(ordinals[at], starts[at], ids[ordinals[at]], hashes[at]))

        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for b, e, hashes, row, start in windows(pieces.as_text(batch.column(2)), words):
                kept.append((hashes, row + np.int32(n_docs), start))
                table.append((ids[b:e], keys[b:e]))
                n_docs, count = n_docs + e - b, count + len(hashes)
                if count >= held:
                    yield from hand_on(number)
                    n_docs, count, number = 0, 0, number + 1
        if count:
            yield from hand_on(number)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []

        def settle():
            parts = [_unpack(block, True) for _, block in blocks]
            again = _not_first(np.concatenate([p[3] for p in parts]), np.concatenate([p[2] for p in parts]))
            at = 0
            for (part, _), (ordinals, starts, _, _) in zip(blocks, parts, strict=True):
                own = again[at:at + len(starts)]
                at += len(starts)
                if own.any():
                    yield _row(None, part, "back", _pack(ordinals[own], starts[own]))
            blocks.clear()

        for batch in batches:
            mine = pc.equal(batch.column(2), "post")
            yield batch.filter(pc.invert(mine))
            own = batch.filter(mine)
            for r, part, block in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), own.column(3), strict=True):
                if r != now and blocks:
                    yield from settle()
                now = r
                blocks.append((part, block.as_buffer().to_pybytes()))
        if blocks:
            yield from settle()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs_of, back = None, b"", []

        def close():
            if not back:
                return
            n = len(docs_of) // 12
            ids, keys = np.frombuffer(docs_of, "<i8", n), np.frombuffer(docs_of, "<i4", n, 8 * n)
            ordinals, starts = (np.concatenate(x) for x in zip(*(_unpack(b, False) for b in back), strict=True))
            back.clear()
            order = np.argsort(ordinals, kind="stable")
            ordinals, starts = ordinals[order], starts[order]
            first = np.flatnonzero(np.concatenate([[True], ordinals[1:] != ordinals[:-1]]))
            for k in range(0, len(first), 5000):
                own = first[k:k + 5000]
                stop = first[k + 5000] if k + 5000 < len(first) else len(ordinals)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[ordinals[own]]), pa.array(keys[ordinals[own]]),
                     pa.ListArray.from_arrays(pa.array(np.append(own, stop) - own[0], pa.int32()), pa.array(starts[own[0]:stop]))],
                    ["doc_id", "key", "starts"])

        for batch in batches:
            for part, kind, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if part != now:
                    yield from close()
                    now = part
                if kind == "docs":
                    docs_of = block.as_buffer().to_pybytes()
                else:
                    back.append(block.as_buffer().to_pybytes())
        yield from close()

    posts = docs.where("doc_id is not null").select("doc_id", "key", "text").mapInArrow(post, _SCHEMA)
    # what is already settled is dealt out by its part, posts by their range
    met = posts.repartition(F.coalesce("range", F.xxhash64("part"))).sortWithinPartitions("range").mapInArrow(meet, _SCHEMA)
    return met.repartition("part").sortWithinPartitions("part").mapInArrow(gather, "doc_id long, key int, starts array<int>")


def covered(starts: np.ndarray, words: int) -> list[tuple[int, int]]:
    """Maximal intervals (first word, end) of the windows that begin at these words, ascending."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + words)
    return list(zip(starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, len(starts) - 1)] + words).tolist(), strict=True))


def remove_repeats(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans (maximal intervals of word numbers, end
    excluded, that go), kept_text (the other words, joined by one space).

    Words are runs of characters other than space and control white space, as
    they are. The document with the smallest id keeps a window; windows are
    judged on the input. A null or empty text has no words; one with fewer
    words than a window loses none. A row without an id loses nothing and
    takes nothing from others. Repeated rows give repeated rows; rows that
    share an id are one document to others and take nothing from each other.
    An empty table gives no rows. Other columns are ignored, whatever their
    names.
    """
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.hash(text).alias("key"), text.alias("text"))
    found = repeated_windows(rows, words, held).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    both = rows.join(found, ["doc_id", "key"], "left").select("doc_id", "text", "starts")
    span = pa.struct([("from", pa.int32()), ("to", pa.int32())])

    def repeats_of(texts: pa.Array, starts: pa.Array) -> dict[int, np.ndarray]:
        """First words of all repeated windows of each row that has any, with those that the text itself repeats."""
        out = {}
        some = np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False))
        for b, e, hashes, row, _ in windows(texts.take(pa.array(some)), words):
            edge = np.searchsorted(row, np.arange(e - b + 1))
            for k in range(b, e):
                own = hashes[edge[k - b]:edge[k - b + 1]]
                out[int(some[k])] = np.flatnonzero(np.isin(own, own[starts[int(some[k])].values.to_numpy()]))
        return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pieces.as_text(batch.column(1))
            again = repeats_of(texts, batch.column(2))
            total, gone, spans, kept = [], [], [], []
            for k, t in enumerate(texts):
                word = t.as_buffer().to_pybytes().split()  # at space, \t, \n, \v, \f, \r
                total.append(len(word))
                out = covered(again[k], words) if k in again else []
                if out:
                    parts, last = [], 0
                    for x, y in out:
                        parts += word[last:x]
                        last = y
                    word = parts + word[last:]
                gone.append(total[-1] - len(word))
                spans.append([{"from": x, "to": y} for x, y in out])
                kept.append(b" ".join(word).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return both.mapInArrow(cut, "doc_id long, n_words long, n_removed long, spans array<struct<from:int,to:int>>, kept_text string")
