"""Packing: vector bin packing by the dot-product heuristic.

Examples are placed into sequences under three simultaneous limits: tokens,
segments and loss-bearing tokens. A task packs its own input split and needs
no shuffle. It keeps a bounded window of waiting examples and one open
sequence; among the waiting examples that fit whole, the one whose demand
vector has the largest dot product with the sequence's free capacity goes in.
If none fits, one is cut to fill the sequence. What a split has left below
one full sequence is laid into sequences whose length is a power of two, which
need no padding. So is a sequence that its last segments cannot fill: it closes
at the largest power of two within reach, where the last piece is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import pieces

#: limits of a sequence
MAX_TOKENS, MAX_SEGMENTS = 4096, 256
#: examples that wait for a place, in a task
WINDOW = 256
#: bounds of a task's memory: bytes of text handled at once, words whose ids it remembers
SLICE_BYTES, CACHE_WORDS = 3 << 20, 250_000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long, sequence_tokens long")


class Packer:
    """Streaming packer of one input split.

    ``add(key, tokens, loss_from)`` queues an example whose tokens from index
    ``loss_from`` on bear loss. ``emit(key, start, length, sequence, offset,
    loss)`` is called for each piece, ``closed(sequence, tokens)`` for each
    sequence. ``max_tokens`` must be a power of two.
    """

    def __init__(self, emit: Callable, closed: Callable, max_tokens: int = MAX_TOKENS,
                 max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, window: int = WINDOW):
        if max_tokens & (max_tokens - 1) or max_tokens < 1 or max_segments < 1:
            raise ValueError("max_tokens must be a power of two, max_segments at least 1")
        self.emit, self.closed = emit, closed
        self.limit = np.array([max_tokens, max_segments, max_tokens if max_loss is None else max_loss], np.int64)
        if self.limit[2] < 1:
            raise ValueError("max_loss must be at least 1")
        self.size = window
        self.keys: list = [None] * window
        #: of each waiting example: next token, tokens in all, first token with loss
        self.next, self.total, self.loss_from = (np.zeros(window, np.int64) for _ in range(3))
        self.waiting = np.zeros(window, bool)
        self.sequence = 0
        self._open(int(self.limit[0]))

    def _open(self, capacity: int) -> None:
        self.capacity, self.used, self.segments, self.loss = capacity, 0, 0, 0

    def _close(self) -> None:
        self.closed(self.sequence, self.used)
        self.sequence += 1

    def add(self, key, tokens: int, loss_from: int = 0) -> None:
        if tokens <= 0:
            return
        while self.waiting.all():
            self._place()
        i = int(np.argmin(self.waiting))
        self.keys[i], self.next[i], self.total[i], self.loss_from[i] = key, 0, tokens, loss_from
        self.waiting[i] = True

    def _put(self, i: int, length: int) -> None:
        start = int(self.next[i])
        loss = max(0, start + length - max(start, int(self.loss_from[i])))
        self.emit(self.keys[i], start, length, self.sequence, self.used, loss)
        self.used, self.segments, self.loss = self.used + length, self.segments + 1, self.loss + loss
        self.next[i] += length
        if self.next[i] == self.total[i]:
            self.waiting[i], self.keys[i] = False, None
        if self.used == self.capacity or self.segments == self.limit[1]:
            self._close()
            self._open(int(self.limit[0]))

    def _place(self) -> None:
        """Puts one waiting example, or a part of one, into the open sequence."""
        free = np.array([self.capacity - self.used, self.limit[1] - self.segments, self.limit[2] - self.loss])
        rest = np.where(self.waiting, self.total - self.next, 0)
        loss = np.maximum(0, self.total - np.maximum(self.next, self.loss_from)) * self.waiting
        last = int(free[1])
        if last <= self.size and self.used + int(rest.max()) < self.capacity:
            # with many short examples the segments run out first
            reach = self.used + int(np.partition(rest, self.size - last)[self.size - last:].sum())
            goal = 1 << (max(1, reach).bit_length() - 1)
            if self.used < goal < self.capacity:
                self.capacity = goal
                free[0] = goal - self.used
        fits = self.waiting & (rest <= free[0]) & (loss <= free[2])
        if fits.any():
            worth = rest / self.limit[0] * free[0] + free[1] / self.limit[1] + loss / self.limit[2] * free[2]
            i = int(np.argmax(np.where(fits, worth, -1.0)))
            self._put(i, int(rest[i]))
            return
        i = int(np.argmax(rest))  # cut the longest: what stays of it is still worth a place
        length = min(int(rest[i]), int(free[0]))
        quiet = max(0, int(self.loss_from[i] - self.next[i]))  # tokens before the loss begins
        length = min(length, quiet + int(free[2]))
        if length > 0:
            self._put(i, length)
        else:
            self._close()
            self._open(int(self.limit[0]))

    def finish(self) -> None:
        """Places all that waits; the tail goes into power-of-two sequences."""
        while self.waiting.any():
            left = int((self.total - self.next)[self.waiting].sum())
            if not self.used and left < self.limit[0]:
                self._open(1 << (left.bit_length() - 1))
            elif self.used and left + self.used < self.capacity:
                # the open sequence shrinks to a power of two that it can still fill
                goal = 1 << ((left + self.used).bit_length() - 1)
                if goal > self.used:
                    self.capacity = goal
            self._place()
        if self.used:
            self._close()


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", prompt_col: str | None = None, keep_spaces: bool = False,
                   max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                   max_loss: int | None = None, cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece of a document: which tokens, in which sequence, at which offset.

    ``tokenizer`` is the path of a tokenizers-library file that every executor
    can read. A document's ids are those of ``prompt_col`` (if named; they bear
    no loss), of ``text_col`` and ``end_id``. Sequence ids are unique over all
    tasks and the same if a task is run again. A null text is empty (its end
    id alone is packed), a null id stays null, rows that repeat are packed
    each, an empty table gives no rows. Very long texts are cut over many
    sequences. Other columns are ignored, whatever their names. Memory of a
    task: one slice of texts, the window and the ids of ``cache_words`` words.
    """
    cols = [docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")]
    if prompt_col:
        cols.append(docs[prompt_col].cast("string").alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces.library_coder(tokenizer, keep_spaces, cache_words)
        base = TaskContext.get().partitionId() << 33
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                "sequence_id", "offset", "loss_tokens")}
        seq: list[int] = []  # pieces' sequences, to add their lengths once they close
        length_of: dict[int, int] = {}

        def emit(key, start, length, sequence, offset, loss):
            doc, ids = key
            for name, x in zip(out, (doc, start, length, pieces.crc32_of(ids[start:start + length]),
                                     len(ids), base + sequence, offset, loss), strict=True):
                out[name].append(x)
            seq.append(sequence)

        packer = Packer(emit, length_of.__setitem__, max_tokens, max_segments, max_loss)

        def flush(everything: bool) -> Iterator[pa.RecordBatch]:
            n = next((i for i, s in enumerate(seq) if s not in length_of), len(seq))
            if n and (everything or n > 5000):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(v[:n], pa.int64()) for v in out.values()),
                     pa.array([length_of[s] for s in seq[:n]], pa.int64())], [*out, "sequence_tokens"])
                for s in set(seq[:n]):
                    del length_of[s]
                for v in (*out.values(), seq):
                    del v[:n]

        for batch in batches:
            text = pieces.as_text(batch.column(1))
            prompt = pieces.as_text(batch.column(2)) if prompt_col else None
            for b, e in pieces.slices(text, SLICE_BYTES):
                ids, count = coder(text.slice(b, e - b))
                edge = np.concatenate([[0], np.cumsum(count)])
                first = [ids[:0]] * (e - b)
                if prompt is not None:
                    p, many = coder(prompt.slice(b, e - b))
                    first = np.split(p, np.cumsum(many)[:-1])
                for k, doc in enumerate(batch.column(0).slice(b, e - b).to_pylist()):
                    own = np.concatenate([first[k], ids[edge[k]:edge[k + 1]], [end_id]]).astype(np.uint32)
                    packer.add((doc, own), len(own), len(first[k]))
                yield from flush(False)
        packer.finish()
        yield from flush(True)

    return docs.select(cols).mapInArrow(run, SCHEMA)
