"""BPE by speculation: greedy longest match proposes, a pair check verifies, failures are merged exactly.

A token sequence is the BPE encoding of its text exactly if every token is
the encoding of its own bytes and every two neighbours are the encoding of
theirs. So greedy longest match runs on all new words at once, the neighbour
check runs once on all proposed pairs at once, and only words with a failing
pair go through the exact merge loop.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import pieces

NEVER = np.int64(1) << 40
#: bytes of a word from which on it is merged by itself
LONG_WORD = 64


class SpeculativeBPE:
    """Byte-level BPE of single words from a vocabulary of byte letters and ranked merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        byte_of = {c: b for b, c in pieces.byte_letters().items()}
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, i in vocab.items():
            if t not in special:
                self.bytes[i] = bytes(byte_of[c] for c in t)
        for t, i in special.items():
            self.bytes[i] = t.encode()
        self.byte_id = np.array([vocab[pieces.byte_letters()[b]] for b in range(256)], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.made = made
        self.merge_of = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True))}
        # of each token: the rank of the merge that makes it (-1: a single byte) and its two halves
        self.rank = np.full(size, -1, np.int64)
        self.half = np.full((2, size), -1, np.int64)
        last = np.arange(len(made))[::-1]  # the lowest rank wins if two merges make a token
        self.rank[made[last]] = last
        self.half[0, made[last]], self.half[1, made[last]] = left[last], right[last]
        self.size = size
        order = np.argsort(left * size + right, kind="stable")
        self.pair_code, self.pair_rank = (left * size + right)[order], order.astype(np.int64)
        whole = np.zeros(size, bool)
        whole[self.byte_id] = True
        for r in range(len(made)):  # a token can come out only if its halves can
            whole[made[r]] |= self.rank[made[r]] == r and whole[left[r]] and whole[right[r]]
        made_by = np.flatnonzero(self.rank >= 0)
        whole[made_by] &= self.compatible(self.half[0, made_by], self.half[1, made_by], self.rank[made_by])
        self._build_trie(whole)

    def _build_trie(self, whole: np.ndarray) -> None:
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for i in np.flatnonzero(whole).tolist():
            node = 0
            for b in self.bytes[i]:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    token.append(-1)
                node = nxt
            token[node] = i
        inner = [n for n, c in enumerate(children) if c]
        row = np.full(len(children), len(inner), np.int32)
        row[inner] = np.arange(len(inner), dtype=np.int32)
        self.next = np.zeros((len(inner) + 1, 256), np.int32)  # the last row: nothing follows
        for n in inner:
            for b, to in children[n].items():
                self.next[row[n], b] = to
        self.row, self.token = row, np.array(token, np.int32)

    def compatible(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair (a[i], b[i]) stays as it is under the merge order.

        Undo the merges that made the two tokens, latest first. If at some
        stage the two symbols at the seam have a merge that comes before the
        one just undone, the exact order would have joined them, so the pair
        cannot stand. ``below``: the rank of the merge that is to join the
        pair itself; only earlier ones count.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), NEVER) if below is None else below.astype(np.int64).copy()
        fine = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            code = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_code, code), len(self.pair_code) - 1)
            known = self.pair_code[at] == code if len(self.pair_code) else np.zeros(len(code), bool)
            joins = known & (self.pair_rank[at] < limit[open_]) if len(self.pair_code) else known
            fine[open_[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            more = ~joins & (np.maximum(rx, ry) >= 0)
            open_, rx, ry = open_[more], rx[more], ry[more]
            # of two equal tokens the left one is made first, so the right one is undone first
            undo_left = rx > ry
            li, ri = open_[undo_left], open_[~undo_left]
            # a merge of the same rank further left comes first, so it blocks a join across the right seam
            limit[li], limit[ri] = rx[undo_left], ry[~undo_left] + 1
            a[li] = self.half[1, a[li]]
            b[ri] = self.half[0, b[ri]]
        return fine

    def exact(self, word: bytes) -> list[int]:
        """The merges of one word in their order: lowest rank first, then leftmost. A heap of
        candidate seams over a linked list keeps very long words near-linear."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := self.merge_of.get((a, b)))]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged away meanwhile
            ids[i], ids[j] = self.merge_of[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (m := self.merge_of.get((ids[left], ids[right]))):
                    heappush(heap, (m[0], left, ids[left], ids[right]))
        return [t for t in ids if t >= 0]

    def exact_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The merge loop over all words at once: each round does the best merge of every word."""
        count = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), count)
        done_owner, done_ids = [], []
        while len(ids):
            code = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.pair_code, code), len(self.pair_code) - 1)
            rank = np.where((self.pair_code[at] == code) & (owner[1:] == owner[:-1]), self.pair_rank[at], NEVER)
            rank = np.append(rank, NEVER)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(owner)))
            best_here = np.repeat(best, length)
            over = best_here == NEVER
            done_owner.append(owner[over])
            done_ids.append(ids[over])
            hit = np.flatnonzero((rank == best_here) & ~over)
            # occurrences that overlap (aaa): from the left, every second one
            run = np.concatenate([[True], np.diff(hit) != 1]) if len(hit) else np.empty(0, bool)
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            ids = ids.copy()
            ids[hit] = self.made[rank[hit]]
            keep = ~over
            keep[hit + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner, ids = np.concatenate([*done_owner, []]).astype(np.int64), np.concatenate([*done_ids, []]).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(words))

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: (tokens end to end, their number by word)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum(size)
        pos = end - size
        found_word, found_token = [], []
        open_ = np.flatnonzero(size)
        while len(open_):
            here, stop = pos[open_], end[open_]
            node = np.zeros(len(open_), np.int32)
            best, length = np.full(len(open_), -1, np.int32), np.zeros(len(open_), np.int64)
            walk, depth = np.arange(len(open_)), 0
            while len(walk):
                step = self.next[self.row[node[walk]], text[here[walk] + depth]]
                walk, step = walk[step > 0], step[step > 0]
                node[walk] = step
                depth += 1
                hit = self.token[step] >= 0
                best[walk[hit]] = self.token[step[hit]]
                length[walk[hit]] = depth
                walk = walk[here[walk] + depth < stop[walk]]
            found_word.append(open_)
            found_token.append(best)
            pos[open_] += length
            open_ = open_[pos[open_] < end[open_]]
        word = np.concatenate(found_word) if found_word else np.empty(0, np.int64)
        token = np.concatenate(found_token) if found_token else np.empty(0, np.int32)
        order = np.argsort(word, kind="stable")
        return token[order], np.bincount(word, minlength=len(words))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids end to end, their number by word, words that needed the exact loop)."""
        ids, count = self.propose(words)
        end = np.cumsum(count)
        owner = np.repeat(np.arange(len(words)), count)
        inside = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
        pair = ids[inside].astype(np.int64) * self.size + ids[inside + 1]
        distinct, where = np.unique(pair, return_inverse=True)
        fine = self.compatible(distinct // self.size, distinct % self.size)[where]
        failed = np.unique(owner[inside[~fine]])
        if not len(failed):
            return ids, count, 0
        bad = np.zeros(len(words), bool)
        bad[failed] = True
        size = np.array([len(words[i]) for i in failed.tolist()])
        short, long_ = failed[size <= LONG_WORD], failed[size > LONG_WORD]
        repaired, repaired_count = self.exact_many([words[i] for i in short.tolist()])
        one_by_one = [self.exact(words[i]) for i in long_.tolist()]
        failed = np.concatenate([short, long_])
        repaired = np.concatenate([repaired, *(np.array(r, np.int32) for r in one_by_one)])
        new_count = count.copy()
        new_count[failed] = np.concatenate([repaired_count, np.array([len(r) for r in one_by_one], np.int64)])
        out = np.empty(int(new_count.sum()), np.int32)
        start = np.cumsum(new_count) - new_count
        good = np.flatnonzero(~bad)
        out[pieces.ragged(start[good], count[good])] = ids[pieces.ragged((end - count)[good], count[good])]
        out[pieces.ragged(start[failed], new_count[failed])] = repaired
        return out, new_count, len(failed)


_LOADED: dict[str, tuple[SpeculativeBPE, pieces.PieceCoder]] = {}


def load(path: str) -> tuple[SpeculativeBPE, pieces.PieceCoder]:
    """This worker's encoder for a byte-level BPE vocabulary file without a normalizer."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["model"].get("end_of_word_suffix"):
            raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bpe = SpeculativeBPE(spec["model"]["vocab"], merges, special)
        _LOADED[path] = bpe, pieces.PieceCoder(pieces.split_keeping_spaces, _code_pieces(bpe, special))
    return _LOADED[path]


def _code_pieces(bpe: SpeculativeBPE, special: dict[str, int]) -> Callable:
    """Pieces to ids: special token strings first, then the pre-tokenizer's words, then BPE."""
    import regex

    rule = regex.compile(pieces.KEEPING_RULE)
    mark = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None

    def code(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number: dict[str, int] = {}  # of each distinct pre-token
        which: list[int] = []
        counts: list[int] = []
        for w in words:
            had = len(which)
            for part in mark.split(w) if mark and mark.search(w) else (w,):
                if part in special:
                    which.append(-1 - special[part])
                else:
                    which += [number.setdefault(p, len(number)) for p in rule.findall(part)]
            counts.append(len(which) - had)
        ids, many, _ = bpe.encode([p.encode() for p in number])
        ids = np.concatenate([ids, np.arange(bpe.size, dtype=np.int32)])  # then each id by itself, for special ones
        many = np.concatenate([many, np.ones(bpe.size, np.int64)])
        start = np.cumsum(many) - many
        at = np.array(which, np.int64)
        at = np.where(at < 0, len(number) - at - 1, at)
        per = many[at]
        edge = np.concatenate([[0], np.cumsum(per)])
        cut = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return ids[pieces.ragged(start[at], per)], np.diff(edge[cut])

    return code


def encode_decode(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array), decoded (text of the ids).

    ``vocab`` is the path of a tokenizers-library file that every executor can
    read. Null text is the empty text (no ids, empty decoded text), a null id
    stays null, repeated rows give repeated rows, an empty table none; other
    columns are ignored, whatever their names. Rows are independent: no
    shuffle, memory bounded by one slice of texts and the piece cache.
    """
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        lambda batches: _rows(batches, vocab, False), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode_decode`, but doc_id, n_tokens, ids_sha256 and decoded_sha256, made where the ids are."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        lambda batches: _rows(batches, vocab, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(batches: Iterator[pa.RecordBatch], vocab: str, digest: bool) -> Iterator[pa.RecordBatch]:
    bpe, coder = load(vocab)
    decimal = [str(i) for i in range(bpe.size)]
    for batch in batches:
        text = pieces.as_text(batch.column(1))
        for b, e in pieces.slices(text):
            ids, count = coder(text.slice(b, e - b))
            edge = np.concatenate([[0], np.cumsum(count)]).tolist()
            doc = batch.column(0).slice(b, e - b)
            plain = [ids[x:y].tolist() for x, y in zip(edge, edge[1:], strict=False)]
            decoded = [b"".join(map(bpe.bytes.__getitem__, p)).decode("utf-8", "replace") for p in plain]
            if not digest:
                yield pa.RecordBatch.from_arrays([doc, pa.array(plain, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                                                 ["doc_id", "ids", "decoded"])
                continue
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(count.astype(np.int64)), pa.array([sha(",".join(map(decimal.__getitem__, p))) for p in plain], pa.string()),
                 pa.array([sha(d) for d in decoded], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
