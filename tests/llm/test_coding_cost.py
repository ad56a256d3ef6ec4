"""Distinct pieces reach the library together; the rules of a grammar open in as many steps as it had rounds."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeride.llm import pieces, repair


class Counted:
    """A tokenizer that counts the calls of its library."""

    def __init__(self, tok):
        self.tok, self.calls = tok, 0
        self.model = self

    def tokenize(self, word):
        self.calls += 1
        return self.tok.model.tokenize(word)

    def encode(self, *args, **kw):
        self.calls += 1
        return self.tok.encode(*args, **kw)

    def encode_batch_fast(self, *args, **kw):
        self.calls += 1
        return self.tok.encode_batch_fast(*args, **kw)


def test_many_pieces_take_few_calls():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABC0123456789.,!'<|>ĊĠ\xa1\xe9ɏ-"
    words = sorted({rng.choice(["", " "]) + "".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(12_000)})
    words += [" ", "\n", "\t x", "a\x00b", "你好", " \xad", "<|endoftext|>", "don't", " we'll", "  "]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counted = Counted(tok)
    odd = sum("<|" in w for w in words) + 10
    ids, counts = pieces._by_pretoken(counted, True)(words)
    assert counted.calls <= odd + 10  # one for each thousands of pieces, and one for each odd piece
    want = [tok.encode(w, add_special_tokens=False).ids for w in words]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    none, no_counts = pieces._by_pretoken(counted, True)([])
    assert not len(none) and not len(no_counts)


def _payload(ids, rules, symbols):
    """A shard written by hand: rules as pairs of symbols."""
    length = [1] * len(ids)
    for a, b in rules:
        length.append(length[a] + length[b])
    t, r = len(ids), len(rules)
    sides = [np.array([p[k] for p in rules], "<u4").tobytes() for k in (0, 1)]
    return b"".join([repair.MAGIC, np.array([t, r, len(symbols)], "<u4").tobytes(), np.array(ids, "<u4").tobytes(), *sides,
                     np.array(length[t:], "<u4").tobytes(), np.array(symbols, "<u2").tobytes()])


def test_rules_that_build_on_each_other_one_by_one():
    shard = repair.Shard(_payload([7, 9], [(0, 1), (2, 0), (1, 0), (3, 4), (5, 5)], [6, 1, 4]))
    assert shard.decode().tolist() == [7, 9, 7, 9, 7, 7, 9, 7, 9, 7, 9, 9, 7]
    assert shard.decode(4, 11).tolist() == [7, 7, 9, 7, 9, 7, 9]
    with pytest.raises(ValueError):
        repair.Shard(_payload([7, 9], [(0, 1)], [2]).replace(np.array([0, 1], "<u4").tobytes() + np.array([2], "<u4").tobytes(),
                                                             np.array([2, 1], "<u4").tobytes() + np.array([2], "<u4").tobytes()))


def test_lengths_of_rules():
    rng = np.random.default_rng(5)
    ids = np.concatenate([np.tile(rng.integers(0, 40, 300), 30), rng.integers(0, 40, 20_000)]).astype(np.uint32)
    shard = repair.Shard(repair.compress(ids))
    assert len(shard.length) > len(shard.ids) + 50 and shard.length.max() > 16
    assert (shard.decode() == ids).all()
