"""A worker codes a pre-token once, whatever stands around it in the texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakeride.llm import pieces

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
WORDS = ["alpha", "Beta", "gamma", "señor", "Ärger"]
SIGNS = ["", ".", ",", "!!", ";", ")", "...", "##", "7", "42"]
ODD = ["a", "Z", "é", "É", "ß", "×", "÷", "œ", "İ", "Ⱥ", "ǅ", "'s", "'", "|", "<|endoftext|>", "<|ENDOFTEXT|>", "0", "12", "½", "ª", " ", "  ",
       "\n", "\n\n", "\t", "\x00", "\x85", "\xa0", ".", ",", "!!", "你好", "J̌", "İ", "\x1c", "\r\n", "don't", "WE'LL", "</w>", " the"]


def _coder(path, keep, cap=1000):
    tok = Tokenizer.from_file(path)
    split = pieces.split_keeping_pretokens if keep else pieces.split_dropping_pretokens
    return tok, pieces.PieceCoder(split, pieces._single_pretokens(tok, keep), cap)


def _equal(tok, coder, texts):
    ids, counts = coder(pieces.as_text(pa.array(texts, pa.string())))
    want = [tok.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def _texts():
    return [" ".join(w + s for w in WORDS) for s in SIGNS] + [w + s + v for w in WORDS for s in SIGNS[1:8] for v in WORDS]


def test_words_before_signs_are_coded_once_spaces_kept():
    tok, coder = _coder(BYTE, True)
    _equal(tok, coder, _texts())
    # the first word never follows a space
    assert len(coder.slot) == 2 * len(WORDS) - 1 + len(SIGNS) - 1
    assert pieces.library_coder(BYTE, True).split is coder.split


def test_words_before_signs_are_coded_once_spaces_dropped():
    tok, coder = _coder(WORD, False)
    _equal(tok, coder, _texts())
    # digits are pre-tokens one by one: 7, 4 and 2
    assert len(coder.slot) == len(WORDS) + len(SIGNS) - 3 + 3
    assert pieces.library_coder(WORD, False).split is coder.split


@pytest.mark.parametrize(("path", "keep"), [(BYTE, True), (WORD, False)])
def test_odd_texts_equal_the_library(path, keep):
    rng = random.Random(11)
    tok, coder = _coder(path, keep, 100)
    _equal(tok, coder, [None, "", None])
    _equal(tok, coder, [" ", "\n", "", "x"])
    for _ in range(300):
        own = rng.sample(ODD, rng.randint(2, len(ODD)))
        _equal(tok, coder, ["".join(rng.choices(own, k=rng.randint(0, 12))) for _ in range(rng.randint(1, 6))])


@pytest.mark.parametrize("split", [pieces.split_keeping_pretokens, pieces.split_dropping_pretokens])
def test_a_slice_of_texts_is_cut_like_a_copy_of_it(split):
    texts = pa.array(["one two", "", "Été, 12 ×3", "it's  odd\n", "last"], pa.large_string())
    for k in range(5):
        words, counts = split(texts.slice(k, 2))
        copy, same = split(pa.array(texts.slice(k, 2).to_pylist(), pa.large_string()))
        assert words.to_pylist() == copy.to_pylist() and counts.tolist() == same.tolist()


def test_the_model_is_called_once_for_each_pretoken_of_a_packer():
    class Model:
        calls = 0

        def tokenize(self, word):
            Model.calls += 1
            return tok.model.tokenize(word)

    class Counted:
        model = Model()

        def encode(self, *args, **kw):
            return tok.encode(*args, **kw)

    tok, _ = _coder(WORD, False)
    coder = pieces.PieceCoder(pieces.library_coder(WORD, False).split, pieces._single_pretokens(Counted(), False), 1000)
    for k in range(0, len(_texts()), 20):
        _equal(tok, coder, _texts()[k:k + 20])
    assert Model.calls == len(WORDS) + len(SIGNS)
