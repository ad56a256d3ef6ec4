"""Whole texts to integer codes, word by word, with a bounded cache.

A corpus repeats its words far more often than it has words, so the costly
step (BPE, feature hashing) runs once per distinct piece of a batch that the
worker does not know yet; everything per occurrence is an Arrow or numpy
kernel. Cutting a text into pieces is exact: a cut is made only where the
consumer's own word rule always has a boundary.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: two white space characters in a row, or the cut mark itself
_IRREGULAR = r"[\x00]|[\t-\r\x1c- \x{85}\p{Z}][\t-\r\x1c- \x{85}\p{Z}]"
_BEFORE_SPACE = re.compile(r"(?= \S)")
#: distinct pieces a worker remembers; the cache starts anew beyond that
CACHE_PIECES = 500_000
#: bytes of text handled at once inside a task
SLICE_BYTES = 8 << 20


def as_text(column: pa.Array) -> pa.Array:
    """String array with 64-bit offsets; null becomes the empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    n = len(texts)
    if not n:
        return
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(size) - size) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[i], start[i]+1, ... for each i, length[i] of them, end to end."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - before, length)


def split_keeping_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces that keep their leading space, for byte-level pre-tokenizers.

    Such a rule always cuts before a space that a visible character follows,
    and around a lone line break. Texts with white space runs are cut only
    before a space that a visible character follows.
    """
    odd = pc.match_substring_regex(texts, _IRREGULAR)
    if pc.any(odd).as_py():
        rows = [_BEFORE_SPACE.split(x) if o else re.sub("\n", "\0\n\0", x.replace(" ", "\0 ")).split("\0")
                for x, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)]
        lists = pa.array(rows, pa.large_list(pa.large_string()))
    else:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(marked, "\0")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def split_dropping_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces between spaces and line breaks, for rules that drop white space."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


# Classes of bytes. A run of letters, of digits or of other visible ASCII is a pre-token of both
# kinds of vocabulary file; what is left to the library (LEFT) keeps its whole piece together.
SPACE, BREAK, LETTER, DIGIT, SIGN, LEFT = range(6)


def _byte_classes(letter_leads: range, line_break: int) -> bytes:
    kind = np.full(256, LEFT, np.uint8)
    kind[33:127], kind[ord("0"):ord("9") + 1] = SIGN, DIGIT
    kind[ord("A"):ord("Z") + 1] = kind[ord("a"):ord("z") + 1] = LETTER
    kind[0x80:0xC0] = kind[letter_leads.start:letter_leads.stop] = LETTER  # as UTF-8; other leads are left
    kind[[ord("'"), ord("|")]] = LEFT  # contractions, special tokens
    kind[[ord(" "), ord("\n")]] = SPACE, line_break
    return kind.tobytes()


# lead bytes of U+00C0 to U+024F, of which only the two signs below are no letters; to U+00FF where case matters
_KEEPING, _IN_PIECES = (_byte_classes(range(0xC3, 0xCA), x) for x in (BREAK, LEFT))
_DROPPING = _byte_classes(range(0xC3, 0xC4), SPACE)
_LOWER = bytes(range(256)).lower()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and the edges of the texts in them."""
    _, edges, data = texts.buffers()
    edge = np.frombuffer(edges, np.int64, len(texts) + 1, 8 * texts.offset)
    size = int(edge[-1] - edge[0])
    return np.frombuffer(data, np.uint8, size, int(edge[0])) if size else np.empty(0, np.uint8), edge - edge[0]


def _kinds(data: np.ndarray, classes: bytes) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(classes), np.uint8) if len(data) else data


def _starts(data: np.ndarray, kind: np.ndarray, piece: np.ndarray, left: np.ndarray, digits_alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """(whether a pre-token begins at each byte, the bytes of pieces that stay whole): at ``piece``
    and, in pieces with no byte ``left``, where the class changes."""
    start = piece.copy()
    start[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
    if digits_alone:
        start |= kind == DIGIT
    times = np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))  # U+00D7, U+00F7
    left = np.concatenate([np.flatnonzero(left), times])
    if not len(left):
        return start, left
    edge = np.append(np.flatnonzero(piece), len(data))
    whole = np.zeros(len(edge) - 1, bool)
    whole[np.searchsorted(edge, left, "right") - 1] = True
    at = np.flatnonzero(start)
    own = piece[at]
    start[at[whole[np.cumsum(own) - 1] & ~own]] = False
    return start, ragged(edge[:-1][whole], np.diff(edge)[whole])


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64, copy=False)), pa.py_buffer(data))


def split_keeping_pretokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of :func:`split_keeping_spaces`, those of ASCII and Latin letters cut into pre-tokens."""
    regular = not pc.any(pc.match_substring_regex(texts, _IRREGULAR)).as_py()
    if regular:
        data, edge = _bytes_of(texts)
    else:
        pieces, per_text = split_keeping_spaces(texts)
        data, bounds = _bytes_of(pieces)
        edge = bounds[np.concatenate([[0], np.cumsum(per_text)])]
    kind = _kinds(data, _KEEPING if regular else _IN_PIECES)
    piece = (kind == SPACE) | (kind == BREAK) if regular else np.zeros(len(data), bool)
    inside = edge if regular else bounds
    piece[inside[inside < len(data)]] = True
    left = kind == LEFT
    if regular:
        piece[1:] |= kind[:-1] == BREAK
    else:
        left |= (kind == SPACE) & ~piece
    at = np.flatnonzero(_starts(data, kind, piece, left, False)[0])
    return _strings(np.append(at, len(data)), data), np.diff(np.searchsorted(at, edge))


def split_dropping_pretokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of :func:`split_dropping_spaces`, those of ASCII and Latin-1 letters cut into pre-tokens in lower case."""
    data, edge = _bytes_of(texts)
    kind = _kinds(data, _DROPPING)
    seen = kind != SPACE
    piece = seen.copy()
    piece[1:] &= ~seen[:-1]
    first = edge[edge < len(data)]
    piece[first] = seen[first]
    start, whole = _starts(data, kind, piece, kind == LEFT, True)
    # a start at white space is the end of a word
    start &= seen
    low = _kinds(data, _LOWER).copy()
    low[1:] += ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)) * np.uint8(0x20)
    low[whole] = data[whole]
    words = _strings(np.append(np.flatnonzero(start[seen]), np.count_nonzero(seen)), low[seen])
    return words, np.diff(np.searchsorted(np.flatnonzero(start), edge))


_IN_USE: list = []


class PieceCoder:
    """Codes of texts, through ``code_pieces(list of str) -> (codes, count of each)``."""

    def __init__(self, split: Callable, code_pieces: Callable, cap: int = CACHE_PIECES, dtype=np.int32):
        self.split, self.code_pieces, self.cap, self.dtype = split, code_pieces, cap, dtype
        self._forget()

    def _alone(self) -> None:
        """Workers outlive stages: only the coder in use keeps its cache, so a chain of operators
        needs no more memory than its largest one."""
        if _IN_USE and _IN_USE[0] is not self:
            _IN_USE.pop()._forget()
            pa.default_memory_pool().release_unused()
        if not _IN_USE:
            _IN_USE.append(self)

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat = np.empty(1 << 16, self.dtype)
        self.start = np.zeros(1 << 14, np.int64)  # start[slot] .. start[slot + 1]

    def _learn(self, words: list[str]) -> None:
        codes, counts = self.code_pieces(words)
        n, used = len(self.slot), int(self.start[len(self.slot)])
        while used + len(codes) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + len(words) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[used:used + len(codes)] = codes
        self.start[n + 1:n + len(words) + 1] = used + np.cumsum(counts)
        self.slot.update(zip(words, range(n, n + len(words)), strict=True))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all texts end to end, number of codes of each text)."""
        self._alone()
        words, per_text = self.split(texts)
        coded = words.dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.slot) > self.cap:
            self._forget()
        slot = np.fromiter(map(self.slot.get, unique, repeat(-1)), np.int64, len(unique))
        new = np.flatnonzero(slot < 0)
        if len(new):
            slot[new] = len(self.slot) + np.arange(len(new))
            self._learn([unique[i] for i in new.tolist()])
        first, many = self.start[slot], self.start[slot + 1] - self.start[slot]
        at = coded.indices.to_numpy(zero_copy_only=False)
        length = many[at]
        edge = np.concatenate([[0], np.cumsum(per_text)])
        total = np.concatenate([[0], np.cumsum(length)])
        return self.flat[ragged(first[at], length)], np.diff(total[edge])


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    from zlib import crc32

    return crc32(ids.astype("<u4", copy=False))


# --- the tokenizers library ---------------------------------------------------

_CODERS: dict[tuple[str, bool], PieceCoder] = {}


def library_coder(path: str, keep_spaces: bool, cap: int = CACHE_PIECES) -> PieceCoder:
    """This worker's coder for a tokenizers-library file (no special tokens added)."""
    if (path, keep_spaces) not in _CODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _CODERS[path, keep_spaces] = PieceCoder(
            split_keeping_pretokens if keep_spaces else split_dropping_pretokens, _single_pretokens(tok, keep_spaces), cap)
    return _CODERS[path, keep_spaces]


# The pre-tokenizer rules of the two kinds of vocabulary file.
KEEPING_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DROPPING_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n"""


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _by_pretoken(tok, keep_spaces: bool, at_once: int = 5000) -> Callable:
    """Codes pieces through the library, all distinct pieces of a batch together.

    Pieces of visible Latin characters are joined by line breaks; all others
    (controls, special token strings, other scripts) go through the library's
    whole chain one by one. Where a line break is one id that nothing else in
    such pieces gives, the library codes the joined text at once and that id
    cuts it; else one regular expression cuts it into pre-tokens and the model
    is called once per distinct pre-token.
    """
    import regex

    rule = regex.compile(KEEPING_RULE if keep_spaces else DROPPING_RULE)
    plain = re.compile((" ?" if keep_spaces else "") + "[!-~\xa1-\xac\xae-\u024f]+").fullmatch
    letters = {chr(b): c for b, c in byte_letters().items()}
    table, model = str.maketrans(letters), tok.model
    line_break = tok.encode("\n", add_special_tokens=False).ids if keep_spaces else []

    def ids_of(word: str) -> list[int]:
        return [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(table))]

    def by_rule(group: list[str], known: dict[str, list[int]]) -> list[list[int]]:
        rows, out = [], []
        text = "\n".join(group)
        for pre in rule.findall(text if keep_spaces else text.lower()):
            if pre == "\n":
                rows.append(out)
                out = []
                continue
            got = known.get(pre)
            if got is None:
                got = known[pre] = ids_of(pre)
            out += got
        return [*rows, out]

    def easy_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known: dict[str, list[int]] = {}
        codes, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for k in range(0, len(words), at_once):
            group = words[k:k + at_once]
            if len(line_break) == 1:
                ids = np.array(tok.encode_batch_fast(["\n".join(group)], add_special_tokens=False)[0].ids, np.int32)
                cut = np.flatnonzero(ids == line_break[0])
                if len(cut) == len(group) - 1:
                    codes.append(np.delete(ids, cut))
                    counts.append(np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
                    continue
            rows = by_rule(group, known)
            counts.append(np.fromiter(map(len, rows), np.int64, len(rows)))
            codes.append(np.fromiter(chain.from_iterable(rows), np.int32, int(counts[-1].sum())))
        return np.concatenate(codes), np.concatenate(counts)

    def code(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        easy = np.fromiter((plain(w) is not None and "<|" not in w for w in words), bool, len(words))
        if easy.all():
            return easy_codes(words)
        codes, of_easy = easy_codes([w for w, e in zip(words, easy.tolist(), strict=True) if e])
        rest = [tok.encode(words[i], add_special_tokens=False).ids for i in np.flatnonzero(~easy).tolist()]
        counts = np.empty(len(words), np.int64)
        counts[easy] = of_easy
        counts[~easy] = np.fromiter(map(len, rest), np.int64, len(rest))
        out = np.empty(int(counts.sum()), np.int32)
        of_id = np.repeat(easy, counts)
        out[of_id] = codes
        out[~of_id] = np.fromiter(chain.from_iterable(rest), np.int32, int(counts[~easy].sum()))
        return out, counts

    return code


def _single_pretokens(tok, keep_spaces: bool) -> Callable:
    """Codes of pieces: what is one pre-token for certain goes to the library's model, the rest through :func:`_by_pretoken`."""
    signs = r"[!-&(-/:-@\[-`{}~]+"
    rule = " ?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+|[0-9]+|" if keep_spaces else "(?:[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|"
    single = re.compile(rule + signs + ")").fullmatch
    letters = byte_letters()
    table, line_break, tokenize = str.maketrans({chr(b): c for b, c in letters.items()}), letters[10], tok.model.tokenize
    by_pretoken = _by_pretoken(tok, keep_spaces)

    def code(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        easy = [single(w) is not None for w in words]
        text = "\n".join(compress(words, easy)).encode().decode("latin-1").translate(table)
        rows = [[t.id for t in tokenize(w)] for w in text.split(line_break)] if text else []
        if not all(easy):
            rest, many = by_pretoken([w for w, e in zip(words, easy, strict=True) if not e])
            own, others = iter(rows), iter(np.split(rest, np.cumsum(many)[:-1]))
            rows = [next(own) if e else next(others).tolist() for e in easy]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.int32, int(counts.sum())), counts

    return code
