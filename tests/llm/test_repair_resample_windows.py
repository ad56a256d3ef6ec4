"""Turn repair, importance resampling and window dedup against brute force, with their edge cases."""

import hashlib
import heapq
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from lakeride.llm import resample, substrings, turns

TURN = "conv_id long, turn long, role string, text string, cost string, audit long, lost boolean"


# --- turn repair -----------------------------------------------------------------

GRAMMAR = re.compile(r"(s?(ua)+)?").fullmatch


def plain_cheapest(initials, faults, limit=40):
    """Cheapest edits by trying all of them in order of cost, then of text."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, roles = heapq.heappop(queue)
        if i == len(initials) and GRAMMAR(roles):
            return cost, audit
        if (audit, i, roles) in done or cost > limit or len(roles) > len(initials) + 4:
            continue
        done.add((audit, i, roles))
        for r in "ua":
            heapq.heappush(queue, (cost + 2, audit + "I", i, roles + r))
        if i < len(initials):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, roles))
            if faults[i] in (turns.NONE, turns.CUT):
                more = faults[i] == turns.CUT
                heapq.heappush(queue, (cost + more, audit + "K", i + 1, roles + (initials[i] or "-")))
                for r in "ua":
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, roles + r))


def test_search_equals_brute_force():
    rng = random.Random(5)
    for _ in range(250):
        n = rng.randint(0, 4)
        initials = [rng.choice("suuaat") for _ in range(n)]
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert turns.cheapest_edits(initials, faults) == plain_cheapest(initials, faults), (initials, faults)


def test_blocks_chain_to_the_same_edits():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randint(3, 14)
        initials = [rng.choice("suuuaaat") for _ in range(n)]
        faults = [rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
        whole = turns.search(initials, faults)
        for block in (1, 2, 5):
            assert turns.cheapest_edits(initials, faults, block) == whole


def test_a_very_long_conversation_is_searched_in_blocks():
    rng = random.Random(7)
    initials = [c for _ in range(3000) for c in "ua" if rng.random() > 0.05]
    cost, audit = turns.cheapest_edits(initials, [0] * len(initials))
    assert 0 < cost <= 4 * 600 and len(audit.replace("I", "")) == len(initials)


def test_repair_rows(spark):
    rows = [(1, 0, "user", "Hi there."), (1, 1, "assistant", "Hello!"),
            (2, None, "system", "Be kind."), (2, 3, "user", "Go on"), (2, 3, "user", "Go on"), (2, 9, "assistant", " \t"),
            (3, 0, None, "What?"), (3, 1, "", None), (None, 0, "assistant", "Yes."), (4, 0, "user", "gone")]
    data = spark.createDataFrame([(*r, "x", 7, r[0] == 4) for r in rows], TURN)
    got = {r.conv_id: r for r in turns.repair(data, "lost").collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert (got[1].cost, got[1].audit, got[1].illegal, got[1].gaps) == (0, "KK", 0, 0)
    assert [tuple(t) for t in got[1].repaired] == [("user", "Hi there."), ("assistant", "Hello!")]
    two = got[2]
    # turns 3 to 9, two of seven there; the second 'Go on' is a duplicate, the answer is blank
    assert (two.gaps, two.blank, two.duplicate, two.truncated, two.illegal) == (5, 1, 1, 1, 1)
    assert (two.cost, two.audit) == (9, "KKDDI")
    assert [tuple(t) for t in two.repaired] == [("system", "Be kind."), ("user", "Go on"), ("assistant", "")]
    assert (got[3].blank, got[3].cost, got[3].audit) == (1, 6, "DD")
    assert (got[None].cost, got[None].audit) == (2, "IK")
    assert (got[4].cost, got[4].audit, got[4].gaps, list(got[4].repaired)) == (0, "", 0, [])
    hashed = {r.conv_id: r.repaired_sha256 for r in turns.digests(turns.repair(data, "lost")).collect()}
    assert hashed[4] == hashlib.sha256(b"").hexdigest()
    assert hashed[1] == hashlib.sha256(b"user:Hi there.\nassistant:Hello!").hexdigest()


def test_repair_of_nothing_and_of_long_texts(spark):
    assert turns.repair(spark.createDataFrame([], TURN)).collect() == []
    long = "w" * 3_000_000 + "."
    got = turns.repair(spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", f"{i}{long}", "", 0, False) for i in range(4)], TURN)).head()
    assert (got.audit, got.truncated) == ("KKKK", 0) and got.repaired[3].text == f"3{long}"


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = {}
    for r in turns.damage(spark.createDataFrame([(*r, "", 0, False) for r in rows], TURN)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.lost))
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fate = crc32(key.encode()) % 20
        want = (role or " ", text or " ", fate == 0)
        want = {1: (want[0], "", False), 2: (want[0], re.sub("[.!?]", "", want[1]), False), 4: ("user", *want[1:])}.get(fate, want)
        assert got[c, t] == [want] * (2 if fate == 3 else 1)


# --- resampling -------------------------------------------------------------------

def plain_features(text, longest):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [crc32(" ".join(words[i:i + n]).encode()) % 50 for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


DOCS = [(0, "The cat sat. The CAT ran"), (1, None), (2, ""), (3, "..."), (4, "one"), (5, "Ünï çé 12 a\x00b ÿ x"), (6, "b c " * 3000),
        (7, "cat sat on the mat"), (7, "cat sat on the mat"), (8, "A B C D E F G H"), (9, "one two three four"), (None, "cat on mat cat")]


@pytest.mark.parametrize("longest", [1, 3])
def test_resample_equals_brute_force(make, longest):
    target = [(0, "the cat sat on the mat"), (1, None), (2, "b c")]
    s, t = Counter(), Counter()
    for _, text in DOCS:
        s.update(plain_features(text, longest)[1])
    for _, text in target:
        t.update(plain_features(text, longest)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)]
    want = []
    for doc, text in DOCS:
        words, found = plain_features(text, longest)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        want.append((doc, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((w for w in want if w[1] >= 3), key=lambda w: (-w[4], w[0] is None, w[0] or 0))
    drawn = order[:60 * len(order) // 100]
    rows = resample.resample(make(DOCS), make(target), percent=60, least_words=3, longest=longest, buckets=50).collect()
    got = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    ranked = sorted((r for r in rows if r.rank is not None), key=lambda r: r.rank)
    assert [(r.doc_id, r.score) for r in ranked] == [(w[0], w[4]) for w in drawn]
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))


def test_resample_of_nothing(empty, make):
    assert resample.resample(empty, make(DOCS)).collect() == []
    assert len(resample.resample(make(DOCS), empty).collect()) == len(DOCS)


def test_ngrams_do_not_cross_texts():
    texts = pa.array(["a b", "", "c", "\xff d e"], pa.large_string())
    (_, _, words, bucket, row), = resample.features(texts, 2, 1 << 20)
    assert words.tolist() == [2, 0, 1, 3]
    want = [crc32(x.encode()) % (1 << 20) for x in ("a", "b", "c", "\xff", "d", "e", "a b", "\xff d", "d e")]
    assert bucket.tolist() == want and row.tolist() == [0, 0, 2, 3, 3, 3, 0, 3, 3]


# --- windows ------------------------------------------------------------------------

def plain_dedup(rows, k):
    first = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(w) - k + 1) if doc is not None else ():
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(w) - k + 1) if doc is not None else ():
            if first[tuple(w[i:i + k])] < doc:
                gone |= set(range(i, i + k))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check_dedup(make, rows, k, held):
    got = substrings.remove_repeats(make(rows, 5), words=k, held=held).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == sorted(plain_dedup(rows, k), key=str)
    for r in got:
        spans = [tuple(s) for s in r.spans]
        assert sum(y - x for x, y in spans) == r.n_removed
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))  # maximal: never adjacent


@pytest.mark.parametrize("held", [3, 40, 1_000_000])
def test_windows_equal_brute_force(make, held):
    rng = random.Random(held)
    rows = [(rng.randint(0, 60), " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for _ in range(60)]
    passage = " ".join(f"w{i}" for i in range(20))
    rows += [(100 + i, f"x{i} {passage} y{i}") for i in range(30)] + [(200, passage), (200, passage), (None, passage), (201, None), (202, ""),
             (203, "\x85　 a b \x1c\x0b\x0c\t\r\n"), (204, "Z" * 500 + " " + passage), (205, "Z" * 500 + " w0 w1 w2 w3 w4")]
    check_dedup(make, rows, 4, held)


def test_windows_of_long_texts(make):
    rng = random.Random(1)
    base = [f"{rng.randrange(10**6)}" for _ in range(400_000)]  # several blocks of bytes
    rows = [(1, " ".join(base)), (2, "new " + "\n".join(base[350_000:]) + " end"), (3, "€" * 700_000 + " " + " ".join(base[5:25]))]
    check_dedup(make, rows, 13, 100_000)


def test_windows_of_nothing(empty):
    assert substrings.remove_repeats(empty).collect() == []


def test_word_hashes_tell_words_apart():
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in ("", "x", "xy", "é") for c in range(60)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end = substrings.word_spans(data, np.array([0, len(data)]))
    hashes = substrings.word_hashes(data, start, end)
    assert len(set(hashes.tolist())) == len(set(words)) == len(words)
