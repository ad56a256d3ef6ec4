"""Near duplicates and components against brute force."""

import random
import re

import pytest

from lakeride.llm.components import components
from lakeride.llm.neardup import Params, near_duplicates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n):
    sets = [shingles(t, n) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    first = {}
    for (d, _), p in zip(rows, part, strict=True):
        first[p] = min(first.get(p, d), d)
    return {d: (len(s), first[p]) for (d, _), s, p in zip(rows, sets, part, strict=True)}


def edited(rnd, words, share):
    return " ".join(rnd.choice("pqrstuv") * 5 if rnd.random() < share else w for w in words)


@pytest.mark.parametrize("n", [4, 5])
def test_components_equal_brute_force(make, n):
    rnd = random.Random(n)
    vocab = [f"w{i}" for i in range(300)]
    rows, i = [], 1000
    for family in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([8, 40, 150, 400]))]
        for _ in range(rnd.choice([1, 3, 30])):
            rows.append((i, edited(rnd, base, rnd.choice([0, 0.005, 0.02, 0.04, 0.1]))))
            i -= 1
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    rows += [(2000 + k, " ".join(rnd.choice(vocab) for _ in range(50)) + " " + passage) for k in range(40)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t "), (3003, "one two"), (3004, "ONE\ttwo"), (3005, "one two three"), (3006, None)]
    rows += [(4000 + k, rows[0][1].upper()) for k in range(20)]
    rnd.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(make(rows), Params(words=n)).collect()}
    assert got == brute(rows, n)


def test_null_ids_repeated_rows_and_empty(make, empty):
    text = " ".join(f"t{i}" for i in range(30))
    got = near_duplicates(make([(None, text), (5, text), (5, text), (7, text), (8, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True)]
    out = near_duplicates(empty)
    assert out.count() == 0 and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    rest = [(9, 9), (1, 2), (2, 1), (1, 2), (None, 4)]
    edges = chain + star + rest
    rnd.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {1: 1, 2: 1}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
