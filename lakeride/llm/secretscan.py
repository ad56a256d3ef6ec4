"""Secret scan: candidate strings, and a random forest that removes the false ones.

Candidates are long runs of token characters and values assigned to
credential names. The forest sees a candidate's length, its character
transitions, how much of it dictionary words cover, the document's path and
the neighbouring words. It is trained on a bounded sample of labelled findings
and then judges every candidate of every whole text in one pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import pieces

#: labelled findings of each kind that the forest is fitted on, at most
SAMPLE = 4000
#: with fewer findings of either label there is no forest
LEAST_FINDINGS = 10
TREES, DEPTH, LEAST_LEAF, BINS = 40, 8, 3, 32
LIMIT = 0.5
MASK = "[SECRET]"

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_ASSIGNED = re.compile(r"(?i)(?:passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|credential)[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{8,})")
_NAMES = ("passw", "pwd", "secret", "token", "key", "credential")
_CREDENTIAL = re.compile(r"(?i)passw|pwd|secret|token|api[_-]?key|access[_-]?key|credential|bearer|auth")
_EXPRESSION = re.compile(r"[()\[\]{}<>]")
_HARMLESS = re.compile(r"(?i)commit|sha\d*|md5|checksum|digest|hash|uuid|revision|etag|example|sample|test|dummy")

# Words that make a long string look like a name and not like a secret.
DICTIONARY = frozenset("""
about above access account action address after again all and any application are array author back base before
below between block body book build but button bytes call can case change char check class clean client close code
color column com command common config connect content context copy count create current data date day default
delete der des die document down each edit ein else empty end ent error est event example false field file filter
first float font for format found from function get group handle has head heit height here home host html http
image import index info ing input int into ion ist item json keit key label language las last left length les level
light line link list load local log long los main make map max mente menu message method min mode model module name
network new next node not null number object off only open option order org other out page parent path per pour
print private process public que query read ready request reset response result return right root row run save
search select self send server service set show sion size sort source start state static status stop string style
sub system table tag target temp template test text than that the this time title tion token top tree true type ung
und una une unit update url use user val value var version view von was web when width window with word work write
year you
""".split())


@dataclass
class Candidate:
    start: int
    end: int
    value: str
    before: str
    after: str


def candidates(text: str) -> list[Candidate]:
    """Candidate strings of a text in order, without overlaps.

    A run that goes on into an assigned value ends before the credential name,
    and what is left of it is a candidate if long enough; the value is one as a
    whole. A run inside a value, or one that begins there, adds to that value.
    """
    low = text.lower()
    values = [(m.start(), *m.span(1)) for m in _ASSIGNED.finditer(text)] if any(n in low for n in _NAMES) else []
    spans, i = [], 0
    for m in _RUN.finditer(text):
        s, e = m.span()
        while i < len(values) and values[i][2] <= s:
            spans.append(values[i][1:])
            i += 1
        while i < len(values) and values[i][1] < e:
            name, start, end = values[i]
            if _long_enough(text, s, min(name, start)):
                spans.append((s, min(name, start)))
            spans.append((start, end))
            s, i = end, i + 1
        if spans and s < spans[-1][1]:  # begins inside the value before
            if e > spans[-1][1]:
                spans[-1] = spans[-1][0], e
        elif _long_enough(text, s, e):
            spans.append((s, e))
    spans += [v[1:] for v in values[i:]]
    return [Candidate(s, e, text[s:e], text[max(0, s - 60):s], text[e:e + 30]) for s, e in spans]


def _long_enough(text: str, start: int, end: int) -> bool:
    return end - start >= 20 or end - start >= 16 and any(c.isdigit() for c in text[start:end])


def _kind(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


def dictionary_coverage(value: str) -> float:
    """Share of the characters that dictionary words of three letters or more cover, longest first."""
    low, i, covered = value.lower(), 0, 0
    while i < len(low):
        size = next((k for k in range(min(11, len(low) - i), 2, -1) if low[i:i + k] in DICTIONARY), 0)
        covered += size
        i += size or 1
    return covered / max(1, len(value))


def _bucket(word: str, n: int) -> int:
    from zlib import crc32

    return crc32(word.encode()) % n


def describe(c: Candidate, path: str) -> list[float]:
    """The features of a candidate."""
    v, n = c.value, len(c.value)
    counts = Counter(v)
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    kinds = [_kind(x) for x in v]
    moves = [0.0] * 16
    for a, b in zip(kinds, kinds[1:], strict=False):
        moves[4 * a + b] += 1 / max(1, n - 1)
    words = re.findall(r"\w+", c.before)[-2:]
    near = [0.0] * 12
    for w in words:
        near[_bucket(w.lower(), 12)] = 1.0
    place = [0.0] * 8
    for part in re.findall(r"\w+", path.lower()):
        place[_bucket(part, 8)] = 1.0
    behind = c.before.rstrip("\"' ")
    return [float(n), math.log(n), entropy, len(counts) / n, kinds.count(0) / n, kinds.count(1) / n, kinds.count(2) / n,
            kinds.count(3) / n, float(sum(x in "0123456789abcdefABCDEF" for x in v) / n), *moves, dictionary_coverage(v),
            float(behind.endswith(("=", ":"))), float(c.before[-1:] in "\"'" and c.before != ""), float(c.after[:1] in "\"'" and c.after != ""),
            float(bool(_CREDENTIAL.search(c.before[-24:]))), float(bool(_HARMLESS.search(c.before[-24:]))),
            float(bool(re.search(r"test|example|sample|doc", path.lower()))), *near, *place]


def weak_label(c: Candidate) -> int | None:
    """A label where the surroundings leave little doubt, for corpora without reviewed findings.

    1: a value with letters and digits, assigned to a credential name, that is quoted or follows
    its = at once and looks like no expression and no words.
    0: no credential name nearby, and only letters, only digits, or mostly dictionary words. Else none.
    """
    named = bool(_CREDENTIAL.search(c.before[-24:]))
    assigned = c.before.rstrip("\"' ").endswith(("=", ":"))
    mixed = any(x.isdigit() for x in c.value) and any(x.isalpha() for x in c.value)
    bare = c.before.endswith("=") and c.value[0] not in "$=" and not _EXPRESSION.search(c.value) and dictionary_coverage(c.value) < 0.5
    if named and assigned and mixed and (c.after[:1] in ('"', "'") or bare) and not _HARMLESS.search(c.before[-24:]):
        return 1
    if not named and (not mixed or dictionary_coverage(c.value) >= 0.5 or _HARMLESS.search(c.before[-24:])):
        return 0
    return None


class Forest:
    """Random forest on binned features: bootstrap rows, a random subset of features at each split, Gini."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        self.trees = []
        for _ in range(trees):
            rows = rng.integers(0, len(x), len(x))
            self.trees.append(self._grow(binned[rows], y[rows].astype(float), depth, rng))

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1).astype(np.int16)

    @staticmethod
    def _grow(x: np.ndarray, y: np.ndarray, depth: int, rng) -> np.ndarray:
        """Rows (feature or -1, bin, left, right, share of positives) of one tree."""
        nodes: list[list[float]] = []
        todo = [(np.arange(len(y)), depth, -1, 0)]
        while todo:
            rows, left, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            share = float(y[rows].mean()) if len(rows) else 0.0
            nodes.append([-1, 0, -1, -1, share])
            if left == 0 or share in (0.0, 1.0) or len(rows) < 2 * LEAST_LEAF:
                continue
            best = (1e-9, -1, 0)
            for j in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1])) + 1), replace=False).tolist():
                total = np.bincount(x[rows, j], minlength=BINS)
                good = np.bincount(x[rows, j], y[rows], BINS)
                n, p = np.cumsum(total)[:-1], np.cumsum(good)[:-1]
                m, q = len(rows) - n, good.sum() - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = p * p / n + q * q / m - good.sum() ** 2 / len(rows)
                gain = np.where((n >= LEAST_LEAF) & (m >= LEAST_LEAF), gain, -1.0)
                if gain.max() > best[0]:
                    best = (float(gain.max()), j, int(np.argmax(gain)))
            if best[1] < 0:
                continue
            nodes[me][0], nodes[me][1] = best[1], best[2]
            low = x[rows, best[1]] <= best[2]
            todo += [(rows[~low], left - 1, me, 1), (rows[low], left - 1, me, 0)]
        return np.array(nodes)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of positives in the leaves that the rows reach."""
        binned, total = self._bin(x), np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                feature = tree[at, 0].astype(np.int64)
                inner = np.flatnonzero(feature >= 0)
                if not len(inner):
                    break
                low = binned[inner, feature[inner]] <= tree[at[inner], 1]
                at[inner] = np.where(low, tree[at[inner], 2], tree[at[inner], 3]).astype(np.int64)
            total += tree[at, 4]
        return total / max(1, len(self.trees))


def _select(docs: DataFrame, keep: list[str], text_col: str, path_col: str) -> DataFrame:
    return docs.select(*(docs[c] for c in keep), docs[text_col].cast("string").alias("__text"),
                       F.coalesce(docs[path_col].cast("string"), F.lit("")).alias("__path"))


def labelled_findings(docs: DataFrame, text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(label, features) of all candidates that :func:`weak_label` can label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, rows = [], []
            for t, p in zip(pieces.as_text(batch.column(0)).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for c in candidates(t):
                    if (y := weak_label(c)) is not None:
                        labels.append(y)
                        rows.append(describe(c, p))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["label", "features"])

    return _select(docs, [], text_col, path_col).mapInArrow(run, "label int, features array<double>")


class Plain:
    """Judge for corpora with too few findings for a forest: a secret is what :func:`weak_label` labels 1, nothing else."""


Judge = Forest | Plain | None


def train(findings: DataFrame, sample: int = SAMPLE) -> Judge:
    """Fits on at most ``sample`` rows (label 0 or 1, features) of each label, those of the smallest
    feature hash. With fewer than ``LEAST_FINDINGS`` of either label the judge is :class:`Plain`;
    without any finding there is none. The findings are computed once and written."""
    findings = materialize(findings, "secret-findings")
    rows = [findings.where(F.col("label") == y).orderBy(F.xxhash64("features"), "features").limit(sample) for y in (0, 1)]
    data = rows[0].unionByName(rows[1]).toPandas()
    if data.empty:
        return None
    if min((data["label"] == y).sum() for y in (0, 1)) < LEAST_FINDINGS:
        return Plain()
    data = data.iloc[np.lexsort((data["features"].map(tuple).map(hash), data["label"]))]
    return Forest(np.array(data["features"].tolist()), data["label"].to_numpy())


def _judged(model: Judge, found: list[Candidate], path: list[str]) -> np.ndarray:
    if model is None or not found:
        return np.ones(len(found))
    if isinstance(model, Plain):
        return np.array([float(weak_label(c) == 1) for c in found])
    return model.score(np.array([describe(c, p) for c, p in zip(found, path, strict=True)]))


def scan(docs: DataFrame, model: Judge, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: doc_id, start, end (characters), n_chars, value_sha256, score, is_secret.

    Null and empty texts have no candidates; a null path is empty, a null id
    stays null; repeated rows are scanned each; an empty table gives no rows.
    Other columns are ignored, whatever their names. The value itself is not
    returned, only its hash. Without a model every candidate counts as a secret.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, paths = [], [], []
            for i, t, p in zip(batch.column(0).to_pylist(), pieces.as_text(batch.column(1)).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = candidates(t)
                ids += [i] * len(own)
                found += own
                paths += [p] * len(own)
            score = _judged(model, found, paths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([c.start for c in found], pa.int64()), pa.array([c.end for c in found], pa.int64()),
                 pa.array([len(c.value) for c in found], pa.int64()),
                 pa.array([sha256(c.value.encode()).hexdigest() for c in found], pa.string()), pa.array(score, pa.float64()),
                 pa.array(score >= LIMIT, pa.bool_())], ["doc_id", "start", "end", "n_chars", "value_sha256", "score", "is_secret"])

    rows = _select(docs.withColumn(id_col, docs[id_col].cast("long")), [id_col], text_col, path_col)
    return rows.mapInArrow(run, "doc_id long, start long, end long, n_chars long, value_sha256 string, score double, is_secret boolean")


def redact(docs: DataFrame, model: Judge, text_col: str = "text", path_col: str = "source") -> DataFrame:
    """All rows and columns of ``docs``, with every confirmed secret in the text replaced by a mask.

    Texts without a secret, null ones too, stay as they are. Without a model
    every candidate is masked; a caller that must not touch clean texts gives
    :class:`Plain` instead.
    """
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            own = [candidates(t or "") for t in texts]
            found = [c for o in own for c in o]
            paths = [p for o, p in zip(own, batch.column(len(names)).to_pylist(), strict=True) for _ in o]
            bad = iter((_judged(model, found, paths) >= LIMIT).tolist())
            for i, o in enumerate(own):
                for c in reversed([c for c in o if next(bad)]):
                    texts[i] = texts[i][:c.start] + MASK + texts[i][c.end:]
            columns = [pa.array(texts, pa.string()) if j == at else batch.column(j) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.withColumn("__path", F.coalesce(docs[path_col].cast("string"), F.lit("")))
    return rows.mapInArrow(run, docs.schema)
