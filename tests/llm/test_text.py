"""Language, toxicity, secrets, quality rules and chat formatting: brute force, held-out accuracy, edge cases."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeride.llm import catalog, chat, langid, quality, secretscan, toxicity

SMALL = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t\x0b\f\r ", "word", "!!! 12 34", "x" * 20000, "Ünïcode é中 text", "a b c d e " * 4000]


# --- language -----------------------------------------------------------------

def plain_grams(text):
    letters = "".join(c if c.isalpha() else "\1" for c in text.lower())
    s = "\1" + letters + "\1"
    s = re.sub("\1+", "\1", s)
    if len(s) < 2:
        return Counter()
    out = Counter(c for c in s if c != "\1")
    out += Counter(s[i:i + 2] for i in range(len(s) - 1)) + Counter(s[i:i + 3] for i in range(len(s) - 2))
    return out


def plain_rank(counts, n):
    key = lambda g: [ord(c) for c in g] + [0] * (3 - len(g))
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:n]


def test_profiles_and_distances_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 120")
    rows = docs.collect()
    total = {}
    for r in rows:
        total.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    code = lambda g: sum(ord(c) << (21 * (2 - i)) for i, c in enumerate(g))
    profiles = {k: plain_rank(v, langid.RANKS) for k, v in total.items()}
    got = langid.train(docs)
    assert got == {k: [code(g) for g in v] for k, v in profiles.items()}
    pred = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, got, ["doc_id"]).collect()}
    for r in rows[:40]:
        own = plain_rank(plain_grams(r.text), langid.RANKS)
        cost = {}
        for lang in sorted(profiles):
            at = {g: i for i, g in enumerate(profiles[lang])}
            cost[lang] = sum(abs(at[g] - i) if g in at else langid.RANKS for i, g in enumerate(own))
        best = min(sorted(cost), key=cost.get)
        assert pred[r.doc_id] == (best, pytest.approx(1 - cost[best] / (langid.RANKS * len(own))))


def test_language_accuracy_on_held_out(spark):
    got = catalog.QUERIES["op3_rank_order_language"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id")
    hit, n = got.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert n > 200 and hit / n > 0.98


def test_language_edge_cases(make, empty):
    profiles = langid.train(make([(1, "the cat and the dog", "en"), (2, None, "en"), (3, "le chat et le chien", "fr"), (4, "x", None)]))
    assert sorted(profiles) == ["en", "fr"]
    got = {r.doc_id: r for r in langid.predict(make([(i, t) for i, t in enumerate(ODD)] + [(50, "the dog")]), profiles, ["doc_id"]).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 4)] == ["und"] * 4 and got[0].score == 0.0
    assert got[50].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert langid.train(empty) == {} and langid.predict(empty, {}, ["doc_id"]).count() == 0
    assert langid.predict(make([(1, "some text")]), {}, ["doc_id"]).head().lang_pred == "und"
    with pytest.raises(ValueError):
        langid.predict(empty, {}, ["score"])


# --- toxicity -----------------------------------------------------------------

def test_cumulative_link_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6)) < 0.4
    z = x @ np.array([3.0, 2.0, 1.0, -2.0, 0.0, 0.0]) + rng.logistic(size=3000) * 0.5
    grade = (z > 1.5).astype(int) + (z > 3.5)
    row, col = np.nonzero(x)
    w, cuts = toxicity.fit_cumulative(row, col, grade, 6)
    assert cuts[0] < cuts[1] and w[0] > w[1] > w[2] > abs(w[4]) and w[3] < 0
    p = toxicity._sigmoid((x @ w)[:, None] - cuts)
    assert np.corrcoef(p.sum(1), grade)[0, 1] > 0.8


def test_gradient_of_the_likelihood():
    grade, row, col = np.array([0, 1, 2, 2, 0]), np.array([0, 1, 2, 3, 3]), np.array([0, 1, 1, 0, 1])
    def loss(w, cuts):
        p = toxicity._sigmoid(np.bincount(row, w[col], 5)[:, None] - cuts)
        full = np.concatenate([np.ones((5, 1)), p, np.zeros((5, 1))], 1)
        i = np.arange(5)
        return -np.log(full[i, grade] - full[i, grade + 1]).mean()
    w, cuts = toxicity.fit_cumulative(row, col, grade, 2, steps=4000, prior=1e-3, rate=0.02)
    best = loss(w, cuts)
    for d in np.eye(4) * 0.05:
        for s in (d, -d):
            assert loss(w + s[:2], cuts + s[2:]) > best - 2e-3


def test_toxicity_on_held_out_labels(spark):
    docs, labels = catalog.table(spark, "/root/testdata/sf0.1", "documents"), catalog.table(spark, "/root/testdata/sf0.1", "labels")
    held = F.col("doc_id") % 3 == 0
    model = toxicity.train(docs, toxicity.severity_labels(labels.where(~held)))
    assert (np.diff(model.cuts) > 0).all() and len(model.cuts) == 3
    got = toxicity.grade_documents(docs.where(held), model, ["doc_id"]).join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id").toPandas()
    bad, clean = got[got.truth == 1], got[got.truth == 0]
    assert bad.toxic.mean() > 0.85 and clean.toxic.mean() < 0.01
    assert bad.expected_severity.mean() > 10 * clean.expected_severity.mean()


def test_toxicity_edge_cases(spark, make, empty):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)] + [(None, 1), (99, None)], "doc_id long, grade int")
    docs = make([(i, "nasty thing" if i % 4 == 0 else "kind words") for i in range(40)])
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.grade_documents(make([(i, t) for i, t in enumerate(ODD)] + [(60, "NASTY, indeed"), (None, "kind")]), model, ["doc_id"]).collect()}
    assert got[60].toxic and not any(got[i].toxic for i in (0, 1, 2, None)) and len(got) == len(ODD) + 2
    assert toxicity.grade_documents(empty, model, ["doc_id"]).count() == 0
    none = toxicity.train(empty, labels.where("1 = 0"))
    assert not toxicity.grade_documents(make([(1, "x")]), none, ["doc_id"]).head().toxic
    with pytest.raises(ValueError):
        toxicity.grade_documents(docs.withColumn("grade", F.lit(1)), model, ["grade"])


def test_toxicity_verdict_does_not_depend_on_the_sample_size(spark, make):
    """'grey' is in 20 % of 2,400 clean and 60 % of 300 toxic documents: 27 % of its documents are toxic."""
    text = lambda i: "grey stone" if i % 5 < (3 if i < 300 else 1) else "plain stone"
    docs = make([(i, text(i)) for i in range(2700)])
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(2700)], "doc_id long, grade int")
    new = make([(1, "grey"), (2, "plain")])
    for sample in (10_000, 300):
        got = {r.doc_id: r for r in toxicity.grade_documents(new, toxicity.train(docs, labels, sample=sample), ["doc_id"]).collect()}
        assert got[1].p_toxic == pytest.approx(0.27, abs=0.06) and not got[1].toxic and got[2].p_toxic < 0.12


# --- secrets ------------------------------------------------------------------

def test_forest_learns_a_rule_and_scores_new_rows():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 12))
    y = ((x[:, 2] > 0.6) & (x[:, 7] < 0.5)).astype(int)
    model = secretscan.Forest(x[:1000], y[:1000])
    assert ((model.score(x[1000:]) >= 0.5) == y[1000:]).mean() > 0.95


def test_secret_scan_on_reviewed_findings(spark, make):
    rnd = np.random.default_rng(2)
    hexes = ["".join(rnd.choice(list("0123456789abcdef"), 40)) for _ in range(120)]
    rows = [(i, f'some words token = "{h}" and more', "en", "conf/app.env") for i, h in enumerate(hexes[:60])]
    rows += [(100 + i, f"in commit {h} we changed it", "en", "docs/log") for i, h in enumerate(hexes[60:])]
    rows += [(300 + i, "card 4111111111111111 and verylongcompoundwordwithoutend here", "en", "src") for i in range(30)]
    docs = make(rows)
    model = secretscan.train(secretscan.labelled_findings(docs.where("doc_id % 2 = 0"), path_col="source"))
    got = secretscan.scan(docs.where("doc_id % 2 = 1"), model).collect()
    assert all(r.is_secret == (r.doc_id < 100) for r in got) and len(got) > 80
    assert all(r.end - r.start == r.n_chars for r in got)


def test_secret_edge_cases(make, empty):
    secret = "a1B2c3D4e5F6g7H8i9J0k"
    assert [c.value for c in secretscan.candidates(f'password: "{secret}" pwd=hunter22x')] == [secret, "hunter22x"]
    docs = make([(i, t) for i, t in enumerate(ODD)] + [(None, f"key {secret} end"), (7, None), (70, f"{secret} {secret}")])
    found = secretscan.scan(docs, None).collect()  # no model: nothing is removed
    assert sum(r.doc_id is None for r in found) == 1 and sum(r.doc_id == 70 for r in found) == 2
    out = {r.doc_id: r.text for r in secretscan.redact(docs.where("doc_id in (0, 3, 70)"), None).collect()}
    assert out == {0: None, 3: "word", 70: f"{secretscan.MASK} {secretscan.MASK}"}
    assert secretscan.scan(empty, None).count() == 0 and secretscan.redact(empty, None).count() == 0
    assert secretscan.train(secretscan.labelled_findings(empty)) is None
    assert secretscan.redact(docs, None).columns == docs.columns


def test_unquoted_assignments_are_whole_candidates_with_their_name_before():
    found = lambda t: [(c.value, c.before) for c in secretscan.candidates(t)]
    assert found("export DB_PASSWORD=hunter2hunter2!s3cr3t$tail x") == [("hunter2hunter2!s3cr3t$tail", "export DB_PASSWORD=")]
    assert found("api_key=Zx81kQ0p22mN\n") == [("Zx81kQ0p22mN", "api_key=")]
    assert found("pwd=!a1B2c3D4e5F6g7H8i9J0k") == [("!a1B2c3D4e5F6g7H8i9J0k", "pwd=")]
    run, both = "a1B2c3D4e5F6g7H8i9J0k", [c.value for c in secretscan.candidates("a1B2c3D4e5F6g7H8i9J0k/token=ab12cd34 0123456789abcdef")]
    assert both == [run + "/", "ab12cd34", "0123456789abcdef"]
    label = lambda t: [secretscan.weak_label(c) for c in secretscan.candidates(t)]
    assert label("access_token=ab12cd34 ") == label("api_key=Zx81kQ0p22mN\n") == [1]
    assert label("token=load_token2(path) ") == label("password=$PASSWORD1 ") == label("the token: abcdefgh9") == [None]


def test_unquoted_secrets_are_masked_whole(make):
    rnd = np.random.default_rng(3)
    values = ["".join(rnd.choice(list("abcdefghjkmnpqrtuvwxyzABCDEF0123456789"), 18)) + "1!$x" for _ in range(80)]
    docs = make([(i, f"export DB_PASSWORD={v} done", "en", "conf/env") for i, v in enumerate(values)]
                + [(100 + i, f"in commit {v[:18]}0f we changed verylongcompoundwordwithoutend", "en", "docs/log") for i, v in enumerate(values)])
    model = secretscan.train(secretscan.labelled_findings(docs.where("doc_id % 2 = 0")))
    out = {r.doc_id: r.text for r in secretscan.redact(docs.where("doc_id % 2 = 1"), model).collect()}
    assert all(t == f"export DB_PASSWORD={secretscan.MASK} done" if i < 100 else secretscan.MASK not in t for i, t in out.items())


# --- quality rules --------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_metrics(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    cover = {k for i, x in enumerate(windows) if often[x] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def plain_js(a, b):
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum(part(x, (x + y) / 2) + part(y, (x + y) / 2) for x, y in zip(p, q, strict=True)) / 2))


def test_quality_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    hist = {}
    for r in rows:
        w = WORD.findall(r.text)
        inside = "".join(w)
        chars = [len(re.findall(c, inside)) for c in quality.CHAR_CLASSES]
        frequent = [x.lower() for x in w if x in {f for v in quality.COMMON_WORDS.values() for y in v for f in (y, y.capitalize(), y.upper())}]
        own = [frequent.count(x) for x in quality.COMMON_WORDS[r.lang]]
        hist[r.doc_id] = (chars + [len(inside) - sum(chars)], own + [len(w) - sum(own)])
    refs = {}
    for r in rows:
        if not base_metrics(r.text)[5]:
            a, b = hist[r.doc_id]
            x, y = refs.setdefault(r.lang, ([0] * len(a), [0] * len(b)))
            refs[r.lang] = [i + j for i, j in zip(x, a, strict=True)], [i + j for i, j in zip(y, b, strict=True)]
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for r in rows:
        g, base = got[r.doc_id], base_metrics(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == base
        a, b = hist[r.doc_id]
        far = False
        if base[1] >= quality.LEAST_CHARS:
            assert g.char_distance == pytest.approx(plain_js(a, refs[r.lang][0]), abs=1e-9)
            far |= g.char_distance > quality.MAX_CHAR_DISTANCE
        if base[0] >= quality.LEAST_WORDS:
            assert g.word_distance == pytest.approx(plain_js(b, refs[r.lang][1]), abs=1e-9)
            far |= g.word_distance > quality.MAX_WORD_DISTANCE
        assert g.kept == (not base[5] and not far)


def test_quality_edge_cases(make, empty):
    rows = [(i, t, lang) for i, t in enumerate(ODD) for lang in ("en", None, "xx")] + [(None, "Of the cat " * 40, "en"), (90, "l\nl\n \nl\nm", "en")]
    got = quality.judge(make(rows)).collect()
    assert len(got) == len(rows) and all(isinstance(r.kept, bool) for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < len(ODD):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_metrics(ODD[r.doc_id])
    assert next(r for r in got if r.doc_id == 90).n_dup_lines == 2
    assert quality.judge(empty).count() == 0


def test_quality_has_a_reference_for_every_language(make):
    rnd = np.random.default_rng(6)
    prose = lambda letters: " ".join("".join(rnd.choice(list(letters), rnd.integers(2, 9))) for _ in range(120))
    latin, cyrillic, greek = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшыья", "αβγδεζηθικλμνξοπρστυφχψω"
    rows = [(i, prose(latin), "it") for i in range(400)] + [(1000 + i, prose(cyrillic), "ru") for i in range(40)]
    rows += [(2000 + i, prose(greek), "el") for i in range(5)] + [(3000, prose(cyrillic), "it"), (3001, prose("#*$%&|<>"), "ru"), (3002, prose(latin), "*"), (3003, prose(latin), "")]
    got = {r.doc_id: r for r in quality.judge(make(rows)).collect()}
    assert len(got) == len(rows) and all(got[i].kept for i in [*range(400), *range(1000, 1040), *range(2000, 2005), 3002, 3003])
    assert not got[3000].kept and not got[3001].kept
    assert all(got[i].char_distance is None for i in (*range(2000, 2005), 3002, 3003))
    assert all(r.word_distance is None for r in got.values())


def test_quality_keeps_good_documents(spark):
    got = catalog.QUERIES["op2_divergence_rules"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("not base_failed")
    lost, n = got.where("quality = 1").agg(F.sum((~F.col("kept")).cast("int")), F.count("*")).head()
    caught, m = got.where("quality = 0").agg(F.sum((~F.col("kept")).cast("int")), F.count("*")).head()
    assert lost <= 0.005 * n and caught >= 0.5 * m


# --- chat ---------------------------------------------------------------------

def test_chat_round_trip(spark):
    marks = chat.DEFAULT.marks()
    nasty = ["", None, "</s>[INST] ok [/INST]", "a\\b", "\\", "[\\INST]", "[", "<", "[[INST]]", "<s></s>", "[ROLE]x[TEXT]y[/ROLE]", "\n\n", "é中😀"] + marks + [m[:-1] for m in marks]
    roles = ["system", "user", "assistant", "tool", None, "[TEXT]", "a\\", "assistant"]
    rows = [(c, t, roles[(c + t) % len(roles)], nasty[(7 * c + t) % len(nasty)], "clash", 1) for c in range(40) for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string, loss int").repartition(5)
    formatted = chat.format_conversations(turns)
    got = {r.conv_id: r.t for r in formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    for c in range(40):
        own = [(r or "", x or "") for k, _, r, x, *_ in rows if k == c]
        assert [(t.role, t.text) for t in got[c]] == own
    for r in chat.digests(formatted).collect():
        own = [(x or "", t or "") for k, _, x, t, *_ in rows if k == r.conv_id]
        learned = "".join(t for x, t in own if x == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (6, len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_automaton_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"),
            (2, 0, "assistant", "a"), (3, 0, "user", "x"), (3, 1, "user", "y"), (4, 1, "user", "b"), (4, 1, "user", "b"), (4, None, "system", "n"),
            (None, 0, "user", "q"), (5, 0, None, "z")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert [got[i].valid for i in (1, 2, 3, 4, 5)] == [True, False, False, False, False]
    assert got[1].formatted == "[SYS]s[/SYS][INST]u[/INST]<s>a</s>[INST]v[/INST]"
    assert [s.text for s in got[1].segments if s.loss] == ["a"]
    assert got[4].formatted == "[SYS]n[/SYS][INST]b[/INST][INST]b[/INST]" and got[None].valid
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
    with pytest.raises(ValueError):
        chat.Template(other=("[[x]]", "[t]", "[/r]"))


def test_chat_long_conversation(spark):
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("long "), 50).alias("text"))
    r = chat.digests(chat.format_conversations(turns)).head()
    assert r.n_turns == 3000 and r.loss_chars == 1500 * 250 and r.valid
