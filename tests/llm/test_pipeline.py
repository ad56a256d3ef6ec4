"""The pipeline's stages against their operators, edge cases and the registered queries."""

import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lakeride.llm import catalog, langid, neardup, secretscan

SMALL = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "minhash_dedup", "secret_scan", "packing"]
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_each_stage_acts_on_what_its_predecessor_kept(spark):
    docs = catalog.table(spark, SMALL, "documents").unionByName(spark.createDataFrame(
        [(900001, "12 34 !!", None, "s", 8), (900002, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, SMALL), f"t-{name}")
        assert after.columns == columns
        gone = {r[0] for r in before.join(after, "doc_id", "left_anti").select("doc_id").collect()}
        if name == "language_id":
            assert gone == {900001, 900002}
        if name == "minhash_dedup":
            kept = neardup.near_duplicates(before).where("kept").select("doc_id")
            assert kept.count() == after.count() and not kept.join(after, "doc_id", "left_anti").count()
            assert gone
        if name == "secret_scan":
            assert not gone
            left = secretscan.scan(after, secretscan.train(secretscan.labelled_findings(before)))
            assert left.where("is_secret").count() == 0
            assert after.where(F.length("text") != F.col("n_chars")).count() == 0
        before = after
    packed = corpus_pipeline.pack(spark, before, SMALL)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_repeated_rows_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (None, "x", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1] and out.columns == docs.columns


def test_language_rejects_unknown_scripts_and_random_letters(spark):
    docs = catalog.table(spark, SMALL, "documents")
    rng = np.random.default_rng(4)
    noise = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)) for n in rng.integers(2, 11, 60))
    known = docs.where("lang = 'fr' and n_chars > 500").orderBy("doc_id").head()
    odd = ["这是一个没有拉丁字母的中文文件" * 20, "Это чистый русский текст " * 20, noise]
    rows = [(900000 + 2 * i + k, t, lang, "s", len(t)) for i, t in enumerate(odd) for k, lang in enumerate((None, "en"))]
    more = spark.createDataFrame([*rows, (900100, known.text, None, "s", 1)], docs.schema)
    got = corpus_pipeline.language(spark, docs.unionByName(more), SMALL).select("doc_id", "lang").toPandas()
    assert dict(got[got.doc_id >= 900000].itertuples(index=False, name=None)) == {900100: "fr"}
    assert len(got) == docs.count() + 1


@pytest.mark.parametrize("n_secrets", [0, 1])
@pytest.mark.parametrize("n_clean", [0, 30])
def test_texts_without_credentials_stay_when_there_is_little_to_learn_from(spark, n_clean, n_secrets):
    clean = [f"{'-' * 20} in commit {i:02d}9f3c5b7a1d2e4f60718293a4b5c6d7e8f9a0b1 card 4111111111111111 abcdefghijklmnopqrstuvwxyz" for i in range(n_clean)]
    odd = "see 0a1B2c3D4e5F6g7H8i9J0k there"  # a candidate without a label
    texts = [*clean, odd, *['api_key = "Zx81kQ0p22mN"'] * n_secrets]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.text for r in corpus_pipeline.secrets(spark, docs, SMALL).orderBy("doc_id").collect()]
    assert got == [*clean, odd, *[f'api_key = "{secretscan.MASK}"'] * n_secrets]


def test_stages_carry_columns_of_any_name(spark):
    docs = catalog.table(spark, SMALL, "documents").where("doc_id < 400")
    long = spark.createDataFrame([(900003, "the cat and the dog " * 60_000, "en", "s", 1_200_000)], docs.schema)
    docs = docs.unionByName(long)
    odd = ["score", "lang_pred", "toxic", "grade", "p_toxic", "expected_severity", "none", "__text", "__path", "c0", "row", "kept", "n", "component_id"]
    wide = docs.select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in odd))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"t-plain-{name}")
        wide = corpus_pipeline.materialize(stage(spark, wide, SMALL), f"t-wide-{name}")
        assert wide.columns == [*docs.columns, *odd]
        assert wide.select(docs.columns).exceptAll(docs).count() == 0 and wide.count() == docs.count() > 0
        assert all(r[c] == f"{c}-{r.doc_id}" for r in wide.limit(20).collect() for c in odd)
    pack = lambda d: corpus_pipeline.pack(spark, d, SMALL).select("doc_id", "start", "length", "ids_crc32")
    assert pack(wide).agg(F.sum("length")).head() == pack(docs).agg(F.sum("length")).head()


def test_pipeline_runs_on_an_empty_table(spark):
    docs = catalog.table(spark, SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"t-empty-{name}")
    assert corpus_pipeline.pack(spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if not n.startswith(("op2_", "op3_", "op4_"))])
def test_registered_queries_run(spark, name):
    df = catalog.QUERIES[name](spark, SMALL)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize("name", ["op2_divergence_rules", "op9_chat_format"])
def test_native_queries_run_no_python(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_langid_unknown_constant():
    assert langid.UNKNOWN == "und" and "lakeride.llm" in sys.modules
