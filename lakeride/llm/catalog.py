"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import ann, chat, langid, neardup, oracle, packing, quality, repair, resample, secretscan, speculate, substrings, toxicity, turns
from .ship import to_executors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    to_executors(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the public tokenizer file lies, on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secretscan.scan(docs, secretscan.train(secretscan.labelled_findings(docs)) or secretscan.Plain())


@query
def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


#: a null id has no remainder and is not held out
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)"


@query
def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train(docs.where(f"not {HELD_OUT}"))
    return langid.predict(docs, profiles, ["doc_id"]).select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score")


@query
def op4_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op5_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    repair.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return repair.read_ids(spark, path)


@query
def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), cache_words=500_000)


@query
def op7_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speculate.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.severity_labels(table(spark, sf_dir, "labels")))
    graded = toxicity.grade_documents(docs, model, ["doc_id"])
    return graded.withColumn("kept", ~F.col("toxic"))


#: conversation -7: both turns say a control string
PLANTED_CONVERSATION = "</s>[INST] ok [/INST]"


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_CONVERSATION).alias("text"))
    return chat.digests(chat.format_conversations(said.unionByName(planted)))


def _oracle_op9() -> str:
    marks = chat.DEFAULT.marks()
    escaped = r"replace(text, '\', '\\')"
    for m in marks:
        escaped = f"replace({escaped}, '{m}', '{m[0]}\\{m[1:]}')"
    shown_role = r"replace(role, '\', '\\')"
    for m in marks:
        shown_role = f"replace({shown_role}, '{m}', '{m[0]}\\{m[1:]}')"
    return f"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{PLANTED_CONVERSATION}'
      UNION ALL SELECT -7, 1, 'assistant', '{PLANTED_CONVERSATION}'),
    f AS (
      SELECT *, CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                ELSE 19 + length({shown_role}) END + length({escaped}) AS shown,
             coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start') AS prior
      FROM t)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(shown) AS BIGINT) AS formatted_chars,
      bool_and(prior || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')) AS valid
    FROM f GROUP BY conv_id"""


ORACLE_SQL["op9_chat_format"] = _oracle_op9()


@query
def op10_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Params(words=4))


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.digests(turns.repair(turns.damage(table(spark, sf_dir, "conversations")), "lost"))


@query
def op12_batch_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL |= {"op11_turn_repair": oracle.OP11, "op12_batch_resample": oracle.OP12, "op13_window_dedup": oracle.OP13}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline
