"""Corpus pipeline: language, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeride.llm import langid, neardup, packing, secretscan, toxicity
from lakeride.llm.catalog import table, vocabulary
from lakeride.llm.ship import to_executors
from lakeride.session import materialize


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ... and the number of each name: extra columns may have any
    name, those of an operator's results and helpers too."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))), {c: f"c{i}" for i, c in enumerate(docs.columns)}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; a null lang becomes the predicted one, a given one stays.

    Recognisable: the score of the nearest profile is above 0 and reaches that language's floor, so
    texts in a script without a profile and random letters go."""
    to_executors(spark)
    rows, c = numbered(docs)
    profiles = langid.train(rows, c["text"], c["lang"])
    # predicted once: the floors and the verdict read the same scores
    named = materialize(langid.predict(rows, profiles, rows.columns, c["text"]), "pipeline-scores")
    floors = langid.floors_of(named, c["lang"])
    least = F.create_map(*(F.lit(x) for item in sorted(floors.items()) for x in item)) if floors else F.lit(None).cast("map<string,double>")
    far = (F.col("score") <= 0) | (F.col("score") < F.coalesce(F.try_element_at(least, F.col("lang_pred")), F.lit(0.0)))
    kept = named.where((F.col("lang_pred") != langid.UNKNOWN) & ~far).withColumn(c["lang"], F.coalesce(c["lang"], "lang_pred"))
    return kept.select(rows.columns).toDF(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least as likely toxic as not go."""
    rows, c = numbered(docs)
    model = toxicity.train(rows, toxicity.severity_labels(table(spark, sf_dir, "labels")).withColumnRenamed("doc_id", c["doc_id"]), c["doc_id"], c["text"])
    graded = toxicity.grade_documents(rows, model, rows.columns, c["text"])
    return graded.where(~F.col("toxic")).select(rows.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays; of rows that repeat an id, that
    with the smallest text. Rows without an id stay."""
    to_executors(spark)
    found = materialize(neardup.near_duplicates(docs), "pipeline-groups")
    by_id = found.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = materialize(by_id.where("not kept").select("doc_id"), "pipeline-gone")
    again = materialize(by_id.where("kept and n > 1").select("doc_id"), "pipeline-repeated")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = (left.join(again, "doc_id", "left_semi").groupBy("doc_id")
           .agg(F.min(F.struct(F.struct(F.col("text").isNull().alias("none")), F.struct("text", *rest))).alias("row")).select("doc_id", "row.col2.*"))
    return left.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are masked in the texts; n_chars follows. No document goes.

    Where the corpus has too few findings to learn from, only plain assignments to credential names are masked."""
    to_executors(spark)
    rows, c = numbered(docs)
    found = secretscan.labelled_findings(rows, c["text"], c["source"])
    clean = secretscan.redact(rows, secretscan.train(found) or secretscan.Plain(), c["text"], c["source"])
    return clean.withColumn(c["n_chars"], F.length(c["text"]).cast("long")).select(rows.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    to_executors(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language_id", language), ("toxicity", toxic), ("minhash_dedup", near_duplicates), ("secret_scan", secrets), ("packing", pack)]

#: the models and token ids of the stages cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
