"""The corpus pipeline: stages that take and return documents, each written before the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.llm import bpe, linededup, ngramjoin, packing, quality, toxicity
from quillwork.llm.arrow import free_name
from quillwork.llm.queries import VOCABULARY, table
from quillwork.session import Scratch, settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject, whatever else their rows hold.

    Verdicts come back by id and a hash of the text, since ids may be null or repeated.
    """
    keyed = docs.select(F.struct("*").alias("row"), *row_key(docs))
    verdicts = quality.judge(
        docs.select(F.struct(*row_key(docs)).alias("doc_id"), "text", "lang", "source"))
    rejected = verdicts.filter("not kept").select("doc_id.*").distinct()
    return keyed.join(rejected, ["key_a", "key_b"], "left_anti").select("row.*")


def row_key(docs: DataFrame) -> list[Column]:
    """128 bits that stand for a whole row: rows that agree in all columns get one verdict."""
    columns = [F.col(c).cast("string") for c in docs.columns]
    whole = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]))
    return [F.xxhash64(F.lit(seed), whole).alias(name) for seed, name in enumerate(("key_a", "key_b"))]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are scored toxic by a model of the labelled documents still here."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs.select(F.struct("*").alias("row"), F.col("text").alias("t")),
                                  model, "t", "score")
    return scored.filter(F.col("score") < toxicity.CUT).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that ten documents or more have; ``n_chars`` follows the text."""
    cut = linededup.dedup_lines(docs, into=free_name(docs, "_lines")).drop(free_name(docs, "_lines"))
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def ordered_name(docs: DataFrame) -> Column:
    """A text that tells rows apart and sorts them by id, null ids last."""
    shifted = F.col("doc_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    number = F.coalesce(F.lpad(shifted.cast("string"), 20, "0"), F.lit("null"))
    return F.concat_ws("-", number, *[F.hex(key) for key in row_key(docs)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies, by id, null ids last.

    Documents without a word are in no group and stay.  Of rows that agree in all columns one stays.
    """
    named = docs.select(F.struct("*").alias("row"), ordered_name(docs).alias("name"))
    groups = settle(ngramjoin.ngram_groups(named.select("name", "row.text"), "name")).select(
        F.col("doc_id").alias("name"), F.col("component_id").alias("first"), "n_shingles")
    shared = groups.filter("n_shingles > 0").groupBy("first").agg(
        F.count("*").alias("members"),
        F.sum(F.expr("cast(name = first as int)")).alias("copies")).filter("members > 1")
    gone = groups.join(shared, "first").filter("name <> first").select("name").distinct()
    repeated = settle(shared.filter("copies > 1").select(F.col("first").alias("name")))
    left = named.join(gone, "name", "left_anti")
    if not repeated.isEmpty():
        one_each = left.join(repeated, "name", "left_semi").dropDuplicates(["name"])
        left = left.join(repeated, "name", "left_anti").unionByName(one_each)
    return left.select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what is left into pieces of power-of-two length, with their token ids, to be trained on."""
    return packing.pack(docs, bpe.read_vocabulary(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack),
]

# A trained model and links that reach on through groups cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the written rows of the one before.

    A stage's rows are deleted when the next one's are written; the last stage reads the last ones.
    """
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = scratch.settle(docs, "docs")
    return docs
