"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec.llm import bpe, jaccard, perplexity, phrases, templates
from quillvec.llm.queries import PATTERN, RANKS, table
from quillvec.llm.tables import Scratch
from quillvec.plans.shipping import ship_package

#: Near duplicates: shingles of five words, and a similarity of 80 percent.
SHINGLE, PERCENT = 5, 80


def packed(docs: DataFrame) -> DataFrame:
    """The columns an operator reads, and all but the text as one more, whose names can't clash with its own."""
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    return docs.select("doc_id", "text", *[c for c in ("lang",) if c in docs.columns], rest.alias("original"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    own = {"text": F.col("text"), **changed}
    return df.select(*[own.get(c, F.col("original")[c]).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and lie within the perplexity bands of their language."""
    ship_package(spark)
    judged = perplexity.quality_rules(packed(docs), carry=("text", "original"))
    return unpacked(judged.filter("kept"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id; rows that share an id stay together.

    Rows without an id stay: no member of their group can be told from them."""
    ship_package(spark)
    groups = jaccard.similar_documents(docs, SHINGLE, PERCENT)
    surplus = groups.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(surplus, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; ``n_chars`` follows the text."""
    ship_package(spark)
    cut = phrases.removed_passages(packed(docs), carry=("original",))
    return unpacked(cut, docs.columns, n_chars=F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no question of the benchmark."""
    ship_package(spark)
    return templates.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens`` of each document."""
    ship_package(spark)
    encoded = bpe.encode(docs, RANKS, PATTERN, ("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: The language model and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is a table that the next one reads."""
    ship_package(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
