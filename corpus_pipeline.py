"""Corpus pipeline: documents through five operators of the llm subpackage, each stage written and read again.

1. quality rules: rows that the base rule or the cascade rejects go;
2. quality classifier: rows that the neighbours' votes put below one half go;
3. n-gram Jaccard join on five-word shingles at 0.8: one document of each group stays;
4. benchmark decontamination: documents that hold a test item go;
5. mixing sources to target weights: a row per epoch that a document is taken in, with `mix_domain` and `mix_epoch`.

SQL cannot state the classifier, so there is no SQL for the whole; the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantmetrics.llm import decontaminate, jaccard_groups, mixing, quality_knn, quality_rules
from plantmetrics.llm.queries import held_out
from plantmetrics.session import scratch_path
from plantmetrics.sources.tables import read_table

NEAR = jaccard_groups.Join(size=5, num=80, den=100)


def pass_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def pass_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Taught on labelled rows of the whole documents table, as its rules have taken most rejected ones from `docs`."""
    labels = read_table(spark, sf_dir, "labels").filter(~held_out("doc_id", 3, 1))
    return quality_knn.keep_good(docs, quality_knn.fit(read_table(spark, sf_dir, "documents"), labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_groups.keep_first(docs, join=NEAR)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality rules", pass_rules),
    ("quality classifier", pass_classifier),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_test_items),
    ("mixing sources to target weights", mix_sources),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier stage is written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
