"""A training corpus out of raw documents: five stages, each written as Parquet and read again before the next."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillworks.llm import decontamination, mixing, quality_rules, secrets, set_join  # noqa: E402
from tillworks.llm.queries import MIX_OPTIONS, mix_levels, mix_weights  # noqa: E402
from tillworks.session import scratch_path  # noqa: E402
from tillworks.sources.tables import table  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the learned decision list reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of copies and near copies."""
    return set_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that carry benchmark passages."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, plain or encoded; n_chars follows the text."""
    kind = docs.schema["n_chars"].dataType
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with how often each is taken whole and the first tokens of its last time."""
    return mixing.mixture(docs, mix_levels(), mix_weights(), **MIX_OPTIONS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("chosen_path_join", near_duplicates), ("decontamination", decontaminate), ("secret_scans", redact),
    ("source_mix", mix),
]

#: SQL can express neither the learned list nor the decoding of secrets; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each leaves is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
