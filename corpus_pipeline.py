"""A training corpus from `documents`, in stages; each reads what the one before it wrote."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tidemark  # noqa: E402
from tidemark.llm import decontaminate, jaccard, langid, line_dedup, mixing  # noqa: E402
from tidemark.llm.common import free_name, word_count  # noqa: E402
from tidemark.llm.queries import table  # noqa: E402
from tidemark.session import materialise, use_trial_root  # noqa: E402

cloudpickle.register_pickle_by_value(tidemark)
# For trial runs on one machine; a cluster names the folder for intermediate tables itself.
use_trial_root("/tmp/checkpoints")

# Below this confidence, and without a letter, a document's language counts as not known.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled documents teach; others go."""
    model = langid.learn(docs)
    found = free_name(docs, "language")
    judged = langid.identify(docs, model, out=found)
    return judged.where((F.col(f"{found}.lang") != langid.UNKNOWN) & (F.col(f"{found}.score") >= MIN_LANGUAGE_SCORE)).drop(found)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occurred before; one of which nothing is left goes."""
    kept, removed = "kept_text", "removed_words"
    rows = line_dedup.dedup_lines(docs, out=kept).where((F.col(removed) == 0) | (F.col(kept) != ""))
    changed = F.when(F.col(removed) > 0, F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.withColumn("n_chars", changed).withColumn("text", F.col(kept)).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are similar directly or through others, the first."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in benchmark windows."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document that is left."""
    sizes = docs.select("doc_id", "lang", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(sizes).select("doc_id", "lang", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language ID", known_language),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

# Language ID is learned, so SQL cannot express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between them the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
