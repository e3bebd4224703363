"""A corpus pipeline of five stages over ``documents``: quality rules, near duplicates, personal data,
mixing of sources, packing. Every stage but the last returns the columns of its input documents.

Cases: a null or empty text fails the quality rules; a stage that gets one all the same keeps it as its operator
says. Ids and sources may be null or repeated, and repeated rows are copies of each other. Texts of any length are
read whole. Empty tables give empty results. Other columns, whatever their names, are handed on as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.llm import hostrules, lshforest, mixing, packing, pii
from tallysheet.llm.tables import read, stored

# A parameter; on a cluster, the place where every executor has the file.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# The columns that stages read; others are put aside under names that no operator uses.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _aside(stage: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
    """``stage`` over ``docs``, which returns their columns, without their other columns in its way."""
    names = {c: c if c in OWN else f"aside_{i}_of_docs" for i, c in enumerate(docs.columns)}
    done = stage(docs.select([docs[_quoted(c)].alias(n) for c, n in names.items()]))
    return done.select([F.col(n).alias(c) for c, n in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the verdict of their host let pass."""
    return _aside(lambda d: hostrules.judge(d).where("kept").select(d.columns), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, one with the least id. Documents without
    words belong to no group and stay."""
    return _aside(lambda d: lshforest.near_duplicates(d).where("is_first").select(d.columns), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""

    def masked(d: DataFrame) -> DataFrame:
        found = pii.find_personal_data(d, with_masked=True)
        changed = {"text": F.col("masked_text"), "n_chars": F.length("masked_text").cast(d.schema["n_chars"].dataType)}
        return found.select([changed[c].alias(c) if c in changed else F.col(c) for c in d.columns])

    return _aside(masked, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return _aside(lambda d: mixing.emit(mixing.mix_sources(d), d.columns), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, with their sequences."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

# MinHash and the packing plan are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
