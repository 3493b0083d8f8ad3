"""A corpus pipeline of training-data operators: each stage works on all that the stage before it kept.

Documents have doc_id, text, lang, source and n_chars; columns beside these go through all stages but the last. Null and
empty texts are clean, near duplicates of nothing, without passages, and pack to one end token. Rows without an id are never
rejected. Rows that share an id stand or fall together in the first two stages, and are each cut by their own text in the
next two. An empty table passes every stage as one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontaminate, near_dedup, packing, suffix_dedup, toxicity
from lotwise.llm.common import Staged, read

REJECT_AT = 0.7


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """Documents whose id is not in `gone` (each row of an id that is goes); rows without an id stay."""
    return docs.join(Staged(docs.sparkSession, "pipeline").write(name, gone.distinct()), "doc_id", "left_anti")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under REJECT_AT; labels of the learning folds only."""
    scored = toxicity.toxicity(docs, read(spark, sf_dir, "labels"), toxicity.learned())
    return _without(docs, scored.filter(F.col("score") >= REJECT_AT).select("doc_id"), "toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates (similarity 0.8). Rows that repeat its id stay
    with it."""
    return _without(docs, near_dedup.near_duplicates(docs).filter("not kept").select("doc_id"), "copies")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that stand earlier in the corpus. A text that is one from end to end becomes
    empty; documents are never dropped here."""
    return _counted(suffix_dedup.without_repeats(docs))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what they share with the benchmark's phrases of 10 words, or with a whole shorter item."""
    return _counted(decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their token ids; every row gives its own, an empty text one end token."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: No SQL can tokenise or calibrate votes; tests/llm/test_pipeline.py holds each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again as the next stage's documents."""
    staged = Staged(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = staged.write(name, stage(spark, docs, sf_dir))
        if k:
            staged.drop(STAGES[k - 1][0])
    return docs
