"""Corpus pipeline: documents to packed training sequences.

Each stage calls one operator of ``tickbook.llm``, works on all rows that the
stage before kept, and returns the columns of documents (the last one: packed
pieces).  ``run`` writes every stage's result to the shared scratch folder and
reads it back, so a lost executor never repeats more than one stage.

Rows are dropped by what the operators decide and by nothing else: a NULL or
empty text has no words and goes with the quality rules; a NULL doc_id is
linked with nothing in the near-duplicate stage; rows that repeat both id and text become one in
the near-duplicate stage, rows that share only the id stay if one of them is
kept; contamination is decided for each row by its own text; an empty table passes as an empty table.  Extra columns pass through
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbook.llm import decontam, dedup, packing, quality, rules
from tickbook.llm import text as T
from tickbook.llm.queries import CAPACITY, table, tokenizer_path


def _carried(docs: DataFrame, *needed: str) -> tuple[DataFrame, list]:
    """``docs`` with all but the needed columns under names that nothing clashes
    with, and the columns that bring the original names and order back."""
    other = {c: f"_carried{i}" for i, c in enumerate(docs.columns) if c not in needed}
    back = [F.col(other.get(c, c)).alias(c) for c in docs.columns]
    return docs.select(*needed, *[F.col(f"`{c}`").alias(n) for c, n in other.items()]), back


def _without(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids`` (column _gone), stored first so
    that the join is planned by its real size."""
    gone = T.stored(ids, label)
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs."""
    rows, back = _carried(docs, "doc_id", "text", "lang")
    return rules.judge(rows, table(spark, sf_dir, "labels")).where("_kept").select(*back)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality score is at least 0.7."""
    rows, back = _carried(docs, "doc_id", "text")
    return quality.classify(rows, table(spark, sf_dir, "labels"), threshold=0.7).where("_predicted = 1").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 0.8-similar five-word shingle sets."""
    decided = dedup.near_duplicates(docs, words=5, percent=80)
    gone = decided.groupBy(F.col("doc_id").alias("_gone")).agg(F.max("kept").alias("_k")).where("NOT _k").select("_gone")
    out = _without(docs, gone, "gone-duplicates")
    again = T.stored(out.groupBy(F.col("doc_id").alias("_gone")).count().where("count > 1 AND _gone IS NOT NULL")
                        .select("_gone"), "repeated-ids")
    if again.isEmpty():
        return out
    mine = F.col("doc_id") == F.col("_gone")
    return out.join(again, mine, "left_anti").union(
        out.join(again, mine, "left_semi").dropDuplicates(["doc_id", "text"]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which less than 5 % of the words lie in benchmark passages of 13 words."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), window=13, percent=5)
    gone = T.stored(found.where("contaminated").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct(),
                    "gone-contaminated")
    # per row: ids may be NULL or repeat with other texts
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), CAPACITY, end_id=0)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# the classifier and the certified cutoffs have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = T.stored(docs, name.replace(" ", "-").lower())
    return docs
