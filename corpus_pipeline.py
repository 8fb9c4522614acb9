"""The corpus pipeline: quality, near copies, benchmark leaks, source mix, token ids.

Each stage works on all that the one before it kept. All but the last return the columns of ``documents``, whatever else
there is beside doc_id, text and source and whatever its name. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm import op1_quality, op2_mixing, op3_decontamination, op5_token_files, op7_minhash
from reelsift.shared import release, released_after, written

#: A text with so many words inside benchmark windows holds a passage, and goes; fewer are cut out of it.
PASSAGE_WORDS = 16


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with numbers for column names, so that no name of a result clashes with them, and that of its text."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("text")]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the quality classifier, fitted on the rated ones, rejects.

    Rows are judged one by one by their texts; null and empty texts have the features of a text of no words. Without
    rated documents all stay.
    """
    model = op1_quality.train(docs, op1_quality.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows, text = _numbered(docs)
    return op1_quality.score(rows, model, text).where("keep").select(*rows.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of near copies.

    Null texts are a group for each id. Of repeated rows one stays; null ids come last.
    """
    return op7_minhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark passage, and cuts shorter runs of benchmark words out of the others.

    ``n_chars``, where there is one, is counted again where something was cut. Null and empty texts stay as they are, and
    with an empty benchmark all rows do.
    """
    rows, text = _numbered(docs)
    found = op3_decontamination.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text).where(F.col("n_hit") < PASSAGE_WORDS)
    cut = {text: F.col("clean")}
    if "n_chars" in docs.columns:
        n = rows.columns[docs.columns.index("n_chars")]
        cut[n] = F.when(F.col("n_hit") > 0, F.length("clean").cast("long")).otherwise(F.col(n))
    return found.withColumns(cut).select(*rows.columns).toDF(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until each source is near its target.

    Documents without words are taken as no copy. A null source is one of its own.
    """
    return op2_mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns their index, read back from them: a row for each document, repeats too.

    Null and empty texts have the end id alone.
    """
    return op5_token_files.token_index(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_copies), ("benchmark decontamination", benchmark_leaks), ("mixing sources to target weights", source_mix), ("token-ID / binary output", token_files)]

#: SQL can't express the classifier, so the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written as Parquet and read again, and its scratch is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with released_after() as kept:
            out = written(stage(spark, docs, sf_dir), f"stage{i + 1}")
            kept.append(out)
        release(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
