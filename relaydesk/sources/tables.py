"""Readers and writers with fixed schemas."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_INPUT_BYTES = 512 * 1024 * 1024

THREADS = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("conversation", T.StringType()),
    ]
)
REPLIES = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("customer_inquiry", T.StringType()),
        T.StructField("support_resolution", T.StringType()),
    ]
)
CASES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("customer_tweet", T.StringType()),
        T.StructField("true_intent", T.StringType()),
        T.StructField("true_escalate", T.BooleanType()),
        T.StructField("true_escalation_reason", T.StringType()),
        T.StructField("gold_reference_reply", T.StringType()),
        T.StructField("difficulty", T.StringType()),
        T.StructField("human_judge_score", T.IntegerType()),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One parquet table of a folder, pruned to ``columns``."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of a table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Give a small table that sits in few file splits one partition per core.

    Row-local text work on one split would leave the other cores idle. A table
    above SMALL_INPUT_BYTES has splits enough and is left alone: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores == 1 or plan_bytes(df) > SMALL_INPUT_BYTES:
        return df
    return df.repartition(cores)


def shares(df: DataFrame, partition_bytes: int = 16 * 1024 * 1024) -> int:
    """Number of partitions for rows that take long: one per core at least, and so many that none grows with the table."""
    return max(df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df) // partition_bytes + 1)


def deal(df: DataFrame, partition_bytes: int = 16 * 1024 * 1024) -> DataFrame:
    """Spread a table whose rows take long, large ones too: their splits are few, and each would be one long task."""
    return df.repartition(shares(df, partition_bytes))


def gather(df: DataFrame, like: DataFrame, partition_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """One partition per core, or more, for a small table that is read over and over, as iterative fitting does.

    ``like`` is the input by whose size the number is chosen; large tables stay as they are.
    """
    size = plan_bytes(like)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if size > SMALL_INPUT_BYTES else df.repartition(max(cores, size // partition_bytes + 1))


def read_threads(spark: SparkSession, path: str, company: str | None = None) -> DataFrame:
    """Corpus of whole threads; the company filter reaches the parquet scan."""
    df = spark.read.schema(THREADS).parquet(path)
    return df if company is None else df.where(F.col("company") == company)


def read_json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, as :func:`write_json` writes them, or files that hold one JSON array each.

    The first character of a file that isn't blank tells which, so a path may hold
    both forms. Lines are split among tasks, an array is read by one task.
    """
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
        F.regexp_extract("value", r"[^\s\x{FEFF}]", 0).alias("first"),
    )
    files = text.where("first <> ''").groupBy("file").agg((F.min_by("first", "place") == "[").alias("array"))
    forms = files.groupBy("array").agg(F.count("*").alias("n")).collect()
    if len(forms) < 2:
        return spark.read.schema(schema).option("multiLine", any(r.array for r in forms)).json(path)
    # a path is read as a pattern, so its special characters are escaped
    literal = lambda file: re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))
    named = {array: [literal(r.file) for r in files.where(F.col("array") == array).collect()] for array in (True, False)}
    read = [spark.read.schema(schema).option("multiLine", array).json(paths) for array, paths in named.items()]
    return read[0].unionByName(read[1])


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    return read_json_table(spark, path, CASES)


def read_replies(spark: SparkSession, path: str, schema: T.StructType = REPLIES) -> DataFrame:
    """Mined replies; a missing file gives an empty table, on which replies fall back to fixed texts."""
    try:
        return read_json_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, one file per task."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, quotes doubled inside quoted fields, line breaks kept."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metric table (system, metric, label, value), one folder per system."""
    metrics.write.mode("overwrite").partitionBy("system").parquet(path)
