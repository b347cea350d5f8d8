"""Replies mined from a stream of turns.

The stream's state is a table of pieces: what a batch knows of each
conversation's first messages, in at most four rows. Pieces are turns again, so
those of two batches are put together as turns are (:func:`first_pieces` of
both), and a batch costs what its own turns cost. A conversation that goes on
in a later batch needs no open task, timer or state store.

Turns of a conversation come in the order of their numbers from batch to batch;
within a batch any order will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from relaydesk.operators.conversations import first_messages, mine_replies, speaker_runs

PIECES = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def first_pieces(turns: DataFrame, customer: str = "user", support: str = "assistant", block: int | None = None) -> DataFrame:
    """(conv_id, turn, role, text): the first run of either role, and what sets it off from later turns.

    ``turns`` are turns, or pieces of several batches. A run before both first
    ones or after them stays as a row without role and text: it ends a run that
    an earlier batch left open, or the last of the two. Runs of a conversation
    meet in an aggregate with partial sums, so a huge one is no huge group.
    A null text counts as empty once its batch is reduced.
    """
    runs = speaker_runs(turns, block=block)
    wanted = F.struct(F.col("first_turn").alias("turn"), "role", "text")

    def first(role: str):
        return F.min_by(wanted, F.when(F.col("role") == role, F.col("first_turn")))

    known = runs.groupBy("conv_id").agg(
        first(customer).alias("inquiry"),
        first(support).alias("resolution"),
        F.min_by(F.struct(F.col("first_turn").alias("turn"), "role"), "first_turn").alias("head"),
        F.max("first_turn").alias("tail"),
    )

    def edge(turn):
        return F.struct(turn.alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))

    foreign = ~F.coalesce(F.col("head.role").isin(customer, support), F.lit(False))
    later = F.greatest("inquiry.turn", "resolution.turn")  # of the two; without the one that is missing
    rows = F.array(
        F.when(foreign, edge(F.col("head.turn"))),
        F.col("inquiry"),
        F.col("resolution"),
        F.when(F.col("tail") > later, edge(F.col("tail"))),
    )
    return known.select("conv_id", F.inline(F.array_compact(rows)))


def write_pieces(
    turns: DataFrame, out: str, checkpoint: str, customer: str = "user", support: str = "assistant", available_now: bool = True
) -> StreamingQuery:
    """Start the stream; the pieces of every batch go to a folder of their own under ``out``.

    A batch that is tried again replaces its folder. A stream started again
    with the same ``checkpoint`` goes on where it stopped.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}

    def reduce(batch: DataFrame, number: int) -> None:
        first_pieces(batch, customer, support).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return turns.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(reduce).start()


def read_pieces(spark: SparkSession, out: str) -> DataFrame:
    """The pieces of all batches that are complete."""
    return spark.read.schema(PIECES).parquet(out).select(*PIECES.names)


def read_pairs(spark: SparkSession, out: str, customer: str = "user", support: str = "assistant") -> DataFrame:
    """(conv_id, inquiry, resolution) as far as the stream has come."""
    return first_messages(speaker_runs(read_pieces(spark, out)), "conv_id", customer, support)


def read_mined(spark: SparkSession, out: str, min_chars: int = 15) -> DataFrame:
    """The reply table as far as the stream has come, unique by inquiry over all batches."""
    return mine_replies(read_pairs(spark, out), min_chars=min_chars)
