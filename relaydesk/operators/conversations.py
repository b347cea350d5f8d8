"""Speaker lines, speaker runs, first message per role and the mined reply table.

A conversation may be one text with ``Customer:`` / ``Support:`` lines, which is
parsed inside its row, or one row per turn. Turn tables are cut into blocks of
consecutive turns, so that one huge conversation is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaydesk.functions.regex import SPACE
from relaydesk.functions.text import clean, keep_if

BLOCK_TURNS = 4096
_GAP = r"[ \t\r\x0B\f\x1C-\x1F\x{85}\p{Z}]*"


# ---------------------------------------------------------------- one text per conversation


def speaker_messages(text: Column, speaker: str, other: str) -> Column:
    """Messages of one speaker in order: a run of lines up to the other speaker, joined by a space.

    Lines before the first speaker belong to nobody. A line may repeat the
    speaker's mark; the mark is not part of the message.
    """
    run = rf"(?dms)^{_GAP}{speaker}:.*?(?=^{_GAP}{other}:|\z)"
    edge = rf"^{SPACE}+|{SPACE}+\z"

    def message(block: Column) -> Column:
        lines = F.split(F.regexp_replace(block, r"\n\z", ""), "\n", -1)
        bare = F.transform(lines, lambda line: F.regexp_replace(line, edge, ""))
        unmarked = F.transform(bare, lambda line: F.regexp_replace(line, rf"^{speaker}:{SPACE}*", ""))
        return F.array_join(unmarked, " ")

    stripped = F.regexp_replace(text, rf"(?d)^{SPACE}+|{SPACE}+\z", "")
    return F.transform(F.regexp_extract_all(stripped, F.lit(run), F.lit(0)), message)


def parse_threads(threads: DataFrame, conv: str, text: str) -> DataFrame:
    """(conv, inquiry, resolution) of threads that hold both speakers; row-local."""
    first = F.struct(
        F.get(speaker_messages(F.col(text), "Customer", "Support"), F.lit(0)).alias("inquiry"),
        F.get(speaker_messages(F.col(text), "Support", "Customer"), F.lit(0)).alias("resolution"),
    )
    return threads.select(conv, keep_if(first, lambda r: r["inquiry"].isNotNull() & r["resolution"].isNotNull()))


# ---------------------------------------------------------------- one row per turn


def speaker_runs(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int | None = None,
) -> DataFrame:
    """(conv, run, role, first_turn, last_turn, n_turns, text): consecutive turns of one role, merged.

    ``turn`` is unique within a conversation. Runs are found inside blocks of
    BLOCK_TURNS turn numbers; where turns are time stamps, ``block`` should
    span some thousand of them. Only one summary row per block is needed to
    continue the numbering across block edges, and a run is merged inside its
    blocks before its pieces meet.
    """
    cut = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
        F.floor(F.col(turn) / (block or BLOCK_TURNS)).alias("block"),
    )
    in_block = Window.partitionBy("conv", "block").orderBy("turn")
    # a null role is a role of its own
    changes = (F.row_number().over(in_block) > 1) & ~F.lag("role").over(in_block).eqNullSafe(F.col("role"))
    marked = cut.withColumn("changes", changes.cast("int")).withColumn(
        "local_run",
        F.sum("changes").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    pieces = (
        marked.groupBy("conv", "block", "local_run")
        .agg(
            F.first("role").alias("role"),
            F.min("turn").alias("first_turn"),
            F.max("turn").alias("last_turn"),
            F.count(F.lit(1)).alias("n_turns"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), " "
            ).alias("text"),
        )
    )
    summary = pieces.groupBy("conv", "block").agg(
        F.min_by("role", "local_run").alias("head"),
        F.max_by("role", "local_run").alias("tail"),
        F.max("local_run").alias("changes"),
    )
    over_blocks = Window.partitionBy("conv").orderBy("block")
    starts = (F.row_number().over(over_blocks) > 1) & ~F.lag("tail").over(over_blocks).eqNullSafe(F.col("head"))
    offsets = summary.withColumn("starts", starts.cast("int")).select(
        F.col("conv").alias("_conv"),
        F.col("block").alias("_block"),
        (
            F.sum(F.col("starts") + F.col("changes")).over(
                over_blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            - F.col("changes")
        ).alias("offset"),
    )
    return (
        pieces.join(offsets, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block")))
        .groupBy("conv", (F.col("offset") + F.col("local_run")).alias("run"))
        .agg(
            F.first("role").alias("role"),
            F.min("first_turn").alias("first_turn"),
            F.max("last_turn").alias("last_turn"),
            F.sum("n_turns").alias("n_turns"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("first_turn", "text"))), lambda t: t["text"]), " "
            ).alias("text"),
        )
        .withColumnRenamed("conv", conv)
    )


def first_messages(runs: DataFrame, conv: str, customer: str, support: str, *more: Column) -> DataFrame:
    """(conv, inquiry, resolution, more..): first merged message of either role, whichever came first.

    ``more`` are further aggregates of the runs of a conversation.
    """
    one = runs.groupBy(conv).agg(
        F.min_by("text", F.when(F.col("role") == customer, F.col("first_turn"))).alias("inquiry"),
        F.min_by("text", F.when(F.col("role") == support, F.col("first_turn"))).alias("resolution"),
        *more,
    )
    return one.where(F.col("inquiry").isNotNull() & F.col("resolution").isNotNull())


# ---------------------------------------------------------------- mined replies


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """For every distinct text ``key`` the row that comes first by the unique column ``order``.

    Texts are told apart by their SHA-256, and the least ``order`` of each is a
    hash aggregate of two short columns: a text that makes up a third of the
    rows costs one row per task. The rows are then fetched by both columns, of
    which no pair is frequent. Rows without a text count as copies of each
    other, and a null ``order`` comes after all others.
    """
    keyed = df.withColumn("_digest", F.coalesce(F.unhex(F.sha2(F.col(key), 256)), F.lit(b"")))
    ordered = keyed.where(F.col(order).isNotNull())
    # two short columns in a hash aggregate; no text is sorted
    least = ordered.groupBy("_digest").agg(F.min(order).alias("_least"))
    first = ordered.join(
        least.withColumnRenamed("_digest", "_of"), (F.col("_digest") == F.col("_of")) & (F.col(order) == F.col("_least"))
    )
    # texts of which no row has an order: these rows alone are compared whole
    unordered = keyed.where(F.col(order).isNull()).join(least, "_digest", "left_anti")
    some = unordered.groupBy("_digest").agg(F.min(F.struct(*df.columns)).alias("_first")).select("_first.*")
    return first.select(*df.columns).unionByName(some)


def mine_replies(
    pairs: DataFrame, conv: str = "conv_id", min_chars: int = 15, limit: int | None = None
) -> DataFrame:
    """(conv, customer_inquiry, support_resolution): cleaned, long enough, unique by inquiry.

    All of them, or the first ``limit`` by ``conv`` where one is asked for.
    """
    # a length of at least 1 also leaves out empty texts
    shortest = max(min_chars, 1)
    cleaned = F.struct(
        clean(F.col("inquiry"), strip_urls=False).alias("customer_inquiry"),
        clean(F.col("resolution"), strip_urls=False).alias("support_resolution"),
    )
    kept = pairs.select(
        conv,
        keep_if(
            cleaned,
            lambda r: (F.length(r["customer_inquiry"]) >= shortest) & (F.length(r["support_resolution"]) >= shortest),
        ),
    )
    unique = keep_first(kept, "customer_inquiry", conv)
    return unique if limit is None else unique.orderBy(conv).limit(limit)
