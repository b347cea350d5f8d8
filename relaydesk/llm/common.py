"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaydesk.session import fresh_dir

SALTS = 16
# rows of a key from which on they are dealt to SALTS tasks, where rows were counted
CROWDED = 10_000
# a write's shuffle files go when it is done; else they stay until the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# a written table with at most so many narrow rows is broadcast, after counting them
BROADCAST_ROWS = 400_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe against lost executors."""
    path, conf = fresh_dir(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return read_written(df.sparkSession, df.schema, path)


def read_written(spark: SparkSession, schema, path: str) -> DataFrame:
    out = spark.read.schema(schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made; nothing that is still to be computed may read them."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def held_out(key: Column) -> Column:
    """True for the fifth of the rows from which no label is learned; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """At most ``rows`` documents of each label (0 and 1) as (key, text, label), none of them held out.

    Rows are taken in order of a hash of the key. A key that is labelled both 0
    and 1 gives a row for each of the two; a repeated row of ``docs`` is taken
    with the first, beyond ``rows``. Only these keys, whose number
    ``rows`` bounds, are broadcast to the documents, so no text is shuffled.
    """
    known = labels.select(F.col(key), F.col(label).cast("int").alias("_label")).where(
        F.col(key).isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col(key))
    )
    taken = [
        known.where(F.col("_label") == value).orderBy(F.xxhash64(key), key).limit(rows).dropDuplicates([key])
        for value in (0, 1)
    ]
    chosen = F.broadcast(taken[0].unionByName(taken[1]))
    return docs.select(key, F.col(text).alias("_text")).join(chosen, key).where(F.col("_text").isNotNull())


def shuffled(dim: DataFrame) -> DataFrame:
    """``dim`` as the side of a join that Spark must not broadcast.

    Spark takes a table for as large as its compressed files and does not count what an explode repeats, so it may
    send many times its limit through the driver.
    """
    return dim.hint("merge")


def salted(rows: DataFrame, dim: DataFrame, key: str, spread: Column, how: str = "left") -> DataFrame:
    """Join ``rows`` with ``dim`` (one row for each ``key``) when one key may hold a large part of ``rows``.

    ``spread`` deals the rows of a key to SALTS tasks; ``dim`` is repeated that often.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(shuffled(right), [key, "_salt"], how).drop("_salt")


def meet(rows: DataFrame, dim: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """As :func:`salted`, for a narrow ``dim`` that is written: by broadcast if it has few rows."""
    if dim.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(dim), key, how)
    return salted(rows, dim, key, spread, how)


def paired(rows: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """As :func:`meet`, where no key of ``rows`` holds a large part of them, so nothing is repeated."""
    return rows.join(F.broadcast(dim) if dim.count() <= BROADCAST_ROWS else shuffled(dim), key, how)


def meet_counted(rows: DataFrame, dim: DataFrame, key: str, spread: Column, times: str) -> DataFrame:
    """Inner join as :func:`meet`, where ``dim`` has the number of rows of its key in ``times``, which is left out.

    Only keys with more than CROWDED rows are dealt to SALTS tasks, so ``dim`` is hardly repeated.
    """
    if dim.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(dim.drop(times)), key)
    crowded = F.col(times) > CROWDED
    # at most a CROWDED-th of the rows
    hot = dim.where(crowded).select(key, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_hot")
    last = F.when(crowded, F.lit(SALTS - 1)).otherwise(F.lit(0))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop(times)
    return left.join(shuffled(right), [key, "_salt"]).drop("_salt")


# bits of a filter that is broadcast, whatever the size of the table; a fuller filter lets more rows pass
FILTER_BITS = 1 << 26


def bit_filter(keys: DataFrame, key: str) -> np.ndarray:
    """64-bit words with a bit for each ``key`` (a hash, as a long), for :func:`may_hold`."""
    bit = F.col(key).bitwiseAND(FILTER_BITS - 1)
    words = keys.groupBy(F.shiftright(bit, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST({key} & 63 AS INT))")).alias("word")
    )
    found = words.toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return out.view(np.uint64)


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that are surely not in the filter."""
    bit = keys.view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def spread_join(rows: DataFrame, dim: DataFrame, key: str, spread: Column, per_task: int = 1000) -> DataFrame:
    """Inner join of narrow ``rows`` (a written table) with a wide ``dim``, one row for each ``key``.

    Few rows are broadcast, so that ``dim`` stays where it is. Else a row of
    ``dim`` is repeated only where its key has more than ``per_task`` rows;
    these keys, at most a ``per_task``-th of the rows, are broadcast.
    """
    if rows.count() <= BROADCAST_ROWS:
        return dim.join(F.broadcast(rows), key)
    parts = rows.groupBy(key).agg(F.ceil(F.count("*") / per_task).cast("int").alias("_parts"))
    parts = F.broadcast(written(parts.where("_parts > 1"), "parts"))
    part = F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int"), F.lit(0))
    left = rows.join(parts, key, "left").withColumn("_part", part)
    last = F.coalesce(F.col("_parts") - 1, F.lit(0))
    right = dim.join(parts, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
    # either side may seem small
    return left.drop("_parts").join(shuffled(right.drop("_parts")), [key, "_part"]).drop("_part")


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """A value kept as long as the Python worker lives, so later tasks of the worker find it made."""
    store = sys.modules.setdefault("_relaydesk_worker", types.ModuleType("_relaydesk_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]
