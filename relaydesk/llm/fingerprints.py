"""Document fingerprints by consistent weighted sampling.

A text is the multiset of its words. Each sample of a fingerprint draws, for
every word, two gamma variates and a uniform one from a hash of the word and
the number of the sample; they give a quantized weight and a rank, and the word
with the least rank is the sample, together with its quantized weight. Two
texts have equal samples with a probability equal to the generalised Jaccard
similarity of their word counts: the sum of the smaller counts over the sum of
the larger ones.

All of it is built-in functions. Words of a text are counted and ranked where
the text lies, in a shuffle by the key, and a sample is the minimum of one
64-bit number: the rank in the upper half, a hash of word and quantized weight
in the lower.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaydesk.llm.common import written

SAMPLES = 32
WORD_BREAK = r"[\x20\x09-\x0D]+"
RANK_STEPS = float(2**23)
RANK_OFFSET = 128.0


def _uniform(bits: Column, shift: int, width: int) -> Column:
    """Between 0 and 1, both excluded, from some bits of a hash."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + F.lit(0.5)) / F.lit(float(1 << width))


def sample_key(term: Column, log_weight: Column, i: int) -> Column:
    """Rank and identity of a term in sample ``i``; ``term`` is a 64-bit hash."""
    first, second = F.xxhash64(term, F.lit(2 * i)), F.xxhash64(term, F.lit(2 * i + 1))
    r = -F.ln(_uniform(first, 0, 21) * _uniform(first, 21, 21))
    c = -F.ln(_uniform(second, 0, 32) * _uniform(second, 32, 32))
    beta = _uniform(first, 42, 22)
    t = F.floor(log_weight / r + beta)
    rank = F.ln(c) - r * (t - beta) - r
    return F.shiftleft(((rank + RANK_OFFSET) * RANK_STEPS).cast("long"), 32).bitwiseOR(
        F.xxhash64(term, t, F.lit(i)).bitwiseAND(F.lit(0xFFFFFFFF))
    )


def sketches(texts: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """(keys, samples) of every text that has a word, samples as whole numbers of 32 bits.

    If ``texts`` is partitioned by the first key, nothing is shuffled.
    """
    words = F.filter(F.split(F.col(text), WORD_BREAK), lambda w: w != "")
    hashed = texts.select(*keys, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))).alias("_s"))
    # words are counted in their row: equal hashes follow each other
    places = F.sequence(F.lit(0), F.size("_s") - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = hashed.where(F.size("_s") > 0).select(*keys, "_s", starts.alias("_starts"))
    terms = F.transform(
        "_starts",
        lambda at, i: F.struct(
            F.get("_s", at).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.size("_s")) - at).cast("double").alias("n"),
        ),
    )
    counted = runs.select(*keys, F.explode(terms).alias("_t"))
    counted = counted.select(*keys, F.col("_t.term").alias("_term"), F.ln("_t.n").alias("_log"))
    least = [F.min(sample_key(F.col("_term"), F.col("_log"), i)).alias(f"_s{i}") for i in range(samples)]
    found = counted.groupBy(*keys).agg(*least)
    lower = (F.expr(f"cast((_s{i} & 4294967295) - 2147483648 as int)") for i in range(samples))
    return found.select(*keys, F.array(*lower).alias("samples"))


def digest(samples: Column, n: int = SAMPLES) -> Column:
    """The fingerprint as text: eight hexadecimal digits for each sample; empty for a text without words."""
    parts = [F.lpad(F.lower(F.hex(samples[i].cast("long") + 2**31)), 8, "0") for i in range(n)]
    return F.coalesce(F.concat(*parts), F.lit(""))


def likeness(a: Column, b: Column, n: int = SAMPLES) -> Column:
    """Share of equal samples; texts without words are like each other and unlike any other."""
    equal = reduce(lambda x, y: x + y, ((a[i] == b[i]).cast("int") for i in range(n)))
    return F.when(a.isNull() & b.isNull(), 1.0).otherwise(F.coalesce(equal / F.lit(float(n)), F.lit(0.0)))


def following(docs: DataFrame, key: str) -> DataFrame:
    """(key, next_key): the next larger key, and the least after the largest.

    Keys are dealt out by ranges; only the least key of each range meets in one
    task.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select(key).distinct().repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    order = Window.orderBy("_range")
    starts = ranged.groupBy("_range").agg(F.min(key).alias("_least"))
    least = starts.agg(F.min_by("_least", "_range").alias("_first"))
    starts = starts.withColumn("_least", F.lead("_least").over(order)).join(F.broadcast(least)).select(
        "_range", F.coalesce("_least", "_first").alias("_after")
    )
    inside = ranged.withColumn("_next", F.lead(key).over(Window.partitionBy("_range").orderBy(key)))
    return inside.join(F.broadcast(starts), "_range").select(key, F.coalesce("_next", "_after").alias("next_key"))


def edited_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_chars, edited): ``edited`` has the last half of the code points, rounded down,
    replaced by as many of the first ones (or all) of the document with the next key."""
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    rows = rows.where(F.col("_key").isNotNull())
    # of rows with one key the least text stands
    place = F.row_number().over(Window.partitionBy("_key").orderBy("_text"))
    rows = rows.withColumn("_place", place).where("_place = 1").drop("_place")
    sizes = rows.select("_key", F.expr("length(_text) div 2").alias("_half"))
    wanted = following(docs.select(F.col(key).alias("_key")).where("_key is not null"), "_key").join(sizes, "_key")
    wanted = wanted.select(F.col("_key").alias("_for"), F.col("next_key").alias("_key"), "_half")
    heads = wanted.join(rows, "_key").select(
        F.col("_for").alias("_key"),
        F.col("_key").alias("_next"),
        F.substring(F.col("_text"), F.lit(1), F.col("_half").cast("int")).alias("_head"),
    )
    return rows.join(heads, "_key").select(
        F.col("_key").alias(key),
        F.col("_next").alias("next_key"),
        F.col("_text").alias(text),
        F.length("_text").cast("long").alias("n_chars"),
        F.concat(F.expr("substring(_text, 1, length(_text) - length(_text) div 2)"), F.col("_head")).alias("edited"),
    )


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(key, samples, fingerprint) of every text.

    Equal texts have equal fingerprints. A null text is an empty one; texts
    without words have null samples and an empty fingerprint. Rows that share
    a key are one document, that with the least text; rows with a null key and
    columns other than key and text are left out.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("_text"))
    rows = rows.where(F.col(key).isNotNull()).withColumn("_place", place).where("_place = 1")
    found = sketches(rows, [key], "_text", samples)
    return rows.select(key).join(found, key, "left").withColumn("fingerprint", digest(F.col("samples"), samples))


def edit_report(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they and the next text's are.

    Rows as :func:`fingerprint` takes them; an empty table gives none.
    """
    texts = edited_texts(docs, key, text)
    both = texts.select(
        F.col(key),
        F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col(text).alias("t")), F.struct(F.lit(1).alias("v"), F.col("edited").alias("t")))).alias("_x"),
    ).select(key, F.col("_x.v").alias("_version"), F.col("_x.t").alias("_text"))
    found = sketches(both, [key, "_version"], "_text", samples)
    own = found.groupBy(key).agg(
        *(F.max(F.when(F.col("_version") == v, F.col("samples"))).alias(n) for v, n in ((0, "own"), (1, "changed")))
    )
    facts = texts.select(key, "next_key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    rows = written(facts.join(own, key, "left"), "fingerprints")
    after = rows.select(F.col(key).alias("next_key"), F.col("own").alias("after"))
    return rows.join(after, "next_key").select(
        key,
        "n_chars",
        "edited_sha256",
        digest(F.col("own"), samples).alias("fingerprint"),
        digest(F.col("changed"), samples).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("after"), samples).alias("near_next"),
    )
