import re

from pyspark.sql import functions as F

from relaydesk.functions.entities import entities, first_matches
from relaydesk.functions.regex import portable
from relaydesk.functions.text import clean, ngrams, tokens, weighted_terms
from relaydesk.packs.support import DEVICES, INTENT_RULES, OS_VERSIONS

MESSAGES = [
    None,
    "",
    "   ",
    "@someone",
    "http://a.b/c",
    "@Éric hello",
    "hi there\t you\n\nall ok\x1cdone",
    "line one\nline two @x https://t.co/abc end",
    "a@b.c and _x_ 2½ ünïcode 4G",
    "My iPhone 7 Plus on iOS 11.0.2! and an iPad Pro with macOS High",
    "battery batteries hot-hot éhot hot. searching... now",
    "charged me $59.99 and $3 for apple  music",
]


def _one(spark, rows, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, t string")
    return [r[1] for r in sorted(df.select("id", column.alias("x")).collect())]


def _plain_clean(text, urls=True):
    text = re.sub(r"@\w+", "", text or "")
    if urls:
        text = re.sub(r"https?://\S+", "", text)
    return re.sub(r"\s+", " ", text).strip()


def test_clean_follows_unicode_classes(spark):
    assert _one(spark, MESSAGES, clean(F.col("t"))) == [_plain_clean(t) for t in MESSAGES]
    assert _one(spark, MESSAGES, clean(F.col("t"), strip_urls=False)) == [_plain_clean(t, False) for t in MESSAGES]


def test_tokens_of_any_script(spark):
    assert _one(spark, MESSAGES, tokens(F.col("t"))) == [re.findall(r"\b\w+\b", (t or "").lower()) for t in MESSAGES]
    expected = [re.findall(r"\b\w{4,}\b", (t or "").lower()) for t in MESSAGES]
    assert _one(spark, MESSAGES, tokens(F.col("t"), 4)) == expected


def test_ngrams(spark):
    texts = ["a b c d", "a", ""]
    assert _one(spark, texts, ngrams(tokens(F.col("t")), 2)) == [["a b", "b c", "c d"], [], []]
    assert _one(spark, texts, ngrams(tokens(F.col("t")), 4)) == [["a b c d"], [], []]


def test_bigrams_join_words_left_after_the_length_filter(spark):
    assert _one(spark, ["go x home now"], weighted_terms(F.col("t"))) == [["go", "home", "now", "go home", "home now"]]


def test_portable_patterns_match_like_unicode_regexes(spark):
    patterns = [p for group in INTENT_RULES.values() for p in group] + [*DEVICES, *OS_VERSIONS, r"\b(?:hot|4g)\b"]
    for p in patterns:
        counts = _one(spark, MESSAGES, F.regexp_count(F.lower(F.coalesce("t", F.lit(""))), F.lit(portable(p))))
        assert counts == [len(re.findall(p, (t or "").lower())) for t in MESSAGES], p


def test_entities_take_the_first_match_of_each_pattern(spark):
    df = spark.createDataFrame([("@a my iPhone 7 has problems on iOS 11.0.2! and iPhone 8 http://t.co/x",)], "t string")
    e = df.select(entities(F.col("t"), DEVICES, OS_VERSIONS).alias("e")).first().e
    assert (e.devices, e.os_versions, e.has_device_info, e.has_os_info) == (["iphone 7"], ["ios 11.0.2"], True, True)
    none = df.select(entities(F.lit(None).cast("string"), DEVICES, OS_VERSIONS).alias("e")).first().e
    assert (none.devices, none.has_device_info, none.has_os_info) == ([], False, False)


def test_entities_are_distinct_and_sorted(spark):
    assert _one(spark, ["b a b"], first_matches(F.col("t"), (r"b", r"a", r"b *"))) == [["a", "b"]]
