"""The registered queries: every operator on whole driver tables.

Each takes (spark, folder) and returns a DataFrame with plain columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.functions.entities import entities
from relaydesk.functions.overlap import add_overlap_scores
from relaydesk.functions.regex import portable
from relaydesk.functions.text import clean, keep_if, tokens
from relaydesk.operators import agreement as agree
from relaydesk.operators import conversations as conv
from relaydesk.operators import metrics, rubric, rules
from relaydesk.operators.logistic import IntentModel
from relaydesk.operators.majority import predict_majority
from relaydesk.operators.retrieve import ReplyIndex, add_exemplars
from relaydesk.operators.reply import nearest_reply as with_nearest_reply
from relaydesk.operators.saved_index import SavedIndex
from relaydesk.operators.tfidf import TfidfModel, vocabulary
from relaydesk.packs.languages import LANGUAGES, LABELS
from relaydesk.packs.phrases import SUPPORT_PHRASES
from relaydesk.packs.support import SUPPORT
from relaydesk.packs.tables import policy_rule_table
from relaydesk.plans import evaluate
from relaydesk.plans.saved import load_system, save_system
from relaydesk.plans.triage import System, add_escalation, add_intent, triage as run_triage
from relaydesk.session import fresh_dir
from relaydesk.sources import tables as io
from relaydesk.sources.tables import read_table, spread
from relaydesk.streaming.mining import read_mined, write_pieces
from relaydesk.streaming.stream import read_messages, read_triage, write_triage

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(make: Query) -> Query:
    REGISTRY[make.__name__] = make
    return make


# ---------------------------------------------------------------- shared inputs


# bytes of a partition of messages that look for replies; the work of a message grows with the replies
MESSAGE_BYTES = 4 * 1024 * 1024


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return io.deal(read_table(spark, folder, "documents", list(columns)))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as messages that look for replies, which takes far longer than reading them."""
    return io.deal(read_table(spark, folder, "documents", ["doc_id", "text"]), MESSAGE_BYTES)


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of both sides; system prompts are nobody's message."""
    return read_table(spark, folder, "conversations").where(F.col("role") != "system")


def first_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return conv.first_messages(conv.speaker_runs(turns(spark, folder)), "conv_id", "user", "assistant")


def mined(spark: SparkSession, folder: str) -> DataFrame:
    return conv.mine_replies(first_pairs(spark, folder))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that carry labels, with truth columns."""
    marks = read_table(spark, folder, "labels").select(
        "doc_id", (F.col("toxic") == 1).alias("true_escalate"), (F.col("quality") == 1).alias("good"), "quality", "toxic"
    )
    return documents(spark, folder, "doc_id", "text", "lang", "n_chars").join(marks, "doc_id")


def conversation_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled cases mined from conversations.

    Message and gold reply are the first message of either side, the true
    intent is the language of the reply, and a message that needed more than
    two customer messages counts as one to escalate.
    """
    runs = conv.speaker_runs(turns(spark, folder))
    needed = F.count_if(F.col("role") == "user").alias("n_user")
    pairs = conv.first_messages(runs, "conv_id", "user", "assistant", needed)
    scores = rules.rule_scores(F.col("resolution"), LABELS, LANGUAGES.intent_rules, 1.0)
    return pairs.withColumn("_s", scores).select(
        "conv_id",
        F.col("inquiry").alias("customer_tweet"),
        rules.best_label(F.col("_s"), LABELS).alias("true_intent"),
        (F.col("n_user") > 2).alias("true_escalate"),
        F.col("resolution").alias("gold_reference_reply"),
    )


def rounded(value: Column | str, name: str | None = None, places: int = 6) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, places).alias(name or value)


# ---------------------------------------------------------------- sources, filters, cleaning


@query
def filter_project(spark: SparkSession, folder: str) -> DataFrame:
    """One brand's records with three fields; filter and columns reach the scan."""
    df = read_table(spark, folder, "documents").where(F.col("source") == "src1")
    return df.select("doc_id", "lang", "n_chars")


@query
def nonempty_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs that stay after cleaning, by the empty and the minimum-length filter."""
    pairs = first_pairs(spark, folder).select(
        "conv_id",
        clean(F.col("inquiry"), strip_urls=False).alias("a"),
        clean(F.col("resolution"), strip_urls=False).alias("b"),
    )
    kept = pairs.where((F.col("a") != "") & (F.col("b") != "") & (F.length("a") >= 100) & (F.length("b") >= 100))
    return kept.select("conv_id", F.length("a").cast("long").alias("len_a"), F.length("b").cast("long").alias("len_b"))


@query
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and page texts with their URLs in front, cleaned with and without link removal."""
    docs = documents(spark, folder, "doc_id", "text").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    pages = spread(read_table(spark, folder, "pages", ["page_id", "url", "html"])).select(
        F.concat(F.lit("p"), "page_id").alias("id"), F.concat_ws("\n", "url", "html").alias("text")
    )
    both = docs.unionByName(pages)
    return both.select(
        "id",
        F.md5(clean(F.col("text"))).alias("cleaned_md5"),
        F.length(clean(F.col("text"))).cast("long").alias("cleaned_chars"),
        F.md5(clean(F.col("text"), strip_urls=False)).alias("kept_urls_md5"),
    )


@query
def preprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text, cleaned text and the entities of the raw text in one projection."""
    docs = documents(spark, folder, "doc_id", "text")
    out = docs.select(
        "doc_id",
        F.col("text").alias("raw_text"),
        clean(F.col("text")).alias("cleaned_text"),
        entities(F.col("text"), LANGUAGES.devices, LANGUAGES.os_versions).alias("entities"),
    )
    return out.select(
        "doc_id",
        F.md5("raw_text").alias("raw_md5"),
        F.md5("cleaned_text").alias("cleaned_md5"),
        F.concat_ws("|", "entities.devices").alias("devices"),
        "entities.has_os_info",
    )


@query
def word_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Number and content of the word tokens of every document."""
    words = tokens(F.col("text"))
    docs = documents(spark, folder, "doc_id", "text").select("doc_id", words.alias("w"))
    return docs.select(
        "doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("tokens_md5")
    )


@query
def extract_entities(spark: SparkSession, folder: str) -> DataFrame:
    found = entities(F.col("text"), LANGUAGES.devices, LANGUAGES.os_versions)
    return (
        documents(spark, folder, "doc_id", "text")
        .withColumn("e", found)
        .select(
            "doc_id",
            F.concat_ws("|", "e.devices").alias("devices"),
            F.concat_ws("|", "e.os_versions").alias("os_versions"),
            "e.has_device_info",
            "e.has_os_info",
        )
    )


# ---------------------------------------------------------------- conversations


def threads_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Threads derived from documents: a comma hands over to the customer, a full stop to support."""
    handed = F.regexp_replace(F.regexp_replace("text", ", ", "\nCustomer: "), r"\. ", "\nSupport: ")
    return documents(spark, folder, "doc_id", "text").select("doc_id", handed.alias("thread"))


@query
def kb_from_threads(spark: SparkSession, folder: str) -> DataFrame:
    """Replies mined from whole threads; nothing is limited."""
    pairs = conv.parse_threads(threads_of_documents(spark, folder), "doc_id", "thread")
    return conv.mine_replies(pairs, "doc_id", limit=None)


@query
def speaker_parse(spark: SparkSession, folder: str) -> DataFrame:
    """All messages of either side counted, the first of either side cleaned."""
    threads = threads_of_documents(spark, folder)
    customer = conv.speaker_messages(F.col("thread"), "Customer", "Support")
    support = conv.speaker_messages(F.col("thread"), "Support", "Customer")
    both = F.struct(customer.alias("c"), support.alias("s"))
    found = threads.select("doc_id", keep_if(both, lambda r: (F.size(r["c"]) > 0) & (F.size(r["s"]) > 0)))
    return found.select(
        "doc_id",
        F.size("c").cast("long").alias("n_customer"),
        F.size("s").cast("long").alias("n_support"),
        clean(F.get("c", F.lit(0)), strip_urls=False).alias("inquiry"),
        clean(F.get("s", F.lit(0)), strip_urls=False).alias("resolution"),
    )


@query
def speaker_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of long answers and of everything else, so that neighbours do merge."""
    side = F.when((F.col("role") == "assistant") & (F.length("text") >= 1000), "long").otherwise("short")
    derived = read_table(spark, folder, "conversations").withColumn("role", side)
    return conv.speaker_runs(derived).select(
        "conv_id",
        F.col("run").cast("long").alias("run"),
        "role",
        "first_turn",
        "last_turn",
        "n_turns",
        F.md5("text").alias("text_md5"),
    )


@query
def first_turns(spark: SparkSession, folder: str) -> DataFrame:
    return first_pairs(spark, folder)


@query
def kb_build(spark: SparkSession, folder: str) -> DataFrame:
    return mined(spark, folder)


@query
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """First document of every distinct text."""
    docs = read_table(spark, folder, "documents", ["doc_id", "text", "source", "n_chars"])
    return conv.keep_first(docs, "text", "doc_id").select("doc_id", "source", "n_chars")


@query
def limit_after_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The first 50 mined replies by conversation: the limit is the feature."""
    return conv.mine_replies(first_pairs(spark, folder), limit=50)


# ---------------------------------------------------------------- set operations and counts


@query
def union_check(spark: SparkSession, folder: str) -> DataFrame:
    """Per-language parts with a constant label, put together, and checked against the size of an evaluation set."""
    docs = read_table(spark, folder, "documents", ["doc_id", "lang"])
    parts = [docs.where(F.col("lang") == x).select("doc_id", F.lit(x).alias("true_intent")) for x in LABELS]
    return metrics.count_violation(reduce(DataFrame.unionByName, parts), 200).withColumn(
        "expected", F.col("expected").cast("long")
    )


@query
def labelled_union(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "lang"])
    parts = [docs.where(F.col("lang") == x).select("doc_id", F.lit(x).alias("true_intent")) for x in LABELS]
    return reduce(DataFrame.unionByName, parts)


@query
def case_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Intent, escalation and difficulty counts in one pass."""
    n = F.col("n_chars")
    cases = labelled(spark, folder).select(
        F.col("lang").alias("intent"),
        F.col("true_escalate").alias("escalate"),
        F.when(n < 1000, "easy").when(n < 4000, "medium").otherwise("hard").alias("difficulty"),
    )
    return metrics.case_counts(cases, intent=None, escalate=("true", "false"), difficulty=("easy", "medium", "hard", "none"))


# ---------------------------------------------------------------- intent


@query
def majority_class(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", "lang"])
    return predict_majority(docs.select("doc_id"), docs, "lang", "doc_id", LANGUAGES.default_label)


@query
def rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    scores = rules.rule_scores(clean(F.col("text")), LABELS, LANGUAGES.intent_rules, LANGUAGES.rule_weight)
    return docs.select("doc_id", scores.alias("s")).select(
        "doc_id", *[F.col("s")[i].alias(f"score_{x}") for i, x in enumerate(LABELS)]
    )


def _intents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", *columns).withColumn("cleaned_text", clean(F.col("text")))
    return add_intent(docs, System("proposed", LANGUAGES))


@query
def hybrid_intent(spark: SparkSession, folder: str) -> DataFrame:
    return _intents(spark, folder).select("doc_id", "intent", rounded("intent_confidence"))


@query
def support_intent(spark: SparkSession, folder: str) -> DataFrame:
    """Support-desk pack on part names, among which only ``hot`` is a rule word."""
    parts = spread(read_table(spark, folder, "part", ["p_partkey", "p_name"]))
    out = run_triage(parts, System("proposed", SUPPORT), "p_name")
    return out.select("p_partkey", "intent", rounded("intent_confidence"), "escalation.risk_category", "reply")


def support_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Part names with one phrase, or two in every third row."""
    phrases, n = F.array(*map(F.lit, SUPPORT_PHRASES)), len(SUPPORT_PHRASES)
    pick = lambda at: F.get(phrases, (at % n).cast("int"))
    key = F.col("p_partkey")
    second = F.when(key % 3 == 0, F.concat(F.lit(" and "), pick(key * 7 + 3))).otherwise("")
    parts = spread(read_table(spark, folder, "part", ["p_partkey", "p_name"]))
    return parts.select("p_partkey", F.concat("p_name", F.lit(": "), pick(key), second).alias("text"))


@query
def support_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Entities, intent, keyword and tiered decision of the support pack, where every rule has hits."""
    rows = support_messages(spark, folder).withColumns(
        {"cleaned_text": clean(F.col("text")), "entities": entities(F.col("text"), SUPPORT.devices, SUPPORT.os_versions)}
    )
    simple = add_escalation(rows, System("simple", SUPPORT)).withColumnRenamed("escalation", "by_keyword")
    out = add_escalation(add_intent(simple, System("proposed", SUPPORT)), System("proposed", SUPPORT))
    return out.select(
        "p_partkey",
        F.array_join("entities.devices", "|").alias("devices"),
        F.array_join("entities.os_versions", "|").alias("os_versions"),
        "intent",
        rounded("intent_confidence"),
        F.col("by_keyword.escalate").alias("keyword_escalate"),
        F.col("by_keyword.stated_reason").alias("keyword_reason"),
        *[f"escalation.{f}" for f in rules.DECISION_FIELDS],
    )


@query
def support_rule_hits(spark: SparkSession, folder: str) -> DataFrame:
    """How many messages each pattern of the support pack is found in."""
    lowered = F.lower(clean(F.col("text")))
    packs = {
        "tier": [r.pattern for t in SUPPORT.tiers for r in t.rules],
        "keyword": list(SUPPORT.keywords),
        "intent": [p for patterns in SUPPORT.intent_rules.values() for p in patterns],
        "device": list(SUPPORT.devices),
        "os_version": list(SUPPORT.os_versions),
    }
    hits = [
        F.struct(F.lit(kind).alias("kind"), F.lit(i).cast("long").alias("rule"), lowered.rlike(portable(p)).alias("hit"))
        for kind, patterns in packs.items()
        for i, p in enumerate(patterns)
    ]
    # more patterns than this make too large a function for one stage
    parts = [support_messages(spark, folder).select(F.inline(F.array(*hits[i : i + 30]))) for i in range(0, len(hits), 30)]
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy("kind", "rule").agg(F.count_if("hit").alias("n_hits"), F.count_if(~F.col("hit")).alias("n_misses"))


@query
def tfidf_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text")
    return vocabulary(docs, "text", 2500).select(
        "term", F.col("tf").cast("long"), F.col("df").cast("long"), rounded("idf")
    )


@query
def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Every weight of every document: sublinear, unit length."""
    docs = documents(spark, folder, "doc_id", "text")
    model = TfidfModel.fit(docs, "text", 2500, sublinear=True)
    weights = model.transform(docs, "text").select(
        "doc_id", F.inline(F.arrays_zip(F.col("vec.idx").alias("t"), F.col("vec.w").alias("w")))
    )
    return weights.select("doc_id", F.col("t").cast("long").alias("term_position"), rounded("w", "weight"))


@query
def lr_intent(spark: SparkSession, folder: str) -> DataFrame:
    """Regression fitted on raw text, applied to cleaned text."""
    docs = documents(spark, folder, "doc_id", "text", "lang")
    system = System("simple", LANGUAGES).fit(docs, "text", "lang", "doc_id")
    out = add_intent(docs.withColumn("cleaned_text", clean(F.col("text"))), system)
    return out.select("doc_id", "lang", "intent", rounded("intent_confidence", places=4))


@query
def fitted_hybrid_intent(spark: SparkSession, folder: str) -> DataFrame:
    """Rules fused with the fitted regression."""
    docs = documents(spark, folder, "doc_id", "text", "lang")
    system = System("proposed", LANGUAGES).fit(docs, "text", "lang", "doc_id")
    out = add_intent(docs.withColumn("cleaned_text", clean(F.col("text"))), system)
    return out.select("doc_id", "lang", "intent", rounded("intent_confidence", places=4))


@query
def lr_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of every label for every document, by a regression on few terms."""
    docs = documents(spark, folder, "doc_id", "text", "lang").withColumn("cleaned_text", clean(F.col("text")))
    model = IntentModel.fit(docs, "text", "lang", max_features=300)
    # an expression, not a column: for a column a filter would be inferred, in which the scores are made over and over
    pairs = F.transform("p", lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    scored = model.probabilities(docs, "cleaned_text", LABELS, "p").select("doc_id", F.inline(pairs))
    return scored.select("doc_id", F.get(F.array(*map(F.lit, LABELS)), F.col("i")).alias("label"), rounded("p", "prob", 4))


# ---------------------------------------------------------------- escalation


def _flat_escalation(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[f"escalation.{f}" for f in rules.DECISION_FIELDS])


@query
def trivial_escalation(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id")
    return _flat_escalation(docs.withColumn("escalation", rules.never_escalate()), "doc_id")


@query
def keyword_escalation(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text").withColumn("cleaned_text", clean(F.col("text")))
    return _flat_escalation(add_escalation(docs, System("simple", LANGUAGES)), "doc_id")


@query
def tiered_escalation(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_escalation(add_escalation(_intents(spark, folder), System("proposed", LANGUAGES)), "doc_id")


@query
def rule_usage(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents every rule of the policy table decided, unused rules included."""
    decided = add_escalation(_intents(spark, folder), System("proposed", LANGUAGES))
    used = decided.groupBy(F.col("escalation.stated_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    table = policy_rule_table(spark, LANGUAGES)
    return table.join(used, "reason", "left").select(
        F.col("tier").cast("long").alias("tier"),
        F.col("ord").cast("long").alias("ord"),
        "risk_category",
        "reason",
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# ---------------------------------------------------------------- retrieval and reply


@query
def reply_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The index of mined inquiries: raw counts, 3000 terms."""
    index = ReplyIndex.build(mined(spark, folder), 3000, sublinear=False)
    postings = index.vectors.select(
        "kb_id", F.inline(F.arrays_zip(F.col("vec.idx").alias("t"), F.col("vec.w").alias("w")))
    )
    return postings.select("kb_id", F.col("t").cast("long").alias("term_position"), rounded("w", "weight"))


@query
def nearest_reply(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest mined reply of every document, no threshold."""
    docs = messages(spark, folder).withColumn("cleaned_text", clean(F.col("text")))
    index = ReplyIndex.build(mined(spark, folder), 3000, sublinear=False)
    found = add_exemplars(docs, "cleaned_text", index, 1)
    return with_nearest_reply(found, index, "exemplars", LANGUAGES.replies.canned).select("doc_id", "reply")


def _exemplar_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.posexplode("exemplars").alias("i", "e")).select(
        key, (F.col("i") + 1).cast("long").alias("rank"), "e.kb_id", rounded("e.score", "score")
    )


@query
def topk_exemplars(spark: SparkSession, folder: str) -> DataFrame:
    """Three best earlier inquiries of every document."""
    docs = messages(spark, folder).withColumn("cleaned_text", clean(F.col("text")))
    index = ReplyIndex.build(mined(spark, folder))
    return _exemplar_rows(add_exemplars(docs, "cleaned_text", index, 3), "doc_id")


@query
def topk_exemplars_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the term join that serves reply tables too large to hand out."""
    docs = messages(spark, folder).withColumn("cleaned_text", clean(F.col("text")))
    index = ReplyIndex.build(mined(spark, folder), max_broadcast=0)
    return _exemplar_rows(add_exemplars(docs, "cleaned_text", index, 3), "doc_id")


@query
def topk_other_threads(spark: SparkSession, folder: str) -> DataFrame:
    """Three best earlier inquiries of every first message, its own thread left out."""
    pairs = first_pairs(spark, folder).withColumn("cleaned_text", clean(F.col("inquiry")))
    index = ReplyIndex.build(mined(spark, folder))
    return _exemplar_rows(add_exemplars(pairs, "cleaned_text", index, 3, own="conv_id"), "conv_id")


@query
def reply_decision(spark: SparkSession, folder: str) -> DataFrame:
    """Reply of every customer turn; first turns find themselves, so both score limits are passed."""
    user = turns(spark, folder).where(F.col("role") == "user")
    system = System.create("proposed", LANGUAGES, mined(spark, folder))
    out = run_triage(spread(user), system)
    return out.select("conv_id", "turn", "intent", "escalation.escalate", "escalation.risk_category", "reply")


# ---------------------------------------------------------------- triage


def _flat_triage(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        F.md5("cleaned_text").alias("cleaned_md5"),
        F.concat_ws("|", "entities.devices").alias("devices"),
        F.concat_ws("|", "entities.os_versions").alias("os_versions"),
        "intent",
        rounded("intent_confidence"),
        "escalation.escalate",
        "escalation.stated_reason",
        rounded("escalation.confidence", "confidence"),
        "escalation.risk_category",
        "reply",
        "system_mode",
    )


@query
def triage(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: every document through the proposed variant."""
    system = System.create("proposed", LANGUAGES, mined(spark, folder))
    return _flat_triage(run_triage(messages(spark, folder), system))


@query
def triage_simple(spark: SparkSession, folder: str) -> DataFrame:
    system = System.create("simple", LANGUAGES, mined(spark, folder))
    return _flat_triage(run_triage(messages(spark, folder), system))


@query
def triage_trivial(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    system = System.create("trivial", LANGUAGES).fit(docs, "text", "lang", "doc_id")
    return _flat_triage(run_triage(docs, system))


def _streamed(spark: SparkSession, folder: str, system: System) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    out, state = fresh_dir(spark, "triaged"), fresh_dir(spark, "triage-state")
    partitions = io.shares(read_table(spark, folder, "documents", ["doc_id", "text"]), MESSAGE_BYTES)
    heard = read_messages(spark, f"{folder}/documents.parquet*", schema, partitions=partitions)
    write_triage(heard, system, out, state).awaitTermination()
    return _flat_triage(read_triage(spark, out))


@query
def stream_triage(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship as a stream over the documents file; the written rows are read back."""
    return _streamed(spark, folder, System.create("proposed", LANGUAGES, mined(spark, folder)))


@query
def stream_triage_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the plan for reply tables that are too large to be handed to every task."""
    system = System.create("proposed", LANGUAGES, mined(spark, folder))
    return _streamed(spark, folder, replace(system, index=system.index.with_broadcast_limit(0)))


@query
def stream_kb_build(spark: SparkSession, folder: str) -> DataFrame:
    """Replies mined from a stream that sees every conversation in three parts and is started again for each."""
    heard = turns(spark, folder)
    ends = heard.agg(F.min("turn").alias("low"), F.max("turn").alias("high")).first()
    incoming, out, state = (fresh_dir(spark, name) for name in ("turns", "pieces", "mining-state"))
    third = 0 if ends["low"] is None else (ends["high"] - ends["low"]) // 3 + 1
    part = F.lit(0) if third == 0 else F.floor((F.col("turn") - ends["low"]) / third)
    for i in range(3):
        # the last part also takes turns without a number
        chosen = part == i if i < 2 else ~F.coalesce(part < 2, F.lit(False))
        heard.where(chosen).write.parquet(f"{incoming}/part={i}")
        stream = read_messages(spark, f"{incoming}/part=*", heard.schema, files_per_trigger=1_000_000)
        write_pieces(stream, out, state).awaitTermination()
    return read_mined(spark, out)


# ---------------------------------------------------------------- metrics


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_intents(spark, folder, "lang"), "lang", "intent", LABELS)


@query
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.class_report(_intents(spark, folder, "lang"), "lang", "intent", LABELS)
    return report.select("label", rounded("precision"), rounded("recall"), rounded("f1"), "support")


@query
def macro_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.macro_report(_intents(spark, folder, "lang"), "lang", "intent", LABELS)
    return report.select(*[rounded(c) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1")])


@query
def escalation_report(spark: SparkSession, folder: str) -> DataFrame:
    system = System("proposed", LANGUAGES)
    cases = labelled(spark, folder).withColumn("cleaned_text", clean(F.col("text")))
    decided = add_escalation(add_intent(cases, system), system).withColumn("guess", F.col("escalation.escalate"))
    report = metrics.escalation_report(decided, "true_escalate", "guess")
    whole = ("true_positives", "false_positives", "false_negatives", "true_negatives")
    return report.select(*[F.col(c) if c in whole else rounded(c) for c in report.columns])


# ---------------------------------------------------------------- text overlap


def _thinned(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against itself without some function words: real overlap."""
    return documents(spark, folder, "doc_id", "text").withColumn(
        "hyp", F.regexp_replace("text", " (?:the|of|de|la|der|in) ", " ")
    )


@query
def rouge12(spark: SparkSession, folder: str) -> DataFrame:
    out = add_overlap_scores(_thinned(spark, folder), "hyp", "text", ("rouge1", "rouge2"))
    return out.select("doc_id", rounded("rouge1"), rounded("rouge2"))


@query
def bleu4(spark: SparkSession, folder: str) -> DataFrame:
    return add_overlap_scores(_thinned(spark, folder), "hyp", "text", ("bleu4",)).select("doc_id", rounded("bleu4"))


@query
def rouge_l(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn against the next turn of its conversation."""
    said = read_table(spark, folder, "conversations")
    after = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ref"))
    pairs = spread(said.join(after, ["conv_id", "turn"]))
    return add_overlap_scores(pairs, "text", "ref", ("rougeL",)).select("conv_id", "turn", rounded("rougeL"))


@query
def overlap_means(spark: SparkSession, folder: str) -> DataFrame:
    scored = add_overlap_scores(_thinned(spark, folder), "hyp", "text", ("rouge1", "rouge2", "bleu4"))
    return scored.agg(*[rounded(F.avg(m), f"mean_{m}") for m in ("rouge1", "rouge2", "bleu4")])


# ---------------------------------------------------------------- rubric and agreement


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a reply derived from the text: long words dropped, a phrase per language added."""
    lang = F.col("lang")
    phrase = (
        F.when(lang == "en", " Sorry, we understand. DM us for help.")
        .when(lang == "fr", " Go to settings > language and tap it.")
        .when(lang == "de", " Do not charge it, visit us.")
        .otherwise("")
    )
    message = F.when(lang == "de", F.concat(F.lit("Bulging: "), "text")).otherwise(F.col("text"))
    words = F.filter(F.split("text", " "), lambda w: F.length(w) < F.when(lang == "es", 9).otherwise(6))
    return labelled(spark, folder).select(
        "doc_id",
        lang.alias("intent"),
        message.alias("message"),
        F.concat(F.array_join(words, " "), phrase).alias("reply"),
        F.col("text").alias("gold"),
        "true_escalate",
        (~F.col("good")).alias("pred_escalate"),
        (1.0 + 2.5 * F.col("quality") + 1.5 * (1 - F.col("toxic"))).alias("human_rating"),
    )


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return rubric.add_rubric(
        _rated(spark, folder), "message", "reply", "gold", "true_escalate", "pred_escalate", "intent"
    )


@query
def rubric_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("doc_id", *rubric.WEIGHTS, "composite_score", "feedback")


@query
def rubric_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = rubric.rubric_summary(_scored(spark, folder))
    return out.select(
        rounded("mean_composite_score"), rounded("std_composite_score"), *[name for name, _ in rubric.STARS]
    )


def _raters(spark: SparkSession, folder: str) -> DataFrame:
    """Two ratings per order: the priority digit, and a mix of it with the price."""
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return read_table(spark, folder, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"]).select(
        digit.alias("a"),
        F.least(F.floor((digit * 100_000 + F.col("o_totalprice")) / 200_000) + 1, F.lit(5)).cast("int").alias("b"),
        (digit * 0.5 + F.col("o_totalprice") / 200_000).alias("x"),
    )


@query
def weighted_kappa(spark: SparkSession, folder: str) -> DataFrame:
    return agree.weighted_kappa(_raters(spark, folder), F.col("a"), F.col("b")).select(rounded("kappa"))


@query
def correlations(spark: SparkSession, folder: str) -> DataFrame:
    raters = _raters(spark, folder)
    r = agree.pearson(raters, F.col("a"), F.col("x"))
    return r.select(rounded("r", "pearson")).withColumn(
        "spearman", F.round(agree.spearman(raters, F.col("a"), F.col("x")).scalar(), 6)
    )


AGREEMENT = (
    "quadratic_weighted_kappa",
    "pearson_correlation",
    "spearman_correlation",
    "mean_absolute_error_MAE",
    "exact_agreement_rate",
    "within_1_point_agreement_rate",
    "human_mean_score",
    "judge_mean_score",
)


@query
def agreement_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = agree.agreement(_raters(spark, folder), F.col("a"), F.col("x"))
    return out.select("sample_size", *[rounded(c) for c in AGREEMENT])


@query
def p_values(spark: SparkSession, folder: str) -> DataFrame:
    raters = labelled(spark, folder).select(F.col("quality").alias("a"), (F.col("n_chars") / 1000).alias("x"))
    out = agree.agreement(raters, F.col("a"), F.col("x"))
    return out.select("sample_size", rounded("pearson_p_value"), rounded("spearman_p_value"))


@query
def calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Rubric score against a given rating of the same reply."""
    out = evaluate.calibration_study(
        _rated(spark, folder), "message", "reply", "gold", "true_escalate", "pred_escalate", "intent", "human_rating"
    )
    return out.select("sample_size", *[rounded(c) for c in AGREEMENT])


# ---------------------------------------------------------------- evaluation


def _variants(spark: SparkSession, folder: str, fitted: bool) -> list[DataFrame]:
    cases = spread(conversation_cases(spark, folder)).persist()
    fit = evaluate.MODES if fitted else ("trivial",)
    replies = mined(spark, folder).persist()
    return evaluate.benchmark(cases, replies, LANGUAGES, key="conv_id", own="conv_id", fit=fit)


@query
def system_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Headline metrics of the three variants, regression not fitted."""
    table = evaluate.compare_systems(_variants(spark, folder, fitted=False), LABELS)
    return table.select("system", *[rounded(c) for c in evaluate.HEADLINE])


@query
def system_comparison_fitted(spark: SparkSession, folder: str) -> DataFrame:
    table = evaluate.compare_systems(_variants(spark, folder, fitted=True), LABELS)
    return table.select("system", *[rounded(c, places=4) for c in evaluate.HEADLINE])


@query
def system_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """All metrics of the three variants, written per system and read back."""
    scored: Sequence[DataFrame] = _variants(spark, folder, fitted=False)
    path = fresh_dir(spark, "metrics")
    io.write_metrics(evaluate.metric_table(reduce(DataFrame.unionByName, scored), LABELS), path)
    return spark.read.parquet(path).select("system", "metric", "label", rounded("value"))


# ---------------------------------------------------------------- sinks


@query
def kb_json(spark: SparkSession, folder: str) -> DataFrame:
    """Mined replies written as JSON and read back; a path that is missing gives none."""
    path = fresh_dir(spark, "replies")
    io.write_json(mined(spark, folder).withColumnRenamed("conv_id", "conversation_id"), path)
    back = io.read_replies(spark, path).unionByName(io.read_replies(spark, f"{path}-missing"))
    return back.withColumn("conversation_id", F.col("conversation_id").cast("long")).withColumnRenamed("conversation_id", "conv_id")


@query
def cases_json(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents written as JSON and read back."""
    path = fresh_dir(spark, "cases")
    cases = labelled(spark, folder).select(
        F.col("doc_id").alias("id"), F.col("text").alias("customer_tweet"), F.col("lang").alias("true_intent"), "true_escalate"
    )
    io.write_json(cases, path)
    back = io.read_cases(spark, path)
    return back.select(
        F.col("id").cast("long").alias("doc_id"),
        F.md5("customer_tweet").alias("text_md5"),
        F.col("true_intent").alias("lang"),
        "true_escalate",
    )


@query
def cases_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents, line breaks and quotes included, written as CSV and read back."""
    path = fresh_dir(spark, "cases")
    io.write_csv(labelled(spark, folder).select("doc_id", "text", "lang", "true_escalate"), path)
    back = io.read_csv(
        spark,
        path,
        T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("true_escalate", T.BooleanType()),
            ]
        ),
    )
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "true_escalate")


# ---------------------------------------------------------------- saved systems


def _grown(spark: SparkSession, folder: str) -> str:
    """Folder of an index that got the replies of earlier and later conversations one after the other."""
    path = fresh_dir(spark, "index")
    replies = mined(spark, folder)
    middle = replies.agg(F.expr("percentile_approx(conv_id, 0.5)").alias("at")).first()["at"] or 0
    index = SavedIndex(spark, path)
    index.add(replies.where(F.col("conv_id") <= middle))
    index.add(replies.where(F.col("conv_id") > middle))
    return path


@query
def triage_from_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Triage by a system that was saved and loaded, with an index that grew by two segments."""
    path = fresh_dir(spark, "system")
    save_system(spark, System("proposed", LANGUAGES), path, _grown(spark, folder))
    system = load_system(spark, path, LANGUAGES)
    return _flat_triage(run_triage(messages(spark, folder), system))


@query
def saved_index_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The closest replies by an index whose segments were merged."""
    index = SavedIndex(spark, _grown(spark, folder))
    index.merge()
    index.vacuum()
    docs = messages(spark, folder).withColumn("cleaned_text", clean(F.col("text")))
    return _exemplar_rows(add_exemplars(docs, "cleaned_text", index.load(), 3), "doc_id")


@query
def lr_from_saved(spark: SparkSession, folder: str) -> DataFrame:
    """The regression saved with its system and loaded again."""
    path = fresh_dir(spark, "system")
    docs = documents(spark, folder, "doc_id", "text", "lang")
    save_system(spark, System("simple", LANGUAGES).fit(docs, "text", "lang", "doc_id"), path)
    out = add_intent(docs.withColumn("cleaned_text", clean(F.col("text"))), load_system(spark, path, LANGUAGES))
    return out.select("doc_id", "lang", "intent", rounded("intent_confidence", places=4))
