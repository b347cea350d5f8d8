import json
from functools import reduce

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.operators.retrieve import ReplyIndex
from relaydesk.packs.support import LABELS, SUPPORT
from relaydesk.plans import evaluate
from relaydesk.sources import tables as io
from relaydesk.plans.triage import RESULT_COLUMNS, System, triage
from relaydesk.streaming.stream import read_messages, read_triage, write_triage

TRAINING = [
    ("battery draining fast", "hardware_battery"),
    ("ios 11 update stuck", "software_os_update"),
    ("apple id password locked", "account_appleid_icloud"),
    ("wifi greyed out and no sim", "connectivity_network"),
    ("charged twice for apple music", "billing_subscriptions"),
    ("cracked screen glass broken", "physical_damage_repair"),
    ("how do i turn on portrait orientation lock", "general_inquiry_features"),
]
KB = [
    (1, "my battery is draining very fast today", "Look at battery health..."),
    (2, "wifi keeps dropping at home all day", "Reset the network settings. DM us."),
    (3, "charged twice for the same app", "Ask for a refund online."),
]


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TRAINING)], "id long, text string, label string")


@pytest.fixture(scope="module")
def kb(spark):
    return spark.createDataFrame(KB, "conv_id long, customer_inquiry string, support_resolution string")


def test_unfitted_proposed_variant(spark):
    df = spark.createDataFrame([(1, "My iPhone 7 battery health is 75%, how do I replace it?")], "id long, text string")
    out = triage(df, System.create("proposed", SUPPORT))
    row = out.first()
    assert out.columns == ["id", "text", *RESULT_COLUMNS]
    assert row.intent == "hardware_battery" and len(row.reply) > 20
    assert row.customer_text == row.text and row.entities.devices == ["iphone 7"]


@pytest.mark.parametrize("mode", ["trivial", "simple", "proposed", "anything else"])
def test_fitted_variants(spark, training, kb, mode):
    system = System.create(mode, SUPPORT, kb).fit(training, "text", "label", "id")
    df = spark.createDataFrame(
        [(1, "@you my battery is draining in two hours https://t.co/x"), (2, None), (3, "")], "id long, text string"
    )
    rows = {r.id: r for r in triage(df, system).collect()}
    assert rows[1].cleaned_text == "my battery is draining in two hours"
    assert rows[1].system_mode == mode
    assert all(r.intent in LABELS and 0.0 <= r.intent_confidence <= 1.0 for r in rows.values())
    assert rows[1].intent == "hardware_battery"  # first seen label of the trivial variant, too
    if mode == "trivial":
        assert rows[1].intent_confidence == 0.5 and rows[1].reply == SUPPORT.replies.canned
    if mode == "simple":
        assert rows[1].reply == "Look at battery health..." and rows[2].reply == "Look at battery health..."
    if mode in ("proposed", "anything else"):
        assert rows[1].reply == "Look at battery health. Still stuck afterwards? DM us and we go on together."
        assert rows[2].reply == SUPPORT.replies.templates[rows[2].intent]


def test_escalated_reply_quotes_a_close_resolution(spark, kb):
    df = spark.createDataFrame([(1, "charged twice for the same app")], "id long, text string")
    row = triage(df, System.create("proposed", SUPPORT, kb)).first()
    texts = SUPPORT.replies
    assert row.escalation.risk_category == "billing_dispute"
    assert row.reply == f"{texts.apology} Ask for a refund online. {texts.step_in}"
    # leaving out its own thread leaves no close one
    row = triage(df.withColumn("me", F.lit(3).cast("long")), System.create("proposed", SUPPORT, kb), own="me").first()
    assert row.reply == f"{texts.apology} {texts.specialist % row.escalation.stated_reason}"


def test_triage_is_one_stage_over_the_messages(spark, kb):
    system = System.create("proposed", SUPPORT, kb)
    out = triage(spark.range(10).select("id", F.lit("my battery").alias("text")), system)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("limit", [10**9, 0])
def test_stream_equals_batch(spark, kb, tmp_path, limit):
    messages = spark.createDataFrame(
        [(i, f"my battery drains {i}" if i % 2 else "charged twice for the same app") for i in range(20)],
        "id long, text string",
    )
    messages.repartition(4).write.parquet(str(tmp_path / "in"))
    system = System("proposed", SUPPORT, ReplyIndex.build(kb, max_broadcast=limit))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    stream = read_messages(spark, str(tmp_path / "in"), schema, files_per_trigger=2)
    write_triage(stream, system, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got, expected = read_triage(spark, str(tmp_path / "out")), triage(messages, system)
    assert got.columns == expected.columns and got.count() == 20
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_metric_table_and_comparison(spark, kb):
    rows = [
        (1, "my battery is draining very fast today", "hardware_battery", False, "Look at battery health please"),
        (2, "smoke from the battery", "hardware_battery", True, "Your safety comes first"),
        (3, "wifi keeps dropping at home", "connectivity_network", True, "Reset it"),
        (4, "shattered glass", "physical_damage_repair", False, ""),
    ]
    cases = spark.createDataFrame(
        rows,
        "id long, customer_tweet string, true_intent string, true_escalate boolean, gold_reference_reply string",
    )
    scored = [
        evaluate.scored_predictions(cases, System.create(m, SUPPORT, kb), m) for m in ("trivial", "simple", "proposed")
    ]
    table = {
        (r.system, r.metric, r.label): r.value
        for r in evaluate.metric_table(scored[0].unionByName(scored[1]).unionByName(scored[2]), LABELS).collect()
    }
    assert table["proposed", "intent_accuracy", ""] == 1.0
    assert table["proposed", "macro_f1", ""] == pytest.approx(3 / 7)
    assert table["proposed", "class_support", "hardware_battery"] == 2.0
    assert [table["proposed", m, ""] for m in ("true_positives", "false_positives", "false_negatives", "true_negatives")] == [1, 1, 1, 1]
    assert table["trivial", "false_auto_handle_rate_FAHR", ""] == 1.0
    rows = scored[2].collect()
    assert table["proposed", "mean_rougeL", ""] == pytest.approx(sum(r.rougeL for r in rows) / 4)
    mean = sum(r.composite_score for r in rows) / 4
    assert table["proposed", "std_composite_score", ""] == pytest.approx(
        (sum((r.composite_score - mean) ** 2 for r in rows) / 4) ** 0.5
    )
    assert sum(table["proposed", s, ""] for s in ("5_stars", "4_stars", "3_stars", "2_stars", "1_star")) == 4
    head = {r.system: r for r in evaluate.compare_systems(scored, LABELS).collect()}
    assert set(head) == {"trivial", "simple", "proposed"}
    assert head["proposed"].mean_composite_score == pytest.approx(mean)


def test_benchmark_from_files_to_metrics(spark, kb, tmp_path):
    rows = [
        {
            "id": f"C-{i}", "customer_tweet": text, "true_intent": label, "true_escalate": label == "physical_damage_repair",
            "true_escalation_reason": "", "gold_reference_reply": "DM us for help", "difficulty": "easy", "human_judge_score": 5,
        }
        for i, (text, label) in enumerate(TRAINING)
    ]
    (tmp_path / "cases.json").write_text(json.dumps(rows))
    cases = io.read_cases(spark, str(tmp_path / "cases.json"))
    scored = evaluate.benchmark(cases, kb, SUPPORT)
    table = evaluate.metric_table(reduce(lambda a, b: a.unionByName(b), scored), LABELS)
    io.write_metrics(table, str(tmp_path / "metrics"))
    back = spark.read.parquet(str(tmp_path / "metrics")).where("metric = 'intent_accuracy'")
    # fitted and scored on the same seven cases, as the published run does
    assert {r.system: r.value for r in back.collect()} == {
        "trivial": pytest.approx(1 / 7), "simple": 1.0, "proposed": pytest.approx(1.0),
    }


def test_calibration_study(spark):
    rows = [
        ("battery bulging", "Please stop using it. DM us for safety help.", "Stop using it. DM us.", True, True, "x", 5.0),
        ("battery bulging", "Keep your charger in.", "Stop using it. DM us.", True, False, "x", 1.0),
        ("how to reset", "Go to settings > reset and tap erase, glad to help.", "Go to settings and reset", False, False, "x", 4.0),
    ]
    rated = spark.createDataFrame(rows, "m string, r string, g string, t boolean, p boolean, i string, h double")
    got = evaluate.calibration_study(rated, "m", "r", "g", "t", "p", "i", "h").first()
    assert got.sample_size == 3 and got.pearson_correlation > 0.8 and 0 <= got.pearson_p_value <= 1
