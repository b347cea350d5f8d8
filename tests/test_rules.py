import math

import pytest
from pyspark.sql import functions as F

from relaydesk.operators import rules
from relaydesk.operators.majority import majority_label, predict_majority
from relaydesk.packs.support import LABELS, SUPPORT
from relaydesk.plans.triage import System, add_escalation, add_intent


def _decide(spark, text, intent="software_os_update"):
    df = spark.createDataFrame([(text, intent)], "cleaned_text string, intent string")
    return add_escalation(df, System("proposed", SUPPORT)).first().escalation


@pytest.mark.parametrize(
    "text, category, confidence",
    [
        ("my battery is bulging and pushing the screen off", "acute_safety", 0.98),
        ("smoke from the plug", "acute_safety", 0.98),
        ("someone in russia logged into my apple id and changed my password", "security_fraud", 0.95),
        ("shattered screen with glass falling out", "hardware_failure", 0.93),
        ("I was charged twice this month", "billing_dispute", 0.92),
        ("this is unacceptable", "customer_frustration", 0.88),
        ("how do I get rid of the padlock icon on screen", "safe_self_service", 0.91),
        # two tiers match: the one tried first wins, security before hardware
        ("hacked and shattered, unacceptable", "security_fraud", 0.95),
        ("charged twice and front glass gone", "hardware_failure", 0.93),
        ("", "safe_self_service", 0.91),
        (None, "safe_self_service", 0.91),
    ],
)
def test_tiers(spark, text, category, confidence):
    got = _decide(spark, text)
    assert (got.risk_category, got.confidence, got.escalate) == (category, confidence, category != "safe_self_service")


def test_first_rule_of_a_tier_gives_the_reason(spark):
    safety = SUPPORT.tiers[0].rules
    assert _decide(spark, "swollen battery and smoke").stated_reason == safety[0].reason
    assert _decide(spark, "smoke").stated_reason == safety[1].reason
    assert "safety" in _decide(spark, "swollen battery").stated_reason.lower()


def test_intent_default_spares_questions(spark):
    repair = "physical_damage_repair"
    assert _decide(spark, "the button is loose", repair).risk_category == "hardware_repair"
    assert _decide(spark, "how much for the button", repair).risk_category == "safe_self_service"
    assert _decide(spark, "the button is loose").risk_category == "safe_self_service"


def test_keyword_policy_lists_all_hits_in_pack_order(spark):
    df = spark.createDataFrame([("water and hacked, broken",), ("fine",), (None,)], "cleaned_text string")
    got = [r.escalation for r in add_escalation(df, System("simple", SUPPORT)).collect()]
    assert got[0].stated_reason == "Simple keyword match triggered: broken, hack, water."
    assert [(g.escalate, g.confidence, g.risk_category) for g in got] == [
        (True, 0.70, "keyword_match"),
        (False, 0.65, "none"),
        (False, 0.65, "none"),
    ]


def test_trivial_never_escalates(spark):
    got = spark.range(1).select(rules.never_escalate().alias("e")).first().e
    assert (got.escalate, got.decision_label, got.confidence, got.risk_category) == (False, "AUTO_HANDLE", 0.5, "none")


def test_rule_scores_count_every_match(spark):
    df = spark.createDataFrame([("Hot hot battery, refund $5 $6",)], "t string")
    scores = df.select(rules.rule_scores(F.col("t"), LABELS, SUPPORT.intent_rules, 1.5).alias("s")).first().s
    by_label = dict(zip(LABELS, scores))
    assert by_label["hardware_battery"] == 4.5
    assert by_label["billing_subscriptions"] == 4.5
    assert by_label["software_os_update"] == 0.0


def test_fusion_is_a_tempered_softmax(spark):
    p, s = [0.7, 0.3, 0.0], [0.0, 1.5, 0.0]
    df = spark.createDataFrame([(p, s)], "p array<double>, s array<double>")
    got = df.select(rules.fuse(F.col("p"), F.col("s"), 1.2, 0.85).alias("f")).first().f
    logits = [(math.log(max(a, 1e-6)) + 1.2 * b) / 0.85 for a, b in zip(p, s)]
    total = sum(math.exp(x) for x in logits)
    assert got == pytest.approx([math.exp(x) / total for x in logits])
    assert sum(got) == pytest.approx(1.0)


def test_ties_go_to_the_first_label_and_no_hit_is_uniform(spark):
    df = spark.createDataFrame([("nothing to see",), ("my battery is draining in two hours",)], "cleaned_text string")
    got = add_intent(df, System("proposed", SUPPORT)).collect()
    assert got[0].intent == LABELS[0]
    assert got[0].intent_confidence == pytest.approx(1 / 7)
    assert got[1].intent == "hardware_battery"
    assert 0 <= got[1].intent_confidence <= 1


def test_unfitted_simple_variant_answers_the_default(spark):
    df = spark.createDataFrame([("battery",)], "cleaned_text string")
    got = add_intent(df, System("simple", SUPPORT)).first()
    assert (got.intent, got.intent_confidence) == ("general_inquiry_features", pytest.approx(1 / 7))


def test_majority_tie_goes_to_first_seen(spark):
    cases = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, None)], "id long, label string")
    assert majority_label(cases, "label", "id").first().label == "b"
    out = predict_majority(cases.select("id"), cases, "label", "id", "zzz")
    assert {(r.intent, r.intent_confidence) for r in out.collect()} == {("b", 0.5)}
    none = predict_majority(cases.select("id"), cases.limit(0), "label", "id", "zzz")
    assert {r.intent for r in none.collect()} == {"zzz"}
