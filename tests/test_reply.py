import pytest
from pyspark.sql import functions as F

from relaydesk.operators.reply import decide_reply, with_offer
from relaydesk.packs.support import SUPPORT

TEXTS = SUPPORT.replies
ROW = (
    "intent string, escalation struct<escalate boolean, stated_reason string, risk_category string>, "
    "resolution string, score double"
)


def _reply(spark, intent, escalate, category, resolution=None, score=None):
    df = spark.createDataFrame([(intent, (escalate, "the reason", category), resolution, score)], ROW)
    return df.select(
        decide_reply(F.col("intent"), F.col("escalation"), F.col("resolution"), F.col("score"), TEXTS).alias("r")
    ).first().r


def test_fixed_texts_come_first(spark):
    safety = _reply(spark, "physical_damage_repair", True, "acute_safety", "res", 0.9)
    assert safety == TEXTS.safety and "safety" in safety.lower() and "stop using" in safety.lower()
    assert _reply(spark, "physical_damage_repair", True, "security_fraud", "res", 0.9) == TEXTS.security
    assert _reply(spark, "physical_damage_repair", True, "hardware_repair", "res", 0.9) == TEXTS.repair


@pytest.mark.parametrize("score, quoted", [(0.41, True), (0.40, False), (None, False)])
def test_escalated_reply_needs_more_than_the_limit(spark, score, quoted):
    got = _reply(spark, "hardware_battery", True, "billing_dispute", "res", score)
    if quoted:
        assert got == f"{TEXTS.apology} res {TEXTS.step_in}"
    else:
        assert got == f"{TEXTS.apology} {TEXTS.specialist % 'the reason'}"


@pytest.mark.parametrize("score, quoted", [(0.35, True), (0.349999, False), (None, False)])
def test_auto_reply_starts_at_the_limit(spark, score, quoted):
    got = _reply(spark, "hardware_battery", False, "safe_self_service", "DM us now", score)
    assert got == ("DM us now" if quoted else TEXTS.templates["hardware_battery"])


def test_unknown_intent_gets_the_default_template(spark):
    assert _reply(spark, "no_such_intent", False, "safe_self_service") == TEXTS.templates[TEXTS.default_intent]


@pytest.mark.parametrize(
    "text, out",
    [
        ("Try this...", "Try this. Still stuck afterwards? DM us and we go on together."),
        ("Try this", "Try this. Still stuck afterwards? DM us and we go on together."),
        ("dm us.", "dm us. Still stuck afterwards? DM us and we go on together."),
        ("Please DM us.", "Please DM us."),
        ("Send a Direct Message.", "Send a Direct Message."),
    ],
)
def test_offer_is_added_unless_invited(spark, text, out):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(with_offer(F.col("t"), TEXTS.offer).alias("x")).first().x == out
