"""Choice of the reply: canned text, nearest earlier reply, or the decision chain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.operators.retrieve import ReplyIndex

# Score above which an escalated reply, and from which an automatic reply, quotes an earlier one.
ESCALATED_REPLY_ABOVE = 0.40
AUTO_REPLY_FROM = 0.35


@dataclass(frozen=True)
class ReplyTexts:
    """Wording of the replies; ``specialist`` has one ``%s`` for the stated reason."""

    canned: str
    safety: str
    security: str
    repair: str
    apology: str
    step_in: str
    specialist: str
    offer: str
    templates: Mapping[str, str]
    default_intent: str
    repair_intent: str


def attach_resolution(df: DataFrame, index: ReplyIndex, kb_id: Column, out: str) -> DataFrame:
    """Append the resolution text of the reply ``kb_id``; null where there is none."""
    if index.vectors is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    replies = index.vectors.select(F.col("kb_id").alias("_kb"), F.col("resolution").alias(out))
    if index.fits_broadcast:
        replies = F.broadcast(replies)
    return df.withColumn("_want", kb_id).join(replies, F.col("_want") == F.col("_kb"), "left").drop("_want", "_kb")


def nearest_reply(df: DataFrame, index: ReplyIndex, exemplars: str, canned: str, out: str = "reply") -> DataFrame:
    """Reply of the nearest inquiry; the first mined reply if no term is known; canned if none was mined."""
    if index.vectors is None:
        return df.withColumn(out, F.lit(canned))
    first = index.vectors.agg(F.min("kb_id")).scalar()
    nearest = F.coalesce(F.get(F.col(exemplars), F.lit(0))["kb_id"], first)
    return attach_resolution(df, index, nearest, out)


def with_offer(resolution: Column, offer: str) -> Column:
    """Append ``offer`` in place of the final periods unless the text already invites a message."""
    invited = resolution.contains("DM us") | F.lower(resolution).contains("direct message")
    bare = F.regexp_replace(resolution, r"\.+\z", "")
    return F.when(invited, resolution).otherwise(F.concat(bare, F.lit(". " + offer)))


def needs_exemplar(intent: Column, escalation: Column, repair_intent: str) -> Column:
    """Rows whose branch of the decision chain looks at an earlier reply."""
    fixed = escalation["risk_category"].isin("acute_safety", "security_fraud")
    return ~(fixed | (escalation["escalate"] & (intent == repair_intent)))


def decide_reply(intent: Column, escalation: Column, resolution: Column, score: Column, texts: ReplyTexts) -> Column:
    """First branch that applies. ``score`` and ``resolution`` are null without an exemplar."""
    category = escalation["risk_category"]
    escalate = escalation["escalate"]
    label = F.when(intent.isin(*texts.templates), intent).otherwise(F.lit(texts.default_intent))
    template = F.coalesce(
        *[F.when(label == name, F.lit(text)) for name, text in texts.templates.items()]
    )
    return F.coalesce(
        F.when(category == "acute_safety", F.lit(texts.safety)),
        F.when(category == "security_fraud", F.lit(texts.security)),
        F.when(escalate & (intent == texts.repair_intent), F.lit(texts.repair)),
        F.when(
            escalate & (score > ESCALATED_REPLY_ABOVE),
            F.concat(F.lit(texts.apology + " "), resolution, F.lit(" " + texts.step_in)),
        ),
        F.when(
            escalate,
            F.concat(F.lit(texts.apology + " "), F.format_string(texts.specialist, escalation["stated_reason"])),
        ),
        F.when(score >= AUTO_REPLY_FROM, with_offer(resolution, texts.offer)),
        template,
    )
