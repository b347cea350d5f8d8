"""Triage of a table of messages.

``triage`` keeps every input column and appends the result columns. With a
mined reply table of the usual size the whole chain is one stage: clean,
extract, classify, decide, score and reply happen where the row lies.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaydesk.functions.entities import entities
from relaydesk.functions.text import clean
from relaydesk.operators import rules
from relaydesk.operators.logistic import IntentModel
from relaydesk.operators.majority import majority_label
from relaydesk.operators.reply import attach_resolution, decide_reply, nearest_reply, needs_exemplar
from relaydesk.operators.retrieve import ReplyIndex, add_exemplars
from relaydesk.packs.pack import Pack

RESULT_COLUMNS = (
    "customer_text",
    "cleaned_text",
    "entities",
    "intent",
    "intent_confidence",
    "escalation",
    "reply",
    "system_mode",
)
VOCABULARY = {"simple": (3000, False), "proposed": (5000, True)}


@dataclass(frozen=True)
class System:
    """One variant: ``trivial``, ``simple`` or ``proposed``; any other mode acts as proposed.

    An unfitted system has no ``model`` and no ``majority``: the trivial and
    simple variants answer the default label, the proposed one rules alone.
    """

    mode: str
    pack: Pack
    index: ReplyIndex | None = None
    model: IntentModel | None = None
    majority: str | None = None

    @property
    def kind(self) -> str:
        return self.mode if self.mode in ("trivial", "simple") else "proposed"

    @classmethod
    def create(cls, mode: str, pack: Pack, replies: DataFrame | None = None, key: str = "conv_id") -> System:
        """Index the mined replies the way the variant needs them."""
        system = cls(mode, pack)
        if replies is None or system.kind == "trivial":
            return system
        features, sublinear = VOCABULARY[system.kind]
        return replace(system, index=ReplyIndex.build(replies, features, sublinear, key))

    def fit(self, df: DataFrame, text: str, label: str, order: str) -> System:
        """Fit the intent part on labelled messages; an empty table changes nothing."""
        if self.kind == "trivial":
            top = majority_label(df, label, order).first()
            return replace(self, majority=top.label) if top else self
        if df.where(F.col(label).isNotNull()).isEmpty():
            return self
        return replace(self, model=IntentModel.fit(df, text, label))


def add_intent(df: DataFrame, system: System, text: str = "cleaned_text") -> DataFrame:
    """Append ``intent`` and ``intent_confidence``."""
    pack = system.pack
    if system.kind == "trivial":
        return df.withColumns(
            {"intent": F.lit(system.majority or pack.default_label), "intent_confidence": F.lit(0.5)}
        )
    if system.model is not None:
        prior = system.model.probabilities(df, text, pack.labels, "_prior")
    else:
        prior = df.withColumn("_prior", rules.uniform(pack.labels))
    if system.kind == "simple":
        best = rules.best_label(F.col("_prior"), pack.labels)
        label = best if system.model is not None else F.lit(pack.default_label)
        return prior.withColumns({"intent": label, "intent_confidence": F.array_max("_prior")}).drop("_prior")
    scores = rules.rule_scores(F.col(text), pack.labels, pack.intent_rules, pack.rule_weight)
    fused = prior.withColumn("_scores", scores).withColumn(
        "_fused", rules.fuse(F.col("_prior"), F.col("_scores"), pack.rule_boost, pack.temperature)
    )
    return fused.withColumns(
        {"intent": rules.best_label(F.col("_fused"), pack.labels), "intent_confidence": F.array_max("_fused")}
    ).drop("_prior", "_scores", "_fused")


def add_escalation(df: DataFrame, system: System, text: str = "cleaned_text") -> DataFrame:
    """Append the struct ``escalation``."""
    pack = system.pack
    if system.kind == "trivial":
        decision = rules.never_escalate()
    elif system.kind == "simple":
        decision = rules.keyword_policy(F.col(text), pack.keywords)
    else:
        decision = rules.tiered_policy(F.col(text), F.col("intent"), pack.tiers, pack.intent_default, pack.safe_reason)
    return df.withColumn("escalation", decision)


def add_reply(df: DataFrame, system: System, text: str = "cleaned_text", own: str | None = None) -> DataFrame:
    """Append ``reply``. Rows whose branch needs no earlier reply are not scored."""
    texts = system.pack.replies
    if system.kind == "trivial" or (system.kind == "simple" and system.index is None):
        return df.withColumn("reply", F.lit(texts.canned))
    if system.kind == "simple":
        found = add_exemplars(df, text, system.index, 1, own, "_exemplars")
        return nearest_reply(found, system.index, "_exemplars", texts.canned).drop("_exemplars")
    if system.index is None:
        found = df.withColumns({"_score": F.lit(None).cast("double"), "_resolution": F.lit(None).cast("string")})
    else:
        needed = needs_exemplar(F.col("intent"), F.col("escalation"), texts.repair_intent)
        asked = df.withColumn("_asked", F.when(needed, F.col(text)))
        top = F.get(F.col("_exemplars"), F.lit(0))
        found = add_exemplars(asked, "_asked", system.index, 1, own, "_exemplars").withColumn("_score", top["score"])
        found = attach_resolution(found, system.index, top["kb_id"], "_resolution").drop("_asked", "_exemplars")
    reply = decide_reply(F.col("intent"), F.col("escalation"), F.col("_resolution"), F.col("_score"), texts)
    return found.withColumn("reply", reply).drop("_score", "_resolution")


def triage(messages: DataFrame, system: System, text: str = "text", own: str | None = None) -> DataFrame:
    """Append RESULT_COLUMNS to ``messages``. ``own`` names the id of a mined reply a message must not find."""
    prepared = messages.withColumns(
        {
            "customer_text": F.col(text),
            "cleaned_text": clean(F.col(text)),
            "entities": entities(F.col(text), system.pack.devices, system.pack.os_versions),
        }
    )
    decided = add_escalation(add_intent(prepared, system), system)
    return add_reply(decided, system, own=own).withColumn("system_mode", F.lit(system.mode))
