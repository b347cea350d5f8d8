"""Rule packs as column expressions: intent scores, fusion, argmax and the escalation policy.

A pack is small configuration, so every pattern becomes a literal that a task
compiles once. No operator here shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaydesk.functions.regex import portable
from relaydesk.functions.text import bind

DECISION_FIELDS = ("escalate", "decision_label", "stated_reason", "confidence", "risk_category")

# Decision labels, and confidences and categories of decisions outside the tiers.
ESCALATE, AUTO_HANDLE = "ESCALATE", "AUTO_HANDLE"
TRIVIAL = (0.5, "none")
KEYWORD_HIT = (0.70, "keyword_match")
KEYWORD_MISS = (0.65, "none")
SAFE = (0.91, "safe_self_service")
KEYWORD_REASON = "Simple keyword match triggered: "
MIN_PROBABILITY = 1e-6


@dataclass(frozen=True)
class Rule:
    """One policy rule. Rules are tried in the order in which they are listed."""

    pattern: str
    reason: str


@dataclass(frozen=True)
class Tier:
    """Rules that share a confidence and a risk category."""

    risk_category: str
    confidence: float
    rules: tuple[Rule, ...]


@dataclass(frozen=True)
class IntentDefault:
    """Escalate one intent unless the message is only asking for information."""

    intent: str
    unless: str
    reason: str
    confidence: float
    risk_category: str


def _decision(escalate: bool, reason: Column | str, confidence: float, category: str) -> Column:
    return F.struct(
        F.lit(escalate).alias("escalate"),
        F.lit(ESCALATE if escalate else AUTO_HANDLE).alias("decision_label"),
        (F.lit(reason) if isinstance(reason, str) else reason).alias("stated_reason"),
        F.lit(float(confidence)).alias("confidence"),
        F.lit(category).alias("risk_category"),
    )


# ---------------------------------------------------------------- intent


def rule_scores(
    text: Column, labels: Sequence[str], rules: Mapping[str, Sequence[str]], weight: float
) -> Column:
    """Array in label order: number of matches of the label's patterns, times ``weight``."""
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def score(label: str) -> Column:
        counts = [F.regexp_count(lowered, F.lit(portable(p))) for p in rules.get(label, ())]
        return reduce(lambda a, b: a + b, counts, F.lit(0)).cast("double") * F.lit(weight)

    return F.array(*[score(label) for label in labels])


def uniform(labels: Sequence[str]) -> Column:
    """Distribution of a model that was never fitted."""
    return F.array_repeat(F.lit(1.0 / len(labels)), len(labels))


def fuse(probabilities: Column, scores: Column, boost: float, temperature: float) -> Column:
    """Softmax over labels of (log p + boost * score) / temperature, shifted by its maximum."""
    logits = F.zip_with(
        probabilities,
        scores,
        lambda p, s: (F.log(F.greatest(p, F.lit(MIN_PROBABILITY))) + s * F.lit(boost)) / F.lit(temperature),
    )
    return softmax(logits)


def softmax(logits: Column) -> Column:
    return bind(
        logits,
        lambda x: bind(
            F.transform(x, lambda v: F.exp(v - F.array_max(x))),
            lambda e: bind(
                F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(e, lambda v: v / total)
            ),
        ),
    )


def best_label(probabilities: Column, labels: Sequence[str]) -> Column:
    """Most probable label; on a tie the one listed first."""
    names = F.array(*[F.lit(name) for name in labels])
    position = F.array_position(probabilities, F.array_max(probabilities))
    # never null, and said so: a null filter inferred from a later join would repeat the scoring
    return F.coalesce(F.get(names, (position - 1).cast("int")), F.lit(labels[0]))


# ---------------------------------------------------------------- escalation


def never_escalate() -> Column:
    return _decision(False, "Default of the trivial variant: always auto-handle, text not inspected.", *TRIVIAL)


def keyword_policy(text: Column, keywords: Sequence[str]) -> Column:
    """Escalate on any keyword; the reason lists all that matched, in pack order."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    named = [
        F.when(lowered.rlike(portable(k)), F.lit(k.replace(r"\b", "").replace("(?:ed)?", ""))) for k in keywords
    ]
    hits = F.concat_ws(", ", *named)
    hit = _decision(True, F.concat(F.lit(KEYWORD_REASON), hits, F.lit(".")), *KEYWORD_HIT)
    miss = _decision(False, "No high-risk keyword found; routed to standard handling.", *KEYWORD_MISS)
    return F.when(hits != "", hit).otherwise(miss)


def tiered_policy(
    text: Column,
    intent: Column,
    tiers: Sequence[Tier],
    intent_default: IntentDefault | None,
    otherwise_reason: str,
) -> Column:
    """First matching rule of the first matching tier, then the intent default, then auto-handle."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    arms = [
        F.when(lowered.rlike(portable(r.pattern)), _decision(True, r.reason, t.confidence, t.risk_category))
        for t in tiers
        for r in t.rules
    ]
    if intent_default is not None:
        d = intent_default
        asked = (intent == F.lit(d.intent)) & ~lowered.rlike(portable(d.unless))
        arms.append(F.when(asked, _decision(True, d.reason, d.confidence, d.risk_category)))
    arms.append(_decision(False, otherwise_reason, *SAFE))
    return F.coalesce(*arms)
