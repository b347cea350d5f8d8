"""Packs as small tables, for desks that keep their rules in a catalog instead of in code."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from relaydesk.operators.rules import Rule, Tier
from relaydesk.packs.pack import Pack

MAX_RULES = 2000
INTENT_RULES = "label string, label_ord int, pattern string, weight double"
POLICY_RULES = "tier int, ord int, pattern string, reason string, confidence double, risk_category string"
TEMPLATES = "label string, template string"


def intent_rule_table(spark: SparkSession, pack: Pack) -> DataFrame:
    rows = [
        (label, i, pattern, pack.rule_weight)
        for i, label in enumerate(pack.labels)
        for pattern in pack.intent_rules.get(label, ())
    ]
    return spark.createDataFrame(rows, INTENT_RULES)


def policy_rule_table(spark: SparkSession, pack: Pack) -> DataFrame:
    rows = [
        (t, o, rule.pattern, rule.reason, tier.confidence, tier.risk_category)
        for t, tier in enumerate(pack.tiers)
        for o, rule in enumerate(tier.rules)
    ]
    return spark.createDataFrame(rows, POLICY_RULES)


def template_table(spark: SparkSession, pack: Pack) -> DataFrame:
    return spark.createDataFrame(list(pack.replies.templates.items()), TEMPLATES)


def _rows(table: DataFrame, *order: str) -> list:
    """Rules become literal patterns of a plan, so their number is limited and checked."""
    rows = table.orderBy(*order).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"a pack holds at most {MAX_RULES} rules")
    return rows


def pack_from_tables(base: Pack, intent_rules: DataFrame, policy_rules: DataFrame, templates: DataFrame) -> Pack:
    """``base`` with labels, intent rules, tiers and templates taken from tables."""
    rules: dict[str, list[str]] = {}
    weight = base.rule_weight
    for r in _rows(intent_rules, "label_ord", "pattern"):
        rules.setdefault(r.label, []).append(r.pattern)
        weight = r.weight
    tiers: dict[int, list] = {}
    for r in _rows(policy_rules, "tier", "ord"):
        tiers.setdefault(r.tier, []).append(r)
    return replace(
        base,
        labels=tuple(rules),
        rule_weight=weight,
        intent_rules={label: tuple(patterns) for label, patterns in rules.items()},
        tiers=tuple(
            Tier(rs[0].risk_category, rs[0].confidence, tuple(Rule(r.pattern, r.reason) for r in rs))
            for rs in tiers.values()
        ),
        replies=replace(base.replies, templates={r.label: r.template for r in _rows(templates, "label")}),
    )
