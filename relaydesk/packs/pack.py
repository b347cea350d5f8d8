"""A pack holds the labels, patterns and texts that one desk works with."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from relaydesk.operators.reply import ReplyTexts
from relaydesk.operators.rules import IntentDefault, Tier


@dataclass(frozen=True)
class Pack:
    labels: tuple[str, ...]
    default_label: str
    intent_rules: Mapping[str, tuple[str, ...]]
    keywords: tuple[str, ...]
    tiers: tuple[Tier, ...]
    intent_default: IntentDefault | None
    safe_reason: str
    devices: tuple[str, ...]
    os_versions: tuple[str, ...]
    replies: ReplyTexts
    rule_weight: float = 1.5
    rule_boost: float = 1.2
    temperature: float = 0.85
