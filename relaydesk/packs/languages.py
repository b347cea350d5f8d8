"""Pack that routes text by language; written for the tables of invented prose.

Intents are languages, told apart by common function words. The policy looks
for personal data, secrets and license lines.
"""

from __future__ import annotations

from relaydesk.operators.reply import ReplyTexts
from relaydesk.operators.rules import IntentDefault, Rule, Tier
from relaydesk.packs.pack import Pack

LABELS = ("en", "fr", "de", "es")
LEXICONS = {
    "en": ("the", "of", "and", "to", "is", "that", "it", "for", "was", "with"),
    "fr": ("le", "les", "et", "des", "du", "une", "pour", "est", "dans", "sur"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "ist"),
    "es": ("el", "y", "los", "se", "del", "las", "por", "con", "su", "una"),
}
MAIL = r"[a-z0-9_]\.example\.com"
ADDRESS = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
SECRET = r'(?:token|secret|password|api_key) = "'
PHONE = r"\+?[0-9]{1,3}[ -]\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}"
LICENSE = r"licensed under"
RELEASED = r"released under"
SHOUTING = r"!! .*!!"
REFUSAL = r"\b(?:nicht|avec)\b"

LANGUAGES = Pack(
    labels=LABELS,
    default_label="en",
    intent_rules={label: (r"\b(?:" + "|".join(words) + r")\b",) for label, words in LEXICONS.items()},
    keywords=(r"\blicense\b", r"\btoken\b", r"\bthe\b", r"\bnicht\b", r"\bpour\b", r"\bpara\b"),
    tiers=(
        Tier("acute_safety", 0.98, (Rule(SECRET, "A secret is written out in the text."),)),
        Tier("security_fraud", 0.95, (
            Rule(MAIL, "A mail host is written out in the text."),
            Rule(PHONE, "A phone number is written out in the text."),
        )),
        Tier("hardware_failure", 0.93, (Rule(ADDRESS, "A network address is written out in the text."),)),
        Tier("billing_dispute", 0.92, (
            Rule(LICENSE, "The text names the license it is under."),
            Rule(RELEASED, "The text names the license it was released under."),
        )),
        Tier("customer_frustration", 0.88, (
            Rule(SHOUTING, "The text shouts."),
            Rule(REFUSAL, "The text holds a word on the watch list."),
        )),
    ),
    intent_default=IntentDefault(
        intent="es",
        unless=r"\b(?:para|pero)\b",
        reason="Spanish text: goes to the Spanish desk.",
        confidence=0.85,
        risk_category="language_desk",
    ),
    safe_reason="Nothing in the text needs a person.",
    devices=(r"\b(?:gnu|apache|mit) +(?:general|license)\b", ADDRESS, r"\b[0-9]{4}-[0-9]{4}\b"),
    os_versions=(r"version +([0-9]+(?:\.[0-9]+)*)",),
    replies=ReplyTexts(
        canned="We can help. Please DM us which language you write in.",
        safety="For your safety we hide this text. Please press reset and visit our help page.",
        security="We take care of your data. Please restart the check and DM us.",
        repair="The Spanish desk will answer. Sorry for the wait.",
        apology="We understand.",
        step_in="Please DM us the text number.",
        specialist="A person has to read this (%s), please DM us the text number.",
        offer="Not clear yet? DM us the line number.",
        templates={
            "en": "We are glad to help in English. Go to settings > language, or DM us.",
            "fr": "We are glad to help in French. Go to settings > language.",
            "de": "We can help in German. Tap the flag.",
        },
        default_intent="en",
        repair_intent="es",
    ),
)
