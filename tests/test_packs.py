import pytest

from relaydesk.plans.queries import REGISTRY
from relaydesk.packs import tables
from relaydesk.packs.languages import LANGUAGES
from relaydesk.packs.support import SUPPORT
from relaydesk.plans.triage import System, triage

MESSAGES = [
    (1, "swollen battery, charged twice"),
    (2, "my password was hacked"),
    (3, "how do i turn this off"),
    (4, "screen repair, how much"),
    (5, "der Akku und die Lampe"),
]


@pytest.mark.parametrize("pack", [SUPPORT, LANGUAGES])
def test_pack_read_from_tables_gives_the_same_results(spark, pack):
    made = tables.pack_from_tables(
        pack,
        tables.intent_rule_table(spark, pack),
        tables.policy_rule_table(spark, pack),
        tables.template_table(spark, pack),
    )
    assert made.labels == pack.labels and made.tiers == pack.tiers
    df = spark.createDataFrame(MESSAGES, "id long, text string")
    columns = ["id", "intent", "intent_confidence", "escalation", "reply"]
    results = [sorted(map(tuple, triage(df, System("proposed", p)).select(*columns).collect())) for p in (pack, made)]
    assert results[0] == results[1]


def test_number_of_rules_is_checked(spark, monkeypatch):
    monkeypatch.setattr(tables, "MAX_RULES", 3)
    with pytest.raises(ValueError):
        tables.pack_from_tables(
            SUPPORT,
            tables.intent_rule_table(spark, SUPPORT),
            tables.policy_rule_table(spark, SUPPORT),
            tables.template_table(spark, SUPPORT),
        )


def test_every_support_rule_has_hits_and_misses(spark):
    out = REGISTRY["support_rule_hits"](spark, "/root/testdata/sf0.001").toPandas()
    kinds = {"tier": sum(len(t.rules) for t in SUPPORT.tiers), "keyword": len(SUPPORT.keywords), "device": len(SUPPORT.devices)}
    for kind, n in kinds.items():
        assert (out.kind == kind).sum() == n
    missed = out[(out.n_hits == 0) | (out.n_misses == 0)]
    assert missed.empty, missed.to_string()
