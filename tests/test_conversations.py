import random

from pyspark.sql import functions as F

from relaydesk.operators import conversations as conv


def _threads(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "conv_id long, conversation string")


def test_speaker_lines(spark):
    df = _threads(
        spark,
        [
            "junk before\nCustomer: hello\n  more \nCustomer: again\nSupport: yes\n\n sure\nCustomer: bye",
            "Support: first\nSupport: second\nCustomer: late",
            "Customer: alone",
            "no speaker at all",
            None,
            "  Customer:tight\n\tSupport:  wide  ",
        ],
    )
    customer = conv.speaker_messages(F.col("conversation"), "Customer", "Support")
    support = conv.speaker_messages(F.col("conversation"), "Support", "Customer")
    rows = df.select("conv_id", customer.alias("c"), support.alias("s")).orderBy("conv_id").collect()
    assert [(r.c, r.s) for r in rows] == [
        (["hello more again", "bye"], ["yes  sure"]),
        (["late"], ["first second"]),
        (["alone"], []),
        ([], []),
        (None, None),
        (["tight"], ["wide"]),
    ]
    pairs = {r.conv_id: (r.inquiry, r.resolution) for r in conv.parse_threads(df, "conv_id", "conversation").collect()}
    assert pairs == {0: ("hello more again", "yes  sure"), 1: ("late", "first second"), 5: ("tight", "wide")}


def test_runs_continue_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(conv, "BLOCK_TURNS", 5)
    rng = random.Random(7)
    rows, expected = [], []
    for conv_id in range(6):
        last, run = None, -1
        for turn in sorted(rng.sample(range(100), 40)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.6 or last is None else last
            rows.append((conv_id, turn, role, f"t{turn}"))
            if role != last:
                run += 1
                expected.append([conv_id, run, role, turn, turn, 1, f"t{turn}"])
                last = role
            else:
                expected[-1][4:] = [turn, expected[-1][5] + 1, expected[-1][6] + f" t{turn}"]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conv.speaker_runs(df).select("conv_id", "run", "role", "first_turn", "last_turn", "n_turns", "text")
    assert sorted(map(list, got.collect())) == sorted(expected)


def test_first_message_per_role_whichever_came_first(spark):
    rows = [
        (1, 0, "assistant", "welcome"), (1, 1, "user", "q1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a1"),
        (2, 0, "user", "alone"),
    ]
    runs = conv.speaker_runs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = conv.first_messages(runs, "conv_id", "user", "assistant").collect()
    assert [tuple(r) for r in got] == [(1, "q1 q2", "welcome")]


def test_mining_filters_dedups_and_limits(spark):
    long = "x" * 15
    rows = [
        (5, "same question here", long + " fifth"),
        (2, "@you same  question here", long + " second"),
        (3, "y" * 14, long),
        (4, "y" * 15, long),
        (6, "another question https://a.b", "z" * 14),
        (7, "link question https://a.b", long),
        (8, None, long),
        (9, "@only_mentions", long),
    ]
    pairs = spark.createDataFrame(rows, "conv_id long, inquiry string, resolution string")
    got = {r.conv_id: r.customer_inquiry for r in conv.mine_replies(pairs).collect()}
    assert got == {2: "same question here", 4: "y" * 15, 7: "link question https://a.b"}
    assert [r.conv_id for r in conv.mine_replies(pairs, limit=2).orderBy("conv_id").collect()] == [2, 4]
    assert conv.mine_replies(pairs, limit=None).count() == 3


def test_keep_first_combines_copies_before_the_shuffle(spark):
    copies = spark.range(1000).select(F.col("id"), F.lit("same").alias("text"), (F.col("id") * 2).alias("twice"))
    kept = conv.keep_first(copies, "text", "id")
    assert [tuple(r) for r in kept.collect()] == [(0, "same", 0)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(id" in plan and "Window" not in plan


def test_all_replies_are_mined(spark):
    pairs = spark.range(1700).selectExpr("id AS conv_id", "concat('a question about thing ', id) AS inquiry", "'an answer that is long enough' AS resolution")
    assert conv.mine_replies(pairs).count() == 1700


def test_a_null_role_is_a_role_and_a_null_conversation_is_one(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, "b"), (1, 2, "user", "c"), (1, 3, None, "d"), (1, 4, None, "e"), (None, 0, "user", "x"), (None, 1, "user", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (None, 2):
        out = sorted(((r.conv_id, r.run, r.role, r.text) for r in conv.speaker_runs(turns, block=block).collect()), key=str)
        expected = [(1, 0, "user", "a"), (1, 1, None, "b"), (1, 2, "user", "c"), (1, 3, None, "d e"), (None, 0, "user", "x y")]
        assert out == sorted(expected, key=str)


def test_first_row_of_a_text_whose_order_is_null(spark):
    rows = [(None, "a", 1), (None, "a", 2), (3, "b", 3), (None, "b", 4), (2, "b", 5), (7, None, 6), (6, None, 7)]
    df = spark.createDataFrame(rows, "id long, text string, x long")
    out = sorted(map(tuple, conv.keep_first(df, "text", "id").collect()), key=str)
    assert out == sorted([(None, "a", 1), (2, "b", 5), (6, None, 7)], key=str)


def test_no_sort_of_texts_in_dedup(spark):
    df = spark.createDataFrame([(1, "a", 1)], "id long, text string, x long")
    plan = conv.keep_first(df.where("id is not null"), "text", "id")._jdf.queryExecution().executedPlan().toString()
    assert "functions=[min(id" in plan and "SortAggregate(key=[_digest" not in plan.split("Union")[0]
