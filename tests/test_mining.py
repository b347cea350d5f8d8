"""Mining from a stream: pieces of batches against runs over all turns."""

import random

import pytest
from compare import differences, sql_session

import __spark_entry__ as contract
from relaydesk.operators import conversations as conv
from relaydesk.streaming import mining
from relaydesk.streaming.stream import read_messages

SCHEMA = "conv_id long, turn long, role string, text string"


def _turns(seed: int, conversations: int = 150) -> list[list[tuple]]:
    """Turns in four batches; every conversation is cut at places of its own."""
    draw = random.Random(seed)
    batches = [[], [], [], []]
    for c in range(conversations):
        n, at = draw.randrange(1, 12), 0
        cuts = sorted(draw.randrange(n + 1) for _ in range(3))
        for i in range(n):
            at += draw.choice([1, 1, 3, 40])
            role = draw.choice(["user", "user", "assistant", "assistant", "tool", None])
            batches[sum(i >= cut for cut in cuts)].append((c if c else None, at, role, f"c{c} t{at}"))
    return batches


def _first(rows: list[tuple]) -> dict:
    """First message of either role, turn by turn."""
    open_role, first, out = {}, {}, {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        if c not in open_role or open_role[c] != role:
            open_role[c] = role
            if (c, role) in first:
                first[c, role].append(None)  # closed
            else:
                first[c, role] = []
        if None not in first[c, role]:
            first[c, role].append(text)
    for c in open_role:
        if (c, "user") in first and (c, "assistant") in first:
            out[c] = tuple(" ".join(t for t in first[c, r] if t is not None) for r in ("user", "assistant"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_of_batches_are_those_of_all_turns(spark, monkeypatch, seed):
    monkeypatch.setattr(conv, "BLOCK_TURNS", 7)
    batches = _turns(seed)
    pieces = [mining.first_pieces(spark.createDataFrame(b, SCHEMA)).collect() for b in batches]
    expected = _first([r for b in batches for r in b])

    def pairs(rows):
        runs = conv.speaker_runs(spark.createDataFrame(rows, SCHEMA))
        return {r.conv_id: (r.inquiry, r.resolution) for r in conv.first_messages(runs, "conv_id", "user", "assistant").collect()}

    assert len(expected) > 50 and pairs(sum(pieces, [])) == expected
    left = mining.first_pieces(spark.createDataFrame(pieces[0] + pieces[1], SCHEMA)).collect()
    right = mining.first_pieces(spark.createDataFrame(pieces[2] + pieces[3], SCHEMA)).collect()
    assert pairs(left + right) == expected
    most = {}
    for r in left:
        most[r.conv_id] = most.get(r.conv_id, 0) + 1
    assert max(most.values()) <= 4


def test_stream_started_again_and_tried_again(spark, tmp_path):
    batches, out, state = _turns(3), str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).write.parquet(str(tmp_path / f"in/part={i}"))
        stream = read_messages(spark, str(tmp_path / "in/part=*"), schema, files_per_trigger=1000)
        mining.write_pieces(stream, out, state).awaitTermination()
        seen = [r for b in batches[: i + 1] for r in b]
        got = {r.conv_id: (r.inquiry, r.resolution) for r in mining.read_pairs(spark, out).collect()}
        assert got == _first(seen)
    # as if the last batch had been written, but not recorded
    (tmp_path / "state/commits/3").unlink()
    (tmp_path / "state/commits/.3.crc").unlink(missing_ok=True)
    mining.write_pieces(read_messages(spark, str(tmp_path / "in/part=*"), schema), out, state).awaitTermination()
    assert {r.conv_id: (r.inquiry, r.resolution) for r in mining.read_pairs(spark, out).collect()} == got


def test_empty_batches_and_null_texts(spark):
    assert mining.first_pieces(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", None), (1, 1, "assistant", "yes"), (2, 0, "tool", "x"), (3, None, "user", "no number")]
    got = {(r.conv_id, r.turn, r.role, r.text) for r in mining.first_pieces(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {(1, 0, "user", ""), (1, 1, "assistant", "yes"), (2, 0, None, None)} <= got


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_stream_equals_table(spark, scale):
    folder = f"/root/testdata/{scale}"
    expected = sql_session(folder).execute(contract.oracle_sql()["kb_build"]).df()
    assert differences(contract.queries()["stream_kb_build"](spark, folder).toPandas(), expected) == []
