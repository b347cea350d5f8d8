import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from relaydesk.packs.support import SUPPORT
from relaydesk.plans import queries
from relaydesk.plans.triage import System, triage
from relaydesk.session import fresh_dir, shared_dir
from relaydesk.sources import tables as io

CASES = [
    ("C-1", 'He said "hi",\nthen é', "a", True, "why, oh why", "reply\\ with, comma", "easy", 5),
    ("C-2", "plain", "b", False, "", None, "hard", 4),
]


def test_json_array_of_cases(spark, tmp_path):
    path = tmp_path / "cases.json"
    path.write_text(json.dumps([dict(zip(io.CASES.names, c)) for c in CASES], ensure_ascii=False, indent=2), "utf-8")
    assert [tuple(r) for r in io.read_cases(spark, str(path)).collect()] == CASES
    with pytest.raises(AnalysisException):
        io.read_cases(spark, str(tmp_path / "none.json"))


def test_json_round_trip_keeps_every_character(spark, tmp_path):
    df = spark.createDataFrame(CASES, io.CASES)
    io.write_json(df, str(tmp_path / "out"))
    assert sorted(map(tuple, spark.read.schema(io.CASES).json(str(tmp_path / "out")).collect())) == CASES
    raw = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert "é" in raw


def test_csv_round_trip_with_quotes_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame(CASES, io.CASES)
    io.write_csv(df, str(tmp_path / "out"))
    back = sorted(map(tuple, io.read_csv(spark, str(tmp_path / "out"), io.CASES).collect()))
    assert [(r[0], r[1], r[3], r[7]) for r in back] == [(c[0], c[1], c[3], c[7]) for c in CASES]
    assert back[0][5] == CASES[0][5]


def test_missing_replies_fall_back_to_fixed_texts(spark, tmp_path):
    replies = io.read_replies(spark, str(tmp_path / "none.json"))
    assert replies.isEmpty() and replies.schema == io.REPLIES
    keyed = replies.withColumn("conv_id", F.col("conversation_id").cast("long"))
    one = spark.createDataFrame([(1, "my battery drains")], "id long, text string")
    simple = triage(one, System.create("simple", SUPPORT, keyed)).first()
    assert simple.reply == SUPPORT.replies.canned
    proposed = triage(one, System.create("proposed", SUPPORT, keyed)).first()
    assert proposed.reply == SUPPORT.replies.templates["hardware_battery"]


def test_replies_file(spark, tmp_path):
    path = tmp_path / "kb.json"
    rows = [{"conversation_id": "7", "customer_inquiry": "my screen is broken", "support_resolution": "DM us."}]
    path.write_text(json.dumps(rows), "utf-8")
    assert io.read_replies(spark, str(path)).first().support_resolution == "DM us."


def test_written_replies_are_read_whole(spark, tmp_path):
    rows = [(str(i), f"question {i}\n[", "an answer") for i in range(50)]
    io.write_json(spark.createDataFrame(rows, io.REPLIES).repartition(4), str(tmp_path / "kb"))
    assert sorted(map(tuple, io.read_replies(spark, str(tmp_path / "kb")).collect())) == sorted(rows)
    io.write_json(spark.createDataFrame(CASES, io.CASES), str(tmp_path / "cases"))
    assert sorted(map(tuple, io.read_cases(spark, str(tmp_path / "cases")).collect())) == CASES


@pytest.mark.parametrize("array_first", [True, False])
def test_a_folder_may_mix_lines_and_arrays(spark, tmp_path, array_first):
    rows = [(str(i), f"question {i}\n[", "an answer") for i in range(9)]
    folder = tmp_path / "a [kb]"
    folder.mkdir()
    made = [dict(zip(io.REPLIES.names, r)) for r in rows]
    names = ["0 %.json", "1.json"] if array_first else ["1.json", "0 %.json"]
    (folder / names[0]).write_text("\n\n " + json.dumps(made[:4], indent=2), "utf-8")
    (folder / names[1]).write_text("\n" + "\n".join(map(json.dumps, made[4:])), "utf-8")
    assert sorted(map(tuple, io.read_replies(spark, str(tmp_path / "a \\[kb\\]")).collect())) == rows


def test_threads_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "threads")
    spark.createDataFrame([("1", "x", "Customer: a"), ("2", "y", "Customer: b")], io.THREADS).write.parquet(path)
    df = io.read_threads(spark, path, "x")
    assert [r.conversation_id for r in df.collect()] == ["1"]
    assert "EqualTo(company,x)" in df._jdf.queryExecution().executedPlan().toString()


def test_metrics_are_written_per_system(spark, tmp_path):
    table = spark.createDataFrame([("a", "f1", "", 0.5), ("b", "f1", "", 0.7)], "system string, metric string, label string, value double")
    for _ in range(2):
        io.write_metrics(table, str(tmp_path / "m"))
    assert {p.name for p in (tmp_path / "m").glob("system=*")} == {"system=a", "system=b"}
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


class _Session:
    """Stands for a session with or without a named shared folder."""

    def __init__(self, named, master):
        self.conf, self.sparkContext, self.master = {"spark.checkpoint.dir": named}, self, master
        self.made = None

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = f"file:{path}"


def test_shared_folder_is_the_one_the_session_names():
    assert shared_dir(_Session("s3://bucket/x/", "spark://host")) == "s3://bucket/x"
    local = _Session(None, "local[4]")
    assert shared_dir(local) == shared_dir(local) == local.made
    with pytest.raises(RuntimeError):
        shared_dir(_Session(None, "spark://host"))


def test_fresh_folders_differ(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_large_tables_are_not_reshuffled(spark, monkeypatch):
    df = spark.range(10)
    assert "Exchange" in io.spread(df)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(io, "SMALL_INPUT_BYTES", 1)
    assert io.spread(df) is df
    assert io.gather(df, df) is df


def test_rows_that_take_long_are_dealt_out_by_size(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert io.deal(table).rdd.getNumPartitions() == cores
    # a table beyond this size was left in its splits
    monkeypatch.setattr(io, "plan_bytes", lambda df: 1024 * 1024 * 1024)
    assert io.deal(table).rdd.getNumPartitions() == max(65, cores)
    assert io.deal(table).count() == 1000


def test_documents_of_a_large_table_are_dealt_out(spark, tmp_path, monkeypatch):
    # one row group, which no number of splits divides; beyond this size it was one task
    spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(io, "SMALL_INPUT_BYTES", 1)
    monkeypatch.setattr(io, "plan_bytes", lambda df: 1024 * 1024 * 1024)
    docs = queries.documents(spark, str(tmp_path), "doc_id", "text")
    assert docs.rdd.getNumPartitions() == 65 and docs.count() == 1000
    assert queries.messages(spark, str(tmp_path)).rdd.getNumPartitions() == 257
