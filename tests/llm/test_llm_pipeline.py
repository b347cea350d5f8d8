"""The stages, one after the other, and what each does to odd rows."""

import pytest

import corpus_pipeline as pipeline
from relaydesk.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_run_packs_what_the_stages_keep(spark):
    pieces = pipeline.run(spark, FOLDER).toPandas()
    ids = {r.doc_id for r in table(spark, FOLDER, "documents").select("doc_id").collect()}
    assert set(pieces.doc_id) < ids
    sizes = pieces.groupby("sequence_id").length.sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def odd(spark):
    docs = table(spark, FOLDER, "documents").limit(20)
    text = "An ordinary text of a few words, which says nothing much but says it calmly."
    rows = [(None, text, "en", None, None), (9001, None, None, "s", 1), (9002, "", "en", "s", 0), (9003, text, "en", "s", 1), (9003, text, "en", "s", 1), (9004, "word " * 30_000, "en", "s", 1)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_stages_keep_columns_and_take_odd_rows(spark, name, stage):
    docs = odd(spark).selectExpr("*", "'mine' AS score", "1 AS _label_")
    out = stage(spark, docs, FOLDER)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert 9001 in kept or name == "quality"
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
    if name == "ngram_dedup":
        assert None in kept and 9003 in kept  # a null id leads to nothing


@pytest.mark.parametrize("name,stage", pipeline.STAGES[2:4])
def test_stages_keep_what_columns_of_any_name_hold(spark, name, stage):
    docs = odd(spark)
    plain = sorted((tuple(r) for r in stage(spark, docs.where("doc_id is not null"), FOLDER).collect()), key=repr)
    names = ["_row", "_ROWS", "_drop", "_pieces", "_stays", "_times", "_given", "_text", "_doc", "n_lines", "n_dropped"]
    odder = docs.where("doc_id is not null").selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    out = stage(spark, odder, FOLDER)
    assert out.columns == odder.columns
    rows = out.collect()
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert sorted((tuple(r)[: len(docs.columns)] for r in rows), key=repr) == plain


def test_ngram_dedup_drops_rows_not_ids(spark):
    copied, other = "an ordinary text of a few words that two rows share", "a clean text that no other row has at all"
    schema = "doc_id long, text string"
    left = lambda rows: sorted(pipeline.ngram_dedup(spark, spark.createDataFrame(rows, schema), FOLDER).collect(), key=str)
    assert left([(2, copied), (4, copied), (4, other)]) == [(2, copied), (4, other)]
    assert left([(4, copied), (4, copied)]) == [(4, copied)]
    assert left([(4, copied), (4, copied), (-3, copied), (7, None), (7, None), (None, copied)]) == [(-3, copied), (7, None), (7, None), (None, copied)]


def test_first_rows_of_groups_are_sent_once(spark, monkeypatch):
    plans, write = {}, pipeline.written
    note = lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name)
    monkeypatch.setattr(pipeline, "written", note)
    rows = [(i, " ".join(f"word{i // 2}{j}" for j in range(9))) for i in range(8)]
    out = pipeline.ngram_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 4, 6]
    assert "explode" not in plans["marks"]


def test_pipeline_is_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "op3_url_filter" in contract.oracle_sql() and [n for n, _ in pipeline.STAGES][0] == "toxicity"


def test_url_rules_equal_sql(spark):
    from compare import differences, sql_session

    from relaydesk.llm import queries

    expected = sql_session(FOLDER).execute(queries.SQL["op3_url_filter"]).df()
    assert differences(queries.op3_url_filter(spark, FOLDER).toPandas(), expected) == []
