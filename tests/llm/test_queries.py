"""The registered text queries: against SQL where there is some, and against plain Python."""

import duckdb
import pytest

import corpus_pipeline
from shelfline.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    wanted, found = con.sql(ORACLES[name]).to_arrow_table(), QUERIES[name](spark, DIR).toArrow()
    columns = sorted(wanted.column_names)
    assert sorted(found.column_names) == columns
    rows = lambda t: sorted(map(repr, zip(*[t[c].to_pylist() for c in columns])))
    assert rows(found) == rows(wanted)


def test_names_cover_all():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_keeps_clean_documents(spark):
    docs = corpus_pipeline.documents(spark, DIR)
    stage, kept = docs, {}
    for name, function in corpus_pipeline.STAGES:
        stage = corpus_pipeline.freeze(function(spark, stage, DIR), f"test_{name}")
        kept[name] = stage.count()
        if name != "byte_bpe":
            assert stage.columns == docs.columns
    assert kept["toxicity"] >= 0.7 * docs.count() and kept["line_dedup"] == kept["toxicity"]
    assert kept["byte_bpe"] == kept["decontamination"] <= kept["near_dedup"] and stage.where("not round_trip").isEmpty()


@pytest.mark.parametrize("name, function", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, function):
    rows = [(1, None, None, None, None), (None, "some text", "en", "s", 9), (2, "", "en", "s", 0), (3, "a b\nc", "en", "s", 5),
            (3, "a b\nc", "en", "s", 5), (4, "word " * 20_000, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert function(spark, docs, DIR).count() <= len(rows)
    assert function(spark, docs.where("false"), DIR).count() == 0
