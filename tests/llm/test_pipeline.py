import hashlib
from pathlib import Path

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.compare import compare, connect
from tradeloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF_DIR) == ""
    con.close()


PROSE = "one day the {} of the house went over the {} street and then the people who had come there {} were glad about it all"
ROWS = [
    (1, PROSE.format("cat", "long", "early") + " write to jo@example.com please", "en"),
    (2, PROSE.format("cat", "long", "early") + " write to jo@example.com please", "en"),
    (3, PROSE.format("dog", "short", "late") + " and nothing else was said by any of them on that day", None),
    (4, None, "en"),
    (5, "12345 --- 678", "en"),
    (6, "", "en"),
    (7, "A line of its own: " + PROSE.format("dog", "short", "late") + ".", "en"),
    (8, "quite another text with words that do not occur in the others, about the sea and the wind", "en"),
]


def test_each_stage_takes_effect(spark):
    docs = spark.createDataFrame([(i, t, la, "s", 5, "clash", "x") for i, t, la in ROWS], "doc_id long, text string, lang string, source string, n_chars long, told string, kept string")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        docs = spark.createDataFrame(out.collect(), out.schema)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        rows[name] = {r.doc_id: r for r in docs.collect()}
    assert set(rows["language_id"]) == {1, 2, 3, 7, 8} and rows["language_id"][3].lang == "en"
    assert set(rows["near_dedup"]) == {1, 3, 7, 8}
    cut = rows["suffix_dedup"]
    assert set(cut) == {1, 3, 7, 8} and cut[1].text == ROWS[0][1] and cut[7].n_chars < len(ROWS[6][1])
    assert cut[7].text.startswith("A line of its own: ") and cut[8].text == ROWS[7][1]
    assert "<email>" in rows["personal_data"][1].text and "jo@" not in rows["personal_data"][1].text
    assert set(rows["packing"]) == {1, 3, 7, 8}


def test_an_empty_table_goes_through(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


@tables
def test_run_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_DIR)
    ids = {r.doc_id for r in out.collect()}
    assert out.count() == len(ids)
    first = {}
    for r in docs.orderBy("doc_id").collect():
        first.setdefault(hashlib.sha256(r.text.encode()).digest(), r.doc_id)
    assert ids <= set(first.values())  # no exact copy is left
    assert len(ids) > 0.8 * len(first)
