import json

import pytest

from tradeloom.operators import serving as S
from tradeloom.plans import harvest
from tradeloom.streaming.incremental import arrived_since, ingest_new_files
from tradeloom.operators.store import LayerStore


@pytest.fixture
def table(spark):
    rows = [(i, f"P{i} x", None if i % 2 else i, "f.csv") for i in range(1, 26)]
    return spark.createDataFrame(rows, "id long, post_code string, some_value int, datafile_created string")


def test_pages_start_at_the_given_id(table):
    seen, start = [], 0
    while start is not None:
        page = S.keyset_page(table, start, 10).orderBy("id").collect()
        seen.append([r.id for r in page])
        assert len({r.next_id for r in page}) == 1
        start = page[0].next_id
    assert [len(p) for p in seen] == [10, 10, 5] and sum(seen, []) == list(range(1, 26))
    assert S.keyset_page(table, 26, 10).isEmpty()


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_every_row_gets_its_page(spark, width):
    ids = [i * i for i in range(60)]
    rows = S.assign_pages(spark.createDataFrame([(i,) for i in ids], "id long"), 7, width=width).collect()
    assert {r.id: r.page for r in rows} == {i: n // 7 for n, i in enumerate(ids)}


def test_lookup_ignores_case_and_spaces(table):
    assert S.lookup_postcode(table, "p7X", column="post_code").first().id == 7
    assert S.lookup_postcode(table, "P99", column="post_code").isEmpty()


def test_records_and_tabular(table):
    records = [json.loads(r.record) for r in S.records_json(table).limit(2).collect()]
    assert records[0] == {"id": 1, "postCode": "P1 x", "someValue": None}
    assert json.loads(S.records_json(table, camel=False).first().record) == {"id": 1, "post_code": "P1 x", "some_value": None}
    assert json.loads(S.tabular_json(table).first().record) == ["1", "P1 x", None]


def test_catalog_tables(spark, table, tmp_path):
    spark.sql("create database if not exists served")
    table.write.mode("overwrite").saveAsTable("served.things")
    table.drop("id").write.mode("overwrite").saveAsTable("served.no_id")
    assert S.servable_table(spark, "served", "things").count() == 25
    with pytest.raises(LookupError):
        S.servable_table(spark, "served", "missing")
    with pytest.raises(LookupError):
        S.servable_table(spark, "operations", "things")
    with pytest.raises(ValueError):
        S.servable_table(spark, "served", "no_id")
    structure = [tuple(r) for r in S.table_structure(table).collect()]
    assert structure == [(1, "id", "bigint", 25), (2, "post_code", "string", 25), (3, "some_value", "int", 12)]
    assert S.export_schema(spark, "served", str(tmp_path)) == ["no_id", "things"]
    lines = {r.value for r in spark.read.text(str(tmp_path / "things.csv")).collect()}
    assert "id,post_code,some_value,datafile_created" in lines and "1,P1 x,NULL,f.csv" in lines


def test_links(spark):
    html = """<a href="/d/exporters1901.zip">x</a> <A class=k HREF='exporters1902.zip'> <a href="https://o.org/exporters9912.zip">
    <a href="//o.org/d/exporters2001.zip"><a name="n"><a href="other.zip"><link href="exporters2002.zip">"""
    pages = spark.createDataFrame([(1, "https://h.org/a/b.html?q=1", html), (2, "https://h.org", "<p>")], "page int, url string, html string")
    links = harvest.harvest_links(pages, r"(?:.*/)?exporters(\d{4})\.zip$", "yyMM")
    assert sorted((r.link, str(r.date)) for r in links.collect()) == [
        ("https://h.org/a/exporters1902.zip", "2019-02-01"),
        ("https://h.org/d/exporters1901.zip", "2019-01-01"),
        ("https://o.org/d/exporters2001.zip", "2020-01-01"),
        ("https://o.org/exporters9912.zip", "1999-12-01"),
    ]
    assert [r.page for r in harvest.pages_without_links(pages, links, "page").collect()] == [2]


def test_refresh_is_due_after_a_day_or_without_a_file(spark):
    online = spark.sql("select * from values (1, date'2020-01-02'), (2, date'2020-01-02'), (3, date'2020-01-02') t(k, date)")
    stored = spark.sql("select * from values (1, date'2020-01-01'), (2, date'2020-01-02') t(k, date)")
    due = {r.k: r.due for r in harvest.needs_refresh(online, stored, ["k"]).collect()}
    assert due == {1: True, 2: False, 3: True}


def test_stream_takes_each_file_once(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    inbox = tmp_path / "in"
    inbox.mkdir()

    def run():
        return ingest_new_files(store, "t", str(inbox), "k int, v string", str(tmp_path / "cp"), "csv")

    (inbox / "1.csv").write_text("1,a\n2,b\n2,b\n")
    assert run() == 1
    assert run() == 0
    (inbox / "2.csv").write_text("2,b\n3,c\n")
    assert run() == 1
    rows = sorted((r.k, r.datafile_created, r.datafile_updated) for r in store.read("t").collect())
    assert rows == [(1, "batch-0", "batch-0"), (2, "batch-0", "batch-1"), (3, "batch-1", "batch-1")]
    assert [r.k for r in arrived_since(store, "t", 1).collect()] == [3]
