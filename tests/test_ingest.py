import pytest
from pyspark.sql import functions as F

from tradeloom.operators import lifecycle as L
from tradeloom.operators import registry as R
from tradeloom.operators.store import LayerStore
from tradeloom.plans import ingest
from tradeloom.sources.delimited import read_delimited
from tradeloom.spec import INCREMENTAL, REPLACE, SNAPSHOT, DatasetSpec

SCHEMA = "key int, name string"


def spec(mode=SNAPSHOT, **options):
    return DatasetSpec(
        "test", "things", mode, SCHEMA, lambda spark, path: read_delimited(spark, path, SCHEMA), ["key", "name"],
        lambda: {"name": F.upper("name")}, **options,
    )


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "store"))


@pytest.fixture
def write(tmp_path):
    def go(name, *rows):
        path = tmp_path / name
        path.write_text("\n".join(["key,name", *rows]) + "\n")
        return str(path)

    return go


def rows(store, name, *columns):
    return sorted(tuple(r) for r in store.read(f"test/things/{name}").select(*columns).collect())


LINEAGE = ("key", "datafile_created", "datafile_updated")


def test_snapshot_merge_keeps_lineage(store, write):
    ingest.load_file(spec(), store, write("1.csv", "1,a", "2,b", "2,b"))
    ingest.load_file(spec(), store, write("2.csv", "2,b", "3,c"))
    assert rows(store, "L0", *LINEAGE) == [(1, "1.csv", "1.csv"), (2, "1.csv", "2.csv"), (3, "2.csv", "2.csv")]
    assert rows(store, "L1", "key", "name") == [(1, "A"), (2, "B"), (3, "C")]
    sources = {r.id: r.key for r in store.read("test/things/L0").collect()}
    assert all(sources[r.data_source_row_id] == r.key for r in store.read("test/things/L1").collect())


def test_same_snapshot_twice_changes_nothing(store, write):
    path = write("1.csv", "1,a", "2,")
    ingest.load_file(spec(), store, path)
    before = rows(store, "L0", "id", *LINEAGE)
    ingest.load_file(spec(), store, path)
    assert rows(store, "L0", "id", *LINEAGE) == before
    assert len(rows(store, "L1", "key")) == 2


def test_delete_previous(store, write):
    ingest.load_file(spec(delete_previous=True), store, write("1.csv", "1,a", "2,b"))
    ingest.load_file(spec(delete_previous=True), store, write("2.csv", "2,b", "3,c"))
    assert rows(store, "L0", "key") == [(2,), (3,)]
    assert rows(store, "L1", "key") == [(2,), (3,)]


def test_rows_without_update_survive_deletion(spark):
    layer = spark.createDataFrame([(1, "a.csv"), (2, None), (3, "b.csv")], "id int, datafile_updated string")
    assert sorted(r.id for r in L.delete_previous_l0(layer, "b.csv").collect()) == [2, 3]
    l1 = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "id int, data_source_row_id int")
    assert sorted(r.id for r in L.delete_previous_l1(layer, l1, "b.csv").collect()) == [11, 12]


def test_null_and_empty_text_are_different_rows(spark):
    from tradeloom.functions.text import row_hash

    df = spark.createDataFrame([(None,), ("",), ("null",), (None,)], "name string")
    assert df.select(row_hash("name").alias("h")).distinct().count() == 3


def test_force_leaves_only_the_last_file(store, write):
    paths = [write("1.csv", "1,a"), write("2.csv", "2,b")]
    assert ingest.process_files(spec(), store, paths, force=True)
    assert rows(store, "L0", "key") == [(2,)] and rows(store, "L1", "key") == [(2,)]
    ingest.load_file(spec(INCREMENTAL), store, paths[0], force=True)
    assert rows(store, "L0", "key") == [(1,)]


def test_replace_and_restore(store, write):
    ingest.load_file(spec(REPLACE), store, write("1.csv", "1,a"))
    ingest.load_file(spec(REPLACE), store, write("2.csv", "2,b"))
    assert rows(store, "L0", "key") == [(2,)]
    store.restore("test/things/L0", 1)
    assert rows(store, "L0", "key") == [(1,)]
    assert [(r.version, r.label) for r in store.versions("test/things/L0").orderBy("version").collect()] == [
        (1, "1.csv"), (2, "2.csv"), (3, "1.csv"),
    ]


def test_registry_through_success_failure_and_retry(store, write):
    good, bad, last = write("a.csv", "1,a"), write("b.csv", "x,b"), write("c.csv", "3,c")
    assert ingest.process_files(spec(), store, [good, bad, last])
    states = {r.file_name: (r.state, r.error_message) for r in ingest.registry(store).collect()}
    assert states["a.csv"] == ("processed", None) and states["c.csv"] == ("processed", None)
    assert states["b.csv"][0] == "failed" and states["b.csv"][1]
    assert rows(store, "L0", "key") == [(1,), (3,)]

    message = states["b.csv"][1]
    write("b.csv", "2,b")
    assert ingest.process_files(spec(), store, [good, bad, last])
    states = {r.file_name: (r.state, r.error_message) for r in ingest.registry(store).collect()}
    assert states["b.csv"] == ("processed", message)
    assert rows(store, "L0", "key", "datafile_updated") == [(1, "a.csv"), (2, "b.csv"), (3, "c.csv")]
    assert not ingest.process_files(spec(), store, [good, bad, last])


def test_a_retry_doubles_nothing(store, write, monkeypatch):
    path, things = write("1.csv", "1,a", "2,b"), spec(INCREMENTAL)

    def fail(*_):
        raise RuntimeError("no room")

    with monkeypatch.context() as m:
        m.setattr(L, "incremental_l1", fail)
        assert not ingest.process_files(things, store, [path])
    assert not store.exists("test/things/L0")  # the failed attempt left nothing visible in either layer
    assert ingest.process_files(things, store, [path])
    assert rows(store, "L0", "key") == [(1,), (2,)] and rows(store, "L1", "key", "name") == [(1, "A"), (2, "B")]
    ids = {r.id for r in store.read("test/things/L0").collect()}
    assert {r.data_source_row_id for r in store.read("test/things/L1").collect()} == ids
    # A finished file that is loaded on purpose once more is added again.
    ingest.load_file(things, store, path)
    assert len(rows(store, "L0", "key")) == 4


class Stop(BaseException):
    """The process ends: nothing after this point runs, no handler sees it."""


def test_load_after_stop_between_the_layers(spark, store, write, monkeypatch):
    things = spec(INCREMENTAL)
    files = [write(f"{i}.csv", *(f"{i * 10 + k},n" for k in range(5))) for i in range(4)]
    staged = store.stage

    def stop_at_l1(table, df, *args):
        if table.endswith("/L1"):
            raise Stop()
        return staged(table, df, *args)

    with monkeypatch.context() as m:
        m.setattr(store, "stage", stop_at_l1)
        with pytest.raises(Stop):
            ingest.process_files(things, store, files)
    again = LayerStore(spark, store.root)  # a new run
    assert not again.exists("test/things/L0")
    assert ingest.process_files(things, again, files)
    assert len(rows(again, "L0", "key")) == 20 and len(rows(again, "L1", "key")) == 20
    assert {r.state for r in ingest.registry(again).collect()} == {R.PROCESSED}


def test_a_recorded_transaction_is_finished_by_the_next_store(spark, store, write, monkeypatch):
    things = spec(INCREMENTAL)
    files = [write(f"{i}.csv", f"{i},n") for i in range(3)]

    def stop(*_):
        raise Stop()

    with monkeypatch.context() as m:
        m.setattr(LayerStore, "_apply", stop)
        with pytest.raises(Stop):
            ingest.process_files(things, store, files)
    assert not store.exists("test/things/L0")  # recorded, not applied yet
    again = LayerStore(spark, store.root)
    assert rows(again, "L0", "key") == [(0,), (1,), (2,)] and len(rows(again, "L1", "key")) == 3
    assert not ingest.process_files(things, again, files)  # all processed: nothing is loaded twice
    assert len(rows(again, "L0", "key")) == 3 and again.recover() == 0


def test_many_files_are_one_addition_and_a_bad_one_is_found(store, write):
    things = spec(INCREMENTAL)
    files = [write(f"{i:02}.csv", f"{i},n{i}") for i in range(6)]
    assert ingest.process_files(things, store, files)
    assert store._version("test/things/L0").version == store._version("test/things/L1").version == 1
    assert rows(store, "L0", "key", "datafile_created") == [(i, f"{i:02}.csv") for i in range(6)]
    more = [write("07.csv", "7,a"), write("08.csv", "x,b"), write("09.csv", "9,c")]
    assert ingest.process_files(things, store, [*files, *more])
    assert rows(store, "L0", "key") == [(i,) for i in (0, 1, 2, 3, 4, 5, 7, 9)] and len(rows(store, "L1", "key")) == 8
    states = {r.file_name: r.state for r in ingest.registry(store).collect()}
    assert states["08.csv"] == R.FAILED and sum(s == R.PROCESSED for s in states.values()) == 8


def test_small_additions_are_compacted(spark, store):
    for i in range(7):
        store.append_compacted("t", spark.createDataFrame([(i,)], "v int"), folders=3)
    assert sorted(r.v for r in store.read("t").collect()) == list(range(7))
    assert len(store._version("t").paths) <= 3


def test_what_could_not_be_read_is_kept(store, write):
    def read(spark, path):
        texts = spark.read.option("header", True).csv(path)
        number = F.col("key").try_cast("int")
        good = texts.where(number.isNotNull()).select(number.alias("key"), "name")
        return good, texts.where(number.isNull()).select(F.col("name").alias("doc"), F.col("key").alias("message"))

    things = spec(INCREMENTAL, read_with_errors=read)
    assert ingest.process_files(things, store, [write("1.csv", "1,a", "x,b")])
    assert rows(store, "L0", "key") == [(1,)]
    assert rows(store, "errors", "doc", "message", "datafile_created") == [("b", "x", "1.csv")]


def test_a_missing_file_name_is_always_a_new_entry(spark):
    at = F.lit("2020-01-01").cast("timestamp")
    registry = spark.createDataFrame([], R.REGISTRY_SCHEMA)
    for name in (None, None, "", "a", "a"):
        update = spark.createDataFrame([("s", name, "processing", None)], "source string, file_name string, state string, error_message string")
        registry = R.registry_upsert(registry, update, at)
    assert sorted(str(r.file_name) for r in registry.collect()) == ["", "None", "None", "a"]


def test_ignored_files_are_not_offered_again(spark):
    registry = spark.createDataFrame(
        [("s", "a", "ignored"), ("s", "b", "failed"), ("s", "c", "processing"), ("t", "d", "processed")],
        "source string, file_name string, state string",
    )
    files = spark.createDataFrame([("s", n) for n in "abcd"], "source string, file_name string")
    assert sorted(r.file_name for r in R.unprocessed_files(files, registry).collect()) == ["b", "c", "d"]
    assert sorted((r.source, r.file_name) for r in R.finished_files(registry).collect()) == [("s", "a"), ("t", "d")]


def test_groups_run_in_dependency_order(store, write):
    def named(name, *requires):
        return DatasetSpec("g", name, INCREMENTAL, SCHEMA, lambda s, p: read_delimited(s, p, SCHEMA), requires=requires)

    specs = {s.id: s for s in (named("cube", "g.tariff"), named("tariff", "g.codes", "g.rates"), named("codes"), named("rates"))}
    files = {"g.codes": [write("codes.csv", "1,a")]}
    assert ingest.run_group(specs, ["g.cube"], store, files) == ["g.codes", "g.rates", "g.tariff", "g.cube"]
    assert store.read("g/codes/L0").count() == 1


def test_upload_is_checked_typed_and_versioned(store, write):
    first = write("v1.csv", "1,one", "2,None")
    types = {"key": "integer", "name": "text"}
    table = ingest.load_upload(store, "org", "data", first, types)
    assert sorted((r.key, r.name) for r in table.collect()) == [(1, "one"), (2, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cast"):
        ingest.load_upload(store, "org", "data", write("v2.csv", "x,one"), types)
    assert store.read("org/data/L0").count() == 2
    assert ingest.check_upload(["id", "key"], ["key", "name"]) == {"missing": ["name"], "reserved": ["id"]}
    assert {r.file for r in store.read("org/data/uploads").select("file").distinct().collect()} == {"v1.csv", "v2.csv"}
