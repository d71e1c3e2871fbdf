import datetime as dt

import pytest

from tradeloom.operators.quality import check_violations
from tradeloom.operators.store import LayerStore
from tradeloom.plans import licensing as P

DAY, NOON = dt.datetime(2019, 3, 12), dt.datetime(2019, 3, 12, 12)

GOOD = {
    "batches": {"id": 1, "batch_ref": "1", "status": "RELEASED", "start_date": DAY, "end_date": DAY, "approve_date": DAY},
    "applications": {"ela_grp_id": 1, "case_type": "SIEL", "case_sub_type": "PERMANENT", "withheld_status": None},
    "goods_incidents": {"id": 1, "type": "REFUSAL", "version_no": 0},
    "footnotes": {"id": 1, "status": "CURRENT"},
    "media_footnote_details": {"id": 1, "status_control": "C", "end_datetime": None, "footnote_type": "STANDARD"},
    "media_footnote_countries": {"id": 1, "status_control": None, "end_datetime": DAY},
    "footnote_entries": {"fne_id": 1, "version_no": 1, "fn_id": 1, "mfd_id": None, "mf_grp_id": None, "mf_free_text": None},
    "incidents": {
        "inc_id": 1, "version_no": 1, "status": "READY", "type": "ISSUE", "case_type": "SIEL", "case_sub_type": "PERMANENT",
        "licence_id": 1, "temporary_licence_flag": 0, "licence_conversion_flag": 0, "incorporation_flag": 0, "mil_flag": 0,
        "other_flag": 0, "torture_flag": 1,
    },
    "returns": {"elr_id": 1, "elr_version": 1, "status": "ACTIVE", "status_control": "A", "licence_type": "OIEL", "ogl_id": None},
    "third_parties": {"tp_id": 1, "version_no": 0, "ultimate_end_user_flag": None},
    "ultimate_end_users": {"ueu_id": 1, "version_no": 0, "status_control": "D"},
}

CASES = [
    ("batches", {"status": "STAGING"}, None),
    ("batches", {"status": "OTHER"}, "status"),
    ("batches", {"batch_ref": "C1", "start_date": None, "end_date": None}, None),
    ("batches", {"batch_ref": "C1"}, "dates"),
    ("batches", {"start_date": None}, "dates"),
    ("batches", {"end_date": None}, "dates"),
    ("batches", {"end_date": NOON}, "dates"),
    ("batches", {"start_date": DAY + dt.timedelta(1)}, "dates"),
    ("applications", {"case_type": "OIEL", "case_sub_type": "CRYPTO"}, None),
    ("applications", {"case_type": "GPL", "case_sub_type": None}, None),
    ("applications", {"case_type": "SIEL", "case_sub_type": "CRYPTO"}, "case sub type"),
    ("applications", {"case_type": "GPL", "case_sub_type": "MEDIA"}, "case sub type"),
    ("applications", {"withheld_status": "PENDING"}, None),
    ("applications", {"withheld_status": "NO"}, "withheld status"),
    ("goods_incidents", {"type": "SUSPENSION"}, "type"),
    ("goods_incidents", {"version_no": -1}, "version"),
    ("footnotes", {"status": "NEW"}, "status"),
    ("media_footnote_details", {"end_datetime": DAY}, "open when current"),
    ("media_footnote_details", {"status_control": "A"}, "open when current"),
    # unknown, and unknown passes
    ("media_footnote_details", {"status_control": None}, None),
    ("media_footnote_details", {"footnote_type": "X"}, "footnote type"),
    ("media_footnote_countries", {"status_control": "C"}, "open when current"),
    ("footnote_entries", {"goods_item_id": 1}, None),
    ("footnote_entries", {"country_id": 1, "fnr_id": 1}, None),
    ("footnote_entries", {"fnr_id": 1}, "subject"),
    ("footnote_entries", {"goods_item_id": 1, "country_id": 1}, "subject"),
    ("footnote_entries", {"version_no": -1}, "version"),
    ("footnote_entries", {"fn_id": None, "mfd_id": 1, "mf_grp_id": 1}, None),
    ("footnote_entries", {"fn_id": None, "mf_free_text": "x", "mf_grp_id": 1}, None),
    ("footnote_entries", {"mf_grp_id": 1}, "shape"),
    ("footnote_entries", {"fn_id": None, "mfd_id": 1}, "shape"),
    ("incidents", {"status": "DONE"}, "status"),
    ("incidents", {"version_no": -1}, "version"),
    ("incidents", {"case_type": "OGEL", "case_sub_type": None, "ogl_id": 1}, None),
    ("incidents", {"case_type": "OGEL", "case_sub_type": None}, "general licence"),
    ("incidents", {"ogl_id": 1}, "general licence"),
    ("incidents", {"type": "REFUSAL", "licence_id": None}, None),
    ("incidents", {"type": "REFUSAL"}, "refusal"),
    ("incidents", {"licence_id": None}, "refusal"),
    ("incidents", {"type": "SUSPENSION", "else_id": 1}, None),
    ("incidents", {"type": "SUSPENSION"}, "suspension"),
    ("incidents", {"else_id": 1}, "suspension"),
    ("incidents", {"type": "OTHER"}, "type"),
    ("incidents", {"case_sub_type": "MEDIA"}, "case sub type"),
    *[("incidents", {flag: 2}, flag.replace("_", " ")) for flag in P.FLAGS],
    ("returns", {"elr_version": 0}, "version"),
    ("returns", {"status": "X"}, "status"),
    ("returns", {"status_control": "D"}, "status control"),
    ("returns", {"licence_type": "OGEL", "ogl_id": 1}, None),
    ("returns", {"licence_type": "OGEL"}, "general licence"),
    ("returns", {"ogl_id": 1}, "general licence"),
    ("returns", {"licence_type": None, "ogl_id": 1}, None),
    ("third_parties", {"ultimate_end_user_flag": 2}, "ultimate end user flag"),
    ("third_parties", {"version_no": -1}, "version"),
    ("ultimate_end_users", {"version_no": -1}, "version"),
    ("ultimate_end_users", {"status_control": "X"}, "status control"),
]


def test_checks_accept_good_values_and_name_the_broken_rule(spark):
    for table in GOOD:
        rules = P.BY_NAME[table]
        cases = [({}, None)] + [(change, rule) for t, change, rule in CASES if t == table]
        columns = rules.struct.fieldNames()
        data = [tuple({**GOOD[table], **change}.get(c) for c in columns) + (i,) for i, (change, _) in enumerate(cases)]
        rows = spark.createDataFrame(data, rules.schema + ", n int")
        found = {}
        for r in check_violations(rows, rules.checks, ["n"]).collect():
            found.setdefault(r.n, set()).add(r.rule)
        for i, (change, rule) in enumerate(cases):
            expected = set() if rule is None else {rule}
            assert found.get(i, set()) == expected, (table, change)


def test_unknown_code_breaks_both_code_rules(spark):
    rules = P.BY_NAME["applications"]
    row = {**GOOD["applications"], "case_type": "NEW"}
    df = spark.createDataFrame([tuple(row.get(c) for c in rules.struct.fieldNames())], rules.schema)
    assert {r.rule for r in check_violations(df, rules.checks, ["ela_grp_id"]).collect()} == {"case type", "case sub type"}


def test_the_schema_is_complete():
    assert len(P.TABLES) == 25
    assert sum(len(t.checks) for t in P.TABLES) == 37
    assert sum(len(t.foreign_keys) for t in P.TABLES) == 24
    order = [t.name for t in P.TABLES]
    for t in P.TABLES:
        assert all(order.index(fk.parent) < order.index(t.name) for fk in t.foreign_keys)
        assert set(t.primary_key) | set(t.not_null) <= set(t.struct.fieldNames())


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "store"))


def write(tmp_path, name, header, *rows):
    path = tmp_path / name
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


BATCH_HEADER = "id,batch_ref,status,start_date,end_date,approve_date,release_date,staging_date"
BATCH = '"1","42","RELEASED","2019-3-12 00:00:00","2019-3-13 00:00:00","2019-3-14 10:00:00","",null'
COUNTRY_HEADER = "ela_grp_id,country_id,report_date,start_date,batch_id"


def test_load_by_name_in_reference_order(spark, store, tmp_path):
    P.load_table(spark, store, "batches", write(tmp_path, "batches.csv", BATCH_HEADER, BATCH))
    (batch,) = store.read("batches").collect()
    assert (batch.start_date, batch.release_date, batch.staging_date) == (DAY, None, None)

    header = "batch,Group,case_type,case_sub_type,time,closed"
    names = {"batch": "batch_id", "Group": "ela_grp_id", "case_type": "case_type", "case_sub_type": "case_sub_type", "time": "initial_processing_time", "closed": "case_closed_date"}
    path = write(tmp_path, "applications.csv", header, "1,7,SIEL,PERMANENT,3,2019-3-12 00:00:00")
    with pytest.raises(KeyError):
        P.load_table(spark, store, "applications", path)
    with pytest.raises(KeyError):
        P.load_table(spark, store, "applications", path, {k: v for k, v in names.items() if k != "time"})
    P.load_table(spark, store, "applications", path, names)
    assert store.read("applications").first().ela_grp_id == 7


@pytest.mark.parametrize(
    "row, problem",
    [
        (BATCH.replace("RELEASED", "OPEN"), r"check \(status\)"),
        (BATCH.replace('"RELEASED"', "NULL"), r"not null \(status\)"),
        (BATCH + "\n" + BATCH, r"primary key \(id\)"),
    ],
)
def test_a_bad_row_rejects_the_whole_file(spark, store, tmp_path, row, problem):
    good = BATCH.replace('"1"', '"2"', 1)
    with pytest.raises(P.LoadRejected, match=problem):
        P.load_table(spark, store, "batches", write(tmp_path, "b.csv", BATCH_HEADER, good, row))
    assert not store.exists("batches")


def test_missing_parents_reject_a_file(spark, store, tmp_path):
    with pytest.raises(P.LoadRejected, match="foreign key"):
        P.load_table(spark, store, "country_group_entries", write(tmp_path, "e.csv", "cg_id,country_id", "1,2"))
    P.load_table(spark, store, "country_groups", write(tmp_path, "g.csv", "id", "1"))
    P.load_table(spark, store, "country_group_entries", write(tmp_path, "e.csv", "cg_id,country_id", "1,2"))
    with pytest.raises(P.LoadRejected, match="primary key"):
        P.load_table(spark, store, "country_group_entries", write(tmp_path, "e.csv", "cg_id,country_id", "1,2"))


def test_a_value_of_the_wrong_type_fails_the_load(spark, store, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        P.load_table(spark, store, "country_groups", write(tmp_path, "g.csv", "id", "one"))
    assert not store.exists("country_groups")


def test_the_whole_report_is_kept(spark, store, tmp_path):
    bad = [BATCH.replace('"1"', f'"{i}"', 1).replace("RELEASED", "OPEN") for i in range(1, 9)]
    with pytest.raises(P.LoadRejected, match=r"8 x check \(status\).*batches_report"):
        P.load_table(spark, store, "batches", write(tmp_path, "b.csv", BATCH_HEADER, *bad))
    assert store.read("batches_report").count() == 8


@pytest.mark.parametrize("row", ["1,2", ""])
def test_rows_of_another_length_than_the_header_fail_the_load(spark, store, tmp_path, row):
    path = write(tmp_path, "e.csv", "cg_id,country_id", "1,2", row or "3", "4,5,6" if row else "4,5")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        P.load_table(spark, store, "country_group_entries", path)
    assert not store.exists("country_group_entries")


def test_a_group_is_loaded_in_reference_order(spark, store, tmp_path):
    order = P.load_order()
    assert sorted(order) == sorted(P.BY_NAME)
    assert all(order.index(fk.parent) <= order.index(t) for t in order for fk in P.BY_NAME[t].foreign_keys)
    files = {
        "country_group_entries": write(tmp_path, "e.csv", "cg_id,country_id", "1,2"),
        "country_groups": write(tmp_path, "g.csv", "id", "1"),
        "batches": write(tmp_path, "b.csv", BATCH_HEADER, BATCH.replace("RELEASED", "OPEN")),
    }
    states = []
    failed = P.load_group(spark, store, files, lambda *state: states.append(state[:3]))
    assert set(failed) == {"batches"} and store.read("country_group_entries").count() == 1
    assert ("batches", "b.csv", "failed") in states and ("country_groups", "g.csv", "processed") in states
