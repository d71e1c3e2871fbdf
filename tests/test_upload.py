import pytest

from tradeloom.sources import delimited as D
from tradeloom.sources import upload as U


@pytest.fixture
def write(tmp_path):
    def go(text, name="file.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode() if isinstance(text, str) else text)
        return str(path)

    return go


def test_profile(spark, write):
    path = write("a,b,c\n1,hello,2020-01-01\n2,NULL,2020-01-02\n3,N/A,2020-01-03\n4,Nonesuch,2020-01-04\n5,x,2020-01-05\n")
    found = {r.column: (r.type, r.samples) for r in U.profile_upload(spark, path).collect()}
    assert found == {
        "a": ("integer", ["1", "2", "3", "4"]),
        "b": ("text", ["hello", "", "", "such"]),
        "c": ("date", ["2020-01-01", "2020-01-02", "2020-01-03", "2020-01-04"]),
    }


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1", "-2", "+3"], "integer"),
        (["048", ""], "integer"),
        (["1", "2.5"], "numeric"),
        ([".5", "1e3"], "numeric"),
        (["true", "False"], "boolean"),
        (["1", "true"], "text"),
        (["2006-11-26"], "date"),
        (["2004"], "integer"),
        (["2006-02-30"], "text"),
        (["2006-11-26T16:30:00Z"], "timestamp"),
        (["2006-11-26", "2006-11-26T16:30:00Z"], "text"),
        (["1", "x"], "text"),
        (["", " "], "text"),
    ],
)
def test_type_inference(spark, values, expected):
    rows = spark.createDataFrame([(v,) for v in values], "c string")
    assert [tuple(r) for r in U.infer_types(rows).collect()] == [(1, "c", expected)]


@pytest.mark.parametrize(
    "text, message",
    [
        ("a,b\n1,2\n3\n", r"row 3 has 1 cells, but the header has 2"),
        ("a,b\n1,2,3\n3,4\n", r"row 2 has 3 cells"),
        ("a,B c\n1,2\n", r'not valid: "B c"'),
        ("1a,b\n1,2\n", r'not valid: "1a"'),
        ("", "no headers found"),
        (",\n1,2\n", "no headers found"),
        ("a,b\n", "no data found"),
    ],
)
def test_bad_files_are_explained(spark, write, text, message):
    with pytest.raises(U.UploadError, match=message):
        U.profile_upload(spark, write(text))


def test_repeated_and_blank_headers(spark, write):
    rows = U.read_upload(spark, write('a,,a,b\n1,2,3,"x, ""y"""\n'))
    assert rows.columns == ["a_1", "a_2", "b"]
    assert tuple(rows.first()) == ("1", "3", 'x, "y"')
    assert U.unique_headers(["a", "a", "a_1"]) == ["a_1_1", "a_2", "a_1_2"]


def test_whole_cell_tokens(spark, write):
    rows = U.read_upload(spark, write("a\nNone\nNonesuch\n"), whole_cell=True)
    assert [r.a for r in rows.collect()] == ["", "Nonesuch"]


def test_other_delimiters(spark, write):
    rows = U.read_upload(spark, write("a;b\n'1;x';2\n"), sep=";", quote="'")
    assert tuple(rows.first()) == ("1;x", "2")


def test_line_breaks_inside_quotes(spark, write):
    rows = U.read_upload(spark, write('a,b\n1,"x\ny"\n2,z\n'), multi_line=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x\ny"), ("2", "z")]
    with pytest.raises(U.UploadError, match=r"row 3 has 3 cells"):
        U.read_upload(spark, write('a,b\n1,"x\ny"\n2,"z\n,",3\n'), multi_line=True)
    with pytest.raises(U.UploadError, match=r"row 2 has 1 cells"):
        U.read_upload(spark, write('a,b\n1\n2,z\n'), multi_line=True)


def test_line_breaks_and_encoding_are_found_out(spark, write):
    text = 'a,b\n1,"x\ny"\n2,café €\n'
    for data in (text.encode(), text.encode("cp1252")):
        rows = U.read_upload(spark, write(data))
        assert sorted(tuple(r) for r in rows.collect()) == [("1", "x\ny"), ("2", "café €")]
    latin = U.read_upload(spark, write("a\né\n".encode("latin-1")), encoding="ISO-8859-1")
    assert latin.first().a == "é"


def test_types_come_from_all_rows(spark, write):
    path = write("a\n" + "1\n" * 100_005 + "x\n")
    assert U.profile_upload(spark, path).first().type == "text"


def test_column_comparison():
    assert U.missing_columns(["a", "b", "c"], ["b"]) == ["a", "c"]
    assert U.reserved_columns(["id", "x", "data_source_row_id"]) == ["id", "data_source_row_id"]


def test_lines_are_numbered_across_blocks(spark, write):
    lines = [f"line {i}" for i in range(1, 2001)]
    path = write("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        numbered = D.file_lines(spark, path)
        rows = numbered.collect()
        assert len({r.block for r in rows}) > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.line_number: r.line for r in rows} == dict(enumerate(lines, 1))


def test_a_value_of_the_wrong_type_fails_the_read(spark, write):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        D.read_delimited(spark, write("a,b\n1,x\ny,x\n"), "a int, b string").collect()


def test_discovery_lists_without_reading(spark, tmp_path):
    for name in ("x/a.csv", "x/y/b.csv", "x/c.txt", "x/[Content_Types].xml"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("1")
    found = D.files_matching(D.discover(spark, str(tmp_path / "x")), r"\.(csv|xml)$")
    assert sorted(r.path.rsplit("/", 1)[-1] for r in found.collect()) == ["a.csv", "b.csv"]
