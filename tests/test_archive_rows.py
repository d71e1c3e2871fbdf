import io
import zipfile

from tradeloom.rehearsal.archives import zipped
from tradeloom.sources.archives import lines_of, members


def plan(df):
    return df._jdf.queryExecution().toString()


def test_rows_are_packed_in_one_pass_and_come_out_again(spark):
    names = ["plain.txt", "in.zip/first.txt", "in.zip/second.txt", "other.zip/first.txt"]
    rows = [(f"c{i % 40}.zip", names[i % 4 if i % 40 else 0], f"{i:04d}\tä {i}") for i in range(400)]
    rows += [("c3.zip", None, "no member"), ("twice.zip", "plain.txt", "same"), ("twice.zip", "plain.txt", "same")]
    packed = zipped(spark.createDataFrame(rows, "file string, member string, text string").repartition(7), nested=True)
    # One call of Python for each of millions of archives took most of the time.
    assert "FlatMapGroupsIn" not in plan(packed)
    found = packed.collect()
    want = {}
    for file, member, text in rows:
        if member:
            want.setdefault(file, {}).setdefault(member, []).append(text)
    assert sorted(r.file for r in found) == sorted(want)
    for r in found:
        assert zipfile.ZipFile(io.BytesIO(r.content)).testzip() is None
        got = {m: opened().read().decode().split("\n") for m, opened in members(bytes(r.content))}
        assert got == {m: sorted(texts) for m, texts in want[r.file].items()}
    lines = sorted((r.file, r.member, r.line) for r in lines_of(packed).collect())
    assert lines == sorted(r for r in rows if r[1])


def test_no_rows_give_no_archives(spark):
    assert zipped(spark.createDataFrame([], "file string, member string, text string"), nested=False).collect() == []
