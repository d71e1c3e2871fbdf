import datetime as dt
import io
import zipfile
from decimal import Decimal

import pytest

from tradeloom.operators.store import LayerStore
from tradeloom.plans import datasets as D
from tradeloom.plans import ingest


def zipped(**files: bytes | str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in files.items():
            z.writestr(name, content)
    return buffer.getvalue()


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "store"))


def l1(store, spec):
    table = store.read(ingest.layer(spec, "L1"))
    return [tuple(r) for r in table.select(*spec.l1_columns).collect()]


def exporter_archive():
    def line(*cells):
        return "\t".join(cells)

    first = "\r\n".join(
        [
            line("201601", "1", '"Abc Company" LTD ', "1 - 3", "", "Street Avenue", "House Name", "City Name", "aa1 1aa", "12345678", "", "23456789"),
            line("201601", "1", "too short"),
            line("201602", "1", "Café ™", "", "", "", "", "", "BB1 1BB", ""),
        ]
    ).encode("mac-roman")
    second = line("201602", "1", "bbb limited", "", "", "", "", "", "x y", "98765432").encode()
    return zipped(**{"jan.zip": zipped(**{"jan.txt": first, "ignored.txt": b"x"}), "feb.txt": second})


def test_exporters(store, tmp_path):
    path = tmp_path / "exporters_2016.zip"
    path.write_bytes(exporter_archive())
    ingest.load_file(D.EXPORTERS, store, str(path))
    jan, feb = dt.datetime(2016, 1, 1), dt.datetime(2016, 2, 1)
    expected = [
        (jan, "abc company ltd", "1 - 3  street avenue house name city name", "AA11AA", ["12345678", "23456789"]),
        (feb, "café ™", None, "BB11BB", []),
        (feb, "bbb limited", None, "XY", ["98765432"]),
    ]
    assert sorted(l1(store, D.EXPORTERS), key=str) == sorted(expected, key=str)
    # no rows are matched: the same file again doubles them
    ingest.load_file(D.EXPORTERS, store, str(path))
    assert len(l1(store, D.EXPORTERS)) == 6
    ids = [r.id for r in store.read(ingest.layer(D.EXPORTERS, "L0")).collect()]
    assert len(set(ids)) == 6


def postcode_line(**cells):
    return ",".join(f'"{cells.get(c, "")}"' for c in D.POSTCODE_FIELDS.split())


def test_postcode_directory(store, tmp_path):
    header = ",".join(D.POSTCODE_FIELDS.split())
    body = "\n".join([header, postcode_line(pcd="AB1 0AA", dointr="198001", doterm="199606", ctry="S1"), postcode_line(pcd="AB1 0AB", dointr="198001")])
    path = tmp_path / "ONSPD_MAY_2019_UK.zip"
    path.write_bytes(zipped(**{"User Guide/notes.txt": "x,y", "Data/ONSPD_MAY_2019_UK.csv": body}))
    ingest.load_file(D.POSTCODE_DIRECTORY, store, str(path))
    rows = store.read(ingest.layer(D.POSTCODE_DIRECTORY, "L1")).orderBy("pcd").collect()
    assert [(r.pcd, r.dointr, r.doterm, r.ctry, r.publication_date) for r in rows] == [
        ("AB1 0AA", dt.date(1980, 1, 1), dt.date(1996, 6, 1), "S1", dt.date(2019, 5, 1)),
        ("AB1 0AB", dt.date(1980, 1, 1), None, None, dt.date(2019, 5, 1)),
    ]


def test_archive_without_the_wanted_member(store, tmp_path):
    path = tmp_path / "wrong.zip"
    path.write_bytes(zipped(**{"Data/other.csv": "a,b"}))
    with pytest.raises(Exception, match="no file in wrong.zip matches"):
        ingest.load_file(D.POSTCODE_DIRECTORY, store, str(path))


def test_country_codes_with_bare_cr_and_a_mark(store, tmp_path):
    lines = ["code,name,full,abbr,comments,iso2,iso3,start,end", '4,"Afghanistan",Afghanistan,,,AF,AFG,1962,Now', '384,"Côte d\'Ivoire – x",,,,CI,CIV,1962,Now']
    path = tmp_path / "country_list.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\r".join(lines).encode("cp1252"))
    ingest.load_file(D.COUNTRY_CODES, store, str(path))
    assert sorted(r[:2] + (r[6],) for r in l1(store, D.COUNTRY_CODES)) == [(4, "Afghanistan", "AFG"), (384, "Côte d'Ivoire – x", "CIV")]


def test_raw_tariff_with_spaces_and_empty_cells(store, tmp_path):
    path = tmp_path / "tariff.csv"
    path.write_text('Reporter,Year,Product,Partner,Type,Avg,Lines\n"048", 2018, "010121", "000", "AHS", 5.5, 2\n"048",2018,"010121","036","MFN","",""\n')
    ingest.load_file(D.RAW_TARIFF, store, str(path))
    rows = store.read(ingest.layer(D.RAW_TARIFF, "L0")).orderBy("partner").collect()
    assert [(r.reporter, r.product, r.partner, r.duty_type, r.simple_average, r.number_of_total_lines) for r in rows] == [
        (48, 10121, 0, "AHS", Decimal("5.5"), 2),
        (48, 10121, 36, "MFN", None, None),
    ]
    assert not store.exists(ingest.layer(D.RAW_TARIFF, "L1"))


def test_bound_rates_keep_the_latest_revision_of_a_file(store, tmp_path):
    first, second = tmp_path / "a.csv", tmp_path / "b.csv"
    first.write_text("nomen,reporter,product,rate,lines\nH0,36,10121,0.0,1\nH5,36,10121,7.5,1\nH4,36,10121,9,1\nH1,48,10121,35,1\n")
    second.write_text("nomen,reporter,product,rate,lines\nH1,36,10121,2,1\nH5,36,10121,7.5,1\n")
    ingest.load_file(D.BOUND_RATES, store, str(first))
    assert sorted(l1(store, D.BOUND_RATES)) == [(36, 10121, Decimal("7.5")), (48, 10121, Decimal("35"))]
    ingest.load_file(D.BOUND_RATES, store, str(second))
    assert sorted(l1(store, D.BOUND_RATES)) == [(36, 10121, Decimal("2")), (36, 10121, Decimal("7.5")), (48, 10121, Decimal("35"))]
    ingest.load_file(D.BOUND_RATES, store, str(second))
    assert len(l1(store, D.BOUND_RATES)) == 3


def test_membership_years_become_rows(store, tmp_path):
    years = [str(y) for y in D.MEMBERSHIP_YEARS]
    path = tmp_path / "eu.csv"
    path.write_text("\n".join([",".join(["Country", "ISO3", *years]), ",".join(["Slovenia", "SVN", *["EUN" if int(y) >= 2004 else "" for y in years]])]))
    ingest.load_file(D.EU_MEMBERSHIP, store, str(path))
    rows = l1(store, D.EU_MEMBERSHIP)
    assert len(rows) == 61
    assert ("Slovenia", "SVN", 2003, None) in rows and ("Slovenia", "SVN", 2004, "EUN") in rows
    ingest.load_file(D.EU_MEMBERSHIP, store, str(path))
    assert len(l1(store, D.EU_MEMBERSHIP)) == 122


def test_trade_flows(store, tmp_path):
    path = tmp_path / "baci.csv"
    path.write_text("t,hs6,i,j,v,q\n2018,10121,36,48,1.5,\n")
    ingest.load_file(D.TRADE_FLOWS, store, str(path))
    assert l1(store, D.TRADE_FLOWS) == [(2018, 10121, 36, 48, Decimal("1.5"), None)]


def test_reference_postcodes_snapshot(store, tmp_path):
    columns = D.REFERENCE_POSTCODES.l1_columns
    def row(postcode, region):
        return ",".join(f'"{v}"' for v in [postcode, *[""] * 7, region, "", "", "1980-01-01", ""])

    path = tmp_path / "s.csv"
    path.write_text("\n".join([",".join(columns), row("AB1", 'East "A"'), row("AB1", 'East "A"')]).replace('"A"', '""A""'))
    ingest.load_file(D.REFERENCE_POSTCODES, store, str(path))
    (only,) = l1(store, D.REFERENCE_POSTCODES)
    assert (only[0], only[1], only[8], only[11], only[12]) == ("AB1", None, "East A", dt.date(1980, 1, 1), None)
