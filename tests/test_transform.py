import pytest

from tradeloom.operators.store import LayerStore
from tradeloom.plans import datasets as D
from tradeloom.plans import ingest, transform


@pytest.fixture
def store(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    years = [str(y) for y in D.MEMBERSHIP_YEARS]
    files = {
        "dit.eu_country_membership": "\n".join([",".join(["c", "i", *years]), ",".join(["Spain", "ESP", *["EUN"] * 61])]),
        "comtrade.country_code_and_iso": "\n".join(
            ["a,b,c,d,e,f,g,h,i"] + [f"{n},{i},,,,,{i},," for n, i in ((12, "DZA"), (76, "BRA"), (724, "ESP"))]
        ),
        "world_bank.bound_rates": "n,r,p,b,l\nH1,12,201,40,1\nH2,12,201,50,1\n",
        "world_bank.tariff": "r,y,p,t,d,s,n\n12,2018,201,76,AHS,21,1\n12,2018,301,0,MFN,7,1\n",
    }
    paths = {}
    for name, text in files.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text + "\n")
        paths[name] = [str(path)]
    order = ingest.run_group(D.ALL, ["world_bank.tariff"], store, paths)
    assert order[-1] == "world_bank.tariff" and len(order) == 4
    return store


def cube(store, spark, **options):
    required = spark.createDataFrame([("DZA", 12, True), ("BRA", 76, True), ("ESP", 724, True)], "iso3 string, iso_num int, requirement boolean")
    table = transform.transform_tariffs(store, required=required, first_year=2018, last_year=2018, **options)
    return {(r["product"], r.reporter, r.partner): (r.assumed_tariff, r.bnd_rate) for r in table.collect()}


def test_files_to_published_cube(spark, store):
    first = cube(store, spark, products="301")
    assert {k[0] for k in first} == {301} and first[(301, 12, 76)] == (7, None)

    resumed = cube(store, spark, resume=True)
    assert {k[0] for k in resumed} == {201, 301} and len(resumed) == 12
    assert resumed[(201, 12, 76)] == (21, 50)
    assert store.read(transform.PUBLISHED).count() == 12

    again = cube(store, spark, resume=True)
    assert again == resumed

    assert {k[0] for k in cube(store, spark, products="201")} == {201}
    assert [r.version for r in store.versions(transform.PUBLISHED).orderBy("version").collect()] == [1, 2, 3, 4]
