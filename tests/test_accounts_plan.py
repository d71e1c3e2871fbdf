from tradeloom.plans import accounts
from tradeloom.sources.archives import documents_of

TAXONOMY = accounts.TAXONOMIES[2]


def elements(spark):
    rows = [
        (doc, kind, i, None, tag, context, None, None, text, day, day)
        for doc in ("Prod1_1_7_20200331.html", "Prod1_1_8_20200331.xml", None)
        for i, (kind, tag, context, text, day) in enumerate(
            [
                ("namespace", None, None, TAXONOMY, None), ("namespace", None, None, "http://other", None),
                ("context", "now", None, None, "2020-03-31"), ("element", "Debtors", "now", " 12 ", None),
                ("element", "Debtors", "now", "13", None), ("element", "EntityDormant", None, "true", None),
                ("element", "BalanceSheetDate", None, "31 March 2020", None), ("element", "Unknown", "now", "1", None),
            ]
        )
    ]
    rows += [("Prod1_1_9_20200331.xml", "element", 0, "Other", None, None, None, None, "x", None, None)]
    rows += [("Prod1_1_10_20200331.xml", "error", 0, None, None, None, None, None, "broken", None, None)]
    return spark.createDataFrame(rows, accounts.ELEMENT_SCHEMA)


def test_rows_of_documents_with_and_without_a_name(spark):
    rows = accounts.accounts_rows(elements(spark), accounts.rule_table(spark))
    got = {
        (r.company_id, r.taxonomy, str(r.period_end), r.debtors, str(r.balance_sheet_date), r.company_dormant)
        for r in rows.collect()
    }
    full = (TAXONOMY, "2020-03-31", 12, "2020-03-31", True)
    assert got == {("7", *full), ("8", *full), ("9", "", "None", None, "None", None), (None, "", "None", None, "None", None)}


def test_documents_are_dealt_out_few_times_and_read_without_frames(spark):
    rows = accounts.accounts_rows(elements(spark), accounts.rule_table(spark))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 6
    archives = spark.createDataFrame([], "file string, content binary")
    read = accounts.read_elements(documents_of(archives))
    assert "MapInPandas" not in read._jdf.queryExecution().executedPlan().toString()
    assert read.collect() == []
