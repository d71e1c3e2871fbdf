import datetime as dt
import io
import zipfile
from decimal import Decimal

from pyspark.sql import functions as F

from tradeloom.plans import accounts
from tradeloom.sources.archives import archive_documents

IXBRL = """<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2008/inlineXBRL" xmlns:u="http://xbrl.frc.org.uk/fr/2014-09-01/core">
<context id="now"><entity/><period><instant>2020-03-31</instant></period></context>
<context id="then"><period><startDate>2018-04-01</startDate><endDate>2019-03-31</endDate></period></context>
<context id="now_WithinOneYear"><period><instant>2020-03-31</instant></period></context>
<p><ix:nonNumeric name="u:EntityCurrentLegalOrRegisteredName"> <span>Acme "X"
Ltd</span></ix:nonNumeric></p>
<ix:nonNumeric name="u:BalanceSheetDate" contextRef="now">31 March 2020</ix:nonNumeric>
<ix:nonNumeric name="u:UKCompaniesHouseRegisteredNumber">12345</ix:nonNumeric>
<ix:nonNumeric name="u:EntityDormantTruefalse">maybe</ix:nonNumeric>
<ix:nonNumeric name="u:EntityDormant">false</ix:nonNumeric>
<ix:nonFraction name="u:EmployeesTotal" contextRef="now">Staff: 7</ix:nonFraction>
<ix:nonFraction name="u:Debtors" contextRef="now" scale="3">1,234</ix:nonFraction>
<ix:nonFraction name="u:Debtors" contextRef="now">5</ix:nonFraction>
<ix:nonFraction name="u:Debtors" contextRef="then"> - </ix:nonFraction>
<ix:nonFraction name="u:Creditors" contextRef="now_WithinOneYear" sign="-">10.5</ix:nonFraction>
<ix:nonFraction name="u:Equity" contextRef="then">77</ix:nonFraction>
<ix:nonFraction name="u:CashBankOnHand" contextRef="nowhere">1</ix:nonFraction>
</html>"""

XBRL = """<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:pt="http://www.xbrl.org/uk/fr/gaap/pt/2004-12-01">
<pt:CompaniesHouseRegisteredNumber>1234</pt:CompaniesHouseRegisteredNumber>
<pt:EntityCurrentLegalName>First</pt:EntityCurrentLegalName>
<pt:EntityCurrentLegalName>Second</pt:EntityCurrentLegalName>
<pt:CompanyNotDormant>true</pt:CompanyNotDormant>
</x:xbrl>"""


def test_documents_to_rows(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("Prod9_11_12345_20200331.html", IXBRL)
        z.writestr("Prod9_12_1234_20170227.xml", XBRL)
        z.writestr("Prod9_12_9_20170227.xml", "<broken")
    (tmp_path / "accounts.zip").write_bytes(buffer.getvalue())

    documents = archive_documents(spark, str(tmp_path))
    elements = accounts.read_elements(documents).cache()
    rules = accounts.rule_table(spark)
    errors = {r.doc.split("_")[2]: r.message for r in accounts.document_errors(elements, rules).collect()}
    assert set(errors) == {"9", "12345"} and errors["12345"] == "undefined context nowhere"

    rows = accounts.read_accounts(spark, str(tmp_path))
    assert rows.columns == [f.name for f in spark.createDataFrame([], accounts.ACCOUNTS_SCHEMA).schema]
    by_key = {(r.company_id, r.period_end): r for r in rows.collect()}
    assert set(by_key) == {("12345", dt.date(2020, 3, 31)), ("12345", dt.date(2019, 3, 31)), ("1234", None)}

    now = by_key[("12345", dt.date(2020, 3, 31))]
    assert (now.run_code, now.date, now.file_type) == ("Prod9_11", dt.date(2020, 3, 31), "html")
    assert now.taxonomy == "http://xbrl.frc.org.uk/fr/2014-09-01/core"
    assert now.period_start == dt.date(2020, 3, 31)
    assert now.entity_current_legal_name == "Acme X Ltd"
    assert now.balance_sheet_date == dt.date(2020, 3, 31)
    assert now.company_dormant is False
    assert now.average_number_employees_during_period == 7
    assert now.debtors == 1234000
    assert now.creditors_due_within_one_year == Decimal("-10.5")
    assert now.shareholder_funds is None and now.cash_bank_in_hand is None

    then = by_key[("12345", dt.date(2019, 3, 31))]
    assert then.period_start == dt.date(2018, 4, 1)
    assert then.debtors is None and then.shareholder_funds == 77

    bare = by_key[("1234", None)]
    assert bare.entity_current_legal_name == "Second"
    assert bare.company_dormant is False
    assert bare.taxonomy == "http://www.xbrl.org/uk/fr/gaap/pt/2004-12-01"


def test_bad_cells_are_reported_and_stop_nothing(spark, tmp_path):
    bad = IXBRL.replace("<instant>2020-03-31", "<instant>31 March 2020").replace('scale="3"', 'scale="40"')
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("Prod9_11_1_20200331.html", IXBRL)
        z.writestr("Prod9_11_2_20200331.html", bad)
    with zipfile.ZipFile(tmp_path / "accounts.zip", "w") as z:
        z.writestr("nested.zip", inner.getvalue())
        z.writestr("Prod9_11_3_20200331.html", "")
    rows, errors = accounts.read_accounts_with_errors(spark, str(tmp_path))
    assert {r.company_id for r in rows.collect()} == {"1", "2"}
    messages = {(r.doc.split("_")[2], r.message) for r in errors.collect()}
    assert ("2", "unreadable date 31 March 2020 in context now") in messages
    assert ("2", "unreadable number 1,234 for debtors") in messages
    assert {d for d, _ in messages} == {"1", "2", "3"}  # all have the undefined context but the empty one
    debtors = [r.debtors for r in rows.where("company_id = '2'").collect()]
    assert 5 in debtors  # the next candidate takes the place of the number that does not fit


def test_every_rule_names_a_known_shape(spark):
    rules = accounts.rule_table(spark)
    assert rules.select(F.countDistinct("attribute")).first()[0] == 30
    assert rules.where("name is null or source not in ('element', 'tag', 'span')").isEmpty()
