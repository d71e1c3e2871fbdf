"""Company accounts: tagged documents to one row per company and reporting period.

Only opening one document stays in Python. It yields the tagged elements; which element fills which column,
the choice among several candidates and the layout by period are joins and aggregations.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import text as X
from tradeloom.session import materialize
from tradeloom.sources.archives import archive_documents

# Taxonomies reported in the result.
TAXONOMIES = [
    "http://www.xbrl.org/uk/fr/gaap/pt/2004-12-01",
    "http://www.xbrl.org/uk/gaap/core/2009-09-01",
    "http://xbrl.frc.org.uk/fr/2014-09-01/core",
]

# Where each column comes from, in order of preference. ``a`` is the tag in the ``name``
# attribute, ``e`` the element's own name, ``ea`` either; ``@text`` must and ``!text`` must not appear in
# the context reference; ``span`` takes the first span inside the tagged element.
GENERAL_RULES = {
    "balance_sheet_date": ("date", ["a BalanceSheetDate", "e BalanceSheetDate"]),
    "companies_house_registered_number": (
        "text",
        ["a UKCompaniesHouseRegisteredNumber", "e CompaniesHouseRegisteredNumber"],
    ),
    "entity_current_legal_name": (
        "text",
        ["a EntityCurrentLegalOrRegisteredName", "e EntityCurrentLegalName", "span EntityCurrentLegalOrRegisteredName"],
    ),
    "company_dormant": (
        "bool",
        ["a EntityDormantTruefalse", "a EntityDormant", "e CompanyDormant", "e CompanyNotDormant not"],
    ),
    "average_number_employees_during_period": (
        "prefixed",
        [
            "a AverageNumberEmployeesDuringPeriod",
            "a EmployeesTotal",
            "e AverageNumberEmployeesDuringPeriod",
            "e EmployeesTotal",
        ],
    ),
}
PERIOD_RULES = {
    "tangible_fixed_assets": ["ea FixedAssets", "ea TangibleFixedAssets", "a PropertyPlantEquipment"],
    "debtors": ["ea Debtors"],
    "cash_bank_in_hand": ["ea CashBankInHand", "a CashBankOnHand"],
    "current_assets": ["ea CurrentAssets"],
    "creditors_due_within_one_year": ["a CreditorsDueWithinOneYear", "a Creditors @WithinOneYear"],
    "creditors_due_after_one_year": ["a CreditorsDueAfterOneYear", "a Creditors @AfterOneYear"],
    "net_current_assets_liabilities": ["ea NetCurrentAssetsLiabilities"],
    "total_assets_less_current_liabilities": ["ea TotalAssetsLessCurrentLiabilities"],
    "net_assets_liabilities_including_pension_asset_liability": [
        "ea NetAssetsLiabilitiesIncludingPensionAssetLiability",
        "ea NetAssetsLiabilities",
    ],
    "called_up_share_capital": ["ea CalledUpShareCapital", "a Equity @ShareCapital"],
    "profit_loss_account_reserve": ["ea ProfitLossAccountReserve", "a Equity @RetainedEarningsAccumulatedLosses"],
    "shareholder_funds": ["ea ShareholderFunds", "a Equity !segment"],
    "turnover_gross_operating_revenue": ["ea TurnoverGrossOperatingRevenue", "ea TurnoverRevenue"],
    "other_operating_income": ["ea OtherOperatingIncome", "ea OtherOperatingIncomeFormat2"],
    "cost_sales": ["ea CostSales"],
    "gross_profit_loss": ["ea GrossProfitLoss"],
    "administrative_expenses": ["ea AdministrativeExpenses"],
    "raw_materials_consumables": ["ea RawMaterialsConsumables", "ea RawMaterialsConsumablesUsed"],
    "staff_costs": ["ea StaffCosts", "ea StaffCostsEmployeeBenefitsExpense"],
    "depreciation_other_amounts_written_off_tangible_intangible_fixed_assets": [
        "ea DepreciationOtherAmountsWrittenOffTangibleIntangibleFixedAssets",
        "ea DepreciationAmortisationImpairmentExpense",
    ],
    "other_operating_charges_format2": ["ea OtherOperatingChargesFormat2", "ea OtherOperatingExpensesFormat2"],
    "operating_profit_loss": ["ea OperatingProfitLoss"],
    "profit_loss_on_ordinary_activities_before_tax": ["ea ProfitLossOnOrdinaryActivitiesBeforeTax"],
    "tax_on_profit_or_loss_on_ordinary_activities": [
        "ea TaxOnProfitOrLossOnOrdinaryActivities",
        "ea TaxTaxCreditOnProfitOrLossOnOrdinaryActivities",
    ],
    "profit_loss_for_period": ["ea ProfitLoss", "ea ProfitLossForPeriod"],
}

NAME_COLUMNS = ["run_code", "company_id", "date", "file_type"]
SQL_TYPES = {"date": "date", "text": "string", "bool": "boolean", "prefixed": "decimal(38,6)", "number": "decimal(38,6)"}
ACCOUNTS_SCHEMA = ", ".join(
    [
        "run_code string, company_id string, date date, file_type string, taxonomy string",
        "period_start date, period_end date",
        *[f"{c} {SQL_TYPES[kind]}" for c, (kind, _) in GENERAL_RULES.items()],
        *[f"{c} {SQL_TYPES['number']}" for c in PERIOD_RULES],
    ]
)

ELEMENT_SCHEMA = (
    "doc string, kind string, position int, element string, tag string, context string, sign string, scale string, "
    "text string, period_start string, period_end string"
)
RULE_SCHEMA = (
    "attribute string, general boolean, type string, priority int, source string, name string, wanted string, "
    "unwanted string"
)


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as rows, one per name a rule looks for."""
    rows = []
    described = [(a, True, kind, rules) for a, (kind, rules) in GENERAL_RULES.items()]
    described += [(a, False, "number", rules) for a, rules in PERIOD_RULES.items()]
    for attribute, general, kind, rules in described:
        for priority, rule in enumerate(rules):
            source, name, *extra = rule.split()
            option = extra[0] if extra else ""
            wanted = option[1:] if option.startswith("@") else None
            unwanted = option[1:] if option.startswith("!") else None
            of_type = "reversed bool" if option == "not" else kind
            for one in {"ea": ["element", "tag"], "e": ["element"], "a": ["tag"], "span": ["span"]}[source]:
                rows.append((attribute, general, of_type, priority, one, name, wanted, unwanted))
    return spark.createDataFrame(rows, RULE_SCHEMA)


@lru_cache(4096)
def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def document_elements(doc: str, content: bytes) -> list[tuple]:
    """Namespaces, contexts and tagged elements of one document, or a single ``error`` row."""
    rows: list[tuple] = []
    positions = count()

    def add(kind, element=None, tag=None, at=None, text=None, start=None, end=None):
        get = at.get if at is not None else lambda *_: None
        rows.append(
            (doc, kind, next(positions), element, tag, get("contextRef"), get("sign"), get("scale"), text, start, end)
        )

    try:
        parser = ET.XMLPullParser(["start", "start-ns"])
        parser.feed(content)
        parser.close()
        root = None
        for event, item in parser.read_events():
            if event == "start-ns":
                add("namespace", text=item[1])
            else:
                root = item
                break  # namespaces of inner elements do not count
        for element in root.iter():
            name, tag = _local(element.tag), (element.get("name") or "").rsplit(":", 1)
            parts = {_local(p.tag): p for p in element.iter()} if name == "context" else {}
            if "period" in parts:
                day = parts.get("instant")
                start, end = (day, day) if day is not None else (parts.get("startDate"), parts.get("endDate"))
                if start is not None and end is not None:
                    add("context", tag=element.get("id"), start=start.text, end=end.text)
                continue
            suffix = tag[1] if len(tag) == 2 else None
            if suffix or element.get("contextRef") or name[:1].isupper():
                add("element", name, suffix, element, element.text)
            if suffix:
                span = next((s for s in element.iter() if s is not element and _local(s.tag) == "span"), None)
                if span is not None:
                    add("span", "span", suffix, span, span.text)
    except ET.ParseError as e:
        return [(doc, "error", 0, None, None, None, None, None, str(e), None, None)]
    return rows


# Elements handed to Spark at a time.
BATCH_ELEMENTS = 20_000


def read_elements(documents: DataFrame) -> DataFrame:
    names = re.findall(r"(\w+) \w+(?:,|$)", ELEMENT_SCHEMA)
    types = [pa.int32() if name == "position" else pa.string() for name in names]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += document_elements(doc, content)
                if len(rows) > BATCH_ELEMENTS:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    return documents.select("document", "content").mapInArrow(parse, ELEMENT_SCHEMA)


def typed_text(kind: Column, clean: Column) -> Column:
    """A cleaned value of a text, date or yes/no type in its standard spelling; unreadable values are NULL.

    The many date formats stand in a lambda: in the code made for every row they would keep the JVM from compiling it.
    """
    return (
        F.when(kind == "date", F.transform(F.array(clean), lambda c: X.free_date(c))[0].cast("string"))
        .when(kind == "bool", X.strict_bool(clean).cast("string"))
        .when(kind == "reversed bool", X.strict_bool(clean, reverse=True).cast("string"))
        .when(kind == "text", clean)
    )


def typed_number(kind: Column, clean: Column, sign: Column, scale: Column) -> Column:
    bare = F.when(kind == "prefixed", F.regexp_replace(clean, ".*: ", "")).when(kind == "number", clean)
    return X.scaled_number(bare, sign, scale)


def candidate_values(elements: DataFrame, rules: DataFrame) -> DataFrame:
    """Elements that a rule points to, with the typed value; the rule table is a fixed short list."""
    named = F.when(F.col("kind") == "span", F.array(F.struct(F.lit("span").alias("source"), F.col("tag").alias("name"))))
    named = named.otherwise(
        F.array(
            F.struct(F.lit("element").alias("source"), F.col("element").alias("name")),
            F.struct(F.lit("tag").alias("source"), F.col("tag").alias("name")),
        )
    )
    read = ["doc", "position", "context", "sign", "scale", "text"]
    names = elements.where(F.col("kind").isin("element", "span")).select(*read, F.explode(named).alias("n"))
    context = F.coalesce("context", F.lit(""))
    chosen = (
        names.select(*read, "n.source", "n.name")
        .join(F.broadcast(rules), ["source", "name"])
        .where(F.col("wanted").isNull() | F.contains(context, F.col("wanted")))
        .where(F.col("unwanted").isNull() | ~F.contains(context, F.col("unwanted")))
    )
    # Only what a rule points to is cleaned, once a row.
    return chosen.withColumn("clean", X.clean_value(F.col("text"))).select(
        "doc", "position", "context", "attribute", "general", "priority",
        typed_text(F.col("type"), F.col("clean")).alias("value"),
        typed_number(F.col("type"), F.col("clean"), F.col("sign"), F.col("scale")).alias("number"),
        F.col("type").isin("number", "prefixed").alias("numeric"), "clean",
    )


def period_values(candidates: DataFrame, contexts: DataFrame, attributes: list[str]) -> DataFrame:
    """One row per document and period: the first usable value by rule, then by place in the document.

    A period exists as soon as a rule's element refers to it, even when the value is blank.
    """
    usable = F.when(F.col("number").isNotNull(), F.struct("priority", "position"))
    period = ["doc_hash", "doc", "period_start", "period_end"]
    # Dealt out by document once: both groupings and the join with the other columns keep to that. Names of documents
    # begin alike, so rows are sorted by their hash first.
    best = (
        candidates.where(~F.col("general"))
        .join(contexts, ["doc", "context"])
        .select("attribute", "priority", "position", "number", F.xxhash64("doc").alias("doc_hash"), *period[1:])
        .repartition("doc")
        .groupBy(*period, "attribute")
        .agg(F.min_by("number", usable).alias("number"))
    )
    return best.groupBy(*period).agg(
        *[F.max(F.when(F.col("attribute") == a, F.col("number"))).alias(a) for a in attributes]
    ).drop("doc_hash")


def general_values(candidates: DataFrame, attributes: list[str]) -> DataFrame:
    """One row per document: the first rule whose last element is usable."""
    value = F.coalesce("value", F.col("number").cast("string"))
    last = (
        candidates.where(F.col("general") & F.col("doc").isNotNull())
        .repartition("doc")
        .groupBy("doc", "attribute", "priority")
        .agg(F.max_by(value, "position").alias("value"))
        .where("value is not null")
    )
    return last.groupBy("doc").agg(
        *[F.min_by("value", F.when(F.col("attribute") == a, F.col("priority"))).alias(a) for a in attributes]
    )


def period_date(column: str) -> Column:
    """A date of a context; one that cannot be read is NULL and reported by ``document_errors``."""
    return F.trim(column).try_cast("date")


def accounts_rows(elements: DataFrame, rules: DataFrame) -> DataFrame:
    """Wide rows; a document without any period still gives one row."""
    # A document without any of these is one still: a flag for each taxonomy needs no list and no join.
    named = [F.max((F.col("kind") == "namespace") & (F.col("text") == name)) for name in TAXONOMIES]
    used = F.array(*[F.when(flag, F.lit(name)) for flag, name in zip(named, TAXONOMIES)])
    documents = (
        elements.where("kind <> 'error'")
        .groupBy("doc")
        .agg(X.joined_allowed(used, TAXONOMIES).alias("taxonomy"))
        .withColumn("taxonomy", F.when(F.col("doc").isNotNull(), F.col("taxonomy")))
    )
    contexts = (
        elements.where("kind = 'context'")
        .groupBy(F.xxhash64("doc").alias("doc_hash"), "doc", F.col("tag").alias("context"))
        .agg(F.max_by(F.struct("period_start", "period_end"), "position").alias("p"))
        .select("doc", "context", "p.*")
    )
    candidates = candidate_values(elements, rules)
    names = X.document_name_parts(F.col("doc"))
    return (
        documents
        .join(general_values(candidates, list(GENERAL_RULES)), "doc", "left")
        .join(period_values(candidates, contexts, list(PERIOD_RULES)), "doc", "left")
        .select(
            *[names[c].alias(c) for c in NAME_COLUMNS],
            F.coalesce("taxonomy", F.lit("")).alias("taxonomy"),
            period_date("period_start").alias("period_start"),
            period_date("period_end").alias("period_end"),
            *[F.col(c).try_cast(SQL_TYPES[kind]).alias(c) for c, (kind, _) in GENERAL_RULES.items()],
            *[F.col(c) for c in PERIOD_RULES],
        )
    )


def document_errors(elements: DataFrame, rules: DataFrame) -> DataFrame:
    """``(doc, message)``: unreadable documents and dates, odd names, elements with an undefined context, and numbers
    that cannot be read."""
    broken = elements.where("kind = 'error'").select("doc", F.col("text").alias("message"))
    odd = (
        elements.select("doc").distinct().where(~F.col("doc").rlike(X.ACCOUNTS_DOCUMENT))
        .select("doc", F.lit("unexpected document name").alias("message"))
    )
    contexts = elements.where("kind = 'context'").select("doc", F.col("tag").alias("context")).distinct()
    undefined = (
        candidate_values(elements, rules)
        .where(~F.col("general") & F.col("context").isNotNull())
        .select("doc", "context").distinct()
        .join(contexts, ["doc", "context"], "left_anti")
        .select("doc", F.concat(F.lit("undefined context "), F.col("context")).alias("message"))
    )
    days = F.explode(F.array("period_start", "period_end"))
    dates = (
        elements.where("kind = 'context'").select("doc", "tag", days.alias("day"))
        .where(F.col("day").isNotNull() & F.trim("day").try_cast("date").isNull()).distinct()
        .select("doc", F.concat(F.lit("unreadable date "), F.col("day"), F.lit(" in context "), F.coalesce("tag", F.lit(""))).alias("message"))
    )
    numbers = (
        candidate_values(elements, rules)
        .where(F.col("numeric") & F.col("clean").isNotNull() & F.col("number").isNull())
        .select("doc", F.concat(F.lit("unreadable number "), F.col("clean"), F.lit(" for "), F.col("attribute")).alias("message"))
        .distinct()
    )
    return broken.unionByName(odd).unionByName(undefined).unionByName(dates).unionByName(numbers)


def read_accounts_with_errors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Accounts of all archives under ``path``, and what could not be read. Elements are written once for all branches."""
    elements = materialize(read_elements(archive_documents(spark, path)), "accounts-elements")
    rules = rule_table(spark)
    return accounts_rows(elements, rules), document_errors(elements, rules)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_accounts_with_errors(spark, path)[0]
