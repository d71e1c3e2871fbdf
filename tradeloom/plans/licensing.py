"""The licensing schema: 25 tables with their types, keys and checks, in load order.

A table is described in a few lines: its columns with types (``!`` marks a required column), its primary
key, its checks and its references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.quality import ForeignKey, TableRules, table_report
from tradeloom.operators.store import LayerStore
from tradeloom.session import materialize
from tradeloom.sources.delimited import read_by_name


class LoadRejected(ValueError):
    """A file breaks the rules of its table; nothing of it was loaded."""


def _table(name: str, columns: str, key: str, checks: dict[str, str] | None = None, refs: dict[str, str] | None = None) -> TableRules:
    schema, required = [], []
    for item in columns.split(", "):
        column, kind = item.split()
        schema.append(f"`{column}` {kind.rstrip('!')}")
        if kind.endswith("!"):
            required.append(column)
    references = []
    for column, target in (refs or {}).items():
        parent, parent_column = target.split(".")
        references.append(ForeignKey((column,), parent, (parent_column,)))
    return TableRules(name, ", ".join(schema), tuple(key.split()), tuple(required), checks or {}, tuple(references))


# The code lists that the checks below compare with.
CASE_TYPES = "'SIEL', 'OIEL', 'SITCL', 'OITCL', 'OGEL', 'GPL', 'TA_SIEL', 'TA_OIEL'"
PLAIN_CASE_TYPES = "'SITCL', 'OITCL', 'OGEL', 'GPL', 'TA_SIEL', 'TA_OIEL'"
SIEL_SUB_TYPES = "'PERMANENT', 'TEMPORARY', 'TRANSHIPMENT'"
OIEL_SUB_TYPES = "'DEALER', 'MEDIA', 'MIL_DUAL', 'UKCONTSHELF', 'CRYPTO'"
BATCH_STATUSES = "'RELEASED', 'STAGING'"
WITHHELD_STATUSES = "'PENDING', 'WITHHELD'"
GOODS_INCIDENT_TYPES = "'REFUSAL', 'ISSUE', 'REVOKE', 'SURRENDER'"
INCIDENT_TYPES = "'REFUSAL', 'ISSUE', 'REDUCTION', 'REVOKE', 'DEREGISTRATION', 'SUSPENSION', 'SURRENDER'"
INCIDENT_STATUSES = "'READY', 'FOR_ATTENTION'"
FOOTNOTE_STATUSES = "'CURRENT', 'DELETED', 'ARCHIVED'"
MEDIA_FOOTNOTE_TYPES = "'STANDARD', 'END_USER'"
RETURN_STATUSES = "'WITHDRAWN', 'ACTIVE'"
RETURN_CONTROLS = "'A', 'P', 'C'"
END_USER_CONTROLS = "'A', 'P', 'C', 'D'"
RETURN_LICENCES = "'OGEL', 'OIEL', 'OITCL'"

# Two case types have sub types of their own, the others have none.
SUB_TYPE_FITS = f"""case case_type when 'SIEL' then case_sub_type in ({SIEL_SUB_TYPES})
    when 'OIEL' then case_sub_type in ({OIEL_SUB_TYPES})
    else case_sub_type is null and case_type in ({PLAIN_CASE_TYPES}) end"""
# A record without an end is the current one; an ended one has no control any more.
OPEN_WHEN_CURRENT = "if(end_datetime is null, status_control = 'C', status_control is null)"


def _only_for(column: str, value: str, other: str) -> str:
    """``other`` is filled exactly when ``column`` has ``value``."""
    return f"({column} = '{value}' and {other} is not null) or ({column} != '{value}' and {other} is null)"


def _pattern(filled: str, empty: str) -> str:
    return " and ".join([f"{c} is not null" for c in filled.split()] + [f"{c} is null" for c in empty.split()])


def _any_of(*patterns: tuple[str, str]) -> str:
    return " or ".join(f"({_pattern(filled, empty)})" for filled, empty in patterns)


FLAGS = ["temporary_licence_flag", "licence_conversion_flag", "incorporation_flag", "mil_flag", "other_flag", "torture_flag"]
TO_BATCH = {"batch_id": "batches.id"}
TO_APPLICATION = {"ela_grp_id": "applications.ela_grp_id"}

TABLES = [
    _table(
        "batches",
        "id int, batch_ref string!, status string!, start_date timestamp, end_date timestamp, approve_date timestamp!, "
        "release_date timestamp, staging_date timestamp",
        "id",
        {
            "status": f"status in ({BATCH_STATUSES})",
            # Corrections (C...) cover no days; every other batch covers whole days, the last not before the first.
            "dates": """case when batch_ref like 'C%' then coalesce(start_date, end_date) is null
                when batch_ref is not null then coalesce(
                    datediff(end_date, start_date) >= 0 and start_date = to_date(start_date) and end_date = to_date(end_date),
                    false) end""",
        },
    ),
    _table("country_groups", "id int", "id"),
    _table(
        "end_users",
        "eu_id int, version_number int, ela_grp_id int, end_user_type string, country_id int, end_user_count int, "
        "start_date timestamp, status_control string, batch_id int",
        "eu_id version_number",
    ),
    _table("footnotes", "id int, text string, status string!", "id", {"status": f"status in ({FOOTNOTE_STATUSES})"}),
    _table("media_footnotes", "id int", "id"),
    _table(
        "media_footnote_countries",
        "id int, ela_grp_id int!, mf_grp_id int!, country_id int!, country_name string!, status_control string, "
        "start_datetime timestamp!, end_datetime timestamp",
        "id",
        {"open when current": OPEN_WHEN_CURRENT},
    ),
    _table(
        "ogl_types",
        "id int, title string!, start_datetime timestamp!, end_datetime timestamp, display_order int, f680_flag string",
        "id",
    ),
    _table("ref_ars_subjects", "ars_value string, ars_subject string!", "ars_value"),
    _table("ref_country_mappings", "country_id int, country_name string!", "country_id"),
    _table("ref_do_not_report_values", "dnr_type string, dnr_value string", "dnr_type dnr_value"),
    _table("ref_report_ratings", "rating string, report_rating string!", "rating"),
    _table(
        "applications",
        "ela_grp_id int, case_type string!, case_sub_type string, initial_processing_time int!, "
        "case_closed_date timestamp!, withheld_status string, batch_id int!, ela_id int",
        "ela_grp_id",
        {
            "case type": f"case_type in ({CASE_TYPES})",
            "case sub type": SUB_TYPE_FITS,
            "withheld status": f"withheld_status is null or withheld_status in ({WITHHELD_STATUSES})",
        },
        TO_BATCH,
    ),
    _table("country_group_entries", "cg_id int, country_id int", "cg_id country_id", refs={"cg_id": "country_groups.id"}),
    _table(
        "media_footnote_details",
        "id int, mf_id int!, status_control string, start_datetime timestamp!, end_datetime timestamp, "
        "footnote_type string!, display_text string!, single_footnote_text string!, joint_footnote_text string",
        "id",
        {"open when current": OPEN_WHEN_CURRENT, "footnote type": f"footnote_type in ({MEDIA_FOOTNOTE_TYPES})"},
        {"mf_id": "media_footnotes.id"},
    ),
    _table(
        "returns",
        "elr_id int, elr_version int, status string!, created_datetime timestamp!, status_control string!, batch_id int!, "
        "licence_type string!, el_id int!, ogl_id int, return_period_date timestamp, end_country_id int, usage_count int, "
        "end_user_type string, eco_comment string",
        "elr_id elr_version",
        {
            "version": "elr_version > 0",
            "status": f"status in ({RETURN_STATUSES})",
            "status control": f"status_control in ({RETURN_CONTROLS})",
            "licence type": f"licence_type in ({RETURN_LICENCES})",
            "general licence": _only_for("licence_type", "OGEL", "ogl_id"),
        },
        TO_BATCH,
    ),
    _table(
        "application_amendments",
        "ela_grp_id int, ela_id int, case_type string!, case_sub_type string, case_processing_time int!, "
        "amendment_closed_date timestamp!, withheld_status string, batch_id int!",
        "ela_grp_id ela_id",
        refs=TO_APPLICATION,
    ),
    _table(
        "application_countries",
        "ela_grp_id int, country_id int, report_date timestamp!, start_date timestamp!, batch_id int!",
        "ela_grp_id country_id",
        refs={**TO_APPLICATION, **TO_BATCH},
    ),
    _table(
        "footnote_entries",
        "fne_id int, fn_id int, ela_grp_id int!, goods_item_id int, country_id int, fnr_id int, start_date timestamp!, "
        "version_no int!, batch_id int!, status_control string!, mfd_id int, mf_grp_id int, mf_free_text string",
        "fne_id version_no",
        {
            "subject": _any_of(
                ("", "goods_item_id country_id fnr_id"),
                ("goods_item_id", "country_id fnr_id"),
                ("country_id", "goods_item_id fnr_id"),
                ("country_id fnr_id", "goods_item_id"),
            ),
            "version": "version_no >= 0",
            "shape": _any_of(
                ("fn_id", "mfd_id mf_free_text mf_grp_id"),
                ("mfd_id mf_grp_id", "fn_id mf_free_text"),
                ("mf_free_text mf_grp_id", "fn_id mfd_id"),
            ),
        },
        {"fn_id": "footnotes.id", **TO_APPLICATION, **TO_BATCH, "mfd_id": "media_footnote_details.id"},
    ),
    _table(
        "goods_incidents",
        "id int, inc_id int!, type string!, goods_item_id int!, dest_country_id int!, source_country_grp_id int, "
        "report_date timestamp!, ela_grp_id int!, start_date timestamp!, version_no int!, batch_id int!, status_control string!",
        "id",
        {"type": f"type in ({GOODS_INCIDENT_TYPES})", "version": "version_no >= 0"},
        {"source_country_grp_id": "country_groups.id", **TO_APPLICATION, **TO_BATCH},
    ),
    _table(
        "incidents",
        "inc_id int, batch_id int!, status string!, type string!, case_type string!, case_sub_type string, ela_grp_id int!, "
        "ela_id int, licence_id int, report_date timestamp!, temporary_licence_flag int!, licence_conversion_flag int!, "
        "incorporation_flag int!, mil_flag int!, other_flag int!, torture_flag int!, start_date timestamp!, version_no int, "
        "ogl_id int, status_control string!, else_id int, stakeholders_confirmed string",
        "inc_id version_no",
        {
            "status": f"status in ({INCIDENT_STATUSES})",
            "version": "version_no >= 0",
            "general licence": _only_for("case_type", "OGEL", "ogl_id"),
            "refusal": "(type = 'REFUSAL') = (licence_id is null)",
            "suspension": _only_for("type", "SUSPENSION", "else_id"),
            "type": f"type in ({INCIDENT_TYPES})",
            "case type": f"case_type in ({CASE_TYPES})",
            "case sub type": SUB_TYPE_FITS,
            **{flag.replace("_", " "): f"{flag} in (0, 1)" for flag in FLAGS},
        },
        {**TO_BATCH, **TO_APPLICATION},
    ),
    _table(
        "third_parties",
        "tp_id int, ela_grp_id int!, sh_id int, country_id int!, ultimate_end_user_flag int, start_date timestamp!, "
        "version_no int, batch_id int!, status_control string!",
        "tp_id version_no",
        {
            "ultimate end user flag": "ultimate_end_user_flag is null or ultimate_end_user_flag in (0, 1)",
            "version": "version_no >= 0",
        },
        {**TO_APPLICATION, **TO_BATCH},
    ),
    _table(
        "ultimate_end_users",
        "ueu_id int, ela_grp_id int!, country_id int!, status_control string!, start_date timestamp!, version_no int, "
        "batch_id int!, sh_id int, ultimate_end_user_flag int",
        "ueu_id version_no",
        {"version": "version_no >= 0", "status control": f"status_control in ({END_USER_CONTROLS})"},
        {**TO_APPLICATION, **TO_BATCH},
    ),
    _table("ars", "gi_id int, ars_value string, ars_quantity int", "gi_id ars_value", refs={"gi_id": "goods_incidents.id"}),
    _table(
        "control_entries",
        "gi_id int, rating string, value decimal(38,6)",
        "gi_id rating",
        refs={"gi_id": "goods_incidents.id", "rating": "ref_report_ratings.rating"},
    ),
    _table(
        "reasons_for_refusal",
        "gi_id int, reason_for_refusal string",
        "gi_id reason_for_refusal",
        refs={"gi_id": "goods_incidents.id"},
    ),
]

BY_NAME = {t.name: t for t in TABLES}


def load_table(spark: SparkSession, store: LayerStore, name: str, path: str, header_map: dict[str, str] | None = None) -> DataFrame:
    """Read a file by header names, check it with the rows already loaded, and add it as a whole or not at all."""
    rules = BY_NAME[name]
    # Typed once; the checks and the load read the same rows.
    rows = materialize(read_by_name(spark, path, rules.schema, header_map), f"licensing-{name}")
    existing = store.read_or_empty(name, rules.schema)
    parents = {fk.parent: store.read_or_empty(fk.parent, BY_NAME[fk.parent].schema) for fk in rules.foreign_keys}
    label = path.rstrip("/").rsplit("/", 1)[-1]
    report = materialize(table_report(rows, rules, parents, existing), f"licensing-report-{name}")
    if not report.isEmpty():
        store.publish(f"{name}_report", report, label)
        kinds = report.groupBy("kind", "rule").agg(F.count("*").alias("n"), F.min("key").alias("key")).orderBy("kind", "rule").collect()
        shown = "; ".join(f"{k.n} x {k.kind} ({k.rule}), first at {k.key}" for k in kinds)
        raise LoadRejected(f"{name}: {shown}; all of them are in {name}_report")
    return store.append(name, rows, label)


def load_order() -> list[str]:
    """The tables, each after those that it refers to."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for fk in BY_NAME[name].foreign_keys:
                if fk.parent != name:
                    visit(fk.parent)
            order.append(name)

    for table in TABLES:
        visit(table.name)
    return order


def load_group(
    spark: SparkSession, store: LayerStore, files: dict[str, str], record, header_maps: dict[str, dict[str, str]] | None = None
) -> dict[str, str]:
    """Load one file per table in the order of their references; ``record(table, file, state, message)`` is called before
    and after each. A table that is rejected does not stop the others. Returns the message of each rejected table."""
    failed: dict[str, str] = {}
    for name in load_order():
        if name in files:
            file_name = files[name].rstrip("/").rsplit("/", 1)[-1]
            record(name, file_name, "processing", None)
            try:
                load_table(spark, store, name, files[name], (header_maps or {}).get(name))
            except Exception as e:
                failed[name] = str(e)
                record(name, file_name, "failed", str(e))
            else:
                record(name, file_name, "processed", None)
    return failed
