"""What a dataset is: its name, its two layers and how a file becomes rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

SNAPSHOT, INCREMENTAL, REPLACE = "snapshot", "incremental", "replace"

# Column types a user may choose for an upload.
UPLOAD_TYPES = {
    "integer": "int",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "numeric": "decimal(38,6)",
    "text": "string",
}

RESERVED_COLUMNS = ["id", "datafile_created", "data_source_row_id"]


@dataclass(frozen=True)
class DatasetSpec:
    """A dataset ``organisation.dataset`` with its raw layer (L0) and its standardised layer (L1).

    ``read`` turns one file into rows of ``l0_schema``. ``transforms`` returns the expression over L0 of each
    L1 column that is not simply copied (a function, because columns exist only within a session). ``hash_columns`` limits what makes a row new in a snapshot.
    ``to_l1`` replaces the projection for datasets whose second layer is not row by row; with ``repeats_source``
    it yields several rows per L0 row, which are added again when a file name is loaded again. ``read_with_errors``
    replaces ``read`` for datasets that report what they could not read; a load keeps the report beside the layers.
    """

    organisation: str
    dataset: str
    mode: str
    l0_schema: str
    read: Callable[[SparkSession, str], DataFrame]
    l1_columns: list[str] = field(default_factory=list)
    transforms: Callable[[], dict[str, str | Column]] = dict
    hash_columns: list[str] | None = None
    to_l1: Callable[[DataFrame], DataFrame] | None = None
    repeats_source: bool = False
    delete_previous: bool = False
    requires: tuple[str, ...] = ()
    read_with_errors: Callable[[SparkSession, str], tuple[DataFrame, DataFrame]] | None = None

    @property
    def id(self) -> str:
        return f"{self.organisation}.{self.dataset}"

    @property
    def l0_columns(self) -> list[str]:
        return T.StructType.fromDDL(self.l0_schema).fieldNames()
