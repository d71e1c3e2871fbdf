"""Running datasets: files in, layers out, one registry entry per file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators import lifecycle as L
from tradeloom.operators import registry as R
from tradeloom.operators.store import LayerStore
from tradeloom.sources.upload import apply_types, missing_columns, read_upload, reserved_columns
from tradeloom.spec import INCREMENTAL, REPLACE, SNAPSHOT, DatasetSpec

REGISTRY = "operations/datafile_registry"
LAYER0_LINEAGE = "id bigint, datafile_created string, datafile_updated string, data_hash string, "


def layer(spec: DatasetSpec, name: str) -> str:
    return f"{spec.organisation}/{spec.dataset}/{name}"


def load_file(spec: DatasetSpec, store: LayerStore, path: str, file_name: str | None = None, force: bool = False) -> None:
    """Bring one file into both layers. ``force`` starts both layers over with this file."""
    spark = store.spark
    file_name = file_name or path.rstrip("/").rsplit("/", 1)[-1]
    if spec.read_with_errors is None:
        rows = spec.read(spark, path)
    else:
        rows, errors = spec.read_with_errors(spark, path)
        # Before the data, and once per file: a file that is loaded never lacks its report.
        store.append(layer(spec, "errors"), errors.withColumn("datafile_created", F.lit(file_name)), file_name, replaces=True)
    if spec.mode == SNAPSHOT:
        _load_snapshot(spec, store, rows, file_name, force)
    elif spec.mode == REPLACE:
        store.publish(layer(spec, "L0"), L.append_file(None, rows, file_name), file_name)
    else:
        _load_incremental(spec, store, rows, file_name, force)


def _load_snapshot(spec: DatasetSpec, store: LayerStore, rows: DataFrame, file_name: str, force: bool) -> None:
    l0_name, l1_name = layer(spec, "L0"), layer(spec, "L1")
    empty_l0 = LAYER0_LINEAGE + spec.l0_schema
    old = store.spark.createDataFrame([], empty_l0) if force else store.read_or_empty(l0_name, empty_l0)
    l0 = store.publish(l0_name, L.snapshot_merge(old, rows, file_name, spec.hash_columns), file_name)

    known = None if force or not store.exists(l1_name) else store.read(l1_name)
    if spec.to_l1 is None:
        sources = store.spark.createDataFrame([], "id bigint, data_source_row_id bigint") if known is None else known
        added = L.snapshot_l1_increment(l0, sources, file_name, spec.l1_columns, spec.transforms())
    else:
        derived = spec.to_l1(l0.where(F.col("datafile_created") == file_name))
        added = derived.select(F.col("id").alias("data_source_row_id"), *spec.l1_columns)
        if known is not None and not spec.repeats_source:
            added = added.join(known.select("data_source_row_id"), "data_source_row_id", "left_anti")
        added = L.with_row_ids(added, known)
    write = store.publish if force else store.append
    l1 = write(l1_name, added, file_name)
    if spec.delete_previous and not force:
        store.publish(l1_name, L.delete_previous_l1(l0, l1, file_name), file_name)
        store.publish(l0_name, L.delete_previous_l0(l0, file_name), file_name)


def _load_incremental(spec: DatasetSpec, store: LayerStore, rows: DataFrame, file_name: str, force: bool) -> None:
    l0_name, l1_name = layer(spec, "L0"), layer(spec, "L1")
    if force:
        fresh = store.publish(l0_name, L.append_file(None, rows, file_name), file_name)
    else:
        # A retry after a failure further on puts its rows in the place of those of the failed attempt.
        # Both layers change in one transaction, so a stop leaves both or neither.
        retried = not _finished(store, spec, file_name)
        known = store.read(l0_name) if store.exists(l0_name) else None
        l0_path = store.stage(l0_name, L.append_file(known, rows, file_name))
        changes = [store.appended(l0_name, l0_path, file_name, replaces=retried)]
        if spec.l1_columns:
            known_l1 = store.read(l1_name) if store.exists(l1_name) else None
            added = L.incremental_l1(store.read_staged(l0_path), known_l1, spec.l1_columns, spec.transforms())
            changes.append(store.appended(l1_name, store.stage(l1_name, added), file_name, replaces=retried))
        store.commit_together(changes)
        return
    if spec.l1_columns:
        added = L.incremental_l1(fresh, None, spec.l1_columns, spec.transforms())
        store.publish(l1_name, added, file_name)


def _finished(store: LayerStore, spec: DatasetSpec, file_name: str) -> bool:
    """Whether the last recorded state of the file is an end, or it was never recorded: then loading it again is meant."""
    return file_name not in _open_files(store, spec)


def registry(store: LayerStore) -> DataFrame:
    return R.current_states(store.read_or_empty(REGISTRY, R.STATE_SCHEMA))


def _states(store: LayerStore, states: list[tuple[str, str | None, str, str | None]]) -> DataFrame:
    now = dt.datetime.now(dt.timezone.utc)
    return store.spark.createDataFrame([(*s, now) for s in states], R.STATE_SCHEMA).coalesce(1)


def _record(store: LayerStore, states: list[tuple[str, str | None, str, str | None]]) -> None:
    """Add (source, file name, state, message) to the log of states; nothing that is there is read or written again."""
    store.append_compacted(REGISTRY, _states(store, states))


# Files that are read by one job; their plans are joined, so there are not too many.
FILES_TOGETHER = 50


def process_files(spec: DatasetSpec, store: LayerStore, files: Iterable[str], force: bool = False) -> bool:
    """Process every file that is not finished yet, in name order; a failing file does not stop the others.

    Files of an incremental dataset are loaded many at a time, and one by one only where that fails. Returns whether
    any file changed the data.
    """
    names = [(spec.id, path.rstrip("/").rsplit("/", 1)[-1], path) for path in sorted(files)]
    if not names:
        return False
    work = store.spark.createDataFrame(names, "source string, file_name string, path string")
    todo = work if force else R.unprocessed_files(work, registry(store))
    # No more than the names that were given.
    waiting = [(r.file_name, r.path) for r in todo.select("file_name", "path").orderBy("file_name").collect()]
    changed = False
    together = spec.mode == INCREMENTAL and spec.read_with_errors is None and not force
    retried = _open_files(store, spec) if together else set()
    step = FILES_TOGETHER if together else 1

    def load(part: list[tuple[str, str]]) -> bool:
        name, path = part[0]
        if len(part) == 1:
            try:
                load_file(spec, store, path, name, force)
            except Exception as e:
                _record(store, [(spec.id, name, R.FAILED, str(e))])
                return False
        elif retried & {name for name, _ in part} or not _load_together(spec, store, part):
            # Halves, so that one bad file among many is found in a few attempts.
            half = len(part) // 2
            return load(part[:half]) | load(part[half:])
        else:
            return True  # the joint load recorded its files as processed in its own transaction
        _record(store, [(spec.id, name, R.PROCESSED, None) for name, _ in part])
        return True

    for i in range(0, len(waiting), step):
        part = waiting[i : i + step]
        _record(store, [(spec.id, name, R.PROCESSING, None) for name, _ in part])
        changed |= load(part)
    return changed


def _open_files(store: LayerStore, spec: DatasetSpec) -> set[str]:
    """Files with an attempt that did not end well, which may have left rows behind."""
    states = registry(store).where((F.col("source") == spec.id) & F.col("state").isin(R.PROCESSING, R.FAILED))
    return {r.file_name for r in states.select("file_name").collect()}


def _load_together(spec: DatasetSpec, store: LayerStore, files: list[tuple[str, str]]) -> bool:
    """Append several incremental files to both layers as one addition, and record them as processed, in one
    transaction; whether that worked. If not, or if the process stops on the way, nothing of it is visible."""
    l0_name, l1_name = layer(spec, "L0"), layer(spec, "L1")
    label = f"{files[0][0]} and {len(files) - 1} more"
    try:
        frames = [spec.read(store.spark, path).withColumn("datafile_created", F.lit(name)) for name, path in files]
        known = store.read(l0_name) if store.exists(l0_name) else None
        l0_path = store.stage(l0_name, L.with_row_ids(reduce(DataFrame.unionByName, frames), known))
        changes = [store.appended(l0_name, l0_path, label)]
        if spec.l1_columns:
            known_l1 = store.read(l1_name) if store.exists(l1_name) else None
            added = L.incremental_l1(store.read_staged(l0_path), known_l1, spec.l1_columns, spec.transforms())
            changes.append(store.appended(l1_name, store.stage(l1_name, added), label))
        done = _states(store, [(spec.id, name, R.PROCESSED, None) for name, _ in files])
        changes.append(store.appended(REGISTRY, store.stage(REGISTRY, done), label))
    except Exception:
        return False
    store.commit_together(changes)
    return True


def run_group(specs: dict[str, DatasetSpec], wanted: Iterable[str], store: LayerStore, files: dict[str, list[str]], force: bool = False) -> list[str]:
    """Process datasets after those they require; returns the order used."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in specs[name].requires:
            visit(needed)
        order.append(name)

    for name in wanted:
        visit(name)
    for name in order:
        process_files(specs[name], store, files.get(name, []), force)
    return order


def check_upload(columns: list[str], latest: list[str] | None) -> dict[str, list[str]]:
    """What to show before an upload is confirmed: columns that went missing and reserved names."""
    return {"missing": missing_columns(latest or [], columns), "reserved": reserved_columns(columns)}


def load_upload(store: LayerStore, organisation: str, dataset: str, path: str, types: dict[str, str], **options) -> DataFrame:
    """Replace an uploaded dataset by a new file; every load stays available as a version.

    The uploaded rows are archived as text first, in a folder named for the dataset and file.
    """
    file_name = path.rstrip("/").rsplit("/", 1)[-1]
    rows = read_upload(store.spark, path, **options)
    table = f"{organisation}/{dataset}"
    store.append(f"{table}/uploads", rows.withColumn("file", F.lit(file_name)), file_name, ("file",))
    return store.publish(f"{table}/L0", L.append_file(None, apply_types(rows, types), file_name), file_name)
