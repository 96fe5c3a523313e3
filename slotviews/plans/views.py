"""Resolving views over their imports, and running one view for a client and window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slotviews.errors import BuilderError, ReadError, SlotViewsError, SpecError
from slotviews.functions.crypto import decrypt_columns, encrypt_columns
from slotviews.functions.scalars import register_functions, view_sql
from slotviews.operators.dedup import dedup_by_keys
from slotviews.operators.slots import (
    SLOT_COLUMNS,
    check_window,
    day_bucket_folders,
    parse_slot,
    slot_id,
)
from slotviews.plans.specs import Import, Load, ViewSpec
from slotviews.sources.files import Files
from slotviews.sources.readers import FILE_FORMATS, reader_of
from slotviews.sources.slot_table import (
    covering_folders,
    existing_slots,
    read_slots,
    slots_below,
    table_location,
    write_slots,
)


def import_window(link: Import, start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """The window an import is read for, given its parent's."""
    if link.start_offset is not None or link.end_offset is not None:
        first = start + link.start_offset if link.start_offset is not None else start
        last = end + link.end_offset if link.end_offset is not None else end
    else:
        first = parse_slot(link.start) if link.start else start
        last = parse_slot(link.end) if link.end else end
    return check_window(first, last)


def source_of(spec: ViewSpec, prefer_stored: bool, is_root: bool) -> str:
    """Where a view's rows come from: ``built``, ``stored`` or ``raw``.

    The root is always built from its imports. A view below it is built unless it is
    stored and the root prefers stored data.
    """
    if spec.imports and (is_root or not spec.stores or not prefer_stored):
        return "built"
    return "stored" if prefer_stored and spec.stores else "raw"


class Workspace:
    """Views below one root folder, sharing a session and an encryption key."""

    def __init__(self, spark: SparkSession, root: str, key: str = ""):
        self.spark, self.root, self.key = spark, root, key
        self.input_paths: list[str] = []
        if key:
            register_functions(spark, key)

    def use(self, spec: ViewSpec, client: str, start: str, end: str) -> "Segment":
        return Segment(self, spec, client, *check_window(start, end))

    def location(self, spec: ViewSpec) -> str:
        return table_location(self.root, spec.uri, spec.name)

    def frame(self, spec: ViewSpec, client: str, start: datetime, end: datetime) -> DataFrame:
        # what the latest run has read, for its metrics record
        self.input_paths = []
        return self._resolve(spec, client, start, end, spec.prefer_materialized, {}, spec.name)

    def bring(self, imports: Sequence[Import], client: str, start, end, prefer: bool = False) -> None:
        """Resolves imports into views of their names, for queries that are no view's steps."""
        first, last = check_window(start, end)
        self.input_paths, known = [], {None: None}
        for link in imports:
            self._resolve(link.spec, client, *import_window(link, first, last), prefer, known, link.name)

    def _resolve(self, spec, client, start, end, prefer, known, name) -> DataFrame:
        # ``known`` holds what this run has resolved; it is empty for the root
        source = source_of(spec, prefer, not known)
        again = (id(spec), start, end)
        if again in known:
            if known[again] is None:
                raise SpecError(f"{spec.name} imports itself")
            rows = known[again]
        elif source == "stored":
            rows = self._stored(spec, client, start, end)
        elif source == "raw":
            rows = dedup_by_keys(self._raw(spec, client, start, end), spec.dedup_keys)
        else:
            known[again] = None
            for link in spec.imports:
                window = import_window(link, start, end)
                self._resolve(link.spec, client, *window, prefer, known, link.name)
            rows = self._build(spec)
        known[again] = rows
        rows.createOrReplaceTempView(name)
        return rows

    def _build(self, spec: ViewSpec) -> DataFrame:
        try:
            if spec.builder is not None:
                return spec.builder(self.spark, spec)
            for name, text in spec.steps:
                view_sql(self.spark, text).createOrReplaceTempView(name)
            return self.spark.table(spec.name)
        except SlotViewsError:
            raise
        except Exception as error:
            raise BuilderError(f"cannot build {spec.name}: {error}") from error

    def _stored(self, spec, client, start, end) -> DataFrame:
        location = self.location(spec)
        found = existing_slots(self.spark, location, client, start, end)
        rows = read_slots(self.spark, location, client, spec.fmt, start, end, schema=spec.schema, found=found)
        self.input_paths += found.values()
        if not spec.sensitive:
            return rows
        types = {column.name: column.type for column in spec.columns if column.type}
        return decrypt_columns(rows, spec.sensitive, self.key, types)

    def _raw(self, spec, client, start, end) -> DataFrame:
        location = spec.raw_location(self.root, client).rstrip("/")
        files = Files(self.spark, location)
        reader, conf = spec.reader or reader_of(spec.fmt), dict(spec.source_conf)
        by_slot = spec.load is Load.RELATIVE and not spec.day_bucket
        if by_slot:
            found = slots_below(files, location, start, end)
            paths = list(found.values())
        elif spec.load is Load.STATIC:
            paths = [location] if files.exists(location) else []
        else:
            days = [f"{location}/{folder}" for folder in day_bucket_folders(spec.day_bucket, start, end)]
            paths = [path for path in days if files.glob(path)]
        if not paths:
            raise ReadError(f"no input for {spec.name} below {location} in [{start}, {end})")
        self.input_paths += paths
        by_slot = by_slot and spec.reader is None and spec.fmt.upper() in FILE_FORMATS
        if by_slot:
            paths = [f"{location}/{folder}" for folder in covering_folders(found, start, end)]
            conf["base_path"] = location
        try:
            rows = reader(self.spark, paths, conf)
            return rows.drop(*SLOT_COLUMNS) if by_slot else rows
        except SlotViewsError:
            raise
        except Exception as error:
            raise ReadError(f"cannot read {spec.name}: {error}") from error


class Segment:
    """One view for one client and window."""

    def __init__(self, workspace: Workspace, spec: ViewSpec, client: str, start: datetime, end: datetime):
        spec.check_root()
        self.workspace, self.spec, self.client = workspace, spec, client
        self.start, self.end = start, end
        self._frame: DataFrame | None = None

    def df(self) -> DataFrame:
        if self._frame is None:
            self._frame = self.workspace.frame(self.spec, self.client, self.start, self.end)
        return self._frame

    def schema(self) -> StructType:
        return self.df().schema

    def write(self, outside: str = "error") -> list[str]:
        """Stores the view's rows, replacing the window; returns the slots written."""
        spec = self.spec
        rows = self.df()
        if spec.sensitive:
            rows = encrypt_columns(rows, spec.sensitive, self.workspace.key)
        return write_slots(
            rows,
            self.workspace.location(spec),
            spec.time_column,
            self.client,
            spec.fmt,
            self.start,
            self.end,
            outside,
        )

    def stored(self) -> DataFrame:
        """The rows stored for the window."""
        return self.workspace._stored(self.spec, self.client, self.start, self.end)

    @property
    def window_ids(self) -> tuple[str, str]:
        return slot_id(self.start), slot_id(self.end)
