"""What a view is: plain values handed to the workspace by the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from slotviews.errors import SpecError


class Load(Enum):
    """STATIC reads the whole location, RELATIVE the slots of the run's window."""

    STATIC = "STATIC"
    RELATIVE = "RELATIVE"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    sensitive: bool = False
    type: str | None = None


@dataclass(frozen=True)
class Import:
    """A view another view is built from, and the window it is read for.

    Give slot ids (``start``, ``end``) for a fixed window; a bound left empty is the
    parent's. Give offsets for a window relative to the parent's. ``alias`` names the
    temporary view when the same spec is imported twice.
    """

    spec: "ViewSpec"
    start: str | None = None
    end: str | None = None
    start_offset: timedelta | None = None
    end_offset: timedelta | None = None
    alias: str | None = None

    @property
    def name(self) -> str:
        return self.alias or self.spec.name


@dataclass(frozen=True)
class ViewSpec:
    """A raw table (no imports) or a view built from imports.

    ``uri`` may hold ``%s`` for the client of raw data. ``steps`` are (name, SQL)
    pairs run in order, each visible to the next under its name; ``builder`` is a
    Python function used instead of them.
    """

    name: str
    uri: str
    fmt: str = "AVRO"
    time_column: str | None = None
    client_folders: Mapping[str, str] = field(default_factory=dict)
    source_conf: Mapping[str, Any] = field(default_factory=dict)
    imports: tuple[Import, ...] = ()
    steps: tuple[tuple[str, str], ...] = ()
    builder: Callable[[SparkSession, "ViewSpec"], DataFrame] | None = None
    dedup_keys: tuple[str, ...] = ()
    prefer_materialized: bool = False
    materialize: bool | None = None
    load: Load = Load.RELATIVE
    dq_enabled: bool = False
    columns: tuple[ColumnSpec, ...] = ()
    params: Mapping[str, str] = field(default_factory=dict)
    day_bucket: str = ""
    reader: Callable | None = None
    schema: Any = None

    @property
    def stores(self) -> bool:
        """Views are stored unless they say otherwise."""
        return self.materialize is not False

    @property
    def sensitive(self) -> list[str]:
        return [column.name for column in self.columns if column.sensitive]

    def raw_location(self, root: str, client: str) -> str:
        folder = self.client_folders.get(client, client)
        return f"{root.rstrip('/')}/{self.uri.strip('/').replace('%s', folder)}"

    def check_root(self) -> None:
        """Checks that apply to the view a run is started for."""
        if self.stores and self.imports and not self.time_column:
            raise SpecError(f"{self.name} is stored and needs a time column")
        if self.materialize is True and not self.imports and not self.prefer_materialized:
            raise SpecError(f"{self.name} has no imports, so it cannot be stored")
