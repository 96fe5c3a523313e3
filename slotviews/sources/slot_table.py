"""Slot tables: ``location/client=C/year=…/month=…/day=…/hour=…/min=…``.

A slot counts as complete when it holds a ``_SUCCESS`` marker. Rewriting a window
takes the markers away first and puts them back last. A marker says nothing of a slot
that is gone, so before anything changes the window is announced by an empty file in the
client's ``_replacing`` folder, whose removal is the last step of a write: one deletion that
makes the whole window readable. Readers refuse windows that an announced one touches, so
none takes a half-replaced window for a complete one; a rerun that covers it repairs it.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotviews.errors import ReadError, SpecError, WriteError
from slotviews.operators.columns import (
    decode_names,
    encode_name,
    encode_names,
    ensure_client,
    fill_blank,
)
from slotviews.operators.slots import (
    SLOT_COLUMNS,
    in_window,
    slot_folder,
    window_steps,
    with_slot_columns,
)
from slotviews.sources.files import Files

MARKER = "_SUCCESS"
REPLACING = "_replacing"
WRITABLE = ("json", "csv", "parquet", "orc")
_SLOT_PATTERN = "year=*/month=*/day=*/hour=*/min=*"
# what makes any text come back as it was: line ends, quotes and spaces at its ends
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def table_location(root: str, uri: str, view: str) -> str:
    return f"{root.rstrip('/')}/{uri.strip('/')}/view={view}"


def stored_format(fmt: str) -> str:
    """The format a view is stored in: JSON unless it names a storable one."""
    return fmt.lower() if fmt.lower() in WRITABLE else "json"


def slots_below(files: Files, base: str, start, end) -> dict[str, str]:
    """The window's slots that exist below a folder: relative folder -> full path.

    One listing per day of the window.
    """
    by_day = defaultdict(set)
    for step in window_steps(start, end):
        by_day[f"year={step:%Y}/month={step:%m}/day={step:%d}"].add(slot_folder(step))
    found = {}
    for paths in files.each(lambda day: files.glob(f"{base}/{day}/hour=*/min=*"), by_day):
        for path in paths:
            folder = "/".join(path.split("/")[-5:])
            if folder in by_day[folder.rsplit("/", 2)[0]]:
                found[folder] = path
    return dict(sorted(found.items()))


def _digits(folder: str) -> str:
    """A slot's folder as its id."""
    return "".join(part.split("=")[1] for part in folder.split("/"))


def _announced(files: Files, base: str) -> list[tuple[str, str, str]]:
    """First and last slot of every window that is being replaced, and its file."""
    paths = files.glob(f"{base}/{REPLACING}/*-*")
    return [(*path.rsplit("/", 1)[1].split("-")[:2], path) for path in paths]


def check_settled(files: Files, base: str, start, end) -> None:
    """Raises if a write of some slot of the window has begun and not ended."""
    steps = window_steps(start, end)
    first, last = _digits(slot_folder(steps[0])), _digits(slot_folder(steps[-1]))
    for begin, stop, _ in _announced(files, base):
        if begin <= last and first <= stop:
            raise ReadError(f"slots {begin} to {stop} in {base} are not complete: a write of them has not ended")


def existing_slots(spark: SparkSession, location: str, client: str, start, end) -> dict[str, str]:
    """Stored slots of the window: relative slot folder -> full path."""
    return slots_below(Files(spark, location), f"{location}/client={client}", start, end)


def stored_slots(spark: SparkSession, location: str, fmt: str, client: str, start, end) -> DataFrame:
    """Stored slots of the window as rows of the slot columns, from the partitions alone.

    The listing is Spark's own and the window prunes it; no data file is opened.
    """
    fields = _with_partition_fields(T.StructType([]))
    rows = spark.read.format(stored_format(fmt)).schema(fields).load(location)
    return rows.where((F.col("client") == client) & in_window(start, end)).select(*SLOT_COLUMNS).distinct()


def covering_folders(found: Iterable[str], start, end) -> list[str]:
    """The slots found in a window as few folders: whole days and hours where possible.

    Spark lists every path it is given by itself, so thirty days are thirty paths and
    not thousands. A day or hour stands for its slots only if the window holds it all.
    """
    window = [slot_folder(step) for step in window_steps(start, end)]
    by_day = Counter(folder.rsplit("/", 2)[0] for folder in window)
    by_hour = Counter(folder.rsplit("/", 1)[0] for folder in window)
    covering = {}
    for folder in found:
        hour, day = folder.rsplit("/", 1)[0], folder.rsplit("/", 2)[0]
        covering[day if by_day[day] == 96 else hour if by_hour[hour] == 4 else folder] = True
    return list(covering)


def slots_to_write(df: DataFrame, epoch_column: str) -> DataFrame:
    """The distinct slots a frame's rows fall into."""
    return with_slot_columns(df.select(epoch_column), epoch_column).select(*SLOT_COLUMNS).distinct()


@contextmanager
def _all_partitions(spark: SparkSession) -> Iterator[None]:
    """Keeps a rebalance from merging small partitions: a slot is a file to make, however few its rows."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_slots(
    df: DataFrame,
    location: str,
    epoch_column: str,
    client: str,
    fmt: str = "parquet",
    start=None,
    end=None,
    outside: str = "error",
) -> list[str]:
    """Stores rows by slot, replacing the window ``[start, end)``; returns the slots.

    Slots of the window that get no rows are removed. ``outside`` says what happens
    to rows whose slot is not in the window: ``error``, ``drop`` or ``append`` (add to
    what their slot already holds). Without a window every slot is appended to.

    Rows are written once, to a staging folder beside the target, with a REBALANCE on
    the slot: a slot's rows meet in one task, a slot with most of the rows is split over
    several, and slots are dealt over all shuffle partitions, as thousands of small files
    take longer than their bytes. Complete with markers, the staged folders are then renamed from the
    driver: whole days and hours where nothing else is there to stay, else single slots.
    This needs a file system with folders that are renamed in one step, such as HDFS or
    an object store with a hierarchical namespace; a flat object store would copy them.
    """
    if epoch_column not in df.columns:
        raise WriteError(f"no time column {epoch_column} to derive slots from")
    if outside not in ("error", "drop", "append"):
        raise SpecError(f"outside must be error, drop or append, not {outside!r}")
    spark, fmt = df.sparkSession, stored_format(fmt)
    bounded = start is not None

    rows = fill_blank(encode_names(ensure_client(df, client)))
    rows = with_slot_columns(rows, encode_name(epoch_column))
    if bounded and outside == "drop":
        # rows without a valid time are nobody's to drop: they are refused below
        rows = rows.where(in_window(start, end) | F.col(SLOT_COLUMNS[0]).isNull())
    rows = rows.hint("rebalance", *SLOT_COLUMNS)

    staging = f"{location}/_staging/{uuid.uuid4().hex}"
    writer = rows.write.format(fmt).partitionBy("client", *SLOT_COLUMNS)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    files = Files(spark, location)
    try:
        with _all_partitions(spark):
            writer.save(staging)
        return _publish(spark, files, staging, location, client, start, end, outside)
    finally:
        files.delete(staging)


def _publish(spark, files: Files, staging: str, location: str, client: str, start, end, outside: str) -> list[str]:
    clients = {path.rsplit("client=", 1)[1] for path in files.glob(f"{staging}/client=*")}
    if clients - {client}:
        raise WriteError(f"rows of other clients than {client}: {sorted(clients - {client})}")
    staged = {"/".join(p.split("/")[-5:]): p for p in files.glob(f"{staging}/client=*/{_SLOT_PATTERN}")}
    if any("__HIVE_DEFAULT_PARTITION__" in folder for folder in staged):
        raise WriteError("rows without a valid time cannot be assigned to a slot")

    window, stored = set(), {}
    if start is not None:
        window = {slot_folder(step) for step in window_steps(start, end)}
        stored = existing_slots(spark, location, client, start, end)
        beyond = sorted(set(staged) - window)
        if beyond and outside == "error":
            raise WriteError(f"{len(beyond)} slots outside the window, first {beyond[0]}")

    target = f"{location}/client={client}"
    slots = sorted(map(_digits, window | set(staged)))
    if not slots:
        return []
    files.mkdirs(f"{target}/{REPLACING}")
    files.touch(f"{target}/{REPLACING}/{slots[0]}-{slots[-1]}-{uuid.uuid4().hex}")
    # no slot that changes may look complete while it does, whether in the window or not;
    # slots of the window that were not listed have no marker to remove
    touched = set(stored) | (set(staged) - window)
    files.each(lambda folder: files.delete(f"{target}/{folder}/{MARKER}"), sorted(touched))
    files.each(lambda path: files.touch(f"{path}/{MARKER}"), staged.values())

    units = _units(files, target, staged, window)
    files.each(files.mkdirs, sorted({f"{target}/{unit}".rsplit("/", 1)[0] for unit in units}))

    def publish(unit: str) -> None:
        source, final = f"{staging}/client={client}/{unit}", f"{target}/{unit}"
        if units[unit]:
            files.delete(final)
            _move(files, source, final)
        else:  # rows are added to a slot; its marker comes last
            for child in sorted(files.children(source), key=lambda path: path.endswith(MARKER)):
                _move(files, child, f"{final}/{child.rsplit('/', 1)[1]}")

    files.each(publish, units)
    gone = [path for folder, path in stored.items() if folder not in staged and not any(unit in units for unit in _above(folder))]
    files.each(files.delete, gone)
    # also what broken writes of these slots have left; the own file is the last step
    files.each(files.delete, [path for begin, stop, path in _announced(files, target) if slots[0] <= begin and stop <= slots[-1]])
    return sorted(staged)


def _above(folder: str) -> tuple[str, str, str]:
    """A slot's day, its hour and itself."""
    hour = folder.rsplit("/", 1)[0]
    return hour.rsplit("/", 1)[0], hour, folder


def _units(files: Files, target: str, staged: Iterable[str], window: set[str]) -> dict[str, bool]:
    """What is renamed at once, and whether it takes the place of what is there.

    A day or an hour moves whole if the target has none or the window holds all of it.
    A slot outside the window that is there already is added to.
    """
    whole = {}
    for level, size in ((0, 96), (1, 4), (2, 1)):
        counts = Counter(_above(folder)[level] for folder in window)
        whole |= {unit: True for unit, n in counts.items() if n == size}
    units, left = {}, set(staged)
    for level in range(3):
        candidates = sorted({_above(folder)[level] for folder in left} - set(whole))
        absent = {unit for unit, there in zip(candidates, files.each(lambda unit: files.exists(f"{target}/{unit}"), candidates)) if not there}
        for folder in sorted(left):
            unit = _above(folder)[level]
            if unit in whole or unit in absent or level == 2:
                units[unit] = unit in whole or unit in absent
                left.discard(folder)
    return units


def _move(files: Files, source: str, target: str) -> None:
    if not files.rename(source, target):
        raise WriteError(f"cannot move {source} to {target}")


def read_slots(
    spark: SparkSession,
    location: str,
    client: str,
    fmt: str,
    start,
    end,
    schema: T.StructType | str | None = None,
    require_all: bool = False,
    partition_columns: bool = False,
    found: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of the stored slots of ``[start, end)``; every slot must be complete.

    A window that an unfinished write touches is refused. Only the window's folders are listed (``found`` passes on a listing that was made),
    with one more listing a day for the markers, so the cost of planning does not depend on
    how much history the table has. A ``schema`` (of the stored data columns) saves
    the inference pass of JSON. ``require_all`` also refuses gaps in the window.
    """
    files = Files(spark, location)
    check_settled(files, f"{location}/client={client}", start, end)
    found = existing_slots(spark, location, client, start, end) if found is None else found
    if not found:
        raise ReadError(f"no slots stored in {location} for {client} in [{start}, {end})")
    days = sorted({_above(folder)[0] for folder in found})
    marked = files.each(lambda day: files.glob(f"{location}/client={client}/{day}/hour=*/min=*/{MARKER}"), days)
    complete = {"/".join(path.split("/")[-6:-1]) for paths in marked for path in paths}
    open_slots = [folder for folder in found if folder not in complete]
    if open_slots:
        raise ReadError(f"{len(open_slots)} slots are not complete, first {open_slots[0]}")
    if require_all and len(found) < len(window_steps(start, end)):
        raise ReadError(f"{len(window_steps(start, end)) - len(found)} slots of the window are missing")

    reader = spark.read.format(stored_format(fmt)).option("basePath", location)
    if stored_format(fmt) == "csv":
        reader = reader.options(**_CSV, multiLine=True)
    if schema is not None:
        reader = reader.schema(_with_partition_fields(schema))
    rows = reader.load([f"{location}/client={client}/{folder}" for folder in covering_folders(found, start, end)])
    if not partition_columns:
        return decode_names(rows.drop("client", *SLOT_COLUMNS))
    return decode_names(_text_partitions(rows, client))


def _with_partition_fields(schema: T.StructType | str) -> T.StructType:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = T.StructType([T.StructField(encode_name(f.name), f.dataType, f.nullable) for f in fields])
    fields = fields.add("client", T.StringType()).add("year", T.IntegerType())
    for name in SLOT_COLUMNS[1:]:
        fields = fields.add(name, T.StringType())
    return fields


def _text_partitions(rows: DataFrame, client: str) -> DataFrame:
    # partition discovery reads month=09 as the number 9 and client=007 as 7
    padded = {n: F.lpad(F.col(n).cast("string"), 2, "0") for n in SLOT_COLUMNS[1:]}
    return rows.withColumns({"client": F.lit(client), **padded})


def read_window(
    spark: SparkSession, location: str, fmt: str, client: str, start, end, schema: T.StructType | str | None = None
) -> DataFrame:
    """The window as a predicate on the partition columns instead of a path list.

    For tables that are listed once and then read for many windows: Spark prunes the
    partitions by the predicate. Keeps the slot columns, month to min as text.
    """
    check_settled(Files(spark, location), f"{location}/client={client}", start, end)
    reader = spark.read.format(stored_format(fmt))
    if stored_format(fmt) == "csv":
        reader = reader.options(**_CSV, multiLine=True)
    if schema is None:
        known = decode_names(reader.load(location).drop("client", *SLOT_COLUMNS))
        schema = known.schema
    rows = reader.schema(_with_partition_fields(schema)).load(location)
    return decode_names(rows.where((F.col("client") == client) & in_window(start, end)))
