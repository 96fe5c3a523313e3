"""Voice-session records: attribute lists to wide call records, and frame headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTES_TYPE = "array<struct<key: string, value: string, timestamp: bigint>>"

# Transport mode names and their ids.
TRANSPORT_MODES = {
    "tdm.nms": "1",
    "voip.dc": "2",
    "gateway": "3",
    "socket.tellme": "4",
    "unknown": "5",
    "voip.tdm": "6",
}

# Output column, attribute name, text where the attribute is missing.
# Columns without an attribute name are derived below.
CALL_COLUMNS = (
    ("uuid", "uuid", "UUID"),
    ("logLabel", None, "LOGLABEL"),
    ("callStartTime", None, None),
    ("endStatusCode", "termination", "ENDSTATUSCODE"),
    ("networkEntryId", "network_entry.id", "NEID"),
    ("logMessage", None, ""),
    ("dnis", "dnis", "DNIS"),
    ("duration", "session.duration", "DURATION"),
    ("cpn", "ani", "ANI"),
    ("iiDigits", "iidigits", "ANI_II"),
    ("iiPrivacy", "iiprivacy", "ANI_PRIVATE"),
    ("destinationNumber", "destination_number", "DESTINATIONNUMBER"),
    ("transportModeId", None, ""),
    ("host", "server.hostname", "HOST"),
    ("type", "type", "TYPE"),
    ("entity", "entity", "ENTITY"),
    ("uri", "uri", "URI"),
    ("userdata", "userdata", "USERDATA"),
    ("bridged", "bridged", "BRIDGED"),
    ("endreason", "endreason", "ENDREASON"),
    ("transfer_fail_reason", "session.telephony.transfer_fail.reason", "TRANSFERFAILREASON"),
    ("connection_result", "connection.result", "CONNECTIONRESULT"),
    ("call_type", "call.type", ""),
    ("call_done_reason", "session.call_done.reason", ""),
    ("log_duration", "log.time.duration", "LOGDURATION"),
    ("dcr", "dcr", "DCR"),
    ("reco_result_nomatch", "reco_result_nomatch", "RESULTNOMATCH"),
    ("reco_result_noinput", "reco_result_noinput", "RESULTNOINPUT"),
    ("reco_result_success", "reco_result_success", "RESULTSUCCESS"),
    ("error_description", "error.description", "ERROR"),
    ("unix_timestamp", None, None),
    ("devlog_size", "devlog_size", ""),
    ("tellme_session_id", "x-tellme-session-id", "SESSIONID"),
    ("key", "key", "KEY"),
)

# Ticks of 100 ns between the UUID epoch (1582) and the Unix epoch, and
# the mask that clears the version bit of a version 1 UUID.
UUID_EPOCH_TICKS = 122192928000000000
UUID_VERSION_MASK = -1152921504606846977


def uuid_time_ms(uuid: Column) -> Column:
    """Milliseconds encoded in a time-based UUID; other text gives null."""
    text = uuid.cast("string")
    well_formed = text.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-7][0-9a-fA-F]{3}")
    digits = F.concat(F.substring(text, 15, 4), F.substring(text, 10, 4), F.substring(text, 1, 8))
    ticks = F.conv(F.when(well_formed, digits), 16, 10).cast("bigint") - F.lit(UUID_EPOCH_TICKS)
    return ticks.bitwiseAND(F.lit(UUID_VERSION_MASK)).cast("double") / F.lit(1e4)


def transport_mode_id(mode: Column) -> Column:
    result = F.lit("")
    for name, number in TRANSPORT_MODES.items():
        result = F.when(mode == name, F.lit(number)).otherwise(result)
    return result


def split_label(label: Column) -> tuple[Column, Column]:
    """Text before and after the last colon; no colon means an empty message."""
    tail = F.substring_index(label, ":", -1)
    has_colon = F.instr(label, ":") > 0
    head = F.left(label, F.length(label) - F.length(tail) - 1)
    return F.when(has_colon, head).otherwise(label), F.when(has_colon, tail).otherwise("")


def attribute_values(attributes: Column, name: str) -> Column:
    """Values of all attributes of that name, whatever its case, in order."""
    matching = F.filter(attributes, lambda a: F.lower(a["key"]) == name.lower())
    return F.transform(matching, lambda a: a["value"])


def attribute_values_by_name(attributes: Column, names: Sequence[str]) -> Column:
    """Map of lower-case name to its values, for the names that occur."""
    entries = F.array(
        *[F.struct(F.lit(name).alias("key"), attribute_values(attributes, name).alias("value")) for name in sorted({n.lower() for n in names})]
    )
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["value"]) > 0))


def label_seconds(attributes: Column) -> Column:
    """Time of the last ``log.label`` attribute, microseconds to seconds."""
    labels = F.filter(attributes, lambda a: F.lower(a["key"]) == "log.label")
    micros = F.coalesce(F.try_element_at(labels, F.lit(-1))["timestamp"], F.lit(0))
    return (micros.cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(20,6)")


def call_records(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Attribute lists as 34-column call records.

    A repeated attribute counts with its last value: the wanted attributes are taken
    out once, in reverse order, and each column looks up its first position.
    """
    wanted = {name for _, name, _ in CALL_COLUMNS if name} | {"transport_mode", "log.label"}
    latest_first = F.reverse(F.filter(F.col(attributes), lambda a: a["key"].isin(sorted(wanted))))
    rows = df.select(
        F.transform(latest_first, lambda a: a["key"]).alias("__keys"),
        F.transform(latest_first, lambda a: a["value"]).alias("__values"),
        label_seconds(F.col(attributes)).alias("__label_time"),
    )

    def value(name: str, default: str) -> Column:
        position = F.array_position("__keys", name)
        found = F.get(F.col("__values"), (position - 1).cast("int"))
        return F.when(position > 0, found).otherwise(F.lit(default))

    label, message = split_label(value("log.label", "LOGLABEL"))
    derived = {
        "logLabel": label,
        "logMessage": message,
        "callStartTime": uuid_time_ms(value("uuid", "UUID")).cast("bigint"),
        "transportModeId": transport_mode_id(value("transport_mode", "TRANSPORTMODEID")),
        "unix_timestamp": F.col("__label_time").cast("string"),
    }
    return rows.select(
        *[(derived[c] if c in derived else value(name, default)).alias(c) for c, name, default in CALL_COLUMNS]
    )


def _unsigned(frame: Column, offset: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(frame, offset + 1, size)), 16, 10)


def _signed(frame: Column, offset: int, size: int) -> Column:
    number = _unsigned(frame, offset, size).cast("bigint")
    half = 1 << (8 * size - 1)
    return F.when(number >= half, number - 2 * half).otherwise(number).cast("int")


def frame_header(frame: Column) -> Column:
    """Header fields of a version 4 binary log frame (big-endian) as a struct.

    Times are microseconds. They are unsigned 64-bit numbers, hence decimals.
    """
    uuid = F.lower(F.hex(F.substring(frame, 30, 16)))
    parts = [F.substring(uuid, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    host_size = _unsigned(frame, 45, 1).cast("int")
    host = F.substring(frame, F.lit(47), F.greatest(host_size - 1, F.lit(0))).cast("string")
    return F.struct(
        _signed(frame, 0, 1).alias("version"),
        _unsigned(frame, 1, 4).cast("bigint").alias("size"),
        _signed(frame, 5, 2).alias("log_class"),
        _signed(frame, 7, 2).alias("log_name"),
        _unsigned(frame, 9, 8).cast("decimal(20,0)").alias("written"),
        _unsigned(frame, 17, 8).cast("decimal(20,0)").alias("created"),
        _unsigned(frame, 25, 4).cast("bigint").alias("event_id"),
        F.concat_ws("-", *parts).alias("uuid"),
        host_size.alias("host_size"),
        host.alias("host"),
    )
