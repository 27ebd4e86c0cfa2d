"""Column expressions for the reference's small scalar rules.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
# Component types a connection endpoint may have.
CONNECTABLE_TYPES = ["PROCESSOR", "INPUT_PORT", "OUTPUT_PORT", "FUNNEL"]
# Run states accepted when setting state.
PROCESSOR_STATES = ["RUNNING", "STOPPED"]
GROUP_STATES = ["RUNNING", "STOPPED"]
PORT_STATES = ["RUNNING", "STOPPED", "DISABLED"]
# Defaults of a new connection.
DEFAULT_BP_OBJECTS = 10000
DEFAULT_BP_SIZE = "1 GB"
DEFAULT_EXPIRATION = "0 sec"
# Name of the root group when its document carries none.
DEFAULT_ROOT_NAME = "NiFi Flow"
# Lint messages.
MSG_NO_PROCESSORS = "No processors found. Add processors to start building your pipeline."
MSG_DISCONNECTED = "Processor '%s' (ID: %s) is not connected to any other component."
MSG_STOPPED = "Processor '%s' is stopped. Consider starting it if it should be running."
MSG_INVALID = "Processor '%s' has validation errors: %s"
UNKNOWN_NAME = "Unknown"
UNKNOWN_STATUS = "UNKNOWN"
# Pipeline specs.
MSG_MISSING_FIELD = "Processor %d missing required '%s' field"
MSG_PIPELINE_CREATED = "Successfully created pipeline '%s' with %d processors"
PIPELINE_GROUP_X, PIPELINE_GROUP_Y = 100.0, 100.0
# Update kinds for processor config.
CONFIG_PROPERTIES = "properties"
CONFIG_AUTO_TERMINATED = "auto-terminatedrelationships"
# Provenance search term keys with a known mapping.
PROVENANCE_KEY_MAP = {"componentId": "ProcessorID", "flowFileUuid": "FlowFileUUID"}

# Data-size units (binary multiples; ours) and duration units in milliseconds.
SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024 ** 2, "GB": 1024 ** 3, "TB": 1024 ** 4}
DURATION_UNITS_MS = {
    "ms": 1, "millis": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "secs": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "mins": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hr": 3_600_000, "hrs": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
    "w": 604_800_000, "wk": 604_800_000, "week": 604_800_000, "weeks": 604_800_000,
}


def default_text(c: Column, default) -> Column:
    """``x or default``: null and empty string both take the default."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(c, F.lit("")), d)


def capitalize(c: Column) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def _unit_lookup(unit: Column, table: dict) -> Column:
    """Multiplier for ``unit`` from a literal map: one lookup, the unit text is
    computed once (a CASE chain would re-evaluate it in every branch)."""
    pairs = [x for name, mult in table.items() for x in (F.lit(name), F.lit(float(mult)))]
    return F.try_element_at(F.create_map(*pairs), unit)


_NUM_UNIT = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$"


def _scaled(c: Column, unit_case, table: dict) -> Column:
    num = F.regexp_extract(c, _NUM_UNIT, 1)
    unit = unit_case(F.regexp_extract(c, _NUM_UNIT, 2))
    return F.when(num != "", (num.cast("double") * _unit_lookup(unit, table)).cast("bigint"))


def parse_data_size(c: Column) -> Column:
    """``'1 GB'`` → bytes as bigint; unknown unit or malformed text → null."""
    return _scaled(c, F.upper, SIZE_UNITS)


def parse_duration_ms(c: Column) -> Column:
    """``'365 days'`` / ``'0 sec'`` → milliseconds as bigint; malformed → null."""
    return _scaled(c, F.lower, DURATION_UNITS_MS)


def split_list(c: Column, sep: str = ";") -> Column:
    """List stored as separated text → array; null stays null, '' → empty array."""
    return F.when(c.isNull(), F.lit(None)).when(c == "", F.array().cast("array<string>")) \
        .otherwise(F.split(c, sep))
