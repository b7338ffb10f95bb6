"""The schema contract of trip files, checked before any job runs."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hailgrid.fixed import OPTIONAL_TRIP_COLUMNS, REQUIRED_TRIP_COLUMNS

log = logging.getLogger(__name__)

KINDS = {
    "integer": T.IntegralType,
    "numeric": T.NumericType,
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}


def contract_report(trips: DataFrame) -> DataFrame:
    """One row per expected or found column: its role, its type, and whether it is acceptable."""
    found = {field.name: field.dataType for field in trips.schema.fields}
    rows = []
    for name in [*REQUIRED_TRIP_COLUMNS, *OPTIONAL_TRIP_COLUMNS]:
        kind = REQUIRED_TRIP_COLUMNS.get(name)
        role = "required" if kind else "optional"
        if name not in found:
            rows.append((name, role, None, "missing"))
        elif kind and not isinstance(found[name], KINDS[kind]):
            rows.append((name, role, found[name].simpleString(), "incompatible"))
        else:
            rows.append((name, role, found[name].simpleString(), "ok"))
    expected = {row[0] for row in rows}
    rows += [(n, "new", t.simpleString(), "ok") for n, t in found.items() if n not in expected]
    return trips.sparkSession.createDataFrame(
        rows, "column_name STRING, role STRING, found_type STRING, status STRING"
    )


def validate_trip_schema(trips: DataFrame) -> dict:
    """Fail on missing required columns or wrong types; report new and absent optional columns."""
    found = {field.name: field.dataType for field in trips.schema.fields}
    missing = sorted(set(REQUIRED_TRIP_COLUMNS) - set(found))
    if missing:
        raise ValueError(f"trip file lacks required columns: {missing}")
    wrong = {
        name: found[name].simpleString()
        for name, kind in REQUIRED_TRIP_COLUMNS.items()
        if not isinstance(found[name], KINDS[kind])
    }
    if wrong:
        raise TypeError(f"trip file has incompatible column types: {wrong}")
    report = {
        "valid": True,
        "column_count": len(found),
        "missing_required": missing,
        "new_columns": sorted(set(found) - set(REQUIRED_TRIP_COLUMNS) - set(OPTIONAL_TRIP_COLUMNS)),
        "missing_optional": sorted(set(OPTIONAL_TRIP_COLUMNS) - set(found)),
        "incompatible_types": wrong,
    }
    for part in ("new_columns", "missing_optional"):
        if report[part]:
            log.info("trip schema: %s %s", part, report[part])
    return report
