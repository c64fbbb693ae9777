"""Declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# The 43 ticket columns by position, with the type to read them as. Values that do
# not parse become null.
TICKET_COLUMNS = [
    ("Summons Number", "bigint"),
    ("Plate ID", "string"),
    ("Registration State", "string"),
    ("Plate Type", "string"),
    ("Issue Date", "string"),
    ("Violation Code", "int"),
    ("Vehicle Body Type", "string"),
    ("Vehicle Make", "string"),
    ("Issuing Agency", "string"),
    ("Street Code1", "int"),
    ("Street Code2", "int"),
    ("Street Code3", "int"),
    ("Vehicle Expiration Date", "string"),
    ("Violation Location", "int"),
    ("Violation Precinct", "int"),
    ("Issuer Precinct", "int"),
    ("Issuer Code", "int"),
    ("Issuer Command", "string"),
    ("Issuer Squad", "string"),
    ("Violation Time", "string"),
    ("Time First Observed", "string"),
    ("Violation County", "string"),
    ("Violation In Front Of Or Opposite", "string"),
    ("House Number", "string"),
    ("Street Name", "string"),
    ("Intersecting Street", "string"),
    ("Date First Observed", "int"),
    ("Law Section", "int"),
    ("Sub Division", "string"),
    ("Violation Legal Code", "string"),
    ("Days Parking In Effect", "string"),
    ("From Hours In Effect", "string"),
    ("To Hours In Effect", "string"),
    ("Vehicle Color", "string"),
    ("Unregistered Vehicle?", "int"),
    ("Vehicle Year", "int"),
    ("Meter Number", "string"),
    ("Feet From Curb", "int"),
    ("Violation Post Code", "string"),
    ("Violation Description", "string"),
    ("No Standing or Stopping Violation", "string"),
    ("Hydrant Violation", "string"),
    ("Double Parking Violation", "string"),
]

TICKET_NAMES = [name for name, _ in TICKET_COLUMNS]


def struct_of(columns: list[tuple[str, str]]) -> T.StructType:
    """Schema from (name, type) pairs; names may hold blanks."""
    return T.StructType([T.StructField(name, _TYPES[type_name]) for name, type_name in columns])


TICKET_SCHEMA = struct_of(TICKET_COLUMNS)

# Side tables: the columns the feature jobs read, all as text in the raw files.
SCHOOLS_SCHEMA = struct_of(
    [
        ("open_date", "string"),
        ("LONGITUDE", "double"),
        ("LATITUDE", "double"),
        ("Status_descriptions", "string"),
        ("Location_Category_Description", "string"),
    ]
)
BUSINESSES_SCHEMA = struct_of(
    [
        ("License Creation Date", "string"),
        ("License Expiration Date", "string"),
        ("License Status", "string"),
        ("Industry", "string"),
        ("Location", "string"),
    ]
)
EVENTS_SCHEMA = struct_of(
    [
        ("Start Date/Time", "string"),
        ("End Date/Time", "string"),
        ("Event Type", "string"),
        ("Street Closure Type", "string"),
        ("Event Borough", "string"),
    ]
)
LANDMARKS_SCHEMA = struct_of(
    [("OBJECTID", "bigint"), ("Borough", "string"), ("Shape_Leng", "double"), ("Shape_Area", "double")]
)

# Widest text kept by the fixed-width export, per column where it differs from the default.
TEXT_WIDTH = 20
TEXT_WIDTHS = {"Location": 42}
