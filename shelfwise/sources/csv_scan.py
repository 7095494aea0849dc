"""CSV scans of the raw zone and of CSV exports.

Scans use an explicit schema: no inference jobs, no type drift between
runs, and Catalyst prunes the CSV read to the columns a plan uses.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import LayerPaths
from .parts import header_groups

# Header on; dates ``yyyy-MM-dd``; timestamps in ISO form with ``T`` or a
# space (Spark's default parser takes both).  A quote in a value is doubled,
# line breaks and padding are kept; a bare empty field is NULL and a quoted
# one the empty string, as in ``COPY ... CSV``.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}

# What the parser returns for a quoted empty field; ``_restored`` makes it ''.
# Drawn anew by each application, so no source can hold it.
_EMPTY = uuid.uuid4().hex

CORRUPT = "_corrupt_record"


def raw_uri(raw_root: str, name: str) -> str:
    """Location of a raw source table: ``{raw}/{name}.csv`` (file or folder)."""
    return f"{raw_root.rstrip('/')}/{name}.csv"


def _restored(df: DataFrame) -> DataFrame:
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != CORRUPT}
    return df.select(*[F.when(F.col(f"`{c}`") == _EMPTY, "").otherwise(F.col(f"`{c}`")).alias(c) if c in text
                       else F.col(f"`{c}`") for c in df.columns])


def read_csv(spark: SparkSession, uri: str, schema: T.StructType | None = None, csv_only: bool = False,
             by_name: bool = False, infer: bool = False, corrupt: bool = False,
             multi_line: bool = True) -> DataFrame:
    """Read CSV with a header.

    Columns bind by position, as a ``COPY ... CSV HEADER`` load does, or with
    ``by_name`` by the header of each part: parts with another order of columns are
    scanned apart, and a missing or unknown column raises and names the part.  Without a
    schema all columns are text (``infer=True``: inferred, two more jobs).
    ``corrupt`` adds the text of a record with too few or too many fields as
    ``_corrupt_record``.

    ``multi_line`` lets a quoted field hold line breaks; Spark then reads each
    file in one task, which fits part files of a task's size.  Turn it off for a
    single very large file known to have none.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("emptyValue", _EMPTY).option("multiLine", str(multi_line).lower())
    if csv_only:
        reader = reader.option("pathGlobFilter", "*.csv")
    if schema is None:
        return _restored(reader.option("inferSchema", str(infer).lower()).csv(uri))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    added = [T.StructField(CORRUPT, T.StringType())] if corrupt else []

    def scan(columns: Sequence[str], paths: str | list[str]) -> DataFrame:
        order = T.StructType([*(schema[c] for c in columns), *added])
        return _restored(reader.schema(order).csv(paths)).select(*schema.fieldNames(), *([CORRUPT] if corrupt else []))

    groups = header_groups(spark, uri, csv_only) if by_name else {}
    for header, paths in groups.items():
        if sorted(header) != sorted(schema.fieldNames()):
            raise ValueError(f"{paths[0]}: header {list(header)} does not name the columns {schema.fieldNames()}")
    if len(groups) < 2:
        return scan(next(iter(groups), schema.fieldNames()), uri)
    return reduce(DataFrame.unionByName, [scan(header, paths) for header, paths in groups.items()])


def scan_table(spark: SparkSession, raw_root: str, name: str, typed: bool = True,
               multi_line: bool = True) -> DataFrame:
    """One raw table, bound by its header: typed by its schema, or as text for
    try-cast conforming, then with ``_corrupt_record``."""
    schema = schemas.RAW_SCHEMAS[name]
    return read_csv(spark, raw_uri(raw_root, name), schema if typed else schemas.all_strings(schema),
                    by_name=True, corrupt=not typed, multi_line=multi_line)


def scan_inferred(spark: SparkSession, raw_root: str, name: str) -> DataFrame:
    """The inference path (``inferSchema=true``)."""
    return read_csv(spark, raw_uri(raw_root, name), infer=True)


def load_raw(spark: SparkSession, paths: LayerPaths | str, typed: bool = True,
             multi_line: bool = True) -> dict[str, DataFrame]:
    """All six raw tables as a lazy ``{name: DataFrame}`` bundle.  Without
    ``multi_line`` large files are read by many tasks (see ``read_csv``)."""
    root = paths.raw if isinstance(paths, LayerPaths) else paths
    return {n: scan_table(spark, root, n, typed, multi_line) for n in schemas.SOURCE_TABLES}


def read_csv_export(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """A written CSV dataset (a folder of part files): every ``*.csv`` part,
    not only the first.  A missing folder raises ``PATH_NOT_FOUND``."""
    return read_csv(spark, uri, schema, csv_only=True)
