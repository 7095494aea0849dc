"""What a raw file looks like against what its schema says.

Inference alone follows the data: one odd value turns a column into text, and a scan
with a declared type turns the odd value into NULL.  ``type_report`` names the column
that drifted and shows a value that did it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.casting import converted
from .csv_scan import scan_table

#: From the narrowest; a column is of the first type that takes all its values.
CANDIDATES: tuple[T.DataType, ...] = (schemas.I, schemas.L, schemas.D, schemas.B, schemas.DT, schemas.TS)


def tried(values: DataFrame) -> DataFrame:
    """``values(text, ...)`` with ``present`` and, per type of CANDIDATES, ``is_{type}``:
    whether the text converts to it."""
    trimmed = values.withColumn("trimmed", F.trim("text"))
    whole = trimmed.withColumn("whole", converted(F.col("trimmed"), "bigint"))  # an INT is a BIGINT in its range
    others = [k.simpleString() for k in CANDIDATES if k not in (schemas.I, schemas.L)]
    return whole.select(
        *values.columns, "trimmed", (F.coalesce(F.length("trimmed"), F.lit(0)) > 0).alias("present"),
        F.coalesce(F.col("whole").between(-1 << 31, (1 << 31) - 1), F.lit(False)).alias("is_int"),
        F.col("whole").isNotNull().alias("is_bigint"),
        *[converted(F.col("trimmed"), k).isNotNull().alias(f"is_{k}") for k in others])


def type_report(spark: SparkSession, raw_root: str, name: str) -> DataFrame:
    """Per column ``(table_name, column_name, declared, inferred, n_values, n_conflicts,
    example)``: the type that takes all its values (``string`` if none does, ``void``
    without values), how many do not convert to the declared type, and the least of
    those.  One pass over the text: every value becomes a row of its own, and a task
    sends on one row per column.
    """
    fields = schemas.RAW_SCHEMAS[name].fields
    kinds, declared = [k.simpleString() for k in CANDIDATES], [f.dataType.simpleString() for f in fields]
    raw = scan_table(spark, raw_root, name, typed=False)
    # numbers stand for the columns' names and types until the rows are counted
    values = raw.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("no"), F.lit(kinds.index(k) if k in kinds else -1).alias("kind"), F.col(f"`{f.name}`").alias("text"))
        for i, (f, k) in enumerate(zip(fields, declared, strict=True))])))
    odd = F.lit(False)
    for i, k in enumerate(kinds):
        odd = F.when(F.col("kind") == i, F.col("present") & ~F.col(f"is_{k}")).otherwise(odd)
    # a date's parser also takes the beginning of a timestamp
    fits = {k: F.col(f"is_{k}") & (F.length("trimmed") <= 10) if k == "date" else F.col(f"is_{k}") for k in kinds}
    found = tried(values).withColumn("odd", odd).groupBy("no").agg(
        F.count_if("present").alias("n_values"), F.count_if("odd").alias("n_conflicts"),
        F.min(F.when(F.col("odd"), F.col("text"))).alias("example"),
        *[F.count_if(F.col("present") & ~fits[k]).alias(f"not_{k}") for k in kinds])
    inferred = F.when(F.col("n_values") == 0, F.lit("void"))
    for k in kinds:
        inferred = inferred.when(F.col(f"not_{k}") == 0, F.lit(k))

    def named(texts):
        return F.element_at(F.array(*map(F.lit, texts)), F.col("no") + 1)

    return found.select(F.lit(name).alias("table_name"), named([f.name for f in fields]).alias("column_name"),
                        named(declared).alias("declared"), inferred.otherwise(F.lit("string")).alias("inferred"),
                        "n_values", "n_conflicts", "example")


def hold_types(spark: SparkSession, raw_root: str, name: str) -> None:
    """Raise ``ValueError`` that names each column with values its type does not take."""
    drifted = type_report(spark, raw_root, name).where("n_conflicts > 0").collect()
    if drifted:
        told = "; ".join(f"{r.column_name} is {r.declared}, {r.n_conflicts} of {r.n_values} values are not, e.g. "
                         f"{r.example!r}" for r in drifted)
        raise ValueError(f"{name}: {told}")
