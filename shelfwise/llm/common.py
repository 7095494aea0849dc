"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_uri

Batch = TypeVar("Batch", pa.RecordBatch, pa.Array)

#: Characters that separate words in the contracts: space and 09-0D.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null key: null)."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % folds


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the cluster's shared checkpoint folder and
    read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    uri = scratch_uri(spark, f"llm/{name}")
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs in a text (null: 0), without
    building the words: the runs' first characters are what one regular
    expression keeps."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not use yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sliced(batches: Iterator[Batch], rows: int = 500) -> Iterator[Batch]:
    """The batches in slices, so that of a batch's texts only a slice's are there
    as Python strings beside it; an empty batch is one empty slice."""
    for whole in batches:
        for at in range(0, max(1, len(whole)), rows):
            yield whole.slice(at, rows)


def text_runs(texts, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` of about ``limit`` characters each; a longer
    text makes a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments given by their end positions; empty
    segments sum to zero."""
    shape = (1, *values.shape[1:])
    running = np.concatenate([np.zeros(shape, np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.asarray(ends, dtype=np.int64)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    return running[ends] - running[starts]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files``
    would: functions that run in Python workers are imported there."""
    sc = spark.sparkContext
    if _shipped.get("to") != sc.applicationId:
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/shelfwise", "zip", root, "shelfwise"))
        _shipped["to"] = sc.applicationId


_shipped: dict[str, str] = {}
