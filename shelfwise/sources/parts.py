"""Files of a text source: their headers, their checksums, and copies of them.

A table's source is a file or a folder of part files, and each part is a file of
its own: it has its own header, and it is copied as it is.

* ``header_groups`` lists the parts by their first line, so a scan can bind each
  group by its own header.
* ``file_digests`` gives size, lines and a checksum of every file, computed by the
  tasks that read the lines.
* ``copy_files`` copies files byte for byte, a task for each file, and compares the
  checksums of both sides.

Line feeds alone part lines here (``lineSep``), so carriage returns, quotes and
broken records stay what they are, and bytes that are no UTF-8 pass through.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..actions import run_concurrently

#: Files above this are not read by one task (Spark splits them); copies need one.
LARGEST_FILE = 1 << 44
HEADERS_AT_ONCE = 16
_PACKED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate")
_CODE_BITS = 21  # of a code point, and one more for none
_LINE_INDEX = (1 << 33) - 1  # the low bits of monotonically_increasing_id


def whole_files(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose scans read each file in one task."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(LARGEST_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(LARGEST_FILE))
    return own


def _plain_path(spark: SparkSession, uri: str) -> str:
    """A listed (percent-encoded) path as Spark's readers take it."""
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def list_files(spark: SparkSession, uri: str, csv_only: bool = False) -> list[str]:
    """The source's files in order of their names; a missing source raises
    ``PATH_NOT_FOUND``.  Hidden files (``_SUCCESS``) are not listed."""
    reader = spark.read.option("pathGlobFilter", "*.csv") if csv_only else spark.read
    return sorted(_plain_path(spark, f) for f in reader.text(uri).inputFiles())


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, without its end and a byte order mark (empty
    file: none).  Only the file's beginning is read."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return None if line is None else line.removeprefix("\ufeff")


def header_groups(spark: SparkSession, uri: str, csv_only: bool = False) -> dict[tuple[str, ...], list[str]]:
    """``{header: files}`` of a CSV source.  The headers are read ``HEADERS_AT_ONCE``
    at a time, a few hundred bytes of each file; empty files belong to no group."""
    lines = run_concurrently({f: (lambda f=f: first_line(spark, f)) for f in list_files(spark, uri, csv_only)},
                             HEADERS_AT_ONCE)
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in lines.items():
        if line is not None:
            groups.setdefault(tuple(next(csv.reader([line]), ())), []).append(path)
    return groups


def _lines(spark: SparkSession, uris: str | list[str], line_end: str = "\n") -> DataFrame:
    text = whole_files(spark).read.option("lineSep", line_end).text(uris)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                       F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit(_LINE_INDEX)).alias("line"))


def file_digests(spark: SparkSession, uris: str | list[str]) -> DataFrame:
    """Per file ``(file, size, n_lines, n_bytes, digest, last_char)``: its size in the
    store, its lines, their bytes with a line feed each, the sum of a hash of each
    line and its number, and the last character of the last line.

    One scan and one row per task to the exchange.  All that is kept of a file while its
    lines pass are numbers, the last character with its line's number too: text would
    make Spark sort the lines first.
    """
    code = F.when(F.length("value") > 0, F.ascii(F.right("value", F.lit(1))) + 1).otherwise(0)
    return _lines(spark, uris).groupBy("file").agg(
        F.max("size").alias("size"), F.count("value").alias("n_lines"),
        F.sum(F.octet_length("value").cast("long") + 1).alias("n_bytes"),
        F.sum(F.xxhash64("value", "line").cast("decimal(20,0)")).alias("digest"),
        F.max(F.shiftleft("line", _CODE_BITS).bitwiseOR(code.cast("long"))).alias("last"), F.max("block").alias("last_block")
    ).withColumn("code", F.col("last").bitwiseAND(F.lit((1 << _CODE_BITS) - 1)).cast("int")).select(
        "file", "size", "n_lines", "n_bytes", "digest",
        F.when(F.col("code") > 0, F.decode(F.unhex(F.lpad(F.hex(F.col("code") - 1), 8, "0")), "UTF-32")).otherwise("").alias("last_char"),
        "last_block")


#: How descriptions of files are kept.
FILES_DDL = ("source_file STRING, size BIGINT, n_lines BIGINT, n_bytes BIGINT, digest DECIMAL(38,0), "
             "line_end STRING, marked BOOLEAN")


@dataclass(frozen=True)
class SourceFile:
    """A file of a source, and what a line-wise copy must know of it."""

    path: str
    size: int
    n_lines: int
    n_bytes: int
    digest: int
    line_end: str  # what its lines, the last one too, can be parted at
    marked: bool  # begins with a byte order mark, which the readers take off

    @property
    def content(self) -> tuple[int, int, int]:
        return self.n_lines, self.n_bytes, self.digest


def describe(spark: SparkSession, uris: str | list[str]) -> list[SourceFile]:
    """One entry per file that has lines, by path."""
    out = []
    for r in file_digests(spark, uris).collect():
        path = _plain_path(spark, r.file)
        if r.last_block:
            raise ValueError(f"{path}: read by more than one task; files of over {LARGEST_FILE} bytes are not copied")
        extra = 0 if path.endswith(_PACKED) else r.size - r.n_bytes
        if extra not in (0, -1, 2, 3):
            raise ValueError(f"{path}: {r.size} bytes, but its lines have {r.n_bytes}")
        out.append(SourceFile(path, r.size, r.n_lines, r.n_bytes, int(r.digest),
                              "\n" if extra in (0, 3) else r.last_char, extra > 0))
    return sorted(out, key=lambda f: f.path)


def copy_files(spark: SparkSession, source: str, target: str) -> list[SourceFile]:
    """Copy a file, or the files of a folder, to the folder ``target``, each by one
    task and into one part; returns the source's files.

    The bytes are those of the source: a file whose last line has no line feed is
    parted, and put together again, at its own last character instead.  Files of
    no bytes have no part, and compressed ones land decompressed.  Afterwards lines,
    bytes and checksums of the parts must be those of the source; if not, this
    raises and names the files.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError(f"{source} would be copied to itself")
    files = describe(spark, source)
    kinds: dict[tuple[str, bool], list[str]] = {}
    for f in files:
        kinds.setdefault((f.line_end, f.marked), []).append(f.path)
    mode = "overwrite"
    for (line_end, marked), paths in sorted(kinds.items(), key=lambda k: -len(k[1])) or [(("\n", False), source)]:
        text = _lines(spark, source if len(kinds) < 2 else paths, line_end)
        value = F.col("value")
        if marked:
            value = F.when(F.col("line") == 0, F.concat(F.lit("\ufeff"), value)).otherwise(value)
        text.select(value.alias("value")).write.mode(mode).option("lineSep", line_end).text(target)
        mode = "append"
    check_copies(spark, files, target)
    return files


def check_copies(spark: SparkSession, files: Iterable[SourceFile], target: str) -> None:
    """Raise ``OSError`` unless ``target`` holds a copy of each of ``files`` and nothing else."""
    landed = [(f.content, f.size) for f in describe(spark, target)]
    missing = []
    for f in files:
        same = next((x for x in landed if x[0] == f.content and (f.path.endswith(_PACKED) or x[1] == f.size)), None)
        if same is None:
            missing.append(f.path)
        else:
            landed.remove(same)
    if missing or landed:
        raise OSError(f"{target}: no equal copy of {missing}" if missing else f"{target}: {len(landed)} parts too many")
