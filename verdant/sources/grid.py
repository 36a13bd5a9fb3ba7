"""Spreadsheet-like grids stored as CSV files (header row + text cells).

Reading keeps the source's conventions: header names are trimmed, every
cell is text, a short row is padded with empty strings, the surplus cells of
an over-long row are kept in ``_extra`` (JSON text) so the row can be refused
with all it holds, and an empty source gives an empty frame.

Every file is mapped by the names in its own header: files are grouped by
header, each group is read with its names, and the groups are put together by
name; a column that a file lacks is NULL.  Each row gets an input ordinal
``_row_no`` = (time of change, file, split start, position), so "later in the
source" is well defined for keep-last deduplication without any global sort.
Files are read in parallel splits; the driver sees the list of files and one
header line per file.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..contract import EXTRA_COL
from ..session import is_missing

TASK_BYTES = 16 << 20    # of source files, for a task that holds its rows
RAW_COL = "_raw"     # the whole line of a row whose number of cells isn't its header's
# one cell of a line with a comma in front: quoted (a quote inside is escaped, or not followed by a comma), or bare
_CELL = r',("[^"\\]*+(?:(?s:\\.|"(?!,|\z))[^"\\]*+)*+"|[^,]*)'
_CSV_READ = {"header": "true", "mode": "PERMISSIVE", "multiLine": "false",
             "recursiveFileLookup": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_CSV_WRITE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
              "quoteAll": "false"}


@dataclass(frozen=True)
class GridFile:
    path: str
    modified: dt.datetime    # in UTC
    names: tuple[str, ...] = ()


def list_files(spark: SparkSession, path: str) -> list[GridFile]:
    """The non-empty files under ``path`` (a listing: no content is read)."""
    try:
        rows = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                .where("length > 0").select("path", F.unix_micros("modificationTime").alias("us")).collect())
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return []
    epoch = dt.datetime(1970, 1, 1)
    files = [GridFile(r.path, epoch + dt.timedelta(microseconds=r.us)) for r in rows]
    return sorted(files, key=lambda f: (f.modified, f.path))


def tasks_for(spark: SparkSession, path: str) -> int:
    """Over how many tasks the rows under ``path`` are dealt where a task holds its share of them:
    ``TASK_BYTES`` of files each, one per core at least (a listing: no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    total = files.agg(F.sum("length").alias("n")).first()["n"] or 0
    return max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))


def header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str] | None:
    """Header names (trimmed) of one file, None if it has no line.

    The first line that is not blank is read through the cluster's file system
    (codecs by the file's extension): no Spark job, and no more of the file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            stream if codec is None else codec.createInputStream(stream), "UTF-8"))
        text = lines.readLine()
        while text is not None and not text.removeprefix("\ufeff").strip():
            text = lines.readLine()
        while multi_line and text is not None and text.count('"') % 2:  # a quoted name goes on
            more = lines.readLine()
            if more is None:
                break
            text += "\n" + more
    finally:
        stream.close()
    if text is None:
        return None
    names = next(csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""), doublequote=False, escapechar="\\"))
    return [n.strip() for n in names] or None


def with_headers(spark: SparkSession, files: Sequence[GridFile], multi_line: bool = False) -> list[GridFile]:
    """Each file with the names in its header (16 files at a time, no Spark job)."""
    def one(f: GridFile) -> GridFile:
        return GridFile(f.path, f.modified, tuple(header(spark, f.path, multi_line) or ()))

    with ThreadPoolExecutor(16) as pool:
        return [f for f in pool.map(one, files) if f.names]


def _read_options(multi_line: bool) -> dict[str, str]:
    return {**_CSV_READ, "multiLine": str(multi_line).lower()}


def _cells(n: int) -> list[str]:
    return [f"_cell{i}" for i in range(n)]


def ordinal(meta: str = "_metadata") -> Column:
    """Position of a row in the source: later change, file, split, row."""
    return F.struct(F.col(f"{meta}.file_modification_time").alias("modified"),
                    F.col(f"{meta}.file_path").alias("file"),
                    F.col(f"{meta}.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def named(cells: DataFrame, own: Sequence[str], names: Sequence[str],
          keep: Sequence[str | Column]) -> DataFrame:
    """Cells by position -> the columns ``names`` by name, and ``_extra``.

    ``own`` is the header that the cells stand under.  A short row's missing
    cells are empty text; a column that ``own`` lacks is NULL."""
    at = {n: i for i, n in reversed(list(enumerate(own)))}
    cols = [F.coalesce(F.col(f"_cell{at[n]}"), F.lit("")).alias(n) if n in at
            else F.lit(None).cast("string").alias(n) for n in names]
    return cells.select(*keep, *cols, surplus(len(own)).alias(EXTRA_COL))


def surplus(own: int) -> Column:
    """The non-empty cells past the first ``own`` of a line (JSON array), NULL if there are none.
    However many they are: they are cut from the line, not read into columns."""
    raw = F.col(RAW_COL)
    commas = F.length(raw) - F.length(F.replace(raw, F.lit(",")))
    every = F.regexp_extract_all(F.concat(F.lit(","), raw), F.lit(_CELL), F.lit(1))
    past = F.filter(F.slice(every, F.lit(own + 1), F.size(every)), lambda x: x != "")
    bare = F.transform(past, lambda x: F.when(
        (F.length(x) > 1) & x.startswith('"') & x.endswith('"'),
        F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('\\"'), F.lit('"'))).otherwise(x))
    # the first cell is named for the reader, which refuses queries for the raw line alone
    long = (F.length(F.coalesce(F.col("_cell0"), F.lit(""))) >= 0) & (commas >= own)
    return F.when(long & (F.size(past) > 0), F.to_json(bare))


def read_grid(spark: SparkSession, path: str, names: Sequence[str] | None = None,
              modified_after: dt.datetime | None = None, multi_line: bool = False) -> DataFrame:
    """CSV grid files -> text columns + ``_extra`` + ``_row_no`` ordinal.

    ``names`` fixes the columns (default: all names of all headers, in the order
    of their first file).  ``modified_after`` leaves out files that did not change
    since (a time in UTC).  ``multi_line`` allows line breaks inside quoted cells; a file is then
    read by one task."""
    files = [f for f in list_files(spark, path) if modified_after is None or f.modified > modified_after]
    files = with_headers(spark, files, multi_line)
    names = list(names) if names else list(dict.fromkeys(n for f in files for n in f.names))
    return read_files(spark, files, names, multi_line) if files else empty_grid(spark, names or K.RAW_COLUMNS)


def empty_grid(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A grid without rows, in the shape of ``read_files``."""
    place = "struct<modified:timestamp,file:string,block:bigint,row:bigint>"
    cols = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return spark.createDataFrame([], f"{K.ROW_NO} {place}, {cols}, {EXTRA_COL} string")


def read_files(spark: SparkSession, files: Sequence[GridFile], names: Sequence[str],
               multi_line: bool = False) -> DataFrame:
    """The rows of ``files`` (one at least, with headers), each file read with its own header's width."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        groups.setdefault(f.names, []).append(f.path)
    out = None
    for own, paths in groups.items():
        schema = ", ".join(f"{c} string" for c in [*_cells(len(own)), RAW_COL])
        cells = (spark.read.options(**_read_options(multi_line)).option("enforceSchema", "true")
                 # a pruned read would not see that a row is too long
                 .option("columnPruning", "false").option("columnNameOfCorruptRecord", RAW_COL).schema(schema).csv(paths))
        part = named(cells, own, names, [ordinal().alias(K.ROW_NO)])
        out = part if out is None else out.unionByName(part)
    return out


def overlong_rows(grid: DataFrame) -> DataFrame:
    """Rows with more cells than the header (they go to the rejects)."""
    return grid.where(F.col(EXTRA_COL).isNotNull())


def to_line(cells: Sequence[str], short_when: Column | None = None,
            keep_when_short: int | None = None) -> Column:
    """One CSV text line per row; optionally drop trailing cells (short rows)."""
    full = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cells]), _CSV_WRITE)
    if short_when is None or keep_when_short is None:
        return full
    short = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cells[:keep_when_short]]), _CSV_WRITE)
    return F.when(short_when, short).otherwise(full)


def write_grid(df: DataFrame, path: str, cells: Sequence[str],
               short_when: Column | None = None, keep_when_short: int | None = None,
               partition_by: str | None = None) -> None:
    """Write rows as CSV text files, each file starting with the header line.

    Full rows go through Spark's CSV writer (header per file, JVM only).
    Rows that must be written short (fewer cells than the header) are
    rendered with ``to_csv`` and the header is put in front of each
    partition's output.
    """
    if short_when is None:
        w = df.select(*[F.col(f"`{c}`") for c in cells],
                      *([partition_by] if partition_by else [])).write
        w = w.partitionBy(partition_by) if partition_by else w
        w.mode("overwrite").options(**_CSV_WRITE).option("header", "true").csv(path)
        return
    write_lines(df, path, cells, to_line(cells, short_when, keep_when_short))


def write_lines(df: DataFrame, path: str, cells: Sequence[str], line: Column) -> None:
    """One CSV text ``line`` per row, the header of ``cells`` on top of each file."""
    # A text file per task holds its rows; the header stands in front of the first
    # row of each, by a marker line that every task's rows are sorted behind.
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lines = df.select(line.alias("value"), F.lit(1).alias("_at"),
                      F.pmod(F.xxhash64(*cells), F.lit(tasks)).cast("int").alias("_file"))
    heads = df.sparkSession.range(tasks).select(
        F.lit(",".join(cells)).alias("value"), F.lit(0).alias("_at"), F.col("id").cast("int").alias("_file"))
    (lines.unionByName(heads).repartition(tasks, "_file").sortWithinPartitions("_file", "_at")
     .select("value", "_file").write.mode("overwrite").partitionBy("_file").text(path))
