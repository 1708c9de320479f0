"""Readers and writers. Paths may be on any Hadoop file system; the table format is a parameter."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, MapType, VariantType

from lakestar.operators.skew import hash_of
from lakestar.session import side_session, together

log = logging.getLogger(__name__)

DEFAULT_FORMAT = "parquet"
# Formats of plain files, where a job that died half-way leaves a folder without this marker.
FILE_FORMATS = {"parquet", "orc", "csv", "json"}
SUCCESS_MARKER = "_SUCCESS"
# Size of the row groups of clustered tables: small enough that a filter leaves most of a file unread.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row, every column a string. With ``columns`` given no job runs to read the header."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(", ".join(f"`{name}` STRING" for name in columns))
    return reader.csv(path)


# Why a line is rejected, and the columns of rejected lines.
UNCLOSED, MISCOUNTED = "unclosed quote", "number of fields"
REJECTS = "file string, line string, reason string"
_BAD = "_rejected"


def read_checked(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV lines as ``read_csv`` reads them, every column a string, with ``_rejected`` in front: NULL, or the file, the line and
    the reason where a line has too few or too many fields or a quote that is never closed.

    The header is the first line of a file and is left out wherever it stands, as each file of a folder has it.
    """
    header = spark.read.text(path).first()
    names = list(columns or (spark.read.option("header", True).csv(path).columns if header else []))
    if not names:
        raise ValueError(f"{path} has no header and no columns are given")
    lines = spark.read.text(path).where((F.length(F.trim("value")) > 0) & (F.col("value") != (header[0] if header else "")))
    schema = ", ".join(f"`{name}` STRING" for name in names) + f", {_BAD} STRING"
    fields = F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    reason = F.when(quotes % 2 == 1, UNCLOSED).when(F.col(f"_fields.{_BAD}").isNotNull(), MISCOUNTED)
    parsed = lines.select("value", F.input_file_name().alias("_file"), fields.alias("_fields")).withColumn("_reason", reason)
    rejected = F.when(
        F.col("_reason").isNotNull(), F.struct(F.col("_file").alias("file"), F.col("value").alias("line"), F.col("_reason").alias("reason"))
    )
    return parsed.select(rejected.alias(_BAD), *[F.col(f"_fields.`{name}`").alias(name) for name in names])


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows of ``read_checked`` and the rejected lines (file, line, reason)."""
    return checked.where(f"{_BAD} IS NULL").drop(_BAD), checked.where(f"{_BAD} IS NOT NULL").select(f"{_BAD}.*")


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Columnar scan, narrowed to ``columns`` at the source. A table whose replacement was interrupted is recovered first."""
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("PATH_NOT_FOUND") or not recover(spark, path):
            raise
        df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds more than hidden entries, such as those a failed job leaves."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(hadoop_path) and any(not s.getPath().getName().startswith(("_", ".")) for s in store.listStatus(hadoop_path))


def is_complete(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Whether a table was fully written at ``path``: a folder left behind by a failed job does not count."""
    return _exists(spark, f"{path.rstrip('/')}/{SUCCESS_MARKER}" if fmt in FILE_FORMATS else path)


def _hashable(kind: DataType) -> bool:
    return not isinstance(kind, (MapType, VariantType))


def _writer(df: DataFrame, fmt: str, partition_by: Sequence[str], options: Mapping[str, str] | None = None):
    writer = df.write.format(fmt).options(**(options or {}))
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_new(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    repair: bool = False,
    options: Mapping[str, str] | None = None,
) -> bool:
    """Create the table unless it is there already; returns whether it was written.

    Files without a marker may be a table that was copied here or the rest of a failed job. They are never overwritten
    unasked: without ``repair`` they are an error.
    """
    spark = df.sparkSession
    if fmt in FILE_FORMATS and not _exists(spark, path):
        recover(spark, path)
    if is_complete(spark, path, fmt):
        return False
    mode = "ignore"
    if fmt in FILE_FORMATS:
        if _holds_files(spark, path) and not repair:
            raise FileExistsError(f"{path} holds files but no {SUCCESS_MARKER}; repair=True writes it anew")
        mode = "overwrite" if _exists(spark, path) else "errorifexists"
    _writer(df, fmt, partition_by, options).mode(mode).save(path)
    return True


def _beside(path: str, what: str) -> str:
    """Hidden folder next to a table, on the same store."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    store = to_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.rename(to_path(source), to_path(target)):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish or undo a replacement that was interrupted; returns whether a whole table is at ``path``.

    With no table in its place the new one takes it if it was fully written, else the old one comes back. With a table in its
    place what lies beside it is of no use any more.
    """
    following, last = _beside(path, "next"), _beside(path, "last")
    if not _exists(spark, path):
        source = next((x for x in (following, last) if is_complete(spark, x)), None)
        if source is None:
            return False
        _rename(spark, source, path)
    for rest in (following, last):
        if _exists(spark, rest):
            _delete(spark, rest)
    return True


def write_replace(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Write the table, replacing what is there once the new one is whole.

    Plain files are written beside the table and swapped by two renames, so a job that fails or is killed at any point
    leaves the old table or the new one, in its place or where ``recover`` (and so ``read_table``) finds it; ``df`` may read the
    table that it replaces. On stores where a rename copies use a transactional format, which does this itself.
    """
    if fmt not in FILE_FORMATS:
        _writer(df, fmt, partition_by).mode("overwrite").save(path)
        return
    spark, following, last = df.sparkSession, _beside(path, "next"), _beside(path, "last")
    recover(spark, path)
    _writer(df, fmt, partition_by).mode("overwrite").save(following)
    if _exists(spark, path):
        _rename(spark, path, last)
    _rename(spark, following, path)
    if _exists(spark, last):
        _delete(spark, last)
    spark.catalog.refreshByPath(path)


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """The rows dealt over files by range of ``columns`` and sorted by them in each file.

    A filter on the first column then leaves most files, row groups and pages unread, as their statistics exclude it. Ranges go
    on into the row's hash, so one value of ``columns`` with any share of the rows fills many files. Without ``files`` adaptive
    execution sizes them.
    """
    ranges = [*[F.col(f"`{c}`") for c in columns], hash_of(*[f.name for f in df.schema.fields if _hashable(f.dataType)])]
    dealt = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    return dealt.sortWithinPartitions(*[F.col(f"`{c}`") for c in columns])


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    fmt: str = DEFAULT_FORMAT,
    repair: bool = False,
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> bool:
    """Like ``write_new``, with the rows ``clustered`` and in row groups of at most about ``row_group_bytes``."""
    if is_complete(df.sparkSession, path, fmt):
        return False
    return write_new(clustered(df, columns, files), path, fmt, repair=repair, options={"parquet.block.size": str(row_group_bytes)})


def ingest_checked(
    spark: SparkSession, source: str, target: str, rejects: str, fmt: str = DEFAULT_FORMAT, repair: bool = False
) -> tuple[int, int] | None:
    """Copy a CSV file to a columnar table without its malformed lines, which go to a table ``rejects`` of their own. Returns the
    numbers of rows and of rejected lines, or None if the table was there.

    Lines are parsed once and counted on the way; only where some were rejected are they read again, to write those. The rejects
    are written first, so a table that is complete has its rejects beside it.
    """
    if is_complete(spark, target, fmt):
        return None
    spark = side_session(spark)
    checked = read_checked(spark, source)
    bad = split_rejects(checked)[1]
    counts = Observation()
    seen = checked.observe(counts, F.count("*").alias("lines"), F.count(_BAD).alias("rejected"))
    beside = _beside(target, "checked")
    split_rejects(seen)[0].write.format(fmt).mode("overwrite").save(beside)
    found = counts.get
    if found["rejected"]:
        write_replace(bad, rejects, fmt)
    if _exists(spark, target):
        if not repair and _holds_files(spark, target):
            raise FileExistsError(f"{target} holds files but no {SUCCESS_MARKER}; repair=True writes it anew")
        _delete(spark, target)
    _rename(spark, beside, target)
    return found["lines"] - found["rejected"], found["rejected"]


def ingest(
    spark: SparkSession,
    tables: Mapping[str, Sequence[str]],
    raw_root: str,
    target_root: str,
    fmt: str = DEFAULT_FORMAT,
    parallel: int = 4,
    repair: bool = False,
    rejects_root: str | None = None,
) -> dict[str, int]:
    """Copy ``{folder: [table, ...]}`` from ``raw_root/folder/table.csv`` to columnar tables, each created once.

    With ``rejects_root`` malformed lines go to tables below it instead of being cut or padded. Returns how many lines of each
    table written by this call were rejected (none are without ``rejects_root``).
    """

    def copy(name: str) -> tuple[str, int]:
        source, target = f"{raw_root}/{name}.csv", f"{target_root}/{name}"
        if rejects_root and fmt in FILE_FORMATS:
            found = ingest_checked(spark, source, target, f"{rejects_root}/{name}", fmt, repair)
            return name, found[1] if found else 0
        write_new(read_csv(spark, source), target, fmt, repair=repair)
        return name, 0

    names = [f"{folder}/{table}" for folder, tables_in in tables.items() for table in tables_in]
    rejected = dict(together(*[partial(copy, name) for name in names], parallel=parallel))
    for name, lines in rejected.items():
        if lines:
            log.warning("%s: %d malformed lines rejected", name, lines)
    return rejected


@dataclass
class TolerantRead:
    """What a tolerant read resolved: frames in order of the sources, and why the others were skipped."""

    used: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


# Conditions that mean that a source or one of its columns is not there.
ABSENT = ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN")


def read_available(
    spark: SparkSession, sources: Mapping[str, Sequence[str]], root: str = "", fmt: str = DEFAULT_FORMAT
) -> TolerantRead:
    """Scan ``{path: columns}``, leaving out with a warning every source whose path or columns do not resolve.

    Any other failure (a damaged file, a store that denies or times out) is raised: it says nothing about absence.
    """
    result = TolerantRead()
    for path, columns in sources.items():
        try:
            result.used[path] = read_table(spark, f"{root}{path}", columns, fmt)
        except AnalysisException as error:
            reason = error.getCondition() or ""
            if not reason.startswith(ABSENT):
                raise
            log.warning("skipping source %s: %s", path, reason)
            result.skipped[path] = reason
    return result


def preview(df: DataFrame, order: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*[F.col(name) for name in order]).limit(rows)
