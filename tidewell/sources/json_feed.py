"""Typed JSON scans and JSON record sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.session import new_workspace
from tidewell.sources.json_array import read_arrays


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


#: Column for the text of a record that is no JSON of the declared layout.
MALFORMED = "_malformed"


#: Files whose first bytes the driver asks for; more of them are looked at by tasks.
_FILES_ASKED = 1000
#: Bytes of a file in which its opening bracket is looked for, before tasks read the file.
_BLANKS_READ = 64


def _by_first_byte(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, int]]:
    """The opening bracket and size of the files that start with one behind blanks, by reading no more than that."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = {}
    for file in files:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        fs = where.getFileSystem(conf)
        stream, first = fs.open(where), " "
        try:
            for _ in range(_BLANKS_READ):
                if first not in " \r\n" or (byte := stream.read()) < 0:
                    break
                first = chr(byte)
        finally:
            stream.close()
        if first in "{[":
            found[file] = (first, fs.getFileStatus(where).getLen())
    return found


def files_by_layout(spark: SparkSession, path: str) -> tuple[list[str], dict[str, int]]:
    """The files of a feed with one record per line, and those that are one JSON array, with their size.

    The first character that is not blank decides, for each file by itself; all the driver sees of a file is its
    name and that character. A file that starts with neither fails: nothing of it could be read as a record.

    Files are only opened where they are few; others, and those that start in another way (with many blanks, a byte
    order mark, compressed), are read by tasks. Their text is cut after closing braces: an array may be a single line.
    """
    files = list(spark.read.text(path).inputFiles())
    told = _by_first_byte(spark, files) if len(files) <= _FILES_ASKED else {}
    by_line, arrays = sorted(f for f, (first, _) in told.items() if first == "{"), {f: size for f, (first, size) in told.items() if first == "["}
    rest = [f for f in files if f not in told]
    if not rest:
        return by_line, arrays
    lines = spark.read.option("lineSep", "}").text(rest if told else path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("line")).alias("place"),
        F.col("_metadata.file_size").alias("size"),
        F.substring(F.ltrim("value", F.lit(" \r\n")), 1, 1).alias("first"),
    )
    firsts = lines.where("first <> ''").groupBy("file").agg(F.min_by("first", "place").alias("first"), F.max("size").alias("size")).collect()
    odd = sorted(r["file"] for r in firsts if r["first"] not in "{[")
    if odd:
        raise ValueError(f"neither records nor an array: {', '.join(odd[:5])}")
    return sorted([*by_line, *(r["file"] for r in firsts if r["first"] == "{")]), arrays | {r["file"]: r["size"] for r in firsts if r["first"] == "["}


def read_feed(
    spark: SparkSession,
    path: str,
    layout: T.StructType,
    array_layout: bool | None = None,
    keep_malformed: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Scan a feed with its declared types, never with inferred ones.

    A feed that declares its layout is read in one pass. Without a declaration, its files are told apart first,
    and a folder may mix both kinds. Record-per-line files split over tasks; so do array files of more than
    ``split_bytes`` (by default what the session reads in a task), smaller ones are a task each. Splits have
    ``split_bytes`` at least, more where that would make very many. NaN becomes NULL on the way in: it would compare
    above every limit later on.

    With ``keep_malformed``, text that is no record stays in the column ``_malformed``, for the quarantine;
    otherwise such a record has NULL in every column.
    """
    if array_layout is None:
        by_line, arrays = files_by_layout(spark, path)
        most = split_bytes or int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        large = sorted(f for f, size in arrays.items() if size > most)
        small = sorted(f for f, size in arrays.items() if size <= most)
    else:
        by_line, small, large = ([], [path], []) if array_layout else ([path], [], [])
    columns = with_malformed(layout) if keep_malformed else layout
    options = {"columnNameOfCorruptRecord": MALFORMED} if keep_malformed else {}

    def scan(files: list[str], multi_line: bool) -> DataFrame:
        return spark.read.schema(columns).options(**options).option("multiLine", multi_line).json(files)

    parts = [scan(files, kind) for files, kind in ((by_line, False), (small, True)) if files]
    if large:
        parts.append(read_arrays(spark, large, schemas.as_nullable(columns), options, new_workspace(spark, "array-feed"), split_bytes))
    raw = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.as_nullable(columns))
    return without_nan(raw, layout)


def without_nan(raw: DataFrame, layout: T.StructType) -> DataFrame:
    doubles = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in layout.fields if isinstance(f.dataType, T.DoubleType)
    }
    return raw.withColumns(doubles) if doubles else raw


def with_malformed(layout: T.StructType) -> T.StructType:
    return T.StructType([*layout.fields, T.StructField(MALFORMED, T.StringType())])


def read_optional_feed(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The feed, or an empty frame of its layout while no device delivers it yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], layout)
    return read_feed(spark, path, layout)


def write_records(df: DataFrame, path: str) -> None:
    """Record-per-line JSON, one folder per table, written by all tasks."""
    df.write.mode("overwrite").json(path)
