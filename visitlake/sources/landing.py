"""Landing of raw click files: one folder per source month, every line kept as it is."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake import schemas as S
from visitlake.session import staged

_NO_SEPARATOR = "\u0001"
_NO_QUOTE = "\u0000"


class LandingError(Exception):
    """The landing request is not valid."""


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines without their CR/LF ending, one column named ``line``."""
    return spark.read.option("recursiveFileLookup", True).text(path).withColumnRenamed("value", "line")


def _is_header():
    return F.col("line").contains(S.SOURCE_VISIT_COLUMN)


def _month():
    fields = F.split("line", S.SOURCE_SEPARATOR, 3)
    return F.format_string("%04d-%02d", fields[0].cast("bigint"), fields[1].cast("bigint"))


def header_and_months(lines: DataFrame) -> tuple[str, dict[str, int]]:
    """The header that all source files share, and the number of data lines of each month, in one scan.

    A file with another header would have its fields at other places: that stops the landing.
    """
    # Lines are counted by the text of their first two fields, of which there are few; only then months are made of it.
    start = F.when(~_is_header(), F.substring_index("line", S.SOURCE_SEPARATOR, 2)).alias("line")
    counted = (lines.filter(F.trim("line") != "").groupBy(F.when(_is_header(), F.col("line")).alias("header"), start)
               .agg(F.count("*").alias("lines")).groupBy("header", F.when(F.col("line").isNotNull(), _month()).alias("month"))
               .agg(F.sum("lines").alias("count")).collect())
    headers = sorted(row["header"] for row in counted if row["header"] is not None)
    if len(headers) != 1:
        raise LandingError(f"the source files must share one header line; found {headers}")
    return headers[0], {row["month"]: row["count"] for row in counted if row["month"] is not None}


def split_by_month(lines: DataFrame, header: str, months: list[str]) -> DataFrame:
    """Data lines of the requested months with their ``source_month``; header and blank lines are left out.

    A line whose first two fields are not numbers stops the job, as it is not a click line.
    """
    return (lines.filter((F.trim("line") != "") & (F.col("line") != header))
            .withColumn("source_month", _month())
            .filter(F.col("source_month").isin(months)))


def write_month_files(lines: DataFrame, header: str, landing: str) -> None:
    """Replace the month folders present in ``lines``. Each file starts with the header and has LF endings.

    The rebalance hint gathers a month into few files and still splits a month that holds most of the rows.
    """
    (lines.hint("rebalance", "source_month")
     .select(F.col("line").alias(header), "source_month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_month")
     .option("header", True).option("sep", _NO_SEPARATOR).option("quote", _NO_QUOTE).option("escape", _NO_QUOTE)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(landing))


def empty_month_files(spark: SparkSession, header: str, landing: str, months: list[str]) -> None:
    """Leave only a header in the given months, so that an emptied month holds no old rows."""
    for month in months:
        (spark.createDataFrame([], "line string").coalesce(1).select(F.col("line").alias(header))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .option("header", True).option("sep", _NO_SEPARATOR).option("quote", _NO_QUOTE)
         .csv(f"{landing}/source_month={month}"))


def land_months(spark: SparkSession, source: str, landing: str, months: list[str], fingerprint: str,
                allowed: list[str] | None = None) -> DataFrame:
    """Land the requested months of a source file set and report ``source_month, rows, action``.

    A month already landed from a source with the same fingerprint is skipped, so a repeated call changes nothing.
    """
    months = sorted(set(months))
    unknown = [month for month in months if allowed is not None and month not in allowed]
    if not months or unknown:
        raise LandingError(f"cannot land {unknown or 'no month at all'}; known months: {allowed or 'any'}")
    record = f"{landing}/_landed"
    landed = _landed_months(spark, record, fingerprint)
    todo = [month for month in months if month not in landed]
    lines = read_lines(spark, source)
    counted = {}
    if todo:
        header, found = header_and_months(lines)
        chosen = split_by_month(lines, header, todo)
        counted = {month: found[month] for month in todo if month in found}
        write_month_files(chosen, header, landing)
        empty_month_files(spark, header, landing, [month for month in todo if month not in counted])
        (spark.createDataFrame([(month, fingerprint, counted.get(month, 0)) for month in todo],
                               "source_month string, fingerprint string, rows bigint")
         .coalesce(1).withColumn("landed_time", F.current_timestamp()).write.mode("append").parquet(record))
    report = [(month, counted.get(month, 0), "written") for month in todo]
    report += [(month, landed[month], "already landed") for month in months if month not in todo]
    return spark.createDataFrame(sorted(report), "source_month string, rows bigint, action string")


def _landed_months(spark: SparkSession, record: str, fingerprint: str) -> dict[str, int]:
    """Months whose latest landing came from this fingerprint. The record has one row per month and landing."""
    if not path_exists(spark, record):
        return {}
    latest = (spark.read.parquet(record).groupBy("source_month")
              .agg(F.max_by(F.struct("fingerprint", "rows"), "landed_time").alias("last")))
    return {row["source_month"]: row["last"]["rows"] for row in latest.collect()
            if row["last"]["fingerprint"] == fingerprint}


def erase_visit_lines(spark: SparkSession, landing: str, months: list[str], visits: DataFrame) -> None:
    """Rewrite month folders without the lines of the given visits; all other lines keep their text.

    A line's visit is read as the click reader reads it, so quotes, blanks and leading zeros do not hide a visit. The kept
    lines are staged first: the month folders are replaced only once a full copy exists elsewhere.
    """
    lines = (spark.read.option("basePath", landing)
             .text([f"{landing}/source_month={month}" for month in months]).withColumnRenamed("value", "line"))
    header = only_header(lines)
    names = header.lstrip("\ufeff").split(S.SOURCE_SEPARATOR)
    fields = T.StructType([T.StructField(f"c{place}", T.StringType()) for place in range(len(names))])
    visit = F.from_csv("line", fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                       {"sep": S.SOURCE_SEPARATOR})[f"c{names.index(S.SOURCE_VISIT_COLUMN)}"].try_cast("bigint")
    data = lines.filter((F.col("line") != header) & (F.trim("line") != "")).withColumn("visit_id", visit)
    kept = data.join(visits.select("visit_id").distinct(), "visit_id", "left_anti").select("line", "source_month")
    kept = staged(kept, "kept-lines")
    write_month_files(kept, header, landing)
    left = [row[0] for row in kept.select("source_month").distinct().collect()]
    empty_month_files(spark, header, landing, [month for month in months if month not in left])


def only_header(lines: DataFrame) -> str:
    """The header that all files share. Files with another one would have their fields at other places."""
    headers = lines.select("line").filter(_is_header()).distinct().limit(2)
    found = [row["line"] for row in headers.collect()]
    if len(found) != 1:
        raise LandingError(f"the landed files must share one header line; found {found}")
    return found[0]


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
