"""Files of one JSON record a line, read as good records and rejects: which line of which file, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_JSON, NOT_A_RECORD = "not json", "not a record"


def read_lines(spark: SparkSession, root: str, globs: Sequence[str] = ("*.jsonl",)) -> DataFrame:
    """file, split, place and line of the files below root whose names fit one of the globs; other files are not opened.

    place ascends within a file's split. A folder without such files gives no lines.
    """
    glob = globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(root)
    at = F.col("_metadata")
    return text.select(at["file_path"].alias("file"), at["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def _reason(line: Column) -> Column:
    """Why a line is no record, or null; blank lines are passed over without a reason."""
    given = F.try_parse_json(line)
    return F.when(F.trim(F.regexp_replace(line, r"(?U)\s+", " ")) == "", "").when(given.isNull(), NOT_JSON).when(~F.schema_of_variant(given).startswith("OBJECT"), NOT_A_RECORD)


def read_with_rejects(spark: SparkSession, root: str, schema: T.StructType | str, globs: Sequence[str] = ("*.jsonl",)) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): the records' fields and their file; and file, line_number, reason and text of lines that are no JSON object.

    A field of another type than the schema's is null in its record, which stays. Lines are numbered from 1 as a file has them, blank
    ones counted: a split's lines follow those of the file's splits before it, whose sizes are one row a split.
    """
    lines = read_lines(spark, root, globs).withColumn("reason", _reason(F.col("line")))
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # each field on its own, so that one of another shape does not take the rest with it
    value = lambda f: F.try_variant_get(F.col("v"), f"$['{f.name}']", "string").try_cast(f.dataType) if isinstance(f.dataType, T.AtomicType) else F.from_json(F.to_json(F.try_variant_get(F.col("v"), f"$['{f.name}']", "variant")), f.dataType)
    records = lines.where("reason is null").select("file", F.try_parse_json("line").alias("v")).select("file", *[value(f).alias(f.name) for f in fields])
    sizes = lines.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", "split", (before - F.col("first") + 1).alias("start"))
    bad = lines.where("reason <> ''").join(starts, ["file", "split"])
    return records, bad.select("file", (F.col("place") + F.col("start")).alias("line_number"), "reason", F.col("line").alias("text"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """file, reason and how many lines."""
    return rejects.groupBy("file", "reason").agg(F.count("*").alias("lines"))
