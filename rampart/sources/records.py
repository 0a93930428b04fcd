"""Run records (A2): one JSON file per run, read against the runs that should have one.

A record that is absent, empty or not to be parsed is a status of its run and not
a missing row: the scan keeps what it found of every file, and the expected runs
are left-joined to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.operators.runs import defensive_long

#: fields of a record that the reports use; the rest of the object is ignored
RECORD = ("instance_id string, trajectory string, produced_db string, settled boolean, timed_out boolean, "
          "score int, wall_clock_s double, n_tool_calls_total string, "
          "rounds array<struct<usage: struct<totalTokens: string>>>")
SUFFIX = ".stdout.json"


def scan_record_files(spark: SparkSession, root: str, glob: str = f"*{SUFFIX}",
                      exp_pattern: str = r"([^/]+)\.stdout\.json$") -> DataFrame:
    """(exp, bytes, text) of every record file below ``root``: a file-level scan, so
    an empty file is a row too.  ``text`` is null where the bytes are not UTF-8.  A
    ``root`` with a pattern (``/runs/*``) has its many folders listed by the tasks."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root))
    return files.select(F.regexp_extract("path", exp_pattern, 1).alias("exp"), F.col("length").alias("bytes"),
                        F.try_validate_utf8(F.col("content").cast("string")).alias("text"))


def parse_records(files: DataFrame) -> DataFrame:
    """Add ``rec`` (the record's fields, null if there is no usable object) and
    ``parses`` to (exp, bytes, text)."""
    whole = F.try_parse_json("text")
    is_object = whole.isNotNull() & F.ltrim("text").startswith("{")
    rec = F.when(is_object, F.from_json("text", RECORD))
    return files.select("exp", "bytes", (F.col("bytes") > 0).alias("present"),
                        F.coalesce(is_object, F.lit(False)).alias("parses"), rec.alias("rec"))


def expected_records(grid: DataFrame, records: DataFrame) -> DataFrame:
    """Every expected run (``exp``) with its record, or ``problem``: an absent and an
    empty file read as no record, anything else that is no JSON object as unparseable.
    Where a run has several files, one that parses is taken."""
    best = records.groupBy("exp").agg(F.bool_or("present").alias("present"),
                                      F.max_by("rec", F.col("parses").cast("int")).alias("rec"))
    file = F.concat("exp", F.lit(SUFFIX))
    problem = (F.when(~F.coalesce("present", F.lit(False)), F.concat(F.lit("no record at "), file))
               .when(F.col("rec").isNull(), F.concat(F.lit("unparseable "), file)))
    return grid.join(best, "exp", "left").withColumn("problem", problem).drop("present")


def record_facts(rec: str = "rec") -> list[Column]:
    """tokens (non-numeric counts are 0, B16), tools, settled, timed_out, score, wall_s."""
    def field(name):
        return F.col(f"{rec}.{name}")
    tokens = F.aggregate(F.coalesce(field("rounds"), F.array()), F.lit(0).cast("bigint"),
                         lambda a, r: a + defensive_long(r["usage"]["totalTokens"]))
    return [tokens.alias("tokens"), defensive_long(field("n_tool_calls_total")).alias("tools"),
            field("settled").alias("settled"), field("timed_out").alias("timed_out"),
            field("score").alias("score"), field("wall_clock_s").alias("wall_s")]
