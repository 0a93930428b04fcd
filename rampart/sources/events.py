"""Tolerant JSONL event scan (A1, B8) with the file order fixed at ingest.

Blank and unparsable lines are skipped, never turned into empty events.  A
cheap substring pre-filter runs before any JSON parsing (Catalyst cannot
derive it from the parse).

Order: a text scan has no line number and one file's splits may be read in
any order, so ``seq`` is fixed from the split's byte offset
(``_metadata.file_block_start``) plus a line id that rises within the split
(``monotonically_increasing_id``).  (file, seq_block, seq_line) sorts exactly
like the file; lines are filtered and parsed before anything is kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.session import cut_lineage


def parse_event_lines(lines: DataFrame, *, prefilter: str | None = None,
                      fields: Mapping[str, tuple[str, str]],
                      text_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse one JSON object per line into typed fields; drop bad lines.

    ``fields`` maps an output name to ``(json path, type)``; the parsed
    VARIANT is kept as ``event`` for polymorphic fields.
    """
    txt = F.col(text_col)
    df = lines.where(F.trim(txt) != "")
    if prefilter:
        df = df.where(txt.contains(prefilter))
    v = F.try_parse_json(txt)
    df = df.select(*keep, v.alias("event")).where(
        F.col("event").isNotNull() & F.schema_of_variant("event").startswith("OBJECT"))
    return df.select(*keep, *[F.try_variant_get("event", path, typ).alias(name)
                              for name, (path, typ) in fields.items()], "event")


def read_event_log(spark: SparkSession, path: str, *, prefilter: str | None = None,
                   fields: Mapping[str, tuple[str, str]] | None = None,
                   run_from_path: str = r"([^/]+)/[^/]*$") -> DataFrame:
    """Read JSONL trajectory files into ``(run, file, seq_block, seq_line, ...)``.

    ``run_from_path`` extracts the run id from the file path (default: the
    parent folder name).  The parsed lines are checkpointed (reliably) so
    the ids cannot change on recomputation; blank, broken and filtered-out lines
    are not written.
    """
    fields = dict(fields or {"type": ("$.type", "string")})
    raw = (spark.read.option("recursiveFileLookup", "true").text(path)
           .select("value", F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("seq_block"),
                   F.monotonically_increasing_id().alias("seq_line")))
    parsed = parse_event_lines(
        raw.withColumn("run", F.regexp_extract("file", run_from_path, 1)), prefilter=prefilter,
        fields=fields, keep=("run", "file", "seq_block", "seq_line"))
    return cut_lineage(parsed)
