"""File sources: JSON in three shapes, lead CSV, term lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from leadgrid.sources import json_items

# The lead file contract.
LEAD_COLUMNS = ("email", "first_name", "last_name", "job_title", "seniority", "linkedin_url", "company_name",
                "company_domain", "company_linkedin", "company_industry", "company_headcount",
                "company_location", "email_status", "source", "source_id")


def read_items(spark: SparkSession, path: str, schema: StructType | str, layout: str = "lines") -> DataFrame:
    """JSON items of a file or of a folder of ``*.json``; empty files add nothing.

    ``lines``: one object per line, files are split and read in parallel. ``array``: one array
    or object per file. ``mixed``: files of either kind, known by their first character. Arrays are
    streamed item by item and files of lines are cut into pieces, so no file is ever held whole.
    An item that is no JSON gives a row of nulls; what follows the end of an array is ignored.
    """
    if layout in ("lines", "array"):
        return spark.read.schema(schema).option("multiLine", layout == "array").json(path, pathGlobFilter=_glob(path))
    if layout != "mixed":
        raise ValueError(f"unknown layout {layout}")
    item = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    # Only names and sizes: the contents column is not read.
    files = spark.read.format("binaryFile").load(path, pathGlobFilter=_glob(path)).select("path", "length")
    pieces = files.mapInArrow(json_items.cut_pieces(), json_items.PIECE)
    # A fixed number of partitions: the few bytes of a piece's name would be coalesced into one task.
    spread = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return spread.mapInArrow(json_items.read_pieces(), "value string") \
        .select(F.from_json("value", item).alias("item")).select("item.*")


def _glob(path: str) -> str:
    return "*" if path.endswith((".json", ".jsonl")) else "*.json"


def read_jsonl_glob(spark: SparkSession, pattern: str, schema: StructType | str) -> DataFrame:
    """Verdict files by glob, one JSON object per line."""
    return spark.read.schema(schema).json(pattern)


def read_lead_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted fields; header trimmed and lower-cased, missing cells empty.

    Line breaks inside quotes need one task per file; ``multi_line=False`` lets Spark split
    large files that have none.
    """
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"') \
        .option("multiLine", multi_line).option("mode", "PERMISSIVE").csv(path)
    names = [c.strip().lower() for c in raw.columns]
    return raw.toDF(*names).select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in names])


def load_terms(spark: SparkSession, path: str) -> list[str]:
    """Terms of a word list in file order: blanks and ``#`` lines skipped, first spelling kept.

    A word list is configuration: it ends up on the driver by purpose.
    """
    return [r["term"] for r in term_rows(spark.read.text(path)).orderBy("place").collect()]


def term_rows(lines: DataFrame) -> DataFrame:
    """(place, term) of what ``spark.read.text`` gives for a word list: a file, or files in the order of their names.

    A place is file, block and line. Spark deals files to tasks by size, so a line number alone does not follow
    their order. Spellings are counted by file and block before they meet: the lines are never sorted.
    """
    block = ["_metadata.file_path", "_metadata.file_block_start"]
    numbered = lines.select(*block, F.monotonically_increasing_id().alias("line"), F.trim("value").alias("term")) \
        .where((F.col("term") != "") & ~F.col("term").startswith("#"))
    spelled = numbered.groupBy("term", "file_path", "file_block_start").agg(F.min("line").alias("line"))
    return first_spelling(spelled.select(F.struct("file_path", "file_block_start", "line").alias("place"), "term"))


def first_spelling(terms: DataFrame) -> DataFrame:
    """First (place, term) of each term, case-insensitively."""
    return terms.groupBy(F.lower("term").alias("_k")).agg(
        F.min("place").alias("place"), F.min_by("term", "place").alias("term")).drop("_k")


def partition_stamp(time_col: str) -> Column:
    """Month partition of a fact table."""
    return F.date_format(time_col, "yyyy-MM")


