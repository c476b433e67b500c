"""Delimited text files, read as text columns with malformed lines kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tamiz import vocabulary as v
from tamiz.functions.text import message
from tamiz.operators.rules import REJECT_REASON
from tamiz.session import Scratch, checkpointed

MALFORMED, COMMENT = "_corrupt", "_comment"
FILE, BLOCK, POSITION, LINE = "_file", "_block", "_position", "_line"
SEQ = "seq"
_FIRST, _BEFORE, _BEFORE_FILE = "__first_position", "__rows_before", "__rows_before_file"
_HEADER_LINES, _OPEN, _HEADER = 1, "__first_open", "__header_line"
_COMMENT_MARK, _QUOTE, _BORDER = "#", '"', "\n"
BROADCAST_BYTES = 64 << 20


def split_fields(line: Column) -> Column:
    """The fields of a line as an array: a border is a comma after an even number of
    quotes, wherever they stand; a quote that is never closed reaches to the end.
    A field within quotes loses them, and pairs of quotes in it become one; an empty
    field is null."""
    return F.transform(_split(line, _bare(line)), lambda field: F.nullif(field, F.lit("")))


def _bare(line: Column) -> Column:
    """The line with empty fields instead of those that are a pair of quotes.  Such fields
    next to each other share a comma, so every other one goes first."""
    pair, bare = F.lit(f",{_QUOTE * 2},"), F.concat(F.lit(","), line, F.lit(","))
    for _ in range(2):
        bare = F.replace(bare, pair, F.lit(",,"))
    return F.when(F.contains(line, F.lit(_QUOTE)), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(line)


def _split(line: Column, bare: Column) -> Column:
    """The fields with empty ones as they are.  Where ``_bare`` left no quote, every
    comma is a border: the quotes before it came in pairs."""
    return F.when(F.contains(bare, F.lit(_QUOTE)), _split_quoted(line)).otherwise(F.split(bare, ","))


def _split_quoted(line: Column) -> Column:
    # What stands between two quotes is inside or outside of them by turns.  No
    # line holds a line feed, which so can mark the borders.
    outside = lambda part, place: F.when(place % 2 == 0, F.replace(part, F.lit(","), F.lit(_BORDER))).otherwise(part)
    marked = F.array_join(F.transform(F.split(line, _QUOTE), outside), _QUOTE)
    return F.transform(F.split(marked, _BORDER), _unquoted)


def _unquoted(field: Column) -> Column:
    text = F.trim(field)
    single = F.replace(text, F.lit(_QUOTE * 2), F.lit(_QUOTE))
    inner = F.substring(single, F.lit(2), F.greatest(F.length(single) - 2, F.lit(0)))
    return F.when(text.startswith(_QUOTE) & text.endswith(_QUOTE), inner).otherwise(field)


def read_lines(spark: SparkSession, path: str | Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per line of the files, header and comments included: ``fields``
    as text, the raw line in ``_corrupt`` if it has too few or too many fields
    (a blank line has too few), and where in the input it stood.

    Lines are read as text and split afterwards, so that every line is counted
    and one that is ragged is noticed whichever columns a query reads.  A field
    cannot span lines, so large files split.
    """
    ragged = (F.size("parsed") != len(fields)) | (F.trim("value") == "")
    return (
        spark.read.text([path] if isinstance(path, str) else list(path))
        .select(
            "value",
            _bare(F.col("value")).alias("bare"),
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(POSITION),
        )
        .select("*", _split(F.col("value"), F.col("bare")).alias("parsed"))
        .select(
            *[F.nullif(F.get("parsed", F.lit(place)), F.lit("")).alias(name) for place, name in enumerate(fields)],
            F.when(ragged, F.col("value")).alias(MALFORMED),
            F.col("value").startswith(_COMMENT_MARK).alias(COMMENT),
            FILE,
            BLOCK,
            POSITION,
        )
    )


def stage_lines(
    scratch: Scratch, path: str | Sequence[str], fields: Sequence[str]
) -> tuple[DataFrame, int]:
    """The data lines of ``path``, parsed once into the shared folder and
    numbered, and how many lines there are below the headers.

    Everything a job does afterwards reads this columnar copy: the text is
    parsed once, positions no longer depend on how it was split, and a lost
    executor costs a re-read rather than a re-parse.
    """
    return number_lines(scratch.stage(read_lines(scratch.spark, path, fields), "lines"))


def number_lines(
    lines: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, int]:
    """``lines`` without headers and comments, with ``_line``, the line number
    in the file, and ``seq``, the index below the headers in the whole input
    (files in path order); and the number of lines below the headers.

    A line's position inside its file split is known when it is read; what is
    missing is the number of lines before the split.  That table has one row
    per split, so its size follows the number of input blocks: it is measured
    and broadcast while small, joined by shuffle (a split is a bounded group)
    beyond that.
    """
    splits = checkpointed(
        lines.groupBy(FILE, BLOCK).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(POSITION).alias(_FIRST),
            F.min(F.when(~F.col(COMMENT), F.col(POSITION))).alias(_OPEN),
        )
    )
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    within = splits.withColumn(_BEFORE, F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    # One row per input file, a list the driver holds anyway to plan the scan.
    all_earlier = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    below_header = F.sum("rows") - F.lit(_HEADER_LINES)
    before = (
        splits.groupBy(FILE)
        .agg(below_header.alias("rows"))
        .select(FILE, F.coalesce(F.sum("rows").over(all_earlier), F.lit(0)).alias(_BEFORE_FILE))
    )
    # The header is the first line of a file that is no comment.
    opened = within.groupBy(FILE).agg(
        F.min(F.col(_BEFORE) + F.col(_OPEN) - F.col(_FIRST) + F.lit(1)).alias(_HEADER)
    )
    offsets = checkpointed(within.drop(_OPEN).join(before, FILE).join(opened, FILE))
    size, rows, files = offsets.agg(
        F.coalesce(F.sum(F.octet_length(FILE) + F.lit(48)), F.lit(0)),
        F.coalesce(F.sum("rows"), F.lit(0)),
        F.count_distinct(FILE),
    ).first()
    offsets = offsets.drop("rows")
    if size <= broadcast_bytes:
        offsets = F.broadcast(offsets)
    numbered = (
        lines.join(offsets, [FILE, BLOCK])
        .withColumn(LINE, F.col(_BEFORE) + F.col(POSITION) - F.col(_FIRST) + F.lit(1))
        .withColumn(SEQ, F.col(_BEFORE_FILE) + F.col(LINE) - F.lit(_HEADER_LINES + 1))
        .where((F.col(LINE) > F.col(_HEADER)) & ~F.col(COMMENT))
        .drop(_FIRST, _BEFORE, _BEFORE_FILE, _HEADER, POSITION, BLOCK, COMMENT)
    )
    return numbered, rows - _HEADER_LINES * files


def readable(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(lines: DataFrame) -> DataFrame:
    """Lines with the wrong number of fields, with the reason for the log."""
    reason = message(
        f"{v.MALFORMED_LINE}: {v.MSG_MALFORMED_LINE}", F.col(LINE), F.col(FILE), F.col(MALFORMED)
    )
    return lines.where(F.col(MALFORMED).isNotNull()).select(SEQ, reason.alias(REJECT_REASON))
