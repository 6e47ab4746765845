"""CSV records that may go over several lines, cut in parallel.

A line break inside quotes does not end a record, so whether a line starts a
record depends on all lines before it in the file. What one line does to that
question is a function of two states, outside and inside quotes; such functions
compose, so the state at a line is a prefix scan: first over the lines of each
split, then over the splits of each file, of which there is one per some hundred
megabytes. Only lines that change or settle the state take part, and only those
of files in which any line ends inside quotes.
"""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfsight.session import stage

# Where a row came from: the number of its first line among the lines of all files, by name of
# the file. It orders the rows and identifies them. One number of fixed width travels through
# every shuffle of the checks, and the least of several is found by a hash aggregate.
INGEST_ORDER = ("_src_row",)

_MARK = "﻿"  # a byte-order mark
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_UNCLOSED = rf'(?:{_FIELD},)*+"[^"]*+(?:""[^"]*+)*+\z'
#: A line that starts a record and ends inside quotes. A quote inside an unquoted field is a character like any other.
OPENS = rf"\A{_UNCLOSED}"
#: A line that starts inside quotes and ends so: without a closing quote, or with a new field left open.
RESUMES = rf'\A[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_UNCLOSED})'


@dataclass(frozen=True)
class CsvRecords:
    """``table`` has the columns as text, :data:`INGEST_ORDER`, and ``surplus``: the record if it has more fields than the header."""

    columns: list[str]
    table: DataFrame


def _physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, split and number, what it does to the quotes, and whether it is UTF-8."""
    raw = spark.read.option("lineSep", "\n").text(path)
    split = F.col("_metadata.file_block_start")
    raw = raw.select(
        F.col("_metadata.file_path").alias("path"), split.alias("split"), F.monotonically_increasing_id().alias("row"),
        F.when((split == 0) & F.col("value").startswith(_MARK), F.substr("value", F.lit(2))).otherwise(F.col("value")).alias("line"),
    )
    return raw.select(
        "path", "split", "row", F.col("line").cast("binary").alias("bytes"), F.col("line").rlike(OPENS).alias("opens"),
        F.col("line").rlike(RESUMES).alias("resumes"), F.is_valid_utf8("line").alias("utf8"),
        F.col("line").rlike(r"\A\r?\z").alias("blank"),
    )


def _turns(marks: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines at which a file goes into quotes or out of them."""
    order = Window.partitionBy("path", "split").orderBy("row")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    after = (F.coalesce("settled", "before_split") + F.col("flips")) % 2
    seen = (
        _composed(marks, upto)
        .join(splits, ["path", "split"])
        .withColumn("after", after)
        .withColumn("before", F.coalesce(F.lag("after").over(order), F.col("before_split")))
    )
    return seen.where("before != after").select("path", "split", "row", (F.col("after") == 1).alias("opening"))


def _composed(marks: DataFrame, upto) -> DataFrame:
    """The function of all lines up to each: the state it settles, if any line did, and the flips behind.

    With the state before the first line in place of ``settled`` where that is
    null, (settled + flips) % 2 is the state after the line.
    """
    marks = marks.withColumn("flips", F.sum(F.when(F.col("opens") & ~F.col("resumes"), 1).otherwise(0)).over(upto))
    fixed = F.when(F.col("opens") == F.col("resumes"), (F.col("opens").cast("int") + F.col("flips")) % 2)
    return marks.withColumn("settled", F.last(fixed, ignorenulls=True).over(upto))


def _states_of_splits(marks: DataFrame) -> DataFrame:
    """The state in which each split with marks starts: a scan over one row per split."""
    inside = Window.partitionBy("path", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max_by(F.struct("settled", "flips"), "row").alias("f")
    whole = _composed(marks, inside).groupBy("path", "split").agg(last)
    odd, settled = F.col("f.flips") % 2 == 1, F.col("f.settled").isNotNull()
    ends_one = settled & ((F.col("f.settled") + F.col("f.flips")) % 2 == 1)
    # As a line: what the split makes of either state.
    as_line = whole.select(
        "path", "split", F.when(settled, ends_one).otherwise(odd).alias("opens"), F.when(settled, ends_one).otherwise(~odd).alias("resumes")
    )
    order = Window.partitionBy("path").orderBy("split")
    state = (F.coalesce("settled", F.lit(0)) + F.col("flips")) % 2
    done = _composed(as_line, order.rowsBetween(Window.unboundedPreceding, 0)).withColumn("after", state)
    return done.select("path", "split", F.coalesce(F.lag("after").over(order), F.lit(0)).alias("before_split"))


def _spans(turns: DataFrame, bounds: DataFrame) -> DataFrame:
    """``path, low, high, record``: the lines of each record of several lines, split by split; ``record`` is its first line."""
    order = Window.partitionBy("path", "split").orderBy("row")
    paired = turns.withColumn("close", F.lead("row").over(order)).where("opening")
    inside = paired.where("close is not null").select("path", F.col("row").alias("low"), F.col("close").alias("high"), F.col("row").alias("record"))
    # A record left open at the end of a split closes at the first turn of the next split that has one.
    along = Window.partitionBy("path").orderBy("split")
    turned = turns.groupBy("path", "split").agg(F.min("row").alias("first"), F.max("row").alias("last"), F.max_by("opening", "row").alias("open"))
    turned = turned.withColumns({"end_split": F.lead("split").over(along), "end_row": F.lead("first").over(along)}).where("open")
    never = F.raise_error(F.concat(F.lit("a quoted field is never closed: "), "path")).cast("long")
    opened = turned.select(
        "path", F.col("split").alias("record_split"), F.col("last").alias("record"), F.coalesce("end_split", never).alias("end_split"), "end_row"
    )
    first, last = F.col("split") == F.col("record_split"), F.col("split") == F.col("end_split")
    over = opened.join(bounds, "path").where(F.col("split").between(F.col("record_split"), F.col("end_split")))
    return inside.unionByName(
        over.select(
            "path", F.when(first, F.col("record")).otherwise(F.col("low")).alias("low"),
            F.when(last, F.col("end_row")).otherwise(F.col("high")).alias("high"), "record",
        )
    )


def _members(lines: DataFrame, splits: DataFrame, most_lines: int) -> DataFrame:
    """``row, record`` of every line of a record of several lines."""
    files = splits.where("opens").select("path").distinct()
    if files.isEmpty():
        return lines.limit(0).select(F.col("row").alias("record"), "row")
    marks = lines.where("opens or not resumes").select("path", "split", "row", "opens", "resumes").join(files, "path", "left_semi")
    marks = stage(marks, "csv_marks")
    bounds = lines.join(files, "path", "left_semi").groupBy("path", "split").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    spans = stage(_spans(_turns(marks, _states_of_splits(marks)), bounds), "csv_spans")
    long = spans.groupBy("path", "record").agg(F.sum(F.col("high") - F.col("low") + 1).alias("n")).where(F.col("n") > most_lines).first()
    if long:
        raise ValueError(f"a record of {long.n} lines in {long.path}: a quote that is not meant to be one?")
    return spans.select("record", F.explode(F.sequence("low", "high")).alias("row"))


def _numbered(lines: DataFrame) -> DataFrame:
    """A row per split: how its lines are numbered on, with the encoding and the header line of its file."""
    first = F.min(F.when((F.col("split") == 0) & ~F.col("blank"), F.col("row")))
    splits = lines.groupBy("path", "split").agg(
        F.count("*").alias("lines"), F.min("row").alias("low"), F.every("utf8").alias("utf8"), F.some("opens").alias("opens"), first.alias("first")
    )
    file = Window.partitionBy("path")
    before = F.sum("lines").over(Window.orderBy("path", "split")) - F.col("lines")  # over one row per split
    return splits.select(
        "path", "split", (before - F.col("low")).alias("shift"), F.every("utf8").over(file).alias("all_utf8"),
        F.some("opens").over(file).alias("opens"), F.min("first").over(file).alias("header"),
    )


def _whole_records(lines: DataFrame, splits: DataFrame, most_lines: int) -> DataFrame:
    """``number, head, record``: each record as one text, at the number of its first line; ``head`` marks the header of a file."""
    members = _members(lines, splits, most_lines)
    text = F.when(F.col("all_utf8"), F.decode("bytes", "UTF-8")).otherwise(F.decode("bytes", "ISO-8859-1"))
    # Splits are few and lines of long records mostly too; made of written tables, they are broadcast by their true size.
    joined = lines.select("path", "split", "row", "bytes", "blank").join(splits.drop("opens"), ["path", "split"]).join(members, "row", "left")
    joined = joined.select("record", "blank", (F.col("row") + F.col("shift")).alias("number"), (F.col("row") == F.col("header")).alias("head"), text.alias("line"))
    single = joined.where("record is null and not blank").select("number", "head", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("number", "line")))  # no more than ``most_lines``
    several = joined.where("record is not null").groupBy("record").agg(parts.alias("parts"), F.max("head").alias("head"))
    several = several.select(F.col("parts")[0]["number"].alias("number"), "head", F.array_join("parts.line", "\n").alias("record"))
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def _names(header: str) -> list[str]:
    """Column names of a header record; a repeated one gets a number, one without a name its place."""
    out: list[str] = []
    for at, name in enumerate(next(csv.reader(io.StringIO(header, newline="")))):
        name, times = name or f"Unnamed: {at}", 0
        base = name
        while name in out:
            times += 1
            name = f"{base}.{times}"
        out.append(name)
    return out


def _header(records: DataFrame, path: str) -> str:
    """The header, which all files that hold anything must share."""
    found = records.where("head").select("record").distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no header' if not found else 'files with different headers'}: {path}")
    return found[0].record


def read_records(spark: SparkSession, path: str, most_lines: int = 100_000) -> CsvRecords:
    """All records below a path, whose files share a header.

    Fields are split by commas and may be quoted; a quote in a quoted field is
    doubled. A field may hold line breaks. A line ends with LF or CR LF; empty
    lines are passed over. A file is Latin-1 if any byte of it is not UTF-8, and
    UTF-8 otherwise; a byte-order mark is dropped. A record with fewer fields than
    the header has nulls at its end; ``surplus`` holds a record with more.
    A quote that is never closed, a record of more than ``most_lines`` lines and
    files whose headers differ are errors.

    The lines are written once with what they do to the quotes. Lines of records
    of one line, the bulk, are not shuffled.
    """
    lines = stage(_physical_lines(spark, path), "csv_lines")
    records = _whole_records(lines, stage(_numbered(lines), "csv_splits"), most_lines)
    columns = _names(_header(records, path))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    parsed = records.where("not coalesce(head, false)").withColumn("f", F.from_csv("record", schema, options))
    fields: list[Column] = [F.col(f"f.c{i}").alias(c) for i, c in enumerate(columns)]
    commas = F.length("record") - F.length(F.replace("record", F.lit(",")))
    more = (commas >= len(columns)) & F.col("record").rlike(rf"\A(?:{_FIELD},){{{len(columns)}}}")
    surplus = F.when(more, F.col("record")).alias("surplus")
    return CsvRecords(columns, parsed.select(*fields, F.col("number").alias(INGEST_ORDER[0]), surplus))
