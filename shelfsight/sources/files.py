"""Reading and writing tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from shelfsight import config
from shelfsight.sources.records import INGEST_ORDER, read_records

def _matches(spark: SparkSession, path: str) -> list[str]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or ()]


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_matches(spark, path))


def missing_to_null(df: DataFrame, tokens: Sequence[str] = config.MISSING_TOKENS) -> DataFrame:
    """Turn the usual spellings of "no value" into NULL in every text column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append(F.when(~c.isin(*tokens), c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def read_csv_resilient(spark: SparkSession, path: str, with_source: bool = False) -> DataFrame:
    """CSV with a header, all columns as text, missing tokens as NULL; see :func:`read_records`.

    A record with more fields than the header fails the job that meets it. To
    set such records aside instead, use :func:`read_csv_with_surplus`.
    """
    found = read_records(spark, path)
    wrong = F.raise_error(F.concat(F.lit("more fields than the header: "), "surplus")).cast("boolean")
    fits = F.when(F.col("surplus").isNull(), F.lit(True)).otherwise(wrong)
    rows = missing_to_null(found.table.where(fits).drop("surplus"))
    return rows if with_source else rows.drop(*INGEST_ORDER)


def read_csv_with_surplus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, surplus): the rows with :data:`INGEST_ORDER`, and the records with more fields than the header as they stand."""
    found = read_records(spark, path)
    rows = missing_to_null(found.table.where("surplus is null").drop("surplus"))
    return rows, _surplus(found.table)


def _surplus(table: DataFrame) -> DataFrame:
    return table.where("surplus is not null").select(*INGEST_ORDER, F.col("surplus").alias("record"))


def ingest_csv(
    spark: SparkSession, path: str, target: str, quarantine: str | None = None, dataset: str = "", run_id: str = ""
) -> tuple[list[str], list[str], int]:
    """CSV to parquet with canonical names and the ingest order; returns old and new names and the row count.

    Records with more fields than the header go to the quarantine, as the text
    ``record`` with the reason ``surplus_fields``; without a quarantine they are
    an error. All records are counted while the table is written.
    """
    found = read_records(spark, path)
    seen = Observation()
    extra = F.col("surplus").isNotNull()
    counted = found.table.observe(seen, F.count_if(~extra).alias("rows"), F.count_if(extra).alias("surplus"))
    table = canonicalise(missing_to_null(counted.where(~extra).drop("surplus")))
    write_parquet(table, target)
    if seen.get["surplus"]:
        if quarantine is None:
            raise ValueError(f"{seen.get['surplus']} records with more fields than the header in {path}")
        rejected = _surplus(found.table).withColumns(
            {"failure_reason": F.lit("surplus_fields"), "_dataset": F.lit(dataset)}
        )
        append_quarantine(rejected, quarantine, run_id)
    return found.columns, [c for c in table.columns if c not in INGEST_ORDER], seen.get["rows"]


def slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def canonical_names(names: Sequence[str], aliases: Mapping[str, Sequence[str]] = config.COLUMN_ALIASES) -> list[str]:
    """Canonical name of every column; fails when two would share one."""
    canonical = {slug(alias): name for name, spellings in aliases.items() for alias in spellings}
    out = [n if n in INGEST_ORDER else canonical.get(slug(n), slug(n)) for n in names]
    clashes = sorted({n for n in out if out.count(n) > 1})
    if clashes:
        raise ValueError(f"several columns map to {clashes}: {list(names)}")
    return out


def canonicalise(df: DataFrame, aliases: Mapping[str, Sequence[str]] = config.COLUMN_ALIASES) -> DataFrame:
    return df.toDF(*canonical_names(df.columns, aliases))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table, or an empty one of the given schema when nothing is there."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def append_quarantine(rejected: DataFrame, path: str, run_id: str) -> str:
    """Add rejected rows under ``_dataset=…/_run_id=…``, keeping earlier runs."""
    (
        rejected.withColumn("_run_id", F.lit(run_id))
        .write.mode("append")
        .partitionBy("_dataset", "_run_id")
        .parquet(path)
    )
    return path


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All rejected rows. Datasets differ in columns, and a column may have another type in each."""
    found = _matches(spark, f"{path}/_dataset=*")
    reader = spark.read.option("mergeSchema", True).option("basePath", path)
    return union_by_name([reader.parquet(folder) for folder in found]) if found else reader.parquet(path)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several frames; a column that one lacks is NULL there, and one whose types differ is text."""
    types: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            types.setdefault(name, set()).add(kind)
    mixed = {name for name, kinds in types.items() if len(kinds) > 1}
    alike = [f.withColumns({c: F.col(f"`{c}`").cast("string") for c in f.columns if c in mixed}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike)


_MARK = b"\xef\xbb\xbf"


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes, sha256`` of every file of any size; each file is hashed in one task, line by line.

    Spark's reader of lines hands over their bytes as they are. It takes away the
    line feeds and a byte order mark, which the length of the file tells apart,
    and unpacks compressed files, so each suffix is read as one that stands for
    no compression. Such files are not cut either, and come in order.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("_file"))
    suffix = F.regexp_extract("path", r"(\.[^./]*)$", 1)
    hashed = []
    for (ending,) in files.select(suffix).distinct().collect():
        reader = spark.read.option("lineSep", "\n").option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        # Spark's build of Hadoop has the second name for the first.
        for name in ("io.compress.passthrough.extension", "org.apache.hadoop.shaded.io.compress.passthrough.extension"):
            reader = reader.option(name, ending or ".")
        if ending:
            reader = reader.option("pathGlobFilter", "*" + re.sub(r"([*?\[\]{}\\,^])", r"\\\1", ending))
        lines = reader.text(path).select(
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"),
            F.regexp_extract("_metadata.file_name", r"(\.[^./]*)$", 1).alias("ending"), F.col("value").cast("binary").alias("line"),
        )
        if not ending:
            # Only names without a suffix may be cut; their parts are put in order.
            lines = lines.where("ending = ''").withColumn("at", F.monotonically_increasing_id())
            lines = lines.repartition("_file").sortWithinPartitions("_file", "start", "at")
        hashed.append(lines.select("_file", "size", "line").mapInArrow(_hashed, "_file string, sha256 string"))
    if not hashed:
        return files.select("path", "bytes", F.lit(None).cast("string").alias("sha256"))
    # A file of nothing but the mark has no line.
    only = F.when(F.col("bytes") == len(_MARK), F.lit(hashlib.sha256(_MARK).hexdigest()))
    missed = F.raise_error(F.concat(F.lit("not hashed: "), "path")).cast("string")
    found = files.join(reduce(lambda a, b: a.unionByName(b), hashed), "_file", "left")
    return found.select("path", "bytes", F.coalesce("sha256", only, missed).alias("sha256"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of files from their lines in order; those of one file stand together."""
    file, size, got, plain, marked = None, 0, 0, None, None

    def finished() -> pa.RecordBatch:
        left = size - got
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{got} bytes of lines in the {size} bytes of {file}")
        found = marked if left >= 3 else plain
        if left % 3:
            found.update(b"\n")
        return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([found.hexdigest()])], ["_file", "sha256"])

    for batch in batches:
        lines = batch.column("line").to_pylist()
        start = 0
        for (name, length), same in groupby(zip(batch.column("_file").to_pylist(), batch.column("size").to_pylist())):
            stop = start + sum(1 for _ in same)
            part = b"\n".join(lines[start:stop])
            start = stop
            if name == file:
                part = b"\n" + part
            else:
                if file is not None:
                    yield finished()
                file, size, got, plain, marked = name, length, 0, hashlib.sha256(), hashlib.sha256(_MARK)
            got += len(part)
            plain.update(part)
            marked.update(part)
    if file is not None:
        yield finished()


# ---------------------------------------------------------------------------
# Cached point-of-interest responses
# ---------------------------------------------------------------------------

ELEMENT = "struct<lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>"
_KEY = r"([^/]+)__(\d+)(?:\.json)?$"


def read_poi_responses(spark: SparkSession, path: str) -> DataFrame:
    """``outlet_id, radius_m, element`` from saved responses, one JSON file per outlet and radius.

    The key is the file name ``<outlet>__<radius>.json``. A file that is no
    JSON yields one row with a NULL element and ``corrupt`` set.
    """
    raw = (
        spark.read.schema(f"elements array<{ELEMENT}>, _corrupt_record string")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("_key"))
    )
    return _explode_responses(raw, F.col("_corrupt_record").isNotNull())


def read_poi_response_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same from a compacted cache: JSON lines ``{"key": "<outlet>__<radius>", "elements": […]}``.

    Millions of small files are slow to list; this form splits like any table.
    """
    raw = (
        spark.read.schema(f"key string, elements array<{ELEMENT}>, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .json(path)
        .withColumnRenamed("key", "_key")
    )
    return _explode_responses(raw, F.col("_corrupt_record").isNotNull())


def _explode_responses(raw: DataFrame, corrupt: Column) -> DataFrame:
    return raw.select(
        F.regexp_extract("_key", _KEY, 1).alias("outlet_id"),
        F.regexp_extract("_key", _KEY, 2).try_cast("int").alias("radius_m"),
        corrupt.alias("corrupt"),
        F.explode_outer("elements").alias("element"),
    )
