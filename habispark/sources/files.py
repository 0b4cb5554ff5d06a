"""CSV, JSON and Parquet readers with explicit schemas; nothing is inferred from values."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habispark import commits
from habispark.constants import CERTIFICATE_FIELDS, COG_COLUMNS, SALES_COLUMNS, SAMPLE_ROWS
from habispark.functions import normalize_null_tokens


class SchemaError(RuntimeError):
    """A source lacks columns that the operators need, named in `missing`."""

    def __init__(self, message: str, missing: Sequence[str] = ()):
        super().__init__(message)
        self.missing = tuple(missing)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    """The frame itself, or an error that lists missing and present columns; runs no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaError(f"{what}: missing columns {missing}; present columns {sorted(df.columns)}", missing)
    return df


def _read_text_csv(
    spark: SparkSession, path: str, partitions: dict[str, T.DataType], base: str | None = None
) -> DataFrame:
    """All columns as text, named by the header. Files whose header differs are refused."""
    # Quoted cells may hold line breaks.
    options = {"header": True, "multiLine": True, "escape": '"'} | ({"basePath": base} if base else {})
    header = spark.read.options(**options).csv(path).columns
    fields = [
        T.StructField(name, partitions.get(name, T.StringType())) for name in header
    ]
    # enforceSchema=False compares every file's header with the schema.
    reader = spark.read.options(**options, enforceSchema=False)
    return reader.schema(T.StructType(fields)).csv(path)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales from `annee_fichier=YYYY[/departement=DD]/*.csv.gz`, missing markers as NULL.

    A gzip file is one input split; once converted to Parquet its rows are splittable. Columns beyond the
    required ones may differ from year to year; all years are split by département, or none is (Spark refuses
    such a mix of folders).
    """
    partitions = {"annee_fichier": T.IntegerType(), "departement": T.StringType()}
    years = sorted(
        "__HIVE_DEFAULT_PARTITION__" if r.annee_fichier is None else str(r.annee_fichier)
        for r in landed_years(spark, path).collect()
    )
    parts = [
        require_columns(_read_text_csv(spark, f"{path}/annee_fichier={y}", partitions, path), SALES_COLUMNS, f"sales {y}")
        for y in years
    ]
    return normalize_null_tokens(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def landed_years(spark: SparkSession, path: str) -> DataFrame:
    """The years landed below `path`, as column `annee_fichier`, from file names alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path)
    return files.select(F.col("annee_fichier").cast("int").alias("annee_fichier")).distinct()


def stored_years(spark: SparkSession, path: str, column: str = "annee_fichier") -> DataFrame:
    """The years of a table stored by year, as `column`, from the names of its files alone."""
    files = _below(spark, path).format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = files.load(table_folders(spark, path))
    return files.select(F.col(column).cast("int").alias(column)).distinct()


def read_cog(spark: SparkSession, path: str) -> DataFrame:
    """The official commune list, missing markers as NULL."""
    return normalize_null_tokens(require_columns(_read_text_csv(spark, path, {}), COG_COLUMNS, "communes"))


def read_geocoded(spark: SparkSession, path: str) -> DataFrame:
    """Geocoder answers of all batches in a folder; `fichier` names the batch a row comes from, `position`
    grows along its rows (a quoted file is read by one task)."""
    rows = _read_text_csv(spark, path, {}).withColumns(
        {"fichier": F.col("_metadata.file_name"), "position": F.monotonically_increasing_id()}
    )
    return normalize_null_tokens(rows)


CERTIFICATE_PAGE = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in CERTIFICATE_FIELDS])),
        )
    ]
)


def page_rows(pages: DataFrame) -> DataFrame:
    """One row per certificate from pages of the form {"results": [...], "next": ...}."""
    return pages.select(F.inline("results"))


def read_certificates(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Certificates from landed service pages; keys absent from a row are NULL."""
    pages = spark.read.schema(CERTIFICATE_PAGE).option("multiLine", multiline).json(path)
    return page_rows(pages)


CERTIFICATE_MAPS = "results array<map<string,string>>"


def page_maps(pages: DataFrame) -> DataFrame:
    """Certificates as one map per row (`row`), which still tells an absent key from a null value."""
    return pages.select(F.explode("results").alias("row"))


def read_certificate_maps(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return page_maps(spark.read.schema(CERTIFICATE_MAPS).option("multiLine", multiline).json(path))


def certificate_columns(maps: DataFrame) -> DataFrame:
    """The expected fields of `row` as columns."""
    return maps.select(*[F.try_element_at("row", F.lit(f)).alias(f) for f in CERTIFICATE_FIELDS])


def field_counts() -> list[Column]:
    """Aggregates: the number of rows (`rows`), and of rows with each field, named like its column."""
    return [
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(F.map_contains_key("row", F.lit(field))).alias(name)
            for field, name in CERTIFICATE_FIELDS.items()
        ],
    ]


# Stores that a task can open by itself; names that only Hadoop knows are left to Spark.
ARROW_STORES = ("file", "hdfs", "s3", "gs")
FOOTERS_AT_A_TIME = 16


def files_without(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """path, column: the Parquet files below `path` that lack a required column, and which one.

    Each file's footer is read by the task that the file is dealt to; no row is read. A column that is part
    of the folder names (`/column=value/`) counts as present.
    """
    wanted = list(required)
    # Not selecting the content leaves the files closed.
    files = _below(spark, path).format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = files.load(table_folders(spark, path)).select("path")
    one = files.first()
    if one and one.path.split(":", 1)[0] not in ARROW_STORES:
        return _files_without_by_spark(spark, files, wanted)

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (file, column)
                for file in batch.column(0).to_pylist()
                for present in [footer_columns(file)]
                for column in wanted
                if column not in present and f"/{column}=" not in file
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.string()) for i in range(2)], ["path", "column"]
            )

    return files.mapInArrow(lacking, "path string, column string")


def _files_without_by_spark(spark: SparkSession, files: DataFrame, wanted: list[str]) -> DataFrame:
    """The same in stores that only Spark can open: it reads one footer per file, some at a time."""
    names = [row.path for row in files.collect()]
    with ThreadPoolExecutor(FOOTERS_AT_A_TIME) as pool:
        present = list(pool.map(lambda file: set(spark.read.parquet(file).columns), names))
    found = [
        (file, column)
        for file, columns in zip(names, present, strict=True)
        for column in wanted
        if column not in columns and f"/{column}=" not in file
    ]
    return spark.createDataFrame(found, "path string, column string")


def footer_columns(file: str) -> set[str]:
    """Names of the columns of one Parquet file, as its footer gives them."""
    if file.startswith("file:"):
        store, name = pa.fs.LocalFileSystem(), "/" + file.removeprefix("file:").lstrip("/")
    else:
        store, name = pa.fs.FileSystem.from_uri(file)
    with store.open_input_file(name) as source:
        return set(pq.read_schema(source).names)


def require_columns_in_files(spark: SparkSession, path: str, required: Iterable[str]) -> None:
    """An error that names files and columns if some file lacks a required column."""
    found = Observation()
    lacking = files_without(spark, path, required)
    # Sorted, so that all footers are looked at and counted though only a few come back.
    examples = lacking.observe(found, F.count(F.lit(1)).alias("lacking")).orderBy("path", "column").limit(SAMPLE_ROWS).collect()
    if examples:
        listed = [f"{row.column} in {row.path}" for row in examples]
        raise SchemaError(
            f"{path}: {found.get['lacking']} required columns are missing in files, for example {listed}",
            sorted({row.column for row in examples}),
        )


# Folder names of the written tables that are codes; Spark would read "01" as a number.
CODE_PARTITIONS = ("code_departement", "departement", "perimetre", "lot")


def read_table(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A Parquet folder whose files may differ in extra columns; partition codes stay text.

    Of a table with commit records only the folders count that the newest one names. Every single file must have the `required` columns: where one lacks them, its rows would be read as NULL.
    """
    required = list(required)
    folders = table_folders(spark, path)
    merged = require_columns(_below(spark, path).option("mergeSchema", True).parquet(*folders), required, path)
    if required:
        require_columns_in_files(spark, path, required)
    fields = [
        T.StructField(f.name, T.StringType() if f.name in CODE_PARTITIONS else f.dataType)
        for f in merged.schema.fields
    ]
    return _below(spark, path).schema(T.StructType(fields)).parquet(*folders).drop(commits.GENERATION)


def table_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table: the one given, or those that its newest commit record names."""
    live = commits.live_folders(spark, path)
    return [path] if live is None else [f"{path}/{folder}" for folder in live]


def _below(spark: SparkSession, path: str) -> DataFrameReader:
    """A reader that takes folder names below `path` for columns."""
    return spark.read.option("basePath", path) if commits.live_folders(spark, path) is not None else spark.read
