"""Scans and sinks: JSON folder -> VARIANT landing table, typed Parquet tables.

* A folder of JSON documents (one per file, pretty-printed or on one line,
  or JSON lines for bulk exports) is read straight into one VARIANT column by
  the JSON source (``singleVariantColumn``) -- no Python parsing, no schema
  inference pass over the data.
* Tables are Parquet folders laid out as ``<root>/<zone>/<table>``; tables that are replaced as a whole hold numbered
  versions, the newest finished one being the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cirrus.operators import quality
from cirrus.streaming import files

LANDING_COLUMN = "weather_data"
ZONES = ("landing_zone", "curated_zone", "consumption_zone")


def zone_path(root: str, zone: str, table: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; expected one of {ZONES}")
    return f"{root.rstrip('/')}/{zone}/{table}"


#: Column of the landing table with the text, byte for byte, of a document that is no JSON.
REJECTED = "rejected_text"


def json_reader(spark: SparkSession, one_document_per_file: bool = True,
                column: str = LANDING_COLUMN, streaming: bool = False, strict: bool = False, rejects: bool = False):
    """JSON source configured to yield one VARIANT column per document.

    ``one_document_per_file`` -> ``multiLine`` (a file is one document, any
    layout); otherwise JSON lines, which are splittable for large exports.
    Lenient (default): an unparsable document becomes a NULL VARIANT, with ``rejects`` beside its text in column
    ``REJECTED``; ``strict``: the load fails on it."""
    reader = spark.readStream if streaming else spark.read
    if rejects:
        reader = reader.schema(f"{column} variant, {REJECTED} string").option("columnNameOfCorruptRecord", REJECTED)
    return (reader.format("json")
            .option("singleVariantColumn", column)
            .option("multiLine", "true" if one_document_per_file else "false")
            .option("mode", "FAILFAST" if strict else "PERMISSIVE"))


def read_json_documents(spark: SparkSession, path: str, one_document_per_file: bool = True,
                        column: str = LANDING_COLUMN, with_source: bool = False,
                        strict: bool = False) -> DataFrame:
    """Batch load of a folder of JSON documents into the landing shape."""
    df = json_reader(spark, one_document_per_file, column, strict=strict).load(path)
    if with_source:
        df = df.select(column, df["_metadata.file_path"].alias("source_file"))
    return df


def landing_rows(raw: DataFrame, column: str = LANDING_COLUMN) -> DataFrame:
    """(document, source_file, rejected_text) of what ``json_reader(rejects=True)`` loads, as batch or stream."""
    return raw.select(column, raw["_metadata.file_path"].alias("source_file"), F.col(REJECTED).cast("binary").alias(REJECTED))


def rejects(landing: DataFrame) -> DataFrame:
    """The rejected documents of a landing table: file, text (binary) and reason."""
    text = F.col(REJECTED).cast("string")
    reason = F.when(~F.is_valid_utf8(text), "invalid UTF-8").otherwise("malformed JSON")
    return landing.where(F.col(REJECTED).isNotNull()).select("source_file", REJECTED, reason.alias("reason"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = 3,
                  min_age: float = 3600.0) -> str:
    """Make ``df`` the table's content in one step, and return its folder.

    It is written beside the present version, as ``<path>/v=<n>``, and is the current one from the moment its job leaves
    the success marker. Readers take the version that is current when they start and keep its files: only versions before
    the newest ``keep`` go, once they are ``min_age`` seconds old. A job that dies changes nothing."""
    spark = df.sparkSession
    taken = [int(n[2:]) for n in files.names(spark, path) if n.startswith("v=") and n[2:].isdigit()]
    folder = f"{path}/v={max(taken, default=-1) + 1}"
    write_table(df, folder, partition_by=partition_by)
    for old in files.numbered(spark, path, "v")[:-keep]:
        files.delete_older(spark, f"{path}/v={old}", min_age)
    return folder


def replace_checked(df: DataFrame, path: str, not_null: Sequence[str] = (), lengths: Mapping[str, int] | None = None,
                    keep: int = 3, min_age: float = 3600.0) -> tuple[str, dict[str, int]]:
    """``replace_table`` with the declared limits enforced: (folder of the accepted rows, counts by limit).

    One job writes both kinds of rows, the rejected ones beside the others under ``accepted=false`` with their
    ``violations``, and counts them on the way; the rows are read once."""
    rules = quality.limits(not_null, lengths)
    marked, seen = quality.enforce(df, rules)
    folder = replace_table(marked, path, ("accepted",), keep, min_age)
    return f"{folder}/accepted=true", quality.counts(seen, rules)


def rejected_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that the current version of a ``replace_checked`` table has rejected, with their ``violations``."""
    folder = f"{files.current(spark, path)}/accepted=false"
    schema = f"{schema}, violations array<string>"
    return (spark.read.schema(schema).parquet(folder) if files.exists(spark, folder)
            else spark.createDataFrame([], schema))


def point_table(spark: SparkSession, name: str, ddl: str, folder: str) -> None:
    """Let the catalog table ``name`` show a folder: one catalog change, so that a query sees the old or the new one."""
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in spark.table(name).schema] if spark.catalog.tableExists(name) else None
    wanted = spark.createDataFrame([], ddl).schema
    if columns == [f"{f.name} {f.dataType.simpleString()}" for f in wanted]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # new, or declared with other columns
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{folder}'")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of the table's current version; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(files.current(spark, path))


def create_table(spark: SparkSession, path: str, schema) -> None:
    """Create-or-replace an empty typed table."""
    replace_table(spark.createDataFrame([], schema), path)


def insert_select(df: DataFrame, path: str, columns: list[str] | None = None,
                  mode: str = "append", partition_by: tuple[str, ...] = ()) -> None:
    """INSERT INTO t [(cols)] SELECT ...: positional select + append to the current version."""
    write_table(df.select(*columns) if columns else df, files.current(df.sparkSession, path), mode, partition_by)
