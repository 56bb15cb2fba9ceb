"""Tables that stages write and read back, exports, and the modelling CSV."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import DeedflowError, PhysicalSchemaError, SourceSchemaError

TRAINING_COLUMNS = ("canonical_area", "property_type", "sale_price_eur", "transaction_date")
CONTENT = "__content"


def load_training_csv(spark: SparkSession, path: str, required: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    """A UTF-8 CSV as text columns; a byte-order mark is dropped; no rows or missing columns are errors."""
    if not str(path).lower().endswith(".csv"):
        raise SourceSchemaError(f"not a CSV file: {path}")
    df = spark.read.options(header=True, encoding="UTF-8", multiLine=True, quote='"', escape='"').csv(str(path))
    first = df.columns[0]
    if first.startswith("\ufeff"):
        df = df.withColumnRenamed(first, first.lstrip("\ufeff"))
    return validate_training(df, required)


def validate_training(df: DataFrame, required: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    if df.isEmpty():
        raise SourceSchemaError("the dataset is empty")
    if missing := sorted(set(required) - set(df.columns)):
        raise SourceSchemaError(f"missing columns: {', '.join(missing)}")
    return df


def _plain(schema: StructType) -> list[tuple[str, str]]:
    """Names and types; Parquet does not keep whether a field may be null."""
    return [(f.name, f.dataType.simpleString()) for f in schema]


def append_only(before: Sequence[str], added: Sequence[str]) -> list[str]:
    """The columns of a stage that appends; a name that is there already is an error."""
    if clash := sorted(set(before) & set(added)):
        raise PhysicalSchemaError(f"columns exist already: {', '.join(clash)}")
    return [*before, *added]


def write_stage(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    """Exactly the named columns in order; missing ones are an error."""
    if missing := [c for c in columns if c not in df.columns]:
        raise PhysicalSchemaError(f"missing columns: {', '.join(missing)}")
    writer = df.select(*(F.col(f"`{c}`") for c in columns)).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def validate_stage(spark: SparkSession, path: str, expected: DataFrame, not_null: Sequence[str] = (), inherited: DataFrame | None = None, key: str = "source_row_number") -> DataFrame:
    """The table read back, after its rows, columns, non-null fields and inherited values were checked."""
    found = spark.read.parquet(path)
    if _plain(found.schema) != _plain(expected.schema):
        raise PhysicalSchemaError(f"expected {_plain(expected.schema)}, found {_plain(found.schema)}")
    checks = found.agg(F.count("*"), *(F.count_if(F.col(c).isNull()) for c in not_null)).first()
    rows = expected.count()
    if checks[0] != rows:
        raise PhysicalSchemaError(f"expected {rows} rows, found {checks[0]}")
    if broken := [c for c, n in zip(not_null, checks[1:]) if n]:
        raise PhysicalSchemaError(f"nulls in {', '.join(broken)}")
    if inherited is not None:
        reconcile(inherited, found, inherited.columns)
    return found


def reconcile(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> None:
    """Both have the same rows in ``columns``, repeated ones as often; a count and a sum of hashes of each decide."""
    if content_hash(before, columns) != content_hash(after, columns):
        raise DeedflowError("a stage has changed, lost or repeated rows")


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, str, str]:
    """An order-insensitive checksum: rows, and sums of two hashes of every row."""
    cols = [F.col(f"`{c}`") for c in columns or df.columns]
    row = F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x1e")) for c in cols))
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return tuple(df.agg(F.count("*"), total(F.xxhash64(row)), total(F.xxhash64(F.lit(7), row))).first())


def check_content(df: DataFrame, expected: str | None) -> str:
    """The content hash as text, which must be ``expected`` if that is given."""
    found = ":".join(map(str, content_hash(df)))
    if expected is not None and found != expected:
        raise PhysicalSchemaError(f"content is {found}, expected {expected}")
    return found


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One CSV file in a folder, sorted; for audits, which are small."""
    out = df.orderBy(*(F.asc_nulls_last(c) for c in order)) if order else df
    out.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file where Spark writes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def as_json(values: dict) -> str:
    return json.dumps(values, sort_keys=True, indent=2, ensure_ascii=False, default=str)


def markdown_table(df: DataFrame, rows: int = 50) -> str:
    """The first rows as a Markdown table; for sorted summaries."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join(map(cell, r)) + " |" for r in df.limit(rows).collect()]
    return "\n".join(lines)


def schema_markdown(df: DataFrame) -> str:
    return "\n".join(["| column | type |", "| --- | --- |", *(f"| {n} | {t} |" for n, t in df.dtypes)])
