"""The property register's CSV: strict decoding, header checks, and the standardised stage.

Spark has no strict Windows-1252 reader, so bytes are read as ISO-8859-1 (which maps each byte to one
character) and the C1 characters are translated; what Windows-1252 leaves undefined is an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import SourceDecodeError, SourceSchemaError
from ..functions import hashing, parsing
from ..functions.text import blank_to_null

# The register's columns, in its order.
DATE, ADDRESS, COUNTY, EIRCODE = "Date of Sale (dd/mm/yyyy)", "Address", "County", "Eircode"
PRICE, NOT_FULL, VAT, DESCRIPTION, SIZE = "Price (€)", "Not Full Market Price", "VAT Exclusive", "Description of Property", "Property Size Description"
REQUIRED = (DATE, ADDRESS, COUNTY, EIRCODE, PRICE, NOT_FULL, VAT, DESCRIPTION, SIZE)
RAW_PREFIX = "source_raw__"

_C1 = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
_FROM, _TO = "".join(a for a, b in _C1 if b), "".join(b for _, b in _C1 if b)
_UNDEFINED = "".join(a for a, b in _C1 if not b)


@dataclass(frozen=True)
class RegisterConfig:
    path: str
    snapshot: date
    source_name: str = "ppr"
    vat_rate: Decimal = parsing.HOUSE_VAT_RATE
    #: Quoted line breaks need one task for each file; without them files are split.
    multi_line: bool = True


def decoded(c: Column) -> Column:
    return F.translate(c, _FROM, _TO)


def encoded(c: Column) -> Column:
    """The inverse of ``decoded``."""
    return F.translate(c, _TO, _FROM)


def encoded_text(value: str) -> str:
    return value.translate(str.maketrans(_TO, _FROM))


def slug(column: str) -> str:
    return RAW_PREFIX + re.sub(r"[^0-9a-zA-Z]+", "_", column).strip("_").lower()


def file_sha256(spark: SparkSession, path: str, block: int = 1 << 22) -> str:
    """SHA-256 of the file's bytes, read in blocks through the file system that Spark uses."""
    jvm, digest = spark.sparkContext._jvm, hashlib.sha256()
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        while data := bytes(stream.readNBytes(block)):
            digest.update(data)
    finally:
        stream.close()
    return digest.hexdigest()


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The cells of the first record."""
    options = {"header": False, "encoding": "ISO-8859-1", "multiLine": False, "quote": '"', "escape": '"'}
    first = spark.read.options(**options).csv(path).first()
    if first is None or len(first) == 0:
        raise SourceSchemaError("the source file is empty")
    cells = [c or "" for c in first]
    if any(ch in _UNDEFINED for c in cells for ch in c):
        raise SourceDecodeError("the header is not valid cp1252")
    return [c.translate(str.maketrans(_FROM, _TO)) for c in cells]


def validate_header(columns: Sequence[str]) -> list[str]:
    """The unexpected columns; repeated, missing and colliding names are errors, in this order."""
    repeated = sorted({c for c in columns if list(columns).count(c) > 1})
    if repeated:
        raise SourceSchemaError(f"repeated columns: {', '.join(repeated)}")
    missing = [c for c in REQUIRED if c not in columns]
    if missing:
        raise SourceSchemaError(f"missing columns: {', '.join(missing)}")
    slugs = [slug(c) for c in columns]
    colliding = sorted({s for s in slugs if slugs.count(s) > 1})
    if colliding:
        raise SourceSchemaError(f"columns with the same short name: {', '.join(colliding)}")
    return [c for c in columns if c not in REQUIRED]


def read_register(spark: SparkSession, config: RegisterConfig) -> DataFrame:
    """All columns as text, blanks as empty text."""
    columns = read_header(spark, config.path)
    validate_header(columns)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    raw = (
        spark.read.schema(schema)
        .options(header=True, encoding="ISO-8859-1", multiLine=config.multi_line, quote='"', escape='"', mode="FAILFAST")
        .csv(config.path)
    )
    names = [F.col(f"`{c}`") for c in columns]
    undefined = F.lit(False)
    for c in names:
        undefined = undefined | F.coalesce(c.rlike(f"[{_UNDEFINED}]"), F.lit(False))
    if not raw.where(undefined).isEmpty():
        raise SourceDecodeError("the file is not valid cp1252")
    return raw.select(*(F.coalesce(decoded(c), F.lit("")).alias(n) for c, n in zip(names, columns)))


def number_rows(df: DataFrame, name: str = "source_row_number") -> DataFrame:
    """Rows numbered from 1 in the order of the scan, without moving them.

    The number of rows in each partition is counted first and the offsets are joined as a table of one row for each
    partition.  The same scan of the same files has the same partitions in both passes; ``load_register`` checks the file's hash.
    """
    placed = df.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    joined = placed.join(F.broadcast(offsets), F.col("__part") == F.col("__of"))
    return joined.withColumn(name, F.col("__start") + F.col("__at") + 1).drop("__part", "__at", "__of", "__start")


def standardise(raw: DataFrame, config: RegisterConfig, sha256: str) -> DataFrame:
    """The 36 core columns, then one verbatim copy of each source column."""
    columns = raw.columns
    col = lambda name: F.col(f"`{name}`")
    numbered = number_rows(raw)
    day = parsing.day_first_date(col(DATE))
    sale, status = parsing.price(col(PRICE)), parsing.price_status(col(PRICE))
    market, vat = blank_to_null(col(NOT_FULL)), blank_to_null(col(VAT))
    described = blank_to_null(col(DESCRIPTION))
    core = {
        "source_name": F.lit(config.source_name),
        "source_snapshot_date": F.lit(config.snapshot),
        "source_file_sha256": F.lit(sha256),
        "source_row_number": F.col("source_row_number"),
        "record_id": hashing.record_id(F.lit(config.source_name), F.lit(sha256), F.col("source_row_number")),
        "raw_record_fingerprint": hashing.fingerprint({c: col(c) for c in columns}),
        "transaction_date_raw": col(DATE),
        "transaction_date": day,
        "transaction_year": F.year(day).cast("long"),
        "date_parse_status": parsing.date_status(col(DATE)),
        "is_future_transaction": parsing.is_future(day, F.lit(config.snapshot)),
        "raw_address": col(ADDRESS),
        "county_raw": col(COUNTY),
        "eircode_raw": blank_to_null(col(EIRCODE)),
        "sale_price_eur_raw_text": col(PRICE),
        "sale_price_eur_raw": sale,
        "price_parse_status": status,
        "not_full_market_price_raw": market,
        "is_full_market_price": parsing.full_market(market),
        "full_market_price_mapping_status": parsing.full_market_status(market),
        "vat_exclusive_raw": vat,
        "vat_exclusive_flag": parsing.vat_exclusive(vat),
        "vat_mapping_status": parsing.vat_status(vat),
        **parsing.vat_adjusted(sale, status, parsing.vat_exclusive(vat), config.vat_rate),
        "property_description_raw": described,
        **parsing.description(described),
        "property_type": F.lit("unknown"),
        "property_type_source": F.lit("unknown"),
        "property_type_quality_flag": F.lit("ppr_house_apartment_ambiguous"),
        "property_size_description_raw": blank_to_null(col(SIZE)),
        "property_size_bucket_source": blank_to_null(col(SIZE)),
        "floor_area_sqm": F.lit(None).cast("double"),
    }
    return numbered.select(*(c.alias(n) for n, c in core.items()), *(col(c).alias(slug(c)) for c in columns))


def load_register(spark: SparkSession, config: RegisterConfig) -> DataFrame:
    return standardise(read_register(spark, config), config, file_sha256(spark, config.path))
