"""Catalogue tables: schemas, tolerant reads, site configuration, JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType

from tallyfield.plans.scratch import names_in


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT, _REAL, _INT, _LONG, _BOOL = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType()
_TEXTS, _TEXT_MAP = ArrayType(_TEXT), MapType(_TEXT, _TEXT)
VARIANT = _struct(title=_TEXT, sku=_TEXT, price=_REAL, compare_at=_REAL, available=_BOOL, stock=_LONG, id=_LONG)
REVIEW = _struct(author=_TEXT, rating=_REAL, date=_TEXT, text=_TEXT)
PRODUCTS = _struct(
    item_id=_LONG, source=_TEXT, url=_TEXT, name=_TEXT, price=_REAL, currency=_TEXT, unit=_TEXT, pack_kg=_REAL, brand=_TEXT, category=_TEXT, npk=_TEXT,
    description=_TEXT, images=_TEXTS, videos=_TEXTS, specs=_TEXT_MAP, sections=_TEXT_MAP, content=_TEXT, sku=_TEXT, price_min=_REAL, price_max=_REAL,
    in_stock=_INT, stock_qty=_INT, rating=_REAL, review_count=_INT, tags=_TEXTS, variants=ArrayType(VARIANT), reviews=ArrayType(REVIEW), platform=_TEXT,
    crawled_at=TimestampType(),
)
#: What every payload parser returns.
STRUCTURED = _struct(
    name=_TEXT, price=_REAL, price_min=_REAL, price_max=_REAL, sku=_TEXT, vendor=_TEXT, product_type=_TEXT, tags=_TEXTS, in_stock=_BOOL, stock_qty=_INT,
    rating=_REAL, review_count=_INT, variants=ArrayType(VARIANT), images=_TEXTS, content_html=_TEXT,
)
SITES = _struct(name=_TEXT, enabled=_BOOL, note=_TEXT, platform=_TEXT, list_urls=_TEXTS, selectors=_TEXT_MAP)
NESTED = ("images", "videos", "specs", "sections", "tags", "variants", "reviews")


def with_all_columns(df: DataFrame, schema: StructType = PRODUCTS) -> DataFrame:
    """df in the schema's order, columns that it lacks as typed nulls, others left out."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return with_all_columns(spark.read.option("mergeSchema", "true").parquet(path))


def reconciled(column: Column, have: DataType, want: DataType) -> Column:
    """A column of an older table as the type that it has now; null where it can't be read so.

    Numbers widen and narrow by value, texts are parsed, JSON text becomes lists, maps and records
    (empty text none), and nested values of another shape go over JSON, which keeps what they share."""
    nested = (ArrayType, MapType, StructType)
    if have == want:
        return column
    if isinstance(want, nested):
        if isinstance(have, StringType):
            return F.from_json(F.nullif(F.btrim(column), F.lit("")), want)
        return F.from_json(F.to_json(column), want) if isinstance(have, nested) else F.lit(None).cast(want)
    if isinstance(have, nested):
        return F.to_json(column) if isinstance(want, StringType) else F.lit(None).cast(want)
    if isinstance(have, BooleanType) and isinstance(want, TimestampType) or isinstance(have, TimestampType) and isinstance(want, BooleanType):
        return F.lit(None).cast(want)
    return column.try_cast(want)


def conformed(df: DataFrame, schema: StructType = PRODUCTS) -> DataFrame:
    """df in the schema's order and types, columns that it lacks as typed nulls, others left out."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*((reconciled(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def read_generations(spark: SparkSession, path: str, schema: StructType = PRODUCTS) -> DataFrame:
    """All rows of the folders in path, written by different releases, as one table of today's types.

    A folder is what one release wrote: its files agree but for columns that some lack.  Folders with
    one schema are one scan, and each scan reads its own types, so filters and columns reach the files."""
    kinds: dict[str, tuple[StructType, list[str]]] = {}
    for name in sorted(x for x in names_in(spark, path) if x[0] not in "._"):
        found = spark.read.option("mergeSchema", "true").parquet(f"{path}/{name}").schema
        kinds.setdefault(found.json(), (found, []))[1].append(f"{path}/{name}")
    whole = None
    for found, folders in kinds.values():
        rows = conformed(spark.read.schema(found).parquet(*folders), schema)
        whole = rows if whole is None else whole.unionByName(rows)
    return spark.createDataFrame([], schema) if whole is None else whole


def read_sites(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Sites that aren't switched off, of one JSON list (or of a site a line)."""
    return spark.read.schema(SITES).json(path, multiLine=not lines).filter(F.coalesce("enabled", F.lit(True)))


def from_json_text(df: DataFrame, schema: StructType = PRODUCTS) -> DataFrame:
    """Nested columns held as JSON text, typed."""
    return df.withColumns({c: F.from_json(c, schema[c].dataType) for c in NESTED if c in df.columns})


def to_json_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, null when empty."""
    return df.withColumns({c: F.when(F.size(c) > 0, F.to_json(c)) for c in NESTED if c in df.columns})
