"""Views over the driver's tables that the catalogue operators run on.

Each view is a list of SQL expressions that Spark and DuckDB read alike, so a query and
the SQL that checks it start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_N = "cast({} as varchar(20))".format
LISTINGS = {
    "item_id": "p_partkey",
    "source": f"concat('shop', {_N('p_partkey % 9')})",
    "url": f"concat('https://shop', {_N('p_partkey % 9')}, '.example/products/', {_N('p_partkey')})",
    "name": f"concat(p_name, ' ', lower(p_type), case when p_partkey % 5 = 0 then '' else concat(' NPK ', {_N('p_size % 6 + 10')}, '-', "
    f"{_N('p_partkey % 4 + 5')}, '-', {_N('p_partkey % 3 + 5')}) end, case when p_partkey % 7 = 0 then '' else concat(' bao ', {_N('p_size % 5 + 1')}, 'kg') end)",
    "price": "case when p_partkey % 11 = 0 then null else p_retailprice end",
    "description": f"case when p_partkey % 7 = 0 and p_partkey % 2 = 0 then concat('goi ', {_N('p_size')}, '0g') else null end",
    "price_text": f"case when p_partkey % 13 = 0 then 'lien he' else concat({_N('p_size')}, '.', {_N('p_partkey % 900 + 100')}, case when p_partkey % 2 = 0 then ' đ' else ' VND / bao' end) end",
}
CRAWLS = {
    "seq": "event_id",
    "url": f"concat('https://e.example/', {_N('user_id')})",
    "source": "event_type",
    "price": "value",
    "crawled_at": "ts",
    "props": "props",
}
#: Over listings; columns that hold nulls and empty values by modulus.
CATALOGUE = {
    "item_id": "item_id",
    "source": "source",
    "url": "url",
    "name": "name",
    "price": "price",
    "n_images": "case when item_id % 3 = 0 then null when item_id % 3 = 1 then 0 else item_id % 7 + 1 end",
    "n_videos": "case when item_id % 5 = 0 then 1 else 0 end",
    "n_specs": "case when item_id % 4 = 0 then null else item_id % 4 end",
    "content": "case when item_id % 6 = 0 then null when item_id % 6 = 1 then '' else name end",
    "section": "case item_id % 10 when 0 then 'thanh_phan' when 1 then 'cong_dung' when 2 then 'huong_dan' when 3 then 'lieu_luong' when 4 then 'bao_quan' when 5 then 'xuat_xu' end",
    "sku": f"case when item_id % 4 = 0 then '' else concat('S', {_N('item_id')}) end",
    "in_stock": "case when item_id % 6 = 0 then null else item_id % 2 end",
    "stock_qty": "case when item_id % 5 < 2 then null else item_id % 50 end",
    "review_count": "item_id % 4",
    "price_max": "case when item_id % 7 < 3 then null else price * 2 end",
    "platform": "case when item_id % 8 = 0 then null when item_id % 2 = 0 then 'haravan' else 'woocommerce' end",
}


def sql_of(view: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in view.items()) + f" FROM {table}"


LISTINGS_SQL = sql_of(LISTINGS, "part")
CRAWLS_SQL = sql_of(CRAWLS, "events")
CATALOGUE_SQL = sql_of(CATALOGUE, f"({LISTINGS_SQL})")


def _view(df: DataFrame, view: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{e} as {c}" for c, e in view.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(table(spark, sf_dir, "part"), LISTINGS)


def crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(table(spark, sf_dir, "events"), CRAWLS)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listings with the nested columns and counts of a whole catalogue."""
    flat = _view(listings(spark, sf_dir), CATALOGUE)
    return flat.selectExpr(
        "*",
        "case when n_images is null then null when n_images = 0 then cast(array() as array<string>) else transform(sequence(1, cast(n_images as int)), k -> concat(url, '/', k, '.jpg')) end as images",
        "case when n_videos = 0 then null else array(concat(url, '.mp4')) end as videos",
        "case when n_specs is null then null when n_specs = 0 then cast(map() as map<string,string>) else map('quy_cach', cast(n_specs as string)) end as specs",
        "case when section is null then null else map(section, name) end as sections",
        "case when review_count = 0 then null else transform(sequence(1, cast(review_count as int)), k -> named_struct('author', concat('a', k), 'rating', cast(k as double), 'date', '2024-01-02T03:04:05', 'text', name)) end as reviews",
        "case when item_id % 3 = 0 then null else array(named_struct('title', name, 'sku', sku)) end as variants",
    )
