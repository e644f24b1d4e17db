"""Scalar parsers: cases worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import text as T


def values(spark, rows, column, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r.v for r in df.select(column.alias("v")).collect()]




def test_price(spark):
    cases = {
        "250.000 đ": 250000, "250.000đ - 300.000đ": 250000, "250.000 - 300.000": 250000300000, "1,250,000.50 VND": 125000050,
        "99 đ": 99, "12.5": 125, "0đ": None, "Giá: liên hệ": None, "": None,
    }
    assert values(spark, cases, T.parse_price(F.col("x"))) == list(cases.values())


def test_npk(spark):
    cases = {"NPK 20 - 20 – 15": "20-20-15", "16.16.8": "16-16-8", "15:15:15": "15-15-15", "100-20-5": None, "": None}
    assert values(spark, cases, T.parse_npk(F.col("x"))) == list(cases.values())


def test_unit(spark):
    cases = {"NPK bao 50kg": "bao 50kg", "50kg": None, "5 kg": "kg", "bao bì": "bao", "Bao 50 kgx": "Bao 50"}
    assert values(spark, cases, T.parse_unit(F.col("x"))) == list(cases.values())


@pytest.mark.parametrize(
    "name,description,kg",
    [
        ("Bao 50kg", None, 50), ("2 TẤN", None, 2000), ("500 gr", None, 0.5), ("2,5 kg", None, 2.5), ("Phân 5 gói", None, None),
        ("1g mẫu", "gói 100g", None), ("Kali", "pha 5g / 1 lít, gói 100g", 0.1), ("2kg-5kg-10kg", None, 2), ("1.000 kg", None, 1), ("", None, None),
    ],
)
def test_pack_kg(spark, name, description, kg):
    got = values(spark, [(name, description)], T.parse_pack_kg(F.col("x"), F.col("y")), "x string, y string")
    assert got == [kg]


def test_fold_and_slug(spark):
    assert values(spark, ["Thông số", "Đầu Trâu", "  "], T.slug(F.col("x"))) == ["thong_so", "dau_trau", ""]
    assert values(spark, ["a" * 39 + " bcd"], T.slug(F.col("x"))) == ["a" * 39 + "_"]
    assert len(T.ACCENTED) == 67


def test_tokens(spark):
    got = values(spark, ["Phân bón NPK 16-16-8 Đầu Trâu bao 50kg"], T.name_tokens(F.col("x")))
    assert sorted(got[0]) == ["50kg", "dau", "npk", "trau"]


def test_money(spark):
    cases = {"250": 2.5, "0": None, "-3": None, "nan": None, "abc": None, "12d": None, None: None}
    assert values(spark, cases, T.money(F.col("x"), 100)) == list(cases.values())


def test_labels(spark):
    cases = {"Hạn sử dụng": "huong_dan", "BẢO QUẢN": "bao_quan", "khác": None}
    assert values(spark, cases, T.label_key(F.col("x"))) == list(cases.values())


def test_platform(spark):
    cases = {"a HSTATIC.net": "haravan", "WooCommerce": "woocommerce", '"@type": "Product"': "jsonld", '"@type": "product"': "html", None: None}
    assert values(spark, cases, T.platform_of(F.col("x"))) == list(cases.values())


def test_image_key(spark):
    assert values(spark, ["/p/a-300x300.jpg?v=1", "/p/a_grande.jpg", "/p/a.jpg"], T.image_key(F.col("x"))) == ["/p/a.jpg"] * 3


def test_api_urls(spark):
    url = "https://a.vn/products/x/?v=1"
    assert values(spark, [url], T.haravan_api(F.col("x"))) == ["https://a.vn/products/x.js"]
    assert values(spark, [url], T.woo_api(F.col("x"))) == ["https://a.vn/wp-json/wc/store/v1/products?slug=x"]


def test_clean_markup(spark):
    assert values(spark, ["<b>a</b>&nbsp;b &#39; c", "<p></p>", None], T.clean_markup(F.col("x"))) == ["a b c", None, None]
