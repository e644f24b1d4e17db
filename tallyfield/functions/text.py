"""Scalar parsers: text column in, value column out.  All are native Column expressions.

Patterns run with Unicode letters, digits and word ends, and without case.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units, words and labels of the shops' language.
CURRENCY = ("₫", "đ", "vnd", "vnđ")
UNIT_WORDS = ("bao", "túi", "chai", "gói", "kg", "tấn", "lít", "ml", "g")
UNIT_SUFFIXES = ("kg", "g", "lít", "l", "ml")
KG_OF = {"kg": 1.0, "kilogram": 1.0, "gr": 0.001, "gam": 0.001, "gram": 0.001, "g": 0.001, "tấn": 1000.0, "tan": 1000.0}
PACK_WORDS = (
    "gói", "goi", "bao", "túi", "tui", "chai", "hũ", "hu", "lọ", "lo", "hộp", "hop", "can", r"quy\s*cách", r"quy\s*cach",
    r"khối\s*lượng", r"khoi\s*luong", r"trọng\s*lượng", r"trong\s*luong",
)
PACK_RANGE_KG = (0.005, 2000.0)
ACCENTED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
STOPWORDS = (
    "phan bon goi bao tui chai kg gr gram te cho cay trong va loai moi voi cao cap chuyen dung nhap khau sieu the cac tot gia re "
    "tang nang suat kich thich giup dat chat luong manh khoe dinh duong tap hieu qua nhanh benh giai phap chinh hang san pham hoat tinh"
).split()
SECTION_LABELS = (
    ("thanh_phan", "thành phần|thanh phan|hàm lượng|ham luong|nguyên liệu"),
    ("cong_dung", "công dụng|cong dung|tác dụng|tac dung|lợi ích|đặc điểm|dac diem"),
    ("huong_dan", "hướng dẫn|huong dan|cách dùng|cach dung|cách sử dụng|sử dụng"),
    ("lieu_luong", "liều lượng|lieu luong|định mức|dinh muc|tỷ lệ pha|pha loãng"),
    ("cong_nghe", "công nghệ|cong nghe|quy trình sản xuất|cơ chế"),
    ("doi_tuong", "đối tượng|doi tuong|cây trồng|dùng cho|chuyên dùng"),
    ("bao_quan", "bảo quản|bao quan|hạn sử dụng|han su dung"),
    ("luu_y", "lưu ý|luu y|chú ý|cảnh báo|khuyến cáo"),
    ("quy_cach", "quy cách|quy cach|đóng gói|khối lượng tịnh|trọng lượng"),
    ("xuat_xu", "xuất xứ|xuat xu|nhà sản xuất|nhập khẩu|thương hiệu|hãng"),
)
SPEC_LABELS = (
    ("thanh_phan", "thành phần|hàm lượng|nguyên liệu"),
    ("xuat_xu", "xuất xứ|nhà sản xuất|thương hiệu|hãng|nơi sản xuất"),
    ("quy_cach", "quy cách|đóng gói|khối lượng|trọng lượng|dung tích"),
    ("doi_tuong", "đối tượng|cây trồng|dùng cho"),
    ("cong_dung", "công dụng|tác dụng"),
)
PLATFORM_MARKS = (
    ("haravan", r"(?i)haravan|hstatic\.net|bizweb\.dktcdn"),
    ("haravan", r"(?i)cdn\.shopify\.com|shopify\.theme"),
    ("woocommerce", "(?i)woocommerce"),
    ("jsonld", r'"@type"\s*:\s*"Product"'),
)
SIZE_WORDS = ("grande", "large", "medium", "small", "compact", "thumb", "icon", "master", "original", "pico", "mini")

_DASH = "[-‐-―:.]"
_KG_UNITS = "kg|kilogram|gr|gam|gram|g|tấn|tan"
PRICE = rf"(?iuU)(\d[\d.,]{{2,}})\s*(?:{'|'.join(CURRENCY)})"
NPK = rf"(?U)\b(\d{{1,2}})\s*{_DASH}\s*(\d{{1,2}})\s*{_DASH}\s*(\d{{1,2}})\b"
UNIT = rf"(?iuU)\b(?:{'|'.join(UNIT_WORDS)})\s*\d*\s*(?:{'|'.join(UNIT_SUFFIXES)})?\b"
WEIGHT = rf"(?iuU)(\d+(?:[.,]\d+)?)\s*({_KG_UNITS})\b"
PACKED_WEIGHT = rf"(?iuU)(?:{'|'.join(PACK_WORDS)})\s*:?\s*(\d+(?:[.,]\d+)?)\s*({_KG_UNITS})\b"
IMAGE_SIZE = rf"(?i)(?:[-_]\d{{2,4}}x\d{{2,4}}|_(?:{'|'.join(SIZE_WORDS)}))(?=\.[a-z]{{3,4}}$)"


def _positive(x: Column) -> Column:
    return F.when((x > 0) & ~F.isnan(x), x)


def squeezed(x: Column) -> Column:
    """White space collapsed to one blank and cut at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def parse_price(raw: Column) -> Column:
    """The first amount before a currency mark, else all digits; separators are dropped; null unless positive."""
    amount = F.when(raw.rlike(PRICE), F.regexp_extract(raw, PRICE, 1)).otherwise(raw)
    return _positive(F.regexp_replace(amount, r"\D", "").try_cast("double"))


def parse_npk(text: Column) -> Column:
    return F.when(text.rlike(NPK), F.concat_ws("-", *(F.regexp_extract(text, NPK, k) for k in (1, 2, 3))))


def parse_unit(text: Column) -> Column:
    return F.when(text.rlike(UNIT), F.trim(F.regexp_extract(text, UNIT, 0)))


def _kg(text: Column, pattern: str) -> Column:
    amount = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")
    factors = F.create_map(*(F.lit(x) for pair in KG_OF.items() for x in pair))
    kg = amount * F.element_at(factors, F.lower(F.regexp_extract(text, pattern, 2)))
    return F.when(kg.between(*PACK_RANGE_KG), kg)


def parse_pack_kg(name: Column, description: Column | None = None) -> Column:
    """The name's first weight is final, even out of range; else the first one after a packaging word."""
    found = F.when(name.rlike(WEIGHT), _kg(name, WEIGHT))
    return found if description is None else found.when(description.rlike(PACKED_WEIGHT), _kg(description, PACKED_WEIGHT))


def fold(text: Column) -> Column:
    """Lower case, accents off."""
    plain = "".join("d" if c == "đ" else unicodedata.normalize("NFD", c)[0] for c in ACCENTED)
    return F.translate(F.lower(text), ACCENTED, plain)


def slug(text: Column) -> Column:
    return F.substring(F.btrim(F.regexp_replace(fold(text), "[^a-z0-9]+", "_"), F.lit("_")), 1, 40)


def name_tokens(name: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    words = F.regexp_extract_all(fold(name), F.lit("[a-z0-9]+"), F.lit(0))
    dull = F.array(*map(F.lit, stopwords))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~F.array_contains(dull, w)))


def money(value: Column, minor: Column | int = 1) -> Column:
    """A text amount in minor units as a positive number of major ones, else null."""
    number = F.when(~value.rlike("(?i)[df]\\s*$"), value.try_cast("double"))
    return _positive(number / (F.lit(minor) if isinstance(minor, int) else minor))


def clean_markup(text: Column) -> Column:
    """Tags and character references out, white space collapsed, null if nothing is left."""
    return F.nullif(squeezed(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"&[a-z]+;|&#\d+;", " ")), F.lit(""))


def platform_of(html: Column) -> Column:
    out = None
    for platform, mark in PLATFORM_MARKS:
        out = F.when(html.rlike(mark), platform) if out is None else out.when(html.rlike(mark), platform)
    return F.when(html.isNotNull(), out.otherwise("html"))


_URL = r"^([A-Za-z][\w+.-]*)://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def path_of(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, _URL, 3), ";[^/]*$", "")


def _site(url: Column) -> Column:
    return F.concat(F.regexp_extract(url, _URL, 1), F.lit("://"), host_of(url))


def haravan_api(url: Column) -> Column:
    return F.concat(F.rtrim(F.split_part(url, F.lit("?"), F.lit(1)), F.lit("/")), F.lit(".js"))


def woo_api(url: Column) -> Column:
    name = F.element_at(F.split(F.rtrim(path_of(url), F.lit("/")), "/"), -1)
    return F.concat(_site(url), F.lit("/wp-json/wc/store/v1/products?slug="), name)


def woo_reviews_api(url: Column, product_id: Column) -> Column:
    return F.concat(_site(url), F.lit("/wp-json/wc/store/v1/products/reviews?product_id="), product_id.cast("string"), F.lit("&per_page=10"))


def label_key(text: Column, labels: Sequence[tuple[str, str]] = SECTION_LABELS) -> Column:
    """The key of the first pattern that the text holds."""
    out = None
    for key, pattern in labels:
        hit = text.rlike(f"(?iu){pattern}")
        out = F.when(hit, key) if out is None else out.when(hit, key)
    return out


def spec_key(label: Column) -> Column:
    """A spec row's key: a known label's, else the slug (null if empty)."""
    return F.coalesce(label_key(label, SPEC_LABELS), F.nullif(slug(label), F.lit("")))


def image_key(url: Column) -> Column:
    """One key for all sizes of a photo."""
    return F.regexp_replace(F.split_part(url, F.lit("?"), F.lit(1)), IMAGE_SIZE, "")
