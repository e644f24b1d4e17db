"""PII: format-preserving pseudonyms by keyed Feistel networks.

One pattern finds candidates; validated ones are replaced by a keyed permutation within
their format, so equal values become equal pseudonyms in every document and different
values stay different:

- card numbers (13 to 19 digits, Luhn, issuer 2 to 6): the digits between the first and the
  last are permuted and the check digit is set anew; IBANs (check digits right) alike, their
  country stays; other long numbers stay as they are
- phone numbers: digits stay digits; punctuation, a country code and a leading 0 stay
- social security numbers (areas, groups and serials that can be): permuted among those
- e-mail addresses: the local part, by domain, letters in any case alike; the domain stays
- IPv4 addresses with octets up to 255, as 32-bit numbers (not after the word version); IPv6
  addresses as two 64-bit halves, full or shortened alike, so all notations of one are linked;
  the pseudonym of a shortened one is written out
- calendar dates of 1900 to 2099, year first, day first (with or without leading zeros), month first
  where it can't be a day, or with an English month's name before or after the day: permuted as
  day numbers, same notation
- values after password, pwd, token, secret, api key, of any length, up to the closing quote on their
  line or else to white space (or to a comma before a quote), bearer tokens, access keys told by
  their prefix, user names and passwords in addresses, private-key blocks: ASCII letters and digits
  within their kind, other signs stay.  What follows without white space counts as the value; a
  plain lower-case word after "secret:" or "token:" and a blank is prose

Strings use an alternating Feistel network on their two halves, each character shifted
within its class by a keyed hash of the other half; numbers use one modulo both factors of
their range.  A pseudonym is the network's image, moved on by a keyed step, and taken back
through the network: a permutation for any key that leaves no value as it is, undone by the
same with the step backwards (``back=True``; a month-first date is read as day first then,
if it can be, and days and months without leading zeros, and "Sept.", may come back otherwise written).  Keep the key outside the code, as whoever has it can undo the pseudonyms: the
query takes it from the session's `spark.tallyfield.pii.key`.

All of it is Column expressions; text without a candidate is passed as it is.

Defined cases: null text stays null with no replacements; of candidates that overlap the
first counts, of those that begin at one place the first kind (ties); long texts are searched
whole; ids are passed through, null or repeated; extra columns are ignored, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 6
KEY_SETTING = "spark.tallyfield.pii.key"
#: For synthetic tables, where no key is set: public, so its pseudonyms hide nothing.
SAMPLE_KEY = "sample key of no secrecy"

# What counts as a candidate, most specific first.
_LEFT, _RIGHT = r"(?<![\w.@+-])", r"(?![\w@])"
_NAMED_SECRET = (
    r"(?!(?i:secret|token):\x20[a-z]{2,}(?:[\s,;.!?]|\z))(?i:(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b[\x20\"']{0,3}[=:]{1,2}>?\x20?)"
)
_LOGIN = r"(?<!\w)[A-Za-z][A-Za-z0-9+.-]{1,20}://(?=[^\s/:@]{1,64}:[^\s/@]{1,256}@)"
_BLOCK = r"-----BEGIN\x20(?:[A-Z]+\x20){0,3}PRIVATE\x20KEY-----"
_BEARER = r"\b[Bb]earer\x20"
_KEY_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|sk-)"
MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
_HEX = "[0-9A-Fa-f]{1,4}"
KINDS = {
    "secret": _NAMED_SECRET + r"(?:\"(?![\"\r\n])[^\r\n]*?(?<!(?<!\\)\\)\"|'(?!['\r\n])[^\r\n]*?(?<!(?<!\\)\\)'|\S+?(?=\s|\z|,[\"']))"
    rf"|{_BEARER}(?=[\w.~+/-]*\d)[\w.~+/-]{{8,}}=*|(?<!\w){_KEY_PREFIX}[A-Za-z0-9]{{16,}}(?!\w)"
    rf"|{_LOGIN}[^\s/:@]{{1,64}}:[^\s/@]{{1,256}}@|{_BLOCK}[A-Za-z0-9+/=\s]*",
    "email": r"(?<![\w.+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<!(?i:version)\x20)(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{1,6}}|[0-9A-Fa-f]{{3,4}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?<!^::)(?<!\s::)(?![\w:])",
    "date": r"(?<![\w/.-])(?:(?:19|20)\d\d(?:-\d\d-|/\d\d/)\d\d|\d{1,2}/\d{1,2}/(?:19|20)\d\d|\d{1,2}\.\d{1,2}\.(?:19|20)\d\d)(?![\w/-]|\.\d)"
    rf"|\b(?:{MONTHS}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sept?|Oct|Nov|Dec)\.)\x20\d{{1,2}},\x20(?:19|20)\d\d(?!\d)|(?<![\w/.-])\d{{1,2}}\x20(?:{MONTHS})\x20(?:19|20)\d\d(?!\d)",
    "ssn": _LEFT + r"\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": _LEFT + r"(?:\d{13,19}|\d{4}(?:-\d{4}){3}(?:-\d{3})?|\d{4}(?:\x20\d{4}){3}|\d{4}[\x20-]\d{6}[\x20-]\d{5})(?![\w-])",
    "phone": r"(?<![\w.@-])(?:\+\d{1,3}[\x20.-]?\(\d{1,4}\)[\x20.-]?\d{2,4}[\x20.-]?\d{2,4}(?:[.-]?\d{2,4})?|\+\d{1,3}(?:[\x20.-]?\d{2,4}){2,5}"
    r"|\(\d{3}\)[\x20.-]?\d{3}[\x20.-]\d{4}|(?:1[.-])?\d{3}[.-]\d{3}[.-]\d{4}|[2-9]\d{2}\x20\d{3}\x20\d{4}|0\d{9,10}|(?:0|\(0\))\d{2,3}[\x20.-]\d{3,4}[\x20.-]\d{3,4})(?![\w-])",
}
PATTERN = "|".join(KINDS.values())
#: Every candidate has one of these.
HINT = r"[0-9@]|(?i:passw|pwd|secret|token|key|bearer)|AKIA|ASIA|gh[pousr]_|sk-"
_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)  # 73,049 days to the end of 2099
#: Areas 1 to 899 but 666, groups 1 to 99, serials 1 to 9999.
_SSN = (898 * 99, 9999)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(seed: Column, n: int = 15) -> Column:
    """A non-negative number from a hash of seed."""
    return F.conv(F.substring(F.sha2(seed, 256), 1, n), 16, 10).cast("long")


def _rounds(start: Column, step, back: bool = False) -> Column:
    """The state after ROUNDS steps step(state, number, sign), or after as many backwards."""
    numbers = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(numbers, start, lambda s, k: step(s, k, -1 if back else 1))


def permuted_number(x: Column, a: int, b: int, key: str, back: bool = False) -> Column:
    """A keyed permutation of 0 .. a*b-1 without fixed points."""
    halves = lambda v: F.struct(F.floor(v / b).cast("long").alias("l"), (v % b).cast("long").alias("r"))

    def step(s: Column, k: Column, sign: int) -> Column:
        by = lambda half: _digits(F.concat_ws("|", F.lit(key), F.lit("n"), k.cast("string"), half.cast("string"))) * sign
        l_ = F.when(k % 2 == 0, F.pmod(s["l"] + by(s["r"]), F.lit(a))).otherwise(s["l"])
        r_ = F.when(k % 2 == 1, F.pmod(s["r"] + by(s["l"]), F.lit(b))).otherwise(s["r"])
        return F.struct(l_.alias("l"), r_.alias("r"))

    move = 1 + _digits(F.lit(f"{key}|m")) % (a * b - 1)
    moved = _let(_rounds(halves(x), step), lambda s: halves(F.pmod(s["l"] * b + s["r"] + (-move if back else move), F.lit(a * b))))
    return _let(_rounds(moved, step, back=True), lambda s: s["l"] * b + s["r"])


def _within(c: Column, by) -> Column:
    """The letter or digit c moved within its class; by(n) is how far in a class of n."""
    to = lambda low, n: F.char(F.lit(ord(low)) + F.pmod(F.ascii(c) - ord(low) + by(n), F.lit(n)))
    return F.when(c.between("0", "9"), to("0", 10)).when(c.between("a", "z"), to("a", 26)).when(c.between("A", "Z"), to("A", 26)).otherwise(c)


def _shifted(half: Column, stream: Column, sign: int) -> Column:
    """Each letter or digit of half moved within its class by the stream's four hex digits for its place."""
    by = lambda i, once: (F.conv(F.substr(once, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int") + F.floor(i / 16).cast("int") * 7) * sign
    return _let(stream, lambda once: F.array_join(F.transform(F.split(half, ""), lambda c, i: _within(c, lambda n: by(i, once))), ""))


def permuted_text(x: Column, key: str, back: bool = False, salt: Column | None = None) -> Column:
    """A keyed permutation, without fixed points, of the texts that have x's classes of characters, place by place."""
    keys = [F.lit(key)] if salt is None else [F.lit(key), salt]
    cut = F.ceil(F.length(x) / 2).cast("int")
    halves = lambda v: F.struct(F.substr(v, F.lit(1), cut).alias("l"), F.substr(v, cut + 1, F.length(v)).alias("r"))

    def step(s: Column, k: Column, sign: int) -> Column:
        stream = lambda half: F.sha2(F.concat_ws("|", *keys, F.lit("t"), k.cast("string"), F.length(x).cast("string"), half), 256)
        l_ = F.when(k % 2 == 0, _shifted(s["l"], stream(s["r"]), sign)).otherwise(s["l"])
        r_ = F.when(k % 2 == 1, _shifted(s["r"], stream(s["l"]), sign)).otherwise(s["r"])
        return F.struct(l_.alias("l"), r_.alias("r"))

    move = _digits(F.concat_ws("|", *keys, F.lit("m")))

    def on(v: Column) -> Column:
        """v with its first letter or digit moved."""
        before = F.length(F.regexp_extract(v, "^[^A-Za-z0-9]*", 0))
        c = _within(F.substr(v, before + 1, F.lit(1)), lambda n: (1 + move % (n - 1)).cast("int") * (-1 if back else 1))
        return F.concat(F.substr(v, F.lit(1), before), c, F.substr(v, before + 2, F.length(v)))

    moved = _let(_rounds(halves(x), step), lambda s: _let(on(F.concat(s["l"], s["r"])), halves))
    return _let(_rounds(moved, step, back=True), lambda s: F.concat(s["l"], s["r"]))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn's sum, where every second digit counts double, the last one if doubled is 1."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: _let(c.cast("int") * (1 + (i + doubled) % 2), lambda d: d - F.when(d > 9, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda s, d: s + d)


def _in_format(x: Column, digits: Column) -> Column:
    """x with its digits replaced, in order, by those given."""
    so_far = lambda i: F.length(F.regexp_replace(F.substr(x, F.lit(1), i + 1), r"\D", ""))
    return F.array_join(F.transform(F.split(x, ""), lambda c, i: F.when(c.between("0", "9"), F.substr(digits, so_far(i), F.lit(1))).otherwise(c)), "")


def _card(x: Column, key: str, back: bool) -> Column:
    """The card number with other digits and a right check digit, or itself if it is none."""

    def new(digits: Column) -> Column:
        body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), permuted_text(F.substr(digits, F.lit(2), F.length(digits) - 2), key, back))
        return _let(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, 1) % 10) % 10).cast("string")))

    valid = lambda digits: digits.rlike("^[2-6]") & (_luhn_sum(digits, 0) % 10 == 0)
    return _let(F.regexp_replace(x, r"\D", ""), lambda d: F.when(valid(d), _in_format(x, new(d))).otherwise(x))


def _iban(x: Column, key: str, back: bool) -> Column:
    """The account number with other letters and digits and right check digits, or itself if it is none."""
    value = lambda c: F.when(c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string"))
    rest = lambda t: F.aggregate(F.split(F.array_join(F.transform(F.split(t, ""), value), ""), ""), F.lit(0), lambda s, d: (s * 10 + d.cast("int")) % 97)

    def new(plain: Column) -> Column:
        own = permuted_text(F.substr(plain, F.lit(5), F.length(plain)), key, back, F.substr(plain, F.lit(1), F.lit(2)))
        country = F.substr(plain, F.lit(1), F.lit(2))
        return _let(own, lambda o: F.concat(country, F.lpad((98 - rest(F.concat(o, country, F.lit("00")))).cast("string"), 2, "0"), o))

    valid = lambda t: rest(F.concat(F.substr(t, F.lit(5), F.length(t)), F.substr(t, F.lit(1), F.lit(4)))) == 1
    place = lambda i: F.length(F.replace(F.substr(x, F.lit(1), i + 1), F.lit(" "), F.lit("")))
    spaced = lambda n: F.array_join(F.transform(F.split(x, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(n, place(i), F.lit(1)))), "")
    return _let(F.replace(x, F.lit(" "), F.lit("")), lambda t: F.when(valid(t), _let(new(t), spaced)).otherwise(x))


def _ip(x: Column, key: str, back: bool) -> Column:
    octets = F.transform(F.split(x, r"\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    new = _let(permuted_number(number, 1 << 16, 1 << 16, key, back), lambda n: F.array_join(F.array(*(F.floor(n / (1 << s)).cast("long") % 256 for s in (24, 16, 8, 0))).cast("array<string>"), "."))
    return F.when(F.forall(octets, lambda o: o < 256), new).otherwise(x)


def _ip6(x: Column, key: str, back: bool) -> Column:
    """Two halves of 64 bits, each in turn changed by a keyed hash of the other; written short, as the standard has it.

    What isn't eight groups stays.  (That an address stays itself is a matter of one in 2^128.)"""
    parts = F.split(x, "::", 2)
    groups = lambda k: F.filter(F.split(F.coalesce(F.get(parts, F.lit(k)), F.lit("")), ":"), lambda g: g != "")
    missing = 8 - F.size(groups(0)) - F.size(groups(1))
    whole = F.concat(groups(0), F.array_repeat(F.lit("0"), F.when(F.size(parts) > 1, missing).otherwise(0)), groups(1))
    number = lambda text: F.conv(text, 16, -10).cast("long")
    half = lambda k: number(F.array_join(F.transform(F.slice(whole, k, 4), lambda g: F.lpad(g, 4, "0")), ""))

    def step(s: Column, k: Column, sign: int) -> Column:
        by = lambda other: number(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("n"), k.cast("string"), other.cast("string")), 256), 1, 16))
        l_ = F.when(k % 2 == 0, s["l"].bitwiseXOR(by(s["r"]))).otherwise(s["l"])
        r_ = F.when(k % 2 == 1, s["r"].bitwiseXOR(by(s["l"]))).otherwise(s["r"])
        return F.struct(l_.alias("l"), r_.alias("r"))

    def written(s: Column) -> Column:
        digits = F.concat(*(F.lpad(F.lower(F.hex(s[c])), 16, "0") for c in "lr"))
        full = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.regexp_replace(F.substr(digits, k * 4 + 1, F.lit(4)), "^0{1,3}", "")), ":")

        def short(text: Column) -> Column:
            out = text
            for n in range(2, 9):  # the longest run of zeros, the first of equals
                run = f"(?:^|:)0(?::0){{{n - 1}}}(?::|$)"
                out = F.when(text.rlike(run), F.replace(F.regexp_replace(F.regexp_replace(text, f"^(.*?){run}", "$1%"), "%", "::"), F.lit(":::"), F.lit("::"))).otherwise(out)
            return out

        return _let(full, short)

    valid = F.when(F.size(parts) > 1, missing > 0).otherwise(missing == 0)
    return F.when(valid, _let(_rounds(F.struct(half(1).alias("l"), half(5).alias("r")), step, back), written)).otherwise(x)


def _ssn(x: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.split_part(x, F.lit("-"), F.lit(k)).cast("long") for k in (1, 2, 3))
    place = area - F.when(area > 666, 2).otherwise(1)
    number = (place * 99 + group - 1) * 9999 + serial - 1

    def written(n: Column) -> Column:
        places = F.floor(n / (99 * 9999)).cast("long")
        areas = places + F.when(places >= 665, 2).otherwise(1)
        pad = lambda v, k: F.lpad(v.cast("string"), k, "0")
        return F.concat_ws("-", pad(areas, 3), pad(F.floor(n / 9999).cast("long") % 99 + 1, 2), pad(n % 9999 + 1, 4))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _let(permuted_number(number, *_SSN, key, back), written)).otherwise(x)


def _date(x: Column, key: str, back: bool) -> Column:
    first = F.lit(_FIRST_DAY).cast("date")

    def by(*forms: str, of: Column = x) -> Column:
        out = x
        for form in reversed(forms):
            day = F.to_date(F.try_to_timestamp(of, F.lit(form)))
            new = F.date_format(F.date_add(first, permuted_number(F.datediff(day, first).cast("long"), *_DAYS, key, back).cast("int")), form)
            out = F.when(day.isNotNull(), new).otherwise(out)
        return out

    pointed = F.regexp_replace(x, r"^Sept\.", "Sep.")
    return (
        F.when(x.rlike(r"^[A-Z]\w+\."), by("MMM. d, yyyy", of=pointed))
        .when(x.rlike("^[A-Z]"), by("MMM d, yyyy", "MMMM d, yyyy"))
        .when(x.rlike("^[0-9]+ "), by("d MMM yyyy", "d MMMM yyyy"))
        .when(x.rlike("^....-"), by("yyyy-MM-dd"))
        .when(x.rlike("^..../"), by("yyyy/MM/dd"))
        .when(x.rlike("^../../"), by("dd/MM/yyyy", "MM/dd/yyyy"))
        .when(x.contains("/"), by("d/M/yyyy", "M/d/yyyy"))
        .when(x.rlike(r"^..\...\."), by("dd.MM.yyyy", "MM.dd.yyyy"))
        .otherwise(by("d.M.yyyy", "M.d.yyyy"))
    )


def _email(x: Column, key: str, back: bool) -> Column:
    """The local part by its domain, capitals where they were."""
    at = F.instr(x, "@")
    local, domain = F.substr(x, F.lit(1), at - 1), F.substr(x, at, F.length(x))
    cased = lambda n: F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(c.between("A", "Z"), F.upper(F.substr(n, i + 1, F.lit(1)))).otherwise(F.substr(n, i + 1, F.lit(1)))), "")
    low = F.translate(local, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(_let(permuted_text(low, key, back, F.lower(domain)), cased), domain)


def _secret(x: Column, key: str, back: bool) -> Column:
    """The letters and digits of the value, permuted as one text, so that signs at its ends don't matter."""
    stays = F.when(x.rlike(f"^{_NAMED_SECRET}"), F.regexp_extract(x, r"^[^=:]*[=:]+", 0)).otherwise(F.regexp_extract(x, f"^(?:{_BEARER}|{_KEY_PREFIX}|{_LOGIN}|{_BLOCK})", 0))
    value = F.substr(x, F.length(stays) + 1, F.length(x))

    def put(s: Column, pair: Column) -> Column:
        n = F.length(pair["word"])
        return F.struct(F.concat(s["out"], pair["sign"], F.substr(s["rest"], F.lit(1), n)).alias("out"), F.substr(s["rest"], n + 1, F.length(s["rest"])).alias("rest"))

    def new(v: Column) -> Column:
        signs, words = F.split(v, "[A-Za-z0-9]+", -1), F.regexp_extract_all(v, F.lit("[A-Za-z0-9]+"), F.lit(0))
        pairs = F.zip_with(signs, words, lambda a, b: F.struct(a.alias("sign"), F.coalesce(b, F.lit("")).alias("word")))
        start = F.struct(F.lit("").alias("out"), permuted_text(F.array_join(words, ""), key, back).alias("rest"))
        return F.when(v.rlike("[A-Za-z0-9]"), F.aggregate(pairs, start, put, lambda s: s["out"])).otherwise(v)

    return F.concat(stays, _let(value, new))


def _phone(x: Column, key: str, back: bool) -> Column:
    """The digits after the country code, however they are written."""
    stays = F.regexp_extract(x, r"^(?:\+\d{1,3}|1)(?=\D)|^0(?=\d{9,10}$)|^(?:0|\(0\))(?=\d{2,3}[\x20.-])|^[2-9](?=\d\d\x20\d{3}\x20)|^", 0)
    rest = F.substr(x, F.length(stays) + 1, F.length(x))
    return F.concat(stays, _in_format(rest, permuted_text(F.regexp_replace(rest, r"\D", ""), key, back)))


_BY_KIND = {"secret": _secret, "email": _email, "iban": _iban, "ip": _ip, "ip6": _ip6, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def kind_of(x: Column) -> Column:
    """The first kind whose pattern a candidate matches."""
    out = None
    for kind, pattern in KINDS.items():
        is_it = x.rlike(f"^(?:{pattern})$")
        out = F.when(is_it, kind) if out is None else out.when(is_it, kind)
    return out


def pseudonym(x: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of a candidate of a kind (itself if it isn't valid), or with `back` what it stands for."""
    out = None
    for name, f in _BY_KIND.items():
        new = f(x, f"{key}:{name}", back)
        out = F.when(kind == name, new) if out is None else out.when(kind == name, new)
    return out.otherwise(x)


def pseudonymise(documents: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced, kinds (sorted, one for each replacement)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("found", F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    rows = rows.withColumn("found", F.when(F.size("found") > 0, F.col("found")))
    new = F.transform("found", lambda x: _let(kind_of(x), lambda kind: F.struct(x.alias("old"), pseudonym(x, kind, key, back).alias("new"), kind.alias("kind"))))
    rows = rows.withColumn("found", new)
    between = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(between, F.concat(F.col("found.new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = F.filter("found", lambda f: f["old"] != f["new"])
    return rows.select(
        "doc_id",
        F.when(F.col("found").isNull(), F.col("text")).otherwise(joined).alias("text"),
        F.when(F.col("found").isNull(), 0).otherwise(F.size(changed)).cast("long").alias("n_replaced"),
        F.coalesce(F.array_sort(F.transform(changed, lambda f: f["kind"])), F.array().cast("array<string>")).alias("kinds"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} isn't set: pseudonyms under the public sample key can be undone by anyone", stacklevel=2)
    return pseudonymise(spark.read.parquet(f"{sf_dir}/documents.parquet"), key or SAMPLE_KEY)
