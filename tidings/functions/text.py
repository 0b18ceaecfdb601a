"""Text, date and number expressions. Everything here is a plain Column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that counts as whitespace, Unicode ones included; ``trim`` alone knows the blank only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# Casts ignore blanks around a number, so the patterns allow them.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"

# Corporate-form markers dropped from a name, in this order.
CORPORATE_FORMS = ["(주)", "주식회사", "INC.", "CO., LTD."]

# How each Latin letter is read aloud in Hangul.
LETTER_READINGS = {
    "A": "에이", "B": "비", "C": "씨", "D": "디", "E": "이",
    "F": "에프", "G": "지", "H": "에이치", "I": "아이", "J": "제이",
    "K": "케이", "L": "엘", "M": "엠", "N": "엔", "O": "오",
    "P": "피", "Q": "큐", "R": "알", "S": "에스", "T": "티",
    "U": "유", "V": "브이", "W": "더블유", "X": "엑스", "Y": "와이", "Z": "제트",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace from both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def or_none_text(c: Column | str) -> Column:
    """Text form in which a null prints as ``None``."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def flatten_newlines(c: Column | str) -> Column:
    """Each line feed and carriage return becomes one blank; null stays null."""
    return F.translate(_col(c), "\n\r", "  ")


def to_number(c: Column | str) -> Column:
    """Double value of numeric text, else null. Rejects Java-only spellings such as ``12d``."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_long(c: Column | str) -> Column:
    """Whole part of numeric text as bigint, null beyond its range; digit-only text never goes through a double."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint")).otherwise(to_number(c).try_cast("bigint"))


def same_number(a: Column | str, b: Column | str) -> Column:
    """Numeric equality of two text columns; text that is no number equals nothing.

    Digits are compared as digits, however many there are, and as doubles only against other spellings.
    """
    digits = lambda c: F.concat(
        F.when(F.regexp_extract(c, r"^\s*-0*[1-9]", 0) != "", "-").otherwise(""), F.regexp_extract(c, r"^\s*[+-]?0*(\d+)\s*$", 1))
    left, right = _col(a).cast("string"), _col(b).cast("string")
    whole = left.rlike(_INTEGER) & right.rlike(_INTEGER)
    return F.when(whole, digits(left) == digits(right)).otherwise(to_number(a) == to_number(b))


def _bare_name(c: Column | str) -> Column:
    name = F.upper(strip(F.coalesce(_col(c).cast("string"), F.lit(""))))
    for form in CORPORATE_FORMS:
        name = F.replace(name, F.lit(form), F.lit(""))
    return F.translate(name, ",. ", "")


def _spell_letters(bare: Column) -> Column:
    spelled = bare
    for letter, reading in LETTER_READINGS.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(reading))
    mixed = F.when(bare.rlike("[가-힣]") | (F.length(bare) <= 3), spelled).otherwise(bare)
    return F.lower(strip(mixed))


def normalize_company_name(c: Column | str) -> Column:
    """Join key of a company name: markers, punctuation and blanks removed, letters spelled out.

    Letters are spelled in Hangul only when the name already has a Hangul syllable or is at most
    three characters long. Null gives the empty string.
    """
    return _spell_letters(_bare_name(c))


def with_normalized_name(df: DataFrame, name: str, out: str) -> DataFrame:
    """``normalize_company_name`` in two projections, so that the cleaned text is computed once a row."""
    return df.withColumn("_bare", _bare_name(name)).withColumn(out, _spell_letters(F.col("_bare"))).drop("_bare")


def normalize_date(c: Column | str) -> Column:
    """``YYYYMMDD`` or ``YYYY.M.D`` text to ``YYYY.MM.DD``; anything else is returned as it is."""
    text = _col(c).cast("string")
    iso = F.when(
        text.rlike(r"^\d{8}$"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    ).when(text.rlike(r"^\d{4}\.\d{1,2}\.\d{1,2}$"), F.translate(text, ".", "-"))
    return F.coalesce(F.date_format(iso.try_cast("date"), "yyyy.MM.dd"), text)


def reference_text(title: Column | str, basc_dt: Column | str, site: Column | str | None = None) -> Column:
    """``[site]. title. date``; the site part is left out when there is no such column."""
    tail = F.concat(or_none_text(title), F.lit(". "), or_none_text(basc_dt))
    if site is None:
        return tail
    return F.concat(F.lit("["), or_none_text(site), F.lit("]. "), tail)


def article_context(title: Column | str, content: Column | str) -> Column:
    """Title and whole article body."""
    return F.concat_ws(" ", _col(title), _col(content))


def company_context(industry: Column | str, product: Column | str, name: Column | str) -> Column:
    """Industry and product, or the company name when both are missing."""
    return F.coalesce(empty_to_null(strip(F.concat_ws(" ", _col(industry), _col(product)))), _col(name))


def render_prompt(template: str, **fields: Column | str) -> Column:
    """Fill ``{field}`` slots of a template with columns; a null prints as ``None``.

    ``{{`` and ``}}`` are literal braces, as in ``str.format``.
    """
    from string import Formatter

    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(or_none_text(fields[field]))
    return F.concat(*parts) if parts else F.lit("")
