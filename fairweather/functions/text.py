"""Text keys and the cleaning of numbers that arrive as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cell texts that mean "no value" in a weather file.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Every character that counts as white space at the ends of a key.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a number. A plain cast to double would also let through a
# 'd' or 'f' suffix and hexadecimal.
_POINT_NUMBER = r"(?i)^\s*[-+]?((\d+(\.\d*)?|\.\d+)(e[-+]?\d+)?|inf|infinity|nan)\s*$"
_COMMA_NUMBER = r"(?i)^\s*[-+]?((\d+([.,]\d*)?|[.,]\d+)(e[-+]?\d+)?|inf|infinity)\s*$"


def clean_key(column: Column) -> Column:
    """Strip white space of any kind (tabs, non-breaking spaces) from both ends."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def address_key(address: Column, postal_code: Column, city: Column) -> Column:
    """``address, postal code, city``; null parts are skipped, empty parts kept."""
    return F.concat_ws(", ", F.trim(address), F.trim(postal_code), F.trim(city))


def combination_key(latitude: Column, longitude: Column, department: Column, day: Column) -> Column:
    """Readable ``lat_lon_department_day`` text. An output column: joins use the four columns."""
    return F.concat_ws(
        "_", latitude.cast("string"), longitude.cast("string"), department.cast("string"), day
    )


def department_key(department: Column) -> Column:
    """Department code as a comparable text: ``01`` and ``' 1 '`` are ``1``, ``2A`` stays ``2A``."""
    text = department.cast("string")
    return F.coalesce(text.try_cast("int").cast("string"), F.trim(text))


def parse_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return F.when(text.rlike(_POINT_NUMBER), text.try_cast("double"))


def parse_decimal_comma(text: Column) -> Column:
    """``12,3`` to 12.3; text that is not a number becomes null."""
    return F.when(text.rlike(_COMMA_NUMBER), F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def null_tokens(text: Column) -> Column:
    """Null for the tokens that mean "no value", the text itself otherwise."""
    return F.when(~text.isin(NULL_TOKENS), text)
