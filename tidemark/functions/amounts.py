"""Exact token amounts. Raw amounts are unsigned 256-bit integers kept as text; scaled ones are decimal(37,18)."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

AMOUNT = "decimal(37,18)"

#: Decimals of amounts by network and kind of contract (fixed values); a query never holds a literal divisor.
TOKEN_DECIMALS = {("claim", "default"): 2, ("bounty", "default"): 18, ("supply", "celo"): 18, ("supply", "fuse"): 2, ("supply", "eth"): 2, ("supply", "xdc"): 18, ("price", "xdc"): 6, ("price", "celo"): 18, ("usdc", "default"): 6, ("usdm", "default"): 18}


def decimals_of(kind: str, network: str = "default") -> int:
    return TOKEN_DECIMALS.get((kind, network), TOKEN_DECIMALS.get((kind, "default"), 18))


def scale_raw(raw: Column, decimals: int) -> Column:
    """raw / 10 ** decimals without a division: the text is read with an exponent, so no digit is lost, and text that
    isn't a whole number or doesn't fit is null."""
    text = F.trim(raw.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), F.concat(text, F.lit(f"E-{decimals}")).try_cast(AMOUNT))


def scale_by(raw: Column, decimals: Column) -> Column:
    """As scale_raw, with the decimals of each row."""
    text = F.trim(raw.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), F.concat(text, F.lit("E-"), decimals.cast("string")).try_cast(AMOUNT))


def scale_number(value: Column, decimals: int) -> Column:
    """As scale_raw, of a whole number."""
    return scale_raw(value.cast("decimal(38,0)"), decimals)


def count_times(n: Column, amount: int) -> Column:
    """A count times a whole amount: multiplied as long, then cast, since decimal products lose scale."""
    return (n.cast("long") * F.lit(amount)).cast(AMOUNT)


def strip_thousands(text: Column) -> Column:
    """A number written with thousands separators, as double; null if it isn't one."""
    return F.regexp_replace(text, ",", "").try_cast("double")


def fixed(value: Column, decimals: int | Column) -> Column:
    """Rounds half up to a number of decimals; what isn't finite becomes 0."""
    finite = F.when(value.isNull() | F.isnan(value.cast("double")) | (F.abs(value.cast("double")) == float("inf")), F.lit(0.0)).otherwise(value.cast("double"))
    return F.round(finite, decimals)


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def uint256_text(word: Column) -> Column:
    """Decimal digits of a hexadecimal number of up to 256 bits, with or without 0x. Null if it isn't one. Up to 124 bits
    are added up from three parts as decimals; only longer ones, more than any built-in type holds, go to Python."""
    digits = F.regexp_replace(F.lower(word), "^0x", "")
    short = digits.rlike("^[0-9a-f]+$") & (F.length(F.ltrim(digits, F.lit("0"))) <= 31)
    padded = F.lpad(F.ltrim(digits, F.lit("0")), 31, "0")
    part = lambda start, n: F.conv(F.substring(padded, start, n), 16, 10).cast("decimal(19,0)")
    value = part(1, 1).cast("decimal(2,0)") * F.lit(Decimal(2**120)) + part(2, 15) * F.lit(Decimal(2**60)) + part(17, 15)
    return F.coalesce(F.when(short, value.cast("string")), _long_uint(F.when(~short, word)))


@F.pandas_udf(StringType())
def _long_uint(word: pd.Series) -> pd.Series:

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else str(int(x, 16))
        except ValueError:
            return None

    return word.map(one, na_action="ignore")


def word_address(word: Column) -> Column:
    """The address in a 32-byte topic or data word: its last 20 bytes, in lower case, with 0x."""
    digits = F.regexp_replace(F.lower(word), "^0x", "")
    return F.when(digits.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("0x"), F.substring(digits, 25, 40)))


def address_word(address: Column) -> Column:
    """An address as a 32-byte word, padded on the left."""
    return F.concat(F.lit("0x"), F.lpad(F.regexp_replace(F.lower(address), "^0x", ""), 64, "0"))


def data_word(data: Column, i: int) -> Column:
    """The i-th 32-byte word of ABI-encoded data, without 0x; null beyond its end."""
    word = F.substring(F.regexp_replace(F.lower(data), "^0x", ""), 1 + 64 * i, 64)
    return F.when(F.length(word) == 64, word)
