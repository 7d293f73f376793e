"""The record: four comma-separated fields carried as one raw string.

``raw`` is the record. Fields are read out of it on demand and never glued
back together, so a sort or a copy returns exactly the bytes it was given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = ("id", "name", "address", "continent")

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("raw", T.StringType(), False),
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("continent", T.StringType(), False),
    ]
)

def _before_comma(raw: Column, n: int) -> Column:
    """Everything before the n-th comma; the whole record if it has fewer.

    substring_index works on bytes, so it is also exact on invalid UTF-8,
    where split would put replacement characters.
    """
    return F.substring_index(raw, ",", n)


def _has_commas(raw: Column, n: int) -> Column:
    return F.octet_length(_before_comma(raw, n)) < F.octet_length(raw)


def _nth_field(raw: Column, n: int) -> Column:
    return F.substring_index(_before_comma(raw, n), ",", -1)


def _wrap(number: Column) -> Column:
    """The low 32 bits of a long as a signed number."""
    return F.shiftright(F.shiftleft(number, 32), 32)


def work_prefix(columns: Sequence[str]) -> str:
    """A beginning of column names that no column has, so that work columns replace none."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def with_lenient_int32(df: DataFrame, name: str, text: Column) -> DataFrame:
    """Add ``name``: a decimal fold over the bytes of ``text`` that accepts anything and wraps.

    Each byte counts as (byte - 48) mod 256 and the total is kept as a signed
    32-bit integer: '12' is 12, '-5' is 2535, '2147483648' is -2147483648.
    Null gives 0. The steps are columns of their own, as each is used several
    times in the next.
    """
    kept = df.columns
    mark = work_prefix(kept)
    at = lambda step: f"{mark}{step}"
    df = df.withColumn(at("text"), text)

    # Up to 18 digits fit a long: the usual case. Nothing else is ever cast,
    # as even a try_cast that fails costs a Java exception.
    digits = (F.octet_length(at("text")) <= 18) & F.col(at("text")).rlike(r"\A[0-9]+\z")
    df = df.withColumn(at("plain"), F.when(digits, _wrap(F.col(at("text")).cast("bigint"))))

    # 10^32 is a multiple of 2^32, so bytes before the last 32 cannot matter,
    # and fewer are filled up with '0', hex 30, on the left.
    tail = F.lpad(F.hex(F.substring(F.col(at("text")).cast("binary"), -32, 32)), 64, "30")
    df = df.withColumn(at("tail"), F.when(F.col(at("plain")).isNull(), tail))

    # Eight bytes at a time in one long: bytes to pairs of digits in 16 bits
    # each, then pairs to fours in 32 bits.
    parts = [str(i) for i in range(4)]
    byte, less_48, pair = F.lit(0x00FF00FF00FF00FF), F.lit(0x00D000D000D000D0), F.lit(0x0000FFFF0000FFFF)
    df = df.withColumns(
        {at("bytes" + i): F.conv(F.substring(at("tail"), 1 + 16 * int(i), 16), 16, -10).cast("bigint") for i in parts}
    )
    ones = {i: (F.col(at("bytes" + i)).bitwiseAND(byte) + less_48).bitwiseAND(byte) for i in parts}
    tens = {i: (F.shiftrightunsigned(at("bytes" + i), 8).bitwiseAND(byte) + less_48).bitwiseAND(byte) for i in parts}
    df = df.withColumns({at("pairs" + i): tens[i] * 10 + ones[i] for i in parts})
    high = {i: F.shiftrightunsigned(at("pairs" + i), 16).bitwiseAND(pair) for i in parts}
    df = df.withColumns({at("fours" + i): high[i] * 100 + F.col(at("pairs" + i)).bitwiseAND(pair) for i in parts})
    total = F.lit(0)
    for i in parts:
        eight = F.shiftrightunsigned(at("fours" + i), 32) * 10**4 + F.col(at("fours" + i)).bitwiseAND(F.lit(0xFFFFFFFF))
        weight = (10 ** (24 - 8 * int(i)) + 2**31) % 2**32 - 2**31
        total = total + _wrap(eight * weight)

    number = F.coalesce(F.col(at("plain")), _wrap(total), F.lit(0)).cast("int")
    return df.select(*[c for c in kept if c != name], number.alias(name))


def _text_field(raw: Column, field: str) -> Column:
    if field == "name":
        return F.when(_has_commas(raw, 2), _nth_field(raw, 2)).otherwise(F.lit(""))
    if field == "address":
        return F.when(_has_commas(raw, 3), _nth_field(raw, 3)).otherwise(F.lit(""))
    if field == "continent":
        exactly_three = _has_commas(raw, 3) & ~_has_commas(raw, 4)
        return F.when(exactly_three, F.substring_index(raw, ",", -1)).otherwise(F.lit(""))
    raise ValueError(f"unknown field {field!r}; a record has {', '.join(FIELDS)}")


def parse_records(df: DataFrame, *fields: str) -> DataFrame:
    """Add the named fields (all four by default) next to ``raw``; 0 or '' where the record is too short.

    A field counts only once the comma after it is there. The last one has no
    comma after it and counts only in a record of exactly three commas.
    """
    raw, fields = F.col("raw"), fields or FIELDS
    if "id" in fields:
        df = with_lenient_int32(df, "id", F.when(_has_commas(raw, 1), _before_comma(raw, 1)))
    return df.withColumns({field: _text_field(raw, field) for field in fields if field != "id"})


def encode_record(id: Column, name: Column, address: Column, continent: Column) -> Column:
    return F.concat_ws(",", id.cast("string"), name, address, continent)


def payload_bytes(raw: Column) -> Column:
    return F.octet_length(raw).cast("bigint")


def strip_line_end(line: Column) -> Column:
    return F.rtrim(line, F.lit("\r\n"))


def _lines(value: Column) -> Column:
    # split decodes to characters and would put replacement characters for
    # invalid UTF-8. As ISO-8859-1 every byte is a character and stays itself.
    characters = F.decode(value.cast("binary"), "ISO-8859-1")
    return (
        F.when(F.instr(value, "\n") == 0, F.array(value))
        .when(F.is_valid_utf8(value), F.split(value, "\n", -1))
        .otherwise(F.transform(F.split(characters, "\n", -1), lambda line: F.encode(line, "ISO-8859-1").cast("string")))
    )


def normalise_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per line of ``value``, as ``raw``; null counts as an empty line."""
    others = [c for c in df.columns if c != value]
    text = F.coalesce(F.col(value), F.lit(""))
    exploded = df.select(*others, F.explode(_lines(text)).alias("raw"))
    return exploded.withColumn("raw", strip_line_end(F.col("raw")))


def key_from_path(path: Column) -> Column:
    """What follows the first underscore; the path itself if that is nothing."""
    cut = F.instr(path, "_")
    rest = path.substr(cut + 1, F.length(path))
    return F.when((cut > 0) & (rest != ""), rest).otherwise(path)
