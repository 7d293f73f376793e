from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.functions.records import (
    FIELDS,
    encode_record,
    key_from_path,
    normalise_lines,
    parse_records,
    payload_bytes,
    with_lenient_int32,
)
from tallyline.operators.generate import records_for

# raw, id, name, address, continent
RECORDS = [
    ("12345,Ada Lovelace,10 Downing Street,Europe", 12345, "Ada Lovelace", "10 Downing Street", "Europe"),
    ("Ada Lovelace,10 Downing Street,12345", -161940601, "10 Downing Street", "", ""),
    ("", 0, "", "", ""),
    ("123", 0, "", "", ""),
    ("1,a", 1, "", "", ""),
    ("1,a,b", 1, "a", "", ""),
    ("1,a,b,Asia", 1, "a", "b", "Asia"),
    ("1,a,b,Asia,x", 1, "a", "b", ""),
    ("1,a,b,Asia,", 1, "a", "b", ""),
    (",a,b,Asia", 0, "a", "b", "Asia"),
    (",,,", 0, "", "", ""),
    ("-5,a,b,Asia", 2535, "a", "b", "Asia"),
    ("+5,a,b,Asia", 2515, "a", "b", "Asia"),
    ("007,a,b,Asia", 7, "a", "b", "Asia"),
    (" 7,a,b,Asia", 2407, "a", "b", "Asia"),
    ("2147483647,a,b,Asia", 2147483647, "a", "b", "Asia"),
    ("2147483648,a,b,Asia", -2147483648, "a", "b", "Asia"),
    ("99999999999999,a,b,Asia", 276447231, "a", "b", "Asia"),
    ("é1,a,b,Asia", 15911, "a", "b", "Asia"),
    ("1,a, lead and trail ,Asia", 1, "a", " lead and trail ", "Asia"),
    ('1,"q",b,Asia', 1, '"q"', "b", "Asia"),
    ("12\r,a,b,Asia", 341, "a", "b", "Asia"),
    ("12\n,a,b,Asia", 338, "a", "b", "Asia"),
    ("12\u0085,a,b,Asia", 2745, "a", "b", "Asia"),
]


def test_parse_truth_table(spark):
    got = parse_records(spark.createDataFrame([(r[0],) for r in RECORDS], "raw string")).collect()
    assert [tuple(r) for r in got] == RECORDS


def expected_id(field: bytes) -> int:
    total = 0
    for byte in field:
        total = (total * 10 + (byte - 48) % 256) % 2**32
    return total - 2**32 if total >= 2**31 else total


def expected_parse(raw: str) -> tuple:
    fields = raw.split(",")
    n = len(fields)
    return (
        expected_id(fields[0].encode()) if n >= 2 else 0,
        fields[1] if n >= 3 else "",
        fields[2] if n >= 4 else "",
        fields[3] if n == 4 else "",
    )


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.text(st.characters(codec="utf-8", exclude_characters=","), max_size=40), min_size=1, max_size=6).map(",".join),
        min_size=1,
        max_size=80,
    )
)
def test_parse_matches_plain_python(spark, records):
    got = parse_records(spark.createDataFrame([(r,) for r in records], "raw string")).collect()
    assert [(r.id, r.name, r.address, r.continent) for r in got] == [expected_parse(r) for r in records]


def test_long_numbers_depend_on_their_last_32_bytes_only(spark):
    numbers = ["9" * n for n in (31, 32, 33, 500)] + ["\x00" * 40 + "1", "x" * 1000]
    got = parse_records(spark.createDataFrame([(n + ",",) for n in numbers], "raw string"), "id").collect()
    assert [r.id for r in got] == [expected_id(n.encode()) for n in numbers]


def test_invalid_utf8_keeps_its_bytes(spark):
    df = spark.sql("select cast(X'31FF2C61FE2C622C41' as string) as raw")
    row = parse_records(df).select("id", F.hex("name").alias("name"), F.hex("raw").alias("raw")).first()
    assert (row.id, row.name, row.raw) == (expected_id(b"1\xff"), "61FE", "31FF2C61FE2C622C41")


def test_unknown_field(spark):
    with pytest.raises(ValueError):
        parse_records(spark.createDataFrame([("",)], "raw string"), "planet")


def test_encode_gives_back_a_well_formed_record(spark):
    raws = [r[0] for r in RECORDS[:1]] + ["21,axxxxxxxxx,12 abc dfsf LdUE,Asia"]
    parsed = parse_records(spark.createDataFrame([(r,) for r in raws], "raw string"))
    assert [r[0] for r in parsed.select(encode_record(*map(F.col, FIELDS))).collect()] == raws


def test_payload_is_counted_in_bytes(spark):
    df = spark.createDataFrame([("é1",), ("",)], "raw string")
    assert [r[0] for r in df.select(payload_bytes(F.col("raw"))).collect()] == [3, 0]


def test_normalise_lines(spark):
    values = [None, "", "a", "a\n", "1,a,b,Asia\r", "x\ny\r\n\r\nz", "p\rq\r\r"]
    got = normalise_lines(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string"))
    lines: dict[int, list[str]] = {}
    for row in got.collect():
        lines.setdefault(row.n, []).append(row.raw)
    assert lines == {0: [""], 1: [""], 2: ["a"], 3: ["a", ""], 4: ["1,a,b,Asia"], 5: ["x", "y", "", "z"], 6: ["p\rq"]}


def test_normalise_keeps_invalid_utf8(spark):
    df = spark.sql("select cast(X'31FF0A61FE0A' as string) as value")
    assert [r[0] for r in normalise_lines(df).select(F.hex("raw")).collect()] == ["31FF", "61FE", ""]


def test_key_from_path(spark):
    paths = ["sorted_id", "a_b_c", "x_", "abc", "_x", "", "_"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(key_from_path(F.col("p"))).collect()
    assert [r[0] for r in got] == ["id", "b_c", "x_", "abc", "x", "", "_"]


def test_lines_of_invalid_utf8_keep_their_bytes_and_take_linear_time(spark):
    lines = [b"\xff" + str(i).encode() + b",\xe9,x" for i in range(16_000)]
    df = spark.createDataFrame([(bytearray(b"\n".join(lines)),)], "b binary").select(F.col("b").cast("string").alias("value"))
    normalise_lines(df).count()
    started = time.perf_counter()
    got = normalise_lines(df).select(F.col("raw").cast("binary")).collect()
    assert time.perf_counter() - started < 3
    assert [bytes(r[0]) for r in got] == lines


def test_work_columns_replace_none_of_the_callers(spark):
    df = spark.createDataFrame([("12", "keep me", "and me")], "raw string, _text string, __plain string")
    assert with_lenient_int32(df, "id", F.col("raw")).first() == ("12", "keep me", "and me", 12)
    row = records_for(spark.createDataFrame([(1, "mine")], "n long, _first string"), "n").first()
    assert row["_first"] == "mine"
