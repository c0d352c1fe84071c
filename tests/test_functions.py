from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.casts import CORRUPT, coerce, coerce_or_reject, text_schema
from tidemark.functions.dates import landing_path, landing_path_column, since_column, since_date
from tidemark.functions.json_text import first_count, flatten_pages
from pyspark.sql.types import StructType

NUMBERS = StructType().add("docket_number", "long").add("name", "string").add("at", "timestamp")


@pytest.mark.parametrize("blank", [None, "", 0, "0"])
def test_blank_or_zero_look_back_is_a_full_read(blank):
    assert since_date("2022-05-04", blank) is None


def test_look_back_is_the_lower_bound():
    assert since_date("2022-05-01", 2) == "2022-04-29"
    assert since_date(dt.date(2022, 1, 1), "1") == "2021-12-31"


def test_run_date_with_a_time_counts_as_its_day():
    assert since_date(dt.datetime(2022, 5, 4, 6), 2) == "2022-05-02"
    assert landing_path("/out", "x", dt.datetime(2022, 5, 4, 6)) == "/out/x/2022/5/4"


def test_negative_look_back_is_refused():
    with pytest.raises(ValueError, match="negative"):
        since_date("2022-05-04", -1)


def test_strict_cast_checks_columns_that_are_not_used(spark):
    rows = coerce(raw(spark, [("x1", "x", None)]), NUMBERS)
    with pytest.raises(Exception, match="cannot read 'x1'"):
        rows.select("name").collect()


def test_bad_run_date_is_refused():
    with pytest.raises(ValueError):
        since_date("04/05/2022", 2)


def test_landing_folder_has_no_leading_zeros(spark):
    assert landing_path("/out/", "evictions", "2022-05-04") == "/out/evictions/2022/5/4"
    df = spark.createDataFrame([("2022-05-04",)], "d string").select(F.to_date("d").alias("d"))
    got = df.select(landing_path_column("/out", "evictions", F.col("d")).alias("p")).first()["p"]
    assert got == "/out/evictions/2022/5/4"


def test_since_column(spark):
    df = spark.createDataFrame([("2022-05-01",)], "d string")
    assert df.select(since_column(F.col("d"), 2).alias("s")).first()["s"] == "2022-04-29"


def raw(spark, rows):
    return spark.createDataFrame(rows, text_schema(NUMBERS))


def test_strict_cast(spark):
    row = coerce(raw(spark, [("123", "x", "2017-01-05T00:00:00.000")]), NUMBERS).first()
    assert row["docket_number"] == 123
    assert row["at"] == dt.datetime(2017, 1, 5)
    assert coerce(raw(spark, [(None, None, None)]), NUMBERS).first().asDict() == {
        "docket_number": None,
        "name": None,
        "at": None,
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_refuses_and_names_the_value(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="docket_number: cannot read 'x1' as bigint"):
            coerce(raw(spark, [("x1", "x", None)]), NUMBERS).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_permissive_cast_keeps_rejects(spark):
    rows = [("123", "a", None), ("x1", "b", "never"), (None, "c", None)]
    good, rejects = coerce_or_reject(raw(spark, rows), NUMBERS)
    assert [(r["docket_number"], r["name"]) for r in good.collect()] == [(123, "a"), (None, "c")]
    (reject,) = rejects.collect()
    assert reject["columns"] == "docket_number,at"
    assert reject["record"] == '{"docket_number":"x1","name":"b","at":"never"}'


def test_line_that_is_not_json(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"docket_number": "5"}\n{\'docket_number\': None}\n')
    schema = text_schema(NUMBERS).add(CORRUPT, "string")
    lines = spark.read.schema(schema).json(str(path))
    good, rejects = coerce_or_reject(lines, NUMBERS)
    assert [r["docket_number"] for r in good.collect()] == [5]
    assert [tuple(r) for r in rejects.collect()] == [("{'docket_number': None}", CORRUPT)]
    with pytest.raises(Exception, match="unreadable line"):
        coerce(lines, NUMBERS).collect()


def test_flatten_pages(spark):
    pages = spark.createDataFrame(
        [('[{"docket_number": "1", "name": "a"}, {"name": "b"}]',), ("[]",)], "body string"
    )
    got = flatten_pages(pages, "body", NUMBERS).collect()
    assert [(r["docket_number"], r["name"]) for r in got] == [("1", "a"), (None, "b")]


@pytest.mark.parametrize("body", ['{"error": "no such column"}', "[{]"])
def test_error_answer_is_not_a_row(spark, body):
    pages = spark.createDataFrame([(body,)], "body string")
    with pytest.raises(Exception, match="expected a JSON list|MALFORMED"):
        flatten_pages(pages, "body", NUMBERS).collect()


def test_first_count(spark):
    df = spark.createDataFrame([('[{"count": "35"}]',)], "body string")
    assert df.select(first_count(F.col("body")).alias("n")).first()["n"] == 35
