from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import amounts, dates, naming, urls


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(("raw", "scale", "want"), [("500", 2, "5"), ("100387403913211125356", 18, "100.387403913211125356"), ("abc", 18, None), ("9" * 78, 18, None), ("", 2, None), (None, 2, None), ("-7", 0, "-7"), ("1e5", 2, None)])
def test_scale_raw_is_exact_or_null(spark, raw, scale, want):
    got = one(spark, amounts.scale_raw(F.col("x"), scale), raw)
    assert got == (None if want is None else Decimal(want))


def test_scaling_keeps_every_digit_of_a_sum(spark):
    df = spark.createDataFrame([("1",), ("1000000000000000000",)], "x string").select(amounts.scale_raw(F.col("x"), 18).alias("v"))
    assert df.agg(F.sum("v")).first()[0] == Decimal("1.000000000000000001")


def test_uint256_and_words(spark):
    assert one(spark, amounts.uint256_text(F.col("x")), "f" * 64) == str(2**256 - 1)
    assert one(spark, amounts.uint256_text(F.col("x")), "zz") is None
    address = "0x" + "aB" * 20
    word = one(spark, amounts.address_word(F.col("x")), address)
    assert word == "0x" + "0" * 24 + "ab" * 20
    assert one(spark, amounts.word_address(F.col("x")), word) == address.lower()
    assert one(spark, amounts.word_address(F.col("x")), "0x12") is None
    assert one(spark, amounts.data_word(F.col("x"), 1), "0x" + "1" * 64 + "2" * 64) == "2" * 64
    assert one(spark, amounts.data_word(F.col("x"), 2), "0x" + "1" * 64) is None


def test_text_numbers(spark):
    assert one(spark, amounts.strip_thousands(F.col("x")), "1,234,567.5") == 1234567.5
    assert one(spark, amounts.strip_thousands(F.col("x")), "n/a") is None
    assert one(spark, amounts.fixed(F.col("x"), 2), float("nan"), "double") == 0.0
    assert one(spark, amounts.fixed(F.col("x"), 1), 2.25, "double") == 2.3


def test_whole_days_counts_24_hours(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31), datetime(2024, 1, 24, 1)), (datetime(2024, 1, 31), datetime(2024, 1, 24))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(dates.whole_days(F.col("a"), F.col("b"))).collect()] == [6, 7]


@pytest.mark.parametrize(("text", "want"), [("2025-09-02", date(2025, 9, 2)), ("9/2/2025", date(2025, 9, 2)), ("2.9.2025", date(2025, 9, 2)), ("45902", date(2025, 9, 2)), ("1756771200", date(2025, 9, 2)), ("1756771200000", date(2025, 9, 2)), ("x", None), (None, None)])
def test_loose_dates(spark, text, want):
    assert one(spark, dates.loose_date(F.col("x")), text) == want


def test_unix_days(spark):
    assert one(spark, dates.unix_day(F.col("x")), "20333") == date(2025, 9, 2)
    assert dates.latest_closed_date(date(2024, 3, 1)) == date(2024, 2, 29)


def test_names(spark):
    assert one(spark, naming.base_metric(F.col("x")), "celo_xdc_a") == "xdc_a"
    assert naming.schema_name("prod", " marts ", "base") == "marts"
    assert naming.schema_name("prod", None, "base") == "base"
    assert naming.schema_name("dev", "marts", "base") == "sandbox"


def test_urls(spark):
    tag = lambda u: urls.tagged_url(F.lit(u), F.lit(" Twitter "), F.lit("a  B"), F.lit("c-d"), F.lit(None).cast("string"))
    assert one(spark, tag("https://e.org/x?y=1#z"), "") == "https://e.org/x?y=1&utm_source=twitter&utm_medium=a_b&utm_campaign=c-d#z"
    assert one(spark, tag("ftp://e.org"), "") is None
    assert one(spark, urls.campaign(F.lit("My Drive"), F.lit("Goal"), F.lit(date(2024, 2, 1)), F.col("x")), "Name") == "my_drive-goal-2024_02-name"
    assert one(spark, urls.campaign_parts(F.col("x")), "a-b-2024_02-n-m").asDict() == {"initiative": "a", "goal": "b", "month": "2024_02", "name": "n-m"}
    df = spark.createDataFrame([("Twitter",), ("myspace",), (None,)], "source string")
    assert urls.unknown_values(df, "source").count() == 2
    link = lambda n, c: urls.campaign_link(F.lit("http://e.org"), F.lit("email"), F.lit("email"), F.lit("ubi"), F.lit("goal"), F.lit(date(2024, 2, 1)), F.lit(n).cast("string"), F.lit(c).cast("string"))
    assert one(spark, link("My Name", "A b"), "") == "http://e.org?utm_source=email&utm_medium=email&utm_campaign=ubi-goal-2024_02-my_name&utm_content=a_b"
    assert one(spark, link("n", "x-y"), "") == "http://e.org?utm_source=email&utm_medium=email&utm_campaign=ubi-goal-2024_02-n"
    assert [one(spark, link(n, None), "") for n in ("a-b", " ", None, "é")] == [None] * 4
    own = urls.vocabulary_of({"sources": [{"value": "myspace", "label": "M"}], "version": 1})
    assert own == {"source": ["myspace"]} and urls.unknown_values(df, "source", own["source"]).count() == 2


def test_event_topics():
    from tidemark.functions.keccak import keccak256, topic_of
    from tidemark.sources.contracts import BOUNTY

    assert keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert topic_of("Transfer(address,address,uint256)") == "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    assert keccak256(b"a" * 136) != keccak256(b"a" * 135)
    assert BOUNTY.arguments["bounty_paid"] == ("data", 0, "uint") and BOUNTY.arguments["invitee"] == ("topic", 2, "address")
