from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import checks, keyed, series


def D(n):
    return date(2024, 1, n)


def test_rolling_distinct_against_sets(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 5)), min_size=1, max_size=40))
    def check(rows):
        df = spark.createDataFrame([(D(d), u) for d, u in rows], "day date, u int")
        got = {r["day"]: r["n"] for r in series.rolling_distinct(df, "day", "u", 7, "n", D(1), D(12)).collect()}
        for d in range(1, 13):
            want = len({u for e, u in rows if d - 6 <= e <= d})
            assert got.get(D(d), 0) == want

    check()


def test_rolling_sum_counts_gaps_as_zero_and_empty_as_nothing(spark):
    df = spark.createDataFrame([(D(1), 1.0), (D(4), 2.0)], "day date, v double")
    assert [r["s"] for r in series.rolling_sum(df, "day", "v", 3, "s").orderBy("day").collect()] == [1.0, 1.0, 1.0, 2.0]
    assert series.rolling_sum(df.limit(0), "day", "v", 3, "s").count() == 0


def test_price_series_both_readings(spark):
    days = spark.createDataFrame([(D(i),) for i in range(1, 6)], "day date")
    prices = spark.createDataFrame([(D(2), 2.0), (D(4), 4.0)], "day date, price double")
    literal = [r["price"] for r in series.price_series(days, prices, "day", "price", False).orderBy("day").collect()]
    filled = [r["price"] for r in series.price_series(days, prices, "day", "price", True).orderBy("day").collect()]
    assert literal == [None, 2.0, None, 4.0, None]
    assert filled == [2.0, 2.0, 2.0, 4.0, 4.0]


def test_cumulative_distinct(spark):
    df = spark.createDataFrame([(D(1), "a"), (D(2), "a"), (D(2), "b"), (D(3), None)], "day date, who string")
    assert [tuple(r) for r in series.cumulative_distinct(df, "day", "who", "n").orderBy("day").collect()] == [(D(1), 1), (D(2), 2)]


def test_date_spine_ends(spark):
    assert series.date_spine(spark, D(1), D(3)).count() == 3
    assert series.date_spine(spark, D(3), D(1)).count() == 0


def test_append_is_idempotent_and_merge_corrects(spark, tmp_path):
    store = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "k string, v int")
    assert [tuple(r) for r in keyed.new_keys_only(batch, store, ["k"]).collect()] == [("c", 3)]
    assert sorted(tuple(r) for r in keyed.new_keys_only(batch, store, ["k"], merge=True).collect()) == [("a", 1), ("b", 9), ("c", 3)]
    from tidemark.sources.sinks import append_new

    path = str(tmp_path / "facts")
    append_new(batch, path, ["k"])
    append_new(batch, path, ["k"])
    assert spark.read.parquet(path).count() == 2


def test_first_by_breaks_ties_by_order(spark):
    df = spark.createDataFrame([("u", 1, 5), ("u", 1, 3), ("v", 2, 1)], "k string, t int, b int")
    assert sorted(tuple(r) for r in keyed.first_by(df, ["k"], ["t", "b"]).collect()) == [("u", 1, 3), ("v", 2, 1)]


def test_layers_and_deletes(spark):
    b, h = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1)], [("a", 2), ("b", 3)]))
    assert sorted(tuple(r) for r in keyed.layered(b, h, ["k"], "v").collect()) == [("a", 1), ("b", 3)]
    assert keyed.without(h, "k", ["a"]).count() == 1


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 2)], "k string, v int")
    assert checks.not_null(df, "k").count() == 1
    assert checks.unique(df, "k").count() == 1
    assert checks.accepted_values(df, "k", ["b"]).count() == 2
    assert checks.non_negative(df, "v").count() == 1
    assert checks.relationship(df, "k", df.where("v = 2"), "k").count() == 2
    rows = {r["test"]: r["status"] for r in checks.failures({"x": df.limit(0), "y": df}).collect()}
    assert rows == {"x": "pass", "y": "fail"}
    t = spark.createDataFrame([(datetime(2024, 1, 1),)], "at timestamp_ntz")
    ages = [checks.freshness(t, "at", now).first()["status"] for now in (datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 5))]
    assert ages == ["pass", "warn", "error"]
    assert checks.freshness(t.limit(0), "at", datetime(2024, 1, 1)).first()["status"] == "error"


def test_rolling_distinct_against_counting(spark):
    import random
    from datetime import date, timedelta

    from tidemark.operators.series import rolling_distinct

    r, d0 = random.Random(5), date(2024, 1, 1)
    rows = {(r.choice("ab"), d0 + timedelta(days=r.randrange(40)), r.randrange(9)) for _ in range(60)}
    df = spark.createDataFrame([*rows, ("a", d0, None)], "g string, d date, k long")
    for days in (1, 3, 7):
        got = {(x["g"], x["d"]): x["n"] for x in rolling_distinct(df, "d", "k", days, "n", by=("g",)).collect()}
        want = {(g, d0 + timedelta(days=i)): len({k for h, d, k in rows if h == g and 0 <= i - (d - d0).days < days}) for g in "ab" for i in range(60)}
        assert got == {k: n for k, n in want.items() if n}
    lo, hi = d0 + timedelta(days=10), d0 + timedelta(days=20)
    part = rolling_distinct(df, "d", "k", 7, "n", lo, hi, by=("g",)).collect()
    assert {(x["g"], x["d"]): x["n"] for x in part} == {k: n for k, n in want.items() if n and lo <= k[1] <= hi}


def test_words_of_any_length_as_decimal_digits(spark):
    from tidemark.functions.amounts import uint256_text

    numbers = [0, 1, 15, 2**60 - 1, 2**60, 2**120 - 1, 2**120, 2**124 - 1, 2**124, 2**128, 2**256 - 1]
    df = spark.createDataFrame([(f"0x{n:064x}", str(n)) for n in numbers] + [(f"{n:X}", str(n)) for n in numbers] + [("0x", None), ("xyz", None), (None, None)], "w string, n string")
    assert [(r["w"], r["x"]) for r in df.select("w", uint256_text(df["w"]).alias("x"), "n").collect()] == [(r["w"], r["n"]) for r in df.collect()]
