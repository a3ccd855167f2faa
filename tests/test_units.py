import pytest

from adloom.operators import units

CASES = [
    ("JB_1", "32 000 to 35 000 CZK per month", 32000, 35000), ("JB_1", "107 tisíc–161 tisíc CZK", 107000, 161000), ("JB_1", "56-78k Kč monthly + bonusy", 56000, 78000),
    ("JB_1", "CZK 28 tisíc až CZK 38 tisíc týdně", 119000, 161500), ("BLT_1", "US$28 000–42 000/yr", 52500, 78750), ("IND_1", "max. 18 eur per hour", -1, 75600),
    ("JB_1", "od 1 190 euro per month", 29750, -1), ("JB_1", "0,6 mil. - 0,8 mil. CZK per year (gross)", 50000, 66667), ("BLT_1", "at least EUR 17.100", 35625, -1),
    ("JB_1", "430-520,- Kč/hod", 72240, 87360), ("JB_1", " AŽ 163,000 KC/MĚS.", -1, 163000), ("SJ_1", "24,50 euro/h", 102900, 102900), ("JB_1", "od 13 100 týdně", 55675, -1),
    ("IND_1", "20 Fr. per hour", 89040, 89040), ("JB_1", "85000", 85000, 85000),
]
NONE = [None, "", " ", "Dohodou", "Attractive salary + 401k", "bonus až 15 %", "5 týdnů dovolené", "tarifní třída 11", "13. plat", "nan", "x" * 4000]


@pytest.fixture(scope="module")
def small(spark):
    d = spark.createDataFrame([("JB", "CZK", "month"), ("SJ", "CZK", "month"), ("BLT", "USD", "year"), ("IND", "GBP", "year")], "id_prefix string, currency string, pay_unit string")
    fx = spark.createDataFrame([("CZK", 1.0), ("EUR", 25.0), ("USD", 22.5), ("GBP", 29.25), ("PLN", 5.75), ("CHF", 26.5)], "currency string, czk double")
    u = spark.createDataFrame([("hour", 168, 1), ("day", 21, 1), ("week", 17, 4), ("month", 1, 1), ("year", 1, 12)], "unit string, month_num int, month_den int")
    return d, fx, u


def _run(spark, small, rows):
    df = spark.createDataFrame([(i, a, b, "clash") for i, (a, b) in enumerate(rows)], "row_id long, ID string, Salary string, currency string")
    return {r["row_id"]: (r["low_czk"], r["high_czk"]) for r in units.monthly_pay(df, *small).collect()}


def test_pay(spark, small):
    assert _run(spark, small, [(a, b) for a, b, *_ in CASES]) == {i: (lo, hi) for i, (_, _, lo, hi) in enumerate(CASES)}


def test_no_pay_and_unknown_source(spark, small):
    assert _run(spark, small, [("JB_1", v) for v in NONE] + [(None, "50 000"), ("ZZ_1", "50 000")]) == {}
    assert _run(spark, small, []) == {}


EXTRAS = [
    ("JB_1", "50 000 Kč měsíčně, bonus 10 %", 50000, 50000), ("JB_1", "50 000 Kč měsíčně, bonus 5 000 Kč ročně", 50000, 50000), ("JB_1", "bonus až 15 %, 40 000 - 45 000 Kč", 40000, 45000),
    ("JB_1", "30 000 Kč, 5 týdnů dovolené, stravenky 100 Kč/den", 30000, 30000), ("JB_1", "35 000 Kč a 13. plat", 35000, 35000), ("JB_1", "tarifní třída 11, 38 000 Kč", 38000, 38000),
    ("JB_1", "40 000 Kč měsíčně, odměny", 40000, 40000), ("BLT_1", "$60,000 a year, 401(k)", 112500, 112500),
]


def test_extras_are_taken_out_of_stated_pay(spark, small):
    assert _run(spark, small, [(a, b) for a, b, *_ in EXTRAS]) == {i: (lo, hi) for i, (_, _, lo, hi) in enumerate(EXTRAS)}


def test_unknown_currency_is_reported_not_guessed(spark, small):
    rows = [("JB_1", "SEK 40000"), ("JB_1", "40 000 kr/month"), ("ZZ_1", "50 000"), ("JB_1", "50 000 PLN"), ("JB_1", "50 000")]
    d, fx, u = small
    less = (d, fx.where("currency <> 'PLN'"), u)
    assert _run(spark, less, rows) == {4: (50000, 50000)}
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "row_id long, ID string, Salary string")
    got = {r["row_id"]: r["reason"] for r in units.unconverted(df, *less).collect()}
    assert got == {0: "currency unknown", 1: "currency unknown", 2: "no currency", 3: "no rate"}
