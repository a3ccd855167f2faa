"""Quantities in free text to one unit, in pure SQL expressions.

``regexp_extract`` takes out amounts, scale, currency and period; the aliases
are normalised by joins with small alias relations; the unit is the text's
own or else the source's default; the factor is then applied in decimals.

Defined results: null, blank and texts without an amount give no row, nor do
texts whose only number is no pay ("bonus až 15 %", "5 týdnů dovolené", "salary
+ 401k"); extras beside a stated pay are taken out, not the row; an open end is
-1; a scale word after the second amount of a range holds for the first too;
repeated rows give one row each. Pay that cannot be converted (a currency
without a rate, no currency or period in text or source) is no row of
``monthly_pay`` but one of ``unconverted``, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.session import small

# Spellings of currencies, periods and scales.
CURRENCIES = {
    "CZK": ["kč", "kc", "czk", "korun", "koruny", "koruna", "kčs"],
    "EUR": ["eur", "euro", "euros", "eura", "€"],
    "USD": ["us$", "usd", "$", "dollars", "dolarů"],
    "GBP": ["gbp", "£", "pounds", "liber"],
    "PLN": ["pln", "zł", "zl", "zlotých"],
    "CHF": ["chf", "fr.", "sfr", "franků"],
}
PERIODS = {
    "hour": ["/h", "/hod", "/hod.", "/hour", "/hr", "per hour", "an hour", "hourly", "na hodinu", "za hodinu", "hodinově", "hod. sazba", "hodinová sazba", "p.h."],
    "day": ["/md", "/day", "/den", "/d", "per day", "a day", "daily", "na den", "za den", "denně", "man-day", "manday", "md"],
    "week": ["/week", "/wk", "/týden", "/týd.", "per week", "a week", "weekly", "týdně", "na týden", "za týden"],
    "month": ["/mo", "/month", "/měs.", "/měs", "/měsíc", "/ měsíc", "per month", "a month", "monthly", "za měsíc", "na měsíc", "měsíčně", "p.m."],
    "year": ["/yr", "/year", "/rok", "/ rok", "/p.a.", "per year", "a year", "per annum", "annually", "yearly", "za rok", "ročně", "p.a."],
}
SCALES = {
    "1000": ["k", "tis", "tis.", "tisíc", "thousand"],
    "1000000": ["m", "mio", "mil", "mil.", "million", "milion", "milionu", "milionů", "miliony"],
}
OPEN_TOP = r"od|from|min\.?|minimálně|at least|nejméně|alespoň|více než|over|ab|starting at"
OPEN_BOTTOM = r"do|up to|max\.?|maximálně|až|nejvýše|at most|bis|až do"
#: codes and signs of currencies that have no alias above
FOREIGN = (
    "aed|aud|bgn|brl|cad|clp|cny|cop|dkk|egp|gel|hkd|hrk|huf|idr|ils|inr|isk|jpy|krw|kzt|mdl|mxn|myr|nok|nzd|pen|php|pkr|qar|ron|rsd|rub|sar|sek|sgd|thb"
    "|try|twd|uah|vnd|zar|kr|ft|lei|rmb|¥|₹|₽|₴|₩|₺|₪"
)
#: extras that bear numbers of their own: taken out before amounts are read
LEAVE = r"\d+\s*(?:týdn\p{L}*|dn[íyů]|weeks?|days?)\s+(?:dovolen\p{L}*|of\s+(?:leave|vacation|holidays?)|leave|vacation|holidays?)"
SHARE = r"(?:(?:až|up to|do|cca|about|of)\s)?\d+(?:[.,]\d+)?(?:\s?[-–]\s?\d+(?:[.,]\d+)?)?\s?%"
GRADE = r"1[34]\.\s?plat\p{L}*|(?:platov\p{L}*|tarifn\p{L}*)?\s?třída\s?\d*|401\s?\(?k\)?"
EXTRA = r"(?:bonus|odměn|benefit|stravenk|příspěv|allowance|prémi)\p{L}*"

BLANKS = r"(?U)\s+"
AMOUNT = r"(\d{1,3}(?:[ .,'’]\d{3})+(?![\d])(?:[.,]\d{1,2}(?!\d))?|\d+(?:[.,]\d{1,2}(?!\d))?)"


def aliases(spark: SparkSession, table: dict[str, list[str]]) -> DataFrame:
    """(alias, unit): a relation of fixed size."""
    rows = [(a, unit) for unit, names in table.items() for a in names]
    return spark.createDataFrame(rows, "alias string, unit string")


def _any(table: dict[str, list[str]]) -> str:
    """Alternation of all aliases, longest first, blanks flexible."""
    import re

    names = sorted((a for names in table.values() for a in names), key=lambda a: (-len(a), a))
    return "|".join(re.escape(a).replace(r"\ ", r"\s?").replace("/", r"/\s?") for a in names)


def _number(text: Column) -> Column:
    """Decimal of an amount: a mark before exactly three digits groups."""
    plain = F.regexp_replace(text, r"[ .,'’](?=\d{3}(?:\D|$))", "")
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("decimal(20,4)")


SCALE = rf"(?:\s?({_any(SCALES)})(?![\p{{L}}]))?"


def tidy(text: Column) -> Column:
    """A pay text in lower case without brackets, extras and their amounts."""
    t = F.lower(F.trim(F.regexp_replace(text, BLANKS, " ")))
    t = F.regexp_replace(t, r"\([^()]*\)", " ")
    t = F.regexp_replace(t, r"\s\+\s.*$", "")  # extras
    t = F.regexp_replace(t, r",-+", " ")
    # an extra's own amount goes with it, up to the end of its clause
    for gone in (LEAVE, SHARE, GRADE, rf"{EXTRA}[^\d;,]{{0,20}}{AMOUNT}[^;]*?(?=[,;]\s|$)", EXTRA):
        t = F.regexp_replace(t, gone, " ")
    return F.trim(F.regexp_replace(t, r"[\s,;]+$", ""))


def parse(t: Column) -> dict[str, Column]:
    """Parts of a tidy pay text: lo, hi, two scales, side, currency, period."""
    word = r"(?![\p{L}])"
    scale = SCALE
    cur = rf"(?:{_any(CURRENCIES)})"
    one = rf"{AMOUNT}{scale}"
    pair = rf"{one}\s?(?:{cur}{word})?\s?(?:-|–|—|to|až|do|bis|and)\s?(?:{cur})?\s?{one}"
    is_pair = t.rlike(pair)
    pick = lambda k, j: F.when(is_pair, F.regexp_extract(t, pair, k)).otherwise(F.regexp_extract(t, one, j) if j else F.lit(""))
    lead = r"^(?:[^\d]*?[\s:])?"
    side = (
        F.when(is_pair, F.lit("both"))
        .when(t.rlike(rf"{lead}(?:{OPEN_BOTTOM})\s?{cur}?\s?\d"), F.lit("max"))
        .when(t.rlike(rf"{lead}(?:{OPEN_TOP})\s?{cur}?\s?\d") | t.rlike(r"\d\s?\+\s?$"), F.lit("min"))
        .otherwise(F.lit("both"))
    )
    return {
        "lo_text": pick(1, 1),
        "lo_scale": pick(2, 2),
        "hi_text": pick(3, 0),
        "hi_scale": pick(4, 0),
        "side": side,
        # a currency sign may touch the figures, a word may not go on
        "currency": F.regexp_extract(t, rf"(?<![\p{{L}}])({_any(CURRENCIES)}){word}|([€$£])", 0),
        "period": F.regexp_replace(F.regexp_extract(t, rf"((?:(?<![\p{{L}}])|(?=/))(?:{_any(PERIODS)})){word}", 1), r"/\s", "/"),
        "foreign": t.rlike(rf"(?<![\p{{L}}])(?:{FOREIGN})\s?\d|\d{scale}\s?(?:{FOREIGN}){word}"),
        "stated": t.rlike(r"\d"),
    }


def _converted(df: DataFrame, defaults: DataFrame, rates: DataFrame, units: DataFrame, text: str, ident: str, row_id: str) -> DataFrame:
    """Every row that states an amount: its bounds in CZK a month, or the reason
    why there are none."""
    spark = df.sparkSession
    # exploded, so that the tidy text and its parts are computed once each
    texts = df.where(F.col(f"`{text}`").rlike(r"\d")).select(
        F.col(f"`{row_id}`").alias("row_id"), F.regexp_extract(F.col(f"`{ident}`"), r"^([A-Za-z]+)", 1).alias("prefix"), F.explode(F.array(tidy(F.col(f"`{text}`")))).alias("t")
    )
    parts = texts.select(
        "row_id", "prefix", F.explode(F.array(F.struct(*(c.alias(k) for k, c in parse(F.col("t")).items())))).alias("p")
    ).select("row_id", "prefix", "p.*").where(F.col("stated") & (F.col("lo_text") != ""))
    # the alias lists are constants above
    alias = lambda table, key, name: F.broadcast(aliases(spark, table).select(F.col("alias").alias(key), F.col("unit").alias(name)))
    d = defaults.groupBy(F.col("id_prefix").alias("prefix")).agg(F.min("currency").alias("d_cur"), F.min("pay_unit").alias("d_unit"))
    r = rates.groupBy(F.col("currency").alias("cur")).agg(F.min("czk").alias("czk"))
    u = units.groupBy("unit").agg(F.min("month_num").alias("month_num"), F.min("month_den").alias("month_den"))
    joined = (
        parts.join(alias(CURRENCIES, "currency", "t_cur"), "currency", "left")
        .join(alias(PERIODS, "period", "t_unit"), "period", "left")
        .join(alias(SCALES, "lo_scale", "lo_x"), "lo_scale", "left")
        .join(alias(SCALES, "hi_scale", "hi_x"), "hi_scale", "left")
        .join(small(d), "prefix", "left")
        .withColumn("cur", F.coalesce("t_cur", F.when(~F.col("foreign"), F.col("d_cur"))))
        .withColumn("unit", F.coalesce("t_unit", "d_unit"))
        .join(small(r), "cur", "left")
        .join(small(u), "unit", "left")
    )
    lo, hi = _number(F.col("lo_text")), _number(F.col("hi_text"))
    lo_x, hi_x = F.col("lo_x").cast("decimal(8,0)"), F.col("hi_x").cast("decimal(8,0)")
    one = F.lit(1).cast("decimal(8,0)")
    shared = F.when(F.col("lo_scale") == "", F.when(lo <= hi, hi_x)).otherwise(lo_x)
    factor = lambda amount, scale: F.round(
        (amount * F.coalesce(scale, one)).cast("decimal(18,2)") * F.col("czk").cast("decimal(9,4)") * F.col("month_num").cast("decimal(4,0)") / F.col("month_den").cast("decimal(4,0)"), 0
    ).cast("long")
    low = factor(lo, shared)
    high = F.when(F.col("hi_text") != "", factor(hi, hi_x)).otherwise(low)
    reason = (
        F.when(F.col("t_cur").isNull() & F.col("foreign"), "currency unknown").when(F.col("cur").isNull(), "no currency").when(F.col("czk").isNull(), "no rate")
        .when(F.col("month_num").isNull() | F.col("month_den").isNull(), "no period")
    )
    return joined.where(lo.isNotNull()).select(
        "row_id",
        F.when(F.col("side") == "max", F.lit(-1).cast("long")).otherwise(low).alias("low_czk"),
        F.when(F.col("side") == "min", F.lit(-1).cast("long")).otherwise(high).alias("high_czk"),
        reason.alias("reason"),
    )


def monthly_pay(df: DataFrame, defaults: DataFrame, rates: DataFrame, units: DataFrame, text: str = "Salary", ident: str = "ID", row_id: str = "row_id") -> DataFrame:
    """(row_id, low_czk, high_czk) of every row whose text states pay."""
    return _converted(df, defaults, rates, units, text, ident, row_id).where(F.col("reason").isNull()).drop("reason")


def unconverted(df: DataFrame, defaults: DataFrame, rates: DataFrame, units: DataFrame, text: str = "Salary", ident: str = "ID", row_id: str = "row_id") -> DataFrame:
    """(row_id, reason) of every row that states an amount which cannot be converted."""
    return _converted(df, defaults, rates, units, text, ident, row_id).where(F.col("reason").isNotNull()).select("row_id", "reason")
