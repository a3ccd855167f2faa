"""Mixed timestamp formats and zones to one UTC instant.

Each value gets an array of all valid interpretations (format, instant,
penalty), built from JVM expressions. Per source and field, the reading is then
chosen by Viterbi over the record order, with costs for switching the format
and for jumping back in time. The Viterbi is distributed as a tree: every block
of about ``BLOCK`` rows is reduced to a min-plus matrix between its first and
last states, every ``FAN`` blocks to one matrix again, the short chain of these
is solved per source and field, and then blocks and rows are resolved between
fixed states. The result equals one Viterbi pass over the whole sequence, for
any run of ambiguous values.

Defined results: null, blank, relative ("3 days ago") or impossible values
("31.02.2025", week 53 of a short year) give no row, nor do unknown zone names;
zone names are read whatever their case; repeated rows give one row each; an
unknown source, or one whose zone is unknown, has UTC as zone, and both orders
of a slashed date are then equally likely and left to the Viterbi; a declared
date_order outweighs any sequence cost.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.session import small

BLOCK = 65_536
#: blocks that are folded into one
FAN = 1_024
SWITCH_COST = 1.0
BACKWARD_COST = 1.0
#: a reading against the source's declared order costs more than any path saves
AGAINST_RULE = 1_000.0

# Month names and abbreviations.
MONTHS = {
    1: "january jan ledna leden januar jänner janvier",
    2: "february feb února únor februar février",
    3: "march mar března březen märz mars",
    4: "april apr dubna duben avril",
    5: "may května květen mai",
    6: "june jun června červen juni juin",
    7: "july jul července červenec juli juillet",
    8: "august aug srpna srpen août",
    9: "september sep sept září septembre",
    10: "october oct října říjen oktober octobre",
    11: "november nov listopadu listopad novembre",
    12: "december dec prosince prosinec dezember décembre",
}
# Zone abbreviations, seconds east of UTC.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 3600, "west": 3600, "cet": 3600, "cest": 7200, "eet": 7200, "eest": 10800,
    "est": -18000, "edt": -14400, "cst": -21600, "cdt": -18000, "mst": -25200, "mdt": -21600, "pst": -28800, "pdt": -25200,
}

#: an offset may be followed by its region, which then says nothing more
ZONE = r"(?:(z|[a-z]{3,4}|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?(?=\[|$)|\[[a-z][\w+\-/]*\])(?:\[[a-z][\w+\-/]*\])?)"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
#: name -> (pattern, group numbers of year, month, day, hour, minute, second, fraction, half day, zone)
FORMATS = {
    "iso": (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[t ]\s*{CLOCK}\s*{ZONE}?)?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "compact": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:t?(\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d+))?)?\s*{ZONE}?)?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "week": (rf"^(\d{{4}})-?(w\d{{2}})-?(\d)(?:[t ]\s*{CLOCK}\s*{ZONE}?)?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "ordinal": (rf"^(\d{{4}})(-)(\d{{3}})(?:[t ]\s*{CLOCK}\s*{ZONE}?)?$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    "dotted": (r"^(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})(?:,?\s*(?:v\s+|um\s+)?(\d{1,2})[:.](\d{2})(?::(\d{2}))?(?:\s*(?:hod\.?|h|uhr))?)?$", (3, 2, 1, 4, 5, 6, 0, 0, 0)),
    "slash_day": (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{CLOCK}\s*(am|pm)?\s*{ZONE}?)?$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "slash_month": (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:,?\s+{CLOCK}\s*(am|pm)?\s*{ZONE}?)?$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "named_day": (rf"^(?:\p{{L}}{{2,9}}\.?,\s*)?(\d{{1,2}})\.?\s+(\p{{L}}+)\.?,?\s+(\d{{4}})(?:,?\s+(?:v\s+|at\s+|um\s+)?{CLOCK}\s*{ZONE}?)?$", (3, 2, 1, 4, 5, 6, 7, 0, 8)),
    "named_month": (rf"^(\p{{L}}+)\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{CLOCK}\s*(am|pm)?\s*{ZONE}?)?$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
}
EPOCHS = {"epoch_s": (10, 1_000_000), "epoch_ms": (13, 1_000), "epoch_us": (16, 1)}


def _map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def zones(spark: SparkSession) -> Column:
    """Map from a zone's name in lower case to the name itself, of every zone
    that the JVM knows; a constant of some six hundred entries."""
    jvm = spark._jvm.java
    names = sorted(jvm.lang.String.join(",", jvm.time.ZoneId.getAvailableZoneIds()).split(","))
    known = {n.lower(): n for n in names}
    return F.map_from_arrays(F.split(F.lit(",".join(known)), ","), F.split(F.lit(",".join(known.values())), ","))


def _instant(parts: Column, zone: Column, known: Column) -> Column:
    """UTC microseconds of the parts of one reading; null where they name none."""
    part = lambda k: F.element_at(parts, k + 1)
    number = lambda k: F.coalesce(part(k).try_cast("int"), F.lit(0))
    year, day = number(0), number(2)
    in_week, in_year = part(1).startswith("w"), part(1) == "-"
    month = F.coalesce(
        part(1).try_cast("int"), F.when(in_week | in_year, 1), F.try_element_at(_map({n: k for k, names in MONTHS.items() for n in names.split()}), part(1)), F.lit(0)
    )
    half, z = part(7), part(8)
    hour = F.when(half == "pm", number(3) % 12 + 12).when(half == "am", number(3) % 12).otherwise(number(3))
    minute, second = number(4), number(5)
    micros = F.when(part(6) != "", F.rpad(F.substring(part(6), 1, 6), 6, "0").try_cast("long")).otherwise(F.lit(0))
    first = F.make_date(year, month, F.lit(1))
    # the Monday of the first week is that of the fourth of January
    week = F.substring(part(1), 2, 2).try_cast("int")
    monday = lambda y: F.trunc(F.make_date(y, F.lit(1), F.lit(4)), "week")
    base = F.when(in_week, F.date_add(monday(year), (week - 1) * 7)).otherwise(first)
    last = F.when(in_week, 7).when(in_year, F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))).otherwise(F.day(F.last_day(first)))
    whole_week = ~in_week | (week >= 1) & (base < monday(year + 1))
    local = (F.unix_date(base) + day - 1).cast("long") * 86_400_000_000 + (hour.cast("long") * 3600 + minute * 60 + second) * 1_000_000 + micros
    sign = F.when(F.regexp_extract(z, r"([+-])\d", 1) == "-", -1).otherwise(1)
    ahead = F.regexp_extract(z, r"[+-](\d{1,2})", 1).try_cast("long") * 3600 + F.coalesce(F.regexp_extract(z, r"[+-]\d{2}:?(\d{2})$", 1).try_cast("long"), F.lit(0)) * 60
    offset = F.when(z.rlike(r"\d"), sign * ahead).otherwise(F.try_element_at(_map(ABBREVIATIONS), z).cast("long"))
    named = F.try_element_at(known, F.substring(z, F.lit(2), F.length(z) - 2))
    at = lambda place: F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), place))
    utc = F.when(z == "", at(zone)).when(z.startswith("["), F.when(named.isNotNull(), at(named))).otherwise(local - offset * 1_000_000)
    clock_ok = (hour < 24) & (minute < 60) & (second < 60) & ((half == "") | number(3).between(1, 12))
    return F.when(year.between(1900, 2200) & month.between(1, 12), F.when((day >= 1) & (day <= last) & whole_week & clock_ok, utc))


def interpretations(value: Column, zone: Column, date_order: Column, known: Column) -> Column:
    """The array of struct(fmt, utc_us, penalty) of every valid reading of
    ``value``, itself in an array that is empty where there is none."""
    v = F.lower(F.regexp_replace(F.regexp_replace(value, r"(?U)\s+", " "), "^ | $", ""))
    shaped = []
    for name, (pattern, groups) in FORMATS.items():
        penalty = F.lit(0.0)
        if name.startswith("slash"):
            other = "month_first" if name == "slash_day" else "day_first"
            penalty = F.when(date_order == other, F.lit(AGAINST_RULE)).otherwise(F.lit(0.0))
        parts = F.split(F.regexp_replace(v, pattern, "|".join(f"${g}" if g else "" for g in groups)), r"\|", -1)
        shaped.append(F.when(v.rlike(pattern), F.struct(F.lit(name).alias("fmt"), parts.alias("parts"), F.lit(None).cast("long").alias("epoch"), penalty.alias("penalty"))))
    for name, (digits, factor) in EPOCHS.items():
        shaped.append(
            F.when(v.rlike(rf"^\d{{{digits}}}$"), F.struct(F.lit(name).alias("fmt"), F.lit(None).cast("array<string>").alias("parts"), (v.try_cast("long") * factor).alias("epoch"), F.lit(0.0).alias("penalty")))
        )
    read = F.transform(
        F.array_compact(F.array(*shaped)),
        lambda c: F.struct(c["fmt"].alias("fmt"), F.when(c["parts"].isNull(), c["epoch"]).otherwise(_instant(c["parts"], zone, known)).alias("utc_us"), c["penalty"].alias("penalty")),
    )
    found = F.filter(read, lambda c: c["utc_us"].isNotNull())
    # a slashed date follows the declared order or names nothing
    return F.filter(F.array(found), lambda xs: F.exists(xs, lambda c: c["penalty"] == 0))


Candidate = tuple[str, int, float]


def _step(a: Candidate, b: Candidate) -> float:
    return (SWITCH_COST if a[0] != b[0] else 0.0) + (BACKWARD_COST if b[1] < a[1] else 0.0)


def viterbi(rows: list[list[Candidate]], before: Candidate | None = None, last: int | None = None) -> list[int]:
    """Cheapest choice per row; ``before`` is the state ahead of the first row,
    ``last`` fixes the state of the last one. Ties go to the first candidate."""
    cost = [c[2] + (_step(before, c) if before else 0.0) for c in rows[0]]
    back: list[list[int] | None] = [None]
    for prev, row in zip(rows, rows[1:]):
        if len(prev) == 1:
            back.append(None)
            cost = [cost[0] + _step(prev[0], c) + c[2] for c in row]
            continue
        links, new = [], []
        for c in row:
            k = min(range(len(prev)), key=lambda i: (cost[i] + _step(prev[i], c), i))
            links.append(k)
            new.append(cost[k] + _step(prev[k], c) + c[2])
        back.append(links)
        cost = new
    k = min(range(len(cost)), key=lambda i: (cost[i], i)) if last is None else last
    out = [k]
    for links in reversed(back[1:]):
        k = links[k] if links else 0
        out.append(k)
    return out[::-1]


def block_matrix(rows: list[list[Candidate]]) -> list[list[float]]:
    """Min-plus costs from each first state to each last state of a block."""
    out = []
    for k, start in enumerate(rows[0]):
        cost = [c[2] if i == k else float("inf") for i, c in enumerate(rows[0])]
        for prev, row in zip(rows, rows[1:]):
            cost = [min(cost[i] + _step(p, c) for i, p in enumerate(prev)) + c[2] for c in row]
        out.append(cost)
    return out


def _candidates(cells) -> list[list[Candidate]]:
    return [[(c["fmt"], int(c["utc_us"]), float(c["penalty"])) for c in cell] for cell in cells]


def _state(c: Candidate) -> dict:
    return dict(zip(("fmt", "utc_us", "penalty"), c))


def _summarise(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block's first and last states and the costs between them."""
    pdf = pdf.sort_values("row_id")
    rows = _candidates(pdf["reads"])
    matrix = block_matrix(rows)
    head = pdf.iloc[0]
    ends = [[_state(c) for c in row] for row in (rows[0], rows[-1])]
    return pd.DataFrame({"source": [head["source"]], "field": [head["field"]], "block": [head["block"]], "first": [ends[0]], "last": [ends[1]], "costs": [[x for row in matrix for x in row]]})


class _Blocks:
    """A sequence of block summaries in order."""

    def __init__(self, pdf: pd.DataFrame):
        self.firsts, self.lasts = _candidates(pdf["first"]), _candidates(pdf["last"])
        self.costs = [list(c) for c in pdf["costs"]]

    def within(self, n: int, i: int, j: int) -> float:
        """Cost inside block n from its first state i to its last state j."""
        return self.costs[n][i * len(self.lasts[n]) + j]

    def on(self, n: int, before: Candidate, j: int) -> float:
        """Cost from a state ahead of block n to its last state j."""
        return min(_step(before, f) + self.within(n, i, j) for i, f in enumerate(self.firsts[n]))

    def run(self, start: list[float]) -> tuple[list[float], list[list[int]]]:
        """Costs of the last block's last states, given those of the first
        block's, and the links back."""
        cost, back = start, [[]]
        for n in range(1, len(self.costs)):
            new, links = [], []
            for j in range(len(self.lasts[n])):
                best = min((cost[p] + self.on(n, c, j), p) for p, c in enumerate(self.lasts[n - 1]))
                new.append(best[0])
                links.append(best[1])
            cost = new
            back.append(links)
        return cost, back


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """The blocks of a group as one: the min-plus product of their matrices."""
    pdf = pdf.sort_values("block").reset_index(drop=True)
    b = _Blocks(pdf)
    costs = []
    for i in range(len(b.firsts[0])):
        costs += b.run([b.within(0, i, j) for j in range(len(b.lasts[0]))])[0]
    head = pdf.iloc[0]
    return pd.DataFrame({"source": [head["source"]], "field": [head["field"]], "block": [head["group"]], "first": [pdf["first"].iloc[0]], "last": [pdf["last"].iloc[-1]], "costs": [costs]})


def _solve(pdf: pd.DataFrame, before: Candidate | None, pick: int | None) -> pd.DataFrame:
    """For each block of a chain the state ahead of it and the index of its last
    state, between a state ahead of the chain and the chain's last one."""
    pdf = pdf.sort_values("block").reset_index(drop=True)
    b = _Blocks(pdf)
    ends = range(len(b.lasts[0]))
    start = [b.on(0, before, j) for j in ends] if before else [min(b.within(0, i, j) for i in range(len(b.firsts[0]))) for j in ends]
    cost, back = b.run(start)
    k = min(range(len(cost)), key=lambda i: (cost[i], i)) if pick is None else pick
    picks = [k]
    for links in reversed(back[1:]):
        k = links[k]
        picks.append(k)
    picks.reverse()
    ahead = [before, *(b.lasts[n][picks[n]] for n in range(len(pdf) - 1))]
    return pd.DataFrame({"source": pdf["source"], "field": pdf["field"], "block": pdf["block"], "before": [_state(c) if c else None for c in ahead], "pick": picks})


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    return _solve(pdf, None, None)


def _fixed(fixed: pd.DataFrame) -> tuple[Candidate | None, int]:
    b = fixed["before"].iloc[0]
    return (b["fmt"], int(b["utc_us"]), float(b["penalty"])) if b is not None else None, int(fixed["pick"].iloc[0])


def _unfold(blocks: pd.DataFrame, fixed: pd.DataFrame) -> pd.DataFrame:
    if not len(blocks):
        return pd.DataFrame({"source": [], "field": [], "block": [], "before": [], "pick": []})
    return _solve(blocks.drop(columns="group"), *_fixed(fixed))


def _resolve(rows: pd.DataFrame, fixed: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"row_id": [], "field": [], "utc_us": [], "fmt": []})
    rows = rows.sort_values("row_id")
    reads = _candidates(rows["reads"])
    path = viterbi(reads, *_fixed(fixed))
    chosen = [r[k] for r, k in zip(reads, path)]
    return pd.DataFrame({"row_id": rows["row_id"].to_numpy(), "field": rows["field"].to_numpy(), "utc_us": [c[1] for c in chosen], "fmt": [c[0] for c in chosen]})


STATE = "struct<fmt:string,utc_us:bigint,penalty:double>"
SUMMARY = f"source string, field string, block bigint, first array<{STATE}>, last array<{STATE}>, costs array<double>"
PICKS = f"source string, field string, block bigint, before {STATE}, pick int"


def _width(df: DataFrame, row_id: str, block: int) -> int:
    """Span of row ids that holds about ``block`` rows, if ids are sparse."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.min(f"`{row_id}`").alias("lo"), F.max(f"`{row_id}`").alias("hi")).first()
    return max(block, (n["hi"] - n["lo"] + 1) * block // n["n"]) if n["n"] and n["hi"] is not None else block


def normalise(df: DataFrame, defaults: DataFrame, fields: list[str], source: str = "Source", row_id: str = "row_id", block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(row_id, field, utc_us, fmt) of every value that names an instant or day."""
    known = zones(df.sparkSession)
    zone = F.coalesce(F.try_element_at(known, F.lower("zone")), F.lit("UTC"))
    d = defaults.groupBy(F.col("source").alias("_src")).agg(F.min(zone).alias("_zone"), F.min("date_order").alias("_order"))
    cells = df.select(
        F.col(f"`{row_id}`").alias("row_id"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source"),
        F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields))).alias("c"),
    ).select("row_id", "source", "c.field", "c.value")
    read = (
        cells.where(F.col("value").isNotNull())
        .join(small(d), F.col("source") == F.col("_src"), "left")
        # exploded, so that the expression is evaluated once and not again in a filter
        .select("row_id", "source", "field", F.explode(interpretations(F.col("value"), F.coalesce(F.col("_zone"), F.lit("UTC")), F.coalesce(F.col("_order"), F.lit("unknown")), known)).alias("reads"))
        .withColumn("block", F.floor(F.col("row_id") / _width(df, row_id, block)).cast("long"))
    )
    keys, up = ["source", "field", "block"], ["source", "field", "group"]
    summary = read.groupBy(*keys).applyInPandas(_summarise, SUMMARY)
    grouped = summary.withColumn("group", F.floor(F.col("block") / fan).cast("long"))
    folded = grouped.groupBy(*up).applyInPandas(_fold, SUMMARY)
    chain = folded.groupBy("source", "field").applyInPandas(_chain, PICKS)
    picks = grouped.groupBy(*up).cogroup(chain.withColumnRenamed("block", "group").groupBy(*up)).applyInPandas(_unfold, PICKS)
    return (
        read.groupBy(*keys)
        .cogroup(picks.groupBy(*keys))
        .applyInPandas(_resolve, "row_id bigint, field string, utc_us bigint, fmt string")
    )
