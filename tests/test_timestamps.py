from datetime import datetime, timedelta, timezone
from itertools import product
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.operators import timestamps as ts

SCHEMA = "row_id long, Source string, A string, extra string"
DEFAULTS = [("jb", "Europe/Prague", "day_first"), ("blt", "America/New_York", "month_first")]


def _run(spark, rows, **kw):
    df = spark.createDataFrame([(i, s, v, "x") for i, (s, v) in enumerate(rows)], SCHEMA)
    d = spark.createDataFrame(DEFAULTS, "source string, zone string, date_order string")
    return {r["row_id"]: r["utc_us"] for r in ts.normalise(df, d, ["A"], **kw).collect()}


def _us(*parts, zone="UTC", fold=0):
    t = datetime(*parts, tzinfo=ZoneInfo(zone), fold=fold)
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def test_formats_zones_and_gaps(spark):
    cases = [
        ("jb", "2025-09-02T01:09:32+02:00", _us(2025, 9, 1, 23, 9, 32)),
        ("jb", "2025-09-02T20:12:35", _us(2025, 9, 2, 18, 12, 35)),
        ("jb", " 2025-09-04 00:34:54\xa0", _us(2025, 9, 3, 22, 34, 54)),
        ("jb", "20250902T145709Z", _us(2025, 9, 2, 14, 57, 9)),
        ("jb", "2025-10-01T01:34:20,332630282+02:00", _us(2025, 9, 30, 23, 34, 20, 332630)),
        ("blt", "2025-09-16T08:43:57[America/New_York]", _us(2025, 9, 16, 12, 43, 57)),
        ("jb", "2025-09-05 10:18:36 CEST", _us(2025, 9, 5, 8, 18, 36)),
        ("jb", "29.3.2026, 01.13 hod.", _us(2026, 3, 29, 0, 13)),
        ("jb", "23. července 2026 02:30", _us(2026, 7, 23, 0, 30)),
        ("jb", "january 22, 2026 8:42 am", _us(2026, 1, 22, 7, 42)),
        ("jb", "12/05/2025", _us(2025, 5, 11, 22)),
        ("blt", "12/05/2025", _us(2025, 12, 5, 5)),
        ("jb", "Thu, 17 Sep 2026 20:25:39 +0200", _us(2026, 9, 17, 18, 25, 39)),
        ("jb", "1749982359", 1749982359 * 10**6),
        ("jb", "1746573461947", 1746573461947 * 1000),
        ("jb", "2026-03-29T02:30:00", _us(2026, 3, 29, 1, 30)),  # skipped: one hour on
        ("jb", "2025-10-26T02:30:00", _us(2025, 10, 26, 0, 30)),  # twice: the first
    ]
    assert _run(spark, [(s, v) for s, v, _ in cases]) == {i: u for i, (_, _, u) in enumerate(cases)}


def test_no_instants(spark):
    rows = [("jb", v) for v in (None, "", "  ", "včera", "31.02.2025", "2025-13-03", "0000-00-00", "N/A", "Posted 3 days ago", "x" * 5000)]
    assert _run(spark, rows) == {}


def test_empty_table(spark):
    assert _run(spark, []) == {}


def _cheapest(rows):
    best = min(
        product(*(range(len(r)) for r in rows)),
        key=lambda p: (sum(rows[i][k][2] for i, k in enumerate(p)) + sum(ts._step(rows[i][p[i]], rows[i + 1][p[i + 1]]) for i in range(len(rows) - 1))),
    )
    return sum(rows[i][k][2] for i, k in enumerate(best)) + sum(ts._step(rows[i][best[i]], rows[i + 1][best[i + 1]]) for i in range(len(rows) - 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 4), st.sampled_from([0.0, 0.5])), min_size=1, max_size=2), min_size=1, max_size=6))
def test_viterbi_equals_enumeration(rows):
    path = ts.viterbi(rows)
    cost = sum(rows[i][k][2] for i, k in enumerate(path)) + sum(ts._step(rows[i][path[i]], rows[i + 1][path[i + 1]]) for i in range(len(rows) - 1))
    assert abs(cost - _cheapest(rows)) < 1e-9


def test_blocks_equal_one_pass(spark):
    # an unknown source leaves the order of slashed dates to the sequence
    rows = [("?", f"{d:02d}/{m:02d}/2025") for m, d in [(1, 2), (1, 13), (2, 3), (3, 1), (3, 20), (4, 5), (5, 6), (6, 30), (7, 8), (8, 7)]]
    assert _run(spark, rows, block=3) == _run(spark, rows, block=1000)


def test_unknown_order_follows_the_sequence(spark):
    rows = [("?", "13/01/2025"), ("?", "02/02/2025"), ("?", "03/02/2025"), ("?", "14/02/2025")]
    got = _run(spark, rows)
    assert got[2] == _us(2025, 2, 3)


def test_zones_offsets_and_further_forms(spark):
    cases = [
        ("jb", "2025-03-01T10:00:00[America/Sao_Paulo]", _us(2025, 3, 1, 13)), ("jb", "2025-03-01T10:00:00[Etc/UTC]", _us(2025, 3, 1, 10)), ("jb", "2025-03-01T10:00:00[etc/gmt+3]", _us(2025, 3, 1, 13)),
        ("jb", "2025-03-01T10:00:00-03:00[America/Sao_Paulo]", _us(2025, 3, 1, 13)), ("jb", "2025-03-01T10:00:00+01", _us(2025, 3, 1, 9)), ("jb", "2025-03-01 10:00 UTC+2", _us(2025, 3, 1, 8)),
        ("jb", "20250301100000", _us(2025, 3, 1, 9)), ("jb", "20250301T100000.25Z", _us(2025, 3, 1, 10, 0, 0, 250000)), ("jb", "2025-W10-3", _us(2025, 3, 4, 23)), ("jb", "2020-W53-5T12:00Z", _us(2021, 1, 1, 12)),
        ("jb", "2024-366", _us(2024, 12, 30, 23)),
    ]
    assert _run(spark, [(s, v) for s, v, _ in cases]) == {i: u for i, (_, _, u) in enumerate(cases)}
    assert _run(spark, [("jb", v) for v in ("2025-03-01T10:00:00[Mars/Base]", "2025-W53-1", "2025-W00-1", "2025-366", "2025-W10-8", "20250301250000")]) == {}


def test_unknown_zone_of_a_source_is_utc(spark):
    df = spark.createDataFrame([(1, "x", "2025-03-01 10:00", "c")], SCHEMA)
    d = spark.createDataFrame([("x", "No/Where", None)], "source string, zone string, date_order string")
    assert [r["utc_us"] for r in ts.normalise(df, d, ["A"]).collect()] == [_us(2025, 3, 1, 10)]


def test_tree_of_blocks_equals_one_pass(spark):
    import random

    rng = random.Random(6)
    rows = [("?", f"{rng.randint(1, 12):02d}/{rng.randint(1, 14):02d}/2025") for _ in range(60)]
    whole = _run(spark, rows)
    df = spark.createDataFrame([(i * 10**15, s, v, "x") for i, (s, v) in enumerate(rows)], SCHEMA)  # sparse ids
    d = spark.createDataFrame(DEFAULTS, "source string, zone string, date_order string")
    got = {r["row_id"] // 10**15: r["utc_us"] for r in ts.normalise(df, d, ["A"], block=4, fan=3).collect()}
    assert set(got) == set(whole)
    reads = [[("d", whole_us, 0.0) for whole_us in sorted({_us(2025, int(b), int(a)) if int(b) <= 12 else None, _us(2025, int(a), int(b)) if int(a) <= 12 else None} - {None})] for a, b, _ in (v.split("/") for _, v in rows)]
    assert all(got[i] in [c[1] for c in reads[i]] for i in got)
    back = lambda x: sum(x[i] < x[i - 1] for i in range(1, len(rows)))
    day = lambda x: [_us(2025, int(b), int(a)) == x[i] if int(b) <= 12 else False for i, (a, b, _) in enumerate(v.split("/") for _, v in rows)]
    switches = lambda x: sum(p != q for p, q in zip(day(x), day(x)[1:]))
    assert back(got) + switches(got) == back(whole) + switches(whole)
