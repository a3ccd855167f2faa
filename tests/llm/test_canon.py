from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import canon

ENTRIES = [("Job.Title", 1, "Data Analyst", "Datový analytik"), ("Job.Title", 30, "Quality Assurance Lead", "Vedoucí zajištění kvality"), ("Job.Title", 23, "Security Auditor", "Auditor bezpečnosti"), ("Job.Title", 31, "Data Engineer", None)]


def _run(spark, values):
    df = spark.createDataFrame([(i, v, 0, "Praha") for i, v in enumerate(values)], "row_id long, `Job.Title` string, entry_id int, Location string")
    e = spark.createDataFrame(ENTRIES, "field string, entry_id long, name string, name_cs string")
    return {r["row_id"]: r["entry_id"] for r in canon.map_values(df, e, ["Job.Title"]).collect()}


def test_values(spark):
    values = ["Data Analyst", "data_analyst", "Senior Datový anlytik (m/ž)", "Analyst, Data, 0.8 úvazku", "QA Lead – Praha", "Senion Quality Assurance Lead", "hybrid, Security Auditro /", "Data Eng.", "Barista", "???", None, " ", "\xa0", "Data Analyst", "x" * 3000]
    assert _run(spark, values) == {1: 1, 2: 1, 3: 1, 4: 30, 5: 30, 6: 23, 7: 31, 8: 0, 9: 0, 14: 0}
    assert _run(spark, []) == {}


def _distance(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=5), st.text("abc", max_size=7), st.integers(0, 3))
def test_automaton_equals_brute_force(names, word, k):
    trie = canon.Trie([(i, n) for i, n in enumerate(names)])
    want = sorted((_distance(word, canon.fold(n)), i) for i, n in enumerate(names) if _distance(word, canon.fold(n)) <= k)
    assert trie.search(word, k) == want


def test_places_are_read_from_the_table(spark):
    values = ["Data Analyst Teplice", "Datový analytik Hradec Králové", "Teplice", "Barista Teplice", "Data Analyst Dolní Lhota", "Data Analyst Tepilce"]
    df = spark.createDataFrame([(i, v, p) for i, (v, p) in enumerate(zip(values, ["Teplice", "Hradec Králové", "Data", None, "", "x"]))], "row_id long, `Job.Title` string, Location string")
    e = spark.createDataFrame(ENTRIES, "field string, entry_id long, name string, name_cs string")
    assert {r["row_id"]: r["entry_id"] for r in canon.map_values(df, e, ["Job.Title"]).collect()} == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 1}


def test_growing_distance_gives_the_nearest():
    trie = canon.Trie([(i, n, None) for i, n in enumerate(["data analyst", "data catalyst", "date analyst", "day analyst"])])
    for word in ("dta analyst", "date analyts", "dat catalist", "xyz", "daa analyst"):
        forms = canon.forms(word)
        want = min((hit for f in forms for hit in trie.search(f, canon.reach(len(f)))), default=(0, 0))[1]
        assert canon.best_entry(trie, word) == want
