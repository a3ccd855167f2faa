import json
from datetime import datetime

from adloom.operators import drift

SCHEMA = "file_id long, feed string, family string, file_name string, written_at timestamp, arrived_at timestamp, line_no int, record string"


def _files(spark, files):
    rows = []
    for fid, (day, lines) in enumerate(files, 1):
        for n, rec in enumerate(lines, 1):
            text = rec if rec is None or isinstance(rec, str) else json.dumps(rec)
            rows.append((fid, "f", "evaluation", f"{fid}.csv", datetime(2025, 1, day), datetime(2025, 1, 28), n, text))
    return spark.createDataFrame(rows, SCHEMA)


def _lines(n, **headers):
    """Adverts with id, title and grade under the given headers."""
    make = {"id": lambda k: f"JB_{1000 + k}", "title": lambda k: f"Title number {k}", "grade": lambda k: str(k % 4)}
    return [{headers.get(k, k): f(i) for k, f in make.items() if headers.get(k, k)} for i in range(n)]


def _changes(df):
    return sorted((r["file_id"], r["change"], r["column_name"]) for r in drift.changes(df).collect())


def test_kinds_of_change(spark):
    files = [
        (1, _lines(9)),
        (2, _lines(9, title="Job Title ")),
        (4, [r | {"Open": True} for r in _lines(9, title="Job Title ", grade=None)]),
        (3, [{**r, "grade": int(r["grade"])} for r in _lines(9, title="Job Title ")]),
    ]
    assert _changes(_files(spark, files)) == [(2, "renamed", "Job Title "), (3, "added", "Open"), (3, "removed", "grade"), (4, "retyped", "grade")]


def test_nulls_broken_lines_and_repeats(spark):
    files = [(1, [*_lines(5), None, "{broken", _lines(1)[0]]), (2, _lines(5))]
    assert _changes(_files(spark, files)) == []


def test_empty(spark):
    assert _changes(spark.createDataFrame([], SCHEMA)) == []


def test_unified(spark):
    files = [(1, _lines(6)), (2, _lines(6, title="Job.Title")), (3, [{**r, "grade": int(r["grade"])} for r in _lines(6, title="Job.Title")])]
    df = drift.unify(_files(spark, files), "evaluation")
    rows = df.collect()
    assert sorted(df.columns) == ["Job.Title", "file_id", "grade", "id", "line_no"]
    assert all(r["Job.Title"] for r in rows) and len(rows) == 18 and dict(df.dtypes)["grade"] == "string"


def test_lattice():
    assert drift.promote(None, "number") == "number"
    assert drift.promote("boolean", "number") == "string"
    assert drift.promote("string", "array") == "array"
    assert drift.promote("object", "number") == "string"
    for a in drift.LATTICE[1:]:
        assert drift.promote(a, a) == a
        for b in drift.LATTICE[1:]:
            assert drift.promote(a, b) == drift.promote(b, a)


def test_values_that_are_common_in_a_file(spark):
    # each line stands three times, and one advert fills most of the file
    often = lambda lines: [r for r in lines for _ in range(3)] + [lines[0]] * 30
    files = [(1, often(_lines(6))), (2, often(_lines(6, title="Role", grade="Mark")))]
    assert _changes(_files(spark, files)) == [(2, "renamed", "Mark"), (2, "renamed", "Role")]


def test_key_renamed_too(spark):
    files = [(1, _lines(8)), (2, _lines(8, id="Advert", title="Role"))]
    assert _changes(_files(spark, files)) == [(2, "renamed", "Advert"), (2, "renamed", "Role")]


def test_other_content_is_no_rename(spark):
    files = [(1, _lines(8)), (2, [{**{k: v for k, v in r.items() if k != "title"}, "pay": f"{n} 000"} for n, r in enumerate(_lines(8))])]
    assert _changes(_files(spark, files)) == [(2, "added", "pay"), (2, "removed", "title")]


def test_nothing_that_grows_is_broadcast(spark, tmp_path, monkeypatch):
    # a small file looks small to the planner; its lines are many in a large one
    _files(spark, [(1, _lines(9)), (2, _lines(9, title="Role"))]).write.parquet(str(tmp_path / "records"))
    plans, cut = [], drift.cut

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(drift, "cut", kept)
    out = drift.changes(spark.read.parquet(str(tmp_path / "records")))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [(r["file_id"], r["change"], r["column_name"]) for r in out.collect()] == [(2, "renamed", "Role")]
    assert len(plans) > 3 and not any("BroadcastExchange" in p for p in plans)
