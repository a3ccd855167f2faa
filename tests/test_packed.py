from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.operators import packed


def _run(spark, cells):
    df = spark.createDataFrame(list(enumerate(cells)), "row_id long, `Caution.Flags` string")
    out = {}
    for r in sorted(packed.explode_packed(df, ["Caution.Flags"]).collect(), key=lambda r: (r["row_id"], r["position"])):
        out.setdefault(r["row_id"], []).append(r["value"])
    return out


def test_splits_and_quotes(spark):
    cells = [
        "CI/CD, Excel, Go", "CI/CD / Excel / Go /", 'Go; "Keras; Torch"', '["A", "Role called \\"all-round\\""]', '"Role called ""all-round""" | Go', "Go", "", None, '"CI/CD"',
        "• Go\n• Excel", "Go,, ,Excel", "CI/CD", "Excel / CI/CD", "CI/CD | Go", "CI/CD; Excel", '"Keras; Torch" / "Excel"', "Go,Go",
    ]
    got = _run(spark, cells)
    assert got == {
        0: ["CI/CD", "Excel", "Go"], 1: ["CI/CD", "Excel", "Go"], 2: ["Go", "Keras; Torch"], 3: ["A", 'Role called "all-round"'], 4: ['Role called "all-round"', "Go"],
        9: ["Go", "Excel"], 10: ["Go", "Excel"], 12: ["Excel", "CI/CD"], 13: ["CI/CD", "Go"], 14: ["CI/CD", "Excel"], 15: ["Keras; Torch", "Excel"], 16: ["Go", "Go"],
    }


def test_empty_and_long(spark):
    assert _run(spark, []) == {}
    assert len(_run(spark, ["a, b" + ", c" * 20_000])[0]) == 20_002


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " a", "b "]), min_size=1, max_size=5), st.dictionaries(st.sampled_from(["a", "b", "a/b", "b/a", "a /b"]), st.floats(0.01, 0.5), min_size=1))
def test_viterbi_is_the_best_split(atoms, p):
    run = "/".join(atoms)
    rate = {"spaced": 0.9, "half": 0.7, "tight": 0.3}
    parts, styles = packed._spans(run)

    def score(cuts):
        x, i = 1.0, 0
        for k, s in enumerate(styles):
            x *= rate[s] if cuts[k] else 1 - rate[s]
        for j in [k + 1 for k, c in enumerate(cuts) if c] + [len(parts)]:
            x *= p.get("/".join(parts[i:j]).strip(), 0.0) or 1e-300
            i = j
        return x

    best = max(score(c) for c in product([0, 1], repeat=len(styles)))
    got = packed.best_split(run, p, rate)
    want = [c for c in product([0, 1], repeat=len(styles)) if score(c) >= best * (1 - 1e-9)]
    splits = []
    for cuts in want:
        out, i = [], 0
        for j in [k + 1 for k, c in enumerate(cuts) if c] + [len(parts)]:
            out.append("/".join(parts[i:j]).strip())
            i = j
        splits.append(out)
    assert best < 1e-250 or got in splits


def test_value_of_many_slashes(spark):
    path = "/".join(f"p{k}" for k in range(16))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([path] * 5 + [f"Go, {path}"])], "row_id long, f string")
    got = [(r["row_id"], r["value"]) for r in packed.explode_packed(df, ["f"]).orderBy("row_id", "position").collect()]
    assert got == [(5, "Go"), (5, path)]


def test_long_run_keeps_its_weight():
    uses, marks = packed.expected("/".join("a" * 150), 2.0, {"a": 1e-3}, dict(packed.PRIOR))
    assert abs(uses["a"] - 300) < 1e-6 and abs(marks["tight"][0] - 298) < 1e-6 and marks["tight"][1] == 298


def test_very_long_runs(spark):
    path = "/".join(f"p{k}" for k in range(500))
    many = " / ".join("Go" if k % 2 else "Excel" for k in range(1500))
    df = spark.createDataFrame(list(enumerate([path] * 5 + [f"Go, {path}", f"{path} / Go", many] + ["Go", "Excel"] * 50)), "row_id long, f string")
    got = {}
    for r in packed.explode_packed(df, ["f"]).orderBy("row_id", "position").collect():
        got.setdefault(r["row_id"], []).append(r["value"])
    assert got[5] == ["Go", path] and got[6] == [path, "Go"] and len(got[7]) == 1500 and set(got) == {5, 6, 7}
