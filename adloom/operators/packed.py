"""Several values packed in one field, split into one row per value.

Quoted spans are atomic and plain delimiters (``, ; | • ·``, tab, line break)
always part values, as a value that holds one is quoted. A slash is ambiguous
("CI/CD", "Java / Go"): expectation-maximisation over the whole column learns
the frequencies of values and, for each way a slash is set, how often it parts
values; Viterbi over the lattice of each run then picks the likeliest split.
The column's distinct runs are aggregated before anything is shuffled twice.

Defined results: null and blank cells and cells with one value give no row;
empty places don't count; a cell that is a JSON array gives its items; values
are trimmed and unquoted; repeated rows count; ties are parted at the slash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.session import cut, small

#: rounds of expectation-maximisation; the split decisions settle after two
ROUNDS = 4
#: prior rate at which a slash parts values, by the blanks around it
PRIOR = {"spaced": 0.9, "half": 0.8, "tight": 0.2}
PRIOR_WEIGHT = 4.0
#: uses of a value beside the one in question, where there are none
UNSEEN = 0.01
#: atoms up to which every part of a run may be a value; a longer value is known
#: by a cell that it fills alone, so none is lost and long runs stay linear
LONG = 64

PIECE = r'(?:"(?:[^"]++|"")*+"|[^",;|•·\t\n\r\u2028]++|")++'
QUOTES = r'"(?:[^"]|"")*"'
#: characters of white space, trimmed without a pattern
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _trim(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANKS))


def _clean(t: Column) -> Column:
    """A trimmed piece unquoted."""
    inner = _trim(F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"')))
    return F.when(t.startswith('"') & t.endswith('"') & (F.length(t) > 1), inner).otherwise(t)


def _json_items(cell: Column) -> Column:
    """Items of a cell that is a JSON array, else null."""
    return F.when(F.ltrim(cell).startswith("["), F.when(cell.rlike(r"(?s)^\s*\[.*\]\s*$"), F.filter(F.transform(F.from_json(cell, "array<string>"), _trim), lambda v: v != "")))


def _pieces(cell: Column) -> Column:
    found = F.regexp_extract_all(cell, F.lit(PIECE), F.lit(0))
    return F.filter(F.transform(found, _trim), lambda p: p != "")


def _slashed(text: Column) -> Column:
    """Whether a slash stands outside quotes."""
    return text.contains("/") & (~text.contains('"') | F.regexp_replace(text, QUOTES, "").contains("/"))


def lattice(run: str) -> tuple[list[str], list[str]]:
    """Atoms of a run and the marks between them, quoted spans atomic."""
    atoms, marks, now, quoted = [], [], "", False
    for ch in run:
        if ch == '"':
            quoted = not quoted
        if ch == "/" and not quoted:
            atoms.append(now)
            marks.append("/")
            now = ""
        else:
            now += ch
    atoms.append(now)
    return atoms, marks


def style(left: str, right: str) -> str:
    blanks = (left[-1:].isspace() or left == "") + (right[:1].isspace() or right == "")
    return ("tight", "half", "spaced")[blanks]


def _spans(run: str):
    """(atoms, styles) of a run."""
    atoms, marks = lattice(run)
    return atoms, [style(atoms[k], atoms[k + 1]) for k in range(len(marks))]


def _quoted(atom: str) -> bool:
    a = atom.strip()
    return len(a) > 1 and a[0] == a[-1] == '"'


def candidates(run: str, known: Iterable[str] = ()) -> list[tuple[int, int, str]]:
    """All values a run may hold: (first atom, last atom, value). Values of more
    than ``LONG`` atoms are the run itself and those of ``known`` that it holds."""
    atoms, styles = _spans(run)
    whole = [_quoted(a) for a in atoms]
    out, n = [], len(atoms)
    for i in range(n):
        for j in range(i, min(n, i + LONG)):
            if j > i and (whole[i] or whole[j]):
                break  # a quoted span is a value of its own
            value = "/".join(atoms[i : j + 1]).strip()
            out.append((i, j, value))
    if n > LONG:
        for value in {run.strip(), *known}:
            m = value.count("/") + 1
            if m > LONG:
                out += [(i, i + m - 1, value) for i in range(n - m + 1) if not any(whole[i : i + m]) and "/".join(atoms[i : i + m]).strip() == value]
    return out


def long_keys(run: str) -> tuple[str, list[str]]:
    """The start of a long run, and all places of it where a long value may start."""
    atoms = lattice(run)[0]
    start = lambda i: "/".join(atoms[i : i + LONG + 1]).strip()
    return start(0), sorted({start(i) for i in range(len(atoms) - LONG)})


def _log(x: float) -> float:
    return math.log(max(x, 1e-300))


def _log_use(value: str, p: dict[str, float], n: int) -> float:
    """Log frequency of a value in a run of n atoms; that of an unseen one stays
    below any split of a long run into seen ones."""
    x = p.get(value, 0.0) if value else 0.5
    return math.log(x) if x > 1e-300 else _log(0.0) * max(1.0, n / 12)


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def best_split(run: str, p: dict[str, float], rate: dict[str, float]) -> list[str]:
    """Viterbi over the lattice of a run."""
    atoms, styles = _spans(run)
    n = len(atoms)
    kept = [0.0]  # log chance that the first k slashes part nothing
    for m in styles:
        kept.append(kept[-1] + _log(1 - rate[m]))
    into: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i, j, value in candidates(run, p):
        into[j].append((i, _log_use(value, p, n) + kept[j] - kept[i] + (_log(rate[styles[i - 1]]) if i else 0.0)))
    best: list[tuple[float, int]] = [(0.0, 0)] + [(-math.inf, 0)] * n
    for j in range(n):
        for i, x in sorted(into[j], reverse=True):  # of equals the one parted last
            if best[i][0] + x > best[j + 1][0] + 1e-12:
                best[j + 1] = (best[i][0] + x, i)
    out, j = [], n
    while j:
        i = best[j][1]
        value = "/".join(atoms[i:j]).strip()
        if value:
            out.append(value)
        j = i
    return out[::-1]


def expected(run: str, weight: float, p: dict[str, float], rate: dict[str, float]) -> tuple[dict[str, float], dict[str, list[float]]]:
    """Forward-backward over a run: expected uses of each value and, by style,
    [parted, all] slashes, all times ``weight``; in logs, as runs may be long."""
    atoms, styles = _spans(run)
    n = len(atoms)
    kept = [0.0]  # log chance that the first k slashes part nothing
    for m in styles:
        kept.append(kept[-1] + _log(1 - rate[m]))
    starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # by last atom
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # by first atom
    for i, j, value in candidates(run, p):
        x = _log_use(value, p, n) + kept[j] - kept[i] + (_log(rate[styles[i - 1]]) if i else 0.0)
        starts[j].append((i, x))
        ends[i].append((j, x))
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(n):
        ahead[j + 1] = _log_sum([ahead[i] + x for i, x in starts[j]])
    for i in range(n - 1, -1, -1):
        behind[i] = _log_sum([x + behind[j + 1] for j, x in ends[i]])
    uses: dict[str, float] = {}
    marks: dict[str, list[float]] = {}
    for i, j, x in ((i, j, x) for i in range(n) for j, x in ends[i]):
        share = weight * math.exp(min(0.0, ahead[i] + x + behind[j + 1] - ahead[n]))
        value = "/".join(atoms[i : j + 1]).strip()
        if value:
            uses[value] = uses.get(value, 0.0) + share
        if i:
            marks.setdefault(styles[i - 1], [0.0, 0.0])[0] += share
    for s in styles:
        marks.setdefault(s, [0.0, 0.0])[1] += weight
    return uses, marks


def _expect(pdf: pd.DataFrame, rate: dict[str, dict[str, float]]):
    """One E-step over distinct runs with the probabilities of their values."""
    rows = []
    for field, run, n, values, probs in zip(pdf["field"], pdf["run"], pdf["n"], pdf["vals"], pdf["probs"]):
        uses, marks = expected(run, float(n), dict(zip(values, probs)), rate[field])
        rows += [(field, "v", v, x, 0.0) for v, x in uses.items()]
        rows += [(field, "s", s, a, b) for s, (a, b) in marks.items()]
    return pd.DataFrame(rows, columns=["field", "kind", "name", "x", "y"])


def explode_packed(df: DataFrame, fields: list[str], row_id: str = "row_id", rounds: int = ROUNDS) -> DataFrame:
    """(row_id, field, position, value) of every cell with two or more values.

    The table is read twice: once to count values and runs, in maps that meet
    before the shuffle, and once to split. Cells without a lattice node that is
    open are split in place; the distinct others are decided once and joined.
    """
    cells = df.select(
        F.col(f"`{row_id}`").alias("row_id"),
        F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("cell")) for f in fields))).alias("c"),
    ).select("row_id", "c.field", "c.cell").where(F.length(_trim(F.col("c.cell"))) > 0)
    run_of = lambda p: F.struct(_slashed(p).alias("run"), F.when(_slashed(p), p).otherwise(_clean(p)).alias("text"))
    sure_of = lambda v: F.struct(F.lit(False).alias("run"), v.alias("text"))
    items = _json_items(F.col("cell"))
    parts = F.coalesce(F.transform(items, sure_of), F.transform(_pieces(F.col("cell")), run_of))
    seen = cut(
        cells.select("field", F.explode(parts).alias("p")).select("field", "p.run", "p.text").where("text <> ''").groupBy("field", "run", "text").agg(F.count(F.lit(1)).alias("n"))
    )
    # values that stand alone are certain uses
    sure = seen.where("not run").select("field", F.col("text").alias("value"), F.col("n").cast("double").alias("x"))
    decided = _learn(seen.where("run").select("field", F.col("text").alias("run"), "n"), sure, fields, rounds)
    open_ = _slashed(F.col("cell")) & items.isNull()
    # the distinct open cells: their runs are looked up, the rest is sure
    looked = (
        cells.where(open_).select("field", "cell").distinct().select("field", "cell", F.posexplode(_pieces(F.col("cell"))).alias("k", "run"))
        .join(small(decided), ["field", "run"], "left")
        .groupBy("field", "cell")
        .agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("split", F.array(_clean(F.col("run")))).alias("vs")))).alias("runs"))
        .select("field", "cell", F.flatten(F.transform("runs", lambda r: r["vs"])).alias("vs"))
    )
    plain = cells.where(~open_).select("row_id", "field", F.coalesce(items, F.transform(_pieces(F.col("cell")), _clean)).alias("vs"))
    mixed = cells.where(open_).join(looked, ["field", "cell"]).select("row_id", "field", "vs")
    out = plain.unionByName(mixed).select("row_id", "field", F.filter("vs", lambda v: v != "").alias("vs"))
    return (
        out.where(F.size("vs") > 1)
        .select("row_id", "field", F.posexplode("vs").alias("k", "value"))
        .select("row_id", "field", (F.col("k") + 1).cast("long").alias("position"), "value")
    )


def _learn(runs: DataFrame, sure: DataFrame, fields: list[str], rounds: int) -> DataFrame:
    """(field, run, split) after expectation-maximisation over all runs."""

    def spans(batches):
        for pdf in batches:
            rows = []
            for f, run, n in zip(pdf["field"], pdf["run"], pdf["n"]):
                values = sorted({v for _, _, v in candidates(run) if v})
                # before anything is learned a run's uses are spread over all that it may hold
                rows += [(f, run, n, v, n / len(values)) for v in values]
            yield pd.DataFrame(rows, columns=["field", "run", "n", "value", "x"])

    def keys(batches):
        for pdf in batches:
            rows = [(f, run, n, *long_keys(run)) for f, run, n in zip(pdf["field"], pdf["run"], pdf["n"])]
            yield pd.DataFrame(rows, columns=["field", "run", "n", "head", "starts"])

    # a long value inside a longer run is known by a cell that it fills alone
    long_ = runs.where(F.length("run") - F.length(F.replace("run", F.lit("/"), F.lit(""))) >= LONG).mapInPandas(keys, "field string, run string, n bigint, head string, starts array<string>")
    inner = long_.select("field", "run", "n", F.explode("starts").alias("head"))
    inner = inner.join(long_.select("field", "head", F.trim("run").alias("value")), ["field", "head"]).where(F.contains("run", "value") & (F.trim("run") != F.col("value"))).select("field", "run", "n", "value", F.lit(0.0).alias("x"))
    cand = cut(runs.mapInPandas(spans, "field string, run string, n bigint, value string, x double").unionByName(inner.distinct()))
    # of the sure values only those that a run may hold are looked up again
    total = {r["field"]: r["x"] for r in sure.groupBy("field").agg(F.sum("x").alias("x")).collect()}  # one number a field
    sure = cut(sure.join(cand.select("field", "value").distinct(), ["field", "value"], "left_semi"))
    # the styles' rates are three numbers a field
    rate = {f: dict(PRIOR) for f in fields}
    uses = cand.groupBy("field", "value").agg(F.sum("x").alias("x"))
    for _ in range(rounds):
        # sure values outside the runs count in the total alone
        mass = {r["field"]: r["x"] + total.get(r["field"], 0.0) for r in uses.groupBy("field").agg(F.sum("x").alias("x")).collect()}
        whole = F.coalesce(*(F.when(F.col("field") == f, F.lit(float(x))) for f, x in mass.items()), F.lit(1.0))
        p = uses.unionByName(sure).groupBy("field", "value").agg(F.sum("x").alias("x")).select("field", "value", (F.greatest(F.col("x") - 1, F.lit(UNSEEN)) / whole).alias("p"))
        given = cand.drop("x").join(p, ["field", "value"]).groupBy("field", "run").agg(F.first("n").alias("n"), F.collect_list("value").alias("vals"), F.collect_list("p").alias("probs"))
        fixed = {f: dict(r) for f, r in rate.items()}

        def step(batches, fixed=fixed):
            for pdf in batches:
                yield _expect(pdf, fixed)

        found = cut(given.mapInPandas(step, "field string, kind string, name string, x double, y double").groupBy("field", "kind", "name").agg(F.sum("x").alias("x"), F.sum("y").alias("y")))
        for r in found.where("kind = 's'").collect():  # at most three rows a field
            rate[r["field"]][r["name"]] = (r["x"] + PRIOR[r["name"]] * PRIOR_WEIGHT) / (r["y"] + PRIOR_WEIGHT)
        uses = found.where("kind = 'v'").select("field", F.col("name").alias("value"), "x")

    last = {f: dict(r) for f, r in rate.items()}

    def decide(batches):
        for pdf in batches:
            splits = [[_unquote(v) for v in best_split(run, dict(zip(vals, probs)), last[field])] for field, run, vals, probs in zip(pdf["field"], pdf["run"], pdf["vals"], pdf["probs"])]
            yield pd.DataFrame({"field": pdf["field"], "run": pdf["run"], "split": splits})

    return cut(given.mapInPandas(decide, "field string, run string, split array<string>"))


def _unquote(v: str) -> str:
    v = v.strip()
    return v[1:-1].replace('""', '"').strip() if len(v) > 1 and v[0] == v[-1] == '"' else v
