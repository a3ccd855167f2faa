"""Schemas that drift between files: one table per family, every change logged.

The header of each file is read in parallel from its own records (JVM variant
functions), compared with the preceding file of its feed, and folded through a
type-promotion lattice to the union schema that all files are cast to. A rename
is the same content under another header: adverts recur in the next file, so a
removed and an added column are one column renamed if they hold the same values
beside the same other values of their lines. Each other value votes by its
rarity in both files, so an advert's own values decide and common ones matter
only where there are no rarer ones. Votes are counts of pairs of values, so no
two lines are ever paired, however often a value occurs.

Defined results: files of a feed follow in order of written_at, ties by
file_id; the first file of a feed has no changes; lines repeated in a file
weigh as often as they stand; null or unreadable records are left out; a column
without non-null values has no type, so it is never retyped; a column renamed
and retyped at once gives both changes; where the files share no value beside
the columns, headers that differ only in case or marks count as renamed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from adloom.session import cut

#: weighted share of votes by which a renamed column's two headers agree
SAME_CONTENT = 0.3

#: the lattice: each type goes up to the next that holds all of its values
LATTICE = ("null", "boolean", "number", "string", "array", "object")


def json_type(kind: Column) -> Column:
    """JSON type name of a variant's schema text."""
    return (
        F.when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", F.lit(None).cast("string"))
        .otherwise("number")
    )


def promote(a: str | None, b: str | None) -> str | None:
    """Least type that holds both: null below all; equal types stay; boolean,
    number and string meet in string; an array takes scalars as its items; an
    object meets any other type in string (its JSON text)."""
    if a is None or b is None or a == b:
        return a or b
    if "object" in (a, b):
        return "string"
    if "array" in (a, b):
        return "array"
    return "string"


def parsed(records: DataFrame, content: bool) -> DataFrame:
    """(file_id, line_no, cells): each line with its fields as an array of
    struct(name, type, content); without content if it isn't asked for."""
    v = F.expr("try_variant_get(try_parse_json(record), '$', 'map<string,variant>')")

    def cell(e: Column) -> Column:
        value = e["value"]
        kind = F.schema_of_variant(value)
        if not content:
            return F.struct(e["key"].alias("name"), json_type(kind).alias("type"))
        # a list says its items, an object its first text
        scalars = F.regexp_extract_all(F.to_json(value), F.lit(r'"((?:[^"\\]|\\.)*+)"(?!\s*:)'), F.lit(1))
        text = F.try_variant_get(value, "$", "string")
        says = F.when(kind.startswith("ARRAY"), F.concat_ws(", ", scalars)).when(kind.startswith("OBJECT"), F.get(scalars, F.lit(0))).otherwise(text)
        return F.struct(e["key"].alias("name"), json_type(kind).alias("type"), F.when(kind != "VOID", says).alias("content"))

    return records.select("file_id", "line_no", F.explode(F.array(F.map_entries(v))).alias("e")).where(F.col("e").isNotNull()).select("file_id", "line_no", F.transform("e", cell).alias("cells"))


def _met(df: DataFrame) -> DataFrame:
    """One side of a join by sorting: both sides grow with the files, and what the
    planner knows of parsed lines' size is no bound, so nothing is broadcast."""
    return df.hint("merge")


def _pairs(records: DataFrame) -> DataFrame:
    """(file_id, prev): each file with the preceding one of its feed."""
    files = records.groupBy("file_id").agg(F.min("feed").alias("feed"), F.min("written_at").alias("written_at"))
    # one row per file, not per line
    return files.select("file_id", F.lag("file_id").over(Window.partitionBy("feed").orderBy("written_at", "file_id")).alias("prev")).where(F.col("prev").isNotNull())


def headers(records: DataFrame) -> DataFrame:
    """(file_id, name, type): the header of each file with each column's type,
    that of most non-null values, ties to the first of the lattice."""
    per = parsed(records, False).select("file_id", F.explode("cells").alias("c")).select("file_id", "c.name", "c.type").groupBy("file_id", "name", "type").agg(F.count(F.lit(1)).alias("n"))
    # count and type in one number, so that the maximum is a plain hash aggregate
    code = F.coalesce(*(F.when(F.col("type") == t, F.lit(len(LATTICE) - k)) for k, t in enumerate(LATTICE)), F.lit(0)).cast("long")
    best = per.groupBy("file_id", "name").agg(F.max(F.when(code > 0, F.col("n") * 8 + code).otherwise(F.lit(0).cast("long"))).alias("best"))
    kind = F.coalesce(*(F.when(F.col("best") % 8 == len(LATTICE) - k, F.lit(t)) for k, t in enumerate(LATTICE)))
    return best.select("file_id", "name", F.when(F.col("best") > 0, kind).alias("type"))


def _votes(lines: DataFrame, name: str) -> DataFrame:
    """(file_id, <name>, x, y, n): how many lines hold y in a column that came or
    went and x beside it; repeats of x in a line count once."""
    ys = F.explode(F.filter("cells", lambda c: F.array_contains("names", c["name"]) & c["content"].isNotNull())).alias("y")
    xs = F.array_distinct(F.transform(F.filter("cells", lambda c: F.coalesce(c["content"], F.lit("")) != ""), lambda c: c["content"]))
    each = lines.select("file_id", xs.alias("xs"), ys).select("file_id", F.col("y.name").alias(name), F.explode(F.filter("xs", lambda x: x != F.col("y.content"))).alias("x"), F.col("y.content").alias("y"))
    return each.groupBy("file_id", name, "x", "y").agg(F.count(F.lit(1)).alias("n"))


def _renames(records: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """(file_id, old, new): columns renamed, by what they hold beside the same values."""
    went = gone.groupBy("file_id", "prev").agg(F.collect_list("name").alias("names"))  # names of one header
    came = come.groupBy("file_id", "prev").agg(F.collect_list("name").alias("names"))
    both = _met(went).join(came.select("file_id", "prev", F.col("names").alias("new_names")), ["file_id", "prev"])
    lines = parsed(_met(records).join(both.select(F.explode(F.array("file_id", "prev")).alias("file_id")).distinct(), "file_id", "left_semi"), True)
    before = lines.withColumnRenamed("file_id", "prev").join(_met(both.select("file_id", "prev", "names")), "prev")
    after = lines.join(_met(both.select("file_id", F.col("new_names").alias("names"))), "file_id")
    old, new = cut(_votes(before, "old")), cut(_votes(after, "new"))
    n_old = old.groupBy("file_id", "old", "x").agg(F.sum("n").alias("n_old"))
    n_new = new.groupBy("file_id", "new", "x").agg(F.sum("n").alias("n_new"))
    same = (
        _met(old).join(new.withColumnRenamed("n", "m"), ["file_id", "x", "y"])
        .groupBy("file_id", "old", "new", "x").agg(F.sum(F.least("n", "m")).alias("same"))
    )
    weight = 1.0 / (F.col("n_old") * F.col("n_new"))
    share = F.coalesce("same", F.lit(0)) / F.least("n_old", "n_new")
    agree = (
        _met(n_old).join(n_new, ["file_id", "x"]).join(_met(same), ["file_id", "old", "new", "x"], "left")
        .groupBy("file_id", "old", "new").agg((F.sum(weight * share) / F.sum(weight)).alias("same"))
    )
    plain = lambda x: F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]", "")
    spelled = _met(gone.select("file_id", F.col("name").alias("old"))).join(come.select("file_id", F.col("name").alias("new")), "file_id").where(plain(F.col("old")) == plain(F.col("new")))
    score = (
        _met(agree).join(spelled.withColumn("spelled", F.lit(1.0)), ["file_id", "old", "new"], "full")
        .select("file_id", "old", "new", F.when(F.col("same") >= SAME_CONTENT, F.col("same")).when(F.col("same").isNull(), F.col("spelled") * 0.1).alias("score"))
        .where(F.col("score").isNotNull())
    )
    rank = lambda key, other: F.row_number().over(Window.partitionBy("file_id", key).orderBy(F.desc(F.round("score", 9)), other))
    return score.withColumns({"a": rank("old", "new"), "b": rank("new", "old")}).where("a = 1 and b = 1").select("file_id", "old", "new")


def changes(records: DataFrame) -> DataFrame:
    """(file_id, change, column_name, before, type_before, type): each
    difference of a file from the preceding one of its feed."""
    pairs = _pairs(records)
    h = cut(headers(records))
    now = _met(pairs).join(h, "file_id").select("file_id", "prev", "name", F.col("type").alias("t_now"), F.lit(True).alias("in_now"))
    was = _met(pairs).join(h.withColumnRenamed("file_id", "prev"), "prev").select("file_id", "prev", "name", F.col("type").alias("t_was"), F.lit(True).alias("in_was"))
    both = cut(_met(now).join(was, ["file_id", "prev", "name"], "full"))
    gone, come = both.where(F.col("in_now").isNull()), both.where(F.col("in_was").isNull())
    renamed = cut(_renames(records, gone, come))
    moved = (
        _met(renamed).join(gone.select("file_id", F.col("name").alias("old"), "t_was"), ["file_id", "old"])
        .join(_met(come.select("file_id", F.col("name").alias("new"), "t_now")), ["file_id", "new"])
    )
    row = lambda change, name, before="name": (F.lit(change).alias("change"), F.col(name).alias("column_name"), F.col(before).alias("before"), F.col("t_was").alias("type_before"), F.col("t_now").alias("type"))
    retyped = F.col("t_was") != F.col("t_now")
    return (
        _met(come).join(renamed.select("file_id", F.col("new").alias("name")), ["file_id", "name"], "left_anti").select("file_id", *row("added", "name"))
        .unionByName(_met(gone).join(renamed.select("file_id", F.col("old").alias("name")), ["file_id", "name"], "left_anti").select("file_id", *row("removed", "name")))
        .unionByName(moved.select("file_id", *row("renamed", "new", "old")))
        .unionByName(moved.where(retyped).select("file_id", *row("retyped", "new", "old")))
        .unionByName(both.where(F.col("in_now") & F.col("in_was") & retyped).select("file_id", *row("retyped", "name")))
    )


def unified_columns(records: DataFrame, family: str) -> dict[str, tuple[list[str], str]]:
    """Canonical column -> (all its spellings, promoted type) of one family.

    Spellings linked by a rename are one column, named by the spelling that
    most files use. What comes to the driver is schema only: distinct pairs of
    header spellings and types, bounded by the vocabulary of headers.
    """
    own = records.where(F.col("family") == family)
    log = changes(own).where("change = 'renamed'").groupBy("before", "column_name").agg(F.count("*").alias("n")).collect()
    heads = headers(own).groupBy("name", "type").agg(F.count("*").alias("files")).collect()
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in log:
        parent[find(r["before"])] = find(r["column_name"])
    plain: dict[str, str] = {}
    for r in heads:  # spellings that differ only in case or marks are one
        key = re.sub(r"[\W_]", "", r["name"].lower())
        parent[find(r["name"])] = find(plain.setdefault(key, r["name"]))
    files: dict[str, int] = {}
    kinds: dict[str, str | None] = {}
    for r in sorted(heads, key=lambda r: (r["name"], r["type"] or "")):
        files[r["name"]] = files.get(r["name"], 0) + r["files"]
        root = find(r["name"])
        kinds[root] = promote(kinds.get(root), r["type"])
    groups: dict[str, list[str]] = {}
    for name in files:
        groups.setdefault(find(name), []).append(name)
    out = {}
    for root, names in groups.items():
        names.sort(key=lambda n: (-files[n], n))
        out[names[0]] = (names, kinds[root] or "string")
    return dict(sorted(out.items()))


SPARK_TYPES = {"boolean": T.BooleanType(), "number": T.DoubleType(), "string": T.StringType(), "array": T.ArrayType(T.StringType()), "object": T.StringType()}


def unify(records: DataFrame, family: str) -> DataFrame:
    """One table of a family: file_id, line_no and the union of all columns,
    every file cast to the promoted types; absent columns are null."""
    columns = unified_columns(records, family)
    lines = records.where(F.col("family") == family).withColumn("m", F.from_json("record", "map<string,string>"))
    out = []
    for name, (spellings, kind) in columns.items():
        raw = F.coalesce(*(F.try_element_at("m", F.lit(s)) for s in spellings))
        if kind == "array":
            items = F.from_json(raw, "array<string>")
            value = F.when(raw.startswith("["), items).when(raw.isNotNull(), F.array(raw))
        else:
            value = raw.try_cast(SPARK_TYPES[kind])
        out.append(value.alias(name))
    return lines.select("file_id", "line_no", *out)
