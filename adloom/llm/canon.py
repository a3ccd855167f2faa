"""Free-entered values to the entries of a reference list.

All spellings of an entry (its name, its translation and alias paths with usual
abbreviations) form a trie; a Levenshtein automaton of the folded value walks
the trie and returns every entry within a distance that depends on the length.
The automaton is simulated in bits: for each number of edits one integer holds
the places of the value that the path so far can stand for, so a step is a few
operations whatever the value's length, and branches die as soon as no place is
left.

Distinct values are searched once (a partial aggregate absorbs hot values) and
joined back to their rows. Remarks on level and contract are a fixed list; those
on places are the words of the table's own place column.

Defined results: null and blank values give no row; a value spelled exactly
like an entry's name gives no row; a value without letters or without an entry
in reach gives entry 0; of several entries the nearest wins, ties go to the
smallest entry_id; repeated rows give one row each.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import text as T
from adloom.session import cut, small

# Remarks on level, kind of place and contract that say nothing of the role.
REMARKS = frozenset(
    "junior jr juniorni senior sr seniorni medior mediorni mid level entry hybrid hybridne remote full part time fulltime parttime"
    " uvazek uvazku hpp dpp dpc ico nastup ihned urgent nova pozice m f d w x z h ka ova 0 8 5 home office".split()
)
# Usual abbreviations of words in names.
ABBREVIATIONS = (
    ("business intelligence", "bi"), ("machine learning", "ml"), ("data warehouse", "dwh"), ("quality assurance", "qa"), ("user experience", "ux"),
    ("database", "db"), ("engineer", "eng"), ("developer", "dev"), ("specialist", "spec"), ("manager", "mgr"), ("coordinator", "coord"),
    ("consultant", "cons"), ("technician", "tech"), ("assistant", "asst"), ("architect", "arch"), ("administrator", "admin"), ("administration", "admin"),
    ("analysis", "anlys"), ("operations", "ops"), ("management", "mgmt"), ("applications", "apps"), ("human resources", "hr"),
)


MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff]")
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case, no accents, words parted by single blanks."""
    plain = text if text.isascii() else MARKS.sub("", unicodedata.normalize("NFKD", text))
    return " ".join(WORD.findall(plain.casefold()))


def reach(length: int) -> int:
    """Greatest distance allowed for a value of so many characters."""
    return 0 if length <= 2 else 1 if length <= 4 else 2 if length <= 11 else 3


class Trie:
    """Nodes are dicts from character to node; key '' holds entry ids."""

    def __init__(self, entries: list[tuple[int, str, str | None]]):
        self.root: dict = {}
        self.paths: dict[str, int] = {}
        for entry, *names in entries:
            for name in names:
                for path in alias_paths(fold(name or "")):
                    node = self.root
                    for ch in path:
                        node = node.setdefault(ch, {})
                    node.setdefault("", set()).add(entry)
                    self.paths[path] = min(entry, self.paths.get(path, entry))

    def search(self, word: str, k: int) -> list[tuple[int, int]]:
        """All (distance, entry) within ``k`` edits, exchanges of neighbours included."""
        n, found = len(word), {}
        full, end = (1 << (n + 1)) - 1, 1 << n
        places: dict[str, int] = {}
        for i, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << i
        # bit i of states[e]: the path stands for word[:i] with e edits or fewer
        start = tuple((1 << (e + 1)) - 1 & full for e in range(k + 1))
        stack = [(self.root, start, None, 0)]
        while stack:
            node, states, before, last = stack.pop()
            if states[k] & end and "" in node:
                d = next(e for e in range(k + 1) if states[e] & end)
                for entry in node[""]:
                    if d < found.get(entry, k + 1):
                        found[entry] = d
            for ch, child in node.items():
                if not ch:
                    continue
                here = places.get(ch, 0)
                low = (states[0] & here) << 1
                new = [low]
                for e in range(1, k + 1):
                    less = states[e - 1]
                    # the same letter; another one; one too many; one missing
                    now = (states[e] & here) << 1 | less << 1 | less | low << 1
                    if before is not None:  # two neighbours exchanged
                        now |= ((before[e - 1] & here) << 1 & last) << 1
                    low = now & full
                    new.append(low)
                if low or (k and states[k - 1]):
                    stack.append((child, tuple(new), states, here))
        return sorted((d, e) for e, d in found.items())


def alias_paths(name: str) -> set[str]:
    """The name and its forms with one or all usual abbreviations."""
    if not name:
        return set()
    out, full = {name}, name
    for long, short in ABBREVIATIONS:
        if long in name:
            for form in (f"{short} ", short):
                out.add(" ".join(name.replace(long, form).split()))
            full = " ".join(full.replace(long, f"{short} ").split())
    return out | {full}


@lru_cache(maxsize=200_000)
def _remark(token: str) -> bool:
    if token in REMARKS or re.sub(r"(.)\1", r"\1", token) in REMARKS:
        return True
    return len(token) > 3 and any(abs(len(token) - len(r)) <= 1 and len(r) > 4 and _one_edit(token, r) for r in REMARKS)


def _one_edit(a: str, b: str) -> bool:
    """Whether two words differ by one edit or one exchange of neighbours."""
    if a == b:
        return True
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])


def forms(value: str, places: frozenset[str] = frozenset()) -> list[str]:
    """Folded forms under which a value is searched: whole, without remarks and
    places, and with the parts around a comma exchanged."""
    open_text = re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", value)
    out: list[str] = []
    for text in (open_text, value):
        parts = [p for p in (fold(x) for x in re.split(r"[,;]", text)) if p]
        stripped = [p for p in (" ".join(t for t in part.split() if not _remark(t) and t not in places) for part in parts) if p]
        for ps in (stripped, parts):
            out += [" ".join(ps), " ".join(ps[1:] + ps[:1])]
    return list(dict.fromkeys(x for x in out if x))


def nearest(trie: Trie, candidates: list[str]) -> int:
    """Nearest entry over the forms of a value, 0 if none is in reach. The
    distance grows step by step, so that near entries are found in short walks."""
    exact = [trie.paths[f] for f in candidates if f in trie.paths]
    if exact:
        return min(exact)
    for k in range(1, max((reach(len(f)) for f in candidates), default=0) + 1):
        hits = [hit for f in candidates if reach(len(f)) >= k for hit in trie.search(f, k)[:1]]
        if hits:
            return min(hits)[1]
    return 0


def best_entry(trie: Trie, value: str, places: frozenset[str] = frozenset()) -> int:
    return nearest(trie, forms(value, places))


def _words(x: Column) -> Column:
    return F.array_distinct(F.filter(F.split(T.normalise(x, ""), " "), lambda w: F.length(w) > 2))


def _signatures(word: Column) -> Column:
    """A word, and what is left of a longer one after a deletion."""
    left = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(F.length(word) > 3, F.array_distinct(F.array_append(left, word))).otherwise(F.array(word))


def place_words(words: DataFrame, df: DataFrame, place: str) -> DataFrame:
    """Those of distinct ``words`` that are words of a place column or, if
    longer, a slip from one."""
    places = df.select(F.explode(_words(F.col(f"`{place}`"))).alias("place")).distinct()
    both = words.select("word", F.explode(_signatures(F.col("word"))).alias("s")).join(places.select("place", F.explode(_signatures(F.col("place"))).alias("s")), "s")
    swapped = (F.length("word") == F.length("place")) & (F.array_sort(F.split("word", "")) == F.array_sort(F.split("place", "")))
    slip = (F.length("place") > 4) & ((F.levenshtein("word", "place") <= 1) | swapped)
    return both.where((F.col("word") == F.col("place")) | slip).select("word").distinct()


def map_values(df: DataFrame, entries: DataFrame, fields: list[str], row_id: str = "row_id", place: str | None = "Location") -> DataFrame:
    """(row_id, field, entry_id) of each non-blank value that isn't spelled
    exactly like an entry's name."""
    # the reference list is read whole by every task: its size is checked
    rows = reference(entries.select("field", "entry_id", "name", "name_cs"))
    lists = {f: [(e, n, m) for ff, e, n, m in rows if ff == f] for f in fields}
    exact = {f: frozenset(n for ff, _, n, _ in rows if ff == f and n is not None) for f in fields}
    each = (F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields)
    cells = df.select(F.col(f"`{row_id}`").alias("row_id"), F.explode(F.array(*each)).alias("c")).select("row_id", "c.field", "c.value").where(F.col("value").rlike(r"(?U)[^\s\p{Z}]"))
    distinct = cells.select("field", "value").distinct()
    values = distinct.withColumn("places", F.array().cast("array<string>"))
    if place in df.columns:
        # words of a value that name places, found by joins as both lists may grow
        each = distinct.select("field", "value", F.explode(_words(F.col("value"))).alias("word"))
        named = each.join(place_words(each.select("word").distinct(), df, place), "word").groupBy("field", "value").agg(F.collect_list("word").alias("places"))
        values = distinct.join(named, ["field", "value"], "left").select("field", "value", F.coalesce("places", F.array().cast("array<string>")).alias("places"))

    def search(batches):
        tries = {f: Trie(x) for f, x in lists.items()}
        # words of the list's own names say what the role is, also if a place bears them
        own = {f: frozenset(w for p in t.paths for w in p.split()) for f, t in tries.items()}
        seen: dict[tuple[str, ...], int] = {}
        for pdf in batches:
            out = []
            for f, v, places in zip(pdf["field"], pdf["value"], pdf["places"]):
                if v in exact[f]:
                    continue
                key = (f, *forms(v, frozenset(places) - own[f]))
                if key not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen[key] = nearest(tries[f], list(key[1:]))
                out.append((f, v, seen[key]))
            yield pd.DataFrame(out, columns=["field", "value", "entry_id"])

    tasks = 3 * df.sparkSession.sparkContext.defaultParallelism
    found = cut(values.repartition(tasks, "field", "value").mapInPandas(search, "field string, value string, entry_id bigint"))
    return cells.join(small(found), ["field", "value"]).select("row_id", "field", "entry_id")


#: most entries of a reference list that every task holds as a trie
MOST_ENTRIES = 1_000_000


def reference(entries: DataFrame) -> list:
    """Rows of a reference list, whose size is checked before they are taken."""
    rows = entries.limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a reference list of more than {MOST_ENTRIES} entries; split it by field")
    return [tuple(r) for r in rows]
