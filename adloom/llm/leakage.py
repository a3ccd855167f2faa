"""Evaluation texts that leaked into the corpus, found by latent semantics.

Every document is cut into words once. An inverted index of the words that few
items hold drops the documents that lack the words which answer to an item; the
check below would refuse them all, so none is lost. What is left is kept as word
numbers and cut into overlapping passages like the items. TF-IDF over the items'
words, with frequencies counted over all documents, and a distributed randomised
SVD give a latent space: each power round multiplies by the matrix and its
transpose in one pass, block sums are added in the cluster, and only the words x
rank matrix comes to the driver (its size is fixed by the item list). A passage
whose cosine with a passage of an item from the index reaches the cut is a
candidate; around it the longest common subsequence must hold two fifths of the
item's words, and enough of the words that answer to this item alone (names,
figures) must be there, so that a shared turn of phrase or a standing
instruction is no case, however long the document is.

Defined results: null, blank and wordless texts on either side give no pair;
repeated documents and repeated items give a pair each; case, accents, marks,
markup, quoting and line breaks don't matter; texts of any length are read whole;
an item's words must stand within five times its length and a passage's.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.canon import reference
from adloom.session import cut, spread

#: words of a passage, and how far apart passages start
PASSAGE = 32
STRIDE = 16
#: rank of the latent space, further random directions, power rounds
RANK = 160
EXTRA = 32
POWER = 2
#: least cosine of a candidate; measured recall against brute force is in the README
COSINE = 0.5
#: a word's weight falls no further beyond this share of the passages, so that no
#: item loses its words: words that few items hold, other words
OWN_SHARE = 0.05
COMMON_SHARE = 0.5
#: least share of an item's words in its order, and of the words it shares with few items
SEQUENCE = 0.4
ANSWER = 0.25
FEW = 2
#: words of one block of the sum over passages
BLOCK = 256
#: how far around a candidate passage an item may stand, in lengths of the item
AROUND = 2


TAG = re.compile(r"</?[A-Za-z][^<>]{0,80}>")
#: a word broken at the end of a line
BROKEN = re.compile(r"(?<=[^\W\d_])[-\u2010]\s*\n[>\s]*(?=[^\W\d_])")
#: invisible and combining marks
MARKS = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff]")
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> list[str]:
    """Words without case, accents, markup or invisible marks."""
    t = html.unescape(text) if "&" in text else text
    if "<" in t:
        t = TAG.sub(" ", t)
    t = BROKEN.sub("", t)
    if not t.isascii():
        t = MARKS.sub("", unicodedata.normalize("NFKD", t))
    return WORD.findall(t.casefold())


def passages(words: list) -> list[list]:
    if len(words) <= PASSAGE:
        return [words] if words else []
    return [words[i : i + PASSAGE] for i in range(0, len(words) - STRIDE, STRIDE)]


def places(item: list) -> dict:
    """Bit mask of each word's places."""
    mask: dict = defaultdict(int)
    for i, w in enumerate(item):
        mask[w] |= 1 << i
    return dict(mask)


def common(item: list, doc: list, mask: dict | None = None) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    mask = places(item) if mask is None else mask
    full = state = (1 << len(item)) - 1
    for w in doc:
        if m := mask.get(w):
            u = state & m
            state = ((state + u) | (state - u)) & full
    return len(item) - state.bit_count()


class Items:
    """The test items, their words and passages; of fixed size."""

    def __init__(self, rows: list[tuple[int, str]]):
        words = {i: fold(t) for i, t in rows if t}
        words = {i: w for i, w in words.items() if w}
        seen = Counter(w for ws in {tuple(x) for x in words.values()} for w in set(ws))
        self.terms = {w: k for k, w in enumerate(sorted(seen))}
        self.few = np.array([seen[w] <= FEW for w in self.terms], bool)
        self.words = {i: [self.terms[w] for w in ws] for i, ws in words.items()}
        self.rare = {i: {t for t in ws if self.few[t]} for i, ws in self.words.items()}
        self.masks = {i: places(ws) for i, ws in self.words.items()}
        self.uses = {i: Counter(ws) for i, ws in self.words.items()}
        # the inverted index: words that few items hold, and for items without such words all of theirs
        self.posting: dict[int, list[int]] = defaultdict(list)
        self.bare = [i for i, r in self.rare.items() if not r]
        for i, r in self.rare.items():
            for t in r:
                self.posting[t].append(i)

    def numbers(self, text: str) -> list[int]:
        """A text as the numbers of its words, -1 for those of no item."""
        get = self.terms.get
        return [get(w, -1) for w in fold(text)]

    def possible(self, have: set[int]) -> list[int]:
        """Items that a text with these words can hold: those that ``check`` may pass."""
        hits = Counter(i for t in have if t in self.posting for i in self.posting[t])
        near = [i for i, n in hits.items() if n >= ANSWER * len(self.rare[i])] + self.bare
        return [i for i in near if sum(n for t, n in self.uses[i].items() if t in have) >= SEQUENCE * len(self.words[i])]

    def check(self, item: int, doc: list[int]) -> bool:
        """Whether a stretch of text holds the item."""
        ws, rare = self.words[item], self.rare[item]
        if rare and len(rare.intersection(doc)) < ANSWER * len(rare):
            return False
        return common(ws, doc, self.masks[item]) >= SEQUENCE * len(ws)

    def around(self, item: int, doc: list[int], hits: list[int]) -> bool:
        """``check`` around the passages that start at the given words."""
        wide = AROUND * len(self.words[item])
        lo = hi = -1
        for h in sorted(hits):
            if lo >= 0 and h - wide <= hi:
                hi = h + PASSAGE + wide
                continue
            if lo >= 0 and self.check(item, doc[lo:hi]):
                return True
            lo, hi = max(0, h - wide), h + PASSAGE + wide
        return lo >= 0 and self.check(item, doc[lo:hi])


class Space:
    """TF-IDF rows over the items' words, and their latent projection."""

    def __init__(self, df: np.ndarray, total: int, few: np.ndarray):
        total = max(total, 1)
        # copies of a leak raise the frequencies of its own words: every word keeps a weight
        most = np.where(few, OWN_SHARE, COMMON_SHARE) * total
        self.idf = np.log((1 + total) / (1 + np.minimum(df, most))).astype(np.float32)

    def rows(self, many: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) of passages, rows of length 1; passages without
        terms have no entry."""
        r, c, v = [], [], []
        for k, ws in enumerate(many):
            got = Counter(ws)
            got.pop(-1, None)
            if not got:
                continue
            vals = [(t, (1 + math.log(n)) * float(self.idf[t])) for t, n in got.items()]
            norm = math.sqrt(sum(x * x for _, x in vals))
            for t, x in vals:
                r.append(k)
                c.append(t)
                v.append(x / norm)
        return np.array(r, np.int64), np.array(c, np.int64), np.array(v, np.float32)


def times(r: np.ndarray, c: np.ndarray, v: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    out = np.zeros((n, q.shape[1]), np.float32)
    if len(r):
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        out[r[starts]] = np.add.reduceat(q[c] * v[:, None], starts, axis=0)
    return out


def add_transposed(z: np.ndarray, r: np.ndarray, c: np.ndarray, v: np.ndarray, y: np.ndarray) -> None:
    """z += transposed rows times y."""
    if len(r):
        order = np.argsort(c, kind="stable")
        cs = c[order]
        starts = np.flatnonzero(np.r_[True, cs[1:] != cs[:-1]])
        z[cs[starts]] += np.add.reduceat(y[r[order]] * v[order][:, None], starts, axis=0)


def latent(kept: DataFrame, space: Space, own: tuple, n_own: int, terms: int, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of all kept passages."""
    width = min(rank + EXTRA, terms)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))
    for _ in range(POWER + 1):
        basis = q.astype(np.float32)

        def multiply(batches, basis=basis):
            z = np.zeros_like(basis)
            for pdf in batches:
                many = [p for ws in pdf["words"] for p in passages(ws.tolist())]
                r, c, v = space.rows(many)
                add_transposed(z, r, c, v, times(r, c, v, basis, len(many)))
            blocks = range(0, len(z), BLOCK)
            yield pd.DataFrame({"block": [b // BLOCK for b in blocks], "part": [z[b : b + BLOCK].tobytes() for b in blocks]})

        def total(pdf):
            parts = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["part"])
            return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [parts.tobytes()]})

        z = np.zeros((terms, width))
        add_transposed(z, *own, times(*own, basis, n_own).astype(np.float64))
        # each task's sum is words x rank numbers: one task a core is enough
        few = kept.select("words").coalesce(kept.sparkSession.sparkContext.defaultParallelism)
        sums = few.mapInPandas(multiply, "block int, part binary").groupBy("block").applyInPandas(total, "block int, part binary")
        for row in sums.collect():  # terms x width numbers
            a = row["block"] * BLOCK
            z[a : a + BLOCK] += np.frombuffer(row["part"], np.float64).reshape(-1, width)
        before, (q, _) = q, np.linalg.qr(z)
    # Rayleigh-Ritz on the last pass: rotate to the singular vectors
    small = before.T @ z
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return (before @ turn[:, np.argsort(-values)[:rank]]).astype(np.float32)


def find_leaks(documents: DataFrame, eval_items: DataFrame, ident: str = "doc_id", text: str = "text", item: str = "item_id", cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id) of each document that holds an item's passage."""
    spark = documents.sparkSession
    out = f"{ident} bigint, {item} bigint"
    # the held-out list travels with the tasks; its size is checked
    items = Items(reference(eval_items.select(item, "text")))
    if not items.words:
        return spark.createDataFrame([], out)
    docs = spread(documents.select(F.col(f"`{ident}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id").where(F.col("text").rlike(r"(?U)\w"))
    listed = spark.sparkContext.broadcast(items)

    def read(batches):
        its = listed.value
        df: Counter = Counter()
        total = 0
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                ws = its.numbers(t)
                have = set(ws)
                total += 1
                df.update(have)
                found = its.possible(have)
                if found:
                    rows.append((i, ws, found, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "words", "items", "term", "n"])
        df[-1] = total
        yield pd.DataFrame([(None, None, None, t, n) for t, n in df.items()], columns=["doc_id", "words", "items", "term", "n"]).astype({"doc_id": "Int64", "term": "Int64", "n": "Int64"})

    once = cut(docs.mapInPandas(read, "doc_id bigint, words array<int>, items array<bigint>, term bigint, n bigint"))
    frequency = np.zeros(len(items.terms))
    total = 0
    for r in once.where("n is not null").groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row a word of the items
        if r["term"] < 0:
            total = r["n"]
        else:
            frequency[r["term"]] = r["n"]
    kept = once.where("words is not null").select("doc_id", "words", "items")
    space = Space(frequency, total, items.few)
    own_passages = [(i, p) for i, ws in items.words.items() for p in passages(ws)]
    own = space.rows([p for _, p in own_passages])
    basis = latent(kept, space, own, len(own_passages), len(items.terms))
    targets = times(*own, basis, len(own_passages))
    targets = targets / np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-6)
    owned: dict[int, list[int]] = defaultdict(list)
    for k, (i, _) in enumerate(own_passages):
        owned[i].append(k)
    packed = spark.sparkContext.broadcast((space, basis, targets, dict(owned)))  # words x rank numbers

    def search(batches):
        its = listed.value
        sp, v_k, goals, of = packed.value
        for pdf in batches:
            hits = []
            for ident_, ws, possible in zip(pdf["doc_id"], pdf["words"], pdf["items"]):
                doc = ws.tolist()
                many = passages(doc)
                x = times(*sp.rows(many), v_k, len(many))
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
                for i in possible.tolist():
                    near = np.flatnonzero((x @ goals[of[i]].T).max(axis=1) >= cosine)
                    if len(near) and its.around(i, doc, (near * STRIDE).tolist()):
                        hits.append((ident_, i))
            yield pd.DataFrame(hits, columns=[ident, item])

    return kept.mapInPandas(search, out)
