"""Abusive, hateful or sexual content by multiple-instance learning.

A document is a bag of sentences; its label says only whether some sentence
offends. A linear model scores every sentence from its words, neighbouring
words and letter sequences, after usual disguises (leet spelling, look-alike
letters, parted letters, stretched letters, stars) are undone; the document's
probability is the noisy-or of its sentences. The labels train the sentence
weights through the noisy-or, so the model learns which sentences offend. It is
fitted on at most ``SAMPLE`` labelled documents (chosen by hash, a documented
bound) and scores every document; a word's share of the score is computed once
per worker.

Defined results: null, blank and letterless texts have score 0 and no
offending sentences; repeated documents are scored each; texts of any length
are read whole; without labels of both kinds all scores are 0.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import spread

#: most labelled documents that the model is fitted on
SAMPLE = 6_000
#: weights of the model
BITS = 17
ROUNDS = 250
#: words of a window in run-on sentences
WINDOW = 12
STEP = 0.08
DECAY = 2e-5
#: highest cut from which a document, and a sentence, counts as offending; the
#: cut itself is set on held-out halves of the labelled sample
THRESHOLD = 0.5

# Look-alike letters and leet digits.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһтмнквгпАЕОРСУХІЈЅТМНКВ" + "αεοικυρτνΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhtmhkbrnAEOPCYXIJSTMHKB" + "aeoikuptvABEZHIKMNOPTYX",
)
LEET = str.maketrans("0134578@$!€+", "oieastbasiet")
# Stems of coarse words (en, cs, de, fr); one feature that the
# labels weigh, so that what is learned in one language helps in the others. With
# thousands of labels it changes nothing, with hundreds it saves some errors (README).
COARSE = (
    "asshole bastard bitch idiot imbecil cretin moron scum vermin parasit subhuman filth whore slut fuck cunt cock tits pussy swine loser trash coward"
    " bootlick worthless pathetic horny kreten debil svin prase krav zmet smejd hovad dement spin dobytek paraz havet podradn kurv zmrd curak pich suka"
    " soust kozy krys hajzl chcip hubu klapack arsch wichs fotze hure schlamp ungezief abschaum fresse sau schwein geil fick titten dumm connard salaud"
    " merde vermin putain salop gueul crevez nique encul nichon"
).split()
ZERO_WIDTH = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff]")
PARTED = re.compile(r"(?<![^\W_])([^\W\d_])(?:([-._*\s|/~])[^\W\d_])(?:\2[^\W\d_])+(?![^\W_])")
TOKEN = re.compile(r"[^\W_][^\s,;:()\"„“”«»…?]*")
END = re.compile(r"(?<=[.!?…])\s+|\n+|[•·|]+|\s{2,}")


def plain(text: str) -> str:
    """Disguises of whole texts undone: case, accents, look-alikes, gaps."""
    t = text
    if not t.isascii():
        t = ZERO_WIDTH.sub("", unicodedata.normalize("NFKC", t))
        if re.search("[\u0370-\u04ff]", t):
            t = t.translate(LOOKALIKES)
        t = MARKS.sub("", unicodedata.normalize("NFKD", t))
    t = t.casefold()
    return PARTED.sub(lambda m: re.sub(r"[^\w]|_", "", m.group(0)), t)


_words: dict[str, str] = {}


def word(token: str) -> str:
    """Disguises of a word undone: leet digits, stretched letters; stars stay."""
    found = _words.get(token)
    if found is None:
        if len(_words) > 500_000:
            _words.clear()
        found = _words[token] = _word(token)
    return found


def _word(token: str) -> str:
    if re.search(r"[^\W\d_]", token):
        core = re.sub(r"[!.]+$", "", token)
        if re.search(r"[0134578@$!€+]", core) and not re.fullmatch(r"\d+[^\W\d_]{1,2}", core):
            core = core.translate(LEET)
        token = core
    token = re.sub(r"[^\w*]|_", "", token)
    return re.sub(r"([^\W\d_])\1+", r"\1", token)


def sentences(text: str) -> list[str]:
    """Sentences of a text with its disguises undone; those without marks that
    run on are read in overlapping windows of words."""
    out = []
    for s in (p.strip() for p in END.split(plain(text))):
        ws = s.split()
        if len(ws) <= WINDOW + WINDOW // 2:
            out += [s] if s else []
        else:
            out += [" ".join(ws[i : i + WINDOW]) for i in range(0, len(ws) - WINDOW // 2, WINDOW // 2)]
    return out


def tokens(sentence: str) -> list[str]:
    """Words of a sentence that has been through ``sentences``."""
    out = []
    for t in TOKEN.findall(sentence):
        w = word(t)
        if w:
            out.append("0" if w.isdigit() else w)
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) & ((1 << BITS) - 1)


STEMS = tuple(sorted({word(s) for s in COARSE}))


def word_features(w: str) -> list[tuple[int, float]]:
    """The word and its letter sequences; a star stands for no letter."""
    out = [(_slot("w" + w), 1.0)]
    if w.startswith(STEMS):
        out.append((_slot("coarse"), 1.0))
    if len(w) > 2:
        edged = f"^{w}$"
        grams = {edged[i : i + n] for n in (3, 4) for i in range(len(edged) - n + 1)}
        grams = {g for g in grams if "*" not in g}
        share = 1.0 / max(1.0, len(grams)) ** 0.5
        out += [(_slot("g" + g), share) for g in sorted(grams)]
    return out


def pair_feature(a: str, b: str) -> int:
    return _slot(f"p{a} {b}")


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """Sentence weights and bias from document labels through the noisy-or."""
    weights, bias = np.zeros(1 << BITS, np.float32), -4.0
    if len(set(labels)) < 2:
        return weights, -1e3
    # a unit is a word or a pair of neighbours; sentences are bags of units
    units: dict[str, int] = {}
    owner, slot, share = [], [], []

    def unit(name: str, feats) -> int:
        if name not in units:
            units[name] = k = len(units)
            for c, x in feats():
                owner.append(k)
                slot.append(c)
                share.append(x)
        return units[name]

    row, use, bag = [], [], []
    for d, t in enumerate(texts):
        for s in sentences(t or "") or [""]:
            ws = tokens(s)
            ids = [unit(w, lambda w=w: word_features(w)) for w in ws]
            ids += [unit(f"{a} {b}", lambda a=a, b=b: [(pair_feature(a, b), 0.7)]) for a, b in zip(ws, ws[1:])]
            row += [len(bag)] * len(ids)
            use += ids
            bag.append(d)
    used, col = np.unique(np.array(slot, np.int64), return_inverse=True)
    o, x, r, u, b = np.array(owner), np.array(share), np.array(row), np.array(use), np.array(bag)
    y = np.array(labels, np.float64)
    w = np.zeros(len(used))
    m1, m2 = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, ROUNDS + 1):
        of_unit = np.bincount(o, x * w[col], len(units))
        z = np.bincount(r, of_unit[u], len(b)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log of the chance that no sentence of the bag offends
        doc = -np.expm1(np.bincount(b, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)))
        # gradient of the log-likelihood by sentence score
        g = np.where(y > 0, (1 - doc) / np.maximum(doc, 1e-9), -1.0)[b] * p / len(y)
        by_unit = np.bincount(u, g[r], len(units))
        grad = np.append(np.bincount(col, x * by_unit[o], len(used)) - DECAY * w, g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad**2
        move = STEP * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        w += move[:-1]
        bias += float(move[-1])
    weights[used] = w
    return weights, bias


def threshold(texts: list[str], labels: list[int]) -> float:
    """The cut that serves F1 best on documents scored by a model fitted on the
    other half; of equal cuts the middle of the widest gap. 0.5 without enough labels."""
    n = len(texts)
    if n < 40 or sum(labels) < 10:
        return THRESHOLD
    scores = np.zeros(n)
    for half in (0, 1):
        kept = [k for k in range(n) if k % 2 != half]
        scorer = Scorer(*fit([texts[k] for k in kept], [labels[k] for k in kept]))
        for k in range(half, n, 2):
            scores[k] = scorer.document(texts[k])[0]
    y = np.array(labels)
    order = np.argsort(-scores)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, n + 1) + y.sum())
    k = int(np.argmax(f1))
    below = scores[order[k + 1]] if k + 1 < n else 0.0
    return float(np.clip(np.sqrt(max(scores[order[k]], 1e-4) * max(below, 1e-4)), 0.02, THRESHOLD))


class Scorer:
    """Scores sentences; each word's share is kept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.words: dict[str, float] = {}
        self.pairs: dict[tuple[str, str], float] = {}
        self.known: dict[str, float | None] = {}

    def sentence(self, s: str) -> float | None:
        """Probability that a sentence offends, None if it has no letters;
        sentences that recur in a corpus are scored once."""
        if s not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[s] = self._sentence(s) if re.search(r"[^\W\d_]", s) else None
        return self.known[s]

    def _sentence(self, s: str) -> float:
        z, before = self.bias, None
        for w in tokens(s):
            x = self.words.get(w)
            if x is None:
                if len(self.words) > 500_000:
                    self.words.clear()
                x = self.words[w] = float(sum(self.weights[c] * v for c, v in word_features(w)))
            z += x
            if before is not None:
                y = self.pairs.get((before, w))
                if y is None:
                    if len(self.pairs) > 1_000_000:
                        self.pairs.clear()
                    y = self.pairs[before, w] = 0.7 * float(self.weights[pair_feature(before, w)])
                z += y
            before = w
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))

    def document(self, text: str | None, cut: float = THRESHOLD) -> tuple[float, list[str]]:
        """Noisy-or of the sentences, and the sentences that offend."""
        clean, bad = 1.0, []
        for s in sentences(text or ""):
            p = self.sentence(s)
            if p is None:
                continue
            clean *= 1 - p
            if p >= cut:
                bad.append(s)
        return 1 - clean, bad


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, float]:
    """Weights, bias and cut, fitted on at most ``sample`` labelled documents, lowest hash first."""
    rows = (
        labels.select("doc_id", "abusive").where(F.col("abusive").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        .join(documents.select("doc_id", "text"), "doc_id")
        .select("doc_id", "text", "abusive").collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    texts, ys = [r["text"] or "" for r in rows], [int(r["abusive"] > 0) for r in rows]
    return *fit(texts, ys), threshold(texts, ys)


def score_documents(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, model: tuple[np.ndarray, float, float] | None = None) -> DataFrame:
    """(doc_id, source, score, abusive, offending): every document's score,
    whether it reaches the cut, and the sentences that offend; ``model`` is what
    ``train`` gave, if it was trained before."""
    weights, bias, cut = model or train(documents, labels, sample)
    packed = documents.sparkSession.sparkContext.broadcast((weights, bias))  # 2^17 weights, whatever the corpus

    def run(batches):
        scorer = Scorer(*packed.value)
        for pdf in batches:
            got = [scorer.document(t if isinstance(t, str) else None, cut) for t in pdf["text"]]
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "source": pdf["source"], "score": [g[0] for g in got], "abusive": [g[0] >= cut for g in got], "offending": [g[1] for g in got]}
            )

    return spread(documents.select("doc_id", "source", "text"), "doc_id").mapInPandas(run, "doc_id bigint, source string, score double, abusive boolean, offending array<string>")


def rates(scored: DataFrame) -> DataFrame:
    """(source, documents, offending, rate) of each source."""
    hit = F.col("abusive").cast("long")
    return scored.groupBy("source").agg(F.count("*").alias("documents"), F.sum(hit).alias("offending"), F.avg(hit.cast("double")).alias("rate"))
