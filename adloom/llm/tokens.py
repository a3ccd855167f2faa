"""Token ids of whole texts by a public byte-level BPE vocabulary.

Speculate and verify: a text is cut into words by the tokenizer's pattern; for
words not met before, greedy longest match proposes tokens; a vectorised check
then looks every adjacent pair up in the table of compatible pairs (a pair is
compatible if merging its joined bytes gives just that pair); byte-level BPE is
local, so a proposal whose pairs are all compatible is the exact encoding. Only
words that fail are merged exactly, rank by rank.

Defined results: null and empty texts give an empty list; blank texts have the
tokens of their blanks; the strings of special tokens are ordinary text; lone
surrogates are read as U+FFFD; texts of any length are encoded whole. A
vocabulary that lacks a single byte is refused, as words could not be covered.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.session import env_path, spread

#: folder of the vocabulary files; they stay where they are
TOKENIZERS = env_path("ADLOOM_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern that parts words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: words kept in a worker's memory between batches
MEMO = 400_000
#: pairs of tokens whose compatibility is kept; more are settled anew
PAIRS = 2_000_000
#: a word longer than this isn't kept
MEMO_LENGTH = 64


class Encoder:
    """Byte-level BPE over a rank file."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        for line in Path(path).read_bytes().splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        if absent := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"{path} has no token for bytes {absent[:5]}")
        self.size = max(self.ranks.values()) + 1
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(PATTERN)
        self.memo: dict[str, list[int]] = {}
        # pair keys whose compatibility is known, sorted, and the answers
        self.keys = np.empty(0, np.int64)
        self.fits = np.empty(0, bool)

    def merge(self, word: bytes) -> list[int]:
        """Exact merging by lowest rank first, leftmost of equals.

        Neighbours are linked and the pairs wait in a heap, so a word of n
        bytes takes n log n steps."""
        import heapq

        n = len(word)
        if n < 2:
            return [self.ranks[word]] if n else []
        end = list(range(1, n + 1))  # part starting at i ends at end[i]
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := self.ranks.get(word[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := self.ranks.get(word[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return out

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        out, i, n = [], 0, len(word)
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                r = self.ranks.get(word[i:j])
                if r is not None:
                    out.append(r)
                    i = j
                    break
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Which pair keys (left * size + right) stand as they are; new ones
        are settled by exact merging once."""
        if len(self.keys) > PAIRS:
            self.keys, self.fits = np.empty(0, np.int64), np.empty(0, bool)
        unique = np.unique(pairs)
        new = np.setdiff1d(unique, self.keys, assume_unique=True)
        if len(new):
            answers = np.fromiter(
                (self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b] for a, b in zip((new // self.size).tolist(), (new % self.size).tolist())), bool, len(new)
            )
            keys, fits = np.concatenate([self.keys, new]), np.concatenate([self.fits, answers])
            order = np.argsort(keys)
            self.keys, self.fits = keys[order], fits[order]
        return self.fits[np.searchsorted(self.keys, pairs)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words: propose, verify all pairs at once, mend."""
        raw = [w.encode("utf-8", "replace") for w in words]
        guess = [[self.ranks[b]] if b in self.ranks else self.propose(b) for b in raw]
        lengths = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter((t for g in guess for t in g), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(guess)), lengths)
        inner = owner[:-1] == owner[1:]
        pairs = (flat[:-1] * self.size + flat[1:])[inner]
        bad = np.unique(owner[:-1][inner][~self.compatible(pairs)]) if len(pairs) else []
        for k in bad:
            guess[k] = self.merge(raw[k])
        return guess

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of whole texts."""
        cut = [self.split.findall(t.encode("utf-8", "replace").decode("utf-8")) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list({w for words in cut for w in words} - self.memo.keys())
        fresh = dict(zip(new, self.encode_words(new)))
        self.memo.update((w, g) for w, g in fresh.items() if len(w) <= MEMO_LENGTH)
        memo = self.memo
        out = []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += memo[w] if w in memo else fresh[w]
            out.append(ids)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str, shipped: bool = False) -> Encoder:
    """One encoder per worker process and file; a shipped file lies where Spark put it."""
    if path not in _encoders:
        _encoders[path] = Encoder(SparkFiles.get(Path(path).name) if shipped else path)
    return _encoders[path]


def encode_corpus(df: DataFrame, ident: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(ident, ids) of every row: a narrow pass, nothing is shuffled beyond an
    even spread of inputs that come in few splits."""
    path = f"{folder}/{tokenizer}.tiktoken"
    # executors need no folder of their own: the driver's file goes with the job
    shipped = Path(path).exists()
    if shipped:
        df.sparkSession.sparkContext.addFile(path)

    def run(batches):
        enc = encoder(path, shipped)
        for pdf in batches:
            yield pd.DataFrame({"i": pdf["i"], "ids": enc.encode([t if isinstance(t, str) else None for t in pdf["t"]])})

    inner = spread(df.select(F.col(f"`{ident}`").alias("i"), F.col(f"`{text}`").alias("t")), "i")
    kind = df.schema[ident].dataType
    out = inner.mapInPandas(run, T.StructType([T.StructField("i", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.select(F.col("i").alias(ident), "ids")
