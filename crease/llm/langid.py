"""Language identification: word first, backing off to shorter character n-grams.

A known word scores its log frequency in each language.  An unknown word is
covered by character n-grams: from each position the longest known n-gram (five
letters down to one, with word ends marked) scores its log frequency in each
language, and the word gets their mean.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.text import keep_in_worker
from crease.session import materialize

SAMPLE_ROWS = 4000      # labelled rows of the fit
MIN_COUNT = 2           # times a word must occur in the sample to be known
LONGEST = 5             # letters of the longest n-gram
CACHE = 1_000_000         # words whose scores a worker remembers

_WORD = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word whose ends are marked by ``^`` and ``$``."""
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, min_count: int = MIN_COUNT) -> dict:
    """``{"langs": [...], "words": {word: logs}, "grams": {gram: logs}, "floor": logs}``.

    Counts come from at most ``sample_rows`` rows with a language (those whose
    doc_id hashes lowest), so the model's size is bounded by that parameter.
    No such rows: no languages, and every text is ``und``.
    """
    chosen = docs.where("lang is not null and doc_id is not null").select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text", "lang").where("lang is not null").join(F.broadcast(chosen), "doc_id")

    def count(batches):
        for b in batches:
            c: dict = {}
            for text, lang in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                for w in _WORD.findall((text or "").lower()):
                    c[lang, w] = c.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.string()),
                                              pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    counts = materialize(sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word")
                         .agg(F.sum("n").alias("n")), "language-words")

    def split(batches):
        for b in batches:
            c: dict = {}
            for lang, w, k in zip(*[x.to_pylist() for x in b.columns], strict=True):
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        c[lang, g] = c.get((lang, g), 0) + k
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.string()),
                                              pa.array(list(c.values()), pa.int64())], names=["lang", "gram", "n"])

    parts = counts.mapInArrow(split, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    # a word or n-gram must occur min_count times in all; the sample bounds both tables
    enough = lambda t, c: t.groupBy(c).pivot("lang", langs).sum("n").fillna(0).where(
        sum((F.col(f"`{x}`") for x in langs), F.lit(0)) >= min_count) if langs else t.limit(0)
    tables = [enough(counts, "word").toArrow(), enough(parts, "gram").toArrow()] if langs else [None, None]
    out: dict = {"id": uuid.uuid4().hex, "langs": langs, "words": {}, "grams": {}, "floor": []}
    for kind, table in zip(("words", "grams"), tables, strict=True):
        if table is None or not table.num_rows:
            continue
        n = np.stack([table.column(x).to_numpy() for x in langs], axis=1).astype(np.float64)
        logs = np.log((n + 0.1) / (n.sum(axis=0) + 0.1 * len(n))).astype(np.float32)
        out[kind] = (table.column(0).to_pylist(), logs)
    return out


class Scorer(dict):
    """Token -> row of ``self.rows`` (log score by language, and the number of words)."""

    def __init__(self, model: dict):
        self.k = len(model["langs"])
        names, self.logs = {}, {}
        for kind in ("words", "grams"):
            listed, self.logs[kind] = model[kind] or ([], np.zeros((0, self.k), dtype=np.float32))
            names[kind] = {x: i for i, x in enumerate(listed)}
        self.words, self.grams = names["words"], names["grams"]
        self.rows = np.zeros((1024, self.k + 1))
        self.n = 0

    def word(self, w: str) -> np.ndarray:
        at = self.words.get(w)
        if at is not None:
            return self.logs["words"][at]
        marked, known, found = f"^{w}$", self.grams, []
        for i in range(len(marked)):
            for n in range(LONGEST, 0, -1):
                at = known.get(marked[i:i + n])
                if at is not None:
                    found.append(at)
                    break
        # no known letter: says nothing of the language
        return self.logs["grams"][found].sum(axis=0) / len(found) if found else np.zeros(self.k)

    def __missing__(self, token: str) -> int:
        if self.n >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        words = _WORD.findall(token)
        row = self.rows[self.n]
        row[:] = 0
        for w in words:
            row[:self.k] += self.word(w)
        row[self.k] = len(words)
        self[token] = self.n
        self.n += 1
        return self.n - 1

    def text(self, text: str) -> np.ndarray:
        if self.n >= CACHE:
            self.clear()
            self.n = 0
        tokens = text.lower().split()
        at = np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return self.rows[at].sum(axis=0)


def predict(docs: DataFrame, model: dict, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row, ``lang_pred`` and ``score`` (posterior chance).

    A text that is null or has no letter (and any text, when the model knows no
    language) is ``und`` with score 0.  Ties go to the first language by name.
    """
    from pyspark.sql.types import StringType, StructType

    schema = StructType([docs.schema[c] for c in keep]).add("lang_pred", StringType()).add("score", "double")
    langs, key = model["langs"], model["id"]
    shipped = docs.sparkSession.sparkContext.broadcast(model)       # bounded by the sample of the fit

    def run(batches):
        scorer = keep_in_worker(("language", key), lambda: Scorer(shipped.value)) if langs else None
        for b in batches:
            names, scores = [], []
            for text in b.column(len(keep)).to_pylist():
                z = scorer.text(text) if langs and text else None
                if z is None or z[-1] == 0:
                    names.append("und")
                    scores.append(0.0)
                    continue
                best = int(np.argmax(z[:-1]))
                names.append(langs[best])
                scores.append(1 / sum(math.exp(max(-700.0, v - z[best])) for v in z[:-1]))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    return docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text")).mapInArrow(run, schema)
