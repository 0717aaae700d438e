"""Counterfactual-regularised toxicity classifier.

Features are the words of a text and their prefixes of three to six letters (so
inflected insults share a feature), present or not.  Features are chosen by
the significance of their log-odds on a bounded sample of labelled rows, then a
logistic regression is fitted in numpy with a penalty on score changes: every
sampled text that names an identity group gets copies in which the term is
swapped for the other terms of its set, and the squared change of the logit is
added to the loss.  So a neutral mention of a group can't earn a high score.

Groups are named by stated terms in four languages and by learnt ones: words that most
often are said neutrally, yet stand beside insults in the sample more often than other
such words do (the targets of abuse, whatever the language).  These are the words that a
classifier would learn to hold against a text.  Learnt terms of like standing form sets.
"""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.text import keep_in_worker
from crease.session import materialize

#: Sets of identity terms (English, German, French, Spanish); a term may stand for any other of its set.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("moslem", "christ", "jude", "katholik", "buddhist"), ("muslimisch", "christlich", "jüdisch", "katholisch"),
    ("musulman", "chrétien", "juif", "catholique", "bouddhiste"), ("musulmán", "cristiano", "judío", "católico", "budista"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("schwarze", "weiße", "asiatische", "afrikanische"), ("noir", "blanc", "asiatique", "africain", "arabe"),
    ("negro", "blanco", "asiático", "africano", "árabe"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"), ("schwul", "lesbisch", "bisexuell", "hetero"),
    ("homosexuel", "lesbienne", "bisexuel", "hétéro"), ("homosexual", "lesbiana", "heterosexual"),
    ("man", "woman"), ("men", "women"), ("male", "female"), ("boy", "girl"), ("mann", "frau"), ("männer", "frauen"),
    ("homme", "femme"), ("hommes", "femmes"), ("hombre", "mujer"), ("hombres", "mujeres"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("einwanderer", "flüchtling", "ausländer", "bürger"),
    ("immigré", "réfugié", "étranger", "citoyen"), ("inmigrante", "refugiado", "extranjero", "ciudadano"),
    ("disabled", "blind", "deaf", "elderly", "young"), ("behindert", "taub", "alt", "jung"),
    ("handicapé", "aveugle", "sourd", "âgé", "jeune"), ("discapacitado", "ciego", "sordo", "anciano", "joven"),
)
LEARNT = 48                # learnt terms at most, in sets of ``LEARNT_SET``
LEARNT_SET = 3
NEUTRAL = 3.0              # a word whose texts are toxic at most so many times as often as all are is said neutrally too
MIN_SHARE = 0.002          # share of the sample's texts that a learnt term must occur in
BESIDE = 2                 # words between a term and an insult at most
SAMPLE_ROWS = 20_000       # labelled rows of the fit
MAX_FEATURES = 4096        # size of the model
MIN_DOCS = 5               # texts a feature must occur in
MIN_Z = 4.0                # significance a feature must have
CACHE = 250_000            # words whose features a worker remembers (some 140 bytes each)

_WORD = re.compile(r"[^\W\d_]+")


def places(sets) -> dict[str, tuple[tuple[str, ...], int]]:
    """Term -> its set and its place there; a term of several sets keeps the first."""
    out: dict[str, tuple[tuple[str, ...], int]] = {}
    for one in sets:
        for i, term in enumerate(one):
            out.setdefault(term, (tuple(one), i))
    return out


def word_features(word: str) -> list[int]:
    """Feature numbers of a word in lower case: itself and its prefixes."""
    return [zlib.crc32(b"w" + word.encode())] + [
        zlib.crc32(b"p" + word[:n].encode()) for n in range(3, 7) if len(word) >= n]


class Vocabulary(dict):
    """Token -> features of interest of its words; forgets all when full."""

    def __init__(self, wanted=None):
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = {f for w in _WORD.findall(token) for f in word_features(w)}
        self[token] = out = tuple(found if self.wanted is None else found.intersection(self.wanted))
        return out


def text_features(text: str | None, vocabulary: Vocabulary) -> set[int]:
    return set().union(*map(vocabulary.__getitem__, set((text or "").lower().split())))


def counterfactuals(text: str, terms: dict | None = None) -> list[str]:
    """The text with every identity term moved on by 1, 2, ... places in its set."""
    terms = places(IDENTITY) if terms is None else terms
    met = {t for t in _WORD.findall(text.lower()) if t in terms}
    if not met:
        return []

    def moved(k):
        def swap(m):
            held = terms.get(m[0].lower())
            return m[0] if held is None else held[0][(held[1] + k) % len(held[0])]
        return swap

    return [_WORD.sub(moved(k), text) for k in range(1, max(len(terms[t][0]) for t in met))]


def learn_terms(sample: DataFrame, rows: int, toxic: int) -> tuple[tuple[str, ...], ...]:
    """Sets of words that are mostly said neutrally and stand beside insults (see above).

    A word's standing is the share of its texts in which an insult is at most
    ``BESIDE`` words away; the ``LEARNT`` of greatest standing form sets in that order.  The
    results sent to the driver are bounded by ``LEARNT`` and the numbers below.
    """
    def count(batches):
        n, t = collections.Counter(), collections.Counter()
        for b in batches:
            for label, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                met = set(_WORD.findall((text or "").lower()))
                n.update(met)
                if label:
                    t.update(met)
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array([t[w] for w in n], pa.int64()),
                                              pa.array(n.values(), pa.int64())], names=["w", "t", "n"])
            n.clear()
            t.clear()

    p = toxic / rows
    words = materialize(sample.mapInArrow(count, "w string, t long, n long").groupBy("w").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
                        .where(F.col("n") >= MIN_DOCS)
                        .withColumn("z", (F.col("t") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))), "toxic-words")
    insults = frozenset(r["w"] for r in words.where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "w").limit(500).collect())
    plain = {r["w"]: r["n"] for r in words.where((F.col("t") <= NEUTRAL * p * F.col("n")) & (F.col("t") < 0.5 * F.col("n")) & (F.col("n") >= MIN_SHARE * rows) & (F.length("w") > 2))
             .orderBy(F.desc("n"), "w").limit(2000).collect()}
    if not insults or not plain:
        return ()

    def beside(batches):
        near = collections.Counter()
        for b in batches:
            for text in b.column(2).to_pylist():
                said = _WORD.findall((text or "").lower())
                at = [i for i, w in enumerate(said) if w in insults]
                near.update({w for i in at for w in said[max(0, i - BESIDE):i + BESIDE + 1] if w in plain})
        yield pa.RecordBatch.from_arrays([pa.array(near.keys(), pa.string()), pa.array(near.values(), pa.int64())], names=["w", "n"])

    near = sample.mapInArrow(beside, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()      # at most 2,000 rows
    best = [w for _, w in sorted((-r["n"] / plain[r["w"]], r["w"]) for r in near)][:LEARNT]
    sets = [tuple(best[i:i + LEARNT_SET]) for i in range(0, len(best), LEARNT_SET)]
    return tuple(x for x in sets if len(x) > 1)


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(key, toxic, text) of the ``rows`` labelled rows whose doc_id hashes lowest;
    labels that contradict each other count as toxic."""
    chosen = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most ``rows`` pairs of numbers
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, penalty: float = 1.0,
        l2: float = 1e-4, rounds: int = 600, identity=IDENTITY, learnt: bool = True) -> dict:
    """``{"bias": b, "weights": {feature: w}, "copies": n, "terms": sets}`` from ``labels`` (doc_id, toxic) of ``docs``:
    ``copies`` says how many swapped copies were held to their texts' scores, ``terms`` by which sets.

    At most ``sample_rows`` labelled rows are used; the model has at most
    ``MAX_FEATURES`` weights, so it stays small whatever the corpus.  Without
    labelled rows of both kinds the score is a constant: high if all are toxic, else low.
    """
    sample = materialize(_sample(docs, labels, sample_rows), "toxic-sample")

    def count(batches):
        vocabulary = Vocabulary()
        for b in batches:
            ids = [np.fromiter(text_features(t, vocabulary), dtype=np.int64) for t in b.column(2).to_pylist()]
            toxic = np.repeat(b.column(1).to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in ids])
            f, at = np.unique(np.concatenate(ids) if ids else np.zeros(0, np.int64), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(np.bincount(at, toxic, len(f)).astype(np.int64)),
                                              pa.array(np.bincount(at, minlength=len(f)).astype(np.int64))], names=["f", "t", "n"])

    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = total["n"], int(total["t"])
    if t == 0 or t == n:
        return {"bias": 4.0 if t else -4.0, "weights": {}, "copies": 0, "terms": ()}
    p = t / n
    chosen = (sample.mapInArrow(count, "f long, t long, n long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
              .where(F.col("n") >= MIN_DOCS)
              .withColumn("z", (F.col("t") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p)))
              .where(F.abs("z") >= MIN_Z).orderBy(F.abs("z").desc(), "f").limit(MAX_FEATURES))
    names = sorted(r["f"] for r in chosen.select("f").collect())         # at most MAX_FEATURES numbers
    number = {f: i for i, f in enumerate(names)}
    sets = tuple(identity) + (learn_terms(sample, n, t) if learnt else ())
    terms = places(sets)

    def select(batches):
        vocabulary = Vocabulary(frozenset(number))
        for b in batches:
            rows = {"toxic": [], "x": [], "of": []}
            for i, (label, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                copies = counterfactuals(text or "", terms)
                for k, v in enumerate([text, *copies]):
                    rows["toxic"].append(label if k == 0 else None)
                    rows["x"].append(sorted(number[f] for f in text_features(v, vocabulary)))
                    rows["of"].append(len(copies) if k == 0 else 0)
            yield pa.RecordBatch.from_arrays([pa.array(rows["toxic"], pa.int64()), pa.array(rows["x"], pa.list_(pa.int64())),
                                              pa.array(rows["of"], pa.int64())], names=["toxic", "x", "copies"])

    # a copy follows its own row within a batch; bounded by sample_rows times the largest set
    got = sample.mapInArrow(select, "toxic long, x array<long>, copies long").toArrow()
    xs = [np.asarray(x, dtype=np.int64) for x in got.column("x").to_pylist()]
    label = np.array([-1 if v is None else v for v in got.column("toxic").to_pylist()])
    own = np.maximum.accumulate(np.where(label >= 0, np.arange(len(label)), 0))
    bias, weights = _train(xs, label, own, len(names), penalty, l2, rounds)
    return {"bias": bias, "weights": {f: float(w) for f, w in zip(names, weights, strict=True) if w != 0.0},
            "copies": int((label < 0).sum()), "terms": sets}


def _train(xs, label, own, width, penalty, l2, rounds) -> tuple[float, np.ndarray]:
    """Adam on the mean log-loss, plus ``penalty`` times the mean squared logit
    change of the copies, plus ``l2`` times the squared weights."""
    row = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    col = np.concatenate(xs) if xs else np.zeros(0, np.int64)
    first = label >= 0
    n, copies = max(1, first.sum()), max(1, (~first).sum())
    theta = np.zeros(width + 1)
    theta[width] = np.log(max(1, (label == 1).sum()) / max(1, (label == 0).sum()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        z = np.bincount(row, theta[col], len(xs)) + theta[width]
        pull = np.where(first, (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) / n, 0.0)
        change = np.where(first, 0.0, 2 * penalty / copies * (z - z[own]))
        both = pull + change - np.bincount(own, change, len(xs))
        grad = np.append(np.bincount(col, both[row], width) + 2 * l2 * theta[:width], pull.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return float(theta[width]), theta[:width]


def score(docs: DataFrame, model: dict, keep: list[str], name: str = "score", text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row and its score: the chance in (0, 1) that it is toxic.

    Null and empty texts get the score of a text without features.
    """
    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([docs.schema[c] for c in keep]).add(name, DoubleType())
    weights, bias = model["weights"], model["bias"]
    wanted = frozenset(weights)
    columns = [F.col(c) for c in keep] + [F.col(text_col).alias("__text")]

    def run(batches):
        vocabulary = keep_in_worker(("toxicity", wanted), lambda: Vocabulary(wanted))
        for b in batches:
            out = []
            for text in b.column(len(keep)).to_pylist():
                z = bias + sum(weights[f] for f in text_features(text, vocabulary))
                out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(out, pa.float64())], names=[*keep, name])

    return docs.select(*columns).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: dict, cutoff: float = 0.5) -> DataFrame:
    """The rows that score below ``cutoff``, with the columns they had."""
    name = "__toxicity"
    while name in docs.columns:                   # a column of that name in the input is kept
        name += "_"
    return score(docs, model, docs.columns, name).where(F.col(name) < cutoff).drop(name)
