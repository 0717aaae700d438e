"""URL filter: stated rules, else logistic regression on hashed character n-grams.

A URL's host and path are cut out by column expressions and met with a list of
rules, the longest that fits deciding.  Where none does, a logistic regression
judges: character n-grams of the host (its ends marked) and of the path are hashed
into ``BUCKETS`` weights each, the counts of either part are divided by the square root of
the part's number of n-grams, and the weights are trained from a small table of
labelled URLs.  Its bias is held at the log-odds of ``PRIOR``, so a URL none of whose
n-grams was seen keeps the assumed share of blocked URLs and is allowed (training itself
gives both classes the same weight).

A row is judged by itself: nothing is shuffled, and the model is ``2 * BUCKETS`` numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm.text import forget_in_worker, mix

SIZES = (3, 4, 5)          # characters of an n-gram
BUCKETS = 1 << 15          # weights of the host's n-grams, and as many of the path's
LABELLED_ROWS = 20_000     # labelled URLs of a fit at most
PRIOR = 0.15               # assumed share of URLs to block
PIECE = 1 << 18            # characters hashed at once
_U = np.uint64

#: (verdict, host and path); a rule fits its host and all subdomains of it
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# The labelled table: what addresses of either kind are about, put into addresses by a rule.
BLOCKED = ("adult", "porn", "xxx", "sexcam", "escort", "casino", "bets", "betting", "poker", "slots", "jackpot", "pills",
           "viagra", "pharma", "spam", "linkfarm", "ads", "adserver", "track", "popunder", "warez", "crack", "phish", "malware")
ALLOWED = ("news", "garden", "school", "library", "recipes", "weather", "museum", "travel", "science", "music", "history",
           "parish", "harbour", "village", "orchestra", "bicycle", "letters", "painting", "kitchen", "forest", "river", "council",
           "theatre", "station", "thinor", "ersthe", "ationes", "ungerei", "ilesont", "ouveste", "landen", "perlora")
_BESIDE = ("free", "cheap", "win", "best", "farm", "club", "hot", "deal")
_FOLDERS = ("en", "de", "fr", "es")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, blocked), made of the words above.

    Addresses come in pairs, one of either kind, that differ in their words alone;
    so prefixes, endings, folders and numbers say nothing.
    """
    rows = []
    for i, w in enumerate(BLOCKED):
        for k in range(4):
            fair, other, near = ALLOWED[(4 * i + k) % 32], ALLOWED[(7 * i + 3 * k + 5) % 32], _BESIDE[(3 * i + k) % 8]
            start = "https://" + ("", "www.", "blog.", "m.")[(i + k) % 4]
            end = (".example.com", ".example.org")[(i + k // 2) % 2]
            path = f"/{_FOLDERS[(i + 2 * k) % 4]}/{(971 * i + 389 * k) % 50_000}" + ("", ".html", "/", "?utm_source=feed")[(i + 3 * k) % 4]
            bad, good = (((w, fair), (f"{near}-{w}", f"{other}-{fair}"), (f"{w}-{near}", f"{fair}-{other}"), (w + near, fair + other)))[k]
            rows += [(start + bad + end + path, 1), (start + good + end + path, 0)]
    return spark.createDataFrame(rows, "url string, blocked int")


# ---- host, path and rules ---------------------------------------------------

def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in small letters; else empty."""
    host = F.regexp_extract(_col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _deciding(host: Column, path: Column, rules, pick) -> Column:
    """``pick`` (rule -> value) of the longest rule that fits; null where none does."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith(start), F.lit(pick(verdict, rule))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (as written); null where none does."""
    return _deciding(host, path, rules, lambda verdict, rule: rule)


def verdict_of(host: Column, path: Column, rules=RULES) -> Column:
    """The verdict of the longest rule that fits; null where none does."""
    return _deciding(host, path, rules, lambda verdict, rule: verdict)


# ---- the regression ---------------------------------------------------------

def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of consecutive texts, the text each belongs to, and how many follow
    in it, some ``PIECE`` characters at a time; a longer text comes in parts that overlap
    by an n-gram less a character, whose repeated characters follow none."""
    reach = max(SIZES) - 1
    points, owner, left, held = [], [], [], 0

    def flush():
        flat = np.frombuffer("".join(points).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return flat, np.concatenate(owner), np.concatenate(left)

    for i, text in enumerate(texts):
        for lo in range(0, len(text), PIECE):
            part = text[lo:lo + PIECE + reach]
            points.append(part)
            owner.append(np.full(len(part), i, dtype=np.int64))
            room = np.arange(len(part), 0, -1)
            room[PIECE:] = 0                       # the next part counts the n-grams that begin there
            left.append(room)
            held += len(part)
            if held >= PIECE:
                yield flush()
                points, owner, left, held = [], [], [], 0
    if points:
        yield flush()


def ngrams(texts: list[str], first: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every n-gram occurrence of the texts, piece by piece;
    buckets count from ``first``."""
    for points, owner, left in _pieces(texts):
        wide = np.concatenate([points.astype(np.uint64) + _U(1), np.zeros(max(SIZES), np.uint64)])
        acc = np.zeros(len(points), dtype=np.uint64)
        for n in range(1, max(SIZES) + 1):
            acc = mix(acc + wide[n - 1:n - 1 + len(points)] * _U(0x9E3779B97F4A7C15))
            if n in SIZES:
                at = np.flatnonzero(left >= n)
                yield owner[at], (mix(acc[at] + _U(n)) % _U(BUCKETS)).astype(np.int64) + first


def _parts(hosts: list[str], paths: list[str]) -> list[tuple[list[str], int]]:
    return [([f"^{h}$" if h else "" for h in hosts], 0), (paths, BUCKETS)]


def logits(hosts: list[str], paths: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds that each URL is to be blocked."""
    z = np.full(len(hosts), bias)
    for texts, first in _parts(hosts, paths):
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for of, bucket in ngrams(texts, first):
            total += np.bincount(of, weights[bucket], len(texts))
            count += np.bincount(of, minlength=len(texts))
        z += total / np.sqrt(np.maximum(count, 1))
    return z


def fit(labelled: DataFrame, rows: int = LABELLED_ROWS, prior: float = PRIOR, l2: float = 3e-3,
        rounds: int = 300) -> dict:
    """``{"weights": array, "bias": b}`` from a table (url, blocked 0/1).

    At most ``rows`` labelled URLs are used, those whose hashes are lowest; rows with
    a null url or label are left out, and of rows that share a URL one counts, blocked if any is.
    Classes weigh the same.  Without rows of both kinds no n-gram says anything: every URL gets the prior.
    """
    one = (labelled.where("url is not null and blocked is not null").groupBy("url").agg(F.max("blocked").alias("blocked"))
           .orderBy(F.xxhash64("url"), "url").limit(rows))
    got = one.select(host_of("url").alias("h"), path_of("url").alias("p"), "blocked").collect()      # at most ``rows`` rows
    y = np.array([r["blocked"] for r in got], dtype=np.float64)
    bias, weights = math.log(prior / (1 - prior)), np.zeros(2 * BUCKETS)
    if not len(y) or y.min() == y.max():
        return {"weights": weights, "bias": bias}
    row, col, value = [], [], []
    for texts, first in _parts([r["h"] for r in got], [r["p"] for r in got]):
        pairs = list(ngrams(texts, first))
        of, bucket = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
        row.append(of)
        col.append(bucket)
        value.append(1 / np.sqrt(np.maximum(np.bincount(of, minlength=len(y)), 1))[of])
    row, col, value = np.concatenate(row), np.concatenate(col), np.concatenate(value)
    names, col = np.unique(col, return_inverse=True)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    theta, m, v = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    for k in range(1, rounds + 1):
        z = np.bincount(row, theta[col] * value, len(y))          # classes weigh the same here: no bias
        pull = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * share
        grad = np.bincount(col, pull[row] * value, len(names)) + 2 * l2 * theta / len(names) ** 0.5
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= 0.05 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    weights[names] = theta
    return {"weights": weights, "bias": bias}


def judge(pages: DataFrame, model: dict, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row: ``page_id, host, path, rule, verdict, score``.

    ``rule`` is the longest rule that fits, else null; ``verdict`` is the rule's, else
    ``block`` where ``score``, the regression's chance that the URL is to be blocked, is at
    least 0.5, else ``allow``.  A null URL, or one without ``://``, has empty host and
    path: no rule fits, and it gets the prior (allow).  A null id stays null;
    repeated rows are judged each for itself; no rows: no rows.
    """
    shipped = pages.sparkSession.sparkContext.broadcast(model)      # 2 * BUCKETS numbers
    host, path = F.col("host"), F.col("path")
    cut = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    ruled = cut.select("page_id", "host", "path", rule_of(host, path, rules).alias("rule"), verdict_of(host, path, rules).alias("verdict"))

    def run(batches):
        forget_in_worker()
        weights, bias = shipped.value["weights"], shipped.value["bias"]
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                z = logits(part.column(1).to_pylist(), part.column(2).to_pylist(), weights, bias)
                score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield part.append_column("score", pa.array(score))

    scored = ruled.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, score double")
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("verdict", own))
