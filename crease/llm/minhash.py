"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

The sketch is that of Dahlgaard, Knudsen and Thorup ("Fast similarity
sketching", 2017): in round i every shingle is hashed to a bin and a value
``i + fraction`` and a bin keeps its least value; the first ``t`` rounds pick the
bin at random, round ``t + j`` sends every shingle to bin ``j``, so after
``2 t`` rounds every bin of a non-empty set is full, and the share of equal bins
is concentrated around the Jaccard similarity as with ``t`` independent
min-hashes, at a cost of about ``t log t + n`` rather than ``t n``.

Bands of bins give candidates.  Before a pair is compared in full, two filters set
it aside: the bins' digests, and an odd sketch (Mitzenmacher, Pagh and Pham, 2014):
a bit per hash class, set where the class has an odd number of shingles.  Two sets
whose difference has m shingles differ in at most m of these bits, so that filter
loses nothing.  Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.graph import components
from crease.llm.text import forget_in_worker, mix, shingle_sets
from crease.session import materialize, splittable

BINS = 128
NIBBLES = BINS // 16   # longs of 16 four-bit digests: one digest per bin
ODD_BITS = 2048        # bits of a set's odd sketch
MISS = 1e-6            # accepted chance that a pair at the threshold shares no band
_U = np.uint64
_EMPTY = _U((1 << 64) - 1)


def sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """(sets x bins) sketch of non-empty sorted sets of 64-bit hashes."""
    out = np.full((len(sets), bins), _EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    items = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    low = _U((1 << 47) - 1)
    for i in range(2 * bins):
        if not len(items):
            break
        h = mix(items + _U((i + 1) * 0xA0761D6478BD642F & (1 << 64) - 1))
        where = (h >> _U(48)).astype(np.int64) * bins >> 16 if i < bins else np.full(len(h), i - bins)
        # fractions come from the bits below the bin's; the round stands above them
        np.minimum.at(flat, owner * bins + where, _U(i << 47) | (h & low))
        full = (out != _EMPTY).all(axis=1)
        keep = ~full[owner]
        items, owner = items[keep], owner[keep]
    return out


def banding(threshold: float, bins: int = BINS, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have so that a pair at the threshold
    shares a band with a chance of at least ``1 - miss``."""
    for rows in range(bins, 0, -1):
        if (1 - threshold ** rows) ** (bins // rows) <= miss:
            return bins // rows, rows
    raise ValueError(f"no banding of {bins} bins reaches {miss} at {threshold}")


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _differ_limit(threshold: float, bins: int = BINS) -> int:
    """Most bins in which the four-bit digests of a pair at the threshold differ,
    by five standard deviations."""
    p = (1 - threshold) * 15 / 16
    return math.ceil(bins * p + 5 * math.sqrt(bins * p * (1 - p)))


def _may_link(percent: int, also=None):
    """False only for pairs that can't be linked, from the sizes and odd sketches of
    both (columns x_n, y_n, x_odd, y_odd), but for ``also``.

    With sizes a and b and a difference of m shingles the similarity is
    (a + b - m) / (a + b + m), so a link needs m (100 + percent) <= (a + b) (100 - percent).
    """
    bits = None
    for j in range(ODD_BITS // 64):
        one = F.bit_count(F.col("x_odd")[j].bitwiseXOR(F.col("y_odd")[j]))
        bits = one if bits is None else bits + one
    fits = 100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n")
    if also is not None:                          # a cheaper condition, asked in between
        fits = fits & also
    return fits & (bits * (100 + percent) <= (F.col("x_n") + F.col("y_n")) * (100 - percent))


def _signatures(docs: DataFrame, width: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, n, set_hi, set_lo, bands, nib, odd) of every row; no words: n = 0 and no bands."""
    bands, rows = banding(threshold)

    def run(batches):
        forget_in_worker()
        for b in batches:
            sets = list(shingle_sets(b.column(1), width))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            digests = [_digest(s) for s in sets]
            pair = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            keys = np.zeros((len(sets), bands), dtype=np.uint64)
            nib = np.zeros((len(sets), NIBBLES), dtype=np.uint64)
            odd = np.zeros((len(sets), ODD_BITS // 64), dtype=np.uint64)
            some = np.flatnonzero(n)
            for lo in range(0, len(some), 2048):
                at = some[lo:lo + 2048]
                sk = sketch([sets[i] for i in at])
                acc = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(at), axis=0)
                for r in range(rows):
                    acc = mix(acc * _U(0x9E3779B97F4A7C15) + sk[:, r:bands * rows:rows])
                keys[at] = acc
                four = mix(sk) & _U(15)
                for j in range(16):
                    nib[at] |= four[:, j::16][:, :NIBBLES] << _U(4 * j)
            for i in some.tolist():
                odd[i] = np.packbits(np.bincount((sets[i] >> _U(20)).astype(np.int64) & ODD_BITS - 1, minlength=ODD_BITS) & 1).view(np.uint64)
            as_list = lambda x, keep: pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(keep, x.shape[1], 0))]).astype(np.int32)),
                pa.array(x[keep].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(pair[:, 0]), pa.array(pair[:, 1]),
                 as_list(keys, n > 0), as_list(nib, n > 0), as_list(odd, n > 0)],
                names=["doc_id", "n", "set_hi", "set_lo", "bands", "nib", "odd"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, set_hi long, set_lo long, bands array<long>, nib array<long>, odd array<long>").withColumn(
        "uid", F.monotonically_increasing_id())


def _texts(docs: DataFrame, holder: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, text) of the classes in ``holder`` (cls, doc_id, set_hi, set_lo).

    Of rows that share a doc_id, the one whose set is the class's is taken.
    """
    def run(batches):
        for b in batches:
            same = [_digest(s) == hi.to_bytes(8, "little", signed=True) + lo.to_bytes(8, "little", signed=True)
                    for s, hi, lo in zip(shingle_sets(b.column(1), width), b.column(2).to_pylist(),
                                         b.column(3).to_pylist(), strict=True)]
            yield b.filter(pa.array(same, pa.bool_())).select([0, 1])

    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(
        holder, "doc_id").select(F.col("cls").alias("rep"), "text", "set_hi", "set_lo")
    return materialize(held.mapInArrow(run, "rep long, text string"), "texts")


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int, blocks: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets pass ``100 * |and| >= percent * |or|``.

    Pairs are dealt to (block of a, block of b); a text is sent once to every
    block pair it has a pair in, not once per pair, so a dense group costs its
    members times the blocks.
    """
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    p = pairs.select("a", "b", block("a").alias("p"), block("b").alias("q"))
    need = p.select("p", "q", F.explode(F.array("a", "b")).alias("rep")).distinct()
    rows = need.join(texts, "rep").select("p", "q", "rep", F.lit(None).cast("long").alias("other"), "text").union(
        p.select("p", "q", F.col("a").alias("rep"), F.col("b").alias("other"), F.lit(None).cast("string").alias("text")))

    def run(group: pa.Table) -> pa.Table:
        link = group.column("other").is_valid()
        held, want = group.filter(pc.invert(link)), group.filter(link)
        ids = held.column("rep").to_pylist()
        column = held.column("text").combine_chunks()
        sets = dict(zip(ids, shingle_sets(column, width), strict=True))
        keep_a, keep_b = [], []
        for a, b in zip(want.column("rep").to_pylist(), want.column("other").to_pylist(), strict=True):
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                keep_a.append(a)
                keep_b.append(b)
        return pa.table({"a": pa.array(keep_a, pa.int64()), "b": pa.array(keep_b, pa.int64())})

    return rows.groupBy("p", "q").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", rows_per_block: int = 4000) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when ``100 * intersection >= percent * union`` of
    their sets of ``width``-word shingles; ``component_id`` is the least doc_id
    reachable and ``kept`` marks the document that bears it.

    Documents with equal sets form a class, which is linked in itself and stands
    in every later step as one row, its least doc_id.  Classes that share a band
    are candidates.  Of a band with many classes, first each class is compared
    with the least one; once components are formed, only classes outside a
    band's largest component are compared with the rest of the band, and of these
    only pairs that their odd sketches allow and whose bins' digests differ in no
    more bins than a pair at the threshold could (five standard deviations).
    Links are confirmed on full sets.  So no group emits all its pairs, and no link
    that joins two components is left out but by the sketch's stated chance.

    Null or blank text: no shingles, linked with nothing.  Null doc_id: linked
    with nothing, kept null.  Rows that repeat a doc_id stand for themselves: with
    equal text they are one class.  No rows: no rows.
    """
    threshold = percent / 100
    sig = materialize(_signatures(docs, width, threshold, id_col, text_col), "signatures")
    ided = sig.where("n > 0 and doc_id is not null")
    classes = materialize(ided.groupBy("set_hi", "set_lo").agg(
        F.min_by(F.struct("uid", "n", "bands", "nib", "odd"), F.struct("doc_id", "uid")).alias("r"),
        F.min("doc_id").alias("doc_id")).select(
        "set_hi", "set_lo", "doc_id", F.col("r.uid").alias("cls"), "r.n", "r.bands", "r.nib", "r.odd"), "classes")
    exploded = classes.select("cls", F.posexplode("bands").alias("band", "key"))
    shared = materialize(exploded.groupBy("band", "key").agg(F.min("cls").alias("centre"), F.count("*").alias("k"))
                         .where("k > 1").select("band", "key", "centre"), "shared-bands")
    member = materialize(exploded.join(shared, ["band", "key"]).select("band", "key", "cls", "centre"), "band-members")
    reps = materialize(classes.join(member.select("cls").distinct(), "cls")
                       .select("cls", "doc_id", "n", "bands", "nib", "odd", "set_hi", "set_lo"), "in-play")
    blocks = max(16, math.ceil(reps.count() / rows_per_block))
    texts = _texts(docs, reps.select("cls", "doc_id", "set_hi", "set_lo"), width, id_col, text_col)

    side = lambda x, c: reps.select(F.col("cls").alias(c), F.col("n").alias(f"{x}_n"), F.col("odd").alias(f"{x}_odd"))
    tried = materialize(
        member.where("cls <> centre").select(F.col("centre").alias("a"), F.col("cls").alias("b")).distinct()
        .join(side("x", "a"), "a").join(side("y", "b"), "b").where(_may_link(percent)).select("a", "b"), "star-pairs")
    linked = materialize(_verify(tried, texts, width, percent, blocks), "star-links")
    comp = materialize(components(linked), "star-components")

    placed = member.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select(
        "band", "key", "cls", F.coalesce("component", "cls").alias("comp"))
    sizes = placed.groupBy("band", "key", "comp").agg(F.count("*").alias("k"))
    major = (sizes.groupBy("band", "key").agg(F.max(F.struct("k", "comp")).alias("m"), F.count("*").alias("parts"))
             .where("parts > 1").select("band", "key", F.col("m.comp").alias("major")))
    open_ = materialize(placed.join(major, ["band", "key"]).join(reps.select("cls", "n", "bands", "nib", "odd"), "cls"), "open-bands")
    fields = ("cls", "comp", "n", "bands", "nib", "odd")
    left = open_.where("comp <> major").select("band", "key", *[F.col(c).alias(f"x_{c}") for c in fields])
    right = open_.select("band", "key", "major", *[F.col(c).alias(f"y_{c}") for c in fields])
    earlier = F.exists(F.sequence(F.lit(1), left.band), lambda j: F.col("x_bands")[j - 1] == F.col("y_bands")[j - 1])
    limit = _differ_limit(threshold)
    ones = F.lit(0x1111111111111111)
    differ = None
    for j in range(NIBBLES):
        x = F.col("x_nib")[j].bitwiseXOR(F.col("y_nib")[j])
        some = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(
            F.shiftrightunsigned(x, 3)).bitwiseAND(ones)
        differ = F.bit_count(some) if differ is None else differ + F.bit_count(some)
    rest = (left.join(right, (left.band == right.band) & (left.key == right.key) & (F.col("x_comp") != F.col("y_comp"))
                      # both outside the largest component: only one of the two orders
                      & ((F.col("y_comp") == F.col("major")) | (F.col("x_cls") < F.col("y_cls")))
                      & _may_link(percent, differ <= limit)
                      # a pair comes from the first band that it shares
                      & ((left.band == 0) | ~earlier))
            .select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b")).distinct()
            .join(tried, ["a", "b"], "left_anti"))
    more = _verify(materialize(rest, "rest-pairs"), texts, width, percent, blocks)
    final = components(linked.union(more)).join(reps.select(F.col("cls").alias("node"), "doc_id"), "node")
    names = final.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # a component may hold very many classes: a hot key of this join
    named = materialize(final.join(splittable(names, "component"), "component").select(F.col("node").alias("cls"), "component_id"), "names")
    # of a class in no link, its least member
    of_class = materialize(classes.select("set_hi", "set_lo", "cls", "doc_id").join(named, "cls", "left").select(
        "set_hi", "set_lo", F.coalesce("component_id", "doc_id").alias("component_id")), "class-components")
    out = ided.select("doc_id", "n", "set_hi", "set_lo").join(of_class, ["set_hi", "set_lo"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = sig.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"),
                                                        F.col("doc_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
