"""Regression trees grown on all rows (M7), with the splits that MLlib's trees have.

MLlib sends a histogram of every feature for every node, ships the growing tree to all tasks and
keeps it on the driver.  Fully grown trees have about as many nodes as rows, so that bounds
the rows of a fit.  Here only the *top* of a tree, nodes of more than ``local_rows`` rows, is grown
from histograms, a level a pass.  A node of fewer rows is a *cell*: its rows meet in one task, which grows all that
is below it.  Nodes stay a table; the driver holds the top, and a row per cell.

The rules are MLlib's: split candidates are at most ``bins - 1`` midpoints per feature, at even strides of
the rows (here of all rows, where MLlib draws 10,000); variance impurity; the first
best split in the order of features and thresholds; a node is a leaf at ``depth``, without impurity, or
without gain; two leaves of the same prediction are one.  On up to 10,000 rows the trees are MLlib's, node for
node.  Sums of integer labels are exact, so trees do not depend on how rows are dealt.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.session import materialize

LOCAL_ROWS = 1 << 15       # rows of a node that one task grows on
MOST_CELLS = 500           # about as many cells: beyond LOCAL_ROWS times that, a cell holds more rows
RANGE_VALUES = 1 << 18     # distinct values that a task puts in order
PASS_ROWS = 1 << 14        # rows that end in the top, in a group
EPSILON = 2.0 ** -52

_CELL = ("tree int, cell int, node int, prediction double, rows long, gain double, left int, right int, "
         "feature int, split int, threshold double, level int")


# --------------------------------------------------------------------------- arrays of a tree

def _impurity(n, s, q):
    return (q - s * s / n) / n


def _gain(n, s, q, ln, ls, lq):
    """Variance gain of a split, in the order of MLlib's operations; -inf below 0."""
    rn = n - ln
    gain = _impurity(n, s, q) - ln / n * _impurity(ln, ls, lq) - rn / n * _impurity(rn, s - ls, q - lq)
    return np.where(gain < 0, -np.inf, gain)


class Tree:
    """Nodes as lists, children after their parent: feature -1 without a split, left and right -1 without children."""

    FIELDS = ("feature", "split", "gain", "left", "right", "n", "s", "q", "level")

    def __init__(self, n, s, q, level: int = 0):
        self.parts = {k: [np.array([v])] for k, v in zip(self.FIELDS, (-1, -1, 0.0, -1, -1, n, s, q, level), strict=True)}
        self.size = 1

    def __getattr__(self, name):
        if name in Tree.FIELDS:
            if len(self.parts[name]) > 1:
                self.parts[name] = [np.concatenate(self.parts[name])]
            return self.parts[name][0]
        raise AttributeError(name)

    def split_nodes(self, at, feature, split, gain, ln, ls, lq) -> tuple[np.ndarray, np.ndarray]:
        """Give the nodes ``at`` children; (left, right) ids."""
        k = len(at)
        left = self.size + 2 * np.arange(k)
        for name, v in (("feature", feature), ("split", split), ("gain", gain), ("left", left), ("right", left + 1)):
            getattr(self, name)[at] = v
        both = lambda a, b: np.stack([a, b], axis=1).ravel()
        n, s, q = self.n[at], self.s[at], self.q[at]
        new = {"n": both(ln, n - ln), "s": both(ls, s - ls), "q": both(lq, q - lq), "level": np.repeat(self.level[at] + 1, 2),
               "gain": np.zeros(2 * k)}
        for name in Tree.FIELDS:
            self.parts[name].append(new.get(name, np.full(2 * k, -1)))
        self.size += 2 * k
        return left, left + 1

    def may_split(self, at: np.ndarray, depth: int) -> np.ndarray:
        return (np.abs(_impurity(self.n[at], self.s[at], self.q[at])) >= EPSILON) & (self.level[at] < depth)

    def numbered(self, ends: dict | None = None):
        """(inner, prediction, first id, kept) after leaves of the same prediction are merged; ids in
        preorder.  ``ends``: for a cell its (nodes, whether it is a leaf, prediction)."""
        prediction, size = self.s / self.n, np.ones(self.size, np.int64)
        inner, leaf = self.left >= 0, self.left < 0
        for c, (nodes, alone, value) in (ends or {}).items():
            size[c], leaf[c] = nodes, alone
            if alone:
                prediction[c] = value
        levels = [np.flatnonzero(inner & (self.level == k)) for k in range(int(self.level.min()), int(self.level.max()) + 1)]
        for at in reversed(levels):
            a, b = self.left[at], self.right[at]
            same = leaf[a] & leaf[b] & (prediction[a] == prediction[b])
            prediction[at] = np.where(same, prediction[a], prediction[at])
            inner[at], leaf[at] = ~same, same
            size[at] = np.where(same, 1, 1 + size[a] + size[b])
        first, kept = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        kept[0] = True
        for at in levels:
            at = at[inner[at] & kept[at]]
            first[self.left[at]], first[self.right[at]] = first[at] + 1, first[at] + 1 + size[self.left[at]]
            kept[self.left[at]] = kept[self.right[at]] = True
        return inner, prediction, first, kept


def _best_splits(bins, y, slot, tree: Tree, at):
    """For the nodes ``at`` (rows of ``slot`` k are at the k-th) the first best split: gain, feature, split, ln, ls, lq."""
    n, s, q = tree.n[at], tree.s[at], tree.q[at]
    best = [np.full(len(at), -np.inf), np.full(len(at), -1), np.full(len(at), -1), *np.zeros((3, len(at)))]
    first = np.cumsum(n) - n
    for f in range(bins.shape[1]):
        key = slot.astype(np.int32) * 256 + bins[:, f]
        order = np.argsort(key, kind="stable")
        key = key[order]
        end = np.flatnonzero((key[1:] != key[:-1]) & (key[1:] >> 8 == key[:-1] >> 8))       # last row of a bin, not of a node
        if not len(end):
            continue
        of = key[end] >> 8
        cs, cq = (np.concatenate([[0.0], np.cumsum(v)]) for v in (y[order], y[order] ** 2))
        ln, ls, lq = end + 1 - first[of], cs[end + 1] - cs[first[of]], cq[end + 1] - cq[first[of]]
        gain = _gain(n[of], s[of], q[of], ln, ls, lq)
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        top = np.repeat(np.maximum.reduceat(gain, start), np.diff(np.append(start, len(of))))
        hit = np.flatnonzero(gain == top)
        hit = hit[np.concatenate([[True], of[hit][1:] != of[hit][:-1]])]                    # the first of a node
        hit = hit[gain[hit] > best[0][of[hit]]]
        for b, v in zip(best, (gain, np.full(len(of), f), key[end] & 255, ln, ls, lq), strict=True):
            b[of[hit]] = v[hit]
    return best


def grow(bins: np.ndarray, y: np.ndarray, level: int, depth: int) -> Tree:
    """The tree below a node of these rows, a level at a time for all its nodes."""
    tree = Tree(len(y), y.sum(), (y * y).sum(), level)
    at, slot = np.zeros(1, np.int64), np.zeros(len(y), np.int64)
    if not tree.may_split(at, depth)[0]:
        return tree
    while len(at):
        gain, feature, split, ln, ls, lq = _best_splits(bins, y, slot, tree, at)
        cut = gain > 0
        left, right = tree.split_nodes(at[cut], feature[cut], split[cut], gain[cut], ln[cut].astype(np.int64), ls[cut], lq[cut])
        rows = cut[slot]
        bins, y, slot = bins[rows], y[rows], slot[rows]
        to = np.where(bins[np.arange(len(y)), feature[slot]] <= split[slot], 0, 1) + 2 * (np.cumsum(cut) - 1)[slot]
        child = np.stack([left, right], axis=1).ravel()
        more = tree.may_split(child, depth)
        rows = more[to]
        bins, y, slot, at = bins[rows], y[rows], (np.cumsum(more) - 1)[to[rows]], child[more]
    return tree


def walk(bins: np.ndarray, feature, split, left, right) -> np.ndarray:
    """The node that each row ends at."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        rows = rows[left[at[rows]] >= 0]
        if not len(rows):
            return at
        k = at[rows]
        at[rows] = np.where(bins[rows, feature[k]] <= split[k], left[k], right[k])


# --------------------------------------------------------------------------- columns

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column; nulls, and rows of another length, are nan."""
    out = np.full((len(column), width), np.nan)
    ok = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
    out[ok.to_numpy(zero_copy_only=False)] = column.filter(ok).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def _binned(column: pa.Array, thresholds: list[np.ndarray]) -> np.ndarray:
    x = _matrix(column, len(thresholds))
    return np.stack([np.searchsorted(t, x[:, f]) for f, t in enumerate(thresholds)], axis=1).astype(np.uint8)


def _packed(bins: np.ndarray) -> pa.Array:
    offsets = (np.arange(len(bins) + 1) * bins.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def _unpacked(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


# --------------------------------------------------------------------------- split candidates

def candidates(rows: DataFrame, features: str, width: int, bins: int, total: int) -> list[np.ndarray]:
    """Thresholds of each feature, ``bins - 1`` at most, from the counts of all its values.

    Values are dealt in ranges, a task puts a range in order, and the totals of the ranges before it
    place it.  The k-th threshold is before the first value that stands farther than the one before it from
    k strides.
    """
    values = materialize(rows.select(F.posexplode(features).alias("f", "v")).where("v is not null").groupBy("f", "v").agg(
        F.count("*").alias("n")), "values")
    ranged = materialize(values.repartitionByRange(values.count() // RANGE_VALUES + 1, "f", "v")
                         .withColumn("part", F.spark_partition_id()), "value-ranges")
    ranges = sorted(((r["f"], r["part"], r["n"], r["k"], r["last"]) for r in ranged.groupBy("f", "part").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.max("v").alias("last")).collect()), key=lambda r: r[:2])
    distinct, before, last, so_far = {}, {}, {}, {}
    for f, part, n, k, top in ranges:
        before[f, part] = (so_far.get(f, 0), distinct.get(f, 0), last.get(f, math.nan))
        so_far[f], distinct[f], last[f] = so_far.get(f, 0) + n, distinct.get(f, 0) + k, top
    targets = 2 * np.cumsum(np.full(bins - 1, total / bins))

    def hits(group: pa.Table) -> pa.Table:
        group = group.sort_by([("f", "ascending"), ("v", "ascending")])
        f_, v_, n_ = (group.column(c).to_numpy() for c in ("f", "v", "n"))
        out = []
        for f in np.unique(f_):
            v, n = v_[f_ == f], n_[f_ == f]
            rows_before, place, last_value = before[f, group.column("part")[0].as_py()]
            reached = np.searchsorted(targets, 2 * (rows_before + np.cumsum(n)) - n)     # strides that this value is beyond
            # a value that reaches a stride, and as many after it (and at the start) as thresholds may be due
            some = (np.arange(len(v)) < bins) | (reached > np.concatenate([np.zeros(bins, np.int64), reached])[:len(v)])
            low = np.concatenate([[last_value], v[:-1]])
            out.append(pa.table({"f": np.full(some.sum(), f, np.int32), "place": (place + np.arange(len(v)))[some],
                                 "reached": reached[some].astype(np.int32), "low": low[some], "high": v[some]}))
        return pa.concat_tables(out)

    found = ranged.groupBy("part").applyInArrow(hits, "f int, place long, reached int, low double, high double")
    out: list[list[float]] = [[] for _ in range(width)]
    for r in sorted(found.collect(), key=lambda r: (r["f"], r["place"])):
        if r["place"] and (distinct[r["f"]] <= bins or len(out[r["f"]]) < r["reached"]):
            out[r["f"]].append((r["low"] + r["high"]) / 2)
    return [np.array(t) for t in out]


# --------------------------------------------------------------------------- fitted trees

@dataclass
class GrownTree:
    """A fitted tree: the arrays of its top, and the cells below as a table."""

    top: Tree
    cells: DataFrame                # nodes below the top, numbered by cell
    bases: dict[int, int]           # id of each cell's first node
    thresholds: list[np.ndarray]
    first: tuple                    # (inner, prediction, id, kept) of the top's nodes
    below: np.ndarray               # the top's nodes that are cells
    numNodes: int
    depth: int

    def nodes(self) -> DataFrame:
        """One row per node: node, prediction, rows, gain, left, right (-1 in a leaf), feature, threshold, level."""
        spark = self.cells.sparkSession
        t, (inner, prediction, ids, kept) = self.top, self.first
        rows = [(int(ids[i]), float(prediction[i]), int(t.n[i]), *((float(t.gain[i]), int(ids[t.left[i]]), int(ids[t.right[i]]), int(t.feature[i]),
                 float(self.thresholds[t.feature[i]][t.split[i]])) if inner[i] else (None, -1, -1, None, None)), int(t.level[i]))
                for i in np.flatnonzero(kept) if int(i) not in self.bases]
        kinds = "node int, prediction double, rows long, gain double, left int, right int, feature int, threshold double, level int"
        top = spark.createDataFrame(rows, kinds)
        bases = spark.createDataFrame([(c, b) for c, b in self.bases.items()], "cell int, base int")
        moved = {c: F.when(F.col(c) >= 0, F.col(c) + F.col("base")).otherwise(F.col(c)) for c in ("node", "left", "right")}
        return self.cells.join(bases, "cell").withColumns(moved).select(*top.columns).union(top)

    def transform(self, rows: DataFrame, features: str, prediction: str) -> DataFrame:
        """``rows`` with the prediction of the leaf each ends at; rows meet the nodes of their cell."""
        thresholds, width, ends = self.thresholds, len(self.thresholds), self.first[1]
        feature, split, left, right = (getattr(self.top, c) for c in ("feature", "split", "left", "right"))
        is_cell = self.below
        names = [c for c in rows.columns if c != prediction]

        def place(batches):
            for b in batches:
                columns = dict(zip(b.schema.names, b.columns, strict=True))
                bins = _binned(columns[features], thresholds)
                at = walk(bins, feature, split, left, right)
                cell = np.where(is_cell[at], at, -1 - columns["_cell"].to_numpy())
                yield pa.RecordBatch.from_arrays([*(columns[c] for c in names), pa.array(ends[at]), pa.array(cell), _packed(bins)],
                                                 names=[*names, prediction, "_cell", "_bins"])

        def descend(asked: pa.Table, nodes: pa.Table) -> pa.Table:
            out = asked.select([*names, prediction])
            if not nodes.num_rows or not asked.num_rows:
                return out
            nodes = nodes.sort_by("node")
            f, s, a, b, p = (nodes.column(c).fill_null(-1).to_numpy() for c in ("feature", "split", "left", "right", "prediction"))
            at = walk(_unpacked(asked.column("_bins"), width), f, s, a, b)
            return out.set_column(len(names), prediction, pa.array(p[at]))

        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema.fields] + [f"`{prediction}` double"]
        # rows that end in the top need no cell: they pass in groups of their own
        groups = F.lit(int(self.top.n[0]) // PASS_ROWS + 1)
        placed = rows.select(*names, F.pmod(F.xxhash64(*names), groups).alias("_cell")).mapInArrow(place, ", ".join([*kinds, "_cell long", "_bins binary"]))
        nodes = self.cells.select(F.col("cell").cast("long").alias("_cell"), "node", "feature", "split", "left", "right", "prediction")
        return placed.groupBy("_cell").cogroup(nodes.groupBy("_cell")).applyInArrow(descend, ", ".join(kinds))


def _histograms(binned: DataFrame, width: int, tops: list[Tree], open_: list[np.ndarray], slots: int) -> list:
    """The first best split of every open node, from one pass over the rows."""
    arrays = [(t.feature, t.split, t.left, t.right, t.size) for t in tops]
    first = np.cumsum([0, *map(len, open_)])
    cells = width * slots

    def count(batches):
        total = [np.zeros((len(o), 3, cells)) for o in open_]
        for b in batches:
            bins = _unpacked(b.column(0), width)
            for k, (feature, split, left, right, size) in enumerate(arrays):
                if not len(open_[k]):
                    continue
                slot = np.full(size, -1)
                slot[open_[k]] = np.arange(len(open_[k]))
                slot = slot[walk(bins, feature, split, left, right)]
                some = slot >= 0
                y = np.repeat(b.column(1 + k).to_numpy()[some], width)
                key = (slot[some][:, None] * cells + np.arange(width)[None, :] * slots + bins[some]).ravel()
                for j, weight in enumerate((None, y, y * y)):
                    total[k][:, j] += np.bincount(key, weight, len(open_[k]) * cells).reshape(-1, cells)
        for k, t in enumerate(total):
            for i in range(len(t)):
                if t[i, 0].any():
                    yield pa.RecordBatch.from_arrays([pa.array([int(first[k] + i)], pa.int32()), pa.array([t[i].tobytes()], pa.binary())], names=["node", "h"])

    def best(group: pa.Table) -> pa.Table:
        h = np.zeros((3, width, slots))
        for v in group.column("h"):
            h += np.frombuffer(v.as_buffer(), np.float64).reshape(h.shape)
        n, s, q = h[:, 0].sum(axis=1)
        ln, ls, lq = np.cumsum(h, axis=2)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((ln > 0) & (ln < n), _gain(n, s, q, ln, ls, lq), -np.inf)
        f, b = np.unravel_index(gain.argmax(), gain.shape)                    # the first of the greatest
        return pa.table({"node": group.column("node").slice(0, 1), "gain": pa.array([gain[f, b]]), "feature": pa.array([f], pa.int32()),
                         "split": pa.array([b], pa.int32()), **{c: pa.array([v[f, b]]) for c, v in (("ln", ln), ("ls", ls), ("lq", lq))}})

    found = binned.mapInArrow(count, "node int, h binary").groupBy("node").applyInArrow(
        best, "node int, gain double, feature int, split int, ln double, ls double, lq double")
    return sorted(found.collect(), key=lambda r: r["node"])


def grow_trees(train: DataFrame, labels: list[str], features: str, depth: int, bins: int,
               local_rows: int | None = None) -> list[GrownTree]:
    """A tree per label, grown side by side on all rows of ``train``."""
    rows = train.select(features, *[F.col(c).cast("double").alias(f"_y{k}") for k, c in enumerate(labels)])
    total, width = rows.agg(F.count("*"), F.max(F.size(features))).first()
    if not total:
        raise ValueError("a tree needs rows to be fitted on")
    bins, local = min(bins, total), local_rows or max(LOCAL_ROWS, total // MOST_CELLS)
    thresholds = candidates(rows, features, width, bins, total)
    slots = max(len(t) for t in thresholds) + 1

    def bin_(batches):
        for b in batches:
            y = [b.column(1 + k) for k in range(len(labels))]
            if any(np.isnan(v.to_numpy(zero_copy_only=False)).any() for v in y):
                raise ValueError("labels must not be null or nan")
            yield pa.RecordBatch.from_arrays([_packed(_binned(b.column(0), thresholds)), *y], names=["bins", *[f"_y{k}" for k in range(len(y))]])

    kinds = ", ".join(f"_y{k} double" for k in range(len(labels)))
    binned = materialize(rows.mapInArrow(bin_, f"bins binary, {kinds}"), "binned")
    sums = binned.agg(*[F.sum(F.expr(e)) for k in range(len(labels)) for e in (f"_y{k}", f"_y{k} * _y{k}")]).first()
    tops = [Tree(total, sums[2 * k], sums[2 * k + 1]) for k in range(len(labels))]
    cells: list[set[int]] = [set() for _ in labels]

    def sort_out(k: int, at: np.ndarray) -> np.ndarray:
        """Of new nodes those that are still to be split here; small ones become cells."""
        at = at[tops[k].may_split(at, depth)]
        small = tops[k].n[at] <= local
        cells[k] |= {int(i) for i in at[small]}
        return at[~small]

    open_ = [sort_out(k, np.zeros(1, np.int64)) for k in range(len(labels))]
    while any(map(len, open_)):
        where = [(k, int(i)) for k, o in enumerate(open_) for i in o]
        new: list[list[int]] = [[] for _ in labels]
        for r in _histograms(binned, width, tops, open_, slots):
            k, i = where[r["node"]]
            if r["gain"] > 0:
                one = [np.array([r[c]]) for c in ("feature", "split", "gain", "ln", "ls", "lq")]
                one[3] = one[3].astype(np.int64)
                new[k] += [int(c[0]) for c in tops[k].split_nodes(np.array([i]), *one)]
        open_ = [sort_out(k, np.array(new[k], np.int64)) for k in range(len(labels))]

    arrays = [(t.feature, t.split, t.left, t.right, np.isin(np.arange(t.size), list(c))) for t, c in zip(tops, cells, strict=True)]
    levels = [t.level for t in tops]

    def deal(batches):
        for b in batches:
            at = [walk(_unpacked(b.column(0), width), *a[:4]) for a in arrays]
            for k, a in enumerate(arrays):
                some = np.flatnonzero(a[4][at[k]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(at[k][some].astype(np.int32)),
                                                  b.column(0).take(pa.array(some)), b.column(1 + k).take(pa.array(some))], names=["tree", "cell", "bins", "y"])

    def grow_cell(group: pa.Table) -> pa.Table:
        k, cell = group.column("tree")[0].as_py(), group.column("cell")[0].as_py()
        t = grow(_unpacked(group.column("bins"), width), group.column("y").to_numpy(), int(levels[k][cell]), depth)
        inner, prediction, first, kept = t.numbered()
        at = np.flatnonzero(kept)
        inner, f, s = inner[at], t.feature[at], t.split[at]
        flat = np.concatenate([[0], np.cumsum([len(x) for x in thresholds])])
        threshold = np.concatenate([*thresholds, [0.0]])[np.where(inner, flat[f] + s, -1)]
        null = lambda v, kind: pa.array(v, kind, mask=~inner)
        child = lambda c: pa.array(np.where(inner, first[c[at]], -1), pa.int32())
        same = lambda v: pa.array(np.full(len(at), v), pa.int32())
        return pa.table({"tree": same(k), "cell": same(cell), "node": pa.array(first[at], pa.int32()), "prediction": prediction[at],
                         "rows": pa.array(t.n[at], pa.int64()), "gain": null(t.gain[at], pa.float64()), "left": child(t.left), "right": child(t.right),
                         "feature": null(f, pa.int32()), "split": null(s, pa.int32()), "threshold": null(threshold, pa.float64()),
                         "level": pa.array(t.level[at], pa.int32())})

    # dealt by number: the rows are few bytes and much work
    dealt = binned.mapInArrow(deal, "tree int, cell int, bins binary, y double").repartition(max(1, sum(map(len, cells))), "tree", "cell")
    grown = materialize(dealt.groupBy("tree", "cell").applyInArrow(grow_cell, _CELL), "cells")
    ends: list[dict] = [{} for _ in labels]
    deepest: list[dict] = [{} for _ in labels]
    for r in grown.groupBy("tree", "cell").agg(F.count("*").alias("n"), F.max("level").alias("level"),
                                               F.max(F.when(F.col("node") == 0, F.col("prediction"))).alias("p")).collect():
        ends[r["tree"]][r["cell"]] = (r["n"], r["n"] == 1, r["p"])
        deepest[r["tree"]][r["cell"]] = r["level"]
    out = []
    for k, t in enumerate(tops):
        first = t.numbered(ends[k])
        bases = {c: int(first[2][c]) for c in cells[k] if first[3][c]}
        own = int(first[3].sum()) - len(bases)
        out.append(GrownTree(t, grown.where(F.col("tree") == k), bases, thresholds, first, arrays[k][4], own + sum(ends[k][c][0] for c in bases),
                             max([int(t.level[first[3]].max()), *(deepest[k][c] for c in bases)])))
    return out
