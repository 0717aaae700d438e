"""Win share of a match from the distribution of each over (M8): exact, without draws.

An over's runs and wickets are distributed as at its leaf of the tree
(``trees.leaf_counts``).  Over by over the joint distribution of an innings' runs and
wickets is the earlier one folded with the over's; an innings stays as it is from ten wickets
on.  Innings with the same leaves in the same order are alike, so each distinct
beginning of such a sequence is folded once, whatever the number of matches, as an
equi-join and an aggregate.  The share of matches that the chase wins then is read
from the two innings' totals, one distinct pair of sequences at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.fixed import OVERS, WICKET_LIMIT
from crease.functions import wicket_discount
from crease.session import materialize, splittable


def over_distribution(counts: DataFrame, runs: str = "total_runs", wickets: str = "total_wickets") -> DataFrame:
    """(leaf, r, w, share) from counts by leaf: runs left after the over's wickets (F3), shares that add up to 1 a leaf."""
    left = wicket_discount(runs, wickets).cast("long")
    return counts.groupBy("leaf", left.alias("r"), F.col(wickets).cast("long").alias("w")).agg(F.sum("share").alias("share"))


def sequences(leaves: DataFrame) -> DataFrame:
    """(match_id, innings, seq): the leaves of an innings' overs in order (at most ``OVERS`` numbers)."""
    at = F.array_sort(F.collect_list(F.struct("over", "leaf")))
    return leaves.where(F.col("over") < OVERS).groupBy("match_id", "innings").agg(
        F.transform(at, lambda x: x["leaf"]).alias("seq"))


def innings_totals(seqs: DataFrame, dist: DataFrame) -> DataFrame:
    """(seq, totals): for each distinct sequence of leaves, the chance of every total as array<double>
    (entry t: of t runs).

    One join and one aggregate for each over of the longest innings, written in turn; a step
    holds a row per distinct beginning, runs and wickets.
    """
    distinct = materialize(seqs.select("seq").distinct(), "sequences")
    longest = distinct.agg(F.max(F.size("seq"))).first()[0] or 0
    dist = materialize(dist, "over-distribution")
    spark = seqs.sparkSession
    state = spark.createDataFrame([("", 0, 0, 1.0)], "begun string, r long, w long, p double")
    done = []
    begun = lambda n: F.array_join(F.slice("seq", 1, n), ",")
    for k in range(1, longest + 1):
        steps = distinct.where(F.size("seq") >= k).select(
            (begun(k - 1) if k > 1 else F.lit("")).alias("before"), begun(k).alias("begun"),
            F.col("seq")[k - 1].alias("leaf")).distinct()
        before = state.withColumnRenamed("begun", "before")
        x = before.join(splittable(steps, "before"), "before").join(splittable(dist.withColumnsRenamed({"r": "dr", "w": "dw"}), "leaf"), "leaf")
        over = F.col("w") >= WICKET_LIMIT                         # all out: the rest of the overs is not played
        state = materialize(x.groupBy(
            "begun", F.when(over, F.col("r")).otherwise(F.col("r") + F.col("dr")).alias("r"),
            F.least(F.when(over, F.col("w")).otherwise(F.col("w") + F.col("dw")), F.lit(WICKET_LIMIT).cast("long")).alias("w"))
            .agg(F.sum(F.col("p") * F.col("share")).alias("p")), "innings-state")
        ends = distinct.where(F.size("seq") == k).select("seq", begun(k).alias("begun"))
        done.append(ends.join(state.groupBy("begun", "r").agg(F.sum("p").alias("p")), "begun").select("seq", "r", "p"))
    if not done:
        return spark.createDataFrame([], "seq array<int>, totals array<double>")
    rows = done[0]
    for more in done[1:]:
        rows = rows.union(more)
    # at most OVERS times an over's most runs: entries between the totals that occur are 0
    sorted_ = F.array_sort(F.collect_list(F.struct("r", "p")))
    dense = F.aggregate(sorted_, F.array().cast("array<double>"), lambda a, x: F.concat(
        a, F.array_repeat(F.lit(0.0), (x["r"] - F.size(a)).cast("int")), F.array(x["p"])))
    return rows.groupBy("seq").agg(dense.alias("totals"))


def win_share(leaves: DataFrame, dist: DataFrame) -> DataFrame:
    """One row per match: ``match_id, expected_1, expected_2, win_1, tie, win_2``.

    ``leaves`` is (match_id, innings, over, leaf), ``dist`` (leaf, r, w, share).  ``expected`` is an
    innings' mean total without the chase's cut; ``win_1`` and ``win_2`` are the chances that a team's total is
    the greater, ``tie`` that they are equal (by the reference's rule team 1's): they add up to 1.
    A chase that stops when it passes the target wins the same matches, as totals never fall.
    An innings without overs has a total of 0.
    """
    seqs = materialize(sequences(leaves), "match-sequences")
    totals = materialize(innings_totals(seqs, dist), "innings-totals")
    none = F.array().cast("array<int>")
    pick = lambda i: F.coalesce(F.max(F.when(F.col("innings") == i, F.col("seq"))), none).alias(f"seq_{i}")
    matches = seqs.groupBy("match_id").agg(pick(1), pick(2))
    pairs = matches.select("seq_1", "seq_2").distinct()
    for i in (1, 2):
        side = totals.select(F.col("seq").alias(f"seq_{i}"), F.col("totals").alias(f"t{i}"))
        pairs = pairs.join(splittable(side, f"seq_{i}"), f"seq_{i}", "left").withColumn(
            f"t{i}", F.coalesce(f"t{i}", F.array(F.lit(1.0))))
    # a pair is a small row but long work: as many partitions as the session shuffles to, which AQE does not merge
    # by size (by a hash, as a shuffle by the pair itself would be taken for that of ``distinct``)
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, F.xxhash64("seq_1", "seq_2"))
    top = F.greatest(F.size("t1"), F.size("t2")) - 1
    at = lambda t, r: F.coalesce(F.get(F.col(t), r), F.lit(0.0))
    names = ("above_1", "above_2", "win_1", "win_2", "tie", "e1", "e2")
    start = F.struct(*[F.lit(0.0).alias(n) for n in names])

    def lower(a, r):
        """One total down: ``above`` is the chance that a team makes more than ``r``."""
        p, q = at("t1", r), at("t2", r)
        now = (a["above_1"] + p, a["above_2"] + q, a["win_1"] + q * a["above_1"], a["win_2"] + p * a["above_2"],
               a["tie"] + p * q, a["e1"] + p * r, a["e2"] + q * r)
        return F.struct(*[c.alias(n) for c, n in zip(now, names, strict=True)])

    read = F.aggregate(F.sequence(top, F.lit(0)), start, lower)
    shares = pairs.select("seq_1", "seq_2", read.alias("_s"))
    x = matches.join(splittable(shares, "seq_1", "seq_2"), ["seq_1", "seq_2"])
    s = F.col("_s")
    return x.select("match_id", s["e1"].alias("expected_1"), s["e2"].alias("expected_2"),
                    s["win_1"].alias("win_1"), s["tie"].alias("tie"), s["win_2"].alias("win_2"))
