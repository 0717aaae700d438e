"""Ordered state over a ball log, as running aggregates.

The reference keeps this state in Python loops over single balls.  The same
rules are written here as prefix sums, products and maxima over a strictly
ordered log (match, innings, ball_no), all through
:func:`crease.operators.running.running_aggregates`, which splits a long
innings into chunks instead of sending it whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.fixed import BALLS_PER_OVER, OVERS, SURVIVAL_CUT, TIE_WINNER, WICKET_LIMIT
from crease.functions import odd
from crease.operators.running import Running, running_aggregates
from crease.session import splittable

CHUNK_BALLS = 4096


def ball_chunk(order: str = "ball_no", size: int = CHUNK_BALLS) -> Column:
    """Chunk id of a 1-based ball number."""
    return F.floor((F.col(order) - 1) / size)


def over_of(ball_no: str | Column = "ball_no") -> Column:
    """0-based over of a 1-based ball number."""
    b = F.col(ball_no) if isinstance(ball_no, str) else ball_no
    return F.floor((b - 1) / BALLS_PER_OVER).cast("int")


def dismissal_points(log: DataFrame, stay: list[str] | None = None, order: str = "ball_no",
                     p: str = "p_survive", cut: float = SURVIVAL_CUT) -> DataFrame:
    """First ball of each stay where the running survival product is <= ``cut``.

    A stay is (match, innings, batsman); the product restarts for each stay.
    Stays that never reach the cut give no row.
    """
    stay = stay or ["match_id", "innings", "batsman"]
    x = running_aggregates(log, stay, [order], ball_chunk(order),
                           [Running("survival", "product", p)])
    return (x.filter(F.col("survival") <= cut).groupBy(*stay)
            .agg(F.min(F.struct(order, "survival")).alias("_first"))
            .select(*stay, F.col(f"_first.{order}").alias("out_ball"),
                    F.col("_first.survival").alias("survival")))


def _cut_specs(wickets: str, runs: str) -> tuple[dict, list[Running]]:
    cols = {"_w": F.col(wickets).cast("long"), "_r": F.col(runs)}
    return cols, [Running("_w_before", "sum", "_w", inclusive=False),
                  Running("_r_before", "sum", "_r", inclusive=False)]


def _bounded_running(x: DataFrame, match: str, innings: str, order: str, specs: list[Running]) -> DataFrame:
    """``specs`` (sums) as plain windows: a match has a few hundred rows at most, so one shuffle
    by match serves these and all that follows within it."""
    w = Window.partitionBy(match, innings).orderBy(order)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    return x.repartition(match).withColumns({
        s.out: F.coalesce(F.sum(s.value).over(upto if s.inclusive else before), F.lit(0)) for s in specs})


def _apply_cut(x: DataFrame, match: str, innings: str, first_innings: int,
               limit: int, order: str, last: int, bounded: bool = False) -> DataFrame:
    """Keep rows of ``x`` (with running _w_before, _r_before, _r) before each innings ends.

    The rows of a bounded match lie together, so its target is a window over them and ``x`` is
    computed once; a NULL match has no target in either form.
    """
    x = x.filter((F.col("_w_before") < limit) & (F.col(order) <= last))
    if bounded:
        first = (F.col(innings) == first_innings) & F.col(match).isNotNull()
        x = x.withColumn("_target", F.sum(F.when(first, F.col("_r"))).over(Window.partitionBy(match)))
    else:
        target = (x.filter(F.col(innings) == first_innings).groupBy(match)
                  .agg(F.sum("_r").alias("_target")))
        x = x.join(splittable(target, match), match, "left")
    keep = ((F.col(innings) == first_innings)
            | (F.col("_r_before") <= F.coalesce(F.col("_target"), F.lit(0))))
    return x.filter(keep).drop("_w", "_r", "_w_before", "_r_before", "_target")


def innings_cutoff(log: DataFrame, match: str = "match_id", innings: str = "innings",
                   order: str = "ball_no", runs: str = "runs", wickets: str = "wicket",
                   first_innings: int = 1, limit: int = WICKET_LIMIT, last: int = OVERS * BALLS_PER_OVER,
                   chunk: Column | None = None, bounded: bool = False) -> DataFrame:
    """Drop the rows after an innings ends.

    An innings ends at its ``limit``-th wicket or with the row numbered ``last``
    (the last ball of its 20 overs, numbered from 1); the second innings also ends
    as soon as its total passes the first innings' total.  The row that ends
    an innings is kept.  ``wickets`` may be a boolean (one ball) or a count
    (one over).  Adds nothing; returns the kept rows.  ``bounded=True`` says
    an innings has a few rows at most (such as its 20 overs): plain windows
    then replace the chunked running sums.
    """
    cols, specs = _cut_specs(wickets, runs)
    x = log.withColumns(cols)
    if bounded:
        x = _bounded_running(x, match, innings, order, specs)
    else:
        chunk = ball_chunk(order) if chunk is None else chunk
        x = running_aggregates(x, [match, innings], [order], chunk, specs)
    return _apply_cut(x, match, innings, first_innings, limit, order, last, bounded)


def strike_reconstruct(log: DataFrame, lineups: DataFrame, match: str = "match_id",
                       innings: str = "innings", order: str = "ball_no", runs: str = "runs",
                       wicket: str = "wicket", cut: bool = False, last: int = OVERS * BALLS_PER_OVER,
                       bounded: bool = False) -> DataFrame:
    """Striker and non-striker of every ball (W4), from runs, wickets and the batting order.

    Two crease slots start with batters 1 and 2 of the order, slot A on strike.
    The strike changes after a ball with odd runs that is not a wicket, and at
    the end of every over.  A wicket puts the next batter of the order, number
    (wickets so far + 2), into the slot of the batter who was out.  So:

    * slot on strike = parity of (earlier odd-run non-wicket balls + completed overs),
      a running sum;
    * occupant of a slot = order[w + 1] (0-based) for the latest earlier wicket
      w in that slot, else its opener.  An innings has at most ``WICKET_LIMIT``
      wickets, so its wickets travel as one bounded array (ball, slot, next
      batter) with the batting order, in the one per-innings join.

    Use on a log cut by :func:`innings_cutoff`, or pass ``cut=True`` to apply
    that cut-off here: the rows it keeps are a prefix of each innings, so the
    running sums of both share one pass.  Balls after a tenth wicket are
    outside an innings (no batter is left to come in).  ``lineups`` has
    (match, innings, batting array).

    ``bounded=True`` (with ``cut``) is for a small ``last``, such as the 120 balls of 20 overs:
    balls after it are left out first, since no earlier ball depends on them, and however
    long the log of a match is, the few left are read once, in plain windows.
    """
    if bounded and not cut:
        raise ValueError("bounded rows are those up to the last ball of a cut")
    keys = [match, innings]
    if bounded:
        log = log.dropna(subset=keys).where(F.col(order) <= last)
    is_w = F.coalesce(F.col(wicket), F.lit(False))
    x = log.withColumns({
        "_odd": (~is_w & (odd(runs) == 1)).cast("long"),
        "_wk": is_w.cast("long")})
    specs = [Running("_odd_before", "sum", "_odd", inclusive=False),
             Running("_w_upto", "sum", "_wk", inclusive=True)]
    if cut:
        cols, cut_specs = _cut_specs(wicket, runs)
        x, specs = x.withColumns(cols), specs + cut_specs
    x = (_bounded_running(x, match, innings, order, specs) if bounded
         else running_aggregates(x, keys, [order], ball_chunk(order), specs))
    if cut:
        x = _apply_cut(x, match, innings, 1, WICKET_LIMIT, order, last, bounded)
    x = x.withColumn("_slot", F.pmod(F.col("_odd_before") + over_of(order), F.lit(2)))
    # at most WICKET_LIMIT entries per innings: a bounded array, built by a window or a partial aggregate
    fell = is_w & (F.col("_w_upto") <= WICKET_LIMIT)
    fall = F.struct(F.col(order).alias("ball"), F.col("_slot").alias("slot"), (F.col("_w_upto") + 1).alias("next"))
    side = lineups.select(*keys, "batting")
    if bounded:
        x = x.withColumn("_falls", F.collect_list(F.when(fell, fall)).over(Window.partitionBy(*keys)))
    else:
        falls = x.filter(fell).groupBy(*keys).agg(F.collect_list(fall).alias("_falls"))
        x = x.join(splittable(side.join(falls, keys, "left"), *keys), keys, "left")

    def latest(slot: int, opener: int) -> Column:
        earlier = F.filter(F.coalesce(F.col("_falls"), F.array()),
                           lambda e: (e["ball"] < F.col(order)) & (e["slot"] == slot))
        return F.coalesce(F.array_max(F.transform(earlier, lambda e: e["next"])), F.lit(opener))

    a, b = latest(0, 0), latest(1, 1)
    if bounded:         # the two numbers, not the array, go into the join
        x = x.withColumns({"_a": a, "_b": b}).drop("_falls").join(splittable(side, *keys), keys, "left")
        a, b = F.col("_a"), F.col("_b")
    on_a = F.col("_slot") == 0
    bat = F.col("batting")
    return x.select(
        *[c for c in log.columns],
        F.try_element_at(bat, (F.when(on_a, a).otherwise(b) + 1).cast("int")).alias("striker"),
        F.try_element_at(bat, (F.when(on_a, b).otherwise(a) + 1).cast("int")).alias("non_striker"))


def batting_positions(lineups: DataFrame, keys: list[str] | None = None,
                      order: str = "batting") -> DataFrame:
    """One row per batter with his 1-based position in the order."""
    keys = keys or ["match_id", "innings"]
    return lineups.select(*keys, F.posexplode(order).alias("_pos", "player")).select(
        *keys, (F.col("_pos") + 1).alias("position"), "player")


def over_totals(log: DataFrame, keys: list[str] | None = None, order: str = "ball_no",
                runs: str = "runs", wicket: str = "wicket") -> DataFrame:
    """Runs, wickets and balls per over (A10)."""
    keys = keys or ["match_id", "innings"]
    return (log.groupBy(*keys, over_of(order).alias("over")).agg(
        F.sum(runs).cast("long").alias("total_runs"),
        F.count_if(F.col(wicket)).alias("total_wickets"),
        F.count("*").alias("balls")))


def scorecard(rows: DataFrame, match: str = "match_id", innings: str = "innings",
              runs: str = "runs", wickets: str = "wicket", limit: int = WICKET_LIMIT,
              tie: str = TIE_WINNER, unit: str = "balls") -> DataFrame:
    """Runs, wickets and rows of both innings, and the winner, per match.
    ``unit`` says what a row is and names the count (``balls_1`` or ``overs_1``).

    ``rows`` are balls (boolean wicket) or overs (wicket counts) already cut
    by :func:`innings_cutoff`.  Wickets are capped at ``limit``.  Team 2 wins
    only with more runs; a tie goes to ``tie``.
    """
    w = F.col(wickets).cast("long")

    def side(i: int) -> list[Column]:
        on = F.col(innings) == i
        return [F.coalesce(F.sum(F.when(on, F.col(runs))), F.lit(0)).cast("long").alias(f"runs_{i}"),
                F.least(F.coalesce(F.sum(F.when(on, w)), F.lit(0)), F.lit(limit))
                .cast("long").alias(f"wickets_{i}"),
                F.count_if(on).alias(f"{unit}_{i}")]

    s = rows.groupBy(match).agg(*side(1), *side(2))
    return s.withColumn("winner", F.when(F.col("runs_2") > F.col("runs_1"), F.lit("Team 2"))
                        .otherwise(F.lit(tie)))
