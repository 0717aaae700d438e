"""Season tables -> career rows and player profiles (projection, filter, union, aggregate)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.fixed import BAT_PROFILE_COLS, BAT_SEASON_COLS, BOWL_PROFILE_COLS, BOWL_SEASON_COLS
from crease.functions import ratio_or_zero, safe_ratio


def project_columns(df: DataFrame, keep: Iterable[str] | None = None,
                    drop: Iterable[str] | None = None) -> DataFrame:
    """Column selection (C1): keep a list, or drop some."""
    if keep is not None:
        df = df.select(*keep)
    if drop is not None:
        df = df.drop(*drop)
    return df


def rename_columns(df: DataFrame, names: dict[str, str] | list[str]) -> DataFrame:
    """Rename by mapping, or by position when given a full list."""
    if isinstance(names, dict):
        return df.withColumnsRenamed(names)
    return df.toDF(*names)


def season_filter(df: DataFrame, holdout: int, year: str = "Year") -> DataFrame:
    """Leave out the hold-out season (C3).  A NULL year is left out too."""
    return df.filter(F.col(year) != F.lit(holdout))


def ratio_columns(df: DataFrame, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Add or replace ``name = num / den`` columns, NULL on a zero denominator."""
    return df.withColumns({n: safe_ratio(a, b) for n, (a, b) in ratios.items()})


def cast_features(df: DataFrame, cols: Iterable[str], to: str = "double") -> DataFrame:
    """Numeric cast of a feature list (C6); other columns untouched."""
    return df.withColumns({c: F.col(c).cast(to) for c in cols})


def fill_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Fill NULL numerics with 0 (C10).  An explicit step: nothing calls it implicitly."""
    return df.na.fill(0) if cols is None else df.na.fill(0, subset=list(cols))


def append_debutants(seasons: DataFrame, debuts: DataFrame) -> DataFrame:
    """Union of season rows and debutant career rows, matched by column name."""
    return seasons.unionByName(debuts)


def batting_career(seasons: DataFrame, debuts: DataFrame, holdout: int) -> DataFrame:
    """Career batting row per player (A1).

    Inns, BF: sums; HS: max; Ave, SR: means of the season values; Runs: the
    *sum of per-season Runs/BF* (kept from the reference, not runs / balls).
    A season with BF = 0 gives NULL, which the sum skips; a sum of nothing is 0.
    """
    rows = append_debutants(
        season_filter(seasons, holdout).select(*BAT_SEASON_COLS),
        debuts.select(*BAT_SEASON_COLS))
    rows = rows.withColumn("Runs", safe_ratio("Runs", "BF")).dropna(subset=["Player"])
    return rows.groupBy("Player").agg(
        F.coalesce(F.sum("Inns"), F.lit(0)).cast("long").alias("Inns"),
        F.coalesce(F.sum("Runs"), F.lit(0.0)).alias("Runs"),
        F.max("HS").cast("long").alias("HS"),
        F.avg("Ave").alias("Ave"),
        F.coalesce(F.sum("BF"), F.lit(0)).cast("long").alias("BF"),
        F.avg("SR").alias("SR"))


def bowling_career(seasons: DataFrame, debuts: DataFrame, holdout: int) -> DataFrame:
    """Career bowling row per player (A2): sums of Runs/Inns and Wkts/Inns, means of Econ, Ave, SR."""
    rows = append_debutants(
        season_filter(seasons, holdout).select(*BOWL_SEASON_COLS),
        debuts.select(*BOWL_SEASON_COLS))
    rows = (rows.withColumns({"Runs": safe_ratio("Runs", "Inns"),
                              "Wkts": safe_ratio("Wkts", "Inns")})
            .dropna(subset=["Player"]))
    return rows.groupBy("Player").agg(
        F.coalesce(F.sum("Inns"), F.lit(0)).cast("long").alias("Inns"),
        F.coalesce(F.sum("Runs"), F.lit(0.0)).alias("Runs"),
        F.coalesce(F.sum("Wkts"), F.lit(0.0)).alias("Wkts"),
        F.avg("Ave").alias("Ave"),
        F.avg("Econ").alias("Econ"),
        F.avg("SR").alias("SR"))


def batting_profile(balls: DataFrame, player: str = "batsman", match: str = "match_id",
                    runs: str = "runs", wicket: str = "wicket") -> DataFrame:
    """Batting profile per player from a ball log (A11); zero denominators give 0."""
    agg = (balls.dropna(subset=[player]).groupBy(player).agg(
        F.countDistinct(match).alias("_inns"),
        F.sum(runs).alias("_runs"),
        F.count(runs).alias("_bf"),
        F.count_if(F.col(wicket)).alias("_outs"),
        F.count_if(F.col(runs) == 6).alias("_sixes"),
        F.count_if(F.col(runs) == 4).alias("_fours")))
    return agg.select(
        player,
        ratio_or_zero("_runs", "_inns").alias("runs_per_innings"),
        (ratio_or_zero("_runs", "_bf") * 100).alias("strike_rate"),
        ratio_or_zero("_inns", "_outs").alias("innings_per_dismissal"),
        ratio_or_zero("_sixes", "_bf").alias("sixes_per_ball"),
        ratio_or_zero("_fours", "_bf").alias("fours_per_ball"))


def bowling_profile(balls: DataFrame, player: str = "bowler", match: str = "match_id",
                    runs: str = "runs", wicket: str = "wicket") -> DataFrame:
    """Bowling profile per player from a ball log (A11); zero denominators give 0."""
    agg = (balls.dropna(subset=[player]).groupBy(player).agg(
        F.countDistinct(match).alias("_inns"),
        F.sum(runs).alias("_runs"),
        F.count("*").alias("_balls"),
        F.count_if(F.col(wicket)).alias("_wkts")))
    return agg.select(
        player,
        ratio_or_zero("_runs", "_wkts").alias("runs_per_wicket"),
        (ratio_or_zero("_runs", "_balls") * 6).alias("economy"),
        ratio_or_zero("_balls", "_wkts").alias("balls_per_wicket"),
        ratio_or_zero("_wkts", "_inns").alias("wickets_per_innings"))


def profile_means(profile: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One-row table of column means, the default for a player without a profile."""
    return profile.agg(*[F.avg(c).alias(c) for c in cols])
