"""Fixed values that must equal the reference's for the same results.

Stated once here, in the order the study uses them; every operator takes its
default from this module.  (Values of our own, such as the stand-in rules,
live in ``crease.plans.standins``.)
"""

# Fixed values.
# Scored outcomes of one ball that have their own column (5 runs has none).
OUTCOMES = (0, 1, 2, 3, 4, 6)
# A pair needs strictly more balls than this for its own odds.
PAIR_THRESHOLD = 9
# Survival prior = mean pair survival times this (not clamped to 1).
SURVIVAL_PRIOR_BOOST = 1.05
# Batting clusters, bowling clusters, the K-means seed and its most rounds.
BAT_CLUSTERS = 4
BOWL_CLUSTERS = 5
KMEANS_SEED = 1
KMEANS_ROUNDS = 20
# Elbow sweep: k from 2 to 14, each fit on a 25 % sample.
ELBOW_KS = range(2, 15)
ELBOW_FRACTION = 0.25
# A batter is out once his running survival product is at or below this.
SURVIVAL_CUT = 0.3
# Balls in an over, overs in an innings, wickets that end an innings.
BALLS_PER_OVER = 6
OVERS = 20
WICKET_LIMIT = 10
# A tie goes to the team that batted first.
TIE_WINNER = "Team 1"
# Regression trees of runs and wickets per over.
TREE_DEPTH = 30
TREE_BINS = 40
# Columns of the season tables that make a career.
BAT_SEASON_COLS = ["Player", "Inns", "Runs", "HS", "Ave", "BF", "SR"]
BOWL_SEASON_COLS = ["Player", "Inns", "Runs", "Wkts", "Ave", "Econ", "SR"]
# Career columns that players are clustered by.
BAT_FEATURES = ["Runs", "HS", "Ave", "BF", "SR"]
BOWL_FEATURES = ["Runs", "Wkts", "Ave", "Econ", "SR"]
# Profile columns, in this order (snake case).
BAT_PROFILE_COLS = ["runs_per_innings", "strike_rate", "innings_per_dismissal",
                    "sixes_per_ball", "fours_per_ball"]
BOWL_PROFILE_COLS = ["runs_per_wicket", "economy", "balls_per_wicket", "wickets_per_innings"]
