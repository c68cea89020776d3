"""Parameter values on the test views, where years and volumes differ from real files."""

from asphalt.operators.attribution import Leaf, Split
from asphalt.schema import Thresholds

STAND_IN = Thresholds(min_rows=50, test_from=2000, early=(1995, 1997), late=(1998, 2001))
BACKTEST = (1998, 1999)
STATE = "S3"
RARE_BELOW = 50
CAP_PER_STATE = 1000
CAP_ROWS = 10_000
ENCODED = ["weather_condition", "state", "is_night"]
WITHOUT_ODDS = ("bump", "no_exit")
# Queries that fit one algorithm use the published defaults. Those that fit several in one query would take minutes
# each with them: they fit fewer trees and iterations (times in the README).
COMPARED_FOREST = {"n_estimators": 50}
COMPARED_BOOSTING = {"max_iter": 30}
SWEEP = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7]
THRESHOLD = 0.3

# A logistic score with fixed weights, so that SQL can state it too.
INTERCEPT = -1.5
COEFFICIENTS = {
    "junction": 0.8, "crossing": 0.1, "stop": -0.3, "traffic_signal": -0.7, "railway": 0.2, "station": 0.05,
    "roundabout": -0.1, "bump": 0.02, "give_way": -0.05, "no_exit": 0.04, "traffic_calming": -0.2, "amenity": 0.03,
    "visibility_mi": -0.02, "wind_speed_mph": 0.03,
}

# A small tree with fixed covers, so that SQL can state its attribution too.
TREE = Split(
    "wind_speed_mph",
    Split("junction", Split("visibility_mi", Leaf(0.05, 900.0), Leaf(0.12, 1100.0), at=4.0), Leaf(0.35, 400.0), at=0.0),
    Split("traffic_signal",
          Split("junction", Leaf(0.6, 300.0), Split("wind_speed_mph", Leaf(0.7, 90.0), Leaf(0.95, 210.0), at=21.0), at=0.0),
          Split("railway", Leaf(0.2, 150.0), Leaf(0.45, 50.0), categories=(0.0,)), at=0.0),
    at=16.5,
)
# Columns of the penalised odds ratios that SQL states as well.
PENALISED = ["junction", "traffic_signal"]
PENALISED_ROUNDS = 12
