"""Column roles and defaults shared by every operator.

An interactions table is any DataFrame with a user key, an item key and a
rating; the roles say which columns those are, so one config drives the
filters, splits, metrics and the ALS fit alike.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values the results depend on (same as the published pipeline):
# seed 123; activity threshold 20; user sample 1 %; split weights 0.6 / 0.2 / 0.2;
# hold-out fraction 0.5; top k 10; ALS maxIter 5; k folds 4.
DEFAULT_SEED = 123
DEFAULT_THRESHOLD = 20
DEFAULT_PERCENTAGE = 0.01
DEFAULT_SPLIT_WEIGHTS = (0.6, 0.2, 0.2)
DEFAULT_HOLDOUT = 0.5
DEFAULT_K = 10
DEFAULT_MAX_ITER = 5
DEFAULT_FOLDS = 4

REGRESSION_METRICS = ("rmse", "mae", "r2")
RANKING_METRICS = ("precisionAt", "meanAveragePrecision", "ndcgAt")


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each part."""

    user: str = "user_id"
    item: str = "item_id"
    rating: str = "rating"
    prediction: str = "prediction"
    # extra columns that make a row order total when user and item tie
    tiebreak: tuple[str, ...] = ()

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)


DEFAULT_ROLES = Roles()
