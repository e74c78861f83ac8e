"""Column-level functions (pure ``pyspark.sql.functions`` expressions)."""

from ratecraft.functions.features import (
    epoch_seconds, from_epoch_seconds, release_year, round_to_period,
    first_genre, split_genres, title_has_year, YEAR_PATTERN,
)
from ratecraft.functions.stats import n_distinct, strict_rmse_aggs, strict_mean

__all__ = [
    "epoch_seconds", "from_epoch_seconds", "release_year", "round_to_period",
    "first_genre", "split_genres", "title_has_year", "YEAR_PATTERN",
    "n_distinct", "strict_rmse_aggs", "strict_mean",
]
