from marketlens.functions.dates import as_of, month_starts, snapshot_dates
from marketlens.functions.horizons import REF, Horizon, in_horizon, within
from marketlens.functions.ratios import mean, safe_ratio, stddev_from_moments

__all__ = ["REF", "Horizon", "as_of", "in_horizon", "mean", "month_starts", "safe_ratio", "snapshot_dates",
           "stddev_from_moments", "within"]
