"""Continuous refresh."""

from tallyline.streaming.derived import Averages, ChangedIndicators, DatabaseCopy, FollowUp, Indicators
from tallyline.streaming.moving import moved_average, moved_sums, newest_sums, run_moving_average
from tallyline.streaming.refresh import Refresh, run_refresh

__all__ = [
    "Averages",
    "ChangedIndicators",
    "DatabaseCopy",
    "FollowUp",
    "Indicators",
    "Refresh",
    "moved_average",
    "moved_sums",
    "newest_sums",
    "run_moving_average",
    "run_refresh",
]
