"""Workload constants whose values the results depend on."""

from datetime import datetime, timedelta

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)

EARLIEST_DATA_HOUR = datetime(2015, 7, 1, 5)
REPORTING_BUFFER_HOURS = 72
TEST_SET_HOURS = 672
MAX_PAGE_ROWS = 5000
MIN_DEMAND = 60_000.0
MAX_DEMAND = 165_000.0
LAG_DAYS = (364, 728, 1092)
HISTOGRAM_BINS = 500

TIME_FEATURES = ("hour", "month", "year", "quarter", "dayofweek", "dayofmonth", "dayofyear")
LAG_FEATURES = ("lag_1y", "lag_2y", "lag_3y")
WEATHER_FEATURES = ("temp", "cloud_cover", "precip")
HOLIDAY_FEATURES = ("is_holiday",)
TARGET = "d"

CV_SPLITS = 8
GBT_PARAMS = {"stepSize": 0.02, "maxDepth": 5, "maxIter": 500}
GBT_TUNING_GRID = {
    "stepSize": (0.01, 0.02, 0.04),
    "maxDepth": (3, 5, 10),
    "maxIter": (100, 500, 1000),
}
GBT_EARLY_STOP = {"stepSize": 0.01, "maxDepth": 6, "maxIter": 1000}
