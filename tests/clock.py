"""The time at which the tests let jobs run."""

import datetime as dt

NOW = dt.datetime(2025, 6, 1, 12, 0)
