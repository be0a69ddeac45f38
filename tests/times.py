"""First timestamp of the test frames."""

import datetime as dt

START = dt.datetime(2026, 3, 1, 8, 0)
