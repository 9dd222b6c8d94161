"""Fixed run parameters used by the registered queries and their oracles."""

import datetime as dt

RUN_TS = dt.datetime(2025, 1, 1, 0, 0, 0)
RUN_TS_2 = dt.datetime(2025, 1, 8, 0, 0, 0)  # the second run of a scenario
DAY_1, DAY_2 = dt.date(2024, 12, 29), dt.date(2025, 1, 5)  # Sundays: customers load in full
# watermarks for the incremental (second) run
WM_BILLING = dt.datetime(2001, 7, 1)
WM_SESSIONS = dt.datetime(2024, 1, 20)
WM_CUSTOMERS = dt.datetime(2000, 1, 1)
# freshness dates
FRESH_BILLING = dt.date(2001, 7, 1)
FRESH_SESSIONS = dt.date(2024, 1, 20)
AS_OF = dt.date(2025, 1, 31)
