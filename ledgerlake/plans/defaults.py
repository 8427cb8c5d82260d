"""Fixed run parameters of the registered queries.

Output that would carry the wall clock (stamps, report times) takes these
instead, so a rerun reproduces the same rows and the oracle can match them.
"""

import datetime as dt

# The run date and run time of the registered queries, and the
# one day that day-scoped operators read.
RUN_DATE = dt.date(2024, 1, 31)
RUN_TS = dt.datetime(2024, 1, 31, 1, 0, 0)
RUN_TS_TEXT = "2024-01-31 01:00:00"
DAY = dt.date(2024, 1, 15)
AUDIT_KEY = "audit/batch_id=GDPR-BATCH-20240131010000"
