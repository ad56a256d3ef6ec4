"""Fixed evaluation instants used by the query catalogue (FIXTURES.md §4).

The operators default to "now"; the catalogue pins every clock so the
results are reproducible and comparable with the SQL oracle.
"""

INGEST_NOW = "2024-02-01 00:00:00"      # ingested_at / updated_at of bronze & silver
GOLD_AS_OF = "2024-01-15 00:00:00"      # gold run: dates >= 2024-01-14
GOLD_NOW = "2024-02-01 01:00:00"        # updated_at of the first gold append
GOLD_NOW_2 = "2024-02-01 02:00:00"      # updated_at of the second gold append
GOLD_NOW_3 = "2024-02-01 03:00:00"      # return to the first run
GOLD_AS_OF_2 = "2024-01-20 00:00:00"    # second gold run: dates >= 2024-01-19
DAILY_AS_OF = "2024-01-16 10:00:00"     # daily report -> 2024-01-15
WEEKLY_AS_OF = "2024-01-22 10:00:00"    # weekly report -> dates >= 2024-01-15
HOURLY_AS_OF = "2024-01-30 23:30:00"    # current hour 23:00 (partial) vs 22:00
EMPTY_AS_OF = "2030-01-15 00:00:00"     # a day without rows
FUTURE_AS_OF = "2099-01-01 02:00:00"    # freshness bound 2099-01-01 -> fails

# metric evaluation
METRIC_STEP = "1m"
PANEL_END = "2024-01-16 10:00:00"       # panels look back 1 h or 3 h from here
PANEL_STARTS = {"1h": "2024-01-16 09:00:00", "3h": "2024-01-16 07:00:00"}
INCREASE_RANGE = "1h"
INCREASE_STEP = "15m"
# sf0.01 has ~14 events per hour spread over 24 task series, so the
# catalogue's rate and firing examples use ranges that hold several samples
RATE_RANGE = "1h"
FIRING_RANGE = "2h"
FIRING_THRESHOLD = 1
FIRING_FOR = "30m"
RETENTION_AS_OF = "2024-02-01 02:30:00"  # expire ledger versions older than 1 h
RETENTION = "1h"

# table maintenance / streaming fixtures (splits together cover every row)
# the first and the last batch are open-ended
SILVER_BATCHES = [(None, "2024-01-08"), ("2024-01-08", "2024-01-15"),
                  ("2024-01-15", "2024-01-22"), ("2024-01-22", None)]
EMPTIED_DATE = "2024-01-20"
EVOLVE_SPLIT = "2024-01-16"
STREAM_SPLIT = "2024-01-16 00:00:00"
