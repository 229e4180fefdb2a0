"""Business rules of the analytics load and the weekly report.

Fixed values: these must equal the reference's for the same results.
"""

import datetime as dt

# ---- fixed values --------------------------------------------------------------

# Calendar dimension range (inclusive).
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2027, 12, 31)

# Subscription domain; anything else (and NULL / blank) becomes UNKNOWN.
SUBSCRIPTION_TYPES = ("free", "premium")
UNKNOWN_SUBSCRIPTION = "unknown"

# Platform domain named by the source schema.
PLATFORMS = ("ios", "android", "web", "desktop")

# Songs of this length or shorter (ms) are bad records.
MIN_SONG_DURATION_MS = 10000

# A play may exceed the song length by this much (ms) before it is dropped.
PLAY_OVERRUN_MS = 5000

# Completion buckets: upper edge (percent, exclusive) and label; the last has no edge.
COMPLETION_BUCKETS = (
    (25, "a) 0–25%   (early bail)"),
    (50, "b) 25–50%  (halfway)"),
    (75, "c) 50–75%  (most of it)"),
    (95, "d) 75–95%  (almost full)"),
    (None, "e) 95–100% (full listen)"),
)

# Report defaults.
TRENDING_DAYS = 7
TRENDING_TOP = 10
BREAKOUT_WINDOW_DAYS = 30
BREAKOUT_MIN_RECENT = 20
BREAKOUT_MIN_PREVIOUS = 5
BREAKOUT_MIN_GROWTH = "1.3"
BREAKOUT_TOP = 15
SAMPLE_ROWS = 10
