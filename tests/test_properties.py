"""Properties: the fact build against a brute-force model; reconciliation; invariance."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import SF_SMALL, artist
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from encore.operators import quality
from encore.plans.warehouse import build_star, driver_staging_tables, driver_star
from encore.sources.staging import Staging, from_frames

USERS = [("u0", True), ("u1", True), ("u2", False), ("u3", None)]
SONGS = [("s0", "a0", 200_000), ("s1", "a0", 9_000), ("s2", "zz", 150_000), ("s3", "a0", 3)]


def _model(events):
    """Expected fact rows (event_id -> (completion, date_key)) by the reference's rules."""
    active = {u for u, a in USERS if a}
    valid_songs = {s for s, a, d in SONGS if d > 10_000 and a == "a0"}
    out = {}
    for e in events:
        eid, uid, sid, at, dur, sdur = e
        if dur is None or sdur is None or not (0 <= dur <= sdur + 5000):
            continue
        if uid not in active or sid not in valid_songs:
            continue
        day = at.date()
        if not (dt.date(2020, 1, 1) <= day <= dt.date(2027, 12, 31)):
            continue
        d, s = max(dur, 0), max(sdur, 1)
        units = (20000 * d + s) // (2 * s)            # basis points, half up
        out[eid] = (Decimal(min(units, 10000)) / 100, day.year * 10000 + day.month * 100 + day.day)
    return out


event_rows = st.lists(st.tuples(
    st.sampled_from([u for u, _ in USERS] + ["nobody", None]),
    st.sampled_from([s for s, _, _ in SONGS] + [None]),
    st.datetimes(min_value=dt.datetime(2019, 12, 30), max_value=dt.datetime(2028, 1, 2)),
    st.one_of(st.none(), st.integers(-10, 260_000)),
    st.one_of(st.none(), st.integers(0, 250_000)),
), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(event_rows)
def test_fact_matches_brute_force_model(spark, rows):
    events = [(f"e{i:03d}", u, s, at, dur, sdur) for i, (u, s, at, dur, sdur) in enumerate(rows)]
    stg = from_frames(
        spark,
        artists=[artist("a0")],
        songs=[(sid, "T", aid, None, "pop", None, d, None, None) for sid, aid, d in SONGS],
        users=[(u, None, "US", "free", None, None, a) for u, a in USERS],
        events=[(eid, u, s, at, dur, sdur, False, None, "web", "US")
                for eid, u, s, at, dur, sdur in events])
    fact = build_star(spark, stg).fact_streams
    got = {r.event_id: (r.completion_pct, r.date_key) for r in fact.collect()}
    assert got == _model(events)


def test_reconciliation_and_distribution(spark):
    star = driver_star(spark, SF_SMALL)
    stg = driver_staging_tables(spark, SF_SMALL)
    rec = quality.load_reconciliation(stg.events, star.fact_streams).collect()[0]
    assert rec.staging_rows == rec.analytics_rows + rec.filtered_out
    assert rec.analytics_rows == star.fact_streams.count()
    dist = quality.completion_distribution(star.fact_streams).collect()
    assert sum(r.plays for r in dist) == rec.analytics_rows
    assert abs(sum(r.pct_of_total for r in dist) - 100.0) <= 0.05 * len(dist)


def test_input_order_does_not_matter(spark):
    stg = driver_staging_tables(spark, SF_SMALL)
    shuffled = Staging(*[t.repartition(7, "user_id" if "user_id" in t.columns else t.columns[0])
                         .sortWithinPartitions(t.columns[-1]) for t in stg])
    a = build_star(spark, stg).fact_streams
    b = build_star(spark, shuffled).fact_streams
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
