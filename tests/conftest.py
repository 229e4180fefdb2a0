from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from encore.session import build_session  # noqa: E402
from encore.sources.staging import from_frames  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8,
                            extra={"spark.driver.memory": "4g"})
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    """An instant from ISO text (offsets honoured), as a naive UTC datetime."""
    value = dt.datetime.fromisoformat(text)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def artist(artist_id, name="Artist", country="us", genre="pop", listeners=None):
    return (artist_id, name, country, genre, listeners)


def song(song_id, artist_id="a1", title="Song", genre="pop", subgenre=None, duration_ms=200_000,
         release=dt.date(2020, 1, 1), explicit=None):
    return (song_id, title, artist_id, None, genre, subgenre, duration_ms, release, explicit)


def user(user_id, subscription="free", active=True, country="US", email="x@example.com",
         age="25-34", signup=dt.date(2021, 1, 1)):
    return (user_id, email, country, subscription, age, signup, active)


def event(event_id, user_id="u1", song_id="s1", at="2024-01-20T10:00:00+00:00", duration_ms=100_000,
          song_duration_ms=200_000, skipped=False, platform="ios", country="US"):
    return (event_id, user_id, song_id, ts(at), duration_ms, song_duration_ms, skipped, None,
            platform, country)


@pytest.fixture
def make_staging(spark):
    def build(artists=(), songs=(), users=(), events=()):
        return from_frames(spark, artists, songs, users, events)
    return build
