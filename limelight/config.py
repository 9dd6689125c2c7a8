"""Scoring profiles and the fixed word lists the operators compare against."""

from __future__ import annotations

from dataclasses import dataclass

# Genre lists of the three published rule sets.
TABLE_GENRES = (
    "jazz", "folk", "alternative", "soul", "indie", "indie folk", "blues", "rnb",
    "nu jazz", "funk", "piano", "80s", "unknown", "indie rock", "singer-songwriter",
    "british indie", "acoustic", "neo soul", "jazz fusion",
)
GENERATED_GENRES = (
    "jazz", "folk", "alternative", "soul", "indie", "indie folk", "blues", "rnb",
    "nu jazz", "funk", "piano", "80s", "unknown",
)
DOCUMENTED_GENRES = (
    "jazz", "folk", "alternative", "soul", "indie", "blues", "rnb", "nu jazz", "funk",
)

# Tags searched during discovery, in search order.
SEARCH_TAGS = (
    "jazz", "folk", "alternative", "soul", "indie", "indie folk", "british soul",
    "uk jazz", "indie rock", "singer-songwriter", "british indie", "acoustic",
    "neo soul", "jazz fusion",
)

# Artists that are never "emerging", lower case.
ESTABLISHED_ARTISTS = (
    "coldplay", "radiohead", "adele", "ed sheeran", "arctic monkeys", "the 1975",
    "david bowie", "pink floyd", "the beatles", "rolling stones",
)

# Words ignored when a name is compared with a profile or a channel.
PROFILE_STOP_WORDS = ("the", "a", "an", "and", "or")
CHANNEL_STOP_WORDS = ("the", "a", "an", "and")

# Words that mark a profile as a musician's.
MUSIC_KEYWORDS = ("music", "artist", "band", "musician", "singer", "songwriter")

# Limits of the collection steps.
EMERGING_LISTENERS = (5_000, 200_000)
LISTENER_REPORT_EDGES = (5_000, 150_000)
MIN_PROFILE_FOLLOWERS = 5_000
CHANNEL_SUBSCRIBERS = (500, 500_000)
MIN_CHANNEL_MATCH = 5
ENGAGEMENT_POSTS = 12
RELEASE_POSTS = 50
RELEASE_WINDOW_DAYS = 30
RECENT_VIDEOS = 10
HANDLE_VIDEOS = 5
TOP_TRACKS = 10
SEARCH_RESULTS = 10
TAGS_KEPT = 5

# Daily request budget of the video source.
QUOTA_STOP = 9_000
QUOTA_SEARCH = 100
QUOTA_DETAIL = 1
QUOTA_VIDEOS = 2


@dataclass(frozen=True)
class ScoreConfig:
    """One set of scoring rules. Ranges are inclusive."""

    name: str
    high_multiple: float
    medium_multiple: float
    followers: tuple[int, int]
    genres: tuple[str, ...]
    listeners: tuple[int, int] = EMERGING_LISTENERS
    min_engagement_rate: float = 1.0
    min_quality: float = 0.3


TABLE = ScoreConfig("table", 1.5, 0.8, (5_000, 100_000), TABLE_GENRES)
GENERATED = ScoreConfig("generated", 2.0, 1.0, (1_000, 100_000), GENERATED_GENRES)
DOCUMENTED = ScoreConfig("documented", 2.0, 1.0, (1_000, 100_000), DOCUMENTED_GENRES)
PROFILES = {c.name: c for c in (TABLE, GENERATED, DOCUMENTED)}
