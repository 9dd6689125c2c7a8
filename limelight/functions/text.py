"""Handles, name words and caption matching as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import CHANNEL_STOP_WORDS, CHANNEL_SUBSCRIBERS, MUSIC_KEYWORDS, PROFILE_STOP_WORDS

# The patterns. Java's \w and \s are ASCII only, so the Unicode word and
# space classes are written out.
_HANDLE = r"([a-zA-Z0-9_.]+)"
_WORD = r"@\p{L}\p{N}_"
_SPACE = r"\s\p{Z}\x{85}\x{1c}-\x{1f}"
PROFILE_URL = rf"(?i)instagram\.com/{_HANDLE}"
MENTION = rf"(?<![{_WORD}])@{_HANDLE}(?![{_WORD}])"
LABELLED = rf"(?i)(?:instagram|ig)[{_SPACE}:]+{_HANDLE}"


def extract_handles(text: Column) -> Column:
    """Distinct lower-case handles in a text, ordered by pattern, then by position.

    Array functions only: one pass over the whole text, no shuffle. NULL text gives an
    empty array.
    """
    text = F.coalesce(text, F.lit(""))
    found = F.concat(
        F.regexp_extract_all(text, F.lit(PROFILE_URL), F.lit(1)),
        F.filter(
            F.regexp_extract_all(text, F.lit(MENTION), F.lit(1)),
            lambda h: ~F.contains(h, F.lit(".")),
        ),
        F.regexp_extract_all(text, F.lit(LABELLED), F.lit(1)),
    )
    long_enough = F.filter(found, lambda h: F.length(h) > 1)
    return F.array_distinct(F.transform(long_enough, F.lower))


def handle_clean(handle: Column) -> Column:
    return F.replace(handle, F.lit("@"), F.lit(""))


def name_handle_variants(name: Column) -> Column:
    """Four ordered guesses at the handle of a named artist."""
    base = F.translate(F.lower(name), " .-", "")
    return F.array(
        base,
        F.replace(base, F.lit("the"), F.lit("")),
        F.concat(base, F.lit("music")),
        F.concat(base, F.lit("official")),
    )


def words(text: Column) -> Column:
    return F.split(F.lower(text), f"[{_SPACE}]+")


def name_words(name: Column, stop_words: tuple[str, ...]) -> Column:
    """Significant words of a name: longer than two characters and not a stop word."""
    return F.filter(words(name), lambda w: (F.length(w) > 2) & ~w.isin(*stop_words))


def profile_name_words(name: Column) -> Column:
    return name_words(name, PROFILE_STOP_WORDS)


def channel_name_words(name: Column) -> Column:
    return name_words(name, CHANNEL_STOP_WORDS)


def mentions_any(text: Column, wanted: Column) -> Column:
    return F.exists(wanted, lambda w: F.contains(text, w))


def profile_matches(name: Column, full_name: Column, biography: Column) -> Column:
    """A name word or a music keyword appears in the profile's name or biography."""
    # neither words nor keywords contain a line break, so one text serves for both
    profile = F.lower(F.concat_ws("\n", full_name, biography))
    keywords = F.array(*[F.lit(k) for k in MUSIC_KEYWORDS])
    return mentions_any(profile, F.concat(profile_name_words(name), keywords))


def channel_match_score(
    wanted: Column, title: Column, description: Column, subscribers: Column
) -> Column:
    """How well a channel fits an artist, given the words of the artist's name."""
    title = F.lower(title)
    description = F.lower(F.coalesce(description, F.lit("")))
    low, high = CHANNEL_SUBSCRIBERS

    def hits(text: Column) -> Column:
        return F.size(F.filter(wanted, lambda w: F.contains(text, w)))

    return (
        F.when(F.contains(title, F.lit("official")), 10).otherwise(0)
        + hits(title) * 5
        + hits(description) * 2
        + F.when(subscribers.between(low, high), 1).otherwise(0)
    )


def caption_words(track_name: Column) -> Column:
    return F.filter(words(track_name), lambda w: F.length(w) > 3)


def caption_has(caption: Column, title: Column, long_words: Column) -> Column:
    """Lower-case caption contains the lower-case title or one of its long words."""
    return F.contains(caption, title) | mentions_any(caption, long_words)


def caption_mentions_track(caption: Column, track_name: Column) -> Column:
    """The whole title, or any of its words longer than three characters, is mentioned."""
    return caption_has(
        F.lower(F.coalesce(caption, F.lit(""))), F.lower(track_name), caption_words(track_name)
    )


#: Code points of a caption that song rows show.
CAPTION_LENGTH = 200


def caption_excerpt(caption: Column) -> Column:
    return F.substring(F.coalesce(caption, F.lit("")), 1, CAPTION_LENGTH)


def post_url(shortcode: Column) -> Column:
    return F.concat(F.lit("https://www.instagram.com/p/"), shortcode, F.lit("/"))


def video_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)


def published_date(iso: Column) -> Column:
    """Calendar date of an ISO-8601 instant as it is written; NULL when unparseable."""
    valid = iso.rlike(r"^\d{4}-\d{2}-\d{2}(T.+)?$") & F.try_to_timestamp(iso).isNotNull()
    return F.when(valid, F.substring(iso, 1, 10).try_cast("date"))
