"""The same results stated in SQL over the given tables, for an independent engine.

``CTES`` derives the artist-shaped inputs as ``fx_*`` relations; ``BODIES`` holds one
statement per operator. ``oracle_sql`` puts the needed relations in front of each body.
"""

from __future__ import annotations

import re

from .. import config
from .fixture import GENRES
from .queries import CHOSEN_ARTIST, CHOSEN_GENRES, DESCRIBED, SPLIT_DAY


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Python-style rounding of the exact binary value
def _exact(x: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', CAST({x} AS DOUBLE)) AS DOUBLE)"


def _any_in(text: str, words: str) -> str:
    return f"len(list_filter({words}, lambda w: contains({text}, w))) > 0"


SPACE = r"[\t\n\v\f\r\x1c-\x1f\x85\p{Z}]+"
WORDCHAR = r"[\p{L}\p{N}_]"
HANDLE = "([a-zA-Z0-9_.]+)"


def _name_words(name: str, stop) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({name}), '{SPACE}'), "
        f"lambda w: length(w) > 2 AND w NOT IN ({_list(stop)}))"
    )


def _caption_match(caption: str, title: str) -> str:
    words = (
        f"list_filter(regexp_split_to_array(lower({title}), '{SPACE}'), "
        "lambda w: length(w) > 3)"
    )
    return f"(contains({caption}, lower({title})) OR {_any_in(caption, words)})"


def _handles(source: str, key: str, text: str) -> str:
    """(key, handle, position): distinct handles of a text, by pattern, then by place."""
    return f"""
    SELECT {key}, handle, CAST(row_number() OVER (PARTITION BY {key} ORDER BY min(place)) - 1 AS BIGINT) AS position
    FROM (
      SELECT {key}, lower(h) AS handle, 1000000000 + i AS place FROM (
        SELECT {key}, unnest(m) AS h, unnest(range(len(m))) AS i FROM (
          SELECT {key}, regexp_extract_all({text}, '(?i)instagram\\.com/{HANDLE}', 1) AS m FROM {source}))
      UNION ALL
      SELECT {key}, lower(h), 2000000000 + i FROM (
        SELECT {key}, i, CASE
            WHEN before <> '' AND regexp_matches(before, '{WORDCHAR}') THEN ''
            WHEN i > 2 AND before = '' THEN ''
            WHEN after = '' OR NOT regexp_matches(after, '[@\\p{{L}}\\p{{N}}_]') THEN run
            ELSE regexp_extract(run, '^(.+)\\.[^.]*$', 1) END AS h
        FROM (
          SELECT {key}, i, right(parts[i - 1], 1) AS before, run,
            CASE WHEN length(parts[i]) > length(run) THEN substr(parts[i], length(run) + 1, 1)
                 WHEN i = len(parts) THEN '' ELSE '@' END AS after
          FROM (
            SELECT {key}, parts, i, regexp_extract(parts[i], '^[a-zA-Z0-9_.]+') AS run
            FROM (SELECT {key}, parts, unnest(range(2, len(parts) + 1)) AS i
                  FROM (SELECT {key}, string_split({text}, '@') AS parts FROM {source})))
          WHERE run <> ''))
      WHERE NOT contains(h, '.')
      UNION ALL
      SELECT {key}, lower(h), 3000000000 + i FROM (
        SELECT {key}, unnest(m) AS h, unnest(range(len(m))) AS i FROM (
          SELECT {key}, regexp_extract_all({text}, '(?i)(?:instagram|ig)[:\\t\\n\\v\\f\\r\\x1c-\\x1f\\x85\\p{{Z}}]+{HANDLE}', 1) AS m FROM {source}))
    )
    WHERE length(handle) > 1
    GROUP BY {key}, handle"""


def _scoring(raw: str, cfg: config.ScoreConfig) -> str:
    lo, hi = cfg.listeners
    flo, fhi = cfg.followers
    return f"""
    SELECT artist_id, artist_name, primary_genre, collection_date, lastfm_listeners,
      lastfm_playcount, lastfm_playcount_per_listener, instagram_handle, instagram_followers,
      instagram_engagement_rate, instagram_avg_likes, youtube_channel_id, youtube_subscribers,
      youtube_total_views, {RATIO} AS underrated_ratio, {ENGAGEMENT} AS engagement_score,
      {PLATFORMS} AS platform_count, {_growth(cfg)} AS growth_potential,
      {PRIORITY} AS priority_score, instagram_followers - lastfm_listeners AS follower_gap,
      youtube_avg_views_per_video, data_quality_score
    FROM {raw}
    WHERE primary_genre IN ({_list(cfg.genres)})
      AND lastfm_listeners BETWEEN {lo} AND {hi}
      AND (instagram_followers IS NULL OR instagram_followers BETWEEN {flo} AND {fhi})
      AND (instagram_engagement_rate IS NULL OR instagram_engagement_rate > {cfg.min_engagement_rate}::DOUBLE)
      AND data_quality_score >= {cfg.min_quality}::DOUBLE"""


RATIO = "instagram_followers / nullif(lastfm_listeners, 0)"
ENGAGEMENT = (
    "CASE WHEN instagram_engagement_rate IS NOT NULL "
    "THEN least(instagram_engagement_rate * 2, 10.0::DOUBLE) END"
)
PLATFORMS = (
    "CAST(CASE WHEN lastfm_listeners > 5000 THEN 1 ELSE 0 END "
    "+ CASE WHEN instagram_followers > 10000 THEN 1 ELSE 0 END "
    "+ CASE WHEN youtube_subscribers > 1000 THEN 1 ELSE 0 END AS BIGINT)"
)
PRIORITY = (
    "(instagram_followers * 0.3::DOUBLE + instagram_engagement_rate * instagram_followers * 0.4::DOUBLE "
    "+ youtube_subscribers * 0.2::DOUBLE + lastfm_playcount_per_listener * 1000.0::DOUBLE * 0.1::DOUBLE) "
    "/ CASE WHEN lastfm_listeners IS NOT NULL THEN greatest(lastfm_listeners, 1) END"
)


def _growth(cfg: config.ScoreConfig) -> str:
    return (
        f"CASE WHEN instagram_followers > lastfm_listeners * {cfg.high_multiple}::DOUBLE THEN 'High' "
        f"WHEN instagram_followers > lastfm_listeners * {cfg.medium_multiple}::DOUBLE THEN 'Medium' "
        "ELSE 'Low' END"
    )


QUALITY = (
    "CASE WHEN lastfm_listeners IS NULL THEN 0 ELSE 1 END * 0.3::DOUBLE "
    "+ CASE WHEN instagram_followers IS NULL THEN 0 ELSE 1 END * 0.4::DOUBLE "
    "+ CASE WHEN youtube_subscribers IS NULL THEN 0 ELSE 1 END * 0.3::DOUBLE"
)
BY_SCORE = "priority_score DESC NULLS LAST, artist_id"
SOCIAL_COLS = (
    "instagram_handle, instagram_followers, instagram_following, instagram_posts, "
    "instagram_avg_likes, instagram_avg_comments, instagram_engagement_rate, "
    "instagram_reels_count, instagram_verified"
)
VIDEO_COLS = (
    "youtube_channel_id, youtube_subscribers, youtube_total_views, youtube_video_count, "
    "youtube_avg_views_per_video"
)
NEWEST_POST = "PARTITION BY handle ORDER BY post_date DESC, shortcode"
NEWEST_VIDEO = "PARTITION BY channel_id ORDER BY published_at DESC, video_id"

CTES: dict[str, str] = {
    "fx_customer": f"""
      SELECT c_custkey AS k, c_name AS artist_name, md5(c_name) AS artist_id,
        ([{_list(GENRES)}])[c_nationkey % {len(GENRES)} + 1] AS genre, c_nationkey AS nation,
        n_regionkey AS region, c_mktsegment AS segment, c_acctbal AS balance
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_artist": """
      SELECT * FROM fx_customer JOIN (
        SELECT o_custkey AS k, CAST(floor(min(o_totalprice)) AS BIGINT) AS listeners,
          CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // 100 AS playcount,
          count(*) AS n_orders
        FROM orders GROUP BY o_custkey) USING (k)""",
    "fx_listening": f"""
      SELECT artist_id, artist_name, listeners AS lastfm_listeners, playcount AS lastfm_playcount,
        CASE WHEN listeners > 0 THEN {_exact('playcount / listeners', 2)} ELSE 0.0 END
          AS lastfm_playcount_per_listener,
        'https://music.example/' || artist_name AS lastfm_url, genre AS genres,
        genre AS primary_genre, 'genre:' || genre AS source,
        '2024-01-31' AS collection_date, '2024-01-31 00:00:00' AS collection_timestamp
      FROM fx_artist""",
    "fx_upload": """
      SELECT o_custkey AS k, l_orderkey, l_partkey, l_linenumber, l_returnflag, l_linestatus,
        'ch' || o_custkey || l_returnflag || l_linestatus AS channel_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
          || strftime(l_shipdate, '%Y%m%d') AS code,
        CAST(l_shipdate AS DATE) AS day, CAST(floor(l_extendedprice) AS BIGINT) AS views,
        CAST(floor(l_extendedprice / 50) AS BIGINT) AS likes, CAST(l_quantity AS BIGINT) AS comments
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_post": """
      SELECT 'artist' || k AS handle, code AS shortcode, day AS post_date, likes, comments,
        l_returnflag = 'R' AS is_video, lower(p_name) AS caption, l_orderkey
      FROM fx_upload JOIN part ON l_partkey = p_partkey""",
    "fx_social_artist": "SELECT * FROM fx_artist WHERE segment <> 'MACHINERY' AND balance >= 1",
    "fx_own_profile": """
      SELECT 'artist' || k AS handle,
        CASE segment WHEN 'BUILDING' THEN upper(artist_name) WHEN 'FURNITURE' THEN 'The Band Page'
          ELSE 'plain page' END AS full_name,
        CASE WHEN segment = 'AUTOMOBILE' THEN 'by ' || artist_name
          WHEN segment <> 'HOUSEHOLD' THEN 'daily notes' END AS biography,
        CAST(floor(balance * 15) AS BIGINT) AS followers, CAST(nation * 10 AS BIGINT) AS followees,
        CAST(floor(balance) AS BIGINT) AS mediacount, balance > 5000 AS is_verified
      FROM fx_social_artist""",
    "fx_profile": """
      SELECT * FROM fx_own_profile
      UNION ALL
      SELECT lower(artist_name) || 'music', artist_name, '', CAST(floor(balance * 15) AS BIGINT),
        CAST(nation * 10 AS BIGINT), CAST(floor(balance) AS BIGINT), balance > 5000
      FROM fx_social_artist WHERE region = 3""",
    "fx_post_mean": f"""
      SELECT handle, sum(likes) / count(*) AS mean_likes, sum(comments) / count(*) AS mean_comments,
        count(*) FILTER (is_video) AS reels
      FROM (SELECT *, row_number() OVER ({NEWEST_POST}) AS rn FROM fx_post) WHERE rn <= 12
      GROUP BY handle""",
    "fx_social": """
      SELECT artist_id, artist_name, handle AS instagram_handle, followers AS instagram_followers,
        followees AS instagram_following, mediacount AS instagram_posts,
        mean_likes AS instagram_avg_likes, mean_comments AS instagram_avg_comments,
        (mean_likes + mean_comments) / followers * 100 AS instagram_engagement_rate,
        reels AS instagram_reels_count, is_verified AS instagram_verified
      FROM fx_own_profile JOIN fx_post_mean USING (handle)
      JOIN (SELECT artist_id, artist_name, 'artist' || k AS handle FROM fx_social_artist) USING (handle)""",
    "fx_video": """
      SELECT artist_id, artist_name, 'chan' || k AS youtube_channel_id,
        subscribers AS youtube_subscribers, total_views AS youtube_total_views,
        n_orders AS youtube_video_count,
        round_even(total_views / n_orders, 0) AS youtube_avg_views_per_video
      FROM fx_artist JOIN (
        SELECT k, CAST(sum(comments) * 20 AS BIGINT) AS subscribers,
          CAST(sum(views) AS BIGINT) AS total_views FROM fx_upload GROUP BY k) USING (k)
      WHERE n_orders >= 8""",
    "fx_raw": f"""
      SELECT artist_id, artist_name, collection_date, lastfm_url, lastfm_listeners,
        lastfm_playcount, lastfm_playcount_per_listener, genres, primary_genre,
        {SOCIAL_COLS}, {VIDEO_COLS}, {QUALITY} AS data_quality_score,
        collection_timestamp AS last_updated
      FROM fx_listening
      LEFT JOIN (SELECT artist_id, {SOCIAL_COLS} FROM fx_social) USING (artist_id)
      LEFT JOIN (SELECT artist_id, {VIDEO_COLS} FROM fx_video) USING (artist_id)""",
    "fx_kept_listening": """
      SELECT * EXCLUDE (hours, arrived) FROM (
        SELECT *, CAST(substr(artist_name, 10) AS BIGINT) % 3 AS hours, 0 AS arrived FROM fx_listening
        UNION ALL
        SELECT * REPLACE (lastfm_listeners + 1000 AS lastfm_listeners),
          (CAST(substr(artist_name, 10) AS BIGINT) + 1) % 3, 1 FROM fx_listening
        WHERE CAST(substr(artist_name, 10) AS BIGINT) % 2 = 0
        UNION ALL
        SELECT * REPLACE ('jazz' AS primary_genre), CAST(substr(artist_name, 10) AS BIGINT) % 4, 2
        FROM fx_listening WHERE CAST(substr(artist_name, 10) AS BIGINT) % 5 = 0)
      QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY hours DESC, arrived DESC) = 1""",
    "fx_kept_social": """
      SELECT * EXCLUDE (arrived) FROM (
        SELECT *, 0 AS arrived FROM fx_social WHERE CAST(substr(artist_name, 10) AS BIGINT) % 4 <> 1
        UNION ALL
        SELECT * REPLACE (instagram_followers * 2 AS instagram_followers), 1
        FROM fx_social WHERE CAST(substr(artist_name, 10) AS BIGINT) % 3 = 0)
      QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY arrived DESC) = 1""",
    "fx_kept_raw": f"""
      SELECT artist_id, artist_name, collection_date, lastfm_url, lastfm_listeners,
        lastfm_playcount, lastfm_playcount_per_listener, genres, primary_genre,
        {SOCIAL_COLS}, {VIDEO_COLS}, {QUALITY} AS data_quality_score,
        collection_timestamp AS last_updated
      FROM fx_kept_listening
      LEFT JOIN (SELECT artist_id, {SOCIAL_COLS} FROM fx_kept_social) USING (artist_id)
      LEFT JOIN (SELECT artist_id, {VIDEO_COLS} FROM fx_video) USING (artist_id)""",
    "fx_kept_scored": _scoring("fx_kept_raw", config.TABLE),
    "fx_zero": """
      SELECT * REPLACE (
        coalesce(instagram_verified, false) AS instagram_verified,
        coalesce(lastfm_listeners, 0) AS lastfm_listeners,
        coalesce(lastfm_playcount, 0) AS lastfm_playcount,
        coalesce(instagram_followers, 0) AS instagram_followers,
        coalesce(instagram_following, 0) AS instagram_following,
        coalesce(instagram_posts, 0) AS instagram_posts,
        coalesce(youtube_subscribers, 0) AS youtube_subscribers,
        coalesce(youtube_total_views, 0) AS youtube_total_views,
        coalesce(youtube_video_count, 0) AS youtube_video_count,
        coalesce(lastfm_playcount_per_listener, 0.0) AS lastfm_playcount_per_listener,
        coalesce(instagram_avg_likes, 0.0) AS instagram_avg_likes,
        coalesce(instagram_avg_comments, 0.0) AS instagram_avg_comments,
        coalesce(instagram_engagement_rate, 0.0) AS instagram_engagement_rate,
        coalesce(youtube_avg_views_per_video, 0.0) AS youtube_avg_views_per_video,
        coalesce(data_quality_score, 0.0) AS data_quality_score)
      FROM fx_raw""",
    "fx_scored": _scoring("fx_raw", config.TABLE),
    "fx_channel": """
      SELECT artist_id, channel_id,
        CASE l_returnflag WHEN 'A' THEN artist_name || ' Official' WHEN 'N' THEN artist_name
          ELSE CASE WHEN l_linestatus = 'F' THEN 'Official hits' ELSE 'misc' END END AS title,
        CASE region WHEN 0 THEN 'Official page of ' || artist_name || ' instagram.com/Artist' || k || '?hl=en'
          WHEN 1 THEN 'Welcome' WHEN 2 THEN 'Contact IG: artist' || k
          WHEN 3 THEN 'Mail me at box@example.org'
          ELSE 'with @nobody and @artist' || k END AS description,
        greatest(views - 5000, 0) AS subscribers, views, videos, artist_name
      FROM fx_customer JOIN (
        SELECT k, channel_id, l_returnflag, l_linestatus,
          CAST(sum(views) AS BIGINT) AS views, count(*) AS videos
        FROM fx_upload GROUP BY ALL) USING (k)""",
    "fx_search": """
      SELECT artist_id, channel_id,
        CAST(list_position(['AF', 'AO', 'NF', 'NO', 'RF', 'RO'], l_returnflag || l_linestatus) AS BIGINT)
          AS search_rank
      FROM (SELECT DISTINCT k, channel_id, l_returnflag, l_linestatus FROM fx_upload)
      JOIN fx_customer USING (k)""",
    "fx_channel_video": """
      SELECT channel_id, code AS video_id, p_name AS title,
        CASE WHEN region = 1 THEN 'Out now, follow @artist' || k || '!' ELSE lower(p_name) END AS description,
        views, likes, comments, strftime(day, '%Y-%m-%dT00:00:00Z') AS published_at, day
      FROM fx_upload JOIN part ON l_partkey = p_partkey JOIN fx_customer USING (k)""",
    # how many titles there are is counted first: a subquery within the join would compare all pairs
    "fx_titled_order": """
      SELECT *, o_orderkey % (SELECT count(*) FROM part) AS title_key FROM orders""",
    "fx_chart": """
      SELECT 'tr' || o_orderkey AS track_id, o_orderkey, artist_id, artist_name,
        upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' '
          || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) AS track_name,
        CAST(floor(o_totalprice) AS BIGINT) AS lastfm_playcount,
        CAST(floor(o_totalprice / 7) AS BIGINT) AS lastfm_listeners,
        'https://music.example/track/' || o_orderkey AS lastfm_url,
        1000000 - CAST(floor(o_totalprice) AS BIGINT) AS lastfm_rank,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS release_date,
        instagram_handle
      FROM fx_titled_order
      JOIN part ON p_partkey = title_key
      JOIN fx_customer ON o_custkey = fx_customer.k
      LEFT JOIN (SELECT k AS sk, 'artist' || k AS instagram_handle FROM fx_social_artist) ON o_custkey = sk""",
    "fx_track": """
      SELECT * FROM fx_chart
      QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY lastfm_rank, track_id) <= 10""",
    "fx_track_video": """
      SELECT track_id, video_id AS youtube_video_id, title AS youtube_video_title,
        views AS youtube_views, likes AS youtube_likes, comments AS youtube_comments,
        day AS youtube_published_date, 'https://www.youtube.com/watch?v=' || video_id AS youtube_url
      FROM (SELECT 'tr' || l_orderkey AS track_id, code AS video_id FROM fx_upload
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, code) = 1)
      JOIN fx_channel_video USING (video_id)""",
    "fx_recent_post": f"""
      SELECT *, row_number() OVER ({NEWEST_POST}) AS post_rank FROM fx_post
      QUALIFY post_rank <= 50""",
    "fx_release_post": f"""
      SELECT track_id, post_rank AS instagram_post_rank, shortcode AS instagram_post_id,
        CAST(post_date AS VARCHAR) AS instagram_post_date, likes AS instagram_likes,
        comments AS instagram_comments, left(caption, 200) AS instagram_caption,
        'https://www.instagram.com/p/' || shortcode || '/' AS instagram_url
      FROM fx_chart JOIN fx_recent_post ON instagram_handle = handle
      WHERE (release_date IS NULL OR abs(date_diff('day', release_date, post_date)) <= 30)
        AND {_caption_match('caption', 'track_name')}
      QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY post_rank) = 1""",
    "fx_release_post_all": f"""
      SELECT track_id, post_rank AS instagram_post_rank, shortcode AS instagram_post_id,
        CAST(post_date AS VARCHAR) AS instagram_post_date, likes AS instagram_likes,
        comments AS instagram_comments, left(caption, 200) AS instagram_caption,
        'https://www.instagram.com/p/' || shortcode || '/' AS instagram_url
      FROM fx_chart JOIN (SELECT *, row_number() OVER ({NEWEST_POST}) AS post_rank FROM fx_post)
        ON instagram_handle = handle
      WHERE (release_date IS NULL OR abs(date_diff('day', release_date, post_date)) <= 30)
        AND {_caption_match('caption', 'track_name')}
      QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY post_rank) = 1""",
    "fx_song": f"""
      WITH dated AS MATERIALIZED (
        SELECT c.artist_name, c.track_name, c.lastfm_playcount, c.lastfm_listeners, c.lastfm_url,
          c.lastfm_rank, c.track_id, c.instagram_handle, v.* EXCLUDE (track_id)
        FROM fx_track c LEFT JOIN fx_track_video v USING (track_id)),
      near AS MATERIALIZED (
        SELECT track_id, track_name, caption, post_rank, shortcode, post_date, p.likes, p.comments
        FROM dated d JOIN fx_recent_post p ON d.instagram_handle = p.handle
        WHERE abs(date_diff('day', youtube_published_date, post_date)) <= 30),
      post AS (
        SELECT track_id, shortcode, post_date, likes, comments
        FROM near WHERE {_caption_match('caption', 'track_name')}
        QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY post_rank) = 1)
      SELECT artist_name, track_name, lastfm_playcount, lastfm_listeners, lastfm_url, lastfm_rank,
        youtube_video_id, youtube_views, youtube_likes, youtube_comments,
        CAST(youtube_published_date AS VARCHAR) AS youtube_published_date, youtube_url,
        shortcode AS instagram_post_id, CAST(post_date AS VARCHAR) AS instagram_post_date,
        likes AS instagram_likes, comments AS instagram_comments,
        'https://www.instagram.com/p/' || shortcode || '/' AS instagram_url,
        '2024-01-31' AS collection_date
      FROM dated LEFT JOIN post USING (track_id)""",
    "fx_handle_text": """
      SELECT doc_id, text || CASE doc_id % 7
        WHEN 0 THEN ' instagram.com/Artist' || doc_id || '?y' WHEN 1 THEN ' @Artist' || doc_id
        WHEN 2 THEN ' IG: Artist' || doc_id WHEN 3 THEN ' a@b.com' WHEN 4 THEN ''
        WHEN 5 THEN ' @Artist' || doc_id || ' instagram Artist' || doc_id || '_x'
        ELSE ' @Artist' || doc_id || '.' END AS text
      FROM documents""",
    "fx_batch": """
      SELECT CAST(user_id AS VARCHAR) AS artist_id, event_id, event_type AS source,
        CAST(ts AS DATE) AS batch, ts AS collection_timestamp, value
      FROM events""",
    "fx_latest": """
      SELECT * FROM fx_batch QUALIFY row_number() OVER (
        PARTITION BY artist_id ORDER BY collection_timestamp DESC, event_id DESC) = 1""",
    "fx_log": """
      SELECT '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] [' ||
        CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || '] ' ||
        CASE event_type
          WHEN 'error' THEN 'HTTP 4' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') || ' from source'
          WHEN 'signup' THEN 'Rate limit reached' WHEN 'view' THEN 'Running job ' || event_id
          ELSE 'collected ' || event_id END AS value, event_id
      FROM events""",
    "fx_log_event": r"""
      SELECT substr(value, 2, 19) AS logged_at, regexp_extract(value, '\] \[(\w+)\] ', 1) AS level,
        regexp_extract(value, '\] \[\w+\] (.*)$', 1) AS message,
        contains(lower(value), 'rate limit') OR contains(lower(value), '22 minutes')
          OR contains(value, '401') AS rate_limited,
        contains(value, 'Step') OR contains(value, 'Running') OR contains(value, 'Successfully')
          OR contains(value, 'ERROR') AS progress, event_id
      FROM fx_log""",
    "fx_log_recent": """
      SELECT * FROM fx_log_event ORDER BY event_id DESC LIMIT 50""",
    "fx_hit": f"""
      SELECT artist_name, CASE WHEN segment = 'MACHINERY' THEN 0 ELSE listeners END AS lastfm_listeners,
        'genre:' || genre AS source,
        CAST(coalesce(list_position([{_list(config.SEARCH_TAGS)}], genre) - 1, {len(config.SEARCH_TAGS)}) AS BIGINT) AS search_ord,
        k // 100 AS query_ord,
        row_number() OVER (PARTITION BY genre, k // 100 ORDER BY k) - 1 AS hit_ord
      FROM fx_artist""",
    "fx_home_hit": f"""
      SELECT artist_name, CASE WHEN segment = 'MACHINERY' THEN 0 ELSE listeners END AS lastfm_listeners,
        'uk_top' AS source, {len(config.SEARCH_TAGS) + 1} AS search_ord, k // 100 AS query_ord,
        row_number() OVER (PARTITION BY k // 100 ORDER BY k) - 1 AS hit_ord
      FROM fx_artist JOIN nation ON nation.n_nationkey = fx_artist.nation WHERE n_name = 'NATION_0'""",
    "fx_first_hit": """
      SELECT * FROM fx_hit
      QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY search_ord, source, query_ord, hit_ord) = 1
      UNION ALL
      SELECT * FROM fx_home_hit WHERE artist_name NOT IN (SELECT artist_name FROM fx_hit)
      QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY query_ord, hit_ord) = 1""",
    "fx_info": f"""
      SELECT *, array_to_string(tags, ', ') AS genres, coalesce(tags[1], 'unknown') AS primary_genre,
        CASE WHEN lastfm_listeners > 0 THEN {_exact('lastfm_playcount / lastfm_listeners', 2)}
          ELSE 0.0 END AS lastfm_playcount_per_listener
      FROM (
        SELECT artist_id, artist_name AS query_name, upper(artist_name) AS artist_name,
          CASE WHEN balance >= 0 THEN listeners ELSE 0 END AS lastfm_listeners,
          playcount AS lastfm_playcount,
          CASE WHEN region <> 1 THEN 'https://music.example/' || artist_name ELSE '' END AS lastfm_url,
          CASE WHEN segment <> 'HOUSEHOLD' THEN [genre, segment, 'tag0', 'tag1', 'tag2'] ELSE [] END AS tags,
          'genre:' || genre AS source
        FROM fx_artist WHERE balance >= 0 OR segment NOT IN ('MACHINERY', 'FURNITURE'))""",
    "fx_candidate_channel": f"""
      SELECT s.artist_id, s.channel_id, s.search_rank, c.subscribers, c.views, c.videos, l.artist_name,
        CAST(CASE WHEN contains(lower(c.title), 'official') THEN 10 ELSE 0 END
          + 5 * len(list_filter({_name_words('l.artist_name', config.CHANNEL_STOP_WORDS)}, lambda w: contains(lower(c.title), w)))
          + 2 * len(list_filter({_name_words('l.artist_name', config.CHANNEL_STOP_WORDS)}, lambda w: contains(lower(c.description), w)))
          + CASE WHEN c.subscribers BETWEEN 500 AND 500000 THEN 1 ELSE 0 END AS BIGINT) AS match_score
      FROM fx_search s JOIN fx_channel c USING (channel_id)
      JOIN fx_listening l ON l.artist_id = s.artist_id
      WHERE c.subscribers >= 500""",
    "fx_best_channel": """
      SELECT * FROM (SELECT * FROM fx_candidate_channel
        QUALIFY row_number() OVER (PARTITION BY artist_id
          ORDER BY match_score DESC, subscribers DESC, search_rank, channel_id) = 1)
      WHERE match_score >= 5""",
    "fx_largest_channel": """
      SELECT s.artist_id, s.channel_id, c.subscribers, c.description
      FROM fx_search s JOIN fx_channel c USING (channel_id)
      QUALIFY row_number() OVER (PARTITION BY s.artist_id
        ORDER BY c.subscribers DESC, s.search_rank, s.channel_id) = 1""",
    "fx_channel_handle": _handles("fx_largest_channel", "artist_id", "description"),
    "fx_video_text": f"""
      SELECT artist_id || '#' || rn AS text_id, artist_id, rn, v.description
      FROM (SELECT *, row_number() OVER ({NEWEST_VIDEO}) AS rn FROM fx_channel_video QUALIFY rn <= 5) v
      JOIN fx_largest_channel USING (channel_id)""",
    "fx_video_handle": _handles("fx_video_text", "text_id", "description"),
    "fx_name_handle": """
      SELECT artist_id, unnest(range(4)) AS position,
        unnest([base, replace(base, 'the', ''), base || 'music', base || 'official']) AS handle
      FROM (SELECT artist_id, replace(replace(replace(lower(artist_name), ' ', ''), '.', ''), '-', '') AS base
            FROM fx_listening)""",
    "fx_candidate": """
      SELECT artist_id, 0 AS source_ord, position, handle FROM fx_channel_handle
      UNION ALL
      SELECT artist_id, rn, position, handle FROM fx_video_handle JOIN fx_video_text USING (text_id)
      UNION ALL
      SELECT artist_id, 6, position, handle FROM fx_name_handle""",
    "fx_verified": f"""
      SELECT c.*, l.artist_name FROM fx_candidate c
      JOIN fx_listening l USING (artist_id)
      JOIN (SELECT handle, followers, lower(coalesce(full_name, '')) AS fn,
              lower(coalesce(biography, '')) AS bio FROM fx_profile) p USING (handle)
      WHERE followers >= 5000 AND (
        {_any_in('fn', _name_words('l.artist_name', config.PROFILE_STOP_WORDS))}
        OR {_any_in('bio', _name_words('l.artist_name', config.PROFILE_STOP_WORDS))}
        OR {_any_in('fn', f'[{_list(config.MUSIC_KEYWORDS)}]')}
        OR {_any_in('bio', f'[{_list(config.MUSIC_KEYWORDS)}]')})""",
    "fx_resolved": """
      SELECT artist_id, artist_name, handle, source_ord FROM fx_verified
      QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY source_ord, position, handle) = 1""",
    "fx_measured": f"""
      SELECT handle AS instagram_handle, followers AS instagram_followers,
        followees AS instagram_following, mediacount AS instagram_posts,
        {_exact('mean_likes', 2)} AS instagram_avg_likes,
        {_exact('mean_comments', 2)} AS instagram_avg_comments,
        CASE WHEN followers > 0
          THEN {_exact('(mean_likes + mean_comments) / followers * 100', 2)} ELSE 0.0 END
          AS instagram_engagement_rate,
        reels AS instagram_reels_count, is_verified AS instagram_verified
      FROM fx_profile JOIN fx_post_mean USING (handle) WHERE followers >= 5000""",
    "fx_recent_mean": f"""
      SELECT channel_id, round_even(sum(views) / count(*), 0) AS recent_mean_views
      FROM (SELECT *, row_number() OVER ({NEWEST_VIDEO}) AS rn FROM fx_channel_video)
      WHERE rn <= 10 GROUP BY channel_id""",
    "fx_attempt": """
      SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS collection_date,
        o_orderkey AS attempt_ord, artist_id, o_orderstatus <> 'P' AS matched,
        o_orderstatus = 'F' AS accepted,
        CAST(100 + CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END
          + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS BIGINT) AS units
      FROM orders JOIN fx_customer ON o_custkey = k""",
}

LISTED = "artist_id, artist_name, lastfm_listeners"


def _described(column: str) -> str:
    return f"""
      SELECT '{column}' AS metric, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
        round(min(x), 4) AS min, round(quantile_cont(x, 0.25), 4) AS q25,
        round(quantile_cont(x, 0.5), 4) AS q50, round(quantile_cont(x, 0.75), 4) AS q75,
        round(max(x), 4) AS max
      FROM (SELECT CAST({column} AS DOUBLE) AS x FROM fx_scored)"""


def _histogram(column: str, bins: int) -> str:
    return f"""
      WITH b AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM fx_scored),
      c AS (SELECT least(CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
            FROM fx_scored, b WHERE {column} IS NOT NULL GROUP BY 1)
      SELECT r.range AS bin, round(lo + r.range * ((hi - lo) / {bins}), 6) AS lower_edge,
        round(lo + (r.range + 1) * ((hi - lo) / {bins}), 6) AS upper_edge, coalesce(n, 0) AS artists
      FROM range({bins}) r, b LEFT JOIN c ON c.bin = r.range"""


def _display(source: str, n: int = 50) -> str:
    return f"""
      SELECT row_number() OVER (ORDER BY {BY_SCORE}) AS rank,
        artist_name || ' (' || format('{{:,}}', lastfm_listeners) || ' Last.fm Listeners)' AS artist,
        CASE WHEN instagram_handle IS NULL THEN 'N/A' ELSE '@' || instagram_handle || ' ('
          || format('{{:,}}', coalesce(instagram_followers, 0)) || ' Followers)' END AS instagram_metrics,
        primary_genre AS genre, round_even(priority_score * 100, 0) / 100 AS priority_score,
        growth_potential, round_even(underrated_ratio * 100, 0) / 100 AS underrated_ratio
      FROM (SELECT * FROM {source} ORDER BY {BY_SCORE} LIMIT {n})"""


def _label(rate: str) -> str:
    return (
        f"CASE WHEN {rate} IS NULL THEN 'N/A' WHEN {rate} < 1 THEN format('{{:.3f}}%', {rate}) "
        f"WHEN {rate} < 10 THEN format('{{:.2f}}%', {rate}) ELSE format('{{:.1f}}%', {rate}) END"
    )


TOP_COLS = (
    "artist_name, primary_genre, priority_score, underrated_ratio, engagement_score, "
    "instagram_followers, lastfm_listeners, youtube_subscribers, growth_potential"
)
SCORED_VIEW = (
    "artist_id, artist_name, primary_genre, collection_date, lastfm_listeners, lastfm_playcount, "
    "lastfm_playcount_per_listener, instagram_handle, instagram_followers, "
    "instagram_engagement_rate, instagram_avg_likes, youtube_channel_id, youtube_subscribers, "
    "youtube_total_views, underrated_ratio, engagement_score, platform_count, growth_potential, "
    "priority_score, follower_gap, youtube_avg_views_per_video, data_quality_score"
)
RELEASE_COLS = (
    "instagram_post_rank, instagram_post_id, instagram_post_date, instagram_likes, "
    "instagram_comments, instagram_caption, instagram_url"
)
LATEST = "SELECT artist_id, event_id, source, value FROM fx_latest"
ALL_LISTENING = (
    "artist_id, artist_name, lastfm_listeners, lastfm_playcount, lastfm_playcount_per_listener, "
    "lastfm_url, genres, primary_genre, source, collection_date, collection_timestamp"
)

BODIES: dict[str, str] = {
    "read_source": f"SELECT {ALL_LISTENING} FROM fx_listening",
    "read_source_text": """
      SELECT artist_id, artist_name, lastfm_listeners,
        genres || chr(10) || '"' || primary_genre || '", more' AS genres FROM fx_listening""",
    "read_log": "SELECT logged_at, level, message, rate_limited, progress FROM fx_log_event",
    "insights_top": f"SELECT {TOP_COLS} FROM fx_scored ORDER BY {BY_SCORE} LIMIT 20",
    "insights_growth": f"""
      SELECT artist_name, primary_genre, priority_score, underrated_ratio, instagram_followers,
        lastfm_listeners, follower_gap, engagement_score
      FROM fx_scored WHERE growth_potential = 'High' ORDER BY {BY_SCORE} LIMIT 30""",
    "compact": LATEST,
    "refresh_merged": "SELECT * FROM fx_raw",
    "source_counts_by_time": """
      SELECT source, CAST(batch AS VARCHAR) AS day, count(*) AS n FROM fx_batch
      WHERE batch + INTERVAL 1 DAY <= (SELECT max(collection_timestamp) FROM fx_batch) - INTERVAL 2 DAY
      GROUP BY ALL""",
    "newest_by_state": LATEST,
    "clustered_top": f"SELECT {TOP_COLS} FROM fx_scored ORDER BY {BY_SCORE} LIMIT 50",
    "clustered_rank": f"""
      SELECT row_number() OVER (ORDER BY {BY_SCORE}) AS rank, artist_id, artist_name, priority_score
      FROM fx_scored""",
    "refresh_changes": "SELECT * FROM fx_kept_raw",
    "kept_scores": "SELECT * FROM fx_kept_scored",
    "kept_genre_summary": """
      SELECT primary_genre, count(*) AS artist_count, round(avg(priority_score), 6) AS avg_priority_score,
        round(avg(underrated_ratio), 6) AS avg_underrated_ratio,
        round(avg(engagement_score), 6) AS avg_engagement,
        count(*) FILTER (growth_potential = 'High') AS high_growth_count,
        round(avg(instagram_followers), 6) AS avg_instagram_followers,
        round(avg(lastfm_listeners), 6) AS avg_lastfm_listeners
      FROM fx_kept_scored GROUP BY primary_genre""",
    "kept_growth_summary": """
      SELECT growth_potential, count(artist_name) AS artist_count,
        round_even(avg(priority_score) * 100, 0) / 100 AS avg_priority_score,
        round_even(avg(underrated_ratio) * 100, 0) / 100 AS avg_underrated_ratio
      FROM fx_kept_scored GROUP BY growth_potential""",
    "kept_source_counts": """
      WITH n AS (
        SELECT count(*) AS everything,
          count(*) FILTER (CAST(substr(artist_name, 10) AS BIGINT) % 2 = 0) AS halves,
          count(*) FILTER (CAST(substr(artist_name, 10) AS BIGINT) % 5 = 0) AS fifths FROM fx_listening),
      arrived AS (
        SELECT 'listening' AS source, 0::BIGINT AS batch, everything AS n FROM n
        UNION ALL SELECT 'listening', 1, halves FROM n
        UNION ALL SELECT 'listening', 2, fifths FROM n
        UNION ALL SELECT 'social', 0, count(*) FROM fx_social WHERE CAST(substr(artist_name, 10) AS BIGINT) % 4 <> 1
        UNION ALL SELECT 'social', 2, count(*) FROM fx_social WHERE CAST(substr(artist_name, 10) AS BIGINT) % 3 = 0
        UNION ALL SELECT 'video', 1, count(*) FROM fx_video)
      SELECT source, batch, n, n - lag(n) OVER (PARTITION BY source ORDER BY batch) AS change FROM arrived""",
    "optional_source": """
      SELECT artist_id, instagram_followers, CAST(NULL AS VARCHAR) AS youtube_channel_id,
        CAST(NULL AS BIGINT) AS youtube_subscribers,
        0.3::DOUBLE + CASE WHEN instagram_followers IS NULL THEN 0 ELSE 1 END * 0.4::DOUBLE
          + 0 * 0.3::DOUBLE AS data_quality_score
      FROM fx_listening LEFT JOIN (SELECT artist_id, instagram_followers FROM fx_social) USING (artist_id)""",
    "parse_tag_hits": "SELECT artist_name, lastfm_listeners, source, search_ord, query_ord, hit_ord FROM fx_hit",
    "parse_geo_hits": "SELECT artist_name, lastfm_listeners, source, search_ord, query_ord, hit_ord FROM fx_home_hit",
    "parse_artist_info": """
      SELECT artist_id, query_name, artist_name, lastfm_listeners, lastfm_playcount,
        lastfm_playcount_per_listener, lastfm_url, array_to_string(tags, '|') AS genre_tags, genres,
        primary_genre, source FROM fx_info""",
    "parse_top_tracks": """
      SELECT artist_id, row_number() OVER (PARTITION BY artist_id ORDER BY lastfm_rank, track_id) - 1 AS chart_ord,
        track_name, lastfm_playcount, lastfm_listeners, lastfm_url, lastfm_rank FROM fx_track""",
    "parse_channels": """
      SELECT channel_id, lower(title) AS title, lower(description) AS description,
        CASE WHEN videos > 1 THEN subscribers ELSE 0 END AS subscribers, views, videos FROM fx_channel
      WHERE artist_id NOT IN (SELECT artist_id FROM fx_channel WHERE views % 97 = 0)""",
    "parse_videos": """
      SELECT video_id, title, views, CASE WHEN comments > 2 THEN likes ELSE 0 END AS likes, comments,
        CASE WHEN comments > 1 THEN CAST(day AS VARCHAR) END AS published_date,
        'https://www.youtube.com/watch?v=' || video_id AS url FROM fx_channel_video
      WHERE views % 89 <> 0""",
    "scan_scores": f"SELECT {SCORED_VIEW} FROM fx_scored ORDER BY {BY_SCORE}",
    "write_report_csv": "SELECT artist_name, primary_genre, lastfm_listeners FROM fx_raw",
    "write_raw_table": "SELECT * FROM fx_raw",
    "build_scores_table": "SELECT * FROM fx_scored",
    "artist_id": "SELECT c_custkey, md5(c_name) AS artist_id FROM customer",
    "plays_per_listener": "SELECT artist_id, lastfm_playcount_per_listener AS plays_per_listener FROM fx_listening",
    "genre_tags": "SELECT artist_id, genres, len(tags) AS n_tags FROM fx_info",
    "primary_genre": "SELECT artist_id, primary_genre FROM fx_info",
    "underrated_ratio": f"SELECT artist_id, {RATIO} AS underrated_ratio FROM fx_raw",
    "engagement_score": f"SELECT artist_id, {ENGAGEMENT} AS engagement_score FROM fx_raw",
    "platform_count": f"SELECT artist_id, {PLATFORMS} AS platform_count FROM fx_raw",
    "growth_potential": "SELECT artist_id, " + ", ".join(
        f"{_growth(c)} AS growth_{n}" for n, c in config.PROFILES.items()) + " FROM fx_raw",
    "priority_score": f"SELECT artist_id, {PRIORITY} AS priority_score FROM fx_raw",
    "follower_gap": "SELECT artist_id, instagram_followers - lastfm_listeners AS follower_gap FROM fx_raw",
    "data_quality_score": "SELECT artist_id, data_quality_score FROM fx_raw",
    "zero_fill": "SELECT * FROM fx_zero",
    "channel_avg_views": """
      SELECT channel_id, CASE WHEN videos > 0 THEN round_even(views / videos, 0) ELSE 0.0 END AS avg_views
      FROM fx_channel""",
    "display_rows": _display("fx_scored"),
    "engagement_label": f"SELECT artist_id, {_label('instagram_engagement_rate')} AS engagement FROM fx_raw",
    "handle_clean": "SELECT artist_id, instagram_handle AS handle FROM fx_raw",
    "post_projection": """
      SELECT handle, shortcode AS instagram_post_id, CAST(post_date AS VARCHAR) AS instagram_post_date,
        likes AS instagram_likes, comments AS instagram_comments, left(caption, 200) AS instagram_caption,
        'https://www.instagram.com/p/' || shortcode || '/' AS instagram_url FROM fx_post""",
    "published_date": "SELECT video_id, CAST(day AS VARCHAR) AS published_date FROM fx_channel_video",
    "stamp_collection": """
      SELECT artist_id, collection_date, collection_timestamp, collection_timestamp AS last_updated
      FROM fx_listening""",
    "extract_handles": _handles("fx_handle_text", "doc_id", "text"),
    "name_handle_variants": "SELECT artist_id, position, handle FROM fx_name_handle",
    "name_words": f"""
      SELECT doc_id,
        array_to_string({_name_words('text', config.PROFILE_STOP_WORDS)}, '|') AS profile_words,
        array_to_string({_name_words('text', config.CHANNEL_STOP_WORDS)}, '|') AS channel_words
      FROM documents""",
    "channel_match_score": f"""
      SELECT channel_id, CAST(CASE WHEN contains(lower(title), 'official') THEN 10 ELSE 0 END
        + 5 * len(list_filter({_name_words('l.artist_name', config.CHANNEL_STOP_WORDS)}, lambda w: contains(lower(title), w)))
        + 2 * len(list_filter({_name_words('l.artist_name', config.CHANNEL_STOP_WORDS)}, lambda w: contains(lower(description), w)))
        + CASE WHEN subscribers BETWEEN 500 AND 500000 THEN 1 ELSE 0 END AS BIGINT) AS match_score
      FROM fx_channel JOIN fx_listening l USING (artist_id)""",
    "log_presence_pairs": """
      SELECT artist_id, round(log10(lastfm_listeners), 6) AS log_listeners,
        round(log10(instagram_followers), 6) AS log_followers, round(priority_score, 6) AS priority_score
      FROM fx_scored WHERE lastfm_listeners > 0 AND instagram_followers > 0""",
    "ratio_side": """
      SELECT artist_id, underrated_ratio, CASE WHEN underrated_ratio > 1 THEN 'above'
        WHEN underrated_ratio < 1 THEN 'below' ELSE 'equal' END AS side
      FROM fx_scored WHERE underrated_ratio IS NOT NULL""",
    "ratio_share_above": """
      SELECT count(underrated_ratio) AS artists, count(*) FILTER (underrated_ratio > 1) AS above,
        count(*) FILTER (underrated_ratio > 1) / count(underrated_ratio) AS share_above FROM fx_scored""",
    "emerging_filter": f"SELECT {LISTED} FROM fx_listening WHERE lastfm_listeners BETWEEN 5000 AND 200000",
    "exclude_established": f"""
      SELECT {LISTED} FROM fx_listening WHERE lower(artist_name) NOT IN
        ({_list(config.ESTABLISHED_ARTISTS)}, 'customer#000000003')""",
    "scoring_filter": f"SELECT {LISTED} FROM fx_scored",
    "min_profile_followers": "SELECT handle, followers FROM fx_profile WHERE followers >= 5000",
    "channel_candidates_filter": "SELECT channel_id, subscribers FROM fx_channel WHERE subscribers >= 500",
    "channel_size_filter": """
      SELECT channel_id, subscribers FROM fx_channel WHERE subscribers BETWEEN 500 AND 500000""",
    "caption_mentions_track": f"""
      SELECT track_id, shortcode, {_caption_match('caption', 'track_name')} AS mentioned
      FROM fx_chart JOIN fx_post ON l_orderkey = o_orderkey""",
    "by_growth": f"SELECT {LISTED}, growth_potential FROM fx_scored WHERE growth_potential = 'High'",
    "by_genre": f"""
      SELECT {LISTED}, primary_genre FROM fx_scored WHERE primary_genre IN (
        SELECT DISTINCT primary_genre FROM fx_scored ORDER BY 1 LIMIT 3)""",
    "by_genre_chosen": f"""
      SELECT {LISTED}, primary_genre FROM fx_scored WHERE primary_genre IN ({_list(CHOSEN_GENRES)})""",
    "by_follower_range": f"""
      SELECT {LISTED}, instagram_followers FROM fx_scored
      WHERE instagram_followers IS NULL OR instagram_followers BETWEEN 20000 AND 80000""",
    "complete_artists": f"""
      SELECT {LISTED} FROM fx_scored WHERE instagram_followers IS NOT NULL
        AND youtube_subscribers IS NOT NULL AND lastfm_listeners IS NOT NULL""",
    "with_ratio": f"SELECT {LISTED}, underrated_ratio FROM fx_scored WHERE underrated_ratio IS NOT NULL",
    "by_min_listeners": f"SELECT {LISTED} FROM fx_listening WHERE lastfm_listeners >= 5000",
    "by_engagement": f"""
      SELECT {LISTED}, instagram_engagement_rate FROM fx_scored WHERE instagram_engagement_rate >= 3.0""",
    "write_source_table": "SELECT * FROM fx_social",
    "load_sources": "SELECT * FROM fx_scored",
    "merge_sources": "SELECT * FROM fx_raw",
    "attach_handles": f"""
      SELECT {LISTED}, instagram_handle FROM fx_listening
      LEFT JOIN (SELECT artist_id, instagram_handle FROM fx_social) USING (artist_id)""",
    "verify_handles": "SELECT artist_id, source_ord, position, handle FROM fx_verified",
    "existing_profiles": """
      SELECT artist_id, position, handle FROM fx_name_handle
      WHERE handle IN (SELECT handle FROM fx_profile)""",
    "artist_channel_candidates": """
      SELECT artist_id, channel_id, search_rank, subscribers, match_score FROM fx_candidate_channel""",
    "track_video": """
      SELECT c.track_id, c.artist_id, v.* EXCLUDE (track_id, youtube_published_date),
        CAST(youtube_published_date AS VARCHAR) AS youtube_published_date
      FROM fx_chart c LEFT JOIN fx_track_video v USING (track_id)""",
    "release_posts": f"""
      SELECT track_id, track_name, {RELEASE_COLS} FROM fx_chart LEFT JOIN fx_release_post USING (track_id)""",
    "release_posts_all": f"""
      SELECT track_id, track_name, {RELEASE_COLS} FROM fx_chart LEFT JOIN fx_release_post_all USING (track_id)""",
    "song_records": "SELECT * FROM fx_song",
    "genre_summary": """
      SELECT primary_genre, count(*) AS artist_count, round(avg(priority_score), 6) AS avg_priority_score,
        round(avg(underrated_ratio), 6) AS avg_underrated_ratio,
        round(avg(engagement_score), 6) AS avg_engagement,
        count(*) FILTER (growth_potential = 'High') AS high_growth_count,
        round(avg(instagram_followers), 6) AS avg_instagram_followers,
        round(avg(lastfm_listeners), 6) AS avg_lastfm_listeners
      FROM fx_scored GROUP BY primary_genre""",
    "insights_genres": """
      SELECT primary_genre, count(*) AS artist_count, round(avg(priority_score), 6) AS avg_priority_score,
        round(avg(underrated_ratio), 6) AS avg_underrated_ratio,
        round(avg(engagement_score), 6) AS avg_engagement,
        count(*) FILTER (growth_potential = 'High') AS high_growth_count,
        round(avg(instagram_followers), 6) AS avg_instagram_followers,
        round(avg(lastfm_listeners), 6) AS avg_lastfm_listeners
      FROM fx_scored GROUP BY primary_genre""",
    "growth_summary": """
      SELECT growth_potential, count(artist_name) AS artist_count,
        round_even(avg(priority_score) * 100, 0) / 100 AS avg_priority_score,
        round_even(avg(underrated_ratio) * 100, 0) / 100 AS avg_underrated_ratio
      FROM fx_scored GROUP BY growth_potential""",
    "genre_counts": "SELECT primary_genre, count(*) AS artists FROM fx_scored GROUP BY 1",
    "genre_counts_top": """
      SELECT primary_genre, count(*) AS artists FROM fx_listening GROUP BY 1
      ORDER BY 2 DESC, 1 LIMIT 10""",
    "overview_metrics": """
      SELECT count(*) AS total_artists, count(*) FILTER (growth_potential = 'High') AS high_potential,
        count(DISTINCT primary_genre) AS genres_covered FROM fx_scored""",
    "coverage_counts": """
      SELECT count(*) AS artists, count(instagram_followers) AS with_social,
        count(youtube_subscribers) AS with_video FROM fx_raw""",
    "listener_range_stats": """
      SELECT min(lastfm_listeners) AS min_listeners, max(lastfm_listeners) AS max_listeners,
        count(*) FILTER (lastfm_listeners BETWEEN 5000 AND 150000) AS in_range,
        count(*) FILTER (lastfm_listeners > 150000) AS above_range,
        count(*) FILTER (lastfm_listeners < 5000) AS below_range FROM fx_listening""",
    "source_means": """
      SELECT source, measure, round(value, 6) AS value FROM (
        SELECT 'listening' AS source, 'avg_listeners' AS measure, avg(lastfm_listeners) AS value FROM fx_listening
        UNION ALL SELECT 'listening', 'avg_playcount', avg(lastfm_playcount) FROM fx_listening
        UNION ALL SELECT 'listening', 'avg_plays_per_listener', avg(lastfm_playcount_per_listener) FROM fx_listening
        UNION ALL SELECT 'social', 'avg_followers', avg(instagram_followers) FROM fx_social
        UNION ALL SELECT 'social', 'avg_engagement_rate', avg(instagram_engagement_rate) FROM fx_social
        UNION ALL SELECT 'social', 'in_target_range',
          CAST(count(*) FILTER (instagram_followers BETWEEN 10000 AND 100000) AS DOUBLE) FROM fx_social
        UNION ALL SELECT 'video', 'avg_subscribers', avg(youtube_subscribers) FROM fx_video
        UNION ALL SELECT 'video', 'avg_total_views', avg(youtube_total_views) FROM fx_video
        UNION ALL SELECT 'video', 'avg_views_per_video', avg(youtube_avg_views_per_video) FROM fx_video)""",
    "success_rate": """
      SELECT count(*) AS processed, count(s.artist_id) AS matched,
        round(count(s.artist_id) / count(*) * 100, 6) AS success_rate
      FROM fx_listening l LEFT JOIN fx_social s ON l.artist_id = s.artist_id""",
    "describe_scores": " UNION ALL ".join(_described(c) for c in DESCRIBED),
    "histogram": _histogram("priority_score", 50),
    "ratio_histogram": _histogram("underrated_ratio", 20),
    "platform_normalised": """
      WITH m AS (SELECT max(lastfm_listeners) AS l, max(instagram_followers) AS i,
                   max(youtube_subscribers) AS y FROM fx_scored)
      SELECT artist_id, artist_name, 'Last.fm' AS platform, round(coalesce(lastfm_listeners / l * 100, 0), 6) AS score FROM fx_scored, m
      UNION ALL SELECT artist_id, artist_name, 'Instagram', round(coalesce(instagram_followers / i * 100, 0), 6) FROM fx_scored, m
      UNION ALL SELECT artist_id, artist_name, 'YouTube', round(coalesce(youtube_subscribers / y * 100, 0), 6) FROM fx_scored, m""",
    "key_insights": f"""
      WITH top AS (SELECT * FROM fx_scored ORDER BY {BY_SCORE} LIMIT 20),
      best AS (SELECT primary_genre, count(*) AS n, avg(priority_score) AS s,
          count(*) FILTER (growth_potential = 'High') AS h
        FROM fx_scored GROUP BY 1 ORDER BY s DESC NULLS LAST, 1 LIMIT 1)
      SELECT round((SELECT avg(underrated_ratio) FROM top), 6) AS avg_ratio,
        round((SELECT max(underrated_ratio) FROM top), 6) AS max_ratio,
        (SELECT artist_name FROM top ORDER BY underrated_ratio DESC NULLS LAST, {BY_SCORE} LIMIT 1) AS max_ratio_artist,
        t.artist_name AS top_artist, t.primary_genre AS top_artist_genre,
        t.instagram_followers AS top_artist_followers, t.lastfm_listeners AS top_artist_listeners,
        t.growth_potential AS top_artist_growth, best.primary_genre AS best_genre,
        best.n AS best_genre_artists, round(best.s, 6) AS best_genre_score, best.h AS best_genre_high_growth
      FROM (SELECT * FROM top ORDER BY {BY_SCORE} LIMIT 1) t, best""",
    "source_row_counts": """
      SELECT source, CAST(batch AS VARCHAR) AS batch, n,
        n - lag(n) OVER (PARTITION BY source ORDER BY batch) AS change
      FROM (SELECT source, batch, count(*) AS n FROM fx_batch GROUP BY ALL)""",
    "last_updated": "SELECT max(collection_date) AS last_updated FROM fx_raw",
    "post_engagement": "SELECT * FROM fx_measured",
    "recent_video_mean": "SELECT channel_id, recent_mean_views FROM fx_recent_mean",
    "quota_estimate": "SELECT count(*) AS artists, count(*) * 101 AS estimated_units FROM fx_listening",
    "first_hit_per_artist": "SELECT artist_name, lastfm_listeners, source, search_ord, query_ord, hit_ord FROM fx_first_hit",
    "latest_per_artist": LATEST,
    "display_rank": f"""
      SELECT row_number() OVER (ORDER BY {BY_SCORE}) AS rank, artist_id, artist_name, priority_score
      FROM fx_scored QUALIFY rank <= 50""",
    "full_rank": f"""
      SELECT row_number() OVER (ORDER BY {BY_SCORE}) AS rank, artist_id, artist_name, priority_score
      FROM fx_scored""",
    "latest_posts": f"""
      SELECT handle, shortcode, row_number() OVER ({NEWEST_POST}) AS newest FROM fx_post QUALIFY newest <= 12""",
    "largest_channel": "SELECT artist_id, channel_id, subscribers FROM fx_largest_channel",
    "best_channel": "SELECT artist_id, channel_id, subscribers, match_score FROM fx_best_channel",
    "resolve_handle": "SELECT * FROM fx_resolved",
    "recent_videos": f"""
      SELECT channel_id, video_id, row_number() OVER ({NEWEST_VIDEO}) AS newest
      FROM fx_channel_video QUALIFY newest <= 10""",
    "default_artist": f"""
      SELECT {LISTED} FROM fx_scored
      ORDER BY (instagram_followers IS NOT NULL AND youtube_subscribers IS NOT NULL) DESC, {BY_SCORE} LIMIT 1""",
    "top_tracks": "SELECT artist_id, track_id, lastfm_rank FROM fx_track",
    "payload_account": """
      WITH a AS (SELECT count(*) AS n, count(*) FILTER (balance < 0 AND segment = 'MACHINERY') AS unreadable,
          count(*) FILTER (balance < 0 AND segment = 'FURNITURE') AS broken FROM fx_artist),
      c AS (SELECT count(*) AS n, count(*) FILTER (bad) AS broken
            FROM (SELECT artist_id, bool_or(views % 97 = 0) AS bad FROM fx_channel GROUP BY artist_id)),
      v AS (SELECT count(*) AS n, count(*) FILTER (views % 89 = 0) AS broken FROM fx_channel_video)
      SELECT 'artist_info' AS kind, n AS payloads, n - unreadable - broken AS accepted, unreadable,
        0::BIGINT AS incomplete, broken FROM a
      UNION ALL SELECT 'channels', n, n - broken, 0, 0, broken FROM c
      UNION ALL SELECT 'videos', n, n - broken, 0, 0, broken FROM v""",
    "payload_rejects": """
      SELECT query_name, 'accepted' AS fate FROM fx_info
      UNION ALL
      SELECT artist_name, CASE segment WHEN 'MACHINERY' THEN 'unreadable' ELSE 'broken number' END
      FROM fx_artist WHERE balance < 0 AND segment IN ('MACHINERY', 'FURNITURE')""",
    "quota_prefix": """
      WITH s AS (SELECT *, sum(units) OVER (PARTITION BY collection_date ORDER BY attempt_ord) AS spent FROM fx_attempt),
      stop AS (SELECT collection_date, min(attempt_ord) AS stopped_at FROM s
               WHERE spent > 9000 AND NOT (matched AND NOT accepted) GROUP BY 1)
      SELECT CAST(s.collection_date AS VARCHAR) AS collection_date, attempt_ord, artist_id, matched, accepted, units
      FROM s LEFT JOIN stop ON s.collection_date = stop.collection_date
      WHERE stopped_at IS NULL OR attempt_ord <= stopped_at""",
    "first_matching_post": """
      SELECT track_id, instagram_post_rank, instagram_post_id FROM fx_release_post
      WHERE track_id IN (SELECT track_id FROM fx_track)""",
    "top_underrated": f"SELECT {TOP_COLS} FROM fx_scored ORDER BY {BY_SCORE} LIMIT 50",
    "high_growth": f"""
      SELECT artist_name, primary_genre, priority_score, underrated_ratio, instagram_followers,
        lastfm_listeners, follower_gap, engagement_score
      FROM fx_scored WHERE growth_potential = 'High' ORDER BY {BY_SCORE} LIMIT 30""",
    "scored_artists": "SELECT * FROM fx_scored",
    "scored_artists_generated": _scoring("fx_raw", config.GENERATED),
    "scored_artists_documented": _scoring("fx_raw", config.DOCUMENTED),
    "score_zero_filled": _scoring("fx_zero", config.TABLE),
    "sample_rows": f"SELECT {LISTED} FROM fx_raw ORDER BY artist_id LIMIT 1000",
    "option_lists": """
      SELECT DISTINCT 'artist' AS option_list, artist_name AS value FROM fx_scored
      UNION ALL SELECT DISTINCT 'genre', primary_genre FROM fx_scored""",
    "artist_detail": f"""
      SELECT artist_name, lastfm_listeners, lastfm_playcount, instagram_followers,
        {_label('instagram_engagement_rate')} AS engagement, youtube_subscribers, youtube_total_views
      FROM fx_scored WHERE growth_potential = 'High'
      ORDER BY (artist_name = '{CHOSEN_ARTIST}') DESC, {BY_SCORE} LIMIT 1""",
    "top3_flag": f"""
      SELECT row_number() OVER (ORDER BY {BY_SCORE}) AS rank, artist_id, rank <= 3 AS highlighted
      FROM fx_scored QUALIFY rank <= 50""",
    "discover": "SELECT artist_name, lastfm_listeners, source, search_ord, query_ord, hit_ord FROM fx_first_hit",
    "append_batch": f"""
      SELECT artist_id, event_id, source, value,
        CASE WHEN batch < DATE '{SPLIT_DAY}' THEN CAST(batch AS VARCHAR) END AS batch FROM fx_latest""",
    "dashboard_view": _display(f"""(SELECT * FROM fx_scored
      WHERE primary_genre IN ({_list(CHOSEN_GENRES)})
        AND (instagram_followers IS NULL OR instagram_followers BETWEEN 10000 AND 90000)
        AND instagram_engagement_rate >= 2.0)"""),
    "stream_upsert": LATEST,
    "batch_stats": f"""
      WITH b AS (SELECT artist_id, CAST(CASE WHEN batch < DATE '{SPLIT_DAY}' THEN 0 ELSE 1 END AS BIGINT) AS batch FROM fx_batch)
      SELECT batch, 'listening' AS source, count(*) AS arrived, count(DISTINCT artist_id) AS artists,
        count(DISTINCT artist_id) FILTER (batch = 0 OR artist_id NOT IN (SELECT artist_id FROM b WHERE batch = 0))
          AS new_artists
      FROM b GROUP BY batch""",
    "resume": """
      SELECT CAST(2 AS BIGINT) AS batches, count(*) AS arrived, count(DISTINCT artist_id) AS artists
      FROM fx_batch""",
    "log_events": "SELECT logged_at, level, message, rate_limited, progress FROM fx_log_event",
    "recent_log_events": "SELECT logged_at, level, message, rate_limited, progress FROM fx_log_recent",
    "rate_limit_seen": "SELECT count(*) AS lines, bool_or(rate_limited) AS rate_limited FROM fx_log_recent",
    "recent_progress": """
      SELECT logged_at, level, message, rate_limited, progress FROM (
        SELECT * FROM fx_log_event ORDER BY event_id DESC LIMIT 10)
      WHERE progress ORDER BY event_id DESC LIMIT 5""",
    "discover_artists": f"""
      SELECT i.artist_id, i.artist_name, i.lastfm_listeners, i.lastfm_playcount,
        i.lastfm_playcount_per_listener, i.lastfm_url, i.genres, i.primary_genre, h.source,
        '2024-01-31' AS collection_date, '2024-01-31 00:00:00' AS collection_timestamp
      FROM fx_info i JOIN fx_first_hit h ON i.query_name = h.artist_name
      WHERE i.lastfm_listeners BETWEEN 5000 AND 200000
        AND lower(i.artist_name) NOT IN ({_list(config.ESTABLISHED_ARTISTS)})""",
    "social_profiles": f"""
      SELECT r.artist_id, r.artist_name, {SOCIAL_COLS}
      FROM fx_resolved r JOIN fx_measured ON r.handle = instagram_handle""",
    "video_channels": """
      SELECT artist_id, artist_name, channel_id AS youtube_channel_id, subscribers AS youtube_subscribers,
        views AS youtube_total_views, videos AS youtube_video_count,
        coalesce(recent_mean_views, 0) AS youtube_avg_views_per_video
      FROM fx_best_channel LEFT JOIN fx_recent_mean USING (channel_id)
      WHERE subscribers BETWEEN 500 AND 500000""",
    "song_catalogue": """
      SELECT s.* EXCLUDE (instagram_post_id, instagram_post_date, instagram_likes, instagram_comments, instagram_url),
        instagram_post_id, instagram_post_date, instagram_likes, instagram_comments, instagram_url
      FROM fx_song s""",
}


def _needed(body: str) -> list[str]:
    """Relations a statement uses, each after the ones it builds on."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in sorted(set(re.findall(r"\bfx_\w+", sql))):
            if name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(body)
    return ordered


BODIES["quota_prefix_ranges"] = BODIES["quota_prefix"]


def statement(body: str) -> str:
    relations = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(body))
    return f"WITH {relations}\nSELECT * FROM ({body})" if relations else body


def oracle_sql() -> dict[str, str]:
    return {key: statement(body) for key, body in BODIES.items()}
