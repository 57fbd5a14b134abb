"""The queries in SQL (DuckDB), over the given tables only."""

import re

from workload.inputs import BACKFILL

CLEAN = r"""nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(title),
    '\([^)]*\)|\[[^\]]*\]', ' ', 'g'), ' - .*$', '', 'g'), '[^\p{L}\p{N} ]', '', 'g'), ' +', ' ', 'g')), '')"""

# Derived inputs, then steps of the queries. A query gets those that it, or another one it gets, names.
STEPS = {
    "tracks": """
        SELECT p_partkey * 2 AS id, CAST(p_partkey AS VARCHAR) AS trackGroup,
               CAST(p_partkey // 8 AS VARCHAR) AS masterBundleId, p_partkey AS videoId,
               p_name || CASE p_partkey % 4 WHEN 1 THEN ' (Live)' WHEN 2 THEN ' - Remastered 2011'
                                            WHEN 3 THEN ' [feat. X]' ELSE '' END AS title,
               [p_partkey % 40] AS mainArtistsIds
        FROM part
        UNION ALL
        SELECT p_partkey * 2 + 1, CAST(p_partkey AS VARCHAR), CAST(p_partkey // 8 AS VARCHAR), p_partkey,
               'another ' || p_name, [(p_partkey + 1) % 40, p_partkey % 40]
        FROM part WHERE p_partkey % 5 = 0""",
    "available": """
        SELECT CAST(p_partkey AS VARCHAR) AS trackGroup, n_name AS countryCode
        FROM part CROSS JOIN nation WHERE (p_partkey + n_nationkey) % 3 <> 0""",
    "artist_ids": "SELECT DISTINCT p_partkey % 40 AS artistId FROM part",
    "artists": """
        SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey % 5 <> 0 THEN 'picture-' || n_nationkey END AS picture
        FROM nation""",
    "clusters": "SELECT n_nationkey AS artistId, n_regionkey AS cluster FROM nation",
    "neighbours": """
        SELECT n_nationkey AS artistId, (n_nationkey + s.step) % 40 AS neighbour, s.place
        FROM nation CROSS JOIN (VALUES (1, 0), (3, 1), (7, 2), (12, 3)) s(step, place)""",
    "compounds": """
        SELECT artistId, (artistId - m.back) % 32 AS artistCompoundId, m.priority, m.main AS mainArtist
        FROM artist_ids CROSS JOIN (VALUES (31, 2, true), (32, 1, true), (30, 0, false)) m(back, priority, main)
        WHERE artistId >= 32""",
    "users": """
        SELECT c_custkey AS id, n_name AS countryCode, c_mktsegment AS segment
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "recs": """
        SELECT c_custkey AS userId, CAST(p_partkey AS VARCHAR) AS trackGroup,
               CAST(row_number() OVER (PARTITION BY c_custkey
                                       ORDER BY (p_partkey + 1) * (c_custkey + 17) % 100003,
                                                CAST(p_partkey AS VARCHAR)) - 1
                    AS INTEGER) AS pos
        FROM customer JOIN part
          ON p_partkey // 40 % (SELECT greatest(1, count(*) // 200) FROM part)
             = c_custkey % (SELECT greatest(1, count(*) // 200) FROM part)""",
    "plays": """
        SELECT o_custkey AS userId, l_partkey AS part, l_linenumber, l_quantity, l_returnflag, o_orderdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "track_history": f"""
        SELECT h.*, {CLEAN} AS cleanedTitle
        FROM (SELECT userId, CAST(part AS VARCHAR) AS trackGroup, count(*) AS count, max(o_orderdate) AS dt
              FROM plays GROUP BY userId, part) h JOIN meta USING (trackGroup)""",
    "artist_history": """
        SELECT userId, part % 40 AS artistId, count(*) AS count, max(o_orderdate) AS dt
        FROM plays GROUP BY userId, part % 40""",
    "album_history": """
        SELECT userId, CAST(part // 8 AS VARCHAR) AS masterBundleId, count(*) AS count
        FROM plays GROUP BY userId, part""",
    "favourite_tracks": "SELECT userId, CAST(part AS VARCHAR) AS trackGroup FROM plays WHERE l_quantity = 50",
    "favourite_artists": "SELECT userId, part % 40 AS artistId FROM plays WHERE l_quantity >= 49",
    "blacklist": """
        SELECT CAST(userId AS VARCHAR) AS userId,
               CASE WHEN l_returnflag = 'R' THEN 'TRACK'
                    WHEN l_returnflag = 'A' AND l_quantity = 1 THEN 'ARTIST'
                    WHEN l_returnflag = 'N' AND l_quantity = 2 THEN 'VIDEO' END AS artifactType,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'artist-' || part
                    WHEN l_returnflag = 'A' THEN CAST(part % 40 AS VARCHAR)
                    ELSE CAST(part AS VARCHAR) END AS artifactId
        FROM plays""",
    "mixes": """
        SELECT CAST(userId AS INTEGER) AS user, list(trackGroup ORDER BY pos, trackGroup) AS tracks,
               substr(md5('discovery_mix_' || userId), 1, 27) AS mixId, '2001-08-01' AS atDate
        FROM (SELECT * FROM cand c
              WHERE NOT EXISTS (SELECT 1 FROM track_history x WHERE x.userId = c.userId AND x.trackGroup = c.trackGroup)
              QUALIFY row_number() OVER (PARTITION BY userId, artistId ORDER BY pos, trackGroup) <= 2)
        GROUP BY userId""",
    "observed": """
        SELECT substr(md5('discovery_mix_' || c_custkey), 1, 27) AS mixId
        FROM customer CROSS JOIN (VALUES (1), (2)) t(time)
        WHERE c_custkey % 3 = 0 AND (t.time = 1 OR c_custkey % 2 = 0)""",
    "observed_tracks": "SELECT user, unnest(tracks) AS trackGroup FROM mixes JOIN observed USING (mixId)",
    "cards": """
        SELECT userId, pos, id, 'Artist ' || id AS name,
               CASE WHEN id % 7 = 0 THEN '' WHEN id % 5 <> 0 THEN 'image-' || id END AS image,
               CASE WHEN id % 3 <> 0 THEN 'cover-' || id END AS cover
        FROM (SELECT userId, pos, CAST(trackGroup AS INTEGER) % 40 AS id FROM recs)""",
    "sequence": """
        SELECT user_id AS user, index,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS place,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS back
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS index FROM events)
        WHERE index IS NOT NULL""",
    "vocabulary": "SELECT s_name AS item, s_suppkey AS index FROM supplier",
    # Steps
    "meta": """
        SELECT trackGroup, mainArtistsIds[1] AS artistId, title FROM tracks
        QUALIFY row_number() OVER (PARTITION BY trackGroup ORDER BY id) = 1""",
    "cand": "SELECT userId, trackGroup, artistId, pos FROM recs JOIN meta USING (trackGroup)",
    "heard": """
        SELECT userId, trackGroup, cleanedTitle FROM track_history
        WHERE count >= 2 OR dt >= TIMESTAMP '2001-08-01' - INTERVAL 12 MONTH""",
    "blocked": """
        SELECT TRY_CAST(userId AS BIGINT) AS userId, artifactType, artifactId,
               TRY_CAST(artifactId AS BIGINT) AS number FROM blacklist WHERE artifactType IS NOT NULL""",
    "blocked_artists": """
        SELECT userId, number AS artistId FROM blocked WHERE artifactType = 'ARTIST'
        UNION ALL
        SELECT b.userId, c.artistId FROM blocked b JOIN compounds c ON c.artistCompoundId = b.number
        WHERE b.artifactType = 'ARTIST'""",
    "albums": "SELECT userId, masterBundleId, CAST(sum(count) AS BIGINT) AS plays FROM album_history GROUP BY ALL",
    "known": """
        SELECT userId, artistId FROM artist_history
        WHERE count >= 3 OR dt >= TIMESTAMP '2001-08-01' - INTERVAL 6 MONTH
        UNION
        SELECT userId, artistId FROM favourite_artists""",
    "flagged": """
        SELECT c.userId, c.artistId, c.trackGroup, CASE WHEN k.userId IS NULL THEN 0 ELSE 1 END AS knownArtist, c.pos
        FROM cand c LEFT JOIN known k ON k.userId = c.userId AND k.artistId = c.artistId""",
    "unheard": """
        SELECT r.userId, m.artistId, r.trackGroup, CASE WHEN k.userId IS NULL THEN 0 ELSE 1 END AS knownArtist, r.pos
        FROM recs r JOIN users u ON u.id = r.userId
        JOIN titled m ON m.trackGroup = r.trackGroup
        JOIN available a ON a.trackGroup = r.trackGroup AND a.countryCode = u.countryCode
        LEFT JOIN known k ON k.userId = r.userId AND k.artistId = m.artistId
        WHERE NOT EXISTS (SELECT 1 FROM blocked x WHERE x.artifactType = 'TRACK' AND x.userId = r.userId
                          AND x.artifactId = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM blocked_artists x WHERE x.userId = r.userId AND x.artistId = m.artistId)
          AND NOT EXISTS (SELECT 1 FROM observed_tracks x WHERE x.user = r.userId AND x.trackGroup = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = r.userId AND x.trackGroup = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = r.userId AND x.cleanedTitle = m.cleanedTitle)
          AND NOT EXISTS (SELECT 1 FROM favourite_tracks x WHERE x.userId = r.userId
                          AND x.trackGroup = r.trackGroup)""",
    "titled": f"SELECT trackGroup, artistId, {CLEAN} AS cleanedTitle FROM meta",
}


def ranking(prefix: str, source: str, size: int, known_cap: int) -> dict[str, str]:
    """The steps from flagged candidates to ordered mixes of ``size``."""
    gap = size // 7
    unknown_cap = size - known_cap
    return {
        f"{prefix}_top": f"""
            SELECT * FROM {source}
            QUALIFY row_number() OVER (PARTITION BY userId, artistId ORDER BY pos, trackGroup) = 1""",
        f"{prefix}_supply": f"""
            SELECT *, sum(knownArtist) OVER (PARTITION BY userId) AS k,
                   count(artistId) OVER (PARTITION BY userId) - sum(knownArtist) OVER (PARTITION BY userId) AS u,
                   row_number() OVER (PARTITION BY userId, knownArtist ORDER BY pos, trackGroup) AS place
            FROM {prefix}_top""",
        f"{prefix}_split": f"""
            SELECT userId, artistId, trackGroup, knownArtist, pos FROM {prefix}_supply
            WHERE place <= CASE WHEN knownArtist = 1
                                THEN CASE WHEN u < {unknown_cap} THEN {size} - u ELSE {known_cap} END
                                ELSE CASE WHEN k < {known_cap} THEN {size} - k ELSE {unknown_cap} END END""",
        f"{prefix}_groups": f"""
            SELECT s.*, c.cluster,
                   min(pos) OVER (PARTITION BY userId, cluster) AS f1,
                   min(pos) OVER (PARTITION BY userId, s.artistId) AS f2,
                   row_number() OVER (PARTITION BY userId, cluster ORDER BY pos, trackGroup) - 1 AS i1,
                   row_number() OVER (PARTITION BY userId, s.artistId ORDER BY pos, trackGroup) - 1 AS i2
            FROM {prefix}_split s LEFT JOIN clusters c ON c.artistId = s.artistId""",
        f"{prefix}_scored": f"""
            SELECT *, least(dense_rank() OVER (PARTITION BY userId ORDER BY f1),
                            dense_rank() OVER (PARTITION BY userId ORDER BY f2)) - 1 + {gap} * greatest(i1, i2) AS score
            FROM {prefix}_groups""",
        f"{prefix}_diverse": f"""
            SELECT userId, trackGroup, knownArtist,
                   CAST(row_number() OVER (PARTITION BY userId ORDER BY score, pos DESC, trackGroup) AS INTEGER) AS rank
            FROM {prefix}_scored""",
        f"{prefix}_nth": f"""
            SELECT *, sum(knownArtist) OVER (PARTITION BY userId) AS k,
                   row_number() OVER (PARTITION BY userId, knownArtist ORDER BY rank, trackGroup) AS nth
            FROM {prefix}_diverse""",
        f"{prefix}_spread": f"""
            SELECT userId, trackGroup, rank AS innerRank,
                   CAST(nth * CASE WHEN knownArtist = 1 THEN {size} - k ELSE k END AS BIGINT) AS rank
            FROM {prefix}_nth""",
    }


STEPS |= ranking("small", "flagged", 14, 2)
STEPS |= ranking("mix", "unheard", 35, 7)


def mixes_of(prefix: str, min_size: int) -> str:
    return f"""
        SELECT CAST(userId AS INTEGER) AS user,
               string_agg(trackGroup, ',' ORDER BY rank, innerRank, trackGroup) AS tracks,
               substr(md5('discovery_mix_' || userId), 1, 27) AS mixId, '2001-08-01' AS atDate
        FROM {prefix}_spread GROUP BY userId HAVING count(*) >= {min_size}"""


def remaining(excluded: str, condition: str) -> str:
    return f"""
        SELECT userId, trackGroup, artistId, pos FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM {excluded} x WHERE {condition})"""


SAME_TRACK = "x.userId = c.userId AND x.trackGroup = c.trackGroup"
SAME_ARTIST = "x.userId = c.userId AND x.artistId = c.artistId"
BLOCKED_TRACK = "x.artifactType = 'TRACK' AND x.userId = c.userId AND x.artifactId = c.trackGroup"
BLOCKED_VIDEO = "x.artifactType = 'VIDEO' AND x.userId = c.userId AND x.number = CAST(c.trackGroup AS BIGINT)"


def picks(condition: str, columns: str) -> str:
    return f"""
        SELECT userId, position, {columns} FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY pos) - 1 AS INTEGER) AS position FROM (
                SELECT * FROM cards WHERE {condition}
                QUALIFY row_number() OVER (PARTITION BY userId, id ORDER BY pos) = 1))
        WHERE position < 5"""


QUERIES = {
    "explode_recommendations": "SELECT userId, trackGroup, pos FROM recs",
    "explode_map": """
        SELECT event_id, CAST(0 AS INTEGER) AS pos, unnest(json_keys(props)) AS name,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS number FROM events""",
    "user_country": "SELECT id AS userId, countryCode FROM users",
    "recs_with_country": """
        SELECT userId, countryCode, trackGroup, pos FROM recs JOIN users ON id = userId""",
    "track_group_metadata": "SELECT trackGroup, artistId, title FROM meta",
    "recs_with_metadata": "SELECT userId, trackGroup, pos, artistId, title FROM recs JOIN meta USING (trackGroup)",
    "available_in_country": """
        SELECT userId, trackGroup, pos FROM recs JOIN users ON id = userId
        JOIN available USING (trackGroup, countryCode)""",
    "filter_blacklisted_tracks": remaining("blocked", BLOCKED_TRACK),
    "filter_blacklisted_videos": remaining("blocked", BLOCKED_VIDEO),
    "filter_blacklisted_artists": remaining("blocked_artists", SAME_ARTIST),
    "filter_blacklist_all": f"""
        SELECT userId, trackGroup, artistId, pos FROM cand c
        WHERE NOT EXISTS (SELECT 1 FROM blocked x WHERE {BLOCKED_TRACK})
          AND NOT EXISTS (SELECT 1 FROM blocked x WHERE {BLOCKED_VIDEO})
          AND NOT EXISTS (SELECT 1 FROM blocked_artists x WHERE {SAME_ARTIST})""",
    "filter_heard_tracks": remaining("heard", SAME_TRACK),
    "filter_observed_tracks": remaining("observed_tracks", "x.user = c.userId AND x.trackGroup = c.trackGroup"),
    "filter_favourite_tracks": remaining("favourite_tracks", SAME_TRACK),
    "filter_heard_titles": """
        SELECT userId, trackGroup, c.artistId, pos FROM cand c JOIN titled t USING (trackGroup)
        WHERE NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = c.userId AND x.cleanedTitle = t.cleanedTitle)""",
    "album_play_counts": "SELECT userId, masterBundleId, plays FROM albums WHERE plays >= 2",
    "filter_heard_albums": """
        SELECT userId, trackGroup, artistId, pos, masterBundleId
        FROM cand c JOIN (SELECT DISTINCT trackGroup, masterBundleId FROM tracks) t USING (trackGroup)
        WHERE NOT EXISTS (SELECT 1 FROM albums x WHERE x.plays >= 2 AND x.userId = c.userId
                          AND x.masterBundleId = t.masterBundleId)""",
    "known_artists": "SELECT userId, artistId FROM known",
    "flag_known_artists": "SELECT userId, artistId, trackGroup, knownArtist, pos FROM flagged",
    "enrich_artist_cluster": """
        SELECT userId, trackGroup, c.artistId, pos, cluster
        FROM cand c LEFT JOIN clusters k ON k.artistId = c.artistId""",
    "enrich_similar_artists": """
        SELECT userId, neighbour AS artistId, place AS enriched_position, 1 AS enriched
        FROM known JOIN neighbours USING (artistId) WHERE place < 3""",
    "enrich_artist_metadata": """
        SELECT userId, artistId, name, picture AS image FROM known JOIN artists ON id = artistId""",
    "enrich_user": """
        SELECT userId, trackGroup, pos, countryCode AS country, segment
        FROM recs LEFT JOIN users ON id = userId""",
    "resolve_main_artist": """
        SELECT userId, trackGroup, coalesce(m.artistCompoundId, c.artistId) AS artistId, pos
        FROM cand c LEFT JOIN (SELECT * FROM compounds WHERE mainArtist
                               QUALIFY row_number() OVER (PARTITION BY artistId ORDER BY priority) = 1) m
          ON m.artistId = c.artistId""",
    "top_track_per_artist": "SELECT userId, artistId, trackGroup, pos FROM small_top",
    "split_known_unknown": "SELECT userId, trackGroup, knownArtist, pos FROM small_split",
    "diversity_rank": "SELECT userId, trackGroup, rank FROM small_diverse",
    "spread_known_artists": "SELECT userId, trackGroup, rank, innerRank FROM small_spread",
    "assemble_discovery_mix": mixes_of("small", 10),
    "assemble_artist_mix": """
        SELECT CAST(artistId AS INTEGER) AS artistId, string_agg(trackGroup, ',' ORDER BY place) AS tracks,
               substr(md5('artist_top_tracks_mix_' || artistId), 1, 27) AS mixId, '2001-08-01' AS atDate
        FROM (SELECT artistId, trackGroup,
                     row_number() OVER (PARTITION BY artistId ORDER BY times DESC, trackGroup) AS place
              FROM (SELECT CAST(part AS VARCHAR) AS trackGroup, count(*) AS times FROM plays GROUP BY part)
              JOIN meta USING (trackGroup))
        GROUP BY artistId""",
    "mix_id": "SELECT c_custkey AS userId, substr(md5('discovery_mix_' || c_custkey), 1, 27) AS mixId FROM customer",
    "mix_id_stable": "SELECT c_name AS name, substr(md5(c_name), 1, 27) AS mixId FROM customer",
    "clean_title": f"SELECT id, title, {CLEAN} AS cleanedTitle FROM tracks",
    "mix_timestamps": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS atDate,
               CAST(round_even(epoch_us(ts) / 1000.0, 0) AS BIGINT) AS updated FROM events""",
    "pick_top_artists": picks("image <> ''", "id, name, image"),
    "pick_top_artists_with_cover": picks("image <> '' AND cover <> ''", "id, name, image, cover"),
    "last_n_items": """
        SELECT user, CAST(row_number() OVER (PARTITION BY user ORDER BY place) - 1 AS INTEGER) AS position,
               index AS item
        FROM sequence WHERE back <= 20""",
    "vocabulary_decode": """
        SELECT s.user, CAST(row_number() OVER (PARTITION BY s.user ORDER BY s.place) - 1 AS INTEGER) AS position, v.item
        FROM sequence s LEFT JOIN vocabulary v ON v.index = s.index""",
    "score_sequences": """
        SELECT s.user, n.position, v.item
        FROM sequence s LEFT JOIN (
            SELECT index, next,
                   CAST(row_number() OVER (PARTITION BY index ORDER BY times DESC, next) - 1 AS INTEGER) AS position
            FROM (SELECT a.index, b.index AS next, count(*) AS times
                  FROM (SELECT * FROM sequence WHERE back <= 500) a
                  JOIN (SELECT * FROM sequence WHERE back <= 500) b ON b.user = a.user AND b.place = a.place + 1
                  GROUP BY ALL)) n
          ON n.index = s.index AND n.position < 10
        LEFT JOIN vocabulary v ON v.index = n.next
        WHERE s.back = 1""",
    "score_sequences_with_model": """
        SELECT f.user, CAST(f.place - 1 AS INTEGER) AS position, v.item
        FROM (SELECT user, index, row_number() OVER (PARTITION BY user ORDER BY count(*) DESC, index) AS place
              FROM sequence WHERE back <= 50 GROUP BY user, index) f
        LEFT JOIN vocabulary v ON v.index = f.index
        WHERE f.place <= 10""",
    "observed_tracks": "SELECT user, trackGroup FROM observed_tracks",
    "daily_slice": """
        SELECT user, coalesce(array_to_string(tracks[61:70], ','), '') AS tracks, mixId, atDate FROM mixes""",
    "daily_mix": """
        SELECT user, array_to_string(tracks[61:70], ',') AS tracks, mixId, atDate,
               epoch_ms(TIMESTAMP '2001-08-05 04:05:06') AS updated
        FROM mixes WHERE len(tracks[61:70]) >= 8""",
    "discovery_mix": mixes_of("mix", 34),
    "current_mixes": "SELECT user, array_to_string(tracks, ',') AS tracks, mixId, atDate FROM mixes",
    "mix_quality_report": """
        SELECT c.name AS check, CAST(CASE c.name
            WHEN 'rows' THEN (SELECT count(*) FROM mixes)
            WHEN 'null_owners' THEN (SELECT count(*) FROM mixes WHERE user IS NULL)
            WHEN 'repeated_owners' THEN (SELECT count(*) FROM (SELECT user FROM mixes WHERE user IS NOT NULL
                                                               GROUP BY user HAVING count(*) > 1))
            WHEN 'null_tracks' THEN (SELECT count(*) FROM mixes WHERE tracks IS NULL)
            WHEN 'too_short' THEN (SELECT count(*) FROM mixes WHERE len(tracks) < 72)
            WHEN 'too_long' THEN (SELECT count(*) FROM mixes WHERE len(tracks) > 79) END AS BIGINT) AS value
        FROM (VALUES ('rows'), ('null_owners'), ('repeated_owners'),
                     ('null_tracks'), ('too_short'), ('too_long')) c(name)""",
}


WEEK = "SELECT user, tracks, mixId, '2001-08-01' AS atDate FROM mixes"
BEFORE = "SELECT user, list_reverse(tracks) AS tracks, mixId, '2001-07-25' AS atDate FROM mixes"
# The commits one after the other: the last of each user counts.
REPLAYED = f"""
    SELECT * FROM (
        SELECT *, 1 AS version, false AS gone FROM ({BEFORE})
        UNION ALL SELECT *, 2, false FROM ({WEEK}) WHERE user % 3 <> 0
        UNION ALL SELECT user, tracks[1:40], mixId, atDate, 3, false FROM ({WEEK}) WHERE user % 10 = 0 AND user % 7 <> 3
        UNION ALL SELECT user, NULL, NULL, NULL, 3, true FROM mixes WHERE user % 7 = 3
        UNION ALL SELECT *, 4, false FROM ({WEEK}) WHERE user % 14 = 3)
    WHERE version <= {{until}} QUALIFY row_number() OVER (PARTITION BY user ORDER BY version DESC) = 1"""
SHOWN = "user, array_to_string(tracks, ',') AS tracks, mixId, atDate"
STEPS |= {
    "gram_sets": f"""
        SELECT title, list_distinct([substr(' ' || title || ' ', n, 3) FOR n IN range(1, greatest(length(title), 1) + 1)]) AS g
        FROM (SELECT DISTINCT {CLEAN} AS title FROM tracks) WHERE title IS NOT NULL""",
    "near": """
        SELECT a.title, b.title AS other FROM gram_sets a JOIN gram_sets b ON a.title <> b.title
        WHERE len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) >= 0.5 - 1e-9""",
    "artist_norms": "SELECT artistId, sum(count * count) AS norm FROM artist_history GROUP BY artistId",
    "artist_pairs": """
        SELECT a.artistId, b.artistId AS neighbour,
               sum(a.count * b.count)::DOUBLE / sqrt(any_value(n.norm)::DOUBLE * any_value(m.norm)::DOUBLE) AS cosine
        FROM artist_history a JOIN artist_history b ON a.userId = b.userId AND a.artistId <> b.artistId
        JOIN artist_norms n ON n.artistId = a.artistId JOIN artist_norms m ON m.artistId = b.artistId
        GROUP BY a.artistId, b.artistId""",
    "plays_of": "SELECT CAST(part AS VARCHAR) AS item, userId, count(*) AS count FROM plays GROUP BY part, userId",
    "item_norms": "SELECT item, sum(count * count) AS norm FROM plays_of GROUP BY item",
    "item_pairs": """
        SELECT a.item, b.item AS neighbour,
               sum(a.count * b.count)::DOUBLE / sqrt(any_value(n.norm)::DOUBLE * any_value(m.norm)::DOUBLE) AS cosine
        FROM plays_of a JOIN plays_of b ON a.userId = b.userId AND a.item <> b.item
        JOIN item_norms n ON n.item = a.item JOIN item_norms m ON m.item = b.item
        GROUP BY a.item, b.item""",
    "steps_of": """
        SELECT user, index, back, lag(index, 1) OVER w AS l1, lag(index, 2) OVER w AS l2, lag(index, 3) OVER w AS l3
        FROM (SELECT * FROM sequence WHERE back <= 500) WINDOW w AS (PARTITION BY user ORDER BY place)""",
    "context_counts": """
        SELECT context, next, count(*) AS times FROM (
            SELECT CAST([] AS INTEGER[]) AS context, index AS next FROM steps_of
            UNION ALL SELECT [l1], index FROM steps_of WHERE l1 IS NOT NULL
            UNION ALL SELECT [l2, l1], index FROM steps_of WHERE l2 IS NOT NULL
            UNION ALL SELECT [l3, l2, l1], index FROM steps_of WHERE l3 IS NOT NULL)
        GROUP BY ALL""",
    "context_lists": """
        SELECT context, next, row_number() OVER (PARTITION BY context ORDER BY times DESC, next) AS place
        FROM context_counts
        QUALIFY sum(times) OVER (PARTITION BY context) >= 2 OR len(context) = 0""",
    "context_ends": """
        SELECT user, CAST([] AS INTEGER[]) AS context FROM steps_of WHERE back = 1
        UNION ALL SELECT user, [index] FROM steps_of WHERE back = 1
        UNION ALL SELECT user, [l1, index] FROM steps_of WHERE back = 1 AND l1 IS NOT NULL
        UNION ALL SELECT user, [l2, l1, index] FROM steps_of WHERE back = 1 AND l2 IS NOT NULL""",
}
QUERIES |= {
    "score_sequences_by_context": """
        SELECT f.user, CAST(row_number() OVER (PARTITION BY f.user ORDER BY f.first) - 1 AS INTEGER) AS position, v.item
        FROM (SELECT e.user, c.next, min((3 - len(e.context)) * 100 + c.place) AS first
              FROM context_ends e JOIN context_lists c ON c.context = e.context AND c.place <= 10
              GROUP BY e.user, c.next
              QUALIFY row_number() OVER (PARTITION BY e.user ORDER BY first) <= 10) f
        LEFT JOIN vocabulary v ON v.index = f.next""",
    "similar_items": """
        SELECT item, CAST(place - 1 AS INTEGER) AS position, neighbour FROM (
            SELECT item, neighbour, row_number() OVER (PARTITION BY item ORDER BY cosine DESC, neighbour) AS place
            FROM item_pairs WHERE cosine >= 0.1)
        WHERE place <= 10""",
    "enrich_similar_by_plays": """
        SELECT userId, neighbour AS artistId, CAST(place - 1 AS INTEGER) AS enriched_position, 1 AS enriched
        FROM known JOIN (
            SELECT artistId, neighbour, row_number() OVER (PARTITION BY artistId ORDER BY cosine DESC, neighbour) AS place
            FROM artist_pairs WHERE cosine >= 0.2) USING (artistId)
        WHERE place <= 3""",
    "near_titles": "SELECT title, other FROM near",
    "filter_heard_near_titles": """
        SELECT userId, trackGroup, c.artistId, pos FROM cand c JOIN titled t USING (trackGroup)
        WHERE NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = c.userId AND x.cleanedTitle = t.cleanedTitle)
          AND NOT EXISTS (SELECT 1 FROM heard x JOIN near n ON n.title = x.cleanedTitle
                          WHERE x.userId = c.userId AND n.other = t.cleanedTitle)""",
    "observed_stream": QUERIES["observed_tracks"],
    "incremental_mix": QUERIES["discovery_mix"],
    "keyed_mixes": f"SELECT {SHOWN} FROM ({REPLAYED.format(until=4)}) WHERE NOT gone",
    "keyed_mixes_of_version": f"SELECT {SHOWN} FROM ({REPLAYED.format(until=2)}) WHERE NOT gone",
    "keyed_mixes_compacted": f"""
        SELECT user, array_to_string(CASE WHEN user % 5 = 1 THEN list_reverse(tracks) ELSE tracks END, ',') AS tracks,
               mixId, atDate
        FROM ({REPLAYED.format(until=4)}) WHERE NOT gone""",
    "keyed_mix_changes": f"""
        SELECT user, CASE WHEN gone THEN 'delete' ELSE 'update' END AS change
        FROM ({REPLAYED.format(until=4)}) WHERE version > 1""",
}


def binned(value: str) -> str:
    size = f"abs(CAST({value} AS BIGINT))"
    drop = f"greatest(length(bin({size})) - 7, 0)"
    return f"CAST(CASE WHEN {value} < 0 THEN -1 ELSE 1 END * (({size} >> {drop}) << {drop}) AS BIGINT)"


def measures(lengths: str, plays: str) -> str:
    """The values of the measures, from expressions over mixes and histories."""
    return f"""
        SELECT 'list_length' AS measure, {binned(lengths)} AS bin FROM mixes
        UNION ALL SELECT 'position', {binned("pos * 7")} FROM recs
        UNION ALL SELECT 'plays', {binned(plays)} FROM track_history
        UNION ALL SELECT 'age', {binned("date_diff('day', CAST(dt AS DATE), DATE '2001-08-01')")} FROM track_history"""


DAYS = ", ".join(f"(DATE '{d}')" for d in BACKFILL)
STEPS |= {
    "nested": """
        SELECT p_partkey AS artistId, p_partkey // 2 AS artistCompoundId, 1 AS priority FROM part
        WHERE p_partkey > 3 AND p_partkey % 4 <> 1
        UNION ALL SELECT p_partkey, p_partkey // 3, 2 FROM part WHERE p_partkey > 3 AND p_partkey % 4 <> 1
        UNION ALL SELECT p_partkey, p_partkey + 1, 0 FROM part WHERE p_partkey % 50 = 0
        UNION ALL SELECT p_partkey, p_partkey - 1, 0 FROM part WHERE p_partkey % 50 = 1""",
    "constituents": """
        SELECT artistId, artistCompoundId FROM (
            WITH RECURSIVE reach AS (
                SELECT artistId, artistCompoundId FROM nested
                UNION SELECT r.artistId, n.artistCompoundId FROM reach r JOIN nested n ON n.artistId = r.artistCompoundId)
            SELECT * FROM reach)
        WHERE artistId <> artistCompoundId""",
    "next_artist": """
        SELECT artistId, artistCompoundId AS next FROM nested
        QUALIFY row_number() OVER (PARTITION BY artistId ORDER BY priority, artistCompoundId) = 1""",
    "final_artist": """
        SELECT artistId, CASE WHEN list_contains(passed, here) THEN list_min(passed[list_position(passed, here):]) ELSE here END AS final
        FROM (
            WITH RECURSIVE way AS (
                SELECT artistId, next AS here, [artistId] AS passed FROM next_artist
                UNION ALL
                SELECT w.artistId, n.next, list_append(w.passed, w.here) FROM way w JOIN next_artist n ON n.artistId = w.here
                WHERE NOT list_contains(w.passed, w.here))
            SELECT * FROM way QUALIFY row_number() OVER (PARTITION BY artistId ORDER BY len(passed) DESC) = 1)""",
    "blocked_nested": """
        SELECT userId, number AS artistId FROM blocked WHERE artifactType = 'ARTIST'
        UNION
        SELECT b.userId, c.artistId FROM blocked b JOIN constituents c ON c.artistCompoundId = b.number
        WHERE b.artifactType = 'ARTIST'""",
    "run_days": f"SELECT day FROM (VALUES {DAYS}) d(day)",
    "heard_days": """
        SELECT userId, CAST(part AS VARCHAR) AS trackGroup, day
        FROM plays JOIN run_days ON o_orderdate < day
        GROUP BY userId, part, day
        HAVING count(*) >= 2 OR max(o_orderdate) >= day - INTERVAL 12 MONTH""",
    "values_now": measures("len(tracks)", "count"),
    "values_before": measures(
        "CASE WHEN user % 5 = 0 THEN least(len(tracks), 40) ELSE len(tracks) END",
        "(count + CASE WHEN userId % 3 = 0 THEN 2 ELSE 0 END)",
    ),
    "shares": """
        SELECT measure, bin,
               sum(b) OVER w AS bb, sum(a) OVER w AS ab, sum(b) OVER (PARTITION BY measure) AS tb,
               sum(a) OVER (PARTITION BY measure) AS ta
        FROM (SELECT measure, bin, sum(b) AS b, sum(a) AS a
              FROM (SELECT *, 1 AS b, 0 AS a FROM values_before UNION ALL SELECT *, 0, 1 FROM values_now)
              GROUP BY measure, bin)
        WINDOW w AS (PARTITION BY measure ORDER BY bin)""",
}
QUERIES |= {
    "all_constituents": "SELECT artistId, artistCompoundId FROM constituents",
    "resolve_final_artist": """
        SELECT userId, trackGroup, pos, coalesce(f.final, CAST(trackGroup AS BIGINT)) AS artistId
        FROM recs LEFT JOIN final_artist f ON f.artistId = CAST(trackGroup AS BIGINT)""",
    "filter_blacklisted_artists_of_all_levels": """
        SELECT userId, trackGroup, pos, CAST(trackGroup AS BIGINT) AS artistId FROM recs c
        WHERE NOT EXISTS (SELECT 1 FROM blocked_nested x WHERE x.userId = c.userId
                          AND x.artistId = CAST(c.trackGroup AS BIGINT))""",
    "heard_on_days": "SELECT userId, trackGroup, day FROM heard_days",
    "filter_heard_on_days": f"""
        SELECT userId, trackGroup, pos, d.day FROM recs c
        CROSS JOIN (VALUES {", ".join(f"(DATE '{d}')" for d in BACKFILL[1::2])}) d(day)
        WHERE NOT EXISTS (SELECT 1 FROM heard_days x WHERE x.userId = c.userId AND x.trackGroup = c.trackGroup
                          AND x.day = d.day)""",
    "filter_key_sets": """
        SELECT r.userId, r.trackGroup, r.pos FROM recs r JOIN titled m ON m.trackGroup = r.trackGroup
        WHERE NOT EXISTS (SELECT 1 FROM blocked x WHERE x.artifactType = 'TRACK' AND x.userId = r.userId
                          AND x.artifactId = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM blocked_artists x WHERE x.userId = r.userId AND x.artistId = m.artistId)
          AND NOT EXISTS (SELECT 1 FROM observed_tracks x WHERE x.user = r.userId AND x.trackGroup = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = r.userId AND x.trackGroup = r.trackGroup)
          AND NOT EXISTS (SELECT 1 FROM heard x WHERE x.userId = r.userId AND x.cleanedTitle = m.cleanedTitle)
          AND NOT EXISTS (SELECT 1 FROM favourite_tracks x WHERE x.userId = r.userId AND x.trackGroup = r.trackGroup)""",
    "mix_sketch": "SELECT measure, bin, count(*) AS n FROM values_now GROUP BY ALL",
    "mix_quantiles": """
        SELECT measure, CAST(p.permille AS INTEGER) AS permille, min(bin) AS value
        FROM (SELECT *, sum(n) OVER (PARTITION BY measure ORDER BY bin) AS below, sum(n) OVER (PARTITION BY measure) AS total
              FROM (SELECT measure, bin, count(*) AS n FROM values_now GROUP BY ALL))
        JOIN (VALUES (10), (250), (500), (750), (990)) p(permille) ON below * 1000 >= p.permille * total
        GROUP BY ALL""",
    "mix_drift": """
        SELECT measure, CAST(max(tb) AS BIGINT) AS rowsBefore, CAST(max(ta) AS BIGINT) AS rowsNow,
               max(abs(CAST(bb AS DOUBLE) / tb - CAST(ab AS DOUBLE) / ta)) AS distance
        FROM shares GROUP BY measure""",
}


def statement(name: str) -> str:
    """The query with the steps it needs, each after the steps it names."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for step in STEPS:
            if step not in needed and re.search(rf"\b{step}\b", text) and re.search(rf"(FROM|JOIN)\s+{step}\b", text):
                add(STEPS[step])
                needed[step] = STEPS[step]

    add(QUERIES[name])
    ctes = ",\n".join(f"{step} AS ({text})" for step, text in needed.items())
    return f"WITH {ctes}\n{QUERIES[name]}" if ctes else QUERIES[name]
