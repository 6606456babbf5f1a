"""ANSI SQL for every registered query, run by another engine on the given tables.

Each statement starts with the same common table expressions: the tables seen as
channels and videos, then staging, metrics and marts.
"""

from __future__ import annotations

from .fixture import CHAINED

_RAW = """
cfg AS (
  SELECT c_custkey, c_name, c_acctbal, lower(c_mktsegment) AS niche,
         CASE WHEN r_name = 'ASIA' THEN 'ID' ELSE 'GLOBAL' END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), raw_channels AS (
  SELECT concat('UC', CAST(c_custkey AS VARCHAR)) AS channel_id,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS channel_name,
         concat('https://example.com/channel/UC', CAST(c_custkey AS VARCHAR)) AS channel_url,
         CASE WHEN c_acctbal < 0 THEN NULL
              ELSE CAST(floor(c_acctbal * 2000) AS BIGINT) + snap * 1000 END AS subscriber_count,
         concat('About ', c_name) AS description,
         CASE WHEN snap = 0 THEN '2001-07-01T00:00:00+00:00'
              ELSE '2001-08-01T00:00:00+00:00' END AS scraped_at,
         niche, region,
         CASE WHEN c_custkey % 121 = 0 THEN '' ELSE concat('cfg-', c_name) END AS config_name
  FROM cfg CROSS JOIN (SELECT 0 AS snap UNION ALL SELECT 1 AS snap) s
), li AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n
  FROM lineitem GROUP BY l_orderkey
), o AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus,
         CAST(floor(o_totalprice / 5000) AS BIGINT) AS b
  FROM orders
), raw_videos AS (
  SELECT concat('v', CAST(o_orderkey AS VARCHAR)) AS video_id,
         CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL
              ELSE concat(o_orderpriority, '  ', o_orderstatus, ' ', c_name) END AS title,
         concat('Description of ', CAST(o_orderkey AS VARCHAR)) AS description,
         CASE WHEN o_custkey % 121 = 0 THEN '' ELSE c_name END AS channel_name,
         concat('UC', CAST(o_custkey AS VARCHAR)) AS channel_id,
         concat('https://example.com/channel/UC', CAST(o_custkey AS VARCHAR)) AS channel_url,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS upload_date,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL
              ELSE CAST((o_orderkey * 37) % 7200 AS BIGINT) END AS duration_seconds,
         b * b * b AS view_count, q AS like_count, coalesce(n, 0) AS comment_count,
         concat('["', lower(o_orderstatus), '","', lower(o_orderpriority), '"]') AS tags,
         concat('["', niche, '"]') AS categories,
         concat('https://example.com/t/', CAST(o_orderkey AS VARCHAR), '.jpg') AS thumbnail_url,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN region = 'ID' THEN 'id' ELSE 'en' END AS language,
         o_orderpriority = '1-URGENT' AS is_live, o_orderstatus = 'F' AS was_live,
         '2001-08-01T00:00:00+00:00' AS scraped_at, niche, region, o_orderkey
  FROM o LEFT JOIN li ON o_orderkey = l_orderkey JOIN cfg ON o_custkey = c_custkey
)"""

_MODELS = """
, stg_channels AS (
  SELECT channel_id, coalesce(channel_name, config_name) AS channel_name, channel_url,
         subscriber_count, description AS channel_description, niche, region, config_name,
         CASE WHEN scraped_at LIKE '2001-07%' THEN '2001-07-01 00:00:00'
              ELSE '2001-08-01 00:00:00' END AS scraped_at,
         CASE WHEN subscriber_count >= 10000000 THEN 'mega'
              WHEN subscriber_count >= 1000000 THEN 'large'
              WHEN subscriber_count >= 100000 THEN 'medium'
              WHEN subscriber_count >= 10000 THEN 'small' ELSE 'micro' END AS size_tier
  FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY scraped_at DESC) AS rn
        FROM raw_channels WHERE channel_id IS NOT NULL) r
  WHERE rn = 1 AND coalesce(channel_name, config_name, '') <> ''
), stg_videos AS (
  SELECT video_id, title, description, channel_name, channel_id, channel_url,
         CAST(upload_date AS DATE) AS upload_date, duration_seconds, view_count, like_count,
         comment_count, tags, categories, thumbnail_url, language, is_live, was_live, niche, region,
         '2001-08-01 00:00:00' AS scraped_at,
         CASE WHEN duration_seconds < 60 THEN 'short' WHEN duration_seconds < 600 THEN 'medium'
              WHEN duration_seconds < 3600 THEN 'long' ELSE 'very_long' END AS duration_category,
         CAST(dayofweek(CAST(upload_date AS DATE)) + 1 AS BIGINT) AS upload_day_of_week,
         CAST(year(CAST(upload_date AS DATE)) AS BIGINT) AS upload_year,
         CAST(month(CAST(upload_date AS DATE)) AS BIGINT) AS upload_month
  FROM raw_videos WHERE video_id IS NOT NULL
), video_metrics AS (
  SELECT v.video_id, v.title, v.channel_id,
         coalesce(c.channel_name, v.channel_name) AS channel_name,
         v.upload_date, v.duration_seconds, v.duration_category, v.view_count, v.like_count,
         v.comment_count, v.niche, v.region, v.upload_day_of_week, v.upload_year, v.upload_month,
         v.tags, v.is_live, v.was_live, c.subscriber_count, c.size_tier,
         CAST(v.like_count AS DOUBLE) / nullif(v.view_count, 0) AS like_rate,
         CAST(v.comment_count AS DOUBLE) / nullif(v.view_count, 0) AS comment_rate,
         CAST(v.like_count + v.comment_count AS DOUBLE) / nullif(v.view_count, 0) AS engagement_rate,
         CAST(v.view_count AS DOUBLE) / nullif(c.subscriber_count, 0) AS views_per_subscriber,
         CAST(date_diff('day', v.upload_date, DATE '2001-08-02') AS BIGINT) AS days_since_upload,
         CASE WHEN v.upload_date IS NOT NULL THEN CAST(v.view_count AS DOUBLE)
              / greatest(date_diff('day', v.upload_date, DATE '2001-08-02'), 1) END AS views_per_day,
         CAST(length(v.title) AS BIGINT) AS title_length,
         CAST(len(string_split(v.title, ' ')) AS BIGINT) AS title_word_count
  FROM stg_videos v LEFT JOIN stg_channels c ON v.channel_id = c.channel_id
), channel_summary AS (
  SELECT channel_id, channel_name, niche, region, subscriber_count, size_tier,
         count(*) AS total_videos,
         CAST(count(*) FILTER (WHERE days_since_upload <= 30) AS BIGINT) AS videos_last_30d,
         CAST(count(*) FILTER (WHERE days_since_upload <= 7) AS BIGINT) AS videos_last_7d,
         CAST(sum(view_count) AS BIGINT) AS total_views, avg(view_count) AS avg_views,
         max(view_count) AS max_views, min(view_count) AS min_views,
         avg(engagement_rate) AS avg_engagement_rate, avg(like_rate) AS avg_like_rate,
         avg(comment_rate) AS avg_comment_rate, avg(views_per_subscriber) AS avg_views_per_sub,
         avg(views_per_day) AS avg_views_per_day, avg(duration_seconds) AS avg_duration_seconds,
         avg(title_length) AS avg_title_length, min(upload_date) AS earliest_video,
         max(upload_date) AS latest_video,
         CAST(count(*) FILTER (WHERE is_live OR was_live) AS BIGINT) AS live_video_count
  FROM video_metrics GROUP BY 1, 2, 3, 4, 5, 6
  HAVING channel_name IS NOT NULL AND trim(channel_name) <> ''
), niche_benchmarks AS (
  SELECT niche, count(*) AS total_channels,
         CAST(count(*) FILTER (WHERE region = 'ID') AS BIGINT) AS id_channels,
         CAST(count(*) FILTER (WHERE region = 'GLOBAL') AS BIGINT) AS global_channels,
         avg(subscriber_count) AS avg_subscribers,
         quantile_disc(subscriber_count, 0.5) AS median_subscribers,
         avg(avg_views) AS avg_views_per_video, avg(total_views) AS avg_total_views,
         avg(avg_engagement_rate) AS avg_engagement_rate, avg(avg_like_rate) AS avg_like_rate,
         avg(avg_comment_rate) AS avg_comment_rate, avg(avg_duration_seconds) AS avg_duration,
         avg(total_videos) AS avg_videos_per_channel, avg(avg_title_length) AS avg_title_length,
         avg(videos_last_30d) AS avg_uploads_last_30d
  FROM channel_summary GROUP BY 1
), dim AS (
  SELECT channel_id, channel_name, channel_url, niche, region, subscriber_count, size_tier,
         channel_description, scraped_at
  FROM stg_channels
), fact AS (
  SELECT video_id, channel_id, title, upload_date, duration_seconds, duration_category,
         upload_day_of_week, upload_year, upload_month, tags, is_live, was_live, m.niche, region,
         view_count, like_count, comment_count, like_rate, comment_rate, engagement_rate,
         views_per_subscriber, views_per_day, days_since_upload, title_length, title_word_count,
         engagement_rate / nullif(bench_engagement, 0) AS engagement_vs_benchmark,
         view_count / nullif(bench_views, 0) AS views_vs_benchmark,
         CASE WHEN view_count / nullif(bench_views, 0) >= 3 THEN 'viral'
              WHEN view_count / nullif(bench_views, 0) >= 1.5 THEN 'above_average'
              WHEN view_count / nullif(bench_views, 0) >= 0.5 THEN 'average'
              ELSE 'below_average' END AS performance_tier
  FROM video_metrics m LEFT JOIN (
    SELECT niche, avg_engagement_rate AS bench_engagement, avg_views_per_video AS bench_views
    FROM niche_benchmarks) n ON m.niche = n.niche
)"""

def _claims(fresh: str, suffix: str = "") -> str:
    """The entries one by one: the mix, the channels (which share nothing), the mix again."""
    mix_url = "'https://example.com/channel/UCMIX'"
    return f"""mix{suffix} AS (
  SELECT 0 AS entry, config_url, video_id, has_video FROM (
    SELECT *, row_number() OVER (ORDER BY position) AS turn FROM {fresh} WHERE config_url = {mix_url}) m
  WHERE turn <= 20
), own{suffix} AS (
  SELECT r.position AS entry, config_url, video_id, has_video FROM (
    SELECT *, row_number() OVER (PARTITION BY config_url ORDER BY tab DESC, position) AS turn
    FROM {fresh} WHERE config_url <> {mix_url}
      AND video_id NOT IN (SELECT video_id FROM mix{suffix} WHERE has_video)) f
  JOIN registry r ON r.url = f.config_url WHERE turn <= 20
), again{suffix} AS (
  SELECT 1000000000000000 AS entry, config_url, video_id, has_video FROM (
    SELECT *, row_number() OVER (ORDER BY position) AS turn FROM {fresh} WHERE config_url = {mix_url}
      AND video_id NOT IN (SELECT video_id FROM mix{suffix} WHERE has_video UNION ALL
                           SELECT video_id FROM own{suffix} WHERE has_video)) m
  WHERE turn <= 20
), claimed{suffix} AS (
  SELECT * FROM mix{suffix} UNION ALL SELECT * FROM own{suffix} UNION ALL SELECT * FROM again{suffix}"""


_INGEST = """
, registry AS (
  SELECT CASE WHEN c_custkey % 121 = 0 THEN concat('UC', CAST(c_custkey AS VARCHAR))
              ELSE concat('cfg-', c_name) END AS name,
         concat('https://example.com/channel/UC', CAST(c_custkey AS VARCHAR)) AS url,
         concat('UC', CAST(c_custkey AS VARCHAR)) AS channel_id, niche, region,
         c_custkey + 1 AS position
  FROM cfg
  UNION ALL
  SELECT 'mix', 'https://example.com/channel/UCMIX', 'UCMIX', 'household', 'GLOBAL', 0
  UNION ALL
  SELECT 'mix-again', 'https://example.com/channel/UCMIX', 'UCMIX', 'machinery', 'ID', 1000000000000000
), current_channels AS (
  SELECT * FROM raw_channels WHERE scraped_at = '2001-08-01T00:00:00+00:00'
), placed AS (
  SELECT *, CAST(date_diff('day', coalesce(CAST(upload_date AS DATE), DATE '1900-01-01'),
                           DATE '2100-01-01') AS BIGINT) * 1000000000000 + o_orderkey AS position
  FROM raw_videos
), listing AS (
  SELECT channel_url AS config_url, CASE WHEN was_live THEN 'streams' ELSE 'videos' END AS tab,
         position, video_id FROM placed
  UNION ALL
  SELECT channel_url, 'videos', position, video_id FROM placed WHERE was_live AND is_live
  UNION ALL
  SELECT 'https://example.com/channel/UCMIX', 'streams', position, video_id FROM placed WHERE was_live
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY config_url, tab ORDER BY position) AS place FROM listing
), listed AS (
  SELECT * FROM numbered a WHERE place <= 30 AND (tab = 'videos' OR NOT EXISTS (
    SELECT 1 FROM numbered b WHERE b.place <= 30 AND b.tab = 'videos'
      AND b.config_url = a.config_url AND b.video_id = a.video_id))
), listed_10 AS (
  SELECT * FROM numbered a WHERE place <= 10 AND (tab = 'videos' OR NOT EXISTS (
    SELECT 1 FROM numbered b WHERE b.place <= 10 AND b.tab = 'videos'
      AND b.config_url = a.config_url AND b.video_id = a.video_id))
), loaded AS (
  SELECT video_id FROM raw_videos WHERE upload_date < '2001-01-01'
), parsed AS (
  SELECT video_id, CASE WHEN is_live THEN title ELSE coalesce(title, '') END AS title,
         CASE WHEN is_live THEN substr(repeat(description, 60), 1, 1000)
              ELSE description END AS description,
         channel_name, channel_id, channel_url, upload_date, duration_seconds, view_count,
         CASE WHEN o_orderkey % 31 = 0 AND like_count IS NOT NULL THEN NULL
              WHEN is_live THEN like_count ELSE coalesce(like_count, 0) END AS like_count,
         comment_count, CASE WHEN o_orderkey % 23 = 0 THEN '"x"' ELSE tags END AS tags, categories, thumbnail_url, language, is_live, was_live, scraped_at
  FROM raw_videos WHERE duration_seconds IS NOT NULL
), fresh AS (
  SELECT config_url, video_id, tab, position,
         video_id IN (SELECT video_id FROM parsed) AS has_video
  FROM listed WHERE video_id NOT IN (SELECT video_id FROM loaded)
), {claims}
), records AS (
  SELECT *, CAST(substr(channel_id, 3) AS BIGINT) AS number, CASE WHEN region = 'ID' THEN channel_id END AS listed_id,
         subscriber_count IS NOT NULL AND niche <> 'machinery' AS extended FROM current_channels
), merged AS (
  SELECT channel_url AS config_url,
         CASE WHEN extended AND number % 5 <> 0 THEN channel_id
              WHEN extended OR listed_id IS NOT NULL OR number % 2 = 0 THEN listed_id ELSE '' END AS channel_id,
         coalesce(CASE WHEN extended AND region = 'ID' THEN upper(channel_name) END, channel_name,
                  CASE WHEN number % 7 <> 0 THEN config_name WHEN number % 2 = 1 THEN '' END) AS channel_name,
         channel_url,
         CASE WHEN extended THEN subscriber_count END AS subscriber_count,
         CASE WHEN NOT extended THEN concat('Listing of ', description)
              WHEN niche = 'furniture' THEN ''
              ELSE substr(repeat(description, 40), 1, 500) END AS description,
         scraped_at
  FROM records
), resolved AS (
  SELECT CASE WHEN s.subscriber_count IS NOT NULL THEN coalesce(s.channel_name, r.name)
              ELSE r.name END AS name,
         CASE WHEN s.subscriber_count IS NOT NULL THEN r.url
              WHEN r.name LIKE 'mix%' THEN r.url
              WHEN r.region = 'ID' THEN concat('https://example.com/found/', r.channel_id)
              WHEN r.niche = 'building' THEN concat('https://example.com/found/', r.channel_id, '/b')
              ELSE r.url END AS url,
         CASE WHEN s.subscriber_count IS NOT NULL THEN r.channel_id
              WHEN r.name LIKE 'mix%' THEN ''
              WHEN r.region = 'ID' THEN NULL
              WHEN r.niche = 'building' THEN r.channel_id ELSE '' END AS channel_id,
         r.niche, r.region,
         CASE WHEN s.subscriber_count IS NOT NULL THEN 'valid'
              WHEN r.name NOT LIKE 'mix%' AND (r.region = 'ID' OR r.niche = 'building')
              THEN 'found_via_search' ELSE 'not_found' END AS status,
         r.position
  FROM registry r LEFT JOIN current_channels s ON r.url = s.channel_url
)"""


def _rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name.split('.')[-1]}" for name in names)


def _models(select: str) -> str:
    return f"WITH {_RAW}{_MODELS}\n{select}"


def _ingest(select: str) -> str:
    return f"WITH {_RAW}{_INGEST.replace('{claims}', _claims('fresh'))}\n{select}"


# text forms


def _fixed(value: str, digits: int) -> str:
    """printf rounds an exact half to even; here it goes up."""
    parts = {1: 4, 2: 8}[digits]
    nudge = {1: 0.01, 2: 0.001}[digits]
    tie = f"({value}) * {parts} = floor(({value}) * {parts}) AND CAST(({value}) * {parts} AS BIGINT) % 2 = 1"
    return (
        f"CASE WHEN {tie} THEN printf('%.{digits}f', CAST({value} AS DOUBLE) + {nudge}) "
        f"ELSE printf('%.{digits}f', CAST({value} AS DOUBLE)) END"
    )


def _compact(value: str) -> str:
    number = f"CAST({value} AS DOUBLE)"
    return (
        f"CASE WHEN coalesce({number}, 0) = 0 THEN '0' "
        f"WHEN {number} >= 1e9 THEN concat({_fixed(number + ' / 1e9', 1)}, 'B') "
        f"WHEN {number} >= 1e6 THEN concat({_fixed(number + ' / 1e6', 1)}, 'M') "
        f"WHEN {number} >= 1e3 THEN concat({_fixed(number + ' / 1e3', 1)}, 'K') "
        f"ELSE regexp_replace(printf('%.3f', round({number}, 3)), '\\.?0+$', '') END"
    )


def _percent(value: str) -> str:
    return (
        f"CASE WHEN coalesce({value}, 0) = 0 THEN '0%' "
        f"ELSE concat({_fixed(f'({value}) * 100', 2)}, '%') END"
    )


def _duration(value: str) -> str:
    return (
        f"CASE WHEN coalesce({value}, 0) = 0 THEN 'N/A' "
        f"WHEN {value} // 60 > 60 THEN concat({value} // 3600, 'h ', ({value} // 60) % 60, 'm') "
        f"ELSE concat({value} // 60, ':', lpad(CAST({value} % 60 AS VARCHAR), 2, '0')) END"
    )


def _short(value: str, limit: int) -> str:
    return (
        f"CASE WHEN length({value}) > {limit} THEN concat(substr({value}, 1, {limit}), '…') "
        f"ELSE {value} END"
    )


_METRIC_RATES = (
    "like_rate", "comment_rate", "engagement_rate", "views_per_subscriber", "views_per_day",
)
_METRIC_COLUMNS = """video_id, title, channel_id, channel_name, upload_date, duration_seconds,
  duration_category, view_count, like_count, comment_count, niche, region, upload_day_of_week,
  upload_year, upload_month, tags, is_live, was_live, subscriber_count, size_tier,
  days_since_upload, title_length, title_word_count"""
_FACT_COLUMNS = """video_id, channel_id, title, upload_date, duration_seconds, duration_category,
  upload_day_of_week, upload_year, upload_month, tags, is_live, was_live, niche, region,
  view_count, like_count, comment_count, days_since_upload, title_length, title_word_count,
  performance_tier"""
_SUMMARY_COLUMNS = """a.channel_id, a.channel_name, a.niche, a.region, a.subscriber_count,
  a.size_tier, total_videos, videos_last_30d, videos_last_7d, total_views, max_views, min_views,
  earliest_video, latest_video, live_video_count"""
_SUMMARY_MEANS = _rounded(
    "avg_views", "avg_engagement_rate", "avg_like_rate", "avg_comment_rate", "avg_views_per_sub",
    "avg_views_per_day", "avg_duration_seconds", "avg_title_length",
)
_BENCHMARK = "niche, total_channels, id_channels, global_channels, median_subscribers, " + _rounded(
    "avg_subscribers", "avg_views_per_video", "avg_total_views", "avg_engagement_rate",
    "avg_like_rate", "avg_comment_rate", "avg_duration", "avg_videos_per_channel",
    "avg_title_length", "avg_uploads_last_30d",
)
_EXPLORER = """f.video_id, f.title, f.channel_id, d.channel_name, d.subscriber_count, d.size_tier,
  f.niche, f.region, f.upload_date, f.view_count, f.like_count, f.comment_count,
  f.duration_seconds, f.duration_category, f.performance_tier, """ + _rounded(
    "f.engagement_rate", "f.like_rate", "f.comment_rate", "f.views_per_subscriber",
    "f.views_per_day", "f.engagement_vs_benchmark", "f.views_vs_benchmark",
)
_FACT_DIM = "FROM fact f JOIN dim d ON f.channel_id = d.channel_id"
_CHANNEL = "UC7"

_SUMMARY = _models(f"SELECT {_SUMMARY_COLUMNS}, {_SUMMARY_MEANS} FROM channel_summary a")
_NICHES = _models(f"SELECT {_BENCHMARK} FROM niche_benchmarks")
_DIM = _models("SELECT * FROM dim")


def _explorer(where: str, sort: str, limit: int, columns: str = _EXPLORER) -> str:
    return f"SELECT {columns} {_FACT_DIM} WHERE {where} ORDER BY f.{sort} DESC NULLS LAST, f.video_id LIMIT {limit}"


def _leaderboard(where: str, sort: str, limit: int, columns: str) -> str:
    return f"""SELECT {columns} FROM channel_summary a JOIN dim d ON a.channel_id = d.channel_id
  WHERE {where}
  ORDER BY a.{sort} DESC NULLS LAST, a.channel_id, a.niche, a.region, a.channel_name LIMIT {limit}"""


def _pivot(rows: str, key: str, grouped: str, value: str, label: str) -> str:
    niches = ("automobile", "building", "furniture", "household", "machinery")
    columns = ", ".join(f"max(CASE WHEN g.niche = '{n}' THEN g.{value} END) AS {n}" for n in niches)
    return f"""SELECT r.{label}, {columns} FROM (VALUES {rows}) r(k, {label})
  LEFT JOIN ({grouped}) g ON g.{key} = r.k GROUP BY r.{label}"""


_DURATIONS = """SELECT niche, duration_category, count(*) AS count, round(avg(view_count), 6) AS avg_views,
  round(avg(engagement_rate), 6) AS avg_engagement FROM fact GROUP BY 1, 2"""
_DAYS = """SELECT niche, upload_day_of_week, count(*) AS count, round(avg(view_count), 6) AS avg_views
  FROM fact GROUP BY 1, 2"""


def _radar() -> str:
    measures = (
        ("Engagement", "avg_engagement_rate", "0.001"),
        ("Avg Views", "avg_views_per_video", "1"),
        ("Avg Subs", "avg_subscribers", "1"),
        ("Upload Freq", "avg_uploads_last_30d", "1"),
        ("Like Rate", "avg_like_rate", "0.001"),
    )
    niches = ("automobile", "building", "furniture", "household", "machinery")
    long = " UNION ALL ".join(
        f"SELECT niche, '{label}' AS metric, coalesce({name}, 0) AS v, {least} AS least FROM niche_benchmarks"
        for label, name, least in measures
    )
    columns = ", ".join(f"max(CASE WHEN niche = '{n}' THEN score END) AS {n}" for n in niches)
    return f"""SELECT metric, {columns} FROM (
  SELECT niche, metric, CAST(floor(v / greatest(max(v) OVER (PARTITION BY metric), least) * 100 + 0.5) AS BIGINT) AS score
  FROM ({long}) l) s GROUP BY metric"""


def oracle_sql() -> dict[str, str]:
    ranked_page = "SELECT row_number() OVER (ORDER BY {order}) AS rank, * FROM ({page}) p"
    tests = [
        ("stg_channels", "channel_id", "not_null", "SELECT count(*) FROM stg_channels WHERE channel_id IS NULL"),
        ("stg_channels", "channel_name", "not_null", "SELECT count(*) FROM stg_channels WHERE channel_name IS NULL"),
        (
            "stg_channels", "niche", "accepted_values",
            "SELECT count(*) FROM stg_channels WHERE niche NOT IN "
            "('automobile', 'building', 'furniture', 'household', 'machinery')",
        ),
        (
            "stg_channels", "region", "accepted_values",
            "SELECT count(*) FROM stg_channels WHERE region NOT IN ('ID', 'GLOBAL')",
        ),
        (
            "stg_channels", "channel_id", "unique",
            "SELECT count(*) FROM (SELECT channel_id FROM stg_channels GROUP BY 1 HAVING count(*) > 1)",
        ),
        ("stg_videos", "video_id", "not_null", "SELECT count(*) FROM stg_videos WHERE video_id IS NULL"),
        ("stg_videos", "channel_id", "not_null", "SELECT count(*) FROM stg_videos WHERE channel_id IS NULL"),
        (
            "stg_videos", "video_id", "unique",
            "SELECT count(*) FROM (SELECT video_id FROM stg_videos GROUP BY 1 HAVING count(*) > 1)",
        ),
    ]
    dq = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, ({failures}) AS failures"
        for table, column, test, failures in tests
    )
    own_niche = f"(SELECT niche FROM dim WHERE channel_id = '{_CHANNEL}')"
    top_page = _explorer(
        "true", "view_count", 10,
        "f.video_id, f.title, d.channel_name, f.niche, f.region, f.view_count, f.like_count, "
        "f.engagement_rate, f.performance_tier, f.upload_date",
    )
    any_page = "f.video_id, f.title, d.channel_name, f.niche, f.view_count, f.like_count, f.engagement_rate, f.views_per_day, f.duration_seconds, f.performance_tier, f.upload_date"
    kpi = "CAST(sum(view_count) AS BIGINT) AS total_views, round(avg(engagement_rate), 6)"
    found = {
        "stg_channels_latest": _models("SELECT * FROM stg_channels"),
        "channels_current_merged": _models("SELECT * FROM stg_channels"),
        "stg_videos_clean": _models("SELECT * FROM stg_videos"),
        "video_metrics": _models(
            f"SELECT {_METRIC_COLUMNS}, {_rounded(*_METRIC_RATES)} FROM video_metrics"
        ),
        "channel_summary": _SUMMARY,
        "niche_benchmarks": _NICHES,
        "dim_channels": _DIM,
        "fct_video_performance": _models(
            f"SELECT {_FACT_COLUMNS}, "
            f"{_rounded(*_METRIC_RATES, 'engagement_vs_benchmark', 'views_vs_benchmark')} FROM fact"
        ),
        "agg_channel_metrics": _SUMMARY,
        "agg_niche_overview": _NICHES,
        "overview_kpis": _models(
            "SELECT count(DISTINCT channel_id) AS total_channels, count(*) AS total_videos, "
            "CAST(sum(view_count) AS BIGINT) AS total_views, "
            "CAST(sum(like_count) AS BIGINT) AS total_likes, "
            "CAST(sum(comment_count) AS BIGINT) AS total_comments, "
            "round(avg(engagement_rate), 6) AS avg_engagement_rate FROM fact"
        ),
        "overview_cards": _models(
            "SELECT count(DISTINCT channel_id) AS total_channels, "
            f"{_compact('count(*)')} AS total_videos, {_compact('sum(view_count)')} AS total_views, "
            f"{_compact('sum(like_count)')} AS total_likes, "
            f"concat({_fixed('avg(engagement_rate) * 100', 2)}, '%') AS avg_engagement FROM fact"
        ),
        "overview_by_niche": _models(
            f"SELECT niche, count(DISTINCT channel_id) AS channels, count(*) AS videos, {kpi} "
            "AS avg_engagement, round(avg(view_count), 6) AS avg_views FROM fact GROUP BY niche"
        ),
        "overview_top_videos": _models(
            _explorer(
                "true", "view_count", 10,
                "f.video_id, f.title, d.channel_name, f.niche, f.region, f.view_count, f.like_count, "
                "round(f.engagement_rate, 6) AS engagement_rate, f.performance_tier, f.upload_date",
            )
        ),
        "overview_top_videos_table": _models(
            f"SELECT rank, {_short('title', 60)} AS title, "
            "concat('https://youtube.com/watch?v=', video_id) AS link, channel_name, niche, "
            f"{_compact('view_count')} AS views, "
            f"concat({_fixed('engagement_rate * 100', 2)}, '%') AS engagement, performance_tier FROM ("
            + ranked_page.format(order="view_count DESC NULLS LAST, video_id", page=top_page)
            + ") t"
        ),
        "overview_by_region": _models(
            f"SELECT region, count(DISTINCT channel_id) AS channels, count(*) AS videos, {kpi} "
            "AS avg_engagement FROM fact GROUP BY region"
        ),
        "overview_tiers": _models(
            "SELECT performance_tier, count(*) AS count FROM fact GROUP BY performance_tier"
        ),
        "sql_tier_query": _models(
            "SELECT f.performance_tier, count(*) AS videos, "
            f"CAST(sum(f.view_count) AS BIGINT) AS total_views {_FACT_DIM} "
            "WHERE f.niche = 'building' AND f.region = 'GLOBAL' GROUP BY 1"
        ),
        "sql_over_views": _models(
            "SELECT c.size_tier, b.niche, count(*) AS videos, "
            "round(max(m.views_per_day), 6) AS best_per_day, min(s.total_views) AS least_total_views "
            "FROM video_metrics m JOIN stg_channels c ON m.channel_id = c.channel_id "
            "JOIN channel_summary s ON s.channel_id = m.channel_id AND s.niche = m.niche "
            "JOIN niche_benchmarks b ON b.niche = m.niche "
            "WHERE m.view_count > b.avg_views_per_video GROUP BY c.size_tier, b.niche"
        ),
        "channel_leaderboard": _models(
            _leaderboard(
                "true", "subscriber_count", 50,
                f"{_SUMMARY_COLUMNS}, {_SUMMARY_MEANS}, d.channel_url, d.channel_description",
            )
        ),
        "channel_leaderboard_filtered": _models(
            _leaderboard(
                "a.niche = 'furniture' AND a.region = 'GLOBAL'", "avg_views", 100,
                f"{_SUMMARY_COLUMNS}, {_SUMMARY_MEANS}, d.channel_url, d.channel_description",
            )
        ),
        "leaderboard_top15": _models(
            f"SELECT rank, {_short('channel_name', 18)} AS name, "
            "coalesce(CAST(total_views AS DOUBLE), 0) AS value, niche FROM ("
            "SELECT row_number() OVER (ORDER BY total_views DESC NULLS LAST, channel_id, niche, "
            "region, channel_name) AS rank, * FROM ("
            + _leaderboard("true", "total_views", 100, "a.*")
            + ") p) t WHERE rank <= 15"
        ),
        "leaderboard_table": _models(
            "SELECT rank, channel_id, channel_name, niche, "
            "CASE WHEN region = 'ID' THEN 'Indonesia' ELSE 'Global' END AS region, size_tier, "
            f"{_compact('subscriber_count')} AS subscribers, {_compact('total_views')} AS total_views, "
            f"{_compact('avg_views')} AS avg_views, {_percent('avg_engagement_rate')} AS engagement, "
            "videos_last_30d FROM ("
            "SELECT row_number() OVER (ORDER BY avg_engagement_rate DESC NULLS LAST, channel_id, "
            "niche, region, channel_name) AS rank, * FROM ("
            + _leaderboard("true", "avg_engagement_rate", 100, "a.*")
            + ") p) t"
        ),
        "channel_info": _models(f"SELECT * FROM dim WHERE channel_id = '{_CHANNEL}'"),
        "channel_metrics": _models(
            f"SELECT {_SUMMARY_COLUMNS}, {_SUMMARY_MEANS} FROM channel_summary a "
            f"WHERE channel_id = '{_CHANNEL}' ORDER BY niche, region, channel_name LIMIT 1"
        ),
        "channel_videos": _models(
            "SELECT video_id, title, upload_date, view_count, like_count, comment_count, "
            "duration_seconds, duration_category, performance_tier, "
            f"{_rounded('engagement_rate', 'views_per_day', 'views_vs_benchmark')} "
            f"FROM fact WHERE channel_id = '{_CHANNEL}'"
        ),
        "channel_videos_table": _models(
            "SELECT row_number() OVER (ORDER BY view_count DESC NULLS LAST, video_id) AS rank, "
            f"video_id, {_short('title', 55)} AS title, "
            "concat('https://youtube.com/watch?v=', video_id) AS link, "
            f"{_compact('view_count')} AS views, {_compact('like_count')} AS likes, "
            f"{_percent('engagement_rate')} AS engagement, "
            f"{_compact('views_per_day')} AS views_per_day, "
            f"{_duration('duration_seconds')} AS duration, performance_tier, "
            f"strftime(upload_date, '%Y-%m-%d') AS date FROM fact WHERE channel_id = '{_CHANNEL}'"
        ),
        "channel_benchmark": _models(f"SELECT {_BENCHMARK} FROM niche_benchmarks WHERE niche = {own_niche}"),
        "channel_peers": _models(
            "SELECT row_number() OVER (ORDER BY subscriber_count DESC NULLS LAST, channel_id, region, "
            "channel_name) AS rank, channel_name, subscriber_count, "
            f"{_rounded('avg_views', 'avg_engagement_rate')}, channel_name = "
            f"(SELECT channel_name FROM dim WHERE channel_id = '{_CHANNEL}') AS is_self "
            f"FROM channel_summary WHERE niche = {own_niche} "
            "ORDER BY subscriber_count DESC NULLS LAST, channel_id, region, channel_name LIMIT 10"
        ),
        "channel_peers_table": _models(
            "SELECT row_number() OVER (ORDER BY subscriber_count DESC NULLS LAST, channel_id, region, "
            "channel_name) AS rank, CASE WHEN channel_name = "
            f"(SELECT channel_name FROM dim WHERE channel_id = '{_CHANNEL}') "
            "THEN concat(channel_name, ' ← You') ELSE channel_name END AS channel, "
            f"{_compact('subscriber_count')} AS subscribers, {_compact('avg_views')} AS avg_views, "
            f"{_percent('avg_engagement_rate')} AS engagement "
            f"FROM channel_summary WHERE niche = {own_niche} "
            "ORDER BY subscriber_count DESC NULLS LAST, channel_id, region, channel_name LIMIT 10"
        ),
        "channel_cards": _models(
            f"SELECT d.channel_name, {_compact('d.subscriber_count')} AS subscribers, "
            f"{_compact('total_views')} AS total_views, {_compact('avg_views')} AS avg_views, "
            f"{_percent('avg_engagement_rate')} AS engagement, total_videos "
            "FROM dim d JOIN channel_summary a ON a.channel_id = d.channel_id "
            f"WHERE d.channel_id = '{_CHANNEL}'"
        ),
        "channel_vs_benchmark": _models(
            "SELECT metric, round(channel, 6) AS channel, round(niche, 6) AS niche, "
            "round(ratio, 6) AS ratio, "
            f"concat({_fixed('ratio', 1)}, '×') AS ratio_text, "
            "CASE WHEN ratio >= 1 THEN 'above' ELSE 'below' END AS position FROM ("
            "SELECT *, CASE WHEN niche > 0 THEN coalesce(channel / niche, 0) ELSE 0 END AS ratio FROM ("
            "SELECT 'Avg Views' AS metric, c.avg_views AS channel, b.avg_views_per_video AS niche "
            f"FROM channel_summary c, niche_benchmarks b WHERE c.channel_id = '{_CHANNEL}' AND b.niche = {own_niche} "
            "UNION ALL SELECT 'Engagement', c.avg_engagement_rate, b.avg_engagement_rate "
            f"FROM channel_summary c, niche_benchmarks b WHERE c.channel_id = '{_CHANNEL}' AND b.niche = {own_niche}) u) r"
        ),
        "channel_tier_distribution": _models(
            "SELECT replace(performance_tier, '_', ' ') AS name, count(*) AS value, "
            f"performance_tier AS tier FROM fact WHERE channel_id = '{_CHANNEL}' GROUP BY performance_tier"
        ),
        "channel_duration_distribution": _models(
            "SELECT duration_category AS name, count(*) AS value, duration_category AS category "
            f"FROM fact WHERE channel_id = '{_CHANNEL}' GROUP BY duration_category"
        ),
        "video_explorer": _models(_explorer("true", "view_count", 50)),
        "video_explorer_live": _models(
            _explorer("f.niche = 'machinery' AND f.was_live", "views_per_day", 100)
        ),
        "video_explorer_regular": _models(
            _explorer("f.region = 'ID' AND NOT f.was_live", "upload_date", 100)
        ),
        "video_explorer_by_tier": _models(
            _explorer("f.performance_tier = 'above_average'", "engagement_rate", 100)
        ),
        "video_page_summary": _models(
            "SELECT count(*) AS videos_shown, "
            "round(coalesce(sum(coalesce(view_count, 0)), 0) / CAST(greatest(count(*), 1) AS DOUBLE), 6) AS avg_views, "
            "round(coalesce(sum(coalesce(engagement_rate, 0)), 0) / greatest(count(*), 1), 6) AS avg_engagement, "
            "CAST(count(*) FILTER (WHERE performance_tier = 'viral') AS BIGINT) AS viral_videos FROM ("
            + _explorer("true", "like_count", 100, "f.*")
            + ") p"
        ),
        "video_page_summary_text": _models(
            "SELECT videos_shown, "
            f"{_compact('avg_views')} AS avg_views, {_percent('avg_engagement')} AS avg_engagement, "
            "viral_videos FROM (SELECT count(*) AS videos_shown, avg(coalesce(view_count, 0)) AS avg_views, "
            "avg(coalesce(engagement_rate, 0)) AS avg_engagement, "
            "CAST(count(*) FILTER (WHERE performance_tier = 'viral') AS BIGINT) AS viral_videos FROM ("
            + _explorer("f.niche = 'building'", "view_count", 100, "f.*")
            + ") p) s"
        ),
        "display_video_table": _models(
            f"SELECT rank, video_id, {_short('title', 55)} AS title, "
            "concat('https://youtube.com/watch?v=', video_id) AS link, channel_name, niche, "
            f"{_compact('view_count')} AS views, {_compact('like_count')} AS likes, "
            f"{_percent('engagement_rate')} AS engagement, {_compact('views_per_day')} AS views_per_day, "
            f"{_duration('duration_seconds')} AS duration, CASE performance_tier "
            "WHEN 'above_average' THEN 'above avg' WHEN 'below_average' THEN 'below avg' "
            "ELSE performance_tier END AS tier, strftime(upload_date, '%Y-%m-%d') AS date FROM ("
            + ranked_page.format(
                order="views_per_day DESC NULLS LAST, video_id",
                page=_explorer("true", "views_per_day", 100, any_page),
            )
            + ") t"
        ),
        "video_ranking": _models(
            "SELECT video_id, view_count, row_number() OVER (ORDER BY view_count DESC NULLS LAST, "
            "video_id) AS rank FROM fact"
        ),
        "niche_overview": _NICHES,
        "niche_region": _models(
            f"SELECT niche, region, count(DISTINCT channel_id) AS channels, count(*) AS videos, {kpi} "
            "AS avg_engagement, round(avg(view_count), 6) AS avg_views, "
            "round(avg(like_rate), 6) AS avg_like_rate FROM fact GROUP BY niche, region"
        ),
        "niche_region_table": _models(
            "SELECT niche, CASE WHEN region = 'ID' THEN 'Indonesia' ELSE 'Global' END AS region, "
            f"channels, videos, {_compact('total_views')} AS total_views, "
            f"{_compact('avg_views')} AS avg_views, {_percent('avg_engagement')} AS engagement, "
            f"{_percent('avg_like_rate')} AS like_rate FROM (SELECT niche, region, "
            "count(DISTINCT channel_id) AS channels, count(*) AS videos, sum(view_count) AS total_views, "
            "avg(view_count) AS avg_views, avg(engagement_rate) AS avg_engagement, "
            "avg(like_rate) AS avg_like_rate FROM fact GROUP BY niche, region) g"
        ),
        "duration_analysis": _models(_DURATIONS),
        "upload_day_analysis": _models(_DAYS),
        "niche_radar": _models(_radar()),
        "duration_pivot": _models(
            _pivot(
                "('short', '<1 min'), ('medium', '1-10 min'), ('long', '10-60 min'), ('very_long', '>1 hour')",
                "duration_category", _DURATIONS, "avg_views", "duration",
            )
        ),
        "upload_day_pivot": _models(
            _pivot(
                "(1, 'Sun'), (2, 'Mon'), (3, 'Tue'), (4, 'Wed'), (5, 'Thu'), (6, 'Fri'), (7, 'Sat')",
                "upload_day_of_week", _DAYS, "count", "day",
            )
        ),
        "id_vs_global": _models(
            "SELECT niche, round(coalesce(avg(view_count) FILTER (WHERE region = 'ID'), 0), 6) AS Indonesia, "
            "round(coalesce(avg(view_count) FILTER (WHERE region = 'GLOBAL'), 0), 6) AS Global "
            "FROM fact GROUP BY niche"
        ),
        "niche_cards": _models(
            "SELECT niche, total_channels, concat(id_channels, ' / ', global_channels) AS indonesia_global, "
            f"{_compact('avg_subscribers')} AS avg_subscribers, "
            f"{_compact('avg_views_per_video')} AS avg_views_per_video, "
            f"{_percent('avg_engagement_rate')} AS engagement_rate, "
            f"{_percent('avg_like_rate')} AS like_rate, "
            "concat(CAST(floor(coalesce(avg_duration, 0) / 60 + 0.5) AS BIGINT), 'm') AS avg_duration, "
            f"{_fixed('coalesce(avg_uploads_last_30d, 0)', 1)} AS uploads_30d FROM niche_benchmarks"
        ),
        "listing_parse": _ingest("SELECT config_url, tab, position, video_id FROM listing"),
        "video_dump_parse": _ingest("SELECT * FROM parsed"),
        "video_lines_sorted_out": _ingest(
            "SELECT video_id, fate, count(*) OVER (PARTITION BY fate) AS lines_of_fate FROM (SELECT video_id, "
            "CASE WHEN o_orderkey % 47 = 0 THEN 'empty line' WHEN o_orderkey % 43 = 0 THEN 'no JSON object' "
            "WHEN duration_seconds IS NULL THEN 'no JSON' "
            "WHEN o_orderkey % 41 = 0 AND upload_date IS NOT NULL THEN 'no upload day' ELSE 'parsed' END AS fate FROM raw_videos)"
        ),
        "channel_dump_merge": _ingest("SELECT * FROM merged"),
        "channel_probe_urls": _ingest(
            "SELECT channel_url AS config_url, concat('https://www.youtube.com/watch?v=x', channel_id) "
            "AS video_url FROM current_channels WHERE niche <> 'machinery'"
        ),
        "raw_channel_rows": _ingest(
            "SELECT m.channel_id, m.channel_name, m.channel_url, m.subscriber_count, m.description, "
            "m.scraped_at, r.niche, r.region, r.name AS config_name "
            "FROM merged m JOIN registry r ON r.url = m.config_url"
        ),
        "staged_channel_rows": _ingest(
            "SELECT channel_id, channel_name, config_name, niche, region FROM ("
            "SELECT m.channel_id, coalesce(m.channel_name, r.name) AS channel_name, r.name AS config_name, r.niche, r.region, "
            "row_number() OVER (PARTITION BY m.channel_id ORDER BY m.scraped_at DESC, m.subscriber_count DESC NULLS LAST, "
            "coalesce(m.channel_name, r.name) DESC) AS place "
            "FROM merged m JOIN registry r ON r.url = m.config_url WHERE m.channel_id IS NOT NULL) "
            "WHERE place = 1 AND coalesce(channel_name, '') <> '' AND channel_id <> ''"
        ),
        "registry_flatten": _ingest(
            "SELECT config_name AS name, channel_url AS url, "
            "CASE WHEN region = 'ID' THEN channel_id END AS channel_id, niche, region, CAST(0 AS BIGINT) AS position "
            "FROM current_channels UNION ALL SELECT concat('alt-', config_name), "
            "concat(channel_url, '/alt'), NULL, niche, region, 1 FROM current_channels"
        ),
        "registry_one_niche": _ingest("SELECT * FROM registry WHERE niche = 'household'"),
        "registry_resolution": _ingest("SELECT * FROM resolved"),
        "registry_status_counts": _ingest(
            "SELECT niche, CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid, "
            "CAST(count(*) FILTER (WHERE status = 'found_via_search') AS BIGINT) AS found_via_search, "
            "CAST(count(*) FILTER (WHERE status = 'not_found') AS BIGINT) AS not_found "
            "FROM resolved GROUP BY niche"
        ),
        "listed_videos": _ingest("SELECT config_url, tab, video_id FROM listed"),
        "listing_requests": _ingest(
            "SELECT url AS config_url, tab, concat(url, '/', tab) AS request_url "
            "FROM registry CROSS JOIN (VALUES ('videos'), ('streams')) t(tab)"
        ),
        "video_requests": _ingest(
            "SELECT DISTINCT video_id, concat('https://www.youtube.com/watch?v=', video_id) AS request_url "
            "FROM listing"
        ),
        "incremental_new_videos": _ingest(
            "SELECT p.video_id, p.title, p.channel_id, p.view_count, r.niche, r.region "
            "FROM claimed c JOIN registry r ON r.position = c.entry JOIN parsed p ON p.video_id = c.video_id"
        ),
        "incremental_report": _ingest(
            "SELECT r.url AS config_url, r.name, r.niche, r.region, r.name NOT LIKE 'mix%' AS channel_loaded, "
            "(SELECT count(*) FROM listed l WHERE l.config_url = r.url) AS total_found, "
            "(SELECT count(*) FROM listed l WHERE l.config_url = r.url) "
            "- (SELECT count(*) FROM fresh f WHERE f.config_url = r.url) AS existing, "
            "(SELECT count(*) FROM claimed c WHERE c.entry = r.position AND c.has_video) AS new_videos, "
            "(SELECT count(*) FROM claimed c WHERE c.entry = r.position AND c.has_video) = 0 AS skipped "
            "FROM registry r"
        ),
        "run_report": _ingest(
            "SELECT count(*) AS channels, CAST(count(*) FILTER (WHERE name NOT LIKE 'mix%') AS BIGINT) AS channels_loaded, "
            "CAST(count(*) FILTER (WHERE name LIKE 'mix%') AS BIGINT) AS channels_failed, "
            "CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS channels_skipped, "
            "CAST(sum(n) AS BIGINT) AS videos_loaded FROM (SELECT r.name, "
            "(SELECT count(*) FROM listed_10 l JOIN parsed p ON p.video_id = l.video_id "
            "WHERE l.config_url = r.url) AS n FROM registry r) s"
        ),
        "incremental_claims_chain": _ingest(
            f""", chained AS (
  SELECT number - step AS number, o_orderkey AS position, video_id, video_id IN (SELECT video_id FROM parsed) AS has_video
  FROM (SELECT *, CAST(substr(channel_id, 3) AS BIGINT) AS number FROM raw_videos) v, (VALUES (0), (1)) s(step)
  WHERE step = 0 OR number % {CHAINED} <> 0
), lists AS MATERIALIZED (
  SELECT number + 1 AS entry, row_number() OVER (ORDER BY number) AS turn, ids FROM (
    SELECT number, list({{'video_id': video_id, 'has_video': has_video}} ORDER BY position) AS ids FROM (
      SELECT *, row_number() OVER (PARTITION BY number ORDER BY position) AS place FROM chained
      WHERE number IN (SELECT position - 1 FROM registry)) c
    WHERE place <= 30 GROUP BY number) l
), walk AS (
  SELECT CAST(0 AS BIGINT) AS turn, CAST(0 AS BIGINT) AS entry, CAST([] AS VARCHAR[]) AS taken,
         CAST([] AS STRUCT(video_id VARCHAR, has_video BOOLEAN)[]) AS new
  UNION ALL
  SELECT turn, entry, list_concat(taken, [x.video_id FOR x IN new IF x.has_video]), new FROM (
    SELECT l.turn, l.entry, w.taken, list_filter(l.ids, lambda x: NOT list_contains(w.taken, x.video_id))[1:3] AS new
    FROM walk w JOIN lists l ON l.turn = w.turn + 1) n
)
SELECT entry, new.video_id AS video_id, new.has_video AS has_video FROM (SELECT entry, unnest(new) AS new FROM walk) w"""
        ).replace("WITH ", "WITH RECURSIVE ", 1),
        "failed_channels": _ingest("SELECT url, name, niche FROM registry WHERE name LIKE 'mix%'"),
        "full_reload": _ingest(
            "SELECT p.video_id, p.channel_id, p.upload_date, p.view_count, r.niche, r.region "
            "FROM listed_10 l JOIN registry r ON r.url = l.config_url JOIN parsed p ON p.video_id = l.video_id"
        ),
        "incremental_reload": _ingest(
            """, fresh_2 AS (
  SELECT * FROM fresh WHERE video_id NOT IN (SELECT video_id FROM claimed WHERE has_video)
), """
            + _claims("fresh_2", "_2")
            + """
), stored AS (
  SELECT video_id, channel_id FROM raw_videos WHERE upload_date < '2001-01-01'
  UNION ALL SELECT p.video_id, p.channel_id FROM claimed c JOIN parsed p ON p.video_id = c.video_id
  UNION ALL SELECT p.video_id, p.channel_id FROM claimed_2 c JOIN parsed p ON p.video_id = c.video_id
), counted AS (
  SELECT channel_id, count(*) AS videos, count(DISTINCT video_id) AS distinct_videos
  FROM stored GROUP BY channel_id
), snaps AS (
  SELECT m.channel_id, CAST(2 * count(*) AS BIGINT) AS snapshots
  FROM merged m JOIN registry r ON r.url = m.config_url GROUP BY m.channel_id
)
SELECT coalesce(c.channel_id, s.channel_id) AS channel_id, coalesce(videos, 0) AS videos,
       coalesce(distinct_videos, 0) AS distinct_videos, coalesce(snapshots, 0) AS snapshots
FROM counted c FULL JOIN snaps s ON c.channel_id = s.channel_id"""
        ),
        "incremental_stream": _ingest(
            "SELECT video_id, CASE WHEN max(CASE WHEN tab = 'videos' THEN 1 ELSE 0 END) = 1 "
            "THEN 'videos' ELSE 'streams' END AS tab FROM listing GROUP BY video_id"
        ),
        "stream_sink_merged": _ingest(
            "SELECT video_id, CASE WHEN max(CASE WHEN tab = 'videos' THEN 1 ELSE 0 END) = 1 "
            "THEN 'videos' ELSE 'streams' END AS tab FROM listing GROUP BY video_id"
        ),
        "loaded_id_index": _ingest(
            "SELECT DISTINCT video_id FROM listed WHERE video_id IN (SELECT video_id FROM loaded)"
        ),
        "incremental_reload_indexed": _ingest(
            """, fresh_2 AS (
  SELECT * FROM fresh WHERE video_id NOT IN (SELECT video_id FROM claimed WHERE has_video)
), """
            + _claims("fresh_2", "_2")
            + """
), stored AS (
  SELECT video_id, channel_id FROM raw_videos WHERE upload_date < '2001-01-01'
  UNION ALL SELECT p.video_id, p.channel_id FROM claimed c JOIN parsed p ON p.video_id = c.video_id
  UNION ALL SELECT p.video_id, p.channel_id FROM claimed_2 c JOIN parsed p ON p.video_id = c.video_id
), counted AS (
  SELECT channel_id, count(*) AS videos, count(DISTINCT video_id) AS distinct_videos
  FROM stored GROUP BY channel_id
), snaps AS (
  SELECT m.channel_id, CAST(1 AS BIGINT) AS newest
  FROM merged m JOIN registry r ON r.url = m.config_url WHERE m.channel_id IS NOT NULL GROUP BY m.channel_id
)
SELECT coalesce(c.channel_id, s.channel_id) AS channel_id, coalesce(videos, 0) AS videos,
       coalesce(distinct_videos, 0) AS distinct_videos, coalesce(newest, 0) AS newest
FROM counted c FULL JOIN snaps s ON c.channel_id = s.channel_id"""
        ),
        "sink_append_overwrite": _ingest(
            "SELECT step, written AS rows_written, stored AS rows_stored FROM ("
            "SELECT count(*) AS n FROM customer) c, LATERAL (VALUES ('create', n, n), "
            "('append', 2 * n, 3 * n), ('append_nothing', 0, 3 * n), ('overwrite_nothing', 0, 3 * n), "
            "('overwrite', 2 * n, 2 * n)) v(step, written, stored)"
        ),
        "catalog_table_steps": (
            "SELECT step, true AS done, stored AS rows_stored FROM (SELECT count(*) AS n FROM customer) c, "
            "LATERAL (VALUES ('absent', -1), ('created', n), ('refused', n), ('appended', 3 * n), "
            "('replaced', 2 * n), ('namespace', 2 * n), ('dropped', -1)) v(step, stored)"
        ),
        "catalog_version_steps": (
            "SELECT step, stored AS rows_stored FROM (SELECT count(*) AS n FROM customer) c, "
            "LATERAL (VALUES ('created', n), ('appended', 3 * n), ('replacement failed', 3 * n), ('replaced', 2 * n), "
            "('planned before', 3 * n), ('saved twice', n), ('versions', 2)) v(step, stored)"
        ),
        "channel_rows_stamped_now": (
            "SELECT count(*) AS rows, count(*) AS iso_rows, CAST(1 AS BIGINT) AS times, count(*) AS recent_rows FROM customer"
        ),
        "sink_typed_table": _ingest(
            "SELECT video_id, title, view_count AS views, CAST(upload_date AS DATE) AS upload_date FROM raw_videos"
        ),
        "batch_union": _ingest(
            "SELECT 'all' AS table_name, 3 * count(*) AS rows FROM customer "
            "UNION ALL SELECT 'described', 2 * count(*) FROM customer "
            "UNION ALL SELECT 'videos', count(*) FROM orders"
        ),
        "channel_summary_daily": _SUMMARY,
        "channel_summary_daily_earlier": _SUMMARY.replace("DATE '2001-08-02'", "DATE '1996-03-05'"),
        "channel_rolling_uploads": _models(
            "SELECT channel_id, upload_date, videos, CAST(sum(videos) OVER (PARTITION BY channel_id "
            "ORDER BY upload_date) AS BIGINT) AS total_videos, CAST(sum(videos) OVER (PARTITION BY channel_id "
            "ORDER BY upload_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS videos_last_30d, "
            "CAST(sum(videos) OVER (PARTITION BY channel_id ORDER BY upload_date "
            "RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS videos_last_7d "
            "FROM (SELECT channel_id, upload_date, count(*) AS videos FROM stg_videos "
            "WHERE upload_date IS NOT NULL AND channel_id IS NOT NULL GROUP BY 1, 2) u"
        ),
        "niche_medians_merged": _models(
            "SELECT niche, count(subscriber_count) AS channels, "
            "quantile_disc(subscriber_count, 0.5) AS median_subscribers FROM channel_summary GROUP BY niche"
        ),
        "view_quantiles_bounded": _models(
            "SELECT niche, fraction, count(view_count) AS videos, true AS near FROM fact "
            "CROSS JOIN (SELECT unnest([CAST(0.25 AS DOUBLE), 0.5, 0.75]) AS fraction) q GROUP BY niche, fraction"
        ),
        "retention_day_table": _ingest(
            "SELECT u.rows, channel_id, scraped_at, subscriber_count FROM raw_channels "
            "CROSS JOIN (SELECT unnest(['retained', 'left']) AS rows) u "
            "WHERE CAST(substr(scraped_at, 1, 10) AS DATE) >= DATE '2001-09-16' - INTERVAL 60 DAY"
        ),
        "retention_60d": _ingest(
            "SELECT channel_id, scraped_at, subscriber_count FROM raw_channels "
            "WHERE CAST(substr(scraped_at, 1, 10) AS DATE) >= DATE '2001-09-16' - INTERVAL 60 DAY"
        ),
        "dq_staging": _models(dq),
        "dq_fk": _models(
            "SELECT 'fct_video_performance' AS table_name, 'channel_id' AS column_name, "
            "'relationships' AS test, count(*) AS failures FROM fact "
            "WHERE channel_id NOT IN (SELECT channel_id FROM dim)"
        ),
        "report_niche_activity": _models(
            "SELECT niche, round(avg(avg_views), 6) AS avg_views_per_video, "
            "round(avg(videos_last_30d), 6) AS avg_uploads_last_30d, "
            "round(avg(avg_views_per_sub), 6) AS avg_views_per_sub FROM channel_summary GROUP BY niche"
        ),
        "report_size_mix": _models(
            "SELECT niche, size_tier, count(*) AS channels, "
            "round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY niche) AS DOUBLE), 6) AS share "
            "FROM channel_summary GROUP BY niche, size_tier"
        ),
        "report_subscriber_view_map": _models(
            "SELECT channel_id, channel_name, niche, region, size_tier, subscriber_count, "
            "round(avg_views, 6) AS avg_views FROM channel_summary"
        ),
        "report_efficiency_top": _models(
            "SELECT row_number() OVER (ORDER BY avg_views_per_sub DESC, channel_id, niche, region) AS rank, "
            "channel_id, channel_name, niche, subscriber_count, round(avg_views_per_sub, 6) AS avg_views_per_sub "
            "FROM channel_summary WHERE avg_views_per_sub IS NOT NULL "
            "ORDER BY channel_summary.avg_views_per_sub DESC, channel_id, niche, region LIMIT 10"
        ),
        "report_underperformers": _models(
            "SELECT channel_id, channel_name, niche, size_tier, subscriber_count, "
            "round(avg_views_per_sub, 6) AS avg_views_per_sub, "
            "round(niche_views_per_sub, 6) AS niche_views_per_sub FROM ("
            "SELECT *, avg(avg_views_per_sub) OVER (PARTITION BY niche) AS niche_views_per_sub "
            "FROM channel_summary) s WHERE size_tier IN ('mega', 'large') "
            "AND avg_views_per_sub < niche_views_per_sub"
        ),
        "report_content_strategy": _models(
            " UNION ALL ".join(
                f"SELECT '{name}' AS dimension, CAST({name} AS VARCHAR) AS category, count(*) AS videos, "
                "round(avg(view_count), 6) AS avg_views, round(avg(engagement_rate), 6) AS avg_engagement "
                f"FROM fact GROUP BY {name}"
                for name in ("duration_category", "performance_tier", "was_live")
            )
        ),
        "report_activity": _models(
            "SELECT channel_id, channel_name, niche, videos_last_30d, round(avg_views, 6) AS avg_views "
            "FROM channel_summary"
        ),
        "report_coverage_cube": _models(
            'SELECT coalesce(niche, \'Total\') AS niche, '
            "CAST(count(*) FILTER (WHERE region = 'ID') AS BIGINT) AS indonesia, "
            "CAST(count(*) FILTER (WHERE region = 'GLOBAL') AS BIGINT) AS global, "
            "count(*) AS total FROM dim GROUP BY ROLLUP (niche)"
        ),
    }
    pages = {
        "overview.kpis": "overview_kpis",
        "overview.by_niche": "overview_by_niche",
        "overview.top_videos": "overview_top_videos",
        "overview.by_region": "overview_by_region",
        "overview.tiers": "overview_tiers",
        "niche.overview": "niche_overview",
        "niche.niche_region": "niche_region",
        "niche.duration_analysis": "duration_analysis",
        "niche.upload_days": "upload_day_analysis",
        "channel.channel": "channel_info",
        "channel.metrics": "channel_metrics",
        "channel.videos": "channel_videos",
        "channel.benchmark": "channel_benchmark",
        "channel.peers": "channel_peers",
    }
    found["page_bundle_rows"] = " UNION ALL ".join(
        f"SELECT '{part}' AS table_name, (SELECT count(*) FROM ({found[name]}) q) AS rows" for part, name in pages.items()
    )
    return found
