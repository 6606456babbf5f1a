"""Thresholds, labels, domains and formats that results depend on."""

NICHES = ("gaming", "tech", "education", "music")
REGIONS = ("ID", "GLOBAL")
REGION_LABELS = {"ID": "Indonesia"}
REGION_LABEL_OTHERWISE = "Global"

# subscriber_count at least this many; otherwise (or NULL) the last tier
SIZE_TIERS = (("mega", 10_000_000), ("large", 1_000_000), ("medium", 100_000), ("small", 10_000))
SIZE_TIER_OTHERWISE = "micro"

# duration_seconds below this many; otherwise (or NULL) the last category
DURATION_CATEGORIES = (("short", 60), ("medium", 600), ("long", 3600))
DURATION_CATEGORY_OTHERWISE = "very_long"
DURATION_LABELS = (
    ("short", "<1 min"),
    ("medium", "1-10 min"),
    ("long", "10-60 min"),
    ("very_long", ">1 hour"),
)

# views over niche benchmark at least this; otherwise (or NULL) the last tier
PERFORMANCE_TIERS = (("viral", 3.0), ("above_average", 1.5), ("average", 0.5))
PERFORMANCE_TIER_OTHERWISE = "below_average"
PERFORMANCE_TIER_SHORT_LABELS = {"above_average": "above avg", "below_average": "below avg"}

# index 0 is day_of_week 1
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

VIDEO_TEXT_LIMIT = 1000
CHANNEL_TEXT_LIMIT = 500
WATCH_URL = "https://www.youtube.com/watch?v="
WATCH_LINK = "https://youtube.com/watch?v="

CHANNEL_SORTS = ("subscriber_count", "total_views", "avg_engagement_rate", "avg_views")
VIDEO_SORTS = ("view_count", "engagement_rate", "views_per_day", "like_count", "upload_date")

DEFAULT_LIMIT = 50
PAGE_LIMIT = 100
CHART_ROWS = 15
TOP_ROWS = 10

LISTING_LIMIT = 30
MAX_NEW_VIDEOS = 20
MAX_VIDEOS = 10
TAB_ORDER = ("videos", "streams")
RETENTION_DAYS = 60

# radar measures: label, column of the niche benchmark, smallest scale
RADAR_MEASURES = (
    ("Engagement", "avg_engagement_rate", 0.001),
    ("Avg Views", "avg_views_per_video", 1.0),
    ("Avg Subs", "avg_subscribers", 1.0),
    ("Upload Freq", "avg_uploads_last_30d", 1.0),
    ("Like Rate", "avg_like_rate", 0.001),
)
# channel against benchmark: label, channel column, benchmark column
COMPARED_MEASURES = (
    ("Avg Views", "avg_views", "avg_views_per_video"),
    ("Engagement", "avg_engagement_rate", "avg_engagement_rate"),
)
