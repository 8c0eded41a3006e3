"""Column lists and fixed values of the data model.

FIXED VALUES — these must equal the values the original pipeline uses, so
results match; they are stated here once, in their original order.
"""

# --- fixed values -----------------------------------------------------------
# Marker of a deleted author (null is treated the same way).
DELETED_AUTHOR = "[deleted]"

# Subreddit allow-list of the prep step (compared case-sensitively).
POLITICAL_SUBREDDITS = (
    "The_Donald", "HillaryClinton", "SandersForPresident", "politics",
    "Conservative", "Republican", "Democrats", "Libertarian", "Ask_Politics", "POLITIC", "PoliticalDiscussion",
    "NeutralPolitics", "ModeratePolitics", "Anarchism", "Anarcho_Capitalism",
)

# Allow-list of the season (three-month) variant.
SEASON_SUBREDDITS = ("Politics", "The_Donald", "HillaryClinton", "SandersForPresident")

# Columns the prep step drops from raw submissions.
SUBMISSION_DROP_COLUMNS = (
    "author_flair_css_class", "author_flair_text", "clicked", "hidden", "is_self", "likes",
    "link_flair_css_class", "link_flair_text", "locked", "media", "media_embed", "over_18", "permalink", "saved",
    "score", "selftext", "selftext_html", "thumbnail", "title", "url", "edited", "distinguished", "stickied",
    "adserver_click_url", "adserver_imp_pixel", "preview", "secure_media", "secure_media_embed",
    "archived", "contest_mode", "downs", "href_url", "domain", "gilded", "hide_score", "imp_pixel", "mobile_ad_url", "post_hint",
    "quarantine", "retrieved_on", "third_party_tracking", "third_party_tracking_2", "ups", "promoted_display_name", "promoted_url",
    "spoiler", "original_link", "from", "from_id", "from_kind", "promoted", "promoted_by",
)

# Columns the season variant drops (one list for posts and comments).
SEASON_DROP_COLUMNS = (
    "author_flair_css_class", "author_flair_text", "clicked", "hidden", "is_self", "likes",
    "link_flair_css_class", "link_flair_text", "locked", "media", "media_embed", "over_18", "permalink", "saved",
    "score", "selftext", "selftext_html", "thumbnail", "title", "url", "edited", "distinguished", "stickied",
    "adserver_click_url", "adserver_imp_pixel", "preview", "secure_media", "secure_media_embed",
    "archived", "contest_mode", "downs", "href_url", "domain", "gilded", "hide_score", "imp_pixel", "mobile_ad_url", "post_hint",
    "quarantine", "retrieved_on", "third_party_tracking", "third_party_tracking_2", "ups", "promoted_display_name", "promoted_url",
    "spoiler", "author_flair_css_class", "author_flair_text", "controversiality", "distinguished", "edited", "gilded",
    "retrieved_on", "score", "stickied", "ups", "promoted", "from", "from_id",
)

# Columns the prep step keeps from comments (after hashing).
COMMENT_KEEP_COLUMNS = (
    "author", "body", "created_utc", "id", "link_id", "parent_id", "subreddit", "subreddit_id",
    "link_hash", "auth_id", "sub_id",
)

# Vertex types and edge relationships of the property graph.
TYPE_SUBREDDIT = "subreddit"
TYPE_USER = "user"
REL_POSTED = "posted"
REL_COMMENTED = "commented"

# Algorithm depths and report thresholds of the original jobs.
SCC_MAX_ITER = 10
SCC_MAX_ITER_SEASON = 2
PAGERANK_MAX_ITER = 10
PAGERANK_RESET = 0.15
COMPONENT_MIN_SIZE = 2          # reports keep components with count > 2
PAIR_MIN_COUNT = 1              # popular pairs keep count > 1
TOP_COMPONENTS_PERIOD = 20
TOP_COMPONENTS_SEASON = 100
TOP_PAGERANK = 20
# --- end of fixed values ----------------------------------------------------

# Partition column of the prepped tables (one value per calendar month).
MONTH_COL = "month"
