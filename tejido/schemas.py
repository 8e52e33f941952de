"""Schemas and closed value sets of the engine's tables."""

from __future__ import annotations

FRONTIER = (
    "url_hash string, url string, source string, status string, created_at timestamp, updated_at timestamp, error_message string, content_hash string, "
    "file_path string, token_count bigint, content_size bigint, mexican_score double, extraction_method string, processing_time_ms double, retry_count int, "
    "priority_score double, discovered_from string, content_type string, has_comments boolean, comment_count int, link_discovery_count int"
)
METRICS = "timestamp timestamp, metric_name string, metric_value double, source string, additional_data string"
SESSIONS = "session_id string, started_at timestamp, ended_at timestamp, processed bigint, successful bigint, tokens bigint"
SOURCE_STATS = (
    "source_name string, last_updated timestamp, total_urls bigint, completed_urls bigint, failed_urls bigint, total_tokens bigint, avg_mexican_score double, "
    "avg_processing_time_ms double, success_rate double"
)
DOMAIN_YIELD = "domain string, total_urls bigint, completed_urls bigint, total_tokens bigint, avg_tokens_per_url double, yield_efficiency double"
CONTENT_ITEM = (
    "type string, title string, text string, url string, score bigint, created_utc timestamp, subreddit string, author string, num_comments int, "
    "parent_post_title string, post_type string, channel string, video_id string, published_at timestamp, description string, transcript_length int, mexican_score double"
)
LINK = "parent_url string, url string, anchor_text string, relevance_score double, link_type string"
DOMAIN = "rank int, domain string, indicators array<string>, score double, category string"
FEED_ENTRY = (
    "url string, title string, description string, published_date timestamp, categories array<string>, source string, feed_url string, entry_id string, discovered_at timestamp"
)
SONG = "artist string, title string, url string, lyrics string, success boolean, metadata map<string,string>"
SOURCE_CONFIG = (
    "name string, base_url string, type string, urls array<string>, start_urls array<string>, render_js boolean, crawl_depth int, comment_selector string, "
    "respect_robots_txt boolean, dynamic_recursion boolean, recursion_keywords array<string>, api_limit int, crawl_comments boolean"
)
TABLES = {"urls": FRONTIER, "performance_metrics": METRICS, "sessions": SESSIONS, "source_stats": SOURCE_STATS, "domain_yield": DOMAIN_YIELD}
#: How the tables are laid out, in place of indexes.
PARTITIONED_BY = {"urls": ["status"], "performance_metrics": ["metric_name"]}
STATUS = ["pending", "processing", "completed", "failed", "blocked"]
CONFIDENCE = ["high", "medium", "low", "very_low"]
TEXT_QUALITY = ["too_short", "binary", "corrupted", "good", "acceptable", "poor"]
LINK_TYPES = ["government", "academic", "news", "research", "document", "general"]
DOMAIN_CATEGORIES = ["government", "education", "news", "commercial", "organization", "general"]
TARGET_TOKENS = 1_000_000_000
