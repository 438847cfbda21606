"""Tables read and written by the harvesting jobs."""

from __future__ import annotations

CRAWL_REQUESTS = (
    "crawl_id string, url string, discover boolean, path_prefix string, strategy string, "
    "include_paths string, exclude_paths string, max_pages int, max_depth int, "
    "max_concurrency int, request_delay_ms int"
)

# One row per fetched URL; a URL that could not be fetched has no row or a null status.
RESPONSES = "url string, status int, content_type string, body string, location string, elapsed_ms bigint"

DNS = "host string, ip string"

PAGES = "crawl_id string, page_no bigint, source_url string, title string, description string, content string"

PROGRESS = (
    "crawl_id string, seq int, completed bigint, total bigint, status string, capped boolean, reason string"
)

URL_LIST = "crawl_id string, pos bigint, url string"
