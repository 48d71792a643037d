"""URL to news-site key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host prefixes that carry a region or a section, not the site.
SITE_PREFIXES = ["af", "ca", "in", "uk", "www", "radio", "video", "go", "markets", "global"]

# Site key -> agency key.
AGENCY_OF_SITE = {
    "cbsnews": "cbs-news",
    "abcnews": "abc-news",
    "usatoday": "usa-today",
    "foxnews": "fox",
    "nbcnews": "nbc-news",
    "washingtontimes": "washington-times",
    "aljazeera": "al-jazeera",
    "businessinsider": "business",
    "fortune": "business",
    "nfl": "sports",
    "nhl": "sports",
    "bleacherreport": "sports",
    "foxsports": "sports",
    "nationalreview": "politics",
    "thehill": "politics",
    "politico": "politics",
    "wired": "technology",
    "techradar": "technology",
    "buzzfeed": "technology",
    "engadget": "technology",
    "arstechnica": "technology",
    "techcrunch": "technology",
    "verge": "technology",
}

# Agency name of the crawler feed -> agency key.
AGENCY_OF_FEED_NAME = {
    "huffington-post": "huffington",
    "fox-news": "fox",
    "breitbart-news": "breitbart",
    "al-jazeera-english": "al-jazeera",
    "nhl-news": "sports",
    "business-insider": "business",
    "wall-street-journal": "business",
    "fox-sports": "sports",
    "nhl": "sports",
    "nfl": "sports",
    "bleacher-report": "sports",
    "espn": "sports",
    "national-review": "politics",
    "hill": "politics",
    "politico": "politics",
    "buzzfeed": "technology",
    "engadget": "technology",
    "ars-technica": "technology",
    "wired": "technology",
    "techcrunch": "technology",
    "tech-radar": "technology",
    "verge": "technology",
}

# Registered domain -> agency key.
AGENCY_OF_DOMAIN = {
    "foxnews": "fox",
    "cnn": "cnn",
    "npr": "npr",
    "reuters": "reuters",
    "nbcnews": "nbc-news",
    "cbsnews": "cbs-news",
    "msnbc": "msnbc",
    "usatoday": "usa-today",
    "usnews": "us-news",
    "huffpost": "huffington",
    "go": "go",
    "abcnews": "abc-news",
    "huffingtonpost": "huffington",
    "whitehouse": "whitehouse",
    "msn": "msn",
    "journalstar": "journalstar",
    "apnews": "apnews",
    "aljazeera": "aljazeera",
    "bloomberg": "bloomberg",
    "wsj": "wsj",
}

# The agency keys reports keep; all else is "other".
KNOWN_AGENCIES = [
    "huffington", "reuters", "cbs-news", "usa-today", "cnn", "npr", "abc-news", "us-news",
    "msn", "pbs", "nbc-news", "cnbc", "msnbc", "fox", "apnews", "breitbart", "al-jazeera",
    "axios", "washington-times", "politics", "business", "sports", "technology",
]


def host(url: Column) -> Column:
    """Lower-case host name without port; empty when the URL has none."""
    return F.regexp_extract(F.lower(F.trim(url)), r"^(?:https?://)?([^/?#:\s]+)", 1)


def site_key(url: Column, prefixes: list[str] | None = None) -> Column:
    """Host with leading section prefixes, ``.com`` and ``-post`` removed."""
    leading = "|".join(prefixes or SITE_PREFIXES)
    key = F.regexp_replace(host(url), rf"^(?:(?:{leading})\.)+", "")
    key = F.regexp_replace(key, r"(?:\.go)?\.com$", "")
    return F.regexp_replace(key, r"-post$", "")


def registered_domain(url: Column) -> Column:
    """The label left of the public suffix (``news.bbc.co.uk`` -> ``bbc``)."""
    pattern = r"([^.]+)\.(?:(?:co|com|org|net|gov|ac|edu)\.[a-z]{2}|[a-z]+)$"
    return F.regexp_extract(host(url), pattern, 1)
