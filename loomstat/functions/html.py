"""Raw page markup to plain text, as one chain of JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Removal patterns, in order of application.
DROPPED_BLOCKS = [r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"]

# Entities that are decoded; any other becomes a space.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " "}

AMPERSAND_MARK = "\u0001"


def page_text(html: Column) -> Column:
    text = F.coalesce(html, F.lit(""))
    for pattern in DROPPED_BLOCKS:
        text = F.regexp_replace(text, pattern, " ")
    for entity, plain in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    text = F.replace(text, F.lit("&amp;"), F.lit(AMPERSAND_MARK))
    text = F.regexp_replace(text, r"&#?[A-Za-z0-9]+;", " ")
    text = F.replace(text, F.lit(AMPERSAND_MARK), F.lit("&"))
    return F.trim(F.regexp_replace(text, r"\s+", " "))
