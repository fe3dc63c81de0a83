"""Article records from landed HTML pages, and the storage projection of an article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, word_count
from ..schemas import ARTICLE_STORED_FIELDS

_INVISIBLE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_TAG = r"<[^>]*>"
_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
_LANG = r'(?i)<html[^>]*\blang="([^"]*)"'
_ARTICLE = r"(?is)<article\b[^>]*>(.*)</article>"
_BODY = r"(?is)<body\b[^>]*>(.*)</body>"
_PARAGRAPH = r"(?is)<p\b[^>]*>(.*?)</p>"
_HREF = r'(?i)<a\b[^>]*\bhref="([^"]*)"'
_ITEM = r"(?is)<li\b[^>]*>\s*<a\b[^>]*>(.*?)</a>\s*</li>"
_BLOCK_END = r"(?i)</(?:p|div|h[1-6]|li|tr|section|article)>|<br\s*/?>"


def unescape(c: Column) -> Column:
    """Decode the five basic entities; ``&amp;`` last, so nothing is decoded twice."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def plain(c: Column) -> Column:
    """Markup → text on one line: tags out, entities decoded, ends stripped."""
    return strip(unescape(F.regexp_replace(c, _TAG, "")))


def page_text(html: Column) -> Column:
    """Whole visible text of the article (else the body); block ends become line breaks."""
    visible = F.regexp_replace(html, _INVISIBLE, "")
    article = F.regexp_extract(visible, _ARTICLE, 1)
    body = F.when(article != "", article).otherwise(F.regexp_extract(visible, _BODY, 1))
    lines = F.regexp_replace(F.regexp_replace(body, _BLOCK_END, "\n"), _TAG, "")
    return strip(F.regexp_replace(unescape(lines), r"\n{2,}", "\n"))


def page_catalogue(pages: DataFrame) -> DataFrame:
    """``page_id, url, title, language_code`` of every page."""
    return pages.select(
        "page_id",
        "url",
        plain(F.regexp_extract("html", _TITLE, 1)).alias("title"),
        F.regexp_extract("html", _LANG, 1).alias("language_code"),
    )


def article_records(pages: DataFrame, collected_at: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One article record per page; ``extra`` columns go over the standard ones."""
    visible = F.regexp_replace(F.col("html"), _INVISIBLE, "")
    language = F.regexp_extract("html", _LANG, 1)
    records = pages.select(
        "page_id",
        plain(F.regexp_extract("html", _TITLE, 1)).alias("title"),
        plain(F.regexp_extract(visible, _PARAGRAPH, 1)).alias("summary"),
        page_text(F.col("html")).alias("content"),
        "url",
        F.transform(F.regexp_extract_all(visible, F.lit(_ITEM), F.lit(1)), plain).alias("categories"),
        F.regexp_extract_all(visible, F.lit(_HREF), F.lit(1)).alias("links"),
        F.lit(collected_at).alias("collected_at"),
        F.concat(F.lit("wikipedia_"), language).alias("source"),
        language.alias("language"),
        plain(F.regexp_extract("html", _TITLE, 1)).alias("original_search_title"),
    )
    return records.withColumns(extra) if extra else records


def stored_article_fields(records: DataFrame) -> DataFrame:
    """Storage projection: the stored fields that are present, with the word count computed."""
    counted = records.withColumn("word_count", word_count(F.col("content")))
    return counted.select(*[c for c in ARTICLE_STORED_FIELDS if c in counted.columns])


def article_metadata(records: DataFrame) -> Column:
    """The full article record as one JSON column."""
    return F.to_json(F.struct(*[c for c in records.columns]), {"ignoreNullFields": "false"})
