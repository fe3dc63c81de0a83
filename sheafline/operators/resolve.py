"""Targets against a page catalogue: exact hits, suggestions, and ambiguous titles.

A title is suggested for a wanted one if it has at least ``OVERLAP`` of the wanted
one's different words; suggestions go by the number of shared words, then by title,
and are cut only after that. A title with that many words of the wanted one must
have one of its rarest words, so each wanted title is looked up under just so many
of its rarest words as the overlap demands; no suggestion is lost that way, and
words that stand in many titles are looked up only for wanted titles made of such
words.

``pages`` is read several times; give it as a stored table (see ``session.stage``)
and not as a view that takes titles out of HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import words
from ..vocab import MAX_RETRIES, RECURSIVE_LIMIT, SEARCH_MAX_RESULTS, SUGGESTIONS_SHOWN
from .ordering import first_n_per_key, first_per_key

#: Least share of a wanted title's words that a suggestion has, as a fraction of whole numbers.
OVERLAP = (1, 3)


def _folded(c: Column) -> Column:
    return F.lower(c)


def page_titles(pages: DataFrame) -> DataFrame:
    """One page per (language, folded title): the lowest page id."""
    keyed = pages.select("language_code", _folded(F.col("title")).alias("folded"), "title", "page_id")
    return first_per_key(keyed, ["language_code", "folded"], [F.col("page_id").asc()])


def search(
    queries: DataFrame, pages: DataFrame, size: int = SEARCH_MAX_RESULTS, overlap: tuple[int, int] = OVERLAP
) -> DataFrame:
    """``language_code, folded, titles``: the search result list of each distinct query.

    ``queries`` holds ``language_code, folded``. Queries without any result are left out.
    """
    num, den = overlap
    titles = page_titles(pages).withColumn("title_words", words(F.col("title")))
    by_word = titles.select("language_code", F.explode("title_words").alias("word"), "title", "page_id", "title_words")
    counts = by_word.groupBy("language_code", "word").agg(F.count("*").alias("title_count"))

    asked = queries.select("language_code", "folded").distinct().withColumn("asked_words", words(F.col("folded")))
    need = F.greatest(F.ceil(F.size("asked_words") * num / den), F.lit(1)).cast("int")
    each = asked.select("language_code", "folded", "asked_words", need.alias("need"), F.explode("asked_words").alias("word"))
    known = each.join(counts, ["language_code", "word"], "left")
    rarest = W.partitionBy("language_code", "folded").orderBy(F.coalesce("title_count", F.lit(0)), "word")
    prefix = known.withColumn("place", F.row_number().over(rarest))
    prefix = prefix.filter(F.col("title_count").isNotNull() & (F.col("place") <= F.size("asked_words") - F.col("need") + 1))

    found = prefix.select("language_code", "folded", "asked_words", "need", "word").join(by_word, ["language_code", "word"])
    shared = F.size(F.array_intersect("asked_words", "title_words"))
    found = found.withColumn("shared", shared).filter("shared >= need")
    # A pair met under several words is one.
    pairs = found.groupBy("language_code", "folded", "page_id").agg(F.first("title").alias("title"), F.first("shared").alias("shared"))
    order = [F.col("shared").desc(), F.col("title").asc(), F.col("page_id").asc()]
    first = first_n_per_key(pairs, ["language_code", "folded"], order, size)
    # At most ``size`` entries per query.
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_rank", "title"))), lambda x: x["title"])
    return first.groupBy("language_code", "folded").agg(listed.alias("titles"))


def check_targets(targets: DataFrame, pages: DataFrame, size: int = SEARCH_MAX_RESULTS, shown: int = SUGGESTIONS_SHOWN) -> DataFrame:
    """Check result of each target: ``success``, ``failed_with_suggestions`` or ``failed``.

    An exact hit lists the title found; a miss lists the first suggestions.
    """
    keyed = targets.withColumn("folded", _folded(F.col("collection_name")))
    exact = page_titles(pages).select("language_code", "folded", F.col("title").alias("_exact"))
    hit = keyed.join(exact, ["language_code", "folded"], "left")
    misses = keyed.join(exact, ["language_code", "folded"], "left_anti")
    found = search(misses, pages, size).withColumnRenamed("titles", "_found")
    both = hit.join(found, ["language_code", "folded"], "left")
    status = (
        F.when(F.col("_exact").isNotNull(), "success")
        .when(F.size("_found") > 0, "failed_with_suggestions")
        .otherwise("failed")
    )
    # Messages stored with a failed check.
    message = (
        F.when(F.col("_exact").isNotNull(), "")
        .when(F.size("_found") > 0, F.format_string("Target not found, but %d search suggestions available", F.size("_found")))
        .otherwise("Target not found and no search suggestions available")
    )
    results = (
        F.when(F.col("_exact").isNotNull(), F.array("_exact"))
        .when(F.size("_found") > 0, F.slice("_found", 1, shown))
        .otherwise(F.array().cast("array<string>"))
    )
    return both.select(
        F.col("id").alias("collection_target_id"),
        "collection_name",
        "language_code",
        status.alias("test_status"),
        results.alias("search_results_found"),
        message.alias("error_message"),
    )


def resolve_pages(targets: DataFrame, pages: DataFrame, size: int = SEARCH_MAX_RESULTS) -> DataFrame:
    """The page of each target: the exact title, else the first search result, else null."""
    checked = check_targets(targets, pages, size, shown=1).withColumn("resolved_title", F.get("search_results_found", F.lit(0)))
    titles = page_titles(pages).select("language_code", F.col("title").alias("resolved_title"), "page_id")
    how = F.when(F.col("test_status") == "success", "exact").when(F.col("resolved_title").isNotNull(), "search").otherwise("none")
    return checked.join(titles, ["language_code", "resolved_title"], "left").select(
        "collection_target_id", "collection_name", "language_code", how.alias("resolved_by"), "resolved_title", "page_id"
    )


def resolve_aliases(
    titles: DataFrame,
    aliases: DataFrame,
    pages: DataFrame,
    max_retries: int = MAX_RETRIES,
    recursive_limit: int = RECURSIVE_LIMIT,
) -> DataFrame:
    """First option of an ambiguous title that is a page, tried in order and in depth.

    ``aliases`` holds ``language_code, alias, option, position``; ``titles`` holds
    ``language_code, title``. At most ``max_retries`` options of each title are
    tried, and an option that is itself ambiguous is followed ``recursive_limit``
    times. The place in the search order is the list of positions on the way.
    """
    first = first_n_per_key(
        aliases.select("language_code", _folded(F.col("alias")).alias("alias"), "option", "position"),
        ["language_code", "alias"],
        [F.col("position").asc(), F.col("option").asc()],
        max_retries,
    ).select("language_code", "alias", "option", _folded(F.col("option")).alias("target"), F.col("_rank").alias("place"))
    exact = page_titles(pages).select("language_code", F.col("folded").alias("target"), F.col("title").alias("page_title"), "page_id")
    ambiguous = first.select("language_code", F.col("alias").alias("target")).distinct().withColumn("again", F.lit(True))
    options = first.join(ambiguous, ["language_code", "target"], "left").join(exact, ["language_code", "target"], "left")

    # Answers are worked out per alias, so the same title asked often costs once.
    # ``best`` holds each alias' first answer within the depth reached so far.
    def first_answer(found: DataFrame) -> DataFrame:
        return first_per_key(
            found.filter(F.col("page_id").isNotNull()).select("language_code", "alias", "place", "page_title", "page_id"),
            ["language_code", "alias"],
            [F.col("place").asc()],
        ).drop("place")

    direct = options.withColumns(
        {"page_title": F.when(F.col("again").isNull(), F.col("page_title")), "page_id": F.when(F.col("again").isNull(), F.col("page_id"))}
    )
    best = first_answer(direct)
    for _ in range(recursive_limit):
        deeper = best.select(
            "language_code", F.col("alias").alias("target"), F.col("page_title").alias("_title"), F.col("page_id").alias("_id")
        )
        followed = direct.join(deeper, ["language_code", "target"], "left").withColumns(
            {"page_title": F.coalesce("page_title", "_title"), "page_id": F.coalesce("page_id", "_id")}
        )
        best = first_answer(followed)
    asked = titles.select("language_code", "title", _folded(F.col("title")).alias("alias"))
    return asked.join(best, ["language_code", "alias"], "left").select("language_code", "title", "page_title", "page_id")
