"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check.

A window is as many consecutive words of a document as a benchmark item has. The
window that resembles an item most can be taken to start with a shingle of the
benchmark (moving it there loses no shared shingle), so only windows that start
with one, or are the last of their document, get a fingerprint. The fingerprints
of all items stand in an index: each is cut into blocks, and as two fingerprints
within the radius agree in a block up to one bit, each block is listed with all
its one-bit neighbours. A window looks up its blocks among items of its size; pairs
within the radius are then compared exactly, by weighted shingles: the Jaccard
similarity of the shingle counts.

Items that say something twice, or are short, have fingerprints that stray: a shingle
that stands five times has five votes. For these items the fingerprint does not decide.
They also stand in an exact lookup by their rarest shingles: of so many occurrences
that one must be in any window as similar as asked (prefix filter, by weight), and
windows of too few shingles are left out (length filter).

Only built-in functions are used. The benchmark's shingles are first looked up in
a bitmap of fixed size, so that a row is made for few places of a document only; a
table of all shingles is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, may_hold

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers.
THRESHOLD = (8, 10)
BITS = 64
#: Two texts at the threshold differ in 10 of 64 bits on average; 19 is over three standard deviations more.
RADIUS = 19
#: More than half the radius, so that one block differs in one bit at most.
BLOCKS = 10
#: Items of up to so many shingles are looked up exactly too.
SHORT = 8
#: Bits of the bitmap of benchmark shingles (2 MB).
FILTER_BITS = 1 << 24
SEPARATORS = r"[^\p{L}\p{N}]+"


def word_numbers(text: Column) -> Column:
    """The lower-cased words (letters and digits) of a text as numbers."""
    words = F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: str, length: int = SHINGLE) -> Column:
    """A number for each run of ``length`` words, in order; empty for shorter texts."""
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - length, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(length)]),
    )
    return F.when(F.size(words) >= length, each).otherwise(F.array().cast("array<bigint>"))


def fingerprint(grams: str) -> Column:
    """SimHash: bit j is set if more shingles have it than not (each counted as often as it stands)."""

    def bit(j: Column) -> Column:
        votes = F.aggregate(
            grams, F.lit(0), lambda n, g: n + (F.call_function("shiftright", g, j).bitwiseAND(F.lit(1)) * 2 - 1).cast("int")
        )
        return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), j)).otherwise(F.lit(0).cast("bigint"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.coalesce(F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b)), F.lit(0).cast("bigint"))


def _block_ranges() -> list[tuple[int, int]]:
    """(first bit, bits) of each block, as even as can be."""
    cut = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cut[:-1], cut[1:])]


def block_values(print_: Column) -> Column:
    """(block, value) of each block of a fingerprint."""
    return F.array(
        *[
            F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << n) - 1)).alias("value"))
            for k, (a, n) in enumerate(_block_ranges())
        ]
    )


def near_block_values(print_: Column) -> Column:
    """(block, value) of each block and of all its one-bit neighbours."""
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << n) - 1)).bitwiseXOR(F.lit(flip).cast("bigint")).alias("value"),
            )
            for k, (a, n) in enumerate(_block_ranges())
            for flip in [0, *(1 << j for j in range(n))]
        ]
    )


def items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size in words, item_grams, item_print); items of fewer words than a shingle have no row."""
    words = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), word_numbers(F.col(text_col)).alias("words"))
    grams = words.filter(F.size("words") >= SHINGLE).select("item_id", F.size("words").alias("size"), shingles("words").alias("item_grams"))
    return grams.withColumn("item_print", fingerprint("item_grams"))


def _similarity(a: str, b: str) -> tuple[Column, Column]:
    """Shared and total weight of two lists of shingles, where a shingle weighs as often as it stands."""
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda x, g: F.size(F.filter(x, lambda y: y == g))
    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, g: n + F.least(count(F.col(a), g), count(F.col(b), g))
    )
    both = F.when(once, F.size(F.array_intersect(a, b))).otherwise(counted)
    return both, F.size(a) + F.size(b) - both


def exact_index(targets: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(item_id, size, item_grams, gram) of the items a fingerprint may miss, by their rarest shingles.

    The shingles of an item, each as often as it stands, are put in order of the number
    of items that have them. A window as similar as asked holds all but a few of these
    occurrences, so it holds one of the first few and one.
    """
    num, den = threshold
    stray = (F.size(F.array_distinct("item_grams")) < F.size("item_grams")) | (F.size("item_grams") <= SHORT)
    each = targets.select("item_id", "size", "item_grams", stray.alias("stray"), F.explode("item_grams").alias("gram"))
    weights = each.groupBy("item_id", "gram").agg(F.count("*").alias("weight"), F.first("size").alias("size"), F.first("stray").alias("stray"))
    spread = weights.groupBy("gram").agg(F.count("*").alias("items"))
    line = F.array_sort(F.collect_list(F.struct("items", "gram", "weight")))
    lines = weights.join(spread, "gram").filter("stray").groupBy("item_id").agg(line.alias("line"))
    lines = lines.join(targets.select("item_id", "size", "item_grams"), "item_id")
    # Occurrences that may be missing: the window must share num / den of the item at least.
    missing = F.size("item_grams") - F.ceil(F.size("item_grams") * num / den)
    ahead = lambda i: F.aggregate(F.slice("line", 1, i), F.lit(0).cast("bigint"), lambda n, x: n + x["weight"])
    first = F.filter("line", lambda x, i: ahead(i) <= missing)
    return lines.select("item_id", "size", "item_grams", F.explode(first["gram"]).alias("gram"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: tuple[int, int] = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item it holds: doc_id, text_key, item_id, start, similarity.

    A document holds an item if a window of the item's size (or the whole text, if
    shorter) has a similarity of ``threshold`` or more; ``start`` is the first word
    of the best such window, among equal ones the earliest that begins with a
    shingle of the benchmark. Case and punctuation do
    not count. Null or empty texts and items of fewer than five words match
    nothing; rows without an id give pairs with a null id; a row that repeats
    another gives no further pair; ``text_key`` (a hash of the text) tells rows
    apart that repeat an id; empty tables give no pairs.
    """
    num, den = threshold
    targets = items(benchmark, item_id_col, item_text_col)
    starts = targets.select(F.explode("item_grams").alias("gram"), "size").distinct()
    longest = targets.agg(F.coalesce(F.max("size"), F.lit(0))).scalar()

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), word_numbers(text).alias("words"))
    rows = rows.select("doc_id", "text_key", F.size("words").alias("n"), shingles("words").alias("grams"))
    # The outer form only keeps Spark from computing all shingles once more to skip short texts.
    placed = rows.select("doc_id", "text_key", "n", "grams", F.posexplode_outer("grams").alias("at", "gram"))
    known = may_hold(bitmap(starts.select("gram").distinct(), "gram", FILTER_BITS), F.col("gram"), FILTER_BITS)
    # What any window from here needs: the shingles of the longest item from this place, or the last ones.
    from_ = F.greatest(F.lit(0), F.least(F.col("at"), F.col("n") - longest))
    placed = placed.filter(known).select("doc_id", "text_key", "n", "at", "gram", from_.alias("from"), F.slice("grams", from_ + 1, longest).alias("near"))
    windows = placed.join(starts, "gram")
    start = F.greatest(F.lit(0), F.least(F.col("at"), F.col("n") - F.col("size")))
    long = F.least(F.col("size"), F.col("n")) - (SHINGLE - 1)
    windows = windows.select(
        "doc_id", "text_key", "size", start.alias("start"), F.slice("near", start - F.col("from") + 1, long).alias("window_grams")
    ).distinct()
    windows = windows.withColumn("window_print", fingerprint("window_grams"))

    index = targets.select("item_id", "size", "item_print", "item_grams", F.inline(near_block_values(F.col("item_print"))))
    looked_up = windows.select("*", F.inline(block_values(F.col("window_print"))))
    near = F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    pairs = looked_up.join(index, ["size", "block", "value"]).filter(near)
    columns = ["doc_id", "text_key", "item_id", "start", "window_grams", "item_grams"]
    stray = exact_index(targets, threshold)
    held = windows.join(stray.select("size").distinct(), "size", "left_semi")
    held = held.select("doc_id", "text_key", "size", "start", "window_grams", F.explode(F.array_distinct("window_grams")).alias("gram"))
    held = held.join(stray, ["size", "gram"]).filter(F.size("window_grams") * den >= F.size("item_grams") * num)
    pairs = pairs.select(columns).unionByName(held.select(columns).distinct())
    both, total = _similarity("window_grams", "item_grams")
    judged = pairs.select("doc_id", "text_key", "item_id", "start", both.alias("both"), total.alias("total"))
    judged = judged.filter(F.col("both") * den >= F.col("total") * num)
    best = F.max(F.struct((F.col("both") / F.col("total")).alias("similarity"), (-F.col("start")).alias("back")))
    found = judged.groupBy("doc_id", "text_key", "item_id").agg(best.alias("best"))
    return found.select(
        "doc_id", "text_key", "item_id", (-F.col("best.back")).cast("bigint").alias("start"), F.col("best.similarity").alias("similarity")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item.

    Null or empty texts hold none and stay; a null id stays null; of rows that repeat
    an id each is judged by its own text; empty tables change nothing.
    """
    found = leaks(docs, benchmark, id_col=id_col, text_col=text_col).select(
        F.col("doc_id").alias("_leaked_id"), F.col("text_key").alias("_leaked_key")
    )
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("_leaked_id")) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_leaked_key")
    )
    return docs.join(found, same, "left_anti")
