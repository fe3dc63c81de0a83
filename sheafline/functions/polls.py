"""Poll fields: names, dates, percentages, numbers, quality and outliers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import CANDIDATE_ALIASES, COLLECTION_TYPES, ELECTION_DAYS
from .text import collapse_whitespace, strip

_ISO = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_US = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


def state_name(c: Column) -> Column:
    """Strip, then spaces become ``_``; null gives ``''``."""
    return F.coalesce(F.translate(strip(c), " ", "_"), F.lit(""))


def candidate_name(c: Column, aliases: dict[str, str] = CANDIDATE_ALIASES) -> Column:
    """Strip, collapse white space, apply aliases; null gives ``''``."""
    known: dict[str, str] = {}
    for alias, real in aliases.items():
        # An alias of what an earlier one gave follows it.
        known = {k: real if v == alias else v for k, v in known.items()} | {alias: real}
    name = F.array(collapse_whitespace(strip(c)))
    if known:
        pairs = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        # A function over a list of one, so that the name is worked out once.
        name = F.transform(name, lambda n: F.coalesce(F.try_element_at(pairs, n), n))
    return F.coalesce(F.get(name, F.lit(0)), F.lit(""))


def iso_date_text(c: Column) -> Column:
    """``Y-M-D`` (time after ``T`` cut off) as is, ``M/D/Y`` as padded ISO, else null.

    A chain of replacements, so that no step is worked out twice: month-first
    dates are turned round with a mark and a zero before month and day, then
    mark and surplus zero go; what is no ISO date at the end is dropped.
    """
    day = F.split_part(strip(c.cast("string")), F.lit("T"), F.lit(1))
    turned = F.regexp_replace(day, _US, "$3\x010$1\x010$2")
    padded = F.regexp_replace(turned, "\x010?([0-9]{2})", "-$1")
    return F.nullif(F.regexp_extract(padded, _ISO, 0), F.lit(""))


def as_date(c: Column) -> Column:
    """Date text → date, null when it names no real day."""
    return F.try_to_date(c, "yyyy-M-d")


def days_between(start: Column, end: Column) -> Column:
    """Days from one ISO date text to another, null unless both are padded real days."""
    padded = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    first = F.when(start.rlike(padded), as_date(start))
    last = F.when(end.rlike(padded), as_date(end))
    return F.datediff(last, first).cast("bigint")


def lenient_float(c: Column) -> Column:
    """Number or numeric text → double, else null. NaN is null too."""
    return F.nullif(c.try_cast("double"), F.lit(float("nan")))


def lenient_int(c: Column) -> Column:
    """Number or numeric text → whole number, cut towards zero, else null."""
    return lenient_float(c).try_cast("bigint")


def within_percent(value: Column) -> Column:
    """A number held within 0-100 and rounded to 6 places."""
    held = F.when(value < 0, F.lit(0.0)).when(value > 100, F.lit(100.0)).otherwise(value)
    return F.round(held, 6)


def percentage(c: Column) -> Column:
    """Lenient float held within 0-100 and rounded to 6 places."""
    return within_percent(lenient_float(c))


def quality_score(
    cycle: Column, state: Column, candidate: Column, model_date: Column, percentages: list[Column]
) -> Column:
    """Share of the fields a model needs: three names, any date, any percentage."""
    # Weight of a required field, of a date and of a percentage.
    required, dated, measured = 1.0, 0.7, 0.8

    def part(present: Column, weight: float) -> Column:
        return F.when(present, F.lit(weight)).otherwise(F.lit(0.0))

    any_pct = percentages[0].isNotNull()
    for column in percentages[1:]:
        any_pct = any_pct | column.isNotNull()
    score = (
        part(cycle.isNotNull() & (cycle != 0), required)
        + part(state.isNotNull() & (state != ""), required)
        + part(candidate.isNotNull() & (candidate != ""), required)
        + part(model_date.isNotNull(), dated)
        + part(any_pct, measured)
    )
    return F.least(score / F.lit(3 * required + dated + measured), F.lit(1.0))


def is_outlier(percentages: list[Column], cycle: Column, current_year: int, days_before: Column | None = None) -> Column:
    """Any percentage below 1 or above 90, an impossible cycle, or an impossible distance."""
    # First cycle, years ahead, and the longest distance in days.
    first_cycle, years_ahead, longest = 1968, 4, 1460
    tests = [F.exists(F.array(*percentages), lambda p: (p < 1.0) | (p > 90.0))]
    tests.append((cycle < first_cycle) | (cycle > current_year + years_ahead))
    if days_before is not None:
        tests.append((days_before < 0) | (days_before > longest))
    flag = F.lit(False)
    for test in tests:
        flag = flag | F.coalesce(test, F.lit(False))
    return flag


def dataset_type(cycle: Column) -> Column:
    """Older or newer file, by cycle; null and 0 count as newer."""
    newer, older = COLLECTION_TYPES
    return F.when(cycle.isNotNull() & (cycle != 0) & (cycle <= 2016), F.lit(older)).otherwise(F.lit(newer))


def election_day(cycle: Column) -> Column:
    """Election day text of the cycles whose file leaves it out, else null."""
    day = F.lit(None).cast("string")
    for year, text in ELECTION_DAYS.items():
        day = F.when(lenient_int(cycle) == year, F.lit(text)).otherwise(day)
    return day


def time_weight(days: Column, decay: float) -> Column:
    """Weight of a poll that is ``days`` old."""
    return F.exp(F.lit(-decay) * days / F.lit(30))


def version_at_least(version: str, wanted: str) -> bool:
    """Numeric comparison of dotted versions."""

    def parts(text: str) -> list[int]:
        numbers = [int(p) for p in text.split(".")]
        return numbers + [0] * (3 - len(numbers))

    return parts(version) >= parts(wanted)
