"""Repeated address keys: report, remove when harmless, refuse when not."""

import logging

from pyspark.sql import functions as F

from ..functions.text import first_letter
from ..sources.stage import materialise
from .skew import salted_join

logger = logging.getLogger(__name__)


class IdenticalDuplicates(Exception):
    """Rows repeat, but only as exact copies."""


class ConflictingDuplicates(Exception):
    """One key has rows that differ."""


def key_counts(df, key="uprn", by=()):
    """Occurrences of each key; a null key is a key here."""
    return df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df, key="uprn"):
    return key_counts(df, key).where(F.col("n_rows") > 1)


def has_unique_keys(df, key="uprn"):
    return duplicate_keys(df, key).isEmpty()


def _of_keys(df, keys, key, how):
    """The rows of ``df`` whose key is among ``keys`` (left_semi) or not (left_anti)."""
    chosen = keys.select(
        F.coalesce(key, F.lit("")).alias("_dup"), F.col(key).isNull().alias("_dup_null")
    )
    marked = df.withColumns(
        {"_key": F.coalesce(key, F.lit("")), "_key_null": F.col(key).isNull()}
    )
    kept = salted_join(marked, chosen, [("_key", "_dup"), ("_key_null", "_dup_null")], how=how)
    return kept.select(*df.columns)


def duplicated_rows(df, key="uprn"):
    """Every row whose key occurs more than once, ordered by key."""
    return _of_keys(df, duplicate_keys(df, key), key, "left_semi").orderBy(key)


def _message(count, letter):
    # Fixed wording, read by people and tests.
    if count == 1:
        return f"1 UPRN has duplicated rows for first_letter={letter}"
    return f"{count} UPRNs have duplicate rows for first_letter={letter}"


def _report(error):
    logger.error("%s", error)


def resolve_duplicates(df, key="uprn", letter=None, on_identical=_report):
    """``df`` without repeated rows, or ``ConflictingDuplicates``.

    Without repeated keys ``df`` comes back as it is, after one narrow count.  Otherwise
    only the rows of repeated keys are compared, as whole rows, and the result is stored,
    so that its readers do not repeat that.  The rule is applied per first letter: exact
    copies are dropped and reported once for the letter, and any key whose rows differ
    refuses the whole input.  ``letter`` is the column to group by, by default the first
    letter of the postcode; a row per letter with repeats reaches the driver.
    """
    if letter is None:
        letter = (
            F.col("first_letter")
            if "first_letter" in df.columns
            else first_letter(F.col("postcode"))
        )
    repeats = materialise(
        key_counts(df.select(key, letter.alias("_letter")), key, ["_letter"]).where(F.col("n_rows") > 1),
        "repeats",
    )

    def per_letter(keys):
        counted = keys.groupBy("_letter").agg(F.count(F.lit(1)).alias("n"))
        return {row["_letter"]: row["n"] for row in counted.collect()}

    found = per_letter(repeats)
    if not found:
        return df

    keys = repeats.select(key).distinct()
    variants = materialise(_of_keys(df, keys, key, "left_semi").distinct(), "variants")
    lettered = variants.select(key, letter.alias("_letter"))
    conflicts = per_letter(key_counts(lettered, key, ["_letter"]).where(F.col("n_rows") > 1))
    differing = sorted(conflicts, key=lambda v: (v is None, v))
    if differing:
        raise ConflictingDuplicates(
            "; ".join(_message(found[v], v) for v in differing)
            + ": the rows of a repeated UPRN differ, so the data must be looked into."
        )
    for value in sorted(found, key=lambda v: (v is None, v)):
        on_identical(
            IdenticalDuplicates(
                _message(found[value], value)
                + ": all copies are identical and were reduced to one."
            )
        )
    return materialise(_of_keys(df, keys, key, "left_anti").unionByName(variants), "resolved")
