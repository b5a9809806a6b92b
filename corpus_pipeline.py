"""A training corpus from raw documents: four stages, each over all the last one kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.
"""

import logging

from doorstep.llm import language, packing, similar, toxicity
from doorstep.llm.shared import fresh, ship, small_batches, stored
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


def _prepare(spark):
    ship(spark)
    small_batches(spark)


def drop_toxic(spark, docs, sf_dir):
    """Score every document with a machine learned from the labelled ones; toxic ones go.

    Labels that no term goes with, none at all for instance, reject nothing.
    """
    _prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.fit(docs, labels)
    if not len(machine.terms):  # the labels tell no text from another
        logger.warning("no labels to learn toxicity from: all documents stay")
        return docs
    (column,) = fresh(docs.columns, "toxicity")
    scored = toxicity.score(docs, machine, column)
    return scored.where(F.col(column) < toxicity.THRESHOLD).drop(column)


def keep_languages(spark, docs, sf_dir):
    """Keep the documents whose text is in a known language, set ``lang`` to it."""
    _prepare(spark)
    prefix = "language_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    found = language.identify(docs, language.fit(docs), prefix)
    named = F.col(f"{prefix}lang_pred")
    return found.where(named != "und").select(
        [named.alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns]
    )


def drop_near_duplicates(spark, docs, sf_dir):
    """Keep one row of each group of near copies: that of the smallest id.

    Near copies share 0.8 or more of their shingles of five words.  Rows are judged by
    their texts, so different texts under one id, or under none, all stay.
    """
    _prepare(spark)
    return similar.distinct_documents(docs)


def pack(spark, docs, sf_dir):
    """Pack all that is left into sequences."""
    _prepare(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: The learned stages cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
