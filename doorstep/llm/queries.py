"""The subpackage's registered queries and their comparison SQL."""

import functools

from . import (
    chunks,
    gru,
    language,
    manifest,
    packing,
    phrases,
    pii,
    pivots,
    quality,
    separators,
    simhash,
    sql,
    tokenfiles,
    toxicity,
)
from .shared import ship

_QUERIES = [
    separators.op1_separators,
    gru.op2_gru,
    language.op3_language,
    packing.op4_packing,
    simhash.op5_simhash,
    quality.op6_quality,
    pivots.op7_pivots,
    tokenfiles.op8_tokens,
    chunks.op9_chunks,
    toxicity.op10_toxicity,
    pii.op11_pii,
    manifest.op12_manifest,
    phrases.op13_phrases,
]

#: The others cannot be written in SQL; tests compare them with brute force instead.
SQL = {
    "op7_pivots": sql.OP7_PIVOTS,
    "op12_manifest": sql.OP12_MANIFEST,
    "op13_phrases": sql.OP13_PHRASES,
}


def _registered(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {query.__name__: _registered(query) for query in _QUERIES}
