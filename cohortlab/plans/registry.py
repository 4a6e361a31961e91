"""All registered queries and their DuckDB twins."""

from . import experiment_queries, persona_queries, regress_queries, series_queries, text_queries

MODULES = [series_queries, persona_queries, text_queries, experiment_queries, regress_queries]


def all_queries():
    out = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles():
    out = {}
    for m in MODULES:
        out.update(m.ORACLE)
    return out
