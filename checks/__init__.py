"""Checked queries: the library run over the test tables, next to equivalent SQL."""

from __future__ import annotations


def all_queries():
    from checks import models, operations, stored, streams

    return {**models.QUERIES, **operations.QUERIES, **streams.QUERIES, **stored.QUERIES}


def all_oracles():
    from checks import models, operations, stored, streams

    return {**models.ORACLE, **operations.ORACLE, **streams.ORACLE, **stored.ORACLE}
