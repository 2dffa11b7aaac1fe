"""Tiny registration helper shared by the query modules."""

from __future__ import annotations


def make_registry():
    table: dict = {}

    def q(name, sql=None):
        def deco(fn):
            table[name] = (fn, sql)
            return fn
        return deco

    return table, q
