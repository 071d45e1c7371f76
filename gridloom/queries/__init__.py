"""Registered queries over the given tables, each with its SQL counterpart."""

from gridloom.queries import arrays, files, layouts, stores

MODULES = (arrays, layouts, stores, files)


def queries() -> dict:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {
        name: sql
        for module in MODULES
        for name, (_, sql) in module.QUERIES.items()
        if sql is not None
    }
