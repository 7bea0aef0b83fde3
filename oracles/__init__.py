"""DuckDB statements that state each result independently of the Spark code."""

from oracles import analysis, tables


def statements() -> dict[str, str]:
    return {**tables.QUERIES, **analysis.QUERIES}
