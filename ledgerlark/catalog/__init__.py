"""Every registered query with the SQL it is checked against."""

from ledgerlark.catalog import jobs, profile, report, sales, scalars

_FAMILIES = (sales, report, profile, jobs, scalars)


def queries() -> dict:
    return {name: run for family in _FAMILIES for name, run in family.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: text for family in _FAMILIES for name, text in family.ORACLE.items()}
