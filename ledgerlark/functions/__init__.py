from ledgerlark.functions.columns import (
    MONEY,
    exact_sum,
    growth_rate,
    half_even,
    is_one_of,
    not_one_of,
    percent_of,
    plain_number,
    title_case,
    year_month,
)

__all__ = [
    "MONEY",
    "exact_sum",
    "growth_rate",
    "half_even",
    "is_one_of",
    "not_one_of",
    "percent_of",
    "plain_number",
    "title_case",
    "year_month",
]
