"""Dates written in several forms within one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted forms, most trusted first.
#   2024-5-8     year-month-day
#   7-May-24     day-month name-short year
#   5/13/24      month/day/short year
#   13/05/2024   day/month/year
#   05/13/2024   month/day/year
WHITESPACE = "[ \t\n\r\f\x0b]*"
YEAR_FIRST = f"^{WHITESPACE}[0-9]{{1,4}}-[0-9]{{1,2}}-[0-9]{{1,2}}{WHITESPACE}$"
MONTH_NAME = f"^{WHITESPACE}[0-9]{{1,2}}-[A-Za-z]{{3}}-[0-9]{{1,2}}{WHITESPACE}$"
SHORT_YEAR = f"^{WHITESPACE}[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{1,2}}{WHITESPACE}$"
LONG_YEAR = f"^{WHITESPACE}[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{3,4}}{WHITESPACE}$"
SLASHED = f"^{WHITESPACE}([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{1,4}}){WHITESPACE}$"

MONTHS = "jan,feb,mar,apr,may,jun,jul,aug,sep,oct,nov,dec"
FIRST_SHORT_YEAR = 1969  # two digits name a year from here on


def parse_date(column: str) -> Column:
    """First form that gives a real day, else null."""
    return F.expr(date_sql(f"`{column}`"))


def date_sql(column: str) -> str:
    """The same as SQL text.

    A shape test picks the form, and the numbers are put in ISO order for a lenient cast, which
    returns null on a bad day. Trying date patterns one after another would raise an exception
    per row and per failed pattern inside the executor. Numbers are put in order by one pattern per
    try: the JVM leaves methods of more than 8,000 bytes interpreted, and a table has several dates.
    """
    # The leading zeros keep short years literal.
    day_first, month_first = (_ordered(column, f"000$3-{order}") for order in ("$2-$1", "$1-$2"))
    # A month name that is none gives month 0, which no calendar has.
    name = f"substring_index(substring_index({column}, '-', 2), '-', -1)"
    named = f"find_in_set(lower({name}), '{MONTHS}'), '-', cast({_part(column, '-', 1)} as int)"
    return f"""case
        when {column} rlike '{YEAR_FIRST}'
            then try_cast(regexp_replace({column}, '^{WHITESPACE}', '000') as date)
        when {column} rlike '{MONTH_NAME}'
            then try_cast(concat({_short_year(column, '-')}, '-', {named}) as date)
        when {column} rlike '{SLASHED}' then coalesce(
            if({column} rlike '{SHORT_YEAR}',
               try_cast(concat({_short_year(column, '/')}, {_ordered(column, '-$1-$2')}) as date),
               null),
            try_cast({day_first} as date),
            if({column} rlike '{LONG_YEAR}', try_cast({month_first} as date), null))
        end"""


def _part(column: str, mark: str, at: int) -> str:
    return f"substring_index({column}, '{mark}', {at})"


def _short_year(column: str, mark: str) -> str:
    year = f"cast({_part(column, mark, -1)} as int)"
    return f"({FIRST_SHORT_YEAR} + pmod({year} - {FIRST_SHORT_YEAR}, 100))"


def _ordered(column: str, order: str) -> str:
    """The three numbers of a slashed date in another order, without outer spaces."""
    return f"regexp_replace({column}, '{SLASHED}', '{order}')"
