"""Text clean-up and file-name routing as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(column: str) -> Column:
    return F.expr(blank_to_null_sql(f"`{column}`"))


def blank_to_null_sql(column: str) -> str:
    return f"nullif(trim({column}), '')"


def fold(text: Column) -> Column:
    """The spelling used to match names: no outer spaces, upper case."""
    return F.upper(F.trim(text))


def drop_path(path: Column) -> Column:
    """Path of a raw drop: a ``.csv`` file, or the ``.csv`` folder its part files lie in.

    Paths arrive URL-encoded from Spark; a literal plus sign is not part of that encoding.
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(plain, "/[^/]*$", "")
    return F.when(F.lower(folder).endswith(".csv"), folder).otherwise(plain)


def source_name(path: Column) -> Column:
    """Base name of a raw drop."""
    return F.substring_index(drop_path(path), "/", -1)


def table_name(file_name: Column) -> Column:
    """Identifier of the table a file belongs to; a name with nothing usable is an error."""
    stem = F.regexp_replace(F.lower(F.trim(file_name)), r"\.csv$", "")
    name = F.btrim(F.regexp_replace(stem, "[^a-z0-9]+", "_"), F.lit("_"))
    refused = F.raise_error(F.concat(F.lit("no table name in file name: "), file_name))
    return (
        F.when(name == "", refused)
        .when(name.rlike("^[0-9]"), F.concat(F.lit("t_"), name))
        .otherwise(name)
    )
