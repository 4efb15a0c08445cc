"""Column expressions shared by the jobs. All but one stay inside the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_STEPS = 1 << 52


def path_part(path: Column | str, from_end: int = 1) -> Column:
    """The ``from_end``-th last element of a slash-separated path (1 is the file name)."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def prefix_label(column: Column | str, prefix: str) -> Column:
    """1.0 where the column starts with ``prefix``, else 0.0; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return column.startswith(prefix).cast("double")


def token_count(tokens: Column | str) -> Column:
    return F.size(tokens)


def token_count_udf(tokens: Column | str) -> Column:
    """The user-defined form of :func:`token_count`, batched by Arrow."""

    def lengths(column: pd.Series) -> pd.Series:
        return column.map(lambda tokens: -1 if tokens is None else len(tokens))

    return F.pandas_udf(lengths, T.IntegerType())(tokens)


def items_of_line(line: Column | str) -> Column:
    """Blank-separated items of one line, outer white space removed."""
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), " ")


def fields_of_line(line: Column | str, schema: str) -> Column:
    """One comma-separated line as a typed struct; a field that does not fit its type is an error.

    Quoted commas stay inside a field and doubled quotes stand for one, as in RFC 4180.
    """
    return F.from_csv(line, schema, {"mode": "FAILFAST", "escape": '"'})


def squared_error(label: Column | str, prediction: Column | str) -> Column:
    label = F.col(label) if isinstance(label, str) else label
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.pow(label - prediction, F.lit(2.0))


def hash_unit(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the key values and the seed alone."""
    hashed = F.xxhash64(F.lit(seed), *[F.col(key) for key in keys])
    return F.pmod(hashed, F.lit(_UNIT_STEPS)) / F.lit(float(_UNIT_STEPS))
