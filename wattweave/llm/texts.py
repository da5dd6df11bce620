"""Results computed per text in Arrow batches, joined to the rows they belong to."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Run = Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]


def column(run: Run, schema: str, *inputs: Column) -> Column:
    """A struct column made by ``run``; it is evaluated once, wherever it is used."""

    def typed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from run(batches)

    return F.pandas_udf(typed, schema).asNondeterministic()(*inputs)


def per_text(docs: DataFrame, id_col: str, text_col: str, run: Run, schema: str) -> DataFrame:
    """The id of every row with the columns that ``run`` makes of its text.

    Only the text goes to Python; ids of any type, nulls included, stay as they are.
    """
    found = docs.select(docs[id_col], column(run, schema, docs[text_col]).alias("__result"))
    return found.select(id_col, "__result.*")


def free_name(taken: list[str], wanted: str) -> str:
    """The wanted column name, lengthened until no column has it."""
    while wanted.lower() in (name.lower() for name in taken):
        wanted += "_"
    return wanted
