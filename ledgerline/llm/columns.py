"""Names of columns that an operator must keep out of the way of."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_place(docs: DataFrame, *own: str) -> DataFrame:
    """The table with all columns but ``own`` named by their places: what other names hold (dots, backquotes, the names of
    ``own`` in other letters) does no harm, until ``toDF`` gives the old names back."""
    free, taken = unused(docs, "__at"), set()
    names = []
    for i, name in enumerate(docs.columns):
        names.append(name if name in own and name not in taken else f"{free}{i}")
        taken.add(name)
    return docs.toDF(*names)
