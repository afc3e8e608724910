"""Names that cannot clash with a table's own columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as it needs to differ
    from all ``taken`` ones (in any case) and from one another."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def set_aside(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with the columns that have one of ``names`` renamed, and the
    columns that give the table back as it was. So an operator can use these
    names and return its input untouched."""
    mine = {n.lower() for n in names}
    clash = [c for c in docs.columns if c.lower() in mine]
    new = dict(zip(clash, fresh([*docs.columns, *names], *clash)))
    return docs.withColumnsRenamed(new), [F.col(f"`{new.get(c, c)}`").alias(c) for c in docs.columns]
