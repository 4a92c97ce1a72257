"""A state machine per subject: what today's decision may do depends on the book it changed yesterday."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def fold(rows: DataFrame, key: str, order: list[str], schema: str, start: Callable[[], object], step: Callable[[object, object], tuple[object, tuple | None]]) -> DataFrame:
    """Fold ``step(state, row) -> (state, output row or None)`` over each key's rows in order.

    Rows are sorted by Spark and streamed, so a subject's history is never held as a whole.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = object(), None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if getattr(row, key) != at:
                    at, state = getattr(row, key), start()
                state, made = step(state, row)
                if made is not None:
                    out.append(made)
            yield pd.DataFrame(out, columns=names)

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)


class Book:
    """A position: quantity, mean entry, number of additions."""

    def __init__(self) -> None:
        self.quantity = self.cost = 0.0
        self.adds = 0


def trade(book: Book, price: float, size: float, stop: float, target: float, most: int) -> tuple[Book, str]:
    """One day: exits (stop before target) come first, then an entry, or an addition on the loss side."""
    if book.quantity:
        change = price / (book.cost / book.quantity) - 1
        if change <= -stop or change >= target:
            return Book(), "stop" if change <= -stop else "target"
        if change < 0 and book.adds < most:
            book.quantity, book.cost, book.adds = book.quantity + size, book.cost + size * price, book.adds + 1
            return book, "add"
        return book, "hold"
    book.quantity, book.cost = size, size * price
    return book, "enter"
