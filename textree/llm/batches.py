"""Helpers for functions over Arrow batches: texts in bounded slices, results as batches, a bounded cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE_CHARS = 2_000_000
CACHE_ENTRIES = 400_000


class BoundedCache(dict):
    """A dictionary that starts anew once it has ``limit`` entries; what it forgets is computed again."""

    def __init__(self, limit: int = CACHE_ENTRIES):
        super().__init__()
        self.limit = limit

    def make_room(self) -> None:
        if len(self) >= self.limit:
            self.clear()


def text_slices(batch: pa.RecordBatch, text: str, chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch; a slice ends once it holds ``chars`` characters. Null counts as empty."""
    column = batch.column(text)
    start, held, size = 0, [], 0
    for row in range(batch.num_rows):
        held.append(column[row].as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield start, held
            start, held, size = row + 1, [], 0
    if held:
        yield start, held


def mapper(
    make: Callable[[], Callable[[list[str]], dict[str, list]]], keep: list[str], text: str, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``make()`` runs once per task and gives a function from texts to result columns.

    Columns in ``keep`` pass through under their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start, texts in text_slices(batch, text):
                columns = {name: batch.column(name).slice(start, len(texts)) for name in keep} | work(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) if isinstance(columns[f.name], list) else columns[f.name].cast(f.type) for f in schema],
                    schema=schema,
                )

    return run
