"""Which hashes occur more than once in a whole table, asked and answered in bulk.

A task sorts the hashes of its rows. What it has twice itself it knows to be repeated; of every
hash it sends one copy, packed by range of the hashed number line, to the part that counts it, so
a hash that a third of all rows hold is sent once per task and no part is larger than others. The
parts send the places of repeated hashes back, packed by range of row keys, where they meet the
texts. A row key stands for a row's id and text; rows with equal keys share results.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import compress_text, decompress_text, mix, pack, unpack
from .rows import arrow_schema, give_back, group_batches, id_type, keyed, map_batches, record_batch, ship_package

# Parts of the number line for each task of a shuffle, so that a part stays small.
PARTS_PER_TASK = 4
# Hashes that a task holds before it sends them.
HELD = 3_000_000
ASK = "part int, asked binary, known binary"
FOUND = "place int, found binary"


def range_bounds(ordered: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of `parts` equal ranges of all 64-bit numbers in sorted ones."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(ordered, edges), [len(ordered)]]).astype(np.int64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.searchsorted(edges, keys, "right")


def found_blob(owners: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> bytes:
    """Runs of places by row key: sorted keys, runs of each, firsts and lengths of the runs."""
    order = np.lexsort((places, owners))
    owners, places, lengths = owners[order], places[order], lengths[order]
    keys, counts = np.unique(owners, return_counts=True)
    return pack(keys, counts, places, lengths)


def found_rows(
    owners: np.ndarray, places: np.ndarray, lengths: np.ndarray, parts: int
) -> Iterator[tuple[int, bytes]]:
    """The runs as one blob for each range of row keys."""
    order = np.argsort(owners, kind="stable")
    owners, places, lengths = owners[order], places[order], lengths[order]
    bounds = range_bounds(owners, parts)
    for part in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[part], bounds[part + 1])
        yield int(part), found_blob(owners[own], places[own], lengths[own])


def runs_of(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, length) of runs of consecutive places, from pairs in order."""
    if not len(place):
        return owner, place, place
    breaks = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(np.append(True, breaks))
    return owner[starts], place[starts], np.diff(np.append(starts, len(place)))


def look_up_runs(blobs: list[bytes], row_keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first, length) of the runs of each row, from any number of blobs."""
    pieces = [unpack(b) for b in blobs]
    if not pieces:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    owners = np.concatenate([np.repeat(p[0], p[1].astype(np.int64)) for p in pieces])
    order = np.argsort(owners, kind="stable")
    owners = owners[order]
    places = np.concatenate([p[2] for p in pieces])[order].astype(np.int64)
    lengths = np.concatenate([p[3] for p in pieces])[order].astype(np.int64)
    low = np.searchsorted(owners, row_keys, "left")
    counts = np.searchsorted(owners, row_keys, "right") - low
    rows = np.repeat(np.arange(len(row_keys)), counts)
    at = np.arange(len(rows)) + np.repeat(low - (np.cumsum(counts) - counts), counts)
    return rows, places[at], lengths[at]


def spread_runs(rows: np.ndarray, firsts: np.ndarray, lengths: np.ndarray):
    """Every place of runs: (row, place)."""
    before = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) + np.repeat(firsts - before, lengths)
    return np.repeat(rows, lengths), at


class Asker:
    """Collects hashes with the places that ask about them, and makes the rows to send."""

    def __init__(self, parts: int, places: int) -> None:
        self.parts, self.places = parts, places
        self.size = 0
        self._hashes: list[np.ndarray] = []
        self._asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(
        self, hashes: np.ndarray, asking: np.ndarray, owners: np.ndarray, places: np.ndarray
    ) -> None:
        """All hashes; indexes of those that ask, with their row keys and places."""
        self._hashes.append(hashes)
        self._asked.append((asking + self.size, owners, places))
        self.size += len(hashes)

    def rows(self) -> Iterator[dict]:
        """The rows to send; the collection starts anew."""
        if not self.size:
            return
        hashes = np.concatenate(self._hashes)
        asking, owners, places = (np.concatenate(a) for a in zip(*self._asked, strict=True))
        ordered = np.sort(hashes)
        new = np.append(True, ordered[1:] != ordered[:-1])
        starts = np.flatnonzero(new)
        distinct, twice = ordered[starts], np.diff(np.append(starts, len(ordered))) > 1
        del ordered
        at = np.searchsorted(distinct, hashes[asking])
        sure = twice[at]
        runs = _ordered_runs(owners[sure], places[sure])
        for part, blob in found_rows(*runs, self.places):
            yield {"part": [part], "asked": [None], "known": [blob]}
        at, owners, places = at[~sure], owners[~sure], places[~sure]
        order = np.argsort(at)
        at, owners, places = at[order], owners[order], places[order]
        bounds = range_bounds(distinct, self.parts)
        inner = np.searchsorted(at, bounds)
        for part in np.flatnonzero(np.diff(bounds)):
            low, high = inner[part], inner[part + 1]
            keys, owner = np.unique(owners[low:high], return_inverse=True)
            blob = pack(
                distinct[bounds[part] : bounds[part + 1]],
                at[low:high] - bounds[part],
                keys,
                owner,
                places[low:high],
            )
            yield {"part": [int(part)], "asked": [blob], "known": [None]}
        self.__init__(self.parts, self.places)


def _ordered_runs(owners: np.ndarray, places: np.ndarray):
    order = np.lexsort((places, owners))
    return runs_of(owners[order], places[order])


def repeated_runs(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places whose hash is in more than one of the blobs."""
    asked = [unpack(b) for b in blobs]
    every = np.sort(np.concatenate([a[0] for a in asked]))
    repeated = every[1:][every[1:] == every[:-1]]
    owners, places = [], []
    for hashes, at, keys, owner, place in asked:
        own = hashes[at.astype(np.int64)]
        spot = np.minimum(np.searchsorted(repeated, own), max(len(repeated) - 1, 0))
        hit = repeated[spot] == own if len(repeated) else np.zeros(len(own), bool)
        owners.append(keys[owner[hit].astype(np.int64)])
        places.append(place[hit].astype(np.int64))
    return _ordered_runs(np.concatenate(owners), np.concatenate(places))


def answers(asked: DataFrame, places: int) -> DataFrame:
    """Runs of repeated places by range of row keys, from the rows of Askers."""
    def job(table: pa.Table) -> Iterator[dict]:
        part = table.column("part")[0].as_py()
        known = [b for b in table.column("known").to_pylist() if b is not None]
        if known:
            yield {"place": [part] * len(known), "found": known}
        blobs = [b for b in table.column("asked").to_pylist() if b is not None]
        if blobs:
            for place, blob in found_rows(*repeated_runs(blobs), places):
                yield {"place": [place], "found": [blob]}

    return group_batches(asked, "part", job, FOUND)


def packed_texts(
    docs: DataFrame, id_column: str, text: str, parts: int, carried: tuple[str, ...] = ()
) -> DataFrame:
    """place, key, doc_id, compressed text, carried columns of every row; place: range of keys."""

    def job(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            yield {
                "place": part_of(mix(keys), parts).astype(np.int32),
                "key": mix(keys).view(np.int64),
                "doc_id": batch.column(1),
                "text": [compress_text(t) for t in texts],
            } | {name: batch.column(name) for name in carried}

    schema = f"place int, key long, doc_id {id_type(docs, id_column)}, text binary"
    schema += "".join(f", {name} {id_type(docs, name)}" for name in carried)
    return map_batches(keyed(docs, id_column, text, carried), job, schema)


def batch_keys(column) -> np.ndarray:
    """Row keys as `packed_texts` has them, from the first column of `keyed`."""
    return mix(column.to_numpy().view(np.uint64))


def text_groups(table: pa.Table, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of packed texts."""
    held, size, first = [], 0, 0
    texts = table.column("text")
    for row in range(len(texts)):
        held.append(decompress_text(texts[row].as_py()))
        size += len(held[-1])
        if size >= limit or row == len(texts) - 1:
            offsets = np.append(0, np.cumsum([len(t) for t in held]))
            yield first, row + 1, np.frombuffer(b"".join(held), np.uint8), offsets
            held, size, first = [], 0, row + 1


def with_found(
    texts: DataFrame, found: DataFrame, job: Callable[[pa.Table, list[bytes]], Iterator[dict]], schema: str
) -> DataFrame:
    """Run a job on the texts of each range of row keys and what was found for it."""
    fields = arrow_schema(schema)
    ship_package(texts.sparkSession)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs = right.column("found").to_pylist()
        made = [record_batch(columns, fields) for columns in job(left, blobs)] if len(left) else []
        give_back()
        return pa.Table.from_batches(made, schema=fields)

    return texts.groupBy("place").cogroup(found.groupBy("place")).applyInArrow(run, schema)
