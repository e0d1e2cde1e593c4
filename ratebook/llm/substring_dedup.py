"""Removal of repeated word windows, found with fixed-block anchors.

Non-overlapping blocks of each text are the index; every rolling window of a block's length, of
every text, probes it. A repeated window of at least two blocks' length less one holds an aligned
block whose hash then occurs twice. Only around such blocks are whole windows hashed and asked
about; neighbouring repeated windows join to maximal repeats.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import (
    SLICE_BYTES,
    covered,
    owners_of,
    rolling_hashes,
    span_hashes,
    split_words,
    symbols,
    text_slices,
    whole_windows,
)
from .repeats import (
    ASK,
    HELD,
    PARTS_PER_TASK,
    Asker,
    answers,
    batch_keys,
    look_up_runs,
    packed_texts,
    spread_runs,
    text_groups,
    with_found,
)
from .rows import id_type, keyed, map_batches, partitions

WINDOW = 35
# Probes send this many upper bits of a hash: a filter, so chance hits only cost time.
_PROBE_BITS = np.uint64(0xFFFF_FFFF_FFFF_0000)


def _word_hashes(data, offsets):
    starts, ends, bounds = split_words(data, offsets)
    return span_hashes(symbols(data), starts, ends), starts, ends, bounds


def dedup_windows(
    docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept of every row.

    `kept`: the text of the words that stay, joined by one space. Every word of a window of
    `window` words whose sequence also starts elsewhere, in the same row or another, goes; so
    exact copies go whole. Rows of fewer words lose none; null and empty texts have none. Repeated
    rows repeat each other; a null id stays; other columns are left out; an empty table gives
    none. Windows are compared by 64-bit hash.
    """
    places = partitions(docs.sparkSession)
    parts = PARTS_PER_TASK * places
    block = (window + 1) // 2

    def probe(batches) -> Iterator[dict]:
        asker = Asker(parts, places)
        for batch in batches:
            keys = batch_keys(batch.column(0))
            for low, high, data, offsets in text_slices(batch.column(2)):
                words, _, _, bounds = _word_hashes(data, offsets)
                hashes = rolling_hashes(words, block) & _PROBE_BITS
                n = np.diff(bounds)
                owner = owners_of(bounds)
                windows = whole_windows(bounds, block)
                windows = windows[n[owner[windows]] >= window]
                place = windows - bounds[owner[windows]]
                anchors = np.flatnonzero(place % block == 0)
                asker.add(
                    hashes[windows],
                    anchors,
                    keys[low:high][owner[windows[anchors]]],
                    place[anchors],
                )
                if asker.size > HELD:
                    yield from asker.rows()
        yield from asker.rows()

    def extend(table: pa.Table, blobs: list[bytes]) -> Iterator[dict]:
        asker = Asker(parts, places)
        keys = table.column("key").to_numpy().view(np.uint64)
        rows, found = spread_runs(*look_up_runs(blobs, keys))
        for low, high, data, offsets in text_groups(table, SLICE_BYTES):
            words, _, _, bounds = _word_hashes(data, offsets)
            own = (rows >= low) & (rows < high)
            anchor = bounds[rows[own] - low] + found[own]
            near = np.zeros(len(words) + 1, np.int64)
            first = np.maximum(anchor - block + 1, bounds[rows[own] - low])
            np.add.at(near, first, 1)
            np.add.at(near, anchor + 1, -1)
            near = np.cumsum(near[:-1]) > 0
            owner = owners_of(bounds)
            windows = whole_windows(bounds, window)
            windows = windows[near[windows]]
            asker.add(
                rolling_hashes(words, window)[windows],
                np.arange(len(windows)),
                keys[low:high][owner[windows]],
                windows - bounds[owner[windows]],
            )
            if asker.size > HELD:
                yield from asker.rows()
        yield from asker.rows()

    def remove(table: pa.Table, blobs: list[bytes]) -> Iterator[dict]:
        keys = table.column("key").to_numpy().view(np.uint64)
        rows, found = spread_runs(*look_up_runs(blobs, keys))
        for low, high, data, offsets in text_groups(table, SLICE_BYTES):
            starts, ends, bounds = split_words(data, offsets)
            own = (rows >= low) & (rows < high)
            gone = covered(bounds[rows[own] - low] + found[own], window, len(starts))
            raw, kept = data.tobytes(), []
            for i in range(high - low):
                stay = np.flatnonzero(~gone[bounds[i] : bounds[i + 1]]) + bounds[i]
                if len(stay) == bounds[i + 1] - bounds[i]:
                    kept.append(b" ".join(raw[offsets[i] : offsets[i + 1]].split()))
                else:
                    spans = zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)
                    kept.append(b" ".join([raw[a:b] for a, b in spans]))
            sums = np.append(0, np.cumsum(gone))
            yield {
                "doc_id": table.column("doc_id").slice(low, high - low).combine_chunks(),
                "n_words": np.diff(bounds),
                "n_removed": sums[bounds[1:]] - sums[bounds[:-1]],
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
                "kept": [k.decode() for k in kept],
            }

    texts = packed_texts(docs, id_column, text, places)
    anchors = answers(map_batches(keyed(docs, id_column, text), probe, ASK), places)
    windows = answers(with_found(texts, anchors, extend, ASK), places)
    return with_found(
        texts,
        windows,
        remove,
        f"doc_id {id_type(docs, id_column)}, n_words long, n_removed long, kept_sha256 string, "
        "kept string",
    )
