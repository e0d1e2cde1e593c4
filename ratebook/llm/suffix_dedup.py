"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

A string of `window` bytes is the truncated suffix at its start. Each string picks the position of
the least hash of its short grams as its anchor, so equal strings have equal anchors, at equal
distances; only strings whose anchor gram occurs twice go on. They travel as contexts, the text
around an anchor that its strings cover. Where contexts of one gram meet, batch by batch, a batch
gets a sorted array of its suffixes and is merge-scanned against the arrays of the levels before
it; arrays of equal size merge into one of the next level, so every suffix is merged a logarithmic
number of times. Suffixes are ordered by the hash of their first `window` bytes: only matches of
that length are asked for, and equal ones are neighbours in any order that looks no further.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..operators.storage import stored
from .arrays import (
    SLICE_BYTES,
    compress_text,
    decompress_text,
    mix,
    pack,
    rolling_hashes,
    symbols,
    text_slices,
    unpack,
    whole_windows,
)
from .repeats import (
    FOUND,
    HELD,
    PARTS_PER_TASK,
    Asker,
    batch_keys,
    found_rows,
    look_up_runs,
    packed_texts,
    range_bounds,
    repeated_runs,
    runs_of,
    spread_runs,
    text_groups,
    with_found,
)
from .rows import group_batches, id_type, keyed, map_batches, partitions

WINDOW = 200
GRAM = 40
# A gram that occurs more often than this is hot: its strings travel by their own hashes, so no
# part has to hold all contexts of one gram. Of more than HOT_LIST such grams the most frequent
# are treated so, which bounds the list; a gram past it is in under a HOT_LISTth of all anchors.
HOT = 20_000
HOT_LIST = 100_000
# Suffixes of a batch that enters the index at once.
BATCH = 1_000_000
_ROWS = "part int, asked binary, known binary, contexts binary"


def anchors_of(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Per anchor its gram's key and position, the first and last start of its strings, the owner.

    Anchors have small hashes; a key is mixed anew, so that keys are spread evenly.
    """
    hashes = rolling_hashes(symbols(data), gram)
    starts = whole_windows(offsets, window)
    if not len(starts):
        empty = np.empty(0, np.int64)
        return hashes[:0], empty, empty, empty, empty
    # the upper half of a hash, then the position: the least value has the leftmost least hash
    least = (hashes & np.uint64(0xFFFF_FFFF_0000_0000)) | np.arange(len(hashes), dtype=np.uint64)
    width, span = window - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    picked = (least[starts] & np.uint64(0xFFFF_FFFF)).astype(np.int64)
    owner = np.searchsorted(offsets, starts, "right") - 1
    firsts = np.flatnonzero(np.append(True, (picked[1:] != picked[:-1]) | (owner[1:] != owner[:-1])))
    lasts = np.append(firsts[1:], len(starts)) - 1
    grams = mix(hashes[picked[firsts]] ^ np.uint64(0xA24BAED4963EE407))
    return grams, picked[firsts], starts[firsts], starts[lasts], owner[firsts]


class LogIndex:
    """Sorted arrays of suffixes, each level at least twice as large as the next one."""

    def __init__(self) -> None:
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []
        self._repeated: list[np.ndarray] = []
        self.size = 0

    def add(self, suffixes: np.ndarray) -> None:
        """Scan a batch against all levels, mark repeated suffixes, and put new ones in."""
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        same = ordered[1:] == ordered[:-1]
        marks = np.zeros(len(suffixes), bool)
        marks[order[1:][same]] = True
        marks[order[:-1][same]] = True
        new = np.append(True, ~same)[: len(order)]
        ordered, refs = ordered[new], order[new] + self.size
        self._repeated.append(marks)
        self.size += len(suffixes)
        for keys, places in self._levels:
            spot = np.minimum(np.searchsorted(keys, ordered), len(keys) - 1)
            hit = keys[spot] == ordered
            # the first of equal suffixes stays in the index; the batch's own are marked below
            self._mark(places[spot[hit]])
            self._mark_equal(suffixes, ordered[hit])
            ordered, refs = ordered[~hit], refs[~hit]
        while self._levels and len(self._levels[-1][0]) <= 2 * len(ordered):
            keys, places = self._levels.pop()
            ordered, refs = np.concatenate([keys, ordered]), np.concatenate([places, refs])
            order = np.argsort(ordered, kind="stable")
            ordered, refs = ordered[order], refs[order]
        if len(ordered):
            self._levels.append((ordered, refs))

    def _mark_equal(self, suffixes: np.ndarray, found: np.ndarray) -> None:
        if len(found):
            spot = np.minimum(np.searchsorted(found, suffixes), len(found) - 1)
            self._repeated[-1] |= found[spot] == suffixes

    def _mark(self, refs: np.ndarray) -> None:
        bounds = np.append(0, np.cumsum([len(m) for m in self._repeated]))
        refs = np.sort(refs)
        cuts = np.searchsorted(refs, bounds)
        for i in np.flatnonzero(np.diff(cuts)):
            self._repeated[i][refs[cuts[i] : cuts[i + 1]] - bounds[i]] = True

    def repeated(self) -> np.ndarray:
        """Whether each suffix, in the order of adding, occurs more than once."""
        return np.concatenate(self._repeated) if self._repeated else np.empty(0, bool)


def _context_rows(
    hashes: np.ndarray, keys: np.ndarray, firsts: np.ndarray, numbers: np.ndarray,
    data: np.ndarray, starts: np.ndarray, window: int, parts: int, places: int,
) -> Iterator[dict]:
    """Contexts by range of their anchor's hash: equal ones known, one of each sent."""
    lengths = numbers + window - 1
    texts = [data[a : a + n].tobytes() for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
    first: dict[bytes, int] = {}
    one = np.array([first.setdefault(t, i) for i, t in enumerate(texts)], np.int64)
    copies = np.bincount(one, minlength=len(one))
    sure = copies[one] > 1
    for part, blob in found_rows(keys[sure], firsts[sure], numbers[sure], places):
        yield {"part": [part], "asked": [None], "known": [blob], "contexts": [None]}
    sent = np.unique(one)
    sent = sent[np.argsort(hashes[sent], kind="stable")]
    bounds = range_bounds(hashes[sent], parts)
    for part in np.flatnonzero(np.diff(bounds)):
        own = sent[bounds[part] : bounds[part + 1]]
        own = own[np.argsort(keys[own], kind="stable")]
        head = pack(keys[own], firsts[own], numbers[own], copies[own] > 1)
        blob = len(head).to_bytes(8, "little") + head
        blob += compress_text(b"".join([texts[i] for i in own]))
        yield {"part": [int(part)], "asked": [None], "known": [None], "contexts": [blob]}


def _repeated_strings(blobs: list[bytes], window: int):
    """Runs of string starts that are repeated among the contexts; sent ones without an owner too."""
    index, owners, places = LogIndex(), [], []
    held: list[np.ndarray] = []
    size = 0
    for blob in blobs:
        n = int.from_bytes(blob[:8], "little")
        keys, place, numbers, owned = unpack(blob[8 : 8 + n])
        text = np.frombuffer(decompress_text(blob[8 + n :]), np.uint8)
        numbers = numbers.astype(np.int64)
        ends = np.cumsum(numbers + window - 1)
        starts = whole_windows(np.append(0, ends), window)
        held.append(rolling_hashes(symbols(text), window)[starts])
        size += len(starts)
        context, at = spread_runs(np.arange(len(keys)), place.astype(np.int64), numbers)
        # copies of a context are known where they are, so its own places need no answer
        owners.append(np.where(owned[context] > 0, np.uint64(0), keys[context]))
        places.append(np.where(owned[context] > 0, -1, at))
        if size >= BATCH:
            index.add(np.concatenate(held))
            held, size = [], 0
    if held:
        index.add(np.concatenate(held))
    hit = index.repeated()
    owners, places = np.concatenate(owners)[hit], np.concatenate(places)[hit]
    owners, places = owners[places >= 0], places[places >= 0]
    order = np.lexsort((places, owners))
    return runs_of(owners[order], places[order])


def dedup_strings(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    hot: int = HOT,
    id_column: str = "doc_id",
    text: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept and carried columns of every row.

    `kept`: the bytes that stay. Every byte of a string of `window` bytes that also starts
    elsewhere, in the same row or another, goes, overlapping occurrences included; exact copies
    go whole. `n_spans` counts maximal removed runs. Null and shorter texts lose nothing. Repeated
    rows repeat each other; a null id stays; other columns are left out; an empty table gives
    none. Strings are compared by 64-bit hash. `carried` names further columns to keep.
    """
    places = partitions(docs.sparkSession)
    parts = PARTS_PER_TASK * places

    def probe(batches) -> Iterator[dict]:
        asker, grams = Asker(parts, places), []
        for batch in batches:
            keys = batch_keys(batch.column(0))
            for low, high, data, offsets in text_slices(batch.column(2)):
                found, anchor, _, _, owner = anchors_of(data, offsets, window, gram)
                asker.add(
                    found,
                    np.arange(len(anchor)),
                    keys[low:high][owner],
                    anchor - offsets[owner],
                )
                grams.append(found)
                if asker.size > HELD:
                    yield from with_counts(asker, grams)
                    grams = []
        yield from with_counts(asker, grams)

    def with_counts(asker: Asker, grams: list[np.ndarray]) -> Iterator[dict]:
        """The rows to send, and how often the task has each gram, for the hot ones."""
        for row in asker.rows():
            yield row | {"contexts": [None]}
        keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *grams]), return_counts=True)
        often = counts > 1
        keys, counts = keys[often], counts[often]
        bounds = range_bounds(keys, parts)
        for part in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[part], bounds[part + 1])
            blob = pack(keys[own], counts[own])
            yield {"part": [int(part)], "asked": [None], "known": [None], "contexts": [blob]}

    def find_anchors(table: pa.Table) -> Iterator[dict]:
        """As `answers`; also (place -1) grams that may be hot, with their counts."""
        part = table.column("part")[0].as_py()
        columns = {n: [b for b in table.column(n).to_pylist() if b is not None] for n in names[1:]}
        found = [(part, b) for b in columns["known"]]
        if columns["asked"]:
            found += found_rows(*repeated_runs(columns["asked"]), places)
        counted = [unpack(b) for b in columns["contexts"]]
        if counted:
            grams, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([c for _, c in counted]))
            grams, counts = grams[counts > hot], counts[counts > hot]
            if len(grams):
                found.append((-1, pack(grams, counts.astype(np.int64))))
        yield {"place": [p for p, _ in found], "found": [b for _, b in found]}

    names = [part.split()[0] for part in _ROWS.split(", ")]
    anchors = stored(
        group_batches(
            map_batches(keyed(docs, id_column, text), probe, _ROWS), "part", find_anchors, FOUND
        ),
        "anchors",
    )
    hot_grams = _hottest([row["found"] for row in anchors.where("place = -1").collect()])
    shared = docs.sparkSession.sparkContext.broadcast(hot_grams)

    def extend(table: pa.Table, blobs: list[bytes]) -> Iterator[dict]:
        asker = Asker(parts, places)
        keys = table.column("key").to_numpy().view(np.uint64)
        rows, at = spread_runs(*look_up_runs(blobs, keys))
        chosen = np.unique((rows.astype(np.int64) << 40) | at)
        for low, high, data, offsets in text_groups(table, SLICE_BYTES):
            found, anchor, first, last, owner = anchors_of(data, offsets, window, gram)
            own = ((owner + low) << 40) | (anchor - offsets[owner])
            spot = np.minimum(np.searchsorted(chosen, own), max(len(chosen) - 1, 0))
            on = chosen[spot] == own if len(chosen) else np.zeros(len(own), bool)
            found, first, last, owner = found[on], first[on], last[on], owner[on]
            heat = np.isin(found, shared.value)
            context, starts = spread_runs(
                owner[heat], first[heat], last[heat] - first[heat] + 1
            )
            if len(starts):
                strings = rolling_hashes(symbols(data), window)[starts]
                asker.add(
                    strings, np.arange(len(starts)), keys[low:high][context], starts - offsets[context]
                )
            cold = ~heat
            if cold.any():
                yield from _context_rows(
                    found[cold],
                    keys[low:high][owner[cold]],
                    (first - offsets[owner])[cold],
                    (last - first + 1)[cold],
                    data,
                    first[cold],
                    window,
                    parts,
                    places,
                )
            if asker.size > HELD:
                yield from (row | {"contexts": [None]} for row in asker.rows())
        yield from (row | {"contexts": [None]} for row in asker.rows())

    def compare(table: pa.Table) -> Iterator[dict]:
        part = table.column("part")[0].as_py()
        columns = {n: [b for b in table.column(n).to_pylist() if b is not None] for n in names[1:]}
        found = [(part, b) for b in columns["known"]]
        if columns["asked"]:
            found += found_rows(*repeated_runs(columns["asked"]), places)
        if columns["contexts"]:
            found += found_rows(*_repeated_strings(columns["contexts"], window), places)
        yield {"place": [p for p, _ in found], "found": [b for _, b in found]}

    def remove(table: pa.Table, blobs: list[bytes]) -> Iterator[dict]:
        keys = table.column("key").to_numpy().view(np.uint64)
        rows, firsts, lengths = look_up_runs(blobs, keys)
        for low, high, data, offsets in text_groups(table, SLICE_BYTES):
            own = (rows >= low) & (rows < high)
            edges = np.zeros(len(data) + 1, np.int64)
            begin = offsets[rows[own] - low] + firsts[own]
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + lengths[own] + window - 1, -1)
            gone = np.cumsum(edges[:-1]) > 0
            sums = np.append(0, np.cumsum(gone))
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = offsets[:-1][offsets[:-1] < len(data)]
            begins[inner] = gone[inner]
            spans = np.append(0, np.cumsum(begins))
            stay = np.append(0, np.cumsum(~gone))[offsets]
            raw = data[~gone].tobytes()
            kept = [raw[a:b] for a, b in zip(stay[:-1], stay[1:], strict=True)]
            yield {
                "doc_id": table.column("doc_id").slice(low, high - low).combine_chunks(),
                "n_bytes": np.diff(offsets),
                "n_removed": sums[offsets[1:]] - sums[offsets[:-1]],
                "n_spans": spans[offsets[1:]] - spans[offsets[:-1]],
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
                "kept": kept,
            } | {
                name: table.column(name).slice(low, high - low).combine_chunks() for name in carried
            }

    texts = packed_texts(docs, id_column, text, places, carried)
    contexts = with_found(texts, anchors.where("place >= 0"), extend, _ROWS)
    strings = group_batches(contexts, "part", compare, FOUND)
    return with_found(
        texts,
        strings,
        remove,
        f"doc_id {id_type(docs, id_column)}, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string, kept binary" + "".join(f", {c} {id_type(docs, c)}" for c in carried),
    )


def _hottest(blobs: list[bytes]) -> np.ndarray:
    """At most HOT_LIST grams, those with the largest counts, in order."""
    if not blobs:
        return np.empty(0, np.uint64)
    found = [unpack(b) for b in blobs]
    grams = np.concatenate([g for g, _ in found])
    counts = np.concatenate([c for _, c in found])
    return np.sort(grams[np.argsort(counts, kind="stable")[-HOT_LIST:]])
