"""Best-fit packing with a linear grouping scheme.

Only the number of pieces of each length decides how lengths go together, so the plan is made
from a histogram of at most `capacity` entries, whatever the input's size: long lengths are
sorted and cut into groups of equal cardinality, each rounded up to its longest; sequences of
rounded lengths (configurations) are optimised by a linear program with generated columns;
actual lengths take the places of rounded ones; short lengths and what the rounded-down program
left over go best-fit into the space that remains. Pieces then find their place by length and
rank, in parallel.
"""

import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import text_slices
from .pieces import LONGEST, NO_CUT, REMEMBERED, piece_starts, text_pieces
from .rows import id_type, map_batches

# Groups of long lengths. A length is long beyond capacity / LONG: two of them fit a sequence, so
# there are configurations to optimise.
GROUPS = 128
LONG = 3
# Pieces that are given to the tokenizer as one text.
JOINED = 2000


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """How often to take each size for the greatest worth within the capacity."""
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    room = np.arange(capacity + 1)
    before = room[:, None] - sizes[None, :]
    for _ in range(capacity // int(sizes.min())):
        gain = np.where(before >= 0, value[np.maximum(before, 0)] + worth, -1.0)
        best = gain.argmax(1)
        better = gain[room, best] > value + 1e-12
        if not better.any():
            break
        value[better] = gain[room, best][better]
        taken[better] = best[better]
    amounts, at = np.zeros(len(sizes), np.int64), capacity
    while taken[at] >= 0:
        amounts[taken[at]] += 1
        at -= sizes[taken[at]]
    return amounts


def _configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use them: the linear program, rounded down."""
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(20 * len(sizes)):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _best_configuration(sizes, worth, capacity)
        if worth @ column <= 1 + 1e-9:
            break
        use = np.linalg.solve(basis, demand.astype(float))
        step = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    use = np.floor(np.maximum(np.linalg.solve(basis, demand.astype(float)), 0) + 1e-9)
    open_demand, chosen = demand.copy(), []
    for i in np.argsort(-use):
        column = basis[:, i].astype(np.int64)
        used = column > 0
        times = min(int(use[i]), int((open_demand[used] // column[used]).min()))
        if times:
            open_demand -= times * column
            chosen.append((column, times))
    return chosen


class _Bins:
    """Classes of sequences with equal content, by the room they have left."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self._by_room: dict[int, list[tuple[tuple, int]]] = defaultdict(list)

    def add(self, lengths: tuple, times: int) -> None:
        if times:
            self._by_room[self.capacity - sum(lengths)].append((lengths, times))

    def best_fit(self, length: int, times: int) -> None:
        """Put `times` pieces of one length where the least room stays."""
        for room in range(length, self.capacity):
            while times and (classes := self._by_room.get(room)):
                lengths, n = classes.pop()
                used = min(n, times)
                self.add(lengths, n - used)
                self.add((*lengths, length), used)
                times -= used
            if not times:
                return
        per = self.capacity // length
        self.add((length,) * per, times // per)
        self.add((length,) * (times % per), int(times % per > 0))

    def classes(self) -> list[tuple[tuple, int]]:
        return [c for room in sorted(self._by_room) for c in self._by_room[room]]


def plan(counts: np.ndarray, capacity: int, groups: int = GROUPS) -> list[tuple[tuple, int]]:
    """(lengths of a sequence, number of such sequences); counts[n]: pieces of length n."""
    least = capacity // LONG
    bins = _Bins(capacity)
    bins.add((capacity,), int(counts[capacity]))
    lengths = np.arange(capacity - 1, least, -1)
    amounts = counts[lengths].astype(np.int64)
    ends = np.cumsum(amounts)
    total = int(ends[-1]) if len(ends) else 0
    rest = counts.astype(np.int64).copy()
    rest[capacity] = 0
    if total:
        cuts = np.unique(np.linspace(0, total, min(groups, total) + 1).astype(np.int64))
        runs, sizes = [], []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            part = np.minimum(ends, high) - np.maximum(ends - amounts, low)
            own = [[int(lengths[i]), int(part[i])] for i in np.flatnonzero(part > 0)]
            runs.append(own)
            sizes.append(own[0][0])
        # groups of one rounded length count as one in the program
        kinds, kind = np.unique(-np.array(sizes), return_inverse=True)
        queues: list[list] = [[] for _ in kinds]
        for k, own in zip(kind, runs, strict=True):
            queues[k].extend(own)
        demand = np.array([sum(n for _, n in q) for q in queues])
        for column, times in _configurations(-kinds, demand, capacity):
            slots = np.repeat(np.arange(len(column)), column)
            while times:
                # as many as have the same actual lengths in all places, one at least
                used = times
                for s, n in Counter(slots).items():
                    used = max(1, min(used, queues[s][0][1] // n))
                content = []
                for s in slots:
                    run = queues[s][0]
                    run[1] -= used
                    rest[run[0]] -= used
                    content.append(run[0])
                    if run[1] == 0:
                        queues[s].pop(0)
                bins.add(tuple(content), used)
                times -= used
    for length in range(capacity - 1, 0, -1):
        if rest[length]:
            bins.best_fit(length, int(rest[length]))
    return bins.classes()


def places(classes: list[tuple[tuple, int]]) -> tuple[np.ndarray, ...]:
    """Runs of ranks of one length: (length << 44 | first rank), first sequence, offset."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, times in classes:
        offset = 0
        for n in lengths:
            rows.append(((n << 44) | taken[n], sequence, offset))
            taken[n] += times
            offset += n
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


class _Ids:
    """Ids of pieces, remembered in one flat array."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self.specials = tuple(t.content for t in added if t.special)
        # a byte-level token has one character for each byte
        vocabulary = self._tokenizer.get_vocab()
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self._row: dict[bytes, int] = {}
        self._flat, self._ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _rows(self, different: pa.Array) -> np.ndarray:
        """Where the ids of each of these different pieces are."""
        pieces, known = different.to_pylist(), self._row.get
        rows = np.array([known(p, -1) for p in pieces], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = np.frombuffer(different.buffers()[1], np.int64)[different.offset :][: len(pieces) + 1]
            data = np.append(np.frombuffer(different.buffers()[2], np.uint8), [0x20, 0x20])
            joins = (data[at[new]] == 0x20) & ~NO_CUT[data[at[new] + 1]] & (np.diff(at)[new] > 1)
            new = np.concatenate([new[joins], new[~joins]])
            made = [pieces[i] for i in new.tolist()]
            flat, lengths = self._solved(made, int(joins.sum()))
            rows[new] = len(self._ends) - 1 + np.arange(len(new))
            self._ends = np.append(self._ends, self._ends[-1] + np.cumsum(lengths))
            self._flat = np.concatenate([self._flat, flat])
            short = (np.diff(at)[new] <= LONGEST).tolist()
            kept = zip(made, rows[new].tolist(), short, strict=True)
            self._row.update((p, row) for p, row, is_short in kept if is_short)
        return rows

    def _solved(self, pieces: list[bytes], joined: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, and how many each has.

        The first `joined` pieces begin where a text may be cut. They are given to the tokenizer
        many as one text; the bytes of its tokens tell where a piece ends. Where they do not, as
        a special string is one token, the pieces are given to it each.
        """
        flat, lengths = [], []
        for low in range(0, len(pieces), JOINED):
            part = pieces[low : min(low + JOINED, joined if low < joined else len(pieces))]
            if low < joined:
                encoded = self._tokenizer.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)
                ids = np.array(encoded[0].ids, np.uint32)
                ends = np.cumsum([len(p) for p in part])
                sums = np.cumsum(self._bytes[ids])
                cuts = np.searchsorted(sums, ends)
                if cuts[-1] == len(ids) - 1 and np.array_equal(sums[cuts], ends):
                    flat.append(ids)
                    lengths.append(np.diff(cuts, prepend=-1))
                    part = pieces[low + len(part) : low + JOINED]
            made = self._tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            flat += [np.array(e.ids, np.uint32) for e in made]
            lengths.append(np.array([len(e.ids) for e in made], np.int64))
        return np.concatenate(flat), np.concatenate(lengths)

    def of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and where those of each piece begin, the end included."""
        if len(self._ends) > REMEMBERED or len(self._flat) > 8 * REMEMBERED:
            self._forget()
        coded = pieces.dictionary_encode()
        rows = self._rows(coded.dictionary)[coded.indices.to_numpy()]
        first, lengths = self._ends[rows], self._ends[rows + 1] - self._ends[rows]
        bounds = np.append(0, np.cumsum(lengths))
        at = np.arange(int(bounds[-1])) + np.repeat(first - bounds[:-1], lengths)
        return self._flat[at], bounds

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text."""
        raw = data.tobytes()
        special = [s.encode() for s in self.specials if s.encode() in raw]
        starts, bounds = piece_starts(data, offsets)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(raw)]
        )
        ids, ends = self.of(column)
        for text, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            own = raw[a:b]
            if any(s in own for s in special):
                parts = [p.encode() for p in text_pieces(own.decode(), self.specials)]
                yield self.of(pa.array(parts, pa.large_binary()))[0]
            else:
                yield ids[ends[bounds[text]] : ends[bounds[text + 1]]]


@lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_column: str, text: str
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the task and rank of length among its pieces."""

    def job(batches):
        known = _ids(path)
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for low, _, data, offsets in text_slices(batch.column(1)):
                rows = []
                for i, found in enumerate(known.of_texts(data, offsets)):
                    ids = found.astype("<u4").tobytes() + end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    starts = [0, *range(first, n, capacity)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        seen[b - a] += 1
                        rows.append(
                            (i, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), seen[b - a] - 1)
                        )
                own, *columns = zip(*rows, strict=True)
                piece, start, length, crc, rank = (np.array(c, np.int64) for c in columns)
                yield {
                    "doc_id": batch.column(0).take(np.array(own) + low),
                    "piece": piece.astype(np.int32),
                    "start": start,
                    "length": length,
                    "ids_crc32": crc,
                    "task": np.full(len(own), task, np.int32),
                    "task_rank": rank,
                }

    return map_batches(
        docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text")),
        job,
        f"doc_id {id_type(docs, id_column)}, piece int, start long, length long, "
        "ids_crc32 long, task int, task_rank long",
    )


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    groups: int = GROUPS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    A row's ids are those of its text and `end_id`; a null or empty text has `end_id` alone.
    Rows longer than the capacity are cut, the first piece being the shorter one. No row is
    dropped or shortened; repeated rows are packed each, a null id stays, other columns are left
    out, an empty table gives none. The driver holds one number for each length.
    """
    pieces = stored(token_pieces(docs, path, capacity, end_id, id_column, text), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    histogram = np.zeros(capacity + 1, np.int64)
    for row in totals:
        histogram[row["length"]] = row["n"]
    keys, sequences, offsets = places(plan(histogram, capacity, groups))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.join(firsts, ["task", "length"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.col("task_rank")).alias("rank"),
    )

    def job(batches):
        for batch in batches:
            rank = batch.column(5).to_numpy()
            key = (batch.column(3).to_numpy() << 44) | rank
            run = np.searchsorted(keys, key, "right") - 1
            yield {name: batch.column(i) for i, name in enumerate(batch.schema.names[:5])} | {
                "sequence_id": sequences[run] + (key - keys[run]),
                "offset": offsets[run],
            }

    return map_batches(
        ranked,
        job,
        f"doc_id {id_type(docs, id_column)}, piece int, start long, length long, "
        "ids_crc32 long, sequence_id long, offset long",
    )
