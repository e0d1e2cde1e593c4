"""Language-model scoring by prediction by partial matching, beside a word baseline.

The model is a trie of byte contexts up to an order, pretrained on counts from every training
document. A symbol is looked for in the longest context that the trie has; where it is missing,
the escape estimate (method C: number of distinct symbols) is paid and the next shorter context
is asked, the symbols of the longer one being excluded from its counts. All grams of a batch
descend together, level by level.

No gram is left out and no process holds the whole trie: contexts of two bytes and more are dealt
by their last two, so a gram meets every context it can descend through in one part. The contexts
below, of one byte and none, have a fixed number of entries and go to every part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import SLICE_BYTES, compress_text, decompress_text, lower_ascii, mix, owners_of, pack
from .arrays import span_hashes, split_words, symbols, text_slices, unpack
from .rows import group_batches, id_type, map_batches, partitions

# Longest context in bytes.
ORDER = 5
# Bytes that UTF-8 never uses stand for the time before a text and for its end.
_BEFORE, _END = 0xFE, 0xFF
_ALPHABET = 257
_FREE = np.uint64(2**64 - 1)
# Grams, and entries of words in texts, that a task holds before it hands them on: 16 bytes each,
# and as much again while they are put in order.
HELD = 2_000_000
# Symbols after one byte: entries of the contexts that go to every part, and parts of that vector.
_PAIRS = 1 << 16
_VECTORS = 16


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text, its end included: it and the ORDER bytes before; and owners."""
    lengths = np.diff(offsets)
    padded = np.full(len(data) + len(lengths) * (ORDER + 1), _BEFORE, np.uint8)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    padded[np.arange(len(data)) + owner * (ORDER + 1) + ORDER] = data
    ends = offsets[1:] + np.arange(1, len(lengths) + 1) * (ORDER + 1) - 1
    padded[ends] = _END
    at = np.ones(len(padded), bool)
    for i in range(ORDER):
        at[ends - lengths - ORDER + i] = False
    keys = np.zeros(len(padded), np.uint64)
    for i in range(ORDER + 1):
        keys[ORDER:] = (keys[ORDER:] << np.uint64(8)) | padded[i : len(padded) - ORDER + i]
    return keys[at], np.repeat(np.arange(len(lengths)), lengths + 1)


def _sum_by(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's amounts."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.add.reduceat(amounts, starts) if len(starts) else amounts


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.diff(np.append(starts, len(keys)))


class _Sums:
    """Amounts by key, added up whenever as many wait as there are keys."""

    def __init__(self) -> None:
        self._done = (np.empty(0, np.uint64), np.empty(0, np.int64))
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, amounts: np.ndarray) -> None:
        self._held.append((keys, amounts.astype(np.int64)))
        self._size += len(keys)
        if self._size > max(HELD // 4, len(self._done[0]) // 2):
            self.total()

    def __len__(self) -> int:
        """Distinct keys among those added up so far."""
        return len(self._done[0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self._held:
            keys, amounts = (np.concatenate(c) for c in zip(self._done, *self._held, strict=True))
            self._held, self._size = [], 0
            self._done = _sum_by(keys, amounts)
        return self._done


def _by_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of `parts` equal ranges of the hashed number line in sorted keys."""
    edges = [(i << 64) // parts for i in range(1, parts)]
    return np.concatenate(
        [[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]
    ).astype(np.int64)


def count_pairs(texts: DataFrame) -> np.ndarray:
    """Counts of each symbol after each byte over all rows; a fixed number of them."""
    schema = "part int, counts binary"

    def job(batches) -> Iterator[dict]:
        counts = np.zeros(_PAIRS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                keys = gram_keys(data, offsets)[0] & np.uint64(_PAIRS - 1)
                counts += np.bincount(keys.astype(np.int64), minlength=_PAIRS)
        vectors = counts.reshape(_VECTORS, -1)
        yield {"part": np.arange(_VECTORS), "counts": [c.tobytes() for c in vectors]}

    def add_up(table: pa.Table) -> Iterator[dict]:
        vectors = [np.frombuffer(v.as_py(), np.int64) for v in table.column("counts")]
        yield {"part": [table.column("part")[0].as_py()], "counts": [sum(vectors).tobytes()]}

    counts = np.zeros((_VECTORS, _PAIRS // _VECTORS), np.int64)
    for row in group_batches(map_batches(texts, job, schema), "part", add_up, schema).collect():
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return counts.reshape(-1)


def gram_parts(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram, by the last two bytes of its context."""
    contexts = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64)) >> np.uint64(32)
    own = (contexts * np.uint64(parts)) >> np.uint64(32)
    return own.astype(np.int32)[((grams >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64)]


class _Table:
    """Numbers by 64-bit key, open addressing; all keys of a batch are looked up together."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(4 * max(len(keys), 1)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._mask = np.uint64((1 << bits) - 1)
        self._keys = np.full(1 << bits, _FREE, np.uint64)
        self._rows = np.full(1 << bits, -1, np.int32)
        slots, rows = self._slots(keys), np.arange(len(keys))
        while len(rows):
            free = np.flatnonzero(self._keys[slots] == _FREE)
            _, first = np.unique(slots[free], return_index=True)
            taken = free[first]
            self._keys[slots[taken]] = keys[rows[taken]]
            self._rows[slots[taken]] = rows[taken]
            rest = np.ones(len(rows), bool)
            rest[taken] = False
            slots, rows = (slots[rest] + np.uint64(1)) & self._mask, rows[rest]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0xD6E8FEB86659FD93)) >> self._shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slots = self._slots(keys)
        there = self._keys[slots]
        found = np.where(there == keys, self._rows[slots], -1)
        open_ = np.flatnonzero((there != keys) & (there != _FREE))
        while len(open_):
            slots[open_] = (slots[open_] + np.uint64(1)) & self._mask
            there = self._keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self._rows[slots[open_[hit]]]
            open_ = open_[~hit & (there != _FREE)]
        return found


class Trie:
    """Log probabilities of a static model, from the counts of its longest grams.

    `pairs`: counts of each symbol after each byte in the whole model, where `grams` are only those
    of one part of it; grams of that part get the probabilities of the whole.
    """

    def __init__(
        self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray | None = None
    ) -> None:
        keys, full, excluded = [], [], []
        self._context_keys, fields = [], []
        child = None
        levels = []
        for order in range(ORDER, -1, -1):
            if order == 1 and pairs is not None:
                grams = np.flatnonzero(pairs).astype(np.uint64)
                counts = pairs[np.flatnonzero(pairs)]
            grams, counts = _sum_by(grams & np.uint64((1 << 8 * (order + 1)) - 1), counts)
            levels.append((order, grams, counts))
        for order, grams, counts in reversed(levels):
            contexts, start = np.unique(grams >> np.uint64(8), return_index=True)
            totals = np.add.reduceat(counts, start) if len(start) else counts
            distinct = np.diff(np.append(start, len(grams)))
            owner = np.repeat(np.arange(len(contexts)), distinct)
            log_n = np.log10(counts)
            keys.append(self._tag(grams, order))
            full.append(log_n - np.log10(totals + distinct)[owner])
            excluded.append(log_n)
            escape = np.log10(distinct) - np.log10(totals + distinct)
            room = np.full(len(contexts), np.nan)
            again = np.zeros(len(contexts))
            if child is not None:
                # what the next shorter context has left once this one's symbols are excluded
                short = np.uint64((1 << 8 * order) - 1)
                place = np.searchsorted(child["grams"], grams & short)
                shared = np.bincount(owner, child["counts"][place], len(contexts))
                above = np.searchsorted(
                    child["contexts"], contexts & np.uint64((1 << 8 * max(order - 1, 0)) - 1)
                )
                fresh = child["distinct"][above] - distinct
                left = child["totals"][above] - shared + fresh
                room = np.where(left > 0, np.log10(np.maximum(left, 1)), np.nan)
                again = np.where(fresh > 0, np.log10(np.maximum(fresh, 1)), 0) - np.where(
                    fresh > 0, np.log10(np.maximum(left, 1)), 0
                )
            child = {
                "grams": grams,
                "counts": counts,
                "contexts": contexts,
                "totals": totals,
                "distinct": distinct,
            }
            self._context_keys.append(self._tag(contexts, order))
            fields.append(np.stack([escape, room, again], 1))
        self._entries = _Table(np.concatenate(keys))
        self._full = np.concatenate(full).astype(np.float32)
        self._excluded = np.concatenate(excluded).astype(np.float32)
        self._contexts = _Table(np.concatenate(self._context_keys))
        # the last row is that of no context
        self._fields = np.concatenate([*fields, np.zeros((1, 3))]).astype(np.float32)
        known = int(child is not None and len(levels[-1][1]))
        self._uniform = -float(np.log10(max(1, _ALPHABET - known)))

    @staticmethod
    def _tag(keys: np.ndarray, order: int) -> np.ndarray:
        return keys | np.uint64((order + 1) << 56)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The log probability of each symbol after its context."""
        result = np.zeros(len(keys))
        rest = np.arange(len(keys))
        below = np.full(len(keys), -1, np.int32)  # the context that was escaped from
        for order in range(ORDER, -1, -1):
            own = keys[rest] & np.uint64((1 << 8 * (order + 1)) - 1)
            entry = self._entries.find(self._tag(own, order))
            hit = np.flatnonzero(entry >= 0)
            came = below[hit]
            room = self._fields[came, 1]
            result[rest[hit]] += np.where(
                came < 0, self._full[entry[hit]], self._excluded[entry[hit]] - room
            )
            miss = np.flatnonzero(entry < 0)
            rest, came, own = rest[miss], below[miss], own[miss]
            if not len(rest):
                break
            context = self._contexts.find(self._tag(own >> np.uint64(8), order))
            there = context >= 0
            paid = np.where(came < 0, self._fields[context, 0], self._fields[came, 2])
            result[rest] += np.where(there, paid, 0.0)
            below = np.where(there, context, came)
        result[rest] += self._uniform
        return result


def _word_entries(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and number of each distinct word of each text, its end included; token counts."""
    starts, ends, bounds = split_words(data, offsets)
    texts = len(offsets) - 1
    words = np.append(span_hashes(symbols(lower_ascii(data)), starts, ends), np.zeros(texts, np.uint64))
    owner = np.append(owners_of(bounds), np.arange(texts))
    order = np.lexsort((owner, words))
    words, owner = words[order], owner[order]
    new = np.append(True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1]))[: len(words)]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(words)))
    return words[at], owner[at].astype(np.int32), times.astype(np.int32), np.diff(bounds) + 1


def score(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    `held_out`: an expression over the input; rows where it is true are scored but not learned
    from, rows where it is null are learned from. Null and empty texts are one end symbol.
    Repeated rows count each; a null id stays; other columns are left out; an empty table gives
    none; without training rows every symbol is equally likely. Every gram of the training rows
    is in the trie, whose parts grow with the input. Grams are counted and looked up, and words
    by 64-bit hash, in the shuffle, those of a task once each, so a very frequent one is no
    larger than a rare one.
    """
    rows = docs.select(
        docs[id_column].alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    spark = docs.sparkSession
    pairs = count_pairs(rows.where(~F.col("held_out")).select("text"))
    shared = spark.sparkContext.broadcast(pairs)
    parts = partitions(spark)
    kind = id_type(docs, id_column)

    def job(batches) -> Iterator[dict]:
        held: list[tuple] = []
        seen, chunk, size = _Sums(), 0, 0
        for batch in batches:
            trained = ~batch.column(2).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_slices(batch.column(1)):
                grams, owner = gram_keys(data, offsets)
                # the lowest bit tells grams that are only asked for from those learned
                asked = (~trained[low:high]).astype(np.uint64)[owner]
                seen.add(*_runs((grams << np.uint64(1)) | asked))
                words, texts, times, n = _word_entries(data, offsets)
                held.append(
                    (words, texts, times, n, trained[low:high], data, np.diff(offsets), batch.column(0).slice(low, high - low))
                )
                size += len(words)
                if size > HELD or len(seen) > HELD:
                    yield from hand_on(held, seen, chunk)
                    seen, chunk, size = _Sums(), chunk + 1, 0
        if held:
            yield from hand_on(held, seen, chunk)

    def hand_on(held: list[tuple], seen: _Sums, chunk: int) -> Iterator[dict]:
        """Texts, words and grams one after the other, each freed before the next; empties `held`."""
        words, texts, times, n, trained, data, lengths, ids = map(list, zip(*held, strict=True))
        held.clear()
        before = np.cumsum([0, *map(len, n)])
        n, trained = np.concatenate(n), np.concatenate(trained)
        number = (TaskContext.get().partitionId() << 20) | chunk
        frame = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), pa.array(n), pa.array(~trained), pa.array(np.concatenate(lengths))],
            names=["doc_id", "n", "held_out", "bytes"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, frame.schema) as writer:
            writer.write_batch(frame)
        yield {
            "part": [None],
            "chunk": [number],
            "texts": [sink.getvalue().to_pybytes()],
            "raw": [compress_text(np.concatenate(data))],
            "words": [None],
            "grams": [None],
        }
        data.clear()
        del frame, sink
        yield from hand_on_words(words, texts, times, before, trained, number)
        keys, counts = seen.total()
        grams = keys >> np.uint64(1)
        starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        known = np.add.reduceat(np.where(keys & np.uint64(1), 0, counts), starts)
        grams = grams[starts]
        own_part = gram_parts(grams, parts).astype(np.int32)
        order = np.argsort(own_part, kind="stable")
        grams, known = grams[order], known[order]
        edges = np.searchsorted(own_part[order], np.arange(parts + 1))
        del own_part, order, keys, counts
        for part in np.flatnonzero(np.diff(edges)):
            low, high = edges[part], edges[part + 1]
            yield _asked(part, number, grams=pack(grams[low:high], known[low:high]))

    def hand_on_words(words, texts, times, before, trained, number) -> Iterator[dict]:
        for t, b in zip(texts, before[:-1].tolist(), strict=True):
            t += np.int32(b)
        parted = []
        for pieces in (words, texts, times):
            parted.append(np.concatenate(pieces))
            pieces.clear()
        order = np.argsort(parted[0], kind="stable").astype(np.int32)
        words, texts, times = (column[order] for column in parted)
        del parted, order
        bounds = _by_part(words, parts)
        for part in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[part], bounds[part + 1]
            own = words[a:b]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            sizes = np.diff(np.append(starts, b - a))
            learned = np.add.reduceat(times[a:b] * trained[texts[a:b]], starts)
            packed = pack(own[starts], sizes, learned, texts[a:b], times[a:b])
            yield _asked(part, number, words=packed)

    def _asked(part, number, words=None, grams=None) -> dict:
        return {
            "part": [int(part)],
            "chunk": [number],
            "texts": [None],
            "raw": [None],
            "words": [words],
            "grams": [grams],
        }

    def look_up(table: pa.Table) -> Iterator[dict]:
        yield from look_up_grams(table)
        yield from look_up_words(table)

    def look_up_grams(table: pa.Table) -> Iterator[dict]:
        given = zip(table.column("chunk").to_pylist(), table.column("grams").to_pylist(), strict=True)
        asked, sums = [(c, g) for c, g in given if g is not None], _Sums()
        for _, grams in asked:
            sums.add(*unpack(grams))
        keys, counts = sums.total()
        trie = Trie(keys[counts > 0], counts[counts > 0], shared.value)
        logs = np.empty(len(keys), np.float32)
        for low in range(0, len(keys), SLICE_BYTES):
            logs[low : low + SLICE_BYTES] = trie.log10(keys[low : low + SLICE_BYTES])
        for number, grams in asked:
            own = unpack(grams)[0]
            found = logs[np.searchsorted(keys, own)]
            yield _reply(number, grams=pack(own, found.view(np.uint32)))

    def look_up_words(table: pa.Table) -> Iterator[dict]:
        chunks = table.column("chunk").to_pylist()
        given = table.column("words").to_pylist()
        asked = [(c, unpack(w)) for c, w in zip(chunks, given, strict=True) if w is not None]
        if not asked:
            return
        keys, counts = _sum_by(
            np.concatenate([w[0] for _, w in asked]), np.concatenate([w[2] for _, w in asked])
        )
        counts = counts.astype(np.int64)
        for number, (own, sizes, _, texts, times) in asked:
            c = np.repeat(counts[np.searchsorted(keys, own)], sizes.astype(np.int64))
            at, texts = np.unique(texts, return_inverse=True)
            times = times.astype(np.int64)
            sums = np.bincount(texts, times * np.log10(c + 1.0), len(at))
            known = np.bincount(texts, times * (c > 0), len(at)).astype(np.int64)
            yield _reply(number, sums=pack(at, sums.view(np.uint64), known))
        yield _reply(-1, tokens=int(counts.sum()), distinct=int((counts > 0).sum()))

    def _reply(number, sums=None, grams=None, tokens=0, distinct=0) -> dict:
        return {
            "chunk": [number],
            "sums": [sums],
            "grams": [grams],
            "tokens": [tokens],
            "vocabulary": [distinct],
        }

    made = "part int, chunk long, texts binary, raw binary, words binary, grams binary"
    handed = stored(map_batches(rows, job, made), "asked")
    replies = stored(
        group_batches(
            handed.where("part IS NOT NULL").select("part", "chunk", "words", "grams"),
            "part",
            look_up,
            "chunk long, sums binary, grams binary, tokens long, vocabulary long",
        ),
        "replies",
    )
    totals = replies.agg(F.sum("tokens"), F.sum("vocabulary")).first()
    train_tokens, vocabulary = (int(t or 0) for t in totals)

    def gather(table: pa.Table) -> Iterator[dict]:
        given = [unpack(g) for g in table.column("grams").to_pylist() if g is not None]
        known_grams = _Table(np.concatenate([g for g, _ in given]))
        logs = np.concatenate([v.astype(np.uint32).view(np.float32) for _, v in given])
        for texts, raw in zip(table.column("texts").to_pylist(), table.column("raw").to_pylist(), strict=True):
            if texts is None:
                continue
            frame = pa.ipc.open_stream(texts).read_next_batch()
            score = np.zeros(len(frame))
            ends = np.append(0, np.cumsum(frame.column(3).to_numpy()))
            whole = pa.LargeStringArray.from_buffers(
                len(frame), pa.py_buffer(ends), pa.py_buffer(decompress_text(raw))
            )
            for low, high, data, offsets in text_slices(whole):
                grams, owner = gram_keys(data, offsets)
                score[low:high] = np.bincount(owner, logs[known_grams.find(grams)], high - low)
            n = frame.column(1).to_numpy()
            sums, known = np.zeros(len(n)), np.zeros(len(n), np.int64)
            for reply in table.column("sums").to_pylist():
                if reply is not None:
                    at, own, hits = unpack(reply)
                    at = at.astype(np.int64)
                    sums[at] += own.view(np.float64)
                    known[at] += hits.astype(np.int64)
            yield {
                "doc_id": frame.column(0),
                "held_out": frame.column(2),
                "n_tokens": n,
                "n_known": known,
                "train_tokens": np.full(len(n), train_tokens),
                "base_score": sums - n * np.log10(train_tokens + vocabulary + 1.0),
                "score": score,
            }

    return group_batches(
        handed.where("part IS NULL")
        .select("chunk", "texts", "raw")
        .unionByName(
            replies.where("chunk >= 0").select("chunk", "sums", "grams"), allowMissingColumns=True
        ),
        "chunk",
        gather,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
