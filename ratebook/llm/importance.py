"""Importance resampling towards a target corpus, over hashed word n-grams.

A feature's bucket is the CRC of its text. The vocabulary has a head, words and pairs that are
frequent in the corpus: each executor holds the CRC state of every head word, with and without the
space before it, and the state of every frequent pair. A feature of head words only is put together
from states: the state of a text followed by n bytes is a linear map, tabled by n, of the text's
own state, combined with the state of those bytes. A feature with a word of the tail takes its CRC
directly from its bytes. Both give the same number, so the head only decides how much work is
saved, and the bucket totals are exact.
"""

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_numbers
from ..operators.storage import stored
from .arrays import joined_words, lower_ascii, split_words, text_slices
from .rows import id_type, map_batches

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
# The head: at most so many words, of so many bytes at most, and so many places for pairs. These
# bound what is broadcast: 2^15 words of 65 bytes and 2^17 pairs of 12 bytes.
HEAD_WORDS = 1 << 15
WORD_BYTES = 64
PAIR_PLACES = 1 << 17
# Pairs that a slice of a task holds so many times are counted as candidates of the head.
PAIR_SEEN = 3
# Distinct words and pairs a task holds while it counts, and steps of frequency for each doubling.
HELD = 400_000
_STEPS = 16
_BETWEEN = np.ones(256, bool)
_BETWEEN[ord("0") : ord("9") + 1] = False
_BETWEEN[ord("a") : ord("z") + 1] = False
_BETWEEN[0x80:] = False


def _shift_tables() -> np.ndarray:
    """For n up to a word and its space: what each byte of a CRC state becomes n bytes later."""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
    state = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    tables = [state]
    for _ in range(WORD_BYTES + 1):
        state = one[state & np.uint32(255)] ^ (state >> np.uint32(8))
        tables.append(state)
    return np.concatenate(tables)


_SHIFT = _shift_tables()


def combine(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of texts of state `left` followed by `length` bytes of state `right`."""
    row = length.astype(np.int64) << 10
    moved = right.copy()
    for i in range(4):
        moved ^= _SHIFT[row + (i << 8) + ((left >> np.uint32(8 * i)) & np.uint32(255))]
    return moved


class Head(NamedTuple):
    """Words with their states; states of pairs by a place computed from the words' numbers."""

    words: list[bytes]
    alone: np.ndarray
    after_space: np.ndarray
    lengths: np.ndarray
    pair_keys: np.ndarray
    pair_states: np.ndarray


def _pair_place(keys: np.ndarray) -> np.ndarray:
    return ((keys * 0x9E3779B1) >> 7) & (PAIR_PLACES - 1)


def make_head(words: list[bytes], pairs: list[bytes]) -> Head:
    """The head of these words and of the pairs of them, most frequent first.

    Of pairs that fall on one place the first stays.
    """
    number = {w: i for i, w in enumerate(words)}
    keys = np.full(PAIR_PLACES, -1, np.int64)
    states = np.zeros(PAIR_PLACES, np.uint32)
    for pair in pairs:
        left, right = (number.get(w) for w in pair.split(b" "))
        if left is not None and right is not None:
            key = left * HEAD_WORDS + right
            place = _pair_place(key)
            if keys[place] < 0:
                keys[place], states[place] = key, zlib.crc32(pair)
    return Head(
        words,
        np.array([zlib.crc32(w) for w in words], np.uint32),
        np.array([zlib.crc32(b" " + w) for w in words], np.uint32),
        np.array([len(w) + 1 for w in words], np.int64),
        keys,
        states,
    )


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Joined words, where each begins, the texts' bounds, and the words with their space."""
    data = lower_ascii(data)
    starts, ends, bounds = split_words(data, offsets, _BETWEEN)
    flat, firsts = joined_words(data, starts, ends)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(firsts), pa.py_buffer(flat)]
    )
    return flat, firsts, bounds, words


def _most(counts: Counter, n: int) -> Counter:
    """The most frequent entries; of equal ones the first in byte order."""
    return Counter(dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]))


def frequent_vocabulary(texts: DataFrame) -> Head:
    """The head of all texts: each task counts its words and pairs, Spark adds up the largest."""

    def job(batches) -> Iterator[dict]:
        words, pairs = Counter(), Counter()
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                _count(data, offsets, words, pairs)
                if len(words) > HELD:
                    words = _most(words, HELD // 2)
                if len(pairs) > HELD:
                    pairs = _most(pairs, HELD // 2)
        for size, counts in ((1, _most(words, HEAD_WORDS)), (2, _most(pairs, PAIR_PLACES // 2))):
            yield {"size": [size] * len(counts), "feature": list(counts), "times": list(counts.values())}

    made = map_batches(texts, job, "size int, feature binary, times long")
    summed = stored(made.groupBy("size", "feature").agg(F.sum("times").alias("times")), "vocabulary")

    step = F.floor(F.log2("times") * _STEPS).cast("int")
    steps = {
        (r["size"], r["step"]): r["count"]
        for r in summed.groupBy("size", step.alias("step")).count().collect()
    }

    def most(size: int, n: int) -> list[bytes]:
        """Features of the highest steps of frequency of which there are at most n."""
        left, least = n, None
        for own, now in sorted(steps, reverse=True):
            if own == size and (left := left - steps[own, now]) >= 0:
                least = now
            elif own == size:
                break
        if least is None:
            return []
        top = summed.where((F.col("size") == size) & (step >= least)).collect()
        return [bytes(r["feature"]) for r in sorted(top, key=lambda r: (-r["times"], r["feature"]))]

    return make_head(most(1, HEAD_WORDS), most(2, PAIR_PLACES // 2))


def _count(data: np.ndarray, offsets: np.ndarray, words: Counter, pairs: Counter) -> None:
    """Add the words of a slice, and the pairs it holds several times."""
    _, firsts, bounds, column = _words(data, offsets)
    if not len(column):
        return
    coded = column.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    texts = coded.dictionary.to_pylist()
    sizes = np.array([len(t) - 1 for t in texts])
    for i, n in enumerate(np.bincount(codes, minlength=len(texts)).tolist()):
        if sizes[i] <= WORD_BYTES:
            words[texts[i][:-1]] += n
    first = np.zeros(len(codes) + 1, bool)
    first[bounds] = True
    both = ~first[1:-1] & (sizes[codes[:-1]] <= WORD_BYTES) & (sizes[codes[1:]] <= WORD_BYTES)
    found, times = np.unique((codes[:-1] * len(texts) + codes[1:])[both], return_counts=True)
    for key, n in zip(found[times >= PAIR_SEEN].tolist(), times[times >= PAIR_SEEN].tolist(), strict=True):
        pairs[texts[key // len(texts)] + texts[key % len(texts)][:-1]] += n


class Buckets:
    """Buckets of the features of texts, with one head."""

    def __init__(self, head: Head) -> None:
        self._head = head
        self._set = pc.SetLookupOptions(pa.array([w + b" " for w in head.words], pa.large_binary()))

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word the buckets of the 1 to 3 words from it on, -1 past the text; the texts' bounds."""
        head = self._head
        flat, firsts, bounds, words = _words(data, offsets)
        n = len(words)
        if not n:
            return np.full((3, 0), -1), bounds, np.diff(bounds)
        at = pc.fill_null(pc.index_in(words, options=self._set), -1).to_numpy().astype(np.int64)
        ends = np.repeat(bounds[1:], np.diff(bounds))
        raw = memoryview(flat.tobytes())
        states = np.zeros((3, n), np.uint32)
        headed = np.ones(n, bool)
        for size in range(3):
            here = np.flatnonzero(np.arange(n) + size < ends)
            headed[here] &= at[here + size] >= 0
            known = here[headed[here]]
            last = at[known + size]
            if size == 0:
                states[0, known] = head.alone[last]
            else:
                made = np.zeros(len(known), bool)
                if size == 1:
                    key = at[known] * HEAD_WORDS + last
                    place = _pair_place(key)
                    made = head.pair_keys[place] == key
                    states[1, known[made]] = head.pair_states[place[made]]
                known, last = known[~made], last[~made]
                states[size, known] = combine(
                    states[size - 1, known], head.after_space[last], head.lengths[last]
                )
            rest = here[~headed[here]]
            pieces = zip(firsts[rest].tolist(), (firsts[rest + size + 1] - 1).tolist(), strict=True)
            states[size, rest] = [zlib.crc32(raw[a:b]) for a, b in pieces]
        buckets = (states % np.uint32(BUCKETS)).astype(np.int64)
        for size in range(1, 3):
            buckets[size, np.arange(n) + size >= ends] = -1
        return buckets, bounds, np.diff(bounds)


def bucket_totals(texts: DataFrame, head: Broadcast) -> np.ndarray:
    """How many features of all texts are in each bucket; tasks send sums, Spark adds them."""

    def job(batches) -> Iterator[dict]:
        buckets, totals = Buckets(head.value), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                found, _, _ = buckets.of(data, offsets)
                totals += np.bincount(found.reshape(-1) + 1, minlength=BUCKETS + 1)
        own = np.flatnonzero(totals[1:])
        yield {"bucket": own, "times": totals[1:][own]}

    summed = map_batches(texts, job, "bucket int, times long").groupBy("bucket")
    totals = np.zeros(BUCKETS, np.int64)
    for row in summed.agg(F.sum("times").alias("times")).collect():
        totals[row["bucket"]] = row["times"]
    return totals


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and raw shares of each bucket."""
    size, aim = float(raw.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * size / ((s + 1.0) * aim))) for s, t in pairs])


def noise(name: str | None) -> int:
    """Thousandths of a Gumbel number that depends on the row's id only."""
    drawn = int(hashlib.sha256(f"{SEED}:{name or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row.

    The rows of at least 20 words with the highest scores, 5 in a hundred of them rounded down,
    are drawn and have a rank from 1; ties go to the smaller id, a null id last. `target`: a table
    with a column of the same name as `text`. Null and empty texts, and those without words, have
    no feature and weight 0. Repeated rows count each, in the totals too; a null id counts as an
    empty one in the random number. Other columns are left out; an empty table of documents gives
    none; without target texts the target is uniform.
    """
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(frequent_vocabulary(docs.select(text)))
    raw, aim = (bucket_totals(df.select(text), head) for df in (docs, target))
    shared = spark.sparkContext.broadcast(gains(raw, aim))

    def job(batches) -> Iterator[dict]:
        buckets, gain = Buckets(head.value), np.append(shared.value, 0)
        for batch in batches:
            names = batch.column(2).to_pylist()
            for low, high, data, offsets in text_slices(batch.column(1)):
                found, bounds, n = buckets.of(data, offsets)
                sums = np.append(0, np.cumsum(gain[found].sum(0)))
                weight = sums[bounds[1:]] - sums[bounds[:-1]]
                yield {
                    "doc_id": batch.column(0).slice(low, high - low),
                    "n_words": n,
                    "n_features": n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0),
                    "weight": weight,
                    "score": weight + np.array([noise(x) for x in names[low:high]], np.int64),
                }

    given = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.col(id_column).cast("string").alias("name")
    )
    schema = f"doc_id {id_type(docs, id_column)}, n_words long, n_features long, weight long, score long"
    scored = stored(map_batches(given, job, schema), "scores")
    able = scored.where(F.col("n_words") >= MIN_WORDS)
    rows = able.count()
    drawn = PERCENT * rows // 100
    ordered = row_numbers(
        able.withColumn("_all", F.lit(1)).withColumn("_loss", -F.col("score")),
        "_all",
        ["_loss", "doc_id"],
        "rank",
        {1: rows} if rows else None,
    )
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return ordered.withColumn("rank", rank).select(*scored.columns, "rank").unionByName(
        scored.where(F.col("n_words") < MIN_WORDS).withColumn("rank", F.lit(None).cast("bigint"))
    )
