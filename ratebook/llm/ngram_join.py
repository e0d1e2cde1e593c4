"""Exact Jaccard join on word shingles with token-combination prefixes.

Two sets that are similar enough share a token among the first of each one's tokens in any fixed
order (its prefix), and k tokens among the first k - 1 more. Tokens are ordered rare ones first, by
a count sketch of the whole corpus. A rare token of the prefix is indexed alone. Where the first
shared token is frequent, small sets, whose frequent tokens say little, are indexed by pairs of
the frequent tokens of the extended prefix; large sets by single ones. All pairs of small groups
are compared; of a larger group first those along its sizes and with a few pivots, and then, so
that no link is lost that matters, the pairs of members that are still in different components.

Where the key of a group is the first that two sets share, all their common tokens stand at its
place or later in both, which bounds how many there are. Pairs beyond that bound are compared in
the group of their first shared key, or not similar.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import (
    compress_text,
    decompress_text,
    lower_ascii,
    mix,
    owners_of,
    pack,
    rolling_hashes,
    span_hashes,
    split_words,
    symbols,
    text_slices,
    unpack,
    whole_windows,
)
from .components import components
from .repeats import range_bounds
from .rows import group_batches, id_type, keyed, map_batches, partitions

SHINGLE = 5
# Similarity in hundredths.
SIMILAR = 80
# Buckets of the count sketch. A token is frequent from so many rows, or so many times the mean
# of a bucket, whichever is more.
BUCKETS = 1 << 22
FREQUENT = 200
TIMES_MEAN = 4
# Sets of at most LARGE tokens use pairs of frequent tokens; those of at least SMALL single ones.
# Similar sets are both in one of the ranges, as sizes differ by a quarter at most.
LARGE, SMALL = 80, 64
# Bits of a set's bitmap: a power of two in this range, for larger sets more. Two bitmaps differ in
# at most as many bits as the sets have tokens apart.
BITS, MOST_BITS = 1024, 1 << 16
_BITS_HELD = 1 << 21
# Groups of at most so many members have all their pairs compared at once.
ALL_PAIRS = 6
HELD = 6_000_000
_SKETCH_PARTS = 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ordered by text, and the bounds of the texts."""
    starts, ends, bounds = split_words(data, offsets)
    words = span_hashes(symbols(lower_ascii(data)), starts, ends)
    n = np.diff(bounds)
    windows = whole_windows(bounds, SHINGLE)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    hashes = np.concatenate(
        [rolling_hashes(words, SHINGLE)[windows], span_hashes(words, bounds[short], bounds[short + 1])]
    )
    owner = np.concatenate([owners_of(bounds)[windows], short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(n) + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number per set, equal for equal sets."""
    sums = np.append(np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(0x5DEECE66D))))
    size = np.diff(bounds).astype(np.uint64)
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + size * np.uint64(0x2545F4914F6CDD1D))


def bit_widths(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of sets; as many as tokens, so that they do not fill up."""
    enough = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    return np.clip(enough, BITS, MOST_BITS)


def bitmaps(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per set, whether the number of its tokens that fall on each bit is odd."""
    widths = bit_widths(np.diff(bounds))
    ends = np.cumsum(widths)
    made: list[bytes] = []
    while (low := len(made)) < len(widths):
        before = ends[low] - widths[low]
        high = int(np.searchsorted(ends, before + _BITS_HELD, "right"))
        cut, width = bounds[low : high + 1], widths[low:high]
        first = ends[low:high] - width - before
        own = owners_of(cut)
        mask = (width[own] - 1).astype(np.uint64)
        bit = (mix(hashes[cut[0] : cut[-1]]) & mask).astype(np.int64)
        odd = np.bincount(first[own] + bit, minlength=int(width.sum())) & 1
        raw = np.packbits(odd.astype(np.uint8)).tobytes()
        made += [raw[f // 8 : (f + w) // 8] for f, w in zip(first.tolist(), width.tolist(), strict=True)]
    return made


def bits_apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many bits the bitmaps of each pair differ; a wider one is folded to the other's width."""
    wide = np.array([[len(x), len(y)] for x, y in zip(left, right, strict=True)]).reshape(-1, 2)
    apart = np.zeros(len(left), np.int64)
    for widths in np.unique(wide, axis=0):
        own = np.flatnonzero((wide == widths).all(1))
        one, two = (
            np.frombuffer(b"".join(side[i] for i in own), np.uint64).reshape(len(own), -1)
            for side in (left, right)
        )
        one, two = (_folded(x, min(one.shape[1], two.shape[1])) for x in (one, two))
        apart[own] = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
    return apart


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def frequent_buckets(texts: DataFrame) -> np.ndarray:
    """Which buckets of the sketch hold a frequent token; from every row's set."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)

    def job(batches) -> Iterator[dict]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                hashes, _ = shingle_sets(data, offsets)
                counts += np.bincount((hashes >> shift).astype(np.int64), minlength=BUCKETS)
        if counts.any():
            slices = counts.reshape(_SKETCH_PARTS, -1)
            yield {"part": np.arange(_SKETCH_PARTS), "counts": [pack(c) for c in slices]}

    def add_up(table: pa.Table) -> Iterator[dict]:
        total = sum(unpack(v.as_py())[0] for v in table.column("counts"))
        yield {"part": [table.column("part")[0].as_py()], "counts": [pack(total)]}

    schema = "part int, counts binary"
    counts = np.zeros((_SKETCH_PARTS, BUCKETS // _SKETCH_PARTS), np.int64)
    for row in group_batches(map_batches(texts, job, schema), "part", add_up, schema).collect():
        counts[row["part"]] = unpack(row["counts"])[0].astype(np.int64)
    counts = counts.reshape(-1)
    return counts >= max(FREQUENT, TIMES_MEAN * counts.mean())


def index_entries(
    hashes: np.ndarray, bounds: np.ndarray, frequent: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index keys of each set, the set of each key, and the tokens of the set before the key.

    Two sets whose first shared key it is share none of those tokens, so of a pair of tokens, of
    which the second may be no nearer than next to the first, one token less counts.
    """
    n = np.diff(bounds)
    shared = -(-SIMILAR * n // 100)  # at least so many tokens are in any similar set
    owner = owners_of(bounds)
    hot = frequent[(hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)]
    order = np.lexsort((hashes, hot, owner))
    hashes, hot = hashes[order], hot[order]
    rank = np.arange(len(hashes)) - bounds[owner]
    within = rank <= (n - shared)[owner]
    alone = within & (~hot | (n[owner] >= SMALL) | (n[owner] == 1))
    keys, sets, skips = [hashes[alone]], [owner[alone]], [rank[alone]]
    paired = hot & (rank <= (n - shared)[owner] + 1) & (n[owner] <= LARGE) & (n[owner] > 1)
    tokens, own, place = hashes[paired], owner[paired], rank[paired]
    for step in range(1, LARGE):
        if len(tokens) <= step:
            break
        both = own[step:] == own[:-step]
        if not both.any():
            break
        keys.append(mix(tokens[:-step][both] + np.uint64(3) * tokens[step:][both]))
        sets.append(own[step:][both])
        skips.append(np.maximum(place[:-step], place[step:] - 1)[both])
    return np.concatenate(keys), np.concatenate(sets), np.concatenate(skips)


def group_pairs(keys: np.ndarray, sets: np.ndarray, sizes: np.ndarray, skips: np.ndarray):
    """Pairs to compare first, and the members of groups that may need more of them.

    Entries of one key form a group. Returns the two sets of each pair, and (key, set, size, skip)
    of larger groups.
    """
    order = np.lexsort((skips, sets, sizes, keys))
    keys, sets, sizes, skips = keys[order], sets[order], sizes[order], skips[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1]))[: len(keys)]
    keys, sets = keys[new], sets[new]
    sizes, skips = sizes[new].astype(np.int64), skips[new].astype(np.int64)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    members = np.diff(np.append(starts, len(keys)))
    many = np.repeat(members, members)
    stay = many > 1
    keys, sets, sizes, skips, many = keys[stay], sets[stay], sizes[stay], skips[stay], many[stay]
    left, right = [], []

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        fit = (keys[a] == keys[b]) & (100 * sizes[a] >= SIMILAR * sizes[b])
        # a large group's first pairs are to find its components, here or not first shared
        left_over = np.minimum(sizes[a] - skips[a], sizes[b] - skips[b])
        fit &= (many[a] > ALL_PAIRS) | ((100 + SIMILAR) * left_over >= SIMILAR * (sizes[a] + sizes[b]))
        left.append(a[fit])
        right.append(b[fit])

    at = np.arange(len(keys))
    for step in range(1, ALL_PAIRS):
        first = at[: max(len(keys) - step, 0)]
        near = (many[first] <= ALL_PAIRS) | (step <= 2)
        compare(first[near], first[near] + step)
    large = at[many > ALL_PAIRS]
    if len(large):
        band = np.floor(np.log(sizes) / np.log(1.25) + 1e-9).astype(np.int64)
        begins = np.append(True, (keys[1:] != keys[:-1]) | (band[1:] != band[:-1]))
        pivot = np.maximum.accumulate(np.where(begins, at, 0))
        compare(pivot[large], large)
        before = pivot[np.maximum(pivot[large] - 1, 0)]
        compare(before, large)
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(sets[a], sets[b]), np.maximum(sets[a], sets[b])], 1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pairs[:, 0], pairs[:, 1], keys[large], sets[large], sizes[large], skips[large]


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b that can be similar by their sizes and bitmaps; sets: set, n, bits."""
    one = sets.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = sets.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def job(batches) -> Iterator[dict]:
        for batch in batches:
            a, b, n, m = (batch.column(i).to_numpy() for i in range(4))
            apart = bits_apart(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            fit = (100 + SIMILAR) * apart <= (100 - SIMILAR) * (n + m)
            yield {"a": a[fit], "b": b[fit]}

    return map_batches(joined, job, "a long, b long")


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose sets are similar; texts: set and the compressed text of one row."""
    left = texts.select(F.col("set").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("set").alias("b"), F.col("text").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def job(batches) -> Iterator[dict]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in range(2))
            left, right = (batch.column(i).to_pylist() for i in (2, 3))
            low = size = 0
            for i in range(len(a)):
                size += len(left[i]) + len(right[i])
                if size > 2_000_000 or i == len(a) - 1:
                    own = slice(low, i + 1)
                    yield from verify(a[own], b[own], left[own] + right[own])
                    low, size = i + 1, 0

    def verify(a, b, packed: list[bytes]) -> Iterator[dict]:
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        first = np.full(len(ids), -1)
        first[at[::-1]] = np.arange(len(at))[::-1]
        raw = [decompress_text(packed[i]) for i in first.tolist()]
        offsets = np.append(0, np.cumsum([len(t) for t in raw]))
        hashes, bounds = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
        n = np.diff(bounds)
        keep = []
        for i, (x, y) in enumerate(zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True)):
            one, two = hashes[bounds[x] : bounds[x + 1]], hashes[bounds[y] : bounds[y + 1]]
            both = np.sort(np.concatenate([one, two]))
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= SIMILAR * (n[x] + n[y] - common):
                keep.append(i)
        yield {"a": a[keep], "b": b[keep]}

    return map_batches(joined, job, "a long, b long")


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, set, key and component of every row.

    Rows link when 100 times the common shingles are at least 80 times all shingles of both; a
    component is named by its least doc_id. A text of fewer than five words is one shingle; null
    and empty texts, and those without words, have none and link with nothing, and are their own
    component. Rows with equal sets always link, repeated rows too. A null id stays and is never
    the least, unless all ids of a component are null. Other columns are left out; an empty table
    gives none. Sets are compared by 64-bit hashes of their shingles. `set` numbers equal sets,
    `key` stands for doc_id and text, `component` numbers components, null where a row has no
    shingles.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = keyed(docs, id_column, text)
    shared = spark.sparkContext.broadcast(np.packbits(frequent_buckets(rows.select("text"))))

    def job(batches) -> Iterator[dict]:
        frequent = np.unpackbits(shared.value).astype(bool)
        held, size = [], 0
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                hashes, bounds = shingle_sets(data, offsets)
                sets, sizes = signatures(hashes, bounds), np.diff(bounds)
                yield _entry(
                    high - low,
                    key=batch.column(0).slice(low, high - low),
                    doc_id=batch.column(1).slice(low, high - low),
                    set=sets.view(np.int64),
                    n=sizes,
                    bits=bitmaps(hashes, bounds),
                )
                keys, at, skips = index_entries(hashes, bounds, frequent)
                held.append((keys, sets[at], sizes[at], skips))
                size += len(keys)
                if size > HELD:
                    yield from hand_on(held)
                    held, size = [], 0
        if held:
            yield from hand_on(held)

    def hand_on(held) -> Iterator[dict]:
        keys, sets, sizes, skips = (np.concatenate(c) for c in zip(*held, strict=True))
        # equal sets of the task are one
        order = np.lexsort((skips, sets, keys))
        keys, sets, sizes, skips = keys[order], sets[order], sizes[order], skips[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1]))[: len(keys)]
        keys, sets, sizes, skips = keys[new], sets[new], sizes[new], skips[new]
        bounds = range_bounds(keys, parts)
        for part in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[part], bounds[part + 1])
            ids, at, back = np.unique(sets[own], return_index=True, return_inverse=True)
            blob = pack(keys[own], back, ids, sizes[own][at], skips[own])
            yield _entry(1, part=[int(part)], entries=[blob])

    kind = id_type(docs, id_column)
    columns = {"key": "long", "doc_id": kind, "set": "long", "n": "long", "bits": "binary"}
    columns |= {"part": "int", "entries": "binary"}

    def _entry(rows_made: int, **given) -> dict:
        return {c: given.get(c, [None] * rows_made) for c in columns}

    made = stored(map_batches(rows, job, ", ".join(f"{c} {t}" for c, t in columns.items())), "sets")
    members = made.where("entries is null").select("key", "doc_id", "set", "n")

    def compare(table: pa.Table) -> Iterator[dict]:
        blobs = [unpack(v.as_py()) for v in table.column("entries")]
        keys = np.concatenate([b[0] for b in blobs])
        sets = np.concatenate([b[2][b[1].astype(np.int64)] for b in blobs])
        sizes = np.concatenate([b[3][b[1].astype(np.int64)] for b in blobs])
        skips = np.concatenate([b[4] for b in blobs])
        a, b, group, own, size, skip = group_pairs(keys, sets, sizes, skips)
        none = np.zeros(len(a), np.int64)
        yield {"a": a.view(np.int64), "b": b.view(np.int64), "size": none - 1, "skip": none}
        yield {"a": group.view(np.int64), "b": own.view(np.int64), "size": size, "skip": skip}

    # pairs have size -1; else a is a group, b a member
    groups = stored(
        group_batches(
            made.where("entries is not null").select("part", "entries"),
            "part",
            compare,
            "a long, b long, size long, skip long",
        ),
        "groups",
    )
    pairs = groups.where("size = -1").select("a", "b").distinct()
    bits = made.where("n > 0").groupBy("set").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    maybe = stored(_possible(pairs, bits), "maybe")
    large = groups.where("size >= 0").select(
        F.col("a").alias("group"), F.col("b").alias("set"), "size", "skip"
    )
    asked = maybe.select(F.col("a").alias("set")).union(maybe.select("b")).union(large.select("set"))
    chosen = members.groupBy("set").agg(F.min("key").alias("key")).join(asked.distinct(), "set")

    def shrink(batches) -> Iterator[dict]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            yield {"key": batch.column(0), "text": [compress_text(t) for t in texts]}

    # texts are compressed before they are shuffled
    small = map_batches(rows.select("key", "text"), shrink, "key long, text binary")
    wanted = small.join(chosen, "key").dropDuplicates(["key"]).select("set", "text")
    texts = stored(wanted, "texts")
    links = stored(_similar(maybe, texts), "links")
    found = stored(components(links), "components")
    labelled = large.join(found, large["set"] == found["node"], "left").select(
        "group", "set", "size", "skip", F.coalesce("component", "set").alias("component")
    )
    # groups of the same members are paired once, each member with the most that it has left
    mixed = labelled.groupBy("group").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count(F.lit(1)).alias("members"),
        F.sum(F.xxhash64("set").cast("decimal(38,0)")).alias("content"),
    )
    open_groups = stored(
        labelled.join(mixed.where("low != high"), "group")
        .groupBy(F.xxhash64("members", "content").alias("group"), "set", "size", "component")
        .agg((F.col("size") - F.min("skip")).alias("left")),
        "open_groups",
    )
    kept = ("set", "size", "component", "left")
    one = open_groups.select("group", *[F.col(c).alias(f"{c}_a") for c in kept])
    two = open_groups.select("group", *[F.col(c).alias(f"{c}_b") for c in kept])
    both = F.col("size_a") + F.col("size_b")
    across = (
        one.join(two, "group")
        .where("component_a < component_b")
        .where(100 * F.least("size_a", "size_b") >= SIMILAR * F.greatest("size_a", "size_b"))
        .where((100 + SIMILAR) * F.least("left_a", "left_b") >= SIMILAR * both)
        .select(F.least("set_a", "set_b").alias("a"), F.greatest("set_a", "set_b").alias("b"))
        .distinct()
    )
    across = stored(_possible(across.join(maybe, ["a", "b"], "left_anti"), bits), "across")
    more = stored(_similar(across, texts), "links")
    if not more.isEmpty():
        found = stored(components(links.unionByName(more)), "components")
    named = members.join(found, members["set"] == found["node"], "left").select(
        "key",
        "doc_id",
        "set",
        "n",
        F.when(F.col("n") > 0, F.coalesce("component", "set")).alias("component"),
    )
    least = (
        named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    return named.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "set",
        "key",
        "component",
    )
