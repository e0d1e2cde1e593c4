"""Near-duplicates by SimHash fingerprints, found by ball hashing that meets in the middle.

Two fingerprints that differ in at most four bits share a variant that differs from either in at
most two. Every distinct fingerprint emits all its 2,081 variants of up to two flipped bits, and
they are shuffled by their leading bits: those of one fingerprint that agree in them travel as one
record and are spelled out where they arrive. So a group holds a range of the variants, and as the
number of leading bits follows from the number of fingerprints, its size does not grow. Where
fingerprints crowd, a group is cut bit by bit before its variants are made.

Fingerprints that share a variant are paired with the least of them, pairs are verified, and a
group sends no more links than it needs to keep its fingerprints connected.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import (
    joined_words,
    lower_ascii,
    mix,
    owners_of,
    pack,
    split_words,
    text_slices,
    unpack,
    whole_windows,
)
from .components import components
from .rows import group_batches, id_type, map_batches

SHINGLE = 4
SEED = 42
# Bits in which linked fingerprints differ at most: twice the radius of a ball.
BITS_APART = 4
RADIUS = BITS_APART // 2
WIDTH = 64
# Variants of a ball: with none, one or two of the 64 bits flipped.
BALL = 1 + WIDTH + WIDTH * (WIDTH - 1) // 2
# Variants a group holds on average, those that are spelled out at once, and records a task holds.
GROUP_VARIANTS = 1 << 20
AT_ONCE = 1 << 21
HELD = 1 << 21
_ONES = np.uint64(0x0101010101010101)
_SIEVE_BITS = 20


def fingerprints_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each text: bits set in over half of its shingles' hashes."""
    data = lower_ascii(data)
    starts, ends, bounds = split_words(data, offsets)
    flat, firsts = joined_words(data, starts, ends)
    n = np.diff(bounds)
    windows = whole_windows(bounds, SHINGLE)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    first = np.concatenate([windows, bounds[short]])
    last = np.concatenate([windows + SHINGLE, bounds[short + 1]])
    owner = np.concatenate([owners_of(bounds)[windows], short])
    order = np.argsort(owner, kind="stable")
    lows, highs = firsts[first[order]].tolist(), (firsts[last[order]] - 1).tolist()
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(raw[a:b], SEED) for a, b in zip(lows, highs, strict=True)], np.uint64)
    return majorities(hashes, np.searchsorted(owner[order], np.arange(len(n) + 1)))


def majorities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per run of hashes the bits that are set in over half of them; none of an empty run."""
    n = np.diff(bounds)
    made = np.zeros(len(n), np.uint64)
    own = np.flatnonzero(n)
    if not len(own):
        return made
    # eight counts of at most 255 are added up in one number
    pieces = -(-n[own] // 255)
    before = np.cumsum(pieces) - pieces
    within = np.arange(int(pieces.sum())) - np.repeat(before, pieces)
    first = np.repeat(bounds[own], pieces) + 255 * within
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _ONES, first)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), before)
        over = (2 * counts > n[own, None]).astype(np.uint64)
        made[own] |= (over << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(1, dtype=np.uint64)
    return made


def flips(bits: int, most: int = RADIUS) -> list[np.ndarray]:
    """Numbers with exactly 0, 1, .. `most` of their lowest `bits` bits set."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    low, high = np.triu_indices(bits, 1)
    return [np.zeros(1, np.uint64), one, one[low] | one[high]][: most + 1]


def leading_bits(fingerprints: int) -> int:
    """Leading bits of variants that make groups of about GROUP_VARIANTS."""
    groups = -(-fingerprints * BALL // GROUP_VARIANTS)
    return max(4, (groups - 1).bit_length())


def _connect(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a and b: each label is the place of a smaller or the same item."""
    while True:
        one, two = labels[a], labels[b]
        apart = one != two
        if not apart.any():
            return labels
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(further := labels[labels], labels):
            labels = further


def _collisions(low: np.ndarray, left: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in `low` that share a variant: of each variant's owners, the first and another.

    `left`: how many of the lowest `bits` bits of each number may still be flipped.
    """
    classes, owners, values = flips(bits), [], []
    for most in range(RADIUS + 1):
        own = np.flatnonzero(left == most)
        if len(own):
            masks = np.concatenate(classes[: most + 1])
            values.append((low[own][:, None] ^ masks[None, :]).reshape(-1))
            owners.append((own, len(masks)))
    every = np.concatenate(values)
    ordered = np.sort(every)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    none = np.zeros(0, np.int64)
    if not len(twice):
        return none, none
    del ordered
    twice = np.unique(twice)
    shift = np.uint64(64 - _SIEVE_BITS)
    sieve = np.zeros(1 << _SIEVE_BITS, bool)
    sieve[(mix(twice) >> shift).astype(np.int64)] = True
    found_values, found_owners = [], []
    for part, (own, count) in zip(values, owners, strict=True):
        hit = np.flatnonzero(sieve[(mix(part) >> shift).astype(np.int64)])
        value = part[hit]
        sure = twice[np.minimum(np.searchsorted(twice, value), len(twice) - 1)] == value
        found_values.append(value[sure])
        found_owners.append(own[hit[sure] // count])
    value, owner = np.concatenate(found_values), np.concatenate(found_owners)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    new = np.append(True, value[1:] != value[:-1])
    first = owner[np.flatnonzero(new)][np.cumsum(new) - 1]
    return first[~new], owner[~new]


def group_links(members: np.ndarray, group: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect members with a common variant whose `lead` leading bits are `group`.

    `members`: distinct fingerprints whose own leading bits are near enough, in order.
    """
    labels = np.arange(len(members))
    bits = WIDTH - lead
    leading = (members >> np.uint64(bits)) ^ np.uint64(group)
    left = RADIUS - np.bitwise_count(leading).astype(np.int64)
    waiting = [(np.arange(len(members)), left, bits)]
    while waiting:
        own, left, bits = waiting.pop()
        if len(own) < 2:
            continue
        counts = np.array([1, 1 + bits, 1 + bits + bits * (bits - 1) // 2])
        if bits and counts[left].sum() > AT_ONCE:
            bits -= 1
            upper = (members[own] >> np.uint64(bits)) & np.uint64(1)
            for value in (0, 1):
                rest = left - (upper != value)
                stay = rest >= 0
                waiting.append((own[stay], rest[stay], bits))
            continue
        low = members[own] & np.uint64((1 << bits) - 1)
        a, b = _collisions(low, left, bits)
        a, b = own[a], own[b]
        close = np.bitwise_count(members[a] ^ members[b]) <= BITS_APART
        labels = _connect(labels, a[close], b[close])
    linked = np.flatnonzero(labels != np.arange(len(members)))
    return members[linked], members[labels[linked]]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint, 64 bits as a long, of every row; zero without words."""

    def job(batches) -> Iterator[dict]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                made = fingerprints_of(data, offsets)
                yield {
                    "doc_id": batch.column(0).slice(low, high - low),
                    "fingerprint": made.view(np.int64),
                }

    given = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    return map_batches(given, job, f"doc_id {id_type(docs, id_column)}, fingerprint long")


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """a, b: links that connect just the fingerprints that pairs of at most 4 differing bits connect.

    `distinct`: a column `fingerprint` without repeats.
    """
    lead = leading_bits(distinct.count())
    bits = np.uint64(WIDTH - lead)
    near = np.concatenate(flips(lead))

    def emit(batches) -> Iterator[dict]:
        held, size = [], 0
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for low in range(0, len(own), max(1, HELD // len(near))):
                some = own[low : low + max(1, HELD // len(near))]
                groups = ((some >> bits)[:, None] ^ near[None, :]).reshape(-1)
                held.append((groups, np.repeat(some, len(near))))
                size += len(groups)
                if size >= HELD:
                    yield hand_on(held)
                    held, size = [], 0
        if held:
            yield hand_on(held)

    def hand_on(held) -> dict:
        groups, members = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((members, groups))
        groups, members = groups[order], members[order]
        starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
        ends = np.append(starts[1:], len(groups))
        packed = [pack(members[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return {"group": groups[starts].astype(np.int64), "members": packed}

    def meet(table: pa.Table) -> Iterator[dict]:
        members = np.unique(np.concatenate([unpack(v.as_py())[0] for v in table.column("members")]))
        a, b = group_links(members, table.column("group")[0].as_py(), lead)
        yield {"a": a.view(np.int64), "b": b.view(np.int64)}

    sent = map_batches(distinct.select("fingerprint"), emit, "group long, members binary")
    return group_batches(sent, "group", meet, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Rows link when their fingerprints differ in at most four bits; a component is named by the
    least doc_id in it. A shingle is four words joined by a space, a shorter text is one shingle,
    repeated shingles count each. Null and empty texts, and those without words, have fingerprint
    zero and link like any other. Repeated rows count each. A null id stays and is never the least,
    unless all ids of a component are null. Other columns are left out; an empty table gives none.
    """
    rows = stored(fingerprints(docs, id_column, text), "fingerprints")
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    links = stored(fingerprint_links(distinct), "links")
    found = components(links)
    named = stored(
        distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
            "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
        ),
        "named",
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "component").select("fingerprint", "component_id")
    return rows.join(ids, "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )
