"""Collocations: frequent phrases by how much more often their parts meet than by chance.

Frequent phrases are mined by partitioning. Documents are dealt to a few shards. A phrase that
occurs `least` times in a language has, in some shard, at least the share of them that the shard
has of the language's words; so each shard is mined completely at that local support, and the
union of the locally frequent phrases holds every frequent one. A second pass over the texts counts
the phrases of the union, and only these, by their text.

A shard is far more than a task can hold. It is cut into places, which count the hashes of all
their phrases and send them, packed, to the range of hashes they belong to; there a shard's counts
are complete. A hash that is locally frequent in any shard goes back to all places that have it.
Both the places' texts and the ranges are of a size that does not grow with the input. A chance
collision of hashes can only add a candidate, which the second pass counts by its text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import (
    compress_text,
    decompress_text,
    joined_words,
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
from .repeats import part_of, range_bounds
from .rows import cogroup_batches, group_batches, map_batches, partitions

LONGEST = 3
LEAST = 10
# A phrase goes if so many hundredths of its occurrences lie in one longer candidate.
INSIDE = 50
TOP = 2000
SHARDS = 3
# Bytes of text of a place, on average.
PLACE_BYTES = 8_000_000
_SIEVE_BITS = 22
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[[0x20, 0x09]] = True


class _Phrases:
    """The words of a slice of texts, and which of them stand in one piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = lower_ascii(data)
        self.starts, self.ends, bounds = split_words(data, offsets, _BETWEEN)
        self.data = data
        ends_before = np.cumsum(_ENDS[data])[self.starts]
        text = owners_of(bounds)
        new = (ends_before[1:] != ends_before[:-1]) | (text[1:] != text[:-1])
        firsts = np.flatnonzero(np.append(True, new)) if len(text) else np.zeros(0, np.int64)
        self.pieces = np.append(firsts, len(text))
        self.words = span_hashes(symbols(data), self.starts, self.ends)

    def hashed(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each phrase of `size` words, and its hash."""
        at = whole_windows(self.pieces, size)
        if size == 1:
            return at, mix(self.words[at])
        return at, rolling_hashes(self.words, size)[at]


class _Spelled:
    """All words of slices of texts, with a number for each different word."""

    def __init__(self, slices: list[_Phrases]) -> None:
        joined = [joined_words(p.data, p.starts, p.ends) for p in slices]
        words = [
            pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(firsts) - 1, [None, pa.py_buffer(firsts), pa.py_buffer(flat)]
            )
            for flat, firsts in joined
        ]
        coded = pa.chunked_array(words, pa.large_binary()).dictionary_encode().unify_dictionaries()
        self.numbers = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
        self.flat = np.concatenate([flat for flat, _ in joined])
        self.firsts = np.append(0, np.cumsum(np.concatenate([np.diff(firsts) for _, firsts in joined])))

    def distinct(
        self, at: np.ndarray, hashes: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of phrases in the order of their hashes: a first word and the hash of each text, and how often.

        Equal hashes are compared word by word.
        """
        if not len(at):
            return at, hashes, np.zeros(0, np.int64)
        same = np.append(False, hashes[1:] == hashes[:-1])
        words = np.stack([self.numbers[at + k] for k in range(size)])
        equal = np.append(False, (words[:, 1:] == words[:, :-1]).all(axis=0))
        if (same & ~equal).any():  # texts that share a hash
            order = np.lexsort((*words, hashes))
            at, hashes, words = at[order], hashes[order], words[:, order]
            equal = np.append(False, (words[:, 1:] == words[:, :-1]).all(axis=0))
        starts = np.flatnonzero(~equal)
        return at[starts], hashes[starts], np.diff(np.append(starts, len(at)))

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of `size` words from these words on, joined by one space."""
        low, high = self.firsts[at], self.firsts[at + size] - 1
        offsets = np.append(0, np.cumsum(high - low))
        spots = np.arange(int(offsets[-1])) + np.repeat(low - offsets[:-1], high - low)
        return pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(offsets), pa.py_buffer(self.flat[spots])
        )


def _by_language(table: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    for lang in pc.unique(table.column("lang")).to_pylist():
        yield lang, table.filter(pc.equal(table.column("lang"), lang))


def _dealt(docs: DataFrame, id_column: str, text: str, lang: str, places: int) -> DataFrame:
    """place, lang and text of every row; the place follows from id and text."""
    key = F.xxhash64(F.col(id_column).cast("string"), F.col(text))
    return docs.select(
        F.pmod(key, F.lit(places)).cast("int").alias("place"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def shard_words(rows: DataFrame) -> DataFrame:
    """lang, shard, words and bytes of all texts; rows: place, lang, text, a place being a shard."""

    def job(batches) -> Iterator[dict]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                _, _, bounds = split_words(data, offsets, _BETWEEN)
                yield {
                    "shard": batch.column(0).slice(low, high - low),
                    "lang": batch.column(1).slice(low, high - low),
                    "words": np.diff(bounds),
                    "bytes": np.diff(offsets),
                }

    made = map_batches(rows, job, "shard int, lang string, words long, bytes long")
    sums = [F.sum(c).alias(c) for c in ("words", "bytes")]
    return made.groupBy("lang", "shard").agg(*sums)


def _packed(by_language: list[tuple]) -> bytes:
    """Arrays of each language, of equal length in a language, as one blob."""
    lengths = np.array([len(arrays[0]) for _, *arrays in by_language])
    joined = [np.concatenate(column) for column in zip(*(arrays for _, *arrays in by_language), strict=True)]
    return pack(lengths, *joined)


def _unpacked(blob: bytes) -> Iterator[list[np.ndarray]]:
    """The arrays of each language."""
    lengths, *joined = unpack(blob)
    bounds = np.append(0, np.cumsum(lengths.astype(np.int64)))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield [values[low:high] for values in joined]


def _unpacked_by_language(langs: pa.ChunkedArray, blobs: pa.ChunkedArray) -> dict[str, list[tuple]]:
    """Of each language: the number of the blob, and its arrays there."""
    found: dict[str, list[tuple]] = {}
    for i, (names, blob) in enumerate(zip(langs.to_pylist(), blobs, strict=True)):
        for lang, arrays in zip(names, _unpacked(blob.as_py()), strict=True):
            found.setdefault(lang, []).append((i, *arrays))
    return found


def mined(rows: DataFrame, supports: DataFrame, parts: int, longest: int, least: int) -> DataFrame:
    """place, langs, found: the hashes of a place's phrases that are locally frequent in some shard.

    Without those that occur fewer than `least` times in all. rows: place, lang, text. supports: lang,
    shard, support.
    """

    def count(table: pa.Table) -> Iterator[dict]:
        place = table.column("place")[0].as_py()
        cut: list[list[tuple]] = [[] for _ in range(parts)]
        for lang, own in _by_language(table):
            hashes = [
                phrases.hashed(size)[1]
                for _, _, data, offsets in text_slices(own.column("text"))
                for phrases in (_Phrases(data, offsets),)
                for size in range(1, longest + 1)
            ]
            distinct, times = np.unique(np.concatenate(hashes), return_counts=True)
            del hashes
            bounds = range_bounds(distinct, parts)
            for p in np.flatnonzero(np.diff(bounds)):
                low, high = bounds[p], bounds[p + 1]
                cut[p].append((lang, distinct[low:high], times[low:high]))
        filled = [p for p in range(parts) if cut[p]]
        yield {
            "part": filled,
            "place": np.full(len(filled), place),
            "langs": [[lang for lang, *_ in cut[p]] for p in filled],
            "counted": [_packed(cut[p]) for p in filled],
        }

    def unite(counted: pa.Table, supports: pa.Table) -> Iterator[dict]:
        local = {(r["lang"], r["shard"]): r["support"] for r in supports.to_pylist()}
        places = counted.column("place").to_pylist()
        found: list[list[tuple]] = [[] for _ in places]
        by_language = _unpacked_by_language(counted.column("langs"), counted.column("counted"))
        for lang, blobs in by_language.items():
            frequent = []
            for shard in range(SHARDS):
                some = [b for i, *b in blobs if places[i] % SHARDS == shard]
                if some:
                    frequent.append(_frequent(some, local[lang, shard]))
            union = np.unique(np.concatenate(frequent))
            union = union[_members(union, _frequent([b for _, *b in blobs], least))]
            for i, hashes, _ in blobs:
                hit = _members(hashes, union)
                if hit.any():
                    found[i].append((lang, hashes[hit]))
        filled = [i for i in range(len(places)) if found[i]]
        yield {
            "place": [places[i] for i in filled],
            "langs": [[lang for lang, _ in found[i]] for i in filled],
            "found": [_packed(found[i]) for i in filled],
        }

    schema = "part int, place int, langs array<string>, counted binary"
    counted = group_batches(rows, "place", count, schema)
    return cogroup_batches(
        counted,
        supports.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))),
        "part",
        unite,
        "place int, langs array<string>, found binary",
    )


def _frequent(blobs: list[list[np.ndarray]], support: int) -> np.ndarray:
    """Hashes whose counts in these blobs reach the support."""
    hashes = np.concatenate([b[0] for b in blobs])
    times = np.concatenate([b[1] for b in blobs])
    order = np.argsort(hashes)
    hashes, times = hashes[order], times[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return hashes[starts][np.add.reduceat(times, starts) >= support]


def _members(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts one after another, and the bounds of each."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def _summed(pieces: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Each phrase once, and how often it occurs in all pieces of phrases and times."""
    coded = pa.concat_arrays([phrase for phrase, _ in pieces]).dictionary_encode()
    sums = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(sums, coded.indices.to_numpy(), np.concatenate([times for _, times in pieces]))
    return coded.dictionary, sums


def phrase_counts(
    rows: DataFrame, found: DataFrame, parts: int, longest: int, least: int
) -> DataFrame:
    """lang, size, phrase, a: how often each phrase whose hash was found occurs in all rows.

    Without phrases that occur fewer than `least` times.
    """

    def count(texts: pa.Table, found: pa.Table) -> Iterator[dict]:
        wanted = _unpacked_by_language(found.column("langs"), found.column("found"))
        shift = np.uint64(64 - _SIEVE_BITS)
        cut: list[list[tuple]] = [[] for _ in range(parts)]
        for lang, own in _by_language(texts):
            if lang not in wanted:
                continue
            union = np.sort(np.concatenate([hashes for _, hashes in wanted[lang]]))
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[(union >> shift).astype(np.int64)] = True
            slices = [_Phrases(data, offsets) for _, _, data, offsets in text_slices(own.column("text"))]
            bases = np.cumsum([0] + [len(p.starts) for p in slices])
            spelled = _Spelled(slices)
            seen: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
            for size in range(1, longest + 1):
                some = []
                for base, phrases in zip(bases[:-1], slices, strict=True):
                    at, hashes = phrases.hashed(size)
                    maybe = np.flatnonzero(sieve[(hashes >> shift).astype(np.int64)])
                    some.append((at[maybe] + base, hashes[maybe]))
                at, hashes = (np.concatenate(column) for column in zip(*some, strict=True))
                # sorted, they are looked up near each other
                order = np.argsort(hashes)
                at, hashes = at[order], hashes[order]
                hit = _members(hashes, union)
                at, hashes, times = spelled.distinct(at[hit], hashes[hit], size)
                seen.append((spelled.texts(at, size), hashes, times))
            phrase = pa.concat_arrays([texts for texts, _, _ in seen])
            hashes, times = (np.concatenate([s[i] for s in seen]) for i in (1, 2))
            part = part_of(hashes, parts)
            order = np.argsort(part, kind="stable")
            flat, bounds = _text_bytes(phrase.take(pa.array(order)))
            lengths, times = np.diff(bounds), times[order]
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)):
                low, high = ends[p], ends[p + 1]
                text = flat[bounds[low] : bounds[high]].tobytes()
                cut[p].append((lang, lengths[low:high], times[low:high], text))
        filled = [p for p in range(parts) if cut[p]]
        yield {
            "part": filled,
            "langs": [[lang for lang, *_ in cut[p]] for p in filled],
            "counted": [_packed([c[:3] for c in cut[p]]) for p in filled],
            "texts": [compress_text(b"".join(c[3] for c in cut[p])) for p in filled],
        }

    def total(counted: pa.Table) -> Iterator[dict]:
        texts = [decompress_text(t.as_py()) for t in counted.column("texts")]
        read = [0] * len(texts)
        by_language: dict[str, list[tuple]] = {}
        # the languages of a blob follow one another in its text
        for i, (langs, blob) in enumerate(
            zip(counted.column("langs").to_pylist(), counted.column("counted"), strict=True)
        ):
            for lang, (lengths, times) in zip(langs, _unpacked(blob.as_py()), strict=True):
                offsets = np.append(0, np.cumsum(lengths.astype(np.int64)))
                text = texts[i][read[i] : read[i] + int(offsets[-1])]
                read[i] += int(offsets[-1])
                phrase = pa.LargeStringArray.from_buffers(
                    len(lengths), pa.py_buffer(offsets), pa.py_buffer(text)
                )
                by_language.setdefault(lang, []).append((phrase, times.astype(np.int64)))
        for lang, pieces in by_language.items():
            phrase, sums = _summed(pieces)
            enough = sums >= least
            phrase = phrase.filter(pa.array(enough))
            yield {
                "lang": [lang] * len(phrase),
                "size": pc.add(pc.count_substring(phrase, " "), 1),
                "phrase": phrase,
                "a": sums[enough],
            }

    counted = cogroup_batches(
        rows, found, "place", count, "part int, langs array<string>, counted binary, texts binary"
    )
    return group_batches(counted, "part", total, "lang string, size int, phrase string, a long")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of every phrase of several words, by its worst cut.

    counts: lang, size, phrase, a, with all parts of each phrase. Products are exact up to 38 digits.
    """
    words = F.split("phrase", " ")
    cuts = (
        counts.where("size > 1")
        .withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
        .withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
        .withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "))
    )

    def part(side: str, out: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(out))

    score = F.expr(
        "(cast(1000000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(a as decimal(38,0)))"
        " div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))"
    )
    whole = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst")
    return (
        whole.groupBy("lang", "size", "phrase", "a")
        .agg(worst)
        .select("lang", "size", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )


def outside_longer(candidates: DataFrame, inside: int) -> DataFrame:
    """Candidates without those that occur in one longer candidate `inside` hundredths of the time."""
    words = F.split("phrase", " ")
    shorter = (
        candidates.where("size > 2")
        .withColumn("width", F.explode(F.expr("sequence(2, size - 1)")))
        .withColumn("first", F.explode(F.expr("sequence(1, size - width + 1)")))
        .select("lang", F.array_join(F.slice(words, F.col("first"), F.col("width")), " ").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    held = candidates.join(shorter, ["lang", "phrase"], "left")
    return held.where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))
    ).drop("longer")


def collocations(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    longest: int = LONGEST,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `longest` words per language.

    Words are lower-cased in A-Z and separated by spaces and tabs; phrases do not cross
    .,;:!?, line ends or texts. a, l, r: occurrences of the phrase, and of its parts before and
    after its worst cut; n: words of the language. Ties of the score go to the larger a, then to
    the phrase first in byte order. A null language is `und`, the same as that name; null and empty
    texts have no words. Repeated rows count each, null ids too; other columns are left out; an
    empty table, or one without frequent phrases, gives no row.
    """
    spark = docs.sparkSession
    words = stored(shard_words(_dealt(docs, id_column, text, lang, SHARDS)), "words")
    size = words.agg(F.sum("bytes")).first()[0] or 0
    places = SHARDS * max(1, -(-max(partitions(spark), size // PLACE_BYTES) // SHARDS))
    totals = words.groupBy("lang").agg(F.sum("words").alias("n"))
    # the share of a shard, rounded up; at least one occurrence
    support = F.greatest(F.lit(1), F.expr(f"({least} * words + n - 1) div greatest(n, 1)"))
    supports = words.join(totals, "lang").select("lang", "shard", support.alias("support"))
    rows = _dealt(docs, id_column, text, lang, places)
    found = mined(rows, stored(supports, "supports"), places, longest, least)
    counts = stored(phrase_counts(rows, found, places, longest, least), "counts")
    candidates = stored(scored(counts), "candidates")
    left = outside_longer(candidates, INSIDE).withColumn(
        "_salt", F.pmod(F.xxhash64("phrase"), F.lit(partitions(spark)))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each salt first, so that no task ranks all phrases of a language
    for keys in (["lang", "_salt"], ["lang"]):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        left = left.withColumn("rank", number.cast("bigint")).where(F.col("rank") <= top)
    return left.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
