"""Quality rules: base measures and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted, one over documents with a trusted label,
one over all documents. A document's score is the mean log ratio of its n-grams; its verdict
compares the score with one threshold for all.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import stored
from .arrays import (
    covered,
    mix,
    owners_of,
    rolling_hashes,
    span_hashes,
    split_words,
    symbols,
    text_slices,
    whole_windows,
)
from .rows import group_batches, id_type, map_batches, partitions

# Bytes of an n-gram, number of hash buckets, and parts the counts are added up in.
WIDTH = 4
BUCKETS = 1 << 17
PARTS = 32
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def base_measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows."""

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, bounds = split_words(data, offsets)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    np.subtract.at(in_word, ends, 1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8) > 0
    values = symbols(data)

    breaks = data == 10
    borders = np.unique(np.concatenate([offsets, np.flatnonzero(breaks) + 1]))
    line_starts, line_ends = borders[:-1], borders[1:].copy()
    line_ends -= breaks[line_ends - 1] if len(line_ends) else 0
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    lines = span_hashes(values, line_starts, line_ends) ^ mix(line_owner.astype(np.uint64) + 1)
    _, first = np.unique(lines, return_index=True)
    again = np.ones(len(lines), bool)
    again[first] = False
    texts = len(offsets) - 1

    words = span_hashes(values, starts, ends)
    windows = whole_windows(bounds, 3)
    owner = owners_of(bounds)
    grams = rolling_hashes(words, 3)[windows] ^ mix(owner[windows].astype(np.uint64) + 1)
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    repeated = np.zeros(len(grams), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    hit = covered(windows[repeated], 3, len(words))
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_text(in_word & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_owner[again], minlength=texts),
        "n_repeat_words": np.bincount(owner[hit], minlength=texts),
    }


def ngram_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte."""
    if len(data) < WIDTH:
        return np.empty(0, np.int64)
    n = len(data) - WIDTH + 1
    gram = np.zeros(n, np.uint32)
    for i in range(WIDTH):
        gram = (gram << np.uint32(8)) | data[i : i + n]
    gram = gram * np.uint32(2654435761)
    return (gram >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _add_up(table: pa.Table):
    vectors = [np.frombuffer(v.as_py(), np.int64) for v in table.column("counts")]
    yield {"part": [table.column("part")[0].as_py()], "counts": [sum(vectors).tobytes()]}


def ngram_counts(docs: DataFrame) -> np.ndarray:
    """Counts by bucket over all rows (first) and over those with `trusted` (second)."""
    schema = "part int, counts binary"

    def job(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            trusted = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_slices(batch.column(0)):
                buckets = ngram_buckets(data)
                windows = whole_windows(offsets, WIDTH)
                good = np.repeat(
                    trusted[low:high], np.maximum(np.diff(offsets) - WIDTH + 1, 0)
                )
                own = buckets[windows]
                counts[0] += np.bincount(own, minlength=BUCKETS)
                counts[1] += np.bincount(own[good], minlength=BUCKETS)
        parts = counts.reshape(2, PARTS, -1).transpose(1, 0, 2)
        yield {"part": np.arange(PARTS), "counts": [p.tobytes() for p in parts]}

    vectors = map_batches(docs.select("text", "trusted"), job, schema)
    parts = group_batches(vectors, "part", _add_up, schema).collect()
    counts = np.zeros((PARTS, 2, BUCKETS // PARTS), np.int64)
    for row in parts:
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64).reshape(2, -1)
    return counts.transpose(1, 0, 2).reshape(2, -1)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket, each smoothed by one half."""
    raw, target = counts + 0.5
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def mean_ratios(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Per text the mean log ratio of its n-grams; 0 for a text without any."""
    sums = np.append(0.0, np.cumsum(ratios[ngram_buckets(data)], dtype=np.float64))
    n = np.maximum(np.diff(offsets) - WIDTH + 1, 0)
    last = np.minimum(offsets[:-1] + n, len(sums) - 1)
    return (sums[last] - sums[np.minimum(offsets[:-1], last)]) / np.maximum(n, 1)


def best_threshold(scored: DataFrame) -> float:
    """Where the shares of good rows below and of other rows above are least in sum.

    `scored`: score and good of all labelled rows. Rows of a score are counted before they are
    dealt by ranges of the score; the driver gets one row of each range.
    """
    good, other = (F.sum(c.cast("bigint")) for c in (F.col("good"), ~F.col("good")))
    counts = scored.groupBy("score").agg(good.alias("good"), other.alias("other"))
    ranged = counts.repartitionByRange(partitions(scored.sparkSession), "score")
    # stored, as the borders come from a sample and must not change between the two passes
    ranged = stored(ranged.withColumn("slice", F.spark_partition_id()), "score_counts")
    sums = [F.sum("good").alias("good"), F.sum("other").alias("other"), F.min("score").alias("least")]
    slices = ranged.groupBy("slice").agg(*sums).orderBy("slice").collect()
    n_good, n_other = (sum(r[c] for r in slices) for c in ("good", "other"))
    if not n_good or not n_other:
        return -np.inf
    before, below = [], [0, 0]
    for r, after in zip(slices, [*slices[1:], None], strict=True):
        before.append((r["slice"], *below, after and after["least"]))
        below = [below[0] + r["good"], below[1] + r["other"]]
    schema = "slice int, good_before long, other_before long, next_slice double"
    known = scored.sparkSession.createDataFrame(before, schema)
    inside = Window.partitionBy("slice").orderBy("score")
    wrong = (F.col("good_before") + F.sum("good").over(inside)) / F.lit(float(n_good)) - (
        F.col("other_before") + F.sum("other").over(inside)
    ) / F.lit(float(n_other))
    cuts = ranged.join(F.broadcast(known), "slice").select(
        wrong.alias("wrong"),
        "score",
        F.coalesce(F.lead("score").over(inside), "next_slice").alias("next"),
    )
    best = cuts.agg(F.min(F.struct("wrong", "score", "next")).alias("cut")).first()["cut"]
    return (best["score"] + best["next"]) / 2 if best["wrong"] < 0 else -np.inf


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int | None = None,
) -> DataFrame:
    """doc_id, base measures, base_failed, score and kept of every row.

    `labels`: doc_id and a label, 1 for trusted documents. The target counts cover every trusted
    row, the raw counts every row, and the threshold every labelled row; with `sample` only those
    of so many labelled ids with the least hash. Null and empty texts have no words, score 0 and
    fail the base rule; without usable labels only the base rule decides. A repeated id gets its
    label on each row. Other columns are left out; an empty table gives none.

    Texts meet the labels in one merge join at any size, so that what is shuffled grows with them.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
        .where("_label IS NOT NULL")
    )
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    # rows without an id have no label and would all meet in one task
    named, unnamed = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    trusted = known.where("_label = 1").select("_id").hint("merge")
    marked = named.join(trusted, F.col("doc_id") == F.col("_id"), "left").select(
        "text", F.col("_id").isNotNull().alias("trusted")
    )
    marked = marked.unionByName(unnamed.select("text", F.lit(False).alias("trusted")))
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(ngram_counts(marked)))

    def judge(batches):
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                measures = base_measures(data, offsets)
                n = measures["n_words"]
                yield measures | {
                    "doc_id": batch.column(0).slice(low, high - low),
                    "base_failed": (n < 50) | (100 * measures["n_repeat_words"] > 50 * n),
                    "score": mean_ratios(data, offsets, shared.value),
                }

    judged = map_batches(
        rows,
        judge,
        f"doc_id {id_type(docs, id_column)}, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, base_failed boolean, score double",
    )
    judged = stored(judged, "judged")
    if sample is not None:
        known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    scored = judged.join(known.hint("merge"), F.col("doc_id") == F.col("_id")).select(
        "score", (F.col("_label") == 1).alias("good")
    )
    threshold = best_threshold(scored)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))
