"""Toxicity of texts after noisy-channel deobfuscation.

Tokens with digits or signs among letters, with letters repeated three times or more, and runs of
single letters are read as a lattice: each sign may stand for letters, a run for one or two, a
separator for nothing. A Viterbi search under a character trigram model takes the likeliest
reading. Words of the restored text are then scored with weights learned from labels.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import lower_ascii, mix, owners_of, span_hashes, symbols, text_slices
from .rows import group_batches, id_type, map_batches

# Labelled rows at most that the classifier is fitted on, and word weights at most.
SAMPLE = 20_000
WEIGHTS = 50_000
# Rows that must have a word, and standard errors its log odds must be away from none.
LEAST_ROWS = 5
LEAST_ERRORS = 4.0

# What a sign may stand for: fixed values.
READINGS = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
}
_SIGNS = "".join(map(re.escape, READINGS))
_BREAKS = r".\-_*~'`·"
# Signs that stand for a letter at the end of a word too; others are punctuation there.
_LAST = "0123456789$@("
_ENDS = "".join(re.escape(sign) for sign in READINGS if sign != "!")
# Signs among letters or after them, or single letters between breaks; a last "!" is left out.
_SUSPICIOUS = re.compile(
    rf"(?<![A-Za-z{_SIGNS}])(?:"
    rf"(?:[A-Za-z]+(?:[{_SIGNS}]+[A-Za-z]|[{_SIGNS}]*[{_LAST}])"
    rf"|[{_SIGNS}]{{1,3}}[A-Za-z]+[{_SIGNS}]*[A-Za-z{_LAST}])(?:[A-Za-z{_SIGNS}]*[A-Za-z{_ENDS}])?"
    rf"|[A-Za-z{_SIGNS}](?:[ {_BREAKS}][A-Za-z{_SIGNS}](?![A-Za-z{_SIGNS}])){{2,}}"
    rf"|[A-Za-z]{{1,8}}(?:[{_BREAKS}][A-Za-z{_SIGNS}]{{1,8}}){{2,}}"
    r")"
)
_THRICE = re.compile(r"([A-Za-z])\1\1")
_WORD = re.compile(r"[A-Za-z]{3,}")
_BREAK = re.compile(rf"[ {_BREAKS}]+")

# Letters of the character model: a border, a to z, and all others as one.
_LETTERS = 28
_OTHER = 27
_CODE = np.zeros(256, np.int64)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0x80:] = _OTHER


def letter_words(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and bounds by text of runs of letters in lower-cased bytes."""
    inside = np.concatenate([[False], _CODE[data] > 0, [False]])
    begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    begins[borders] = inside[1:-1][borders]
    borders = offsets[1:][offsets[1:] > 0] - 1
    stops[borders] = inside[1:-1][borders]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def trigram_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Codes of the letter trigrams of words with a border on both sides."""
    lengths = ends - starts
    padded = np.zeros(int(lengths.sum()) + 3 * len(starts), np.int64)
    before = np.cumsum(lengths) - lengths
    source = np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)
    place = np.arange(int(lengths.sum())) + np.repeat(3 * np.arange(len(starts)) + 2, lengths)
    padded[place] = _CODE[data[source]]
    codes = (padded[:-2] * _LETTERS + padded[1:-1]) * _LETTERS + padded[2:]
    keep = np.ones(len(codes), bool)
    last = before + 3 * np.arange(len(starts)) + 2 + lengths
    for i in range(2):
        keep[last[:-1] - 1 + i] = False
    return codes[keep]


def count_trigrams(texts: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all rows; a fixed number of them."""

    def job(batches):
        counts = np.zeros(_LETTERS**3, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                data = lower_ascii(data)
                starts, ends, _ = letter_words(data, offsets)
                if len(starts):
                    counts += np.bincount(trigram_codes(data, starts, ends), minlength=len(counts))
        yield {"part": np.arange(_LETTERS), "counts": [c.tobytes() for c in counts.reshape(28, -1)]}

    def add_up(table: pa.Table) -> Iterator[dict]:
        vectors = [np.frombuffer(v.as_py(), np.int64) for v in table.column("counts")]
        yield {"part": [table.column("part")[0].as_py()], "counts": [sum(vectors).tobytes()]}

    schema = "part int, counts binary"
    counts = np.zeros((_LETTERS, _LETTERS**2), np.int64)
    for row in group_batches(map_batches(texts, job, schema), "part", add_up, schema).collect():
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return counts.reshape(-1)


class Channel:
    """Restores texts under a character model given as trigram counts."""

    # Cost of reading a sign as a letter, of shortening a run or a pair, in nats.
    SIGN, RUN, PAIR = 0.5, 0.5, 3.0

    def __init__(self, counts: np.ndarray) -> None:
        cube = counts.reshape(_LETTERS, _LETTERS, _LETTERS).astype(float)
        pairs = cube.sum(0)
        pairs = (pairs + 0.1) / (pairs.sum(1, keepdims=True) + 0.1 * _LETTERS)
        cube = (cube + 2 * pairs[None]) / (cube.sum(2, keepdims=True) + 2)
        self._cost = (-np.log(cube)).tolist()
        self._known: dict[str, str] = {}

    def restore(self, text: str) -> str:
        """The text with its suspicious tokens replaced by their likeliest reading."""
        text = _SUSPICIOUS.sub(self._read, text)
        if _THRICE.search(text):
            text = _WORD.sub(self._read_repeated, text)
        return text

    def _read_repeated(self, match: re.Match) -> str:
        """A whole word, read anew if it has a letter three times in a row."""
        return self._read(match) if _THRICE.search(match.group()) else match.group()

    def _read(self, match: re.Match) -> str:
        token = match.group()
        if token not in self._known:
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[token] = self.decode(token)
        return self._known[token]

    def decode(self, token: str) -> str:
        """Viterbi over (last two letters); every letter or sign of the token is consumed."""
        joined = _BREAK.sub("", token.lower())
        runs = [(m.group(1), len(m.group())) for m in re.finditer(r"(.)\1*", joined, re.DOTALL)]
        # what was written is a chain of its parts, so that a long token takes no more per symbol
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for symbol, length in runs:
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            letters = READINGS.get(symbol, symbol)
            extra = self.SIGN if symbol in READINGS else 0.0
            for times in (1, 2) if length > 1 else (1,):
                paid = extra * times + (self.RUN if length > 2 else self.PAIR * (length - times))
                for state, (cost, written) in best.items():
                    for letter in letters:
                        (a, b), c = state, ord(letter) - 96 if "a" <= letter <= "z" else _OTHER
                        total = cost + paid
                        for _ in range(times):
                            total += self._cost[a][b][c]
                            a, b = b, c
                        if (a, b) not in after or total < after[a, b][0]:
                            after[a, b] = (total, (written, letter * times))
            best = after
        ends = [(cost + self._cost[a][b][0], written) for (a, b), (cost, written) in best.items()]
        least = min(cost for cost, _ in ends)
        return min(_written(parts) for cost, parts in ends if cost == least)


def _written(chain: tuple) -> str:
    parts = []
    while chain:
        chain, part = chain
        parts.append(part)
    return "".join(reversed(parts))


_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[b for sign in READINGS for b in sign.encode()[-1:]]] = True
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[ord(b) for b in " .-_*~'`"] + ["·".encode()[-1]]] = True
_IS_ASCII_LETTER = (_CODE > 0) & (_CODE < _OTHER)
_IS_ASCII_SIGN = _IS_SIGN.copy()
_IS_ASCII_SIGN[0x80:] = False
# Bytes of a sign or letter by its first, and of a break by its last.
_BYTES = np.ones(256, np.int64)
_BYTES[["£".encode()[0], "€".encode()[0]]] = 2, 3
_BREAK_BYTES = np.ones(256, np.int64)
_BREAK_BYTES["·".encode()[-1]] = 2
# Most bytes from the last of a break to the last of the next with up to eight signs between.
_APART = 8 * 3 + 2


def suspicious_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions, in lower-cased bytes, one at least in every line that has a suspicious token."""
    letter = _IS_ASCII_LETTER[data]
    sign = _IS_ASCII_SIGN[data]
    for long in (s.encode() for s in READINGS if len(s.encode()) > 1):
        sign[:-1] |= (data[:-1] == long[0]) & (data[1:] == long[1])
    beside = np.flatnonzero(_IS_SIGN[data[:-1]] & letter[1:])
    # a sign after a letter, but an exclamation mark only if one more sign follows
    ended = np.flatnonzero(letter[:-1] & sign[1:] & (data[1:] != ord("!")))
    marked = np.flatnonzero(letter[:-2] & (data[1:-1] == ord("!")) & sign[2:])
    thrice = np.flatnonzero((data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & letter[2:])
    # breaks before a letter or sign, twice in a row with one of these between, or more if tight
    joint = np.flatnonzero(_IS_BREAK[data[:-1]] & (letter | sign)[1:])
    single = joint[:-1][np.diff(joint) <= _BYTES[data[joint[:-1] + 1]] + _BREAK_BYTES[data[joint[1:]]]]
    tight = joint[data[joint] != 32]
    tight = tight[:-1][np.diff(tight) <= _APART]
    return np.unique(np.concatenate([beside, ended, marked, thrice, single, tight]))


def restored_slices(column, channel: Channel) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As text_slices, of restored and lower-cased texts; only lines that need it are read."""
    for low, high, data, offsets in text_slices(column):
        lowered = lower_ascii(data)
        places = suspicious_places(lowered, offsets)
        borders = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
        kept, parts, at, ends, shifts = data, [], 0, [], []
        raw = data.tobytes()
        for line in np.unique(np.searchsorted(borders, places, "right") - 1):
            a, b = int(borders[line]), int(borders[line + 1])
            new = channel.restore(raw[a:b].decode()).encode()
            if new != raw[a:b]:
                parts += [raw[at:a], new]
                at = b
                ends.append(b)
                shifts.append(len(new) - (b - a))
        if ends:
            kept = np.frombuffer(b"".join([*parts, raw[at:]]), np.uint8)
            moved = np.append(0, np.cumsum(shifts))
            offsets = offsets + moved[np.searchsorted(np.array(ends), offsets, "right")]
        yield low, high, lower_ascii(kept), offsets


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of each distinct word of each text."""
    starts, ends, bounds = letter_words(data, offsets)
    words, owner = span_hashes(symbols(data), starts, ends), owners_of(bounds)
    _, first = np.unique(words ^ mix(owner.astype(np.uint64) + 1), return_index=True)
    return words[first], owner[first]


def _word_weights(rows: DataFrame, channel: Channel) -> tuple[np.ndarray, np.ndarray]:
    """Words whose log odds differ, and these; from the labelled rows."""

    def job(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, data, offsets in restored_slices(batch.column(0), channel):
                words, owner = word_rows(data, offsets)
                toxic = label[low:high][owner]
                keys, place = np.unique(words, return_inverse=True)
                yield {
                    "word": keys.view(np.int64),
                    "toxic": np.bincount(place, toxic, len(keys)).astype(np.int64),
                    "n": np.bincount(place, minlength=len(keys)),
                }

    totals = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, toxic = int(totals[0]), int(totals[1] or 0)
    if toxic in (0, n):
        return np.empty(0, np.uint64), np.empty(0)
    counted = map_batches(rows.select("text", "label"), job, "word long, toxic long, n long")
    summed = counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    a, b = F.col("toxic") + 0.5, F.col("n") - F.col("toxic") + 0.5
    odds = F.log(a / (toxic - F.col("toxic") + 0.5)) - F.log(b / (n - toxic - F.col("n") + F.col("toxic") + 0.5))
    error = F.sqrt(1 / a + 1 / b)
    kept = (
        summed.where(F.col("n") >= LEAST_ROWS)
        .select("word", odds.alias("odds"), error.alias("error"))
        .where(F.abs("odds") > LEAST_ERRORS * F.col("error"))
        .orderBy(F.desc(F.abs("odds") / F.col("error")), "word")
        .limit(WEIGHTS)
        .toPandas()
        .sort_values("word", key=lambda s: s.to_numpy(np.int64).view(np.uint64))
    )
    return kept["word"].to_numpy(np.int64).view(np.uint64), kept["odds"].to_numpy(float)


def _sums(data, offsets, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per text the sum of the weights of its distinct words."""
    if not len(words):
        return np.zeros(len(offsets) - 1)
    starts, ends, bounds = letter_words(data, offsets)
    hashes = span_hashes(symbols(data), starts, ends)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = np.flatnonzero(words[at] == hashes)
    pairs = np.unique(owners_of(bounds)[hit] * len(words) + at[hit])
    return np.bincount(pairs // len(words), weights[pairs % len(words)], len(offsets) - 1)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, a little drawn to zero; by Newton's method."""
    if not len(y):
        return 0.0, 0.0
    design = np.stack([np.ones(len(x)), x], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 0.01 * beta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, score, predicted and carried columns of every row.

    `held_out`: an expression over doc_id; labels of ids where it is true are not used. Of the
    other labelled ids the `sample` with the least hash fit the word weights and the scale, of an
    id with several rows the one with the least sum of weights fits the scale; the
    character model counts every row's text. Only the text enters a score. Null and empty texts
    get the score of a text without telling words; without labels of both kinds every row gets
    the share of label 1. A repeated id gets its label on each row; `carried` names columns
    to keep, others are left out; an empty table gives none.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~F.coalesce(held_out, F.lit(True)))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    channel = Channel(count_trigrams(rows.select("text")))
    labelled = rows.join(F.broadcast(known), "doc_id").select("text", "label", "doc_id")
    words, weights = _word_weights(labelled, channel)
    shared = docs.sparkSession.sparkContext.broadcast((channel, words, weights))

    def measure(batches):
        for batch in batches:
            for low, high, data, offsets in restored_slices(batch.column(0), shared.value[0]):
                yield {
                    "x": _sums(data, offsets, *shared.value[1:]),
                    "label": batch.column(1).slice(low, high - low),
                    "doc_id": batch.column(2).slice(low, high - low),
                }

    # of an id with several rows one, so that no more rows come to the driver than ids were sampled
    measured = map_batches(labelled, measure, f"x double, label int, doc_id {id_type(rows, 'doc_id')}")
    once = measured.groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("one"))
    fitted = once.select("one.*").toPandas().sort_values(["x", "label"])
    base, slope = fit_logistic(fitted["x"].to_numpy(float), fitted["label"].to_numpy(float))

    def judge(batches):
        for batch in batches:
            for low, high, data, offsets in restored_slices(batch.column(1), shared.value[0]):
                x = base + slope * _sums(data, offsets, *shared.value[1:])
                score = 1 / (1 + np.exp(-np.clip(x, -50, 50)))
                yield {
                    "doc_id": batch.column(0).slice(low, high - low),
                    "held_out": batch.column(2).slice(low, high - low),
                    "score": score,
                    "predicted": (score >= 0.5).astype(np.int32),
                } | {c: batch.column(c).slice(low, high - low) for c in kept}

    kept = [c for c in carried if c != "doc_id"]
    return map_batches(
        docs.select(
            docs[id_column].alias("doc_id"),
            docs[text].alias("_text"),
            F.coalesce(held_out, F.lit(False)).alias("_held_out"),
            *kept,
        ),
        judge,
        f"doc_id {id_type(docs, id_column)}, held_out boolean, score double, predicted int"
        + "".join(f", {c} {id_type(docs, c)}" for c in kept),
    )
