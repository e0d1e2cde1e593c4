"""Token counts by rank-synchronous array merging.

Pre-tokens are held as ragged arrays, one flat array of symbols and the bounds of its
sequences. In each step every sequence finds its pair of lowest rank and merges all places of
that pair; sequences without a pair leave. The surviving symbols are the tokens.
"""

import json
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from .arrays import text_slices
from .pieces import Remembered, text_pieces
from .rows import id_type, map_batches

# The tokenizer's own pre-token pattern, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NO_RANK = np.iinfo(np.int64).max


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class ArrayMerger:
    """Merge rules of a byte-level vocabulary file as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocabulary = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self._size = max(vocabulary.values()) + 1
        keys = left * self._size + right
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = order.astype(np.int64)
        self._merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self._bytes = np.array([vocabulary[c] for c in _byte_letters()], np.int64)
        self.specials = tuple(t["content"] for t in content["added_tokens"] if t["special"])
        self._pattern = regex.compile(PATTERN)

    def _pair_ranks(self, ids: np.ndarray, sequence: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each symbol but the last."""
        keys = ids[:-1] * self._size + ids[1:]
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        found = (self._keys[at] == keys) & (sequence[:-1] == sequence[1:])
        return np.where(found, self._ranks[at], _NO_RANK)

    def survivors(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence of bytes; no sequence may be empty."""
        ids = self._bytes[data]
        sequence = np.repeat(np.arange(len(lengths)), lengths)
        left = lengths.copy()
        while len(ids) > 1:
            ranks = np.append(self._pair_ranks(ids, sequence), _NO_RANK)
            starts = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
            sizes = np.diff(np.append(starts, len(ids)))
            lowest = np.minimum.reduceat(ranks, starts)
            busy = lowest < _NO_RANK
            if not busy.any():
                break
            hit = (ranks == np.repeat(lowest, sizes)) & (ranks < _NO_RANK)
            # of places that overlap, as in a run of one symbol, every other one merges
            places = np.flatnonzero(hit)
            follows = np.append(False, places[1:] == places[:-1] + 1)
            run_starts = np.maximum.accumulate(np.where(follows, 0, np.arange(len(places))))
            places = places[(np.arange(len(places)) - run_starts) % 2 == 0]
            ids[places] = self._merged[ranks[places]]
            np.subtract.at(left, sequence[places], 1)
            stay = np.repeat(busy, sizes)
            stay[places + 1] = False
            ids, sequence = ids[stay], sequence[stay]
        return left

    def counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece, special strings as one."""
        tokens = [
            [] if p in self.specials else [t.encode() for t in self._pattern.findall(p)]
            for p in pieces
        ]
        flat = [t for words in tokens for t in words]
        if not flat:
            return [int(p in self.specials) for p in pieces]
        data = np.frombuffer(b"".join(flat), np.uint8)
        left = self.survivors(data, np.array([len(t) for t in flat]))
        sums = np.append(0, np.cumsum(left))
        bounds = np.append(0, np.cumsum([len(words) for words in tokens]))
        counts = (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()
        return [c or int(p in self.specials) for p, c in zip(pieces, counts, strict=True)]


@lru_cache(maxsize=2)
def _remembered(path: str) -> tuple[ArrayMerger, Remembered]:
    merger = ArrayMerger(path)
    return merger, Remembered(merger.counts)


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, in one pass without a shuffle.

    `path`: a byte-level vocabulary file that every executor has. Special strings in a text
    count as one token. Null and empty texts: 0 and 0. A text's length is not bounded; it is
    held in one task with arrays of its new pieces. Repeated rows are counted each, a null id
    stays, other columns are left out.
    """

    def job(batches):
        merger, remembered = _remembered(path)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                raw = data.tobytes()
                texts = [
                    text_pieces(raw[a:b].decode(), merger.specials)
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                n = np.array([sum(counts) for counts in remembered.of(texts)], np.int64)
                yield {
                    "doc_id": batch.column(0).slice(low, high - low),
                    "n_bytes": np.diff(offsets),
                    "n_tokens": n,
                    "over_limit": n > limit,
                }

    return map_batches(
        docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text")),
        job,
        f"doc_id {id_type(docs, id_column)}, n_bytes long, n_tokens long, over_limit boolean",
    )
