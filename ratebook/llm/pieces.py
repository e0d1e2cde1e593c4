"""Texts as cached pieces, for byte-level tokenizers whose words take one leading space.

Such a tokenizer's own words never cross a place where a space is followed by something
that is not white space, so what it makes of a text is joined from what it makes of the
pieces between those places; a piece that comes again is looked up.
"""

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np

# Unicode's White_Space.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE_AFTER_SPACE = re.compile(f" (?:[{_WHITE}]|$)")
_PLACES = re.compile(f"(?= [^{_WHITE}])")
# Pieces remembered in a Python worker, and the longest that is.
REMEMBERED = 800_000
LONGEST = 64


def text_pieces(text: str, specials: tuple[str, ...]) -> list[str]:
    """The pieces of a text, special strings as their own."""
    if specials and any(s in text for s in specials):
        cut = re.split("(" + "|".join(map(re.escape, specials)) + ")", text)
        return list(
            chain.from_iterable([p] if p in specials else text_pieces(p, ()) for p in cut if p)
        )
    if _WHITE_AFTER_SPACE.search(text):
        return [p for p in _PLACES.split(text) if p]
    first, *rest = text.split(" ")
    return [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]


# First bytes that no cut is made before: ASCII white space, and those of other white space, which
# other characters share. A place that is left out only makes a longer piece.
NO_CUT = np.zeros(256, bool)
NO_CUT[[0x20, *range(0x09, 0x0E), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the texts begin in their bytes, and per text its first piece.

    The second array has one more entry, the number of pieces.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[: max(len(data) - 1, 0)] = (data[:-1] == 0x20) & ~NO_CUT[data[1:]]
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.searchsorted(starts, offsets)


class Remembered:
    """Results of pieces; `solve` makes those of a list of new pieces."""

    def __init__(self, solve: Callable[[list[str]], list]) -> None:
        self._solve = solve
        self._known: dict = {}

    def of(self, texts: list[list[str]]) -> Iterator[Iterator]:
        """Per text the results of its pieces."""
        if len(self._known) > REMEMBERED:
            self._known.clear()
        new = list(set(chain.from_iterable(texts)).difference(self._known))
        self._known.update(zip(new, self._solve(new), strict=True))
        look_up = self._known.__getitem__
        for pieces in texts:
            yield map(look_up, pieces)
        for piece in new:
            if len(piece) > LONGEST:
                del self._known[piece]
