"""Code-point boundaries of a text as a set of byte offsets that answers "where does point k begin?".

The set is kept in the manner of Roaring bitmaps: offsets are divided by their upper 16 bits into
containers, and each container takes whichever of three forms is smallest. Running totals of the
containers' sizes lead to the container of the k-th offset, and a select inside it gives the offset.
"""

from __future__ import annotations

import numpy as np

SPAN_BITS = 16
SPAN = 1 << SPAN_BITS
_BITMAP_BYTES = SPAN // 8


class ArrayContainer:
    """Sorted 16-bit members."""

    kind = "array"

    def __init__(self, members: np.ndarray) -> None:
        self.members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.members[k])


class BitmapContainer:
    """One bit for each of 65,536 places, with the number of members before each word of 64."""

    kind = "bitmap"

    def __init__(self, members: np.ndarray) -> None:
        flags = np.zeros(SPAN, np.uint8)
        flags[members] = 1
        self.bits = np.packbits(flags, bitorder="little")
        counts = np.bitwise_count(self.bits.view(np.uint64))
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[8 * word : 8 * word + 8], bitorder="little"))
        return 64 * word + int(inside[k - self.before[word]])


class RunContainer:
    """Starts of runs of neighbouring members, with the number of members before each run."""

    kind = "run"

    def __init__(self, starts: np.ndarray, before: np.ndarray) -> None:
        self.starts, self.before = starts.astype(np.uint16), before

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def _container(members: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    breaks = np.flatnonzero(np.diff(members) != 1) + 1
    if 4 * (len(breaks) + 1) <= min(2 * len(members), _BITMAP_BYTES):
        before = np.concatenate([[0], breaks])
        return RunContainer(members[before], before)
    return ArrayContainer(members) if 2 * len(members) <= _BITMAP_BYTES else BitmapContainer(members)


class BoundarySet:
    """A set of offsets, given in ascending order."""

    def __init__(self, offsets: np.ndarray) -> None:
        upper = offsets >> SPAN_BITS
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(upper)) + 1, [len(offsets)]])
        self.keys = upper[cuts[:-1]] if len(offsets) else upper
        #: Members before each container, and in the end all of them.
        self.before = cuts if len(offsets) else cuts[:1]
        self.containers = [
            _container(offsets[lo:hi] & (SPAN - 1)) for lo, hi in zip(self.before[:-1], self.before[1:], strict=True)
        ]

    @classmethod
    def of_text(cls, data: np.ndarray) -> BoundarySet:
        """Where the code points of UTF-8 bytes begin, and where the last one ends."""
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        return cls(np.append(begins, len(data)))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << SPAN_BITS) + self.containers[at].select(k - int(self.before[at]))
