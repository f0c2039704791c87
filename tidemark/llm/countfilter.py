"""Counts of many keys, rounded to a scale of powers, in a Bloom filter.

A count becomes its step on the scale, and a key of step q is entered q times, as (key, 1) to (key, q).
Asking for a count probes (key, 1), (key, 2), … until a probe misses: the last hit is the step. A stored
count is never understated; a key is overstated by a step with the filter's error rate, by two with
its square, and so on. Most keys of a corpus are rare and take one or two entries.
"""

from __future__ import annotations

import numpy as np

from .textarrays import U64, mix

_STEP_MULTIPLIER = 0xA0761D6478BD642F


def scale(base: float, top: int = 1 << 53) -> np.ndarray:
    """Least counts of the steps: 1, 2, … and, where that is farther, ``base`` times the one before."""
    steps = [1]
    while steps[-1] < top:
        steps.append(max(steps[-1] + 1, int(np.ceil(steps[-1] * base))))
    return np.array(steps, np.int64)


def steps_of(counts: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The step of each count, 0 for a count of 0."""
    return np.searchsorted(steps, counts, "right")


def middles(steps: np.ndarray) -> np.ndarray:
    """The count that each step stands for: 0, then the middle of what falls into it."""
    return np.concatenate([[0.0], (steps[:-1] + steps[1:] - 1) / 2, steps[-1:]])


class CountFilter:
    """A bit array of a fixed number of probes for each entry."""

    def __init__(self, data: bytes | np.ndarray, probes: int) -> None:
        self.data = np.frombuffer(data, np.uint8)
        self.size, self.probes = U64(8 * len(self.data)), probes

    @classmethod
    def build(cls, keys: np.ndarray, quanta: np.ndarray, bits: float, probes: int) -> CountFilter:
        """``keys``, each entered as often as ``quanta`` says, with ``bits`` of space for each entry."""
        size = 64 * max(1, int(np.ceil(int(quanta.sum()) * bits / 64)))
        flags = np.zeros(size, np.uint8)
        out = cls(np.zeros(size // 8, np.uint8), probes)
        step = 1
        while len(keys):
            start, stride = out._walk(keys, step)
            for i in range(probes):
                flags[out._place(start, stride, i)] = 1
            step += 1
            more = quanta >= step
            keys, quanta = keys[more], quanta[more]
        out.data = np.packbits(flags, bitorder="little")
        return out

    def _walk(self, keys: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        x = mix(keys ^ U64(step * _STEP_MULTIPLIER % (1 << 64)))
        return x >> U64(32), (x & U64(0xFFFFFFFF)) | U64(1)

    def _place(self, start: np.ndarray, stride: np.ndarray, i: int) -> np.ndarray:
        return (mix(start + U64(i + 1) * stride) % self.size).astype(np.int64)

    def _has(self, keys: np.ndarray, step: int) -> np.ndarray:
        """Numbers of the keys that are entered as (key, step), or look it."""
        start, stride = self._walk(keys, step)
        left = np.arange(len(keys))
        for i in range(self.probes):
            at = self._place(start[left], stride[left], i)
            left = left[(self.data[at >> 3] >> (at & 7)) & 1 == 1]
        return left

    def quanta(self, keys: np.ndarray, most: int) -> np.ndarray:
        """The step of each key, 0 if it is not there, ``most`` at the highest."""
        found = np.zeros(len(keys), np.uint8)
        left = np.arange(len(keys))
        for step in range(1, most + 1):
            left = left[self._has(keys[left], step)]
            if not len(left):
                break
            found[left] = step
        return found
