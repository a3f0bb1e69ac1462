"""Walking an automaton over many texts at once.

The codes of all texts of a slice are cut into segments of equal length, laid side by side
in a matrix, and stepped through together: step t looks up the t-th code of every segment in
one array operation. A long text is many segments, so it costs no more than many short ones.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 256


class Segments:
    """Segments of the code runs codes[bounds[i]:bounds[i + 1]].

    `lead` codes before each segment (of the same run) stand in the first `lead` rows of the
    matrix, so that a walk can find its state; before the start of a run they are `start`.
    Places past the end of a run hold `pad`.
    """

    def __init__(self, codes, bounds, pad: int, lead: int = 0, start: int = 0, length: int = SEGMENT):
        lengths = np.diff(bounds)
        parts = (lengths + length - 1) // length
        self.owner = np.repeat(np.arange(len(lengths)), parts)
        first = np.concatenate(([0], np.cumsum(parts)))[:-1]
        number = np.arange(len(self.owner)) - first[self.owner]
        begin = bounds[:-1][self.owner] + number * length
        end = np.minimum(begin + length, bounds[1:][self.owner])
        places = begin[None, :] + np.arange(-lead, length)[:, None]
        self.lead, self.runs = lead, len(lengths)
        if len(self.owner):
            matrix = codes[np.clip(places, 0, len(codes) - 1)]
            matrix[places >= end[None, :]] = pad
            matrix[places < bounds[:-1][self.owner][None, :]] = start
        else:
            matrix = np.empty((length + lead, 0), dtype=codes.dtype)
        self.matrix = matrix

    def per_run(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per segment over the segments of each run."""
        return np.bincount(self.owner, weights=values, minlength=self.runs)
