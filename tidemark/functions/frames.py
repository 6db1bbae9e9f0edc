"""Rows of sorted partitions, group by group, inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The key and the rows of each group of frames that are sorted by keys; one group at a time is held.

    A task works on its many groups in the batches that come, where a grouped map pays a call and a frame for each of them.
    """
    held: list[pd.DataFrame] = []
    now = None
    for frame in frames:
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(1)])
        for a, b in zip(starts, [*starts[1:], len(frame)]):
            key = tuple(values[a].tolist())
            if held and key != now:
                yield now, pd.concat(held) if len(held) > 1 else held[0]
                held = []
            now = key
            held.append(frame.iloc[a:b])
    if held:
        yield now, pd.concat(held) if len(held) > 1 else held[0]
