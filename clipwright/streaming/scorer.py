"""A stateful scorer over a stream: windows of frames that reach across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WINDOW = 5


def window_scores(frames: DataFrame, key: str, at: str, ident: str, value: str, window: int = WINDOW) -> DataFrame:
    """(key, ident, score): the mean of each ``window`` frames in a row, named by the last of them.

    The last ``window - 1`` frames of a key are its state, so the windows do not depend on where a batch ends. Within a
    batch frames are put in order of ``at``; batches must come in that order, as files of a recording do.
    """
    import numpy as np
    import pandas as pd

    out = f"{key} {frames.schema[key].dataType.simpleString()}, {ident} {frames.schema[ident].dataType.simpleString()}, score double"
    carry = "carry array<double>"

    def score(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values([at, ident])
        before = list(state.get[0]) if state.exists else []
        values = np.array([*before, *rows[value].astype(float)])
        state.update((values[-(window - 1):].tolist(),))
        if len(values) < window:
            return
        sums = np.convolve(values, np.ones(window), "valid") / window
        yield pd.DataFrame({key: k[0], ident: rows[ident].to_numpy()[len(rows) - len(sums):], "score": sums})

    return frames.groupBy(key).applyInPandasWithState(score, out, carry, "append", GroupStateTimeout.NoTimeout)
