"""Eye control as a stream: decisions per frame and the halt rule."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.blinks import HALT_FRAMES
from ..operators.matrices import array_zone_counts, with_decision
from .keyed import with_state


def decisions(frames: DataFrame, pixels: str, rows: int, columns: int) -> DataFrame:
    """One action per frame, from the frame alone."""
    return with_decision(array_zone_counts(frames, pixels, rows, columns))


def halts(frames: DataFrame) -> DataFrame:
    """Halts over ``frames(stream, frame, dark)``: ``stream``, ``halt_frame``, ``late_frame``.

    The state store keeps, per stream, the last frame and the dark-free run that reaches it; a run
    that goes on in the next batch is joined to it. A frame that comes again, or after a later
    one has been seen, is returned as ``late_frame`` and changes no run.
    """
    stream = frames.schema["stream"].dataType.simpleString()

    def step(rows: pd.DataFrame, state: tuple | None):
        last, first, length = state if state is not None else (None, None, 0)
        rows = rows.sort_values("frame", kind="stable", ignore_index=True)
        new = ~rows["frame"].duplicated() if last is None else ~rows["frame"].duplicated() & (rows["frame"] > last)
        late, frame, dark = rows["frame"][~new], rows["frame"][new].to_numpy(), rows["dark"][new].to_numpy()
        if len(frame):
            clear = dark == 0
            goes_on = np.concatenate(([length > 0 and frame[0] == last + 1], clear[:-1] & (frame[1:] == frame[:-1] + 1)))
            place = np.arange(len(frame))
            begin = np.maximum.accumulate(np.where(clear & goes_on, -1, place))  # -1: the run began before this batch
            run = np.where(clear, place - begin + 1 + np.where(begin < 0, length - 1, 0), 0)
            halting = frame[run == HALT_FRAMES]
            opened = first if begin[-1] < 0 else frame[begin[-1]]
            state = (int(frame[-1]), int(opened) if run[-1] else None, int(run[-1]))
        else:
            halting = frame
        name = rows["stream"].iloc[0]
        found = pd.DataFrame({
            "stream": name, "halt_frame": pd.array([*halting.tolist(), *[None] * len(late)], "Int64"),
            "late_frame": pd.array([*[None] * len(halting), *late.tolist()], "Int64"),
        })
        return found, state

    rows = frames.select("stream", F.col("frame").cast("bigint").alias("frame"), F.col("dark").cast("bigint").alias("dark"))
    return with_state(rows, ["stream"], step, f"stream {stream}, halt_frame bigint, late_frame bigint", "last bigint, first bigint, length bigint")
