"""Temporal state over an unbounded stream of prompts or masks.

The batch fold (``orbiscope.operators.tracking``) and the streams here share their
state machines.  A stream delivers frames of a sequence in order, one or several
per micro-batch; the state of each (sequence, face) is kept by Spark and holds
only what later frames can still reach.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orbiscope.config import Config
from orbiscope.operators.tracking import PROMPT_OUT, TRACK_OUT, MaskMemory, Track, Tracker, box_of

STATE = "state string"


def _by_frame(pdfs: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[dict]]]:
    rows = pd.concat(list(pdfs)).sort_values(["frame_idx", "prompt_idx"])
    for frame, of_frame in rows.groupby("frame_idx", sort=True):
        yield int(frame), of_frame.to_dict("records")


def _track(config: Config):
    columns = [c.split()[0] for c in TRACK_OUT.split(", ")]

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker = Tracker(config)
        if state.exists:
            saved = json.loads(state.get[0])
            tracker.next_id = saved["next_id"]
            tracker.tracks = {t["track_id"]: Track(**(t | {"box": tuple(t["box"])})) for t in saved["tracks"]}
        out = []
        for frame, prompts in _by_frame(pdfs):
            tracker.forget(frame)
            for p, track_id, reused in tracker.assign(prompts, frame):
                out.append({k: p[k] for k in columns[:6]} | {"track_id": track_id, "reused": reused})
                tracker.observe(track_id, box_of(p), frame)
        tracks = [asdict(t) | {"prompt": {}} for t in tracker.tracks.values()]
        state.update((json.dumps({"next_id": tracker.next_id, "tracks": tracks}),))
        yield pd.DataFrame(out, columns=columns)

    return step


def stream_tracks(prompts: DataFrame, config: Config) -> DataFrame:
    """The streaming form of ``assign_tracks``."""
    return prompts.groupBy("sequence_id", "face").applyInPandasWithState(
        _track(config), TRACK_OUT, STATE, "append", GroupStateTimeout.NoTimeout
    )


def _memory(config: Config):
    columns = [c.split()[0] for c in PROMPT_OUT.split(", ")]

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory = MaskMemory(config)
        if state.exists:
            memory.last = {tuple(k): (m, seen) for k, m, seen in json.loads(state.get[0])}
        out = []
        for frame, prompts in _by_frame(pdfs):
            made, _ = memory.attach(prompts, frame, key[1])
            memory.update(made, frame)
            out += [{k: r.get(k) for k in columns} | {"frame_idx": frame} for r in made]
        state.update((json.dumps([[list(k), m, seen] for k, (m, seen) in memory.last.items()]),))
        yield pd.DataFrame(out, columns=columns)

    return step


def stream_priors(prompts: DataFrame, config: Config) -> DataFrame:
    """The streaming form of ``attach_priors``."""
    return prompts.groupBy("sequence_id", "face").applyInPandasWithState(
        _memory(config), PROMPT_OUT, STATE, "append", GroupStateTimeout.NoTimeout
    )


def stream_status(frames: DataFrame, late: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """Valid and skipped frames per sequence and time window of an event-time stream (``ts``, ``file_exists``)."""
    return (
        frames.withWatermark("ts", late)
        .groupBy(F.window("ts", every), "sequence_id")
        .agg(F.count_if("file_exists").alias("valid_frames"), F.count_if(~F.col("file_exists")).alias("skipped_frames"))
    )
