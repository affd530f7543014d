"""One ridge model per user, kept as keyed state of a stream."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.linalg import stack
from .sink import latest


#: Matrices that an Arrow batch may hold.
BATCH_BYTES = 1 << 24


def compressed(d: int):
    """Turns each Arrow batch into one row a user: (k, n, at, xs, b) with at most d rows of features.

    X'X is all that the inverse needs of them, so more than d rows are replaced by the factor R of X = QR: R'R = X'X. A user
    with a third of all events reaches the state as a short row a batch.
    """
    def run(batches):
        for frame in batches:
            frame = frame[frame["k"].notna()]
            if frame.empty:
                continue
            out = []
            for k, own in frame.groupby("k", sort=True):
                known = own[own["x"].notna()]
                x = stack(known["x"]) if len(known) else np.zeros((0, d))
                b = known["r"].fillna(0.0).to_numpy("float64") @ x if len(known) else np.zeros(d)
                out.append((k, len(own), own["at"].max(), (np.linalg.qr(x, mode="r") if len(x) > d else x).ravel(), b))
            yield pd.DataFrame(out, columns=["k", "n", "at", "xs", "b"])
    return run


def absorb(ainv: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The inverse of A + X'X from that of A: Sherman-Morrison for one row, its block form for several."""
    ax = ainv @ x.T
    new = ainv - ax @ np.linalg.solve(np.eye(len(x)) + x @ ax, ax.T)
    return (new + new.T) / 2


def user_models(pulls: DataFrame, d: int, ridge: float = 0.1, idle: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Stream of (user_id, n, theta, ainv, expired): each user's model after a batch that has pulls of the user.

    ``pulls`` has user_id, reward, x and, with ``idle``, a timestamp ``at``. Updates commute, so the order of events does not
    matter and late ones count like others. With ``idle`` such as "7 days" a user without events for that long leaves the
    state with a last row marked ``expired``, and starts anew later; events later than ``delay`` are then dropped.
    Pulls without a user are left out, those without features only count.
    """
    if idle is not None:
        pulls = pulls.withWatermark("at", delay)
        pause = int(pd.Timedelta(idle).total_seconds() * 1000)
    kind = pulls.schema["user_id"].dataType.simpleString()
    at = F.col("at") if idle is not None else F.lit(None).cast("timestamp")
    rows = pulls.select(F.col("user_id").alias("k"), at.alias("at"), F.col("x").cast("array<double>").alias("x"),
                        F.col("reward").cast("double").alias("r"))
    if idle is None:
        rows = rows.mapInPandas(compressed(d), f"k {kind}, n bigint, at timestamp, xs array<double>, b array<double>")
    else:  # the watermark must reach the state, which Python output would hide
        rows = rows.filter("k is not null").select("k", F.lit(1).cast("bigint").alias("n"), "at", F.coalesce(
            "x", F.array().cast("array<double>")).alias("xs"), F.when(F.col("x").isNull(), F.array_repeat(F.lit(0.0), d)).otherwise(
                F.transform("x", lambda v: v * F.coalesce("r", F.lit(0.0)))).alias("b"))

    def update(key, frames, state: GroupState):
        # bytes, as many states wait for their batch to fill and a list of numbers takes four times as much
        n, ainv, b = state.get if state.exists else (0, (np.eye(d) / ridge).tobytes(), np.zeros(d).tobytes())
        n, ainv, b = int(n), np.frombuffer(ainv).reshape(d, d), np.frombuffer(b)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "n": [n], "theta": [ainv @ b], "ainv": [ainv.ravel()], "expired": [True]})
            return
        last = 0
        for frame in frames:
            xs = np.concatenate([np.zeros(0), *frame["xs"]]).reshape(-1, d)
            for at_row in range(0, len(xs), d):
                ainv = absorb(ainv, xs[at_row:at_row + d])
            n, b = n + int(frame["n"].sum()), b + stack(frame["b"]).sum(0)
            if idle is not None:
                last = max(last, int(frame["at"].max().timestamp() * 1000))
        state.update((n, ainv.tobytes(), b.tobytes()))
        if idle is not None:
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + pause)
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "theta": [ainv @ b], "ainv": [ainv.ravel()], "expired": [False]})

    return rows.groupBy("k").applyInPandasWithState(
        update, f"user_id {kind}, n bigint, theta array<double>, ainv array<double>, expired boolean",
        "n bigint, ainv binary, b binary", "update",
        GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.EventTimeTimeout)


def stream_user_models(pulls: DataFrame, d: int, ridge: float = 0.1, idle: str | None = None, delay: str = "1 hour",
                       path: str | None = None) -> DataFrame:
    """The newest model of each user after all input there is; a restart with the same ``path`` goes on.

    Arrow batches are cut by rows, and a row holds a matrix: as many are allowed as take ``BATCH_BYTES``.
    """
    conf, name = pulls.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(max(1, min(int(before) if int(before) > 0 else 10_000, BATCH_BYTES // (8 * d * d)))))
    try:
        return latest(user_models(pulls, d, ridge, idle, delay), ["user_id"], path)
    finally:
        conf.set(name, before)
