"""Recent-rating queues in Spark's keyed state.

Users' newest ratings are state of the stream itself, under keys that some users share: a micro-batch
touches the keys of the users it holds, and no table is read or rewritten for them. Spark checkpoints the state with the progress
of the stream, so a restart goes on from the same queues.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoprec.operators.realtime import QUEUE
from shoprec.streaming.live import TRIGGER

#: Results: `seq` 1 is the newest.
_RESULT = "userId int, seq int, productId int, score double, timestamp bigint, place bigint"
#: Keys of the state. Spark's cost of a key is far above that of a row, so users share keys by a hash. The number
#: belongs to a stream's checkpoint: with another one the queues so far are not found.
KEYS = 4_096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _processor(cap: int):
    """The processor as a local class: it travels whole, and the workers need not have this package."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    kind = np.dtype([("userId", "<i4"), ("timestamp", "<i8"), ("place", "<i8"), ("productId", "<i4"), ("score", "<f8")])

    class Queues(StatefulProcessor):
        def init(self, handle):
            # One value a key: a row of state costs far more than a rating in it.
            self.queues = handle.getValueState("queues", "ratings binary")

        def _held(self):
            """Queues of the key's users."""
            return np.frombuffer(self.queues.get()[0] if self.queues.exists() else b"", kind)

        def _push(self, held, frame):
            """Newest first: by time, then place in the source, then ids."""
            fresh = np.empty(len(frame), kind)
            for name in kind.names:
                if name != "score" and frame[name].isna().any():
                    raise ValueError(f"a rating without {name} has no place in a queue")
                fresh[name] = frame[name].to_numpy()
            both = np.concatenate([held, fresh])
            both = both[np.lexsort([both[c] for c in ("score", "productId", "place", "timestamp", "userId")])[::-1]]
            return both[self._places(both) <= cap]

        def _places(self, held):
            first = np.flatnonzero(np.concatenate([[True], held["userId"][1:] != held["userId"][:-1]]))
            return np.arange(1, len(held) + 1) - np.repeat(first, np.diff(np.append(first, len(held))))

        def handleInputRows(self, key, rows, timers):
            held, touched = self._held(), set()
            for frame in rows:  # a bounded frame at a time, so a busy user is never held whole
                held = self._push(held, frame)
                touched.update(frame["userId"].tolist())
            self.queues.update((held.tobytes(),))
            some = np.isin(held["userId"], list(touched))
            found = pd.DataFrame({name: held[name][some] for name in kind.names})
            found["seq"] = self._places(held)[some]
            yield found[["userId", "seq", "productId", "score", "timestamp", "place"]]

        def handleInitialState(self, key, rows, timers):
            self.queues.update((self._push(self._held(), rows).tobytes(),))

        def close(self):
            pass

    return Queues()


def recent_queues(
    events: DataFrame, history: DataFrame | None = None, cap: int = QUEUE, keys: int = KEYS
) -> DataFrame:
    """The queue of each user a micro-batch of `events` touches, whole, as rows of (userId, seq, productId,
    score, timestamp, place).

    `events` is a stream of ratings with `place`, which orders those of equal time. `history` gives
    the queues to begin with and is read at the first start only; at most `cap` rows a user count.
    """
    columns = ["userId", "timestamp", "place", "productId", "score"]
    key = F.pmod(F.xxhash64("userId"), F.lit(keys)).cast("int").alias("key")
    start = None if history is None else history.select(key, *columns).groupBy("key")
    return events.select(key, *columns).groupBy("key").transformWithStateInPandas(
        _processor(cap), _RESULT, "Update", "None", initialState=start
    )


def start_recent_queues(
    events: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], history: DataFrame | None = None,
    cap: int = QUEUE, trigger: Mapping = TRIGGER, keys: int = KEYS,
) -> StreamingQuery:
    """Hand the queues that each micro-batch changed to `handle`, with the batch number.

    Keyed state of this kind needs Spark's RocksDB state store; the setting holds while the query starts.
    """
    conf = events.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        writer = recent_queues(events, history, cap, keys).writeStream.foreachBatch(handle).outputMode("update")
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def newest_queues(log: DataFrame) -> DataFrame:
    """Of the queues handed out so far (with `batch`) the last one of each user."""
    last = log.groupBy("userId").agg(F.max("batch").alias("batch"))
    return log.join(last, ["userId", "batch"]).drop("batch")
