"""Streams of requests against a static memory: parts gathered as state, answers given once, rounds counted.

State is kept by key (transformWithState, in RocksDB), so a request's parts may
come in any files and batches.  What is complete goes out once and its state is
dropped; what is never completed is dropped by a timer, once the stream's
watermark says that it was last heard of long ago.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from memloom.config import MemoryConfig
from memloom.operators import routing

REQUESTS = "query_id long, tok long, n long, vec array<double>, ts timestamp"
HOUR = 3_600_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def request_stream(spark: SparkSession, path: str, schema: str, files: int = 4) -> DataFrame:
    """Requests from files as they come, at most some files in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


class Idle(StatefulProcessor):
    """State that goes once the watermark is `ttl` milliseconds past the last time at which its key was heard of."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def heard(self, at: pd.Timestamp | None) -> None:
        """Puts the timer off, or away."""
        due = None if at is None else int(at.timestamp() * 1000) + self.ttl
        for old in list(self.handle.listTimers()):
            due = None if due is None else max(due, old)
            self.handle.deleteTimer(old)
        if due is not None:
            self.handle.registerTimer(due)

    def forget(self) -> None:
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.forget()
        return iter(())

    def close(self) -> None:
        pass


class FanIn(Idle):
    """Gathers the parts of a key, each once, and gives them in order when all n are there."""

    def __init__(self, key: str, part: str, n: str, value: str, kind: str, at: str, ttl: int):
        super().__init__(ttl)
        self.names, self.kind = (key, part, n, value, at), kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "part long", f"value {self.kind}")

    def forget(self) -> None:
        self.parts.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        name, part, n, value, at = self.names
        wanted, last = 0, None
        for batch in rows:
            for p, count, v in zip(batch[part], batch[n], batch[value]):
                self.parts.updateValue((int(p),), (v.tolist() if hasattr(v, "tolist") else v,))
                wanted = int(count)
            last = batch[at].max() if last is None else max(last, batch[at].max())
        held = sorted((k[0], v[0]) for k, v in self.parts.iterator())
        if len(held) < wanted:
            self.heard(last)
            return
        self.heard(None)
        self.forget()
        yield pd.DataFrame({name: [key[0]], "parts": [[v for _, v in held]]})


def gathered(parts: DataFrame, key: str, part: str, n: str, value: str, at: str = "ts", ttl: int = HOUR, late: str = "1 minute") -> DataFrame:
    """key and parts (values in the order of their numbers) of each key all of whose n parts have come.

    A part that comes again before the others replaces itself.  Parts that come
    `late` after newer ones, or that aren't completed within ttl milliseconds of
    their last, by the times in `at`, are dropped.
    """
    kind = parts.schema[value].dataType.simpleString()
    rows = parts.select(F.col(key).cast("long"), F.col(part).cast("long"), F.col(n).cast("long"), value, at).withWatermark(at, late)
    return rows.groupBy(key).transformWithStateInPandas(FanIn(key, part, n, value, kind, at, ttl), f"{key} long, parts array<{kind}>", "append", "eventTime")


class Rounds(Idle):
    """Counts the turns of a request until it is done, or has had the most it may have."""

    def __init__(self, most: int, at: str, ttl: int):
        super().__init__(ttl)
        self.most, self.at = most, at

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("seen", "seen long, over boolean")

    def forget(self) -> None:
        self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen, over = self.state.get() if self.state.exists() else (0, False)
        turns = pd.concat(list(rows)).sort_values("turn")
        self.heard(turns[self.at].max())
        if over:
            return
        for done in turns["done"]:
            seen += 1
            over = bool(done) or seen >= self.most
            if over:
                break
        self.state.update((seen, over))
        if over:
            yield pd.DataFrame({"conv_id": [key[0]], "rounds": [seen]})


def rounds(turns: DataFrame, most: int = 8, at: str = "ts", ttl: int = HOUR, late: str = "1 minute") -> DataFrame:
    """Requests (conv_id, turn, done, and a time) across batches: a row for each request that is done or has had `most` rounds.

    That a request is over is known until nothing was heard of it for ttl
    milliseconds of the stream's time, so that late turns don't begin it anew.
    """
    return turns.withWatermark(at, late).groupBy("conv_id").transformWithStateInPandas(Rounds(most, at, ttl), "conv_id long, rounds long", "append", "eventTime")


def started(stream: DataFrame, writer) -> StreamingQuery:
    """Starts a stateful stream with the state store that its operators need; the session's own setting comes back."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, ROCKS)
    try:
        return writer.start()
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def serve(requests: DataFrame, memory: DataFrame, config: MemoryConfig, out: str, checkpoint: str, ttl: int = HOUR) -> StreamingQuery:
    """Routes each query (see REQUESTS; n tokens, in any files) once against memory and appends its best documents.

    A batch that is run again after a failure writes over its own folder.
    """

    def batch(rows: DataFrame, number: int) -> None:
        tokens = rows.select("query_id", F.posexplode("parts").alias("tok", "vec")).withColumn("tok", F.col("tok").cast("long"))
        routing.route(memory, tokens, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    whole = gathered(requests, "query_id", "tok", "n", "vec", ttl=ttl)
    return started(whole, whole.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True))


def appended(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what a stateful stream gives as Parquet, for what has come so far."""
    return started(stream, stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True))


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Requests by window and kind, late ones up to the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
