"""Writing streams: batched, idempotent, and run to the end of what is there."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stateful_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query takes over when it starts: RocksDB state (timers need it, and
    state may exceed memory) and the number of state partitions, ``spark.sql.shuffle.partitions``
    of the session unless told otherwise. The number is fixed for the life of a checkpoint: choose
    it for the size the state will have, not for the executors there are at the start."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def batched_sink(stream: DataFrame, path: str, checkpoint: str, interval: str = "5 seconds",
                 mode: str = "append", available_now: bool = False,
                 partitions: int | None = None) -> StreamingQuery:
    """Collect rows for ``interval`` and write them at once, one folder per query and micro-batch.

    A batch replayed after a failure overwrites its own folder. A query that starts over without its
    checkpoint has a new id and writes beside what is there; duplicates are left to ``read_final``.
    """
    running: list[str] = []
    started = Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/query={running[0]}/batch_id={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with stateful_settings(stream.sparkSession, partitions):
        query = (
            stream.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
    running.append(query.id)
    started.set()
    return query


def drain(stream: DataFrame, mode: str = "append", partitions: int | None = None) -> DataFrame:
    """Run a stream over the data available now and return what it wrote, as a table in the
    shared scratch folder."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "state")
    if mode == "append":
        with stateful_settings(spark, partitions):
            running = (
                stream.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
            )
    else:
        running = batched_sink(stream, path, checkpoint, mode=mode, available_now=True,
                               partitions=partitions)
    running.awaitTermination()
    if mode == "append":
        return spark.read.schema(stream.schema).parquet(path)
    schema = stream.schema.add("query", "string").add("batch_id", "long")
    return spark.read.schema(schema).parquet(path).drop("query")
