"""The attempt log as a stream: terminal states absorb, retries are counted, waits are kept."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cantorel.session import shared_dir

OUT = "key string, attempts long, status string, accepted long, rejected long, update long"
STATE = "attempts long, status string, accepted long, rejected long, updates long"
#: Attempts after which a retryable source is given up.
MAX_ATTEMPTS = 3


def advance(attempts: int, status: str, kinds: list[str], terminal: frozenset[str], retry: frozenset[str], most: int) -> tuple[int, str, int, int]:
    """(attempts, status, accepted, rejected) after a batch of attempts of one source, in order."""
    accepted = rejected = 0
    for kind in kinds:
        if status in terminal or status == "retry_exhausted":
            rejected += 1
            continue
        accepted += 1
        if kind in retry:
            attempts += 1
            status = "retry_exhausted" if attempts >= most else kind
        else:
            status = kind
    return attempts, status, accepted, rejected


def track(stream: DataFrame, terminal: set[str], retry: set[str], most: int = MAX_ATTEMPTS) -> DataFrame:
    """A stream (key, at, kind) to the state of each key after each batch that has rows of it.

    Rows of one batch are taken in the order of ``at``. State is a few numbers a key, so it
    is bounded by the number of sources, not of attempts.
    """
    end, again = frozenset(terminal), frozenset(retry)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values("at")
        attempts, status, accepted, rejected, updates = state.get if state.exists else (0, "not_started", 0, 0, 0)
        attempts, status, a, r = advance(attempts, status, rows["kind"].tolist(), end, again, most)
        now = (attempts, status, accepted + a, rejected + r, updates + 1)
        state.update(now)
        yield pd.DataFrame([(str(key[0]), *now)], columns=["key", "attempts", "status", "accepted", "rejected", "update"])

    return stream.groupBy("key").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def replay(spark: SparkSession, path: str) -> DataFrame:
    """The events of a Parquet path as an attempt log, run to its end; the last state of each user.

    Updates are appended to a table in the folder that ``spark.checkpoint.dir`` names, beside the
    stream's own checkpoint, so nothing but the last states' aggregate leaves the executors, and a
    batch that is run again after a loss replaces what it had written.
    """
    table = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    single = any(f.endswith(f"/{name}") for f in table.inputFiles()[:1])  # a stream reads folders
    reader = spark.readStream.schema(table.schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)
    log = stream.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("at"), F.col("event_type").alias("kind"))
    place = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex[:12]}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/updates/batch={number}")

    states = track(log, {"purchase"}, {"error"})
    states.writeStream.foreachBatch(keep).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(states.schema).parquet(f"{place}/updates")
    last = rows.groupBy("key").agg(F.max_by(F.struct("attempts", "status", "accepted", "rejected"), "update").alias("s"))
    return last.select(F.col("key").alias("user_id"), "s.*")
