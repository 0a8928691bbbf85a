"""Starting streaming queries."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from inspect import signature

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cabgrid.operators.topk import top_k

BATCH_INTERVAL = "5 seconds"
#: Name of the observed numbers of lines by outcome.
OBSERVED = "outcomes"


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    per_batch: Callable[..., DataFrame] | None = None,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    output_mode: str = "append",
    query_name: str | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Write ``df`` to parquet at ``path`` with its checkpoint at
    ``checkpoint`` (put it in the shared checkpoint folder, see
    :func:`cabgrid.session.checkpoint_root`).

    ``per_batch`` post-processes every micro-batch (e.g. a top-k over the
    windows that just closed); each batch is written to its own
    ``batch_id=N`` folder in overwrite mode, so a batch re-run after a
    failure replaces its output instead of duplicating it. It may take the batch
    id as a second argument. With ``partition_by``, rows go to a folder for each value.
    ``available_now`` drains what is there and stops; otherwise a
    micro-batch runs every ``interval``. ``fmt`` may also be ``console``
    (prints each batch, for inspection) or ``memory`` (an in-memory table
    named ``query_name``, for tests); ``path`` is ignored for those, and they
    can't be combined with ``per_batch``."""
    if per_batch is not None and fmt != "parquet":
        raise ValueError("per_batch output is written as parquet")
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if per_batch is None and fmt in ("console", "memory"):
        w = w.format(fmt)
    elif per_batch is None:
        w = w.format(fmt).option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    else:
        with_id = len(signature(per_batch).parameters) > 1 and signature(per_batch).parameters.get("batch_id") is not None

        def sink(batch: DataFrame, batch_id: int) -> None:
            done = per_batch(batch, batch_id=batch_id) if with_id else per_batch(batch)
            done.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(f"{path}/batch_id={batch_id}")

        w = w.foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def observed_outcomes(query: StreamingQuery) -> dict[str, int]:
    """Lines by outcome that :func:`cabgrid.streaming.stream_outcomes` saw, summed over
    the progress reports that the query still holds (Spark keeps the last 100); for
    the whole history count the written rows."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(OBSERVED)
        for name, n in row.asDict().items() if row is not None else ():
            total[name] = total.get(name, 0) + n
    return total


def _batch_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Folders ``batch_id=N`` that are complete, by N."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS"))
    folders = [str(f.getPath().getParent().toString()) for f in found]
    return {int(f.rsplit("=", 1)[1]): f for f in folders}


def best_so_far(path: str, order: Callable[[], list[Column]], k: int) -> Callable[..., DataFrame]:
    """For ``write_stream(per_batch=...)``: the ``k`` best rows of all batches up to
    this one. They are the best of the batch and of what the batch before it wrote:
    k rows a batch, whatever has passed. Exact when a row is final and comes once, as
    a closed window does. A batch that is run again reads what was there before it,
    so it writes the same rows. Folders before the last two go."""

    def merge(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        earlier = {n: f for n, f in _batch_folders(spark, path).items() if n < batch_id}
        rows = batch
        if earlier:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(earlier[max(earlier)]))
        for n in sorted(earlier)[:-2]:
            place = spark._jvm.org.apache.hadoop.fs.Path(earlier[n])
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        return top_k(rows, order(), k)

    return merge


def read_best(spark: SparkSession, path: str) -> DataFrame | None:
    """What the last batch of :func:`best_so_far` wrote; None before the first."""
    folders = _batch_folders(spark, path)
    return spark.read.parquet(folders[max(folders)]) if folders else None


class BatchBanner(StreamingQueryListener):
    """Prints ``===== <batch time> =====`` with the batch id and input rows
    after every micro-batch of every query of the session, and keeps the
    same facts of the last ``keep`` batches in ``self.batches`` (batch id, time,
    rows) for inspection. Register it with the session's query manager."""

    def __init__(self, echo: bool = True, keep: int = 1000):
        self.echo = echo
        self.batches: deque[tuple[int, str, int]] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((p.batchId, p.timestamp, p.numInputRows))
        if self.echo:
            print(f"========= {p.timestamp} ========= batch {p.batchId}, {p.numInputRows} rows")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
