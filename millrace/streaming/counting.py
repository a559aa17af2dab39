"""Word counts over files that keep arriving."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.counting import merge_counts, word_count
from millrace.session import scratch_dir, spread
from millrace.sources.hidden import glob_names, hidden_files


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = 1, skip_hidden: bool = False,
                bytes_per_batch: int | None = None) -> DataFrame:
    """Lines of the ``.txt`` files of a folder tree, a number of files at a time, or as many as hold
    ``bytes_per_batch`` (at least one; then ``files_per_batch`` does not count).

    A stream passes over names that begin with a dot or an underscore.  If there are any when this is
    called, this is an error, unless ``skip_hidden`` says that they are to be left out.
    """
    limit = files_per_batch if bytes_per_batch is None else bytes_per_batch
    if limit is None or limit < 1:
        raise ValueError("files_per_batch or bytes_per_batch must be positive")
    if not skip_hidden and (hidden := hidden_files(spark, path)):
        raise ValueError(f"{len(hidden)} files have names that a stream does not read, rename them or pass skip_hidden: {hidden[:5]}")
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    reader = reader.option("maxFilesPerTrigger" if bytes_per_batch is None else "maxBytesPerTrigger", limit)
    return reader.text(path).withColumnRenamed("value", "text")


#: Running totals are kept on the executors' disks, not in their heaps.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Batches after which a store is compacted.
COMPACT = 64


class BatchStore:
    """Counts of batches at a path: a folder a batch, and a snapshot of all up to some batch.

    What a folder holds counts once Spark has marked it as complete, so the switch to a new snapshot
    is the writing of that mark.  A batch that the snapshot holds is not written again, and a repeated later one
    replaces itself, so each counts once however often it is tried.  Folders that the new snapshot
    replaces stay until the next one, for those who are reading them.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], every: int = COMPACT) -> None:
        if every < 1:
            raise ValueError("every must be positive")
        self.spark, self.path, self.merge, self.every = spark, path.rstrip("/"), merge, every

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind, in order."""
        marks = glob_names(self.spark, f"{self.path}/{kind}=*/_SUCCESS")
        return sorted(int(mark.rsplit("/", 2)[1].removeprefix(f"{kind}=")) for mark in marks)

    def _write(self, counts: DataFrame, kind: str, number: int) -> None:
        writer = counts.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        writer.parquet(f"{self.path}/{kind}={number}")

    def _parts(self) -> tuple[int | None, list[int]]:
        """The batch up to which there is a snapshot, and the complete batches after it."""
        snapshots = self._complete("snapshot")
        last = snapshots[-1] if snapshots else None
        return last, [number for number in self._complete("batch") if last is None or number > last]

    def folders(self) -> list[str]:
        """What a reader has to read now."""
        last, batches = self._parts()
        return ([] if last is None else [f"{self.path}/snapshot={last}"]) + [f"{self.path}/batch={number}" for number in batches]

    def read(self) -> DataFrame:
        folders = self.folders()
        reader = self.spark.read.schema("word string, n bigint")
        return self.merge(reader.parquet(*folders) if folders else self.spark.createDataFrame([], "word string, n bigint"))

    def add(self, counts: DataFrame, number: int) -> None:
        last, batches = self._parts()
        if last is not None and number <= last:
            # Computed all the same: a stream with state has to store that batch's state.
            counts.write.format("noop").mode("overwrite").save()
            return
        self._write(counts, "batch", number)
        if len({*batches, number}) >= self.every:
            self.compact()

    def compact(self) -> None:
        """Merge the snapshot and all later batches to a new snapshot, and drop what the one before replaced."""
        last, batches = self._parts()
        if not batches:
            return
        self._write(self.read(), "snapshot", batches[-1])
        if last is None:
            return
        old = [f"batch={number}" for number in self._complete("batch") if number <= last]
        old += [f"snapshot={number}" for number in self._complete("snapshot") if number < last]
        for folder in old:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _latest(totals: DataFrame) -> DataFrame:
    """Totals only grow, so a word's latest is its largest."""
    return totals.groupBy("word").agg(F.max("n").alias("n"))


def count_arriving(stream: DataFrame, store: str, checkpoint: str, text: str = "text", every: int = COMPACT) -> None:
    """Count the words of all files there are now, batch by batch, into ``store``.

    Each batch writes the counts of its own files, so the work of a batch depends on the batch
    alone; after ``every`` batches they are merged to one snapshot.  Called again with the same folders it goes
    on with the files that came since, a batch that failed on its way included.
    """
    kept = BatchStore(stream.sparkSession, store, merge_counts, every)

    def add(batch: DataFrame, number: int) -> None:
        kept.add(word_count(spread(batch), text), number)

    query = (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def counts_so_far(spark: SparkSession, store: str) -> DataFrame:
    """The merge of the snapshot and the batches after it: ``word, n``."""
    return BatchStore(spark, store, merge_counts).read()


def running_counts(stream: DataFrame, store: str, checkpoint: str, text: str = "text", every: int = COMPACT) -> DataFrame:
    """The same with the running totals held as streaming state.

    Every batch writes the new totals of the words it changed; a word's latest batch
    holds its total, and snapshots keep only that.  State grows with the vocabulary, not with the stream, and
    lies in a state store on disk.
    """
    spark = stream.sparkSession
    kept = BatchStore(spark, store, _latest, every)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ON_DISK)
    try:
        query = (
            word_count(stream, text).writeStream.outputMode("update").foreachBatch(kept.add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return kept.read()


def stream_word_count(stream: DataFrame, text: str = "text", stateful: bool = False) -> DataFrame:
    """Run a stream to the end of what is there now and return its counts.

    Runs when called.  Checkpoint and batches go to fresh shared folders.
    """
    spark = stream.sparkSession
    home = scratch_dir(spark, "stream")
    if stateful:
        return running_counts(stream, f"{home}/totals", f"{home}/checkpoint", text)
    count_arriving(stream, f"{home}/counts", f"{home}/checkpoint", text)
    return counts_so_far(spark, f"{home}/counts")
