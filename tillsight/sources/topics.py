"""Topics of messages: Kafka where its connector is deployed, folders elsewhere.

Both kinds offer the same calls, and jobs take either one. ``read`` and
``read_stream`` take messages; ``pinned`` fixes what ``read`` will take, and
``covers`` tells it; ``write``, ``write_batch`` and ``write_run`` send, and
``last_run`` finds the last run that was sent whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tillsight.schema import ENVELOPE
from tillsight.workspace import COMPRESSION, hadoop_path, shuffles_removed

#: How far a topic was read: its parts (partitions, or files) and the place after the last message.
Covered = Mapping[str, int]

_ROW_GROUP_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a Kafka cluster, through Spark's Kafka connector.

    A topic partition is read by several tasks when it holds more than
    ``records_per_task``, so one overfull partition does not hold up a job.
    Offsets are what the connector takes: a word, or JSON of partitions to
    offsets. ``options`` go to reader and writer as they are, such as those
    for security or for lost data.
    """

    bootstrap_servers: str
    records_per_task: int = 1_000_000
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    options: Mapping[str, str] = field(default_factory=dict)
    #: (first, next) offset of each partition of a topic; by the connector's own client if not given.
    ends: Callable[[SparkSession, str], tuple[dict[int, int], dict[int, int]]] | None = None

    @property
    def bounded(self) -> bool:
        """Whether a batch read leaves out some of the topic."""
        return self.has_start or self.ending_offsets != "latest"

    @property
    def has_start(self) -> bool:
        """Whether a batch read leaves out the topic's first messages."""
        return self.starting_offsets != "earliest"

    def batch_options(self, topic: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            "endingOffsets": self.ending_offsets,
            "maxRecordsPerPartition": str(self.records_per_task),
            **self.options,
        }

    def stream_options(self, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
        """The rate limit is a streaming option; a batch read would ignore it."""
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            "maxRecordsPerPartition": str(self.records_per_task),
            **self.options,
        }
        if max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return options

    def write_options(self, topic: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": topic, **self.options}

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.format("kafka").options(**self.batch_options(topic)).load()

    def read_stream(self, spark: SparkSession, topic: str, max_per_trigger=None) -> DataFrame:
        options = self.stream_options(topic, max_per_trigger)
        return spark.readStream.format("kafka").options(**options).load()

    def pinned(self, spark: SparkSession, topic: str, covered: Covered | None = None) -> KafkaTopics:
        """The same topic with its offsets as they are now, without what is ``covered``.

        All reads of the result see the same messages, whatever arrives
        meanwhile.
        """
        first, following = (self.ends or self._client_ends)(spark, topic)
        start = resolve_offsets(self.starting_offsets, topic, first, following)
        end = resolve_offsets(self.ending_offsets, topic, first, following)
        for part, position in (covered or {}).items():
            if position > following.get(int(part), 0):
                raise ValueError(f"{topic} ends before offset {position} of partition {part}, which was read from it")
            start[int(part)] = max(start[int(part)], position)
        text = [json.dumps({topic: {str(part): at for part, at in sorted(offsets.items())}}) for offsets in (start, end)]
        return replace(self, starting_offsets=text[0], ending_offsets=text[1])

    def covers(self, topic: str) -> dict[str, int]:
        """How far a pinned topic goes."""
        return json.loads(self.ending_offsets)[topic]

    def last_run(self, spark: SparkSession, topic: str) -> KafkaTopics | None:
        """The topic from the first message of the last run on, by the pointer its sender left."""
        if self.bounded:
            return None
        first, following = (self.ends or self._client_ends)(spark, f"{topic}{_POINTERS}")
        tail = {part: max(first[part], at - 1) for part, at in following.items()}
        if all(tail[part] == at for part, at in following.items()):
            return None
        text = json.dumps({f"{topic}{_POINTERS}": {str(part): at for part, at in sorted(tail.items())}})
        pointers = replace(self, starting_offsets=text).read(spark, f"{topic}{_POINTERS}")
        # One message of each partition of the pointers.
        sent = [json.loads(row.text) for row in pointers.select(F.col("value").cast("string").alias("text")).collect()]
        newest = max(sent, key=lambda pointer: pointer["run_id"])
        return replace(self, starting_offsets=json.dumps({topic: newest["from"]}))

    def _client_ends(self, spark: SparkSession, topic: str) -> tuple[dict[int, int], dict[int, int]]:
        settings = spark._jvm.java.util.Properties()
        reader = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
        given = {name.removeprefix("kafka."): value for name, value in self.options.items() if name.startswith("kafka.")}
        for name, value in {
            "bootstrap.servers": self.bootstrap_servers, "key.deserializer": reader, "value.deserializer": reader, **given
        }.items():
            settings.put(name, value)
        client = spark._jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
        try:
            place = spark._jvm.org.apache.kafka.common.TopicPartition
            parts = [place(topic, info.partition()) for info in client.partitionsFor(topic) or []]
            first, following = client.beginningOffsets(parts), client.endOffsets(parts)
            return {p.partition(): first[p] for p in parts}, {p.partition(): following[p] for p in parts}
        finally:
            client.close()

    def write_run(self, messages: DataFrame, topic: str, run_id: int) -> None:
        """A run of an insight topic, then a pointer to where it begins.

        The pointer goes to a topic of its own, under one key, so compaction
        keeps the last one.
        """
        spark = messages.sparkSession
        _, begin = (self.ends or self._client_ends)(spark, topic)
        self.write(messages, topic)
        pointer = json.dumps({"run_id": run_id, "from": {str(part): at for part, at in sorted(begin.items())}})
        row = spark.range(1).select(F.lit(topic).alias("key"), F.lit(pointer).alias("value"))
        row.write.format("kafka").options(**self.write_options(f"{topic}{_POINTERS}")).save()

    def write(self, messages: DataFrame, topic: str) -> None:
        sent = [name for name in ("key", "value") if name in messages.columns]
        messages.select(*sent).write.format("kafka").options(**self.write_options(topic)).save()

    def write_batch(self, messages: DataFrame, topic: str, run_id: int) -> None:
        """One micro-batch. A replayed batch is sent again, under the number it had."""
        self.write(messages, topic)


def resolve_offsets(wanted: str, topic: str, first: Mapping[int, int], following: Mapping[int, int]) -> dict[int, int]:
    """Numbers for offsets that are words, or JSON in which -2 and -1 stand for the words."""
    if wanted in ("earliest", "latest"):
        return dict(first if wanted == "earliest" else following)
    given = json.loads(wanted)[topic]
    marks = {-2: first, -1: following}
    return {int(part): marks[at][int(part)] if at in marks else at for part, at in given.items()}


_POINTERS = "-runs"


@dataclass(frozen=True)
class FileTopics:
    """Topics as folders of Parquet envelopes under ``root``.

    A read takes messages that arrived from ``since`` on and before ``until``,
    both times as Spark reads them; the place of offsets. ``files`` (relative
    to the topic) and ``run`` are set by ``pinned`` and ``last_run``.
    """

    root: str
    since: str | None = None
    until: str | None = None
    files: tuple[str, ...] | None = None
    run: int | None = None

    @property
    def bounded(self) -> bool:
        """Whether a batch read leaves out some of the topic."""
        return self.since is not None or self.until is not None

    @property
    def has_start(self) -> bool:
        """Whether a batch read leaves out the topic's first messages."""
        return self.since is not None

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}" if self.run is None else _run_folder(f"{self.root}/{topic}", self.run)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        if self.files is not None and not self.files:
            return spark.createDataFrame([], ENVELOPE)
        reader = spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true")
        if self.files is None:
            return self._within_times(reader.parquet(self.path(topic)))
        return self._within_times(reader.parquet(*[f"{self.path(topic)}/{name}" for name in self.files]))

    def pinned(self, spark: SparkSession, topic: str, covered: Covered | None = None) -> FileTopics:
        """The files that the topic has now, without those ``covered``.

        All reads of the result see the same messages, whatever arrives
        meanwhile. Files are listed once and not opened.
        """
        folder, file_system = hadoop_path(spark, self.path(topic))
        if not file_system.exists(folder):
            return replace(self, files=())
        whole = replace(self, since=None, until=None, files=None).read(spark, topic)
        root = file_system.makeQualified(folder).toUri().getPath()
        names = (unquote(name) for name in whole.inputFiles())
        names = {name[name.index(f"{root}/") + len(root) + 1 :] for name in names}
        return replace(self, files=tuple(sorted(names - set(covered or ()))))

    def covers(self, topic: str) -> dict[str, int]:
        """The files of a pinned topic; a file is covered whole."""
        return dict.fromkeys(self.files, 0)

    def last_run(self, spark: SparkSession, topic: str) -> FileTopics | None:
        """The folder of the last run that was written whole; only names of folders are listed."""
        folder, file_system = hadoop_path(spark, self.path(topic))
        if self.bounded or not file_system.exists(folder):
            return None
        names = [status.getPath().getName() for status in file_system.listStatus(folder)]
        runs = sorted((int(name.removeprefix(_RUN)) for name in names if name.startswith(_RUN)), reverse=True)
        for run in runs:
            done, _ = hadoop_path(spark, f"{_run_folder(self.path(topic), run)}/_SUCCESS")
            if file_system.exists(done):
                return replace(self, run=run)
        return None

    def _within_times(self, messages: DataFrame) -> DataFrame:
        if self.since is not None:
            messages = messages.filter(F.col("timestamp") >= F.lit(self.since).cast("timestamp"))
        if self.until is not None:
            messages = messages.filter(F.col("timestamp") < F.lit(self.until).cast("timestamp"))
        return messages

    def read_stream(self, spark: SparkSession, topic: str, max_per_trigger=None) -> DataFrame:
        """``max_per_trigger`` counts files here, as folders have no offsets to count."""
        reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return self._within_times(reader.parquet(self.path(topic)))

    def write(self, messages: DataFrame, topic: str) -> None:
        with shuffles_removed(messages.sparkSession):
            self._writer(messages, topic).mode("append").parquet(self.path(topic))

    def write_batch(self, messages: DataFrame, topic: str, run_id: int) -> None:
        """One micro-batch in a folder of its run, so a replay replaces it and nothing else."""
        with shuffles_removed(messages.sparkSession):
            self._writer(messages, topic).mode("overwrite").parquet(_run_folder(self.path(topic), run_id))

    def write_run(self, messages: DataFrame, topic: str, run_id: int) -> None:
        """A run of an insight topic in a folder of its own, which its name points to."""
        with shuffles_removed(messages.sparkSession):
            self._writer(messages, topic).mode("append").parquet(_run_folder(self.path(topic), run_id))

    @staticmethod
    def _writer(messages: DataFrame, topic: str) -> DataFrameWriter:
        """Arrival order is (timestamp, partition, offset): the write, then the row in it.

        Row groups are small, as tasks share a file by row groups and parsing
        messages takes far longer than reading them.
        """
        row_in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        columns = {
            "key": F.lit(None),
            "topic": F.lit(topic),
            "partition": F.spark_partition_id(),
            "offset": row_in_partition,
            "timestamp": F.current_timestamp(),
            "timestampType": F.lit(0),
        }
        given = set(messages.columns)
        envelopes = messages.select(*[
            (F.col(column.name) if column.name in given else columns[column.name])
            .cast(column.dataType)
            .alias(column.name)
            for column in ENVELOPE
        ])
        return envelopes.write.options(**{"parquet.block.size": _ROW_GROUP_BYTES, "compression": COMPRESSION})


_RUN = "run-"


def _run_folder(path: str, run: int) -> str:
    return f"{path}/{_RUN}{run}"
