"""Objects written under names of their own, one per row."""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that a folder or file name holds as % and two hexadecimal digits.
_ESCAPED = "%\"#'*/:=?\\{[]^" + "".join(map(chr, [*range(1, 32), 127]))
_FORMAT = "named_objects"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def path_part(text: Column) -> Column:
    """Text as part of a path; readers of partitioned folders turn it back."""
    escaped = text
    for character in _ESCAPED:
        escaped = F.replace(escaped, F.lit(character), F.lit(f"%{ord(character):02X}"))
    unusual = text.rlike("[\\x01-\\x1F\\x7F%\"#'*/:=?\\\\{\\[\\]^]")
    return F.when(unusual, escaped).otherwise(text)


def _data_source() -> type:
    """A writer of (name, content) rows.

    Defined in a function, so that it travels to workers by value. A task writes each object to a
    file of its own attempt and moves it to its name when it is whole; so a reader never sees half
    of one, and a task that runs again, or twice at once, leaves the same objects. The job ends by
    removing what lost attempts left.
    """
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    class NamedObjectsWriter(DataSourceArrowWriter):
        def __init__(self, path: str) -> None:
            self.path, self.job = path, uuid.uuid4().hex

        def _place(self):
            from pyarrow import fs

            if "://" in self.path or self.path.startswith("file:"):
                store, base = fs.FileSystem.from_uri(self.path)
            else:
                store, base = fs.LocalFileSystem(), self.path
            return store, base.rstrip("/"), f"{base.rstrip('/')}/_temporary-{self.job}"

        def write(self, iterator):
            store, base, temporary = self._place()
            attempt, made = f"{temporary}/{uuid.uuid4().hex}", set()
            store.create_dir(attempt, recursive=True)
            for batch in iterator:
                names, contents = (batch.column(i).to_pylist() for i in (0, 1))
                for name, content in zip(names, contents, strict=True):
                    target = f"{base}/{name}"
                    parent = target.rsplit("/", 1)[0]
                    if parent not in made:
                        store.create_dir(parent, recursive=True)
                        made.add(parent)
                    with store.open_output_stream(f"{attempt}/object") as sink:
                        sink.write(content)
                    store.move(f"{attempt}/object", target)
            return WriterCommitMessage()

        def _clean(self) -> None:
            from pyarrow import fs

            store, _, temporary = self._place()
            if store.get_file_info(temporary).type == fs.FileType.Directory:
                store.delete_dir(temporary)

        def commit(self, messages) -> None:
            self._clean()

        def abort(self, messages) -> None:
            self._clean()

    class NamedObjects(DataSource):
        @classmethod
        def name(cls) -> str:
            return _FORMAT

        def writer(self, schema, overwrite):
            return NamedObjectsWriter(self.options["path"])

    return NamedObjects


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let the session list folders, and the files of a batch, in a few tasks for each core.

    By default Spark starts a task for each of them, up to 10,000, which takes longer than listing
    them. A lower setting stays.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING, "10000")) > tasks:
        spark.conf.set(_LISTING, str(tasks))


def register(spark: SparkSession) -> None:
    """Make the writer known to a session.

    The batches of a stream have a session that copies this one at the start, so a stream that
    writes objects needs this before.
    """
    try:
        spark.dataSource.register(_data_source())
    except AnalysisException as error:
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def write_objects(objects: DataFrame, path: str) -> None:
    """Write each row's content (binary) below `path` under its name; an existing one is replaced.

    `objects`: name, parts of which are separated by /, and content. Of several rows of one name
    the one with the least content is written, so the result does not depend on the order.
    """
    register(objects.sparkSession)
    once = objects.groupBy("name").agg(F.min("content").alias("content"))
    once.select("name", "content").write.format(_FORMAT).mode("append").save(path)
