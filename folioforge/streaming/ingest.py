"""Loading files as they arrive: the batch import, run for the new files of a folder that a stream watches."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest, state


def watch(store: state.Store, source: str, folder: str, checkpoint: str, pattern: str = "*.csv") -> StreamingQuery:
    """Load the files of a folder that aren't loaded yet, then stop; run it again, with the same checkpoint, for later ones.

    All files of a batch are imported together; one that fails is marked and doesn't end the stream. A file that's seen
    twice after a failure is skipped by its content's hash.
    """
    files = store.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path")

    def load(batch, _epoch: int) -> None:
        if paths := [row.path for row in batch.collect()]:  # one name a file
            ingest.import_files(store, source, sorted(paths))

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
