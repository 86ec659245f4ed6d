"""Rows of a stream over a connection of the user's own: one for each partition and micro-batch.

A connection has ``send(row)``, ``commit()`` and ``abort()``. A micro-batch that is repeated after a
crash comes under the same epoch, with the same rows in the same partitions where the source and the
number of partitions are the same; what was committed under (partition, epoch) isn't sent again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def partition_writer(connect: Callable, committed: Callable[[int, int], bool]):
    """Writer for ``foreach``: connects once for (partition, epoch), commits at the end of the rows, aborts on an error.

    ``connect(partition, epoch)`` gives a connection; ``committed(partition, epoch)`` tells whether its rows are there already.
    """

    # Defined here so that it is shipped by value: workers need not have this package.
    class Writer:
        def open(self, partition_id: int, epoch_id: int) -> bool:
            self.connection = None if committed(partition_id, epoch_id) else connect(partition_id, epoch_id)
            return self.connection is not None

        def process(self, row) -> None:
            self.connection.send(row)

        def close(self, error) -> None:
            if self.connection is None:
                return
            if error is None:
                self.connection.commit()
            else:
                self.connection.abort()

    return Writer()


def connection_writer(rows: DataFrame, connect: Callable, committed: Callable[[int, int], bool],
                      mode: str = "append") -> DataStreamWriter:
    return rows.writeStream.outputMode(mode).foreach(partition_writer(connect, committed))


def folder_connections(path: str) -> tuple[Callable, Callable[[int, int], bool]]:
    """``connect`` and ``committed`` of a folder all executors share: JSON lines, a file for each (partition, epoch).

    A file appears under its name by one rename, so readers and the fence see whole commits only. Of two attempts at one
    (partition, epoch) the first to commit counts; their rows are the same.
    """

    def place(partition_id: int, epoch_id: int) -> tuple:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        return store, folder, f"{folder}/epoch-{epoch_id}-part-{partition_id}.json"

    def exists(store, name: str) -> bool:
        from pyarrow import fs

        return store.get_file_info(name).type == fs.FileType.File

    def committed(partition_id: int, epoch_id: int) -> bool:
        store, _, name = place(partition_id, epoch_id)
        return exists(store, name)

    class Connection:
        def __init__(self, partition_id: int, epoch_id: int):
            import uuid

            self.store, folder, self.name = place(partition_id, epoch_id)
            self.store.create_dir(folder, recursive=True)
            self.staged = f"{folder}/_open-{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.staged)

        def send(self, row) -> None:
            import json

            self.out.write(json.dumps(row.asDict(), ensure_ascii=False).encode() + b"\n")

        def commit(self) -> None:
            self.out.close()
            if exists(self.store, self.name):
                self.store.delete_file(self.staged)
            else:
                self.store.move(self.staged, self.name)

        def abort(self) -> None:
            self.out.close()
            self.store.delete_file(self.staged)

    return Connection, committed
