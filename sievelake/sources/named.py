"""A sink of named text files, which appear together or not at all."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Files of a folder at most, so that none is long to list.
FOLDER_FILES = 1000
#: Characters of files that are handed on together when they are read.
BATCH_SIZE = 4 << 20


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    files: int


class _Writer(DataSourceWriter):
    """Each attempt of a task writes to a folder of its own; the driver keeps one attempt of each task and renames the whole."""

    def __init__(self, path: str):
        self.path, self.staging = path.rstrip("/"), f"{path.rstrip('/')}._writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        files, root = _at(self.staging)
        folder, n = f"{root}/attempts/{uuid.uuid4().hex}", 0
        files.create_dir(folder, recursive=True)
        for row in iterator:
            name, text = row
            if not name or "/" in name or name.startswith("."):
                raise ValueError(f"no file name: {name!r}")
            if n % FOLDER_FILES == 0:
                files.create_dir(f"{folder}/{n // FOLDER_FILES:06d}")
            with files.open_output_stream(f"{folder}/{n // FOLDER_FILES:06d}/{name}") as out:
                out.write((text or "").encode())
            n += 1
        return _Written(folder, n)

    def commit(self, messages):
        files, root = _at(self.staging)
        files.create_dir(f"{root}/whole", recursive=True)
        for i, m in enumerate(m for m in messages if m is not None):  # one folder per task, however many files
            if m.files:
                files.move(m.folder, f"{root}/whole/part-{i:05d}")
        with files.open_output_stream(f"{root}/whole/_SUCCESS"):
            pass
        target = _at(self.path)[1]
        if files.get_file_info(target).type != pafs.FileType.NotFound:
            raise FileExistsError(self.path)
        files.move(f"{root}/whole", target)
        files.delete_dir(root)

    def abort(self, messages):
        files, root = _at(self.staging)
        if files.get_file_info(root).type != pafs.FileType.NotFound:
            files.delete_dir(root)


def _at(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


class NamedTexts(DataSource):
    """Format ``named_texts``: rows (name, text), each a file of that name in a folder of one of the folders ``part-<n>`` of the path."""

    @classmethod
    def name(cls) -> str:
        return "named_texts"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"])


def write_named_texts(df: DataFrame, path: str, name: str, text: str) -> None:
    """Write each row's text to a file of its name, below a folder that all executors share; null texts are empty files.

    Files of a failed or repeated task are not among them; ``path`` is there once all are, and must not be there before.
    """
    df.sparkSession.dataSource.register(NamedTexts)
    df.select(name, text).write.format("named_texts").mode("append").save(path)


def _below(files: pafs.FileSystem, folder: str) -> list[str]:
    return sorted(f.path for f in files.get_file_info(pafs.FileSelector(folder)))


def read_named_texts(spark, path: str, empty: bool = False) -> DataFrame:
    """(file, text) of what ``write_named_texts`` wrote; empty files have a row only with ``empty``.

    The driver lists the folders of the writing tasks, a task lists and reads one of them: no list of all files is made.
    """
    files, root = _at(path)
    parts = [p for p in _below(files, root) if p.rsplit("/", 1)[-1].startswith("part-")]

    def run(batches):
        at = _at(path)[0]
        for batch in batches:
            for i in batch.column(0).to_pylist():
                names, texts, size = [], [], 0
                for folder in _below(at, parts[i]):
                    for file in _below(at, folder):
                        with at.open_input_stream(file) as data:
                            text = data.read().decode()
                        if text or empty:
                            names.append(file.rsplit("/", 1)[-1])
                            texts.append(text)
                            size += len(text)
                        if size > BATCH_SIZE or len(names) >= FOLDER_FILES:
                            yield pa.record_batch([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["file", "text"])
                            names, texts, size = [], [], 0
                yield pa.record_batch([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["file", "text"])

    return spark.range(0, len(parts), 1, max(len(parts), 1)).mapInArrow(run, "file string, text string")
