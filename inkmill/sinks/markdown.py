"""One Markdown file per document, written in parallel.

A data source for Spark's own writer: each task writes its files to a folder of its own and moves them to their places when all
are written, so a reader never sees half a file, and a task that runs again replaces its files instead of leaving others. The
driver only hears how many there are. The target is a path or URI that all executors reach (a mounted folder, or any store that
Arrow's file systems know).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "inkmill_markdown"
#: Longest file name without its extension, in bytes.
MOST_NAME_BYTES = 200


def file_name(name: str) -> str:
    """A name that any file system takes; names that had to be changed get a hash of what they were."""
    safe = "".join("_" if c in '/\\\0:*?"<>|' or c < " " else c for c in name).lstrip(".")
    raw = safe.encode()
    if safe == name and 0 < len(raw) <= MOST_NAME_BYTES:
        return f"{safe}.md"
    return f"{raw[: MOST_NAME_BYTES - 20].decode(errors='ignore')}-{hashlib.sha256(name.encode()).hexdigest()[:16]}.md"


@dataclass
class Written(WriterCommitMessage):
    files: int


class MarkdownWriter(DataSourceWriter):
    """Writes rows with columns name and text."""

    def __init__(self, target: str):
        self.target, self.job = target, uuid.uuid4().hex

    def _place(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.target or self.target.startswith("file:"):
            system, path = fs.FileSystem.from_uri(self.target)
        else:
            system, path = fs.LocalFileSystem(), self.target
        return system, path.rstrip("/")

    def write(self, rows: Iterator[Row]) -> Written:
        system, target = self._place()
        context = TaskContext.get()
        own = f"{target}/_temporary/{self.job}/{context.taskAttemptId() if context else uuid.uuid4().hex}"
        system.create_dir(own, recursive=True)
        names = set()
        for row in rows:
            if row["text"] is not None:
                name = file_name(row["name"])
                names.add(name)
                with system.open_output_stream(f"{own}/{name}") as out:
                    out.write(row["text"].encode())
        for name in sorted(names):
            system.move(f"{own}/{name}", f"{target}/{name}")
        return Written(len(names))

    def _clean(self) -> None:
        system, target = self._place()
        folder = f"{target}/_temporary"
        if system.get_file_info(f"{folder}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{folder}/{self.job}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()
        system, target = self._place()
        system.create_dir(target, recursive=True)
        with system.open_output_stream(f"{target}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of tasks that were done stay, as a later run replaces them."""
        self._clean()


class MarkdownFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> MarkdownWriter:
        if set(schema.names) != {"name", "text"}:
            raise ValueError(f"expected columns name and text, not {schema.names}")
        return MarkdownWriter(self.options["path"])


def write_files(converted: DataFrame, target: str, text: str = "clean_md", key: str = "stem") -> None:
    """`<stem>.md` for each document that passed (clean text) or gave text (`text="raw_md"`).

    With `key="stem"` the documents are taken to have different stems, as after a run with that key. With `key="path"` a hash of
    the path is part of the name, so documents never share a file.
    """
    rows = converted.filter(F.col("status") == "success") if text == "clean_md" else converted
    name = F.col("stem") if key == "stem" else F.concat("stem", F.lit("-"), F.left(F.sha2("path", 256), F.lit(16)))
    converted.sparkSession.dataSource.register(MarkdownFiles)
    rows.select(name.alias("name"), F.col(text).alias("text")).write.format(FORMAT).mode("append").save(target)
