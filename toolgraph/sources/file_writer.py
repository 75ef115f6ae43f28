"""Files whose names and borders matter: one document a row, or one document in all.

A Python data source writer. Tasks write into a staging folder, each attempt into
its own, and tell the driver what they wrote; the driver's commit moves the files
to their names, and an abort removes the staging folder (a task that is still being
killed may leave files there). So no half file and no file twice stands under a name. Paths may be of any store that
Arrow's file systems know.

``file_of_each``: one file a row, named by a column. ``file_of_all``: one file with
the rows of a table (part, at, line) in that order, written by a single task that
streams them, since it is one document.

Defined results: rows of a null name are left out; of rows with one name one stays
(the last that the commit moves). A null body is an empty file.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: characters of a name that a file's may not have
UNSAFE = re.compile(r"[^\w.\- ]")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class StagedWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.mode = options["path"].rstrip("/"), options.get("kind", "each")
        self.staging = f"{self.path}.staging-{options['job']}"

    def write(self, iterator: Iterator[Row]) -> Written:
        store, staging = file_system(self.staging)
        own = f"{staging}/{uuid.uuid4().hex}"
        store.create_dir(own, recursive=True)
        files: list[tuple[str, str]] = []
        if self.mode == "all":
            rows = iter(iterator)
            first = next(rows, None)
            if first is not None:  # tasks without rows write nothing
                with store.open_output_stream(f"{own}/whole") as out:
                    out.write(first.line.encode() + b"\n")
                    for row in rows:
                        out.write(row.line.encode() + b"\n")
                files.append((f"{own}/whole", ""))
            return Written(files)
        for k, row in enumerate(iterator):
            with store.open_output_stream(f"{own}/{k}") as out:
                out.write((row.body or "").encode())
            files.append((f"{own}/{k}", UNSAFE.sub("_", row.name)))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.path)
        if self.mode == "each":
            store.create_dir(path, recursive=True)
        for message in messages:
            for at, name in message.files if message else []:
                store.move(at, f"{path}/{name}" if name else path)
        self.clear()

    def abort(self, messages: list[Written | None]) -> None:
        self.clear()

    def clear(self) -> None:
        store, staging = file_system(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class StagedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "staged_files"

    def writer(self, schema, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options)


def saved(spark: SparkSession, rows: DataFrame, path: str, kind: str) -> None:
    spark.dataSource.register(StagedFiles)
    rows.write.format("staged_files").option("kind", kind).option("job", uuid.uuid4().hex).mode("append").save(path)


def file_of_each(rows: DataFrame, name: str, body: str, path: str) -> None:
    """One file a row under ``path``: ``name`` is a column of file names, ``body`` one of texts."""
    saved(rows.sparkSession, rows.filter(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("name"), F.col(body).cast("string").alias("body")), path, "each")


def file_of_all(lines: DataFrame, path: str) -> None:
    """The lines of (part, at, line) as one file at ``path``."""
    ordered = lines.repartitionByRange(1, "part", "at").sortWithinPartitions("part", "at").select("line")
    saved(lines.sparkSession, ordered, path, "all")


def write_trajectory_files(trajectories: DataFrame, path: str, key: str = "intent_id") -> None:
    """``traj_<intent>.json`` for each intent: its row as a JSON object without null fields."""
    body = F.to_json(F.struct(*[c for c in trajectories.columns if c != key]))
    file_of_each(trajectories.select(F.concat(F.lit("traj_"), F.col(key).cast("string"), F.lit(".json")).alias("name"), body.alias("body")), "name", "body", path)
