"""A key-value store of files: what :func:`pacewatch.operators.online.write_online` writes to where no server is."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, fields map<string,string>, ttl long"


class FileClient:
    """Client with the pipeline calls of a key-value store; runs on executors.

    A pipeline's commands become one file, named by the digest of its content and renamed
    into place when it is whole: sent twice it is the same file, and what broke off in the
    middle is never read. ``uri`` is a folder that all executors share.
    """

    def __init__(self, uri: str):
        self.files, self.folder = fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")
        self.files.create_dir(self.folder, recursive=True)

    def pipeline(self, transaction: bool = False) -> FilePipeline:
        return FilePipeline(self)

    def put(self, name: str, data: bytes) -> None:
        aside = f"{self.folder}/_{uuid.uuid4().hex}"
        with self.files.open_output_stream(aside) as out:
            out.write(data)
        self.files.move(aside, f"{self.folder}/{name}")

    def close(self) -> None:
        pass


class FilePipeline:
    """Commands that are carried out together."""

    def __init__(self, client: FileClient):
        self.client, self.rows = client, {}

    def hset(self, key: str, mapping: Mapping[str, str]) -> None:
        self.rows.setdefault(key, {"key": key, "fields": {}, "ttl": None})["fields"].update(mapping)

    def expire(self, key: str, ttl: int) -> None:
        if key in self.rows:
            self.rows[key]["ttl"] = ttl

    def execute(self) -> None:
        lines = "".join(json.dumps(row, sort_keys=True) + "\n" for row in self.rows.values())
        data = lines.encode()
        self.client.put(f"{hashlib.sha256(data).hexdigest()}.json", data)


def read_written(spark: SparkSession, uri: str) -> DataFrame:
    """(key, fields, ttl) of a folder that one sync wrote; a key that came in two chunks counts once."""
    return spark.read.schema(SCHEMA).json(uri).dropDuplicates(["key"])
