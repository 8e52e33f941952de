"""Services that answer page by page, as a source for Spark: `channel_uploads` reads landed responses of a video service's lists of uploads.

Responses lie in folders channel_id=<channel>/token=<token>, as text files of one JSON object each; a channel's first one has the token `first`, and
each names the next one's token. Reading in a batch follows each channel's tokens in a partition of its own, up to `most` videos. As a stream,
the offset is the number of responses of each channel that have been read, in the order in which they landed (by token, numbers by value); responses that land later are
new rows, PAGES of them a partition.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Videos that a batch takes of a channel, and responses that a partition of a stream reads.
MOST, PAGES = 500, 20
FIRST = "first"
ROWS = "channel_id string, rank bigint, video_id string, title string, description string, published_at string"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def _folders(path: str, kind: str) -> dict[str, str]:
    """Value and path of the folders kind=<value> below path."""
    store, at = _store(path)
    found = store.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    return {unquote(f.base_name.partition("=")[2]): f.path for f in found if f.type == pafs.FileType.Directory and f.base_name.startswith(f"{kind}=")}


def _response(root: str, folder: str) -> dict | None:
    """The response in a folder; None if there is none, or no JSON object."""
    store, _ = _store(root)
    for f in sorted(store.get_file_info(pafs.FileSelector(folder, allow_not_found=True)), key=lambda f: f.path):
        if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")) and f.size:
            with store.open_input_stream(f.path) as s:
                try:
                    value = json.loads(s.read())
                except ValueError:
                    return None
                return value if isinstance(value, dict) else None
    return None


def _rows(channel: str, start: int, page: dict) -> Iterator[tuple]:
    for k, item in enumerate(page.get("items") or []):
        s = item.get("snippet") or {}
        yield channel, start + k + 1, (s.get("resourceId") or {}).get("videoId"), s.get("title"), s.get("description"), s.get("publishedAt")


@dataclass
class Channel(InputPartition):
    channel: str
    folder: str


@dataclass
class Pages(InputPartition):
    channel: str
    folders: list[str]
    first: int


class UploadsReader(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def partitions(self) -> list[Channel]:
        return [Channel(c, p) for c, p in sorted(_folders(self.path, "channel_id").items())]

    def read(self, partition: Channel | None) -> Iterator[tuple]:
        if partition is None:  # there is no channel
            return
        tokens = _folders(_qualified(self.path, partition.folder), "token")
        token, seen, n = FIRST, set(), 0
        while token in tokens and token not in seen and n < self.most:
            seen.add(token)
            page = _response(self.path, tokens[token])
            if page is None:
                return
            for row in _rows(partition.channel, n, page):
                if row[1] <= self.most:
                    yield row
            n += len(page.get("items") or [])
            token = page.get("nextPageToken")


def _qualified(root: str, path: str) -> str:
    """A path that _store() reads, of one that it gave out."""
    return path if "://" not in root else root.partition("://")[0] + "://" + path.lstrip("/") if not root.startswith("file:") else path


def _in_order(tokens: dict[str, str]) -> list[str]:
    """Folders of responses: the first one, then by token, numbers in tokens by their values."""
    parts = lambda t: [(int(x), "") if x.isdigit() else (-1, x) for x in re.split(r"(\d+)", t)]
    return [tokens[t] for t in sorted(tokens, key=lambda t: (t != FIRST, parts(t)))]


class UploadsStream(DataSourceStreamReader):
    """Rank counts a channel's responses times 2^20, so that it grows within a channel whatever is read together."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {c: len(_folders(_qualified(self.path, p), "token")) for c, p in _folders(self.path, "channel_id").items()}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        out = []
        for c, p in sorted(_folders(self.path, "channel_id").items()):
            folders = _in_order(_folders(_qualified(self.path, p), "token"))
            out += [Pages(c, folders[k : min(k + PAGES, end.get(c, 0))], k) for k in range(start.get(c, 0), end.get(c, 0), PAGES)]
        return out

    def read(self, partition: Pages) -> Iterator[tuple]:
        for k, folder in enumerate(partition.folders, partition.first):
            page = _response(self.path, folder)
            if page is not None:
                yield from _rows(partition.channel, k << 20, page)

    def commit(self, end: dict) -> None:
        pass


class Uploads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "channel_uploads"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> UploadsReader:
        return UploadsReader(self.options["path"], int(self.options.get("most", MOST)))

    def streamReader(self, schema) -> UploadsStream:  # noqa: N802
        return UploadsStream(self.options["path"])


def register(spark: SparkSession) -> None:
    """From now on, spark.read.format("channel_uploads") and spark.readStream.format("channel_uploads") work; option `path`, and `most` for batches."""
    spark.dataSource.register(Uploads)
