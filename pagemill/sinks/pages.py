"""One file per page (`format("page_files")`): a data-source writer that names its
own files. Tasks write into a folder of the job; files get their names when the job
commits, and what retried tasks left behind goes with that folder."""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from pagemill.sources.warc import _open_fs

NAME_BYTES = 240  # of a file name; longer ones end with a digest
MOVES = 16


@dataclass
class PagePart(WriterCommitMessage):
    folder: str


def stored_name(name: str) -> str:
    data = name.encode()
    if len(data) <= NAME_BYTES:
        return name
    return data[: NAME_BYTES - 33].decode("utf-8", "ignore") + "-" + hashlib.md5(data).hexdigest()


class PageFileWriter(DataSourceWriter):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.job = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, root = _open_fs(self.path)
        folder = f"{root}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(folder, recursive=True)
        for row in iterator:
            with fs.open_output_stream(f"{folder}/{stored_name(row['file_name'])}", compression=None) as out:
                out.write((row["text"] or "").encode())
        return PagePart(folder)

    def commit(self, messages):
        fs, root = _open_fs(self.path)
        with ThreadPoolExecutor(MOVES) as pool:
            for part in messages:
                if part is not None:
                    files = fs.get_file_info(pafs.FileSelector(part.folder))
                    list(pool.map(lambda f: fs.move(f.path, f"{root}/{f.base_name}"), files))
        self._drop(fs, root)

    def abort(self, messages):
        self._drop(*_open_fs(self.path))

    def _drop(self, fs, root):
        if fs.get_file_info(f"{root}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.job}")


class PageFiles(DataSource):
    @classmethod
    def name(cls):
        return "page_files"

    def schema(self):
        return "file_name string, text string"

    def writer(self, schema, overwrite):
        return PageFileWriter(self.options)
