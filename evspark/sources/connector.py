"""``spark.read.format("bibliography").load(folder_or_file)``: exports as a data source of Spark.

One partition a file: a reader for folders of exports that are small each. Large exports are better read by
``exports.read_files`` and ``exports.parse``, which spread the records of a file over the cluster.
"""

from __future__ import annotations

import glob
import os
import re

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from evspark.sources.exports import FORMATS, PARSED, read_tags, record_of


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _sniffed(text: str) -> str | None:
    if re.search(r"(?m)^PMID- ", text):
        return "medline"
    if re.search(r"(?m)^UT ", text) and re.search(r"(?m)^ER\s*$", text):
        return "wos"
    return "ris" if re.search(r"(?m)^TY\s{2}-", text) else None


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_File]:
        found = [p for p in glob.glob(os.path.join(self.path, "**"), recursive=True) if os.path.isfile(p)] if os.path.isdir(self.path) else glob.glob(self.path)
        return [_File(p) for p in sorted(found)]

    def read(self, partition: _File):
        with open(partition.path, encoding="utf-8-sig", newline=None) as f:
            text = f.read()
        name = _sniffed(text)
        if name is None:
            raise ValueError(f"{os.path.basename(partition.path)}: not an export of a known format")
        form = FORMATS[name]
        source = re.sub("[^a-z0-9]+", "_", os.path.splitext(os.path.basename(partition.path))[0].lower()).strip("_") or "ris"
        blocks = re.split(form.blocks, text)
        for k, block in enumerate(blocks[:-1] if form.closed else blocks):
            if record := record_of(read_tags(block, form), form, source):
                row = {"file": partition.path, "block": k, **record}
                yield tuple(row[c] for c in PARSED.names)


class Bibliography(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bibliography"

    def schema(self):
        return PARSED

    def reader(self, schema):
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Bibliography)
