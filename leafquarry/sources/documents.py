"""A Python data source for PDF files, registered only where a reader library is installed.

`register(spark)` adds the format "pdf_layout": option path (a glob), one row per page in the layout schema of
`files.LAYOUT`. Each file is one input partition and is opened on an executor; a page filter is pushed to the reader.
"""

from __future__ import annotations

import glob
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from .files import LAYOUT

try:
    import fitz
except ImportError:
    fitz = None


class PdfPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pdf_layout"

    def schema(self) -> str:
        return LAYOUT

    def reader(self, schema) -> DataSourceReader:
        return PdfReader(self.options["path"])


class PdfReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path, self.page = path, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("page",):
                self.page = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        # The files must be readable by the executors under the same path, as the reader library opens them itself.
        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with fitz.open(partition.value) as doc:
            for no in range(doc.page_count) if self.page is None else [self.page - 1]:
                if 0 <= no < doc.page_count:
                    yield page_row(partition.value, no + 1, doc[no])


def page_row(path: str, number: int, page) -> tuple:
    """One page of an open document in the layout schema."""
    lines = []
    for block in page.get_text("dict")["blocks"]:
        for line in block.get("lines", []):
            x0, y0, x1, y1 = line["bbox"]
            spans = [(s["text"], s["font"], int(s["flags"]), float(s["size"])) for s in line["spans"]]
            lines.append((y0, x0, y1, x1, float(line.get("dir", (1, 0))[1]), spans))
    tables = [(list(map(float, t.bbox)), t.extract()) for t in page.find_tables()]
    drawings = [(*map(float, d["rect"]), list(d["fill"]) if d.get("fill") else None) for d in page.get_drawings()]
    links = [(k["uri"], float(k["from"].y0), float(k["from"].x0), page.get_textbox(k["from"]).strip()) for k in page.get_links() if k.get("uri")]
    return path, number, float(page.rect.width), float(page.rect.height), lines, tables, drawings, links


def register(spark: SparkSession) -> bool:
    """Whether the format could be registered."""
    if fitz is None:
        return False
    spark.dataSource.register(PdfPages)
    return True
