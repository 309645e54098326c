"""Scanned files as pages, and documents as files.

Rasterising needs decoders this package does not bring: a decoder is a function
from a file's bytes to an iterator of pages, run on the executors over Arrow
batches.  Without one the file is one page.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Decoder = Callable[[bytes], Iterator[tuple[int, int, bytes]]]
PAGES = "path string, page_idx int, height int, width int, content binary"


def page_files(spark: SparkSession, path: str, decoder: Decoder | None = None, glob: str | None = None) -> DataFrame:
    """A row for each page of each file: path, page, size, raster; unreadable files raise with their path."""
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b.path, b.content):
                try:
                    pages = list(decoder(content)) if decoder else [(0, 0, content)]
                except Exception as e:
                    raise ValueError(f"cannot decode {name}: {e}") from e
                yield pd.DataFrame({"path": name, "page_idx": range(len(pages)), "height": [p[0] for p in pages], "width": [p[1] for p in pages], "content": [p[2] for p in pages]})

    return files.mapInPandas(run, PAGES)


def checked(content: bytes, prefix: str) -> bool:
    """Does the SHA-256 of a download begin with the prefix?"""
    return hashlib.sha256(content).hexdigest().startswith(prefix)


def write_documents(texts: DataFrame, path: str, name: str, text: str = "text") -> None:
    """Each document's text as lines of files in a folder named after the document."""
    texts.select(F.col(name), F.explode(F.split(text, "\n")).alias("value")).repartition(name).write.mode("overwrite").partitionBy(name).text(path)


def page_file_name(base: str, page: str, pages: str):
    """``stem_page_i.ext`` where a document has several pages."""
    dot = base.rfind(".")
    stem, ext = (base[:dot], base[dot:]) if dot > 0 else (base, "")
    return F.when(F.col(pages) > 1, F.concat(F.lit(f"{stem}_page_"), F.col(page), F.lit(ext))).otherwise(F.lit(base))
