"""Listing-page snapshots as (url, html)."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.shared import exists, located
from fraclake.sinks.archives import file_system
from fraclake.sources.files import OPEN_BYTES, TASKS, dealt_by_bytes, list_files

#: Names that Spark's readers take for hidden, of folders below the given one and of files.
HIDDEN = r"(^|/)([.]|_(?!(common_)?metadata[^/]*/)(?![^/]*=))|[.]_COPYING_(/|$)"

#: Compressed pages that tasks read, and those that are left to Spark's reader.
_CODECS, _OTHER_CODECS = {".gz": "gzip", ".bz2": "bz2"}, ("deflate", "lz4", "snappy", "zst")

#: Pages, and bytes of them, that leave a task at a time.
_PAGES, _BYTES = 1_000, 4 << 20

#: What ``_metadata.file_path`` escapes: ASCII that no path of a URI holds, blanks and controls beyond ASCII.
_ESCAPED = re.compile(r"[^A-Za-z0-9_.!~'()*;:@&=+$,/\u0080-\U0010ffff-]"
                      r"|[\u0080-\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def read_pages(spark: SparkSession, folder: str, url_prefix: str) -> DataFrame:
    """Saved pages, one file each; the url is the prefix plus the path below ``folder``.

    Pages are small and many. Tasks list them and open those that they are dealt by bytes, some
    thousands each; the driver holds no list of them. Empty and hidden files are no pages, as
    for Spark's readers; pages compressed in a form that only Spark knows are left to its
    reader, which lists on the driver.
    """
    if not exists(spark, folder):
        raise FileNotFoundError(folder)
    root, within = (path.rstrip("/") for path in located(spark, folder))
    listed = list_files(spark, root or "/").withColumn("below", F.substring("path", F.lit(len(root) + 2), F.length("path")))
    files = listed.where((F.col("length") > 0) & ~F.col("below").rlike(HIDDEN))
    left = F.col("below").rlike(rf"(?i)[.]({'|'.join(_OTHER_CODECS)})$")
    pages = _opened(dealt_by_bytes(files.where(~left), TASKS * spark.sparkContext.defaultParallelism, open_bytes=OPEN_BYTES))
    if not files.where(left).isEmpty():
        either = ",".join("".join(f"[{c}{c.upper()}]" for c in codec) for codec in _OTHER_CODECS)
        raw = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*.{{{either}}}")
        path = F.regexp_replace("_metadata.file_path", "^[^:/]+:(//[^/]*)?", "")
        pages = pages.unionByName(raw.select(F.substring(path, F.lit(len(within) + 2), F.length(path)).alias("below"), "value"))
    return pages.select(F.concat(F.lit(url_prefix), "below").alias("url"), F.col("value").alias("html"))


def _opened(files: DataFrame) -> DataFrame:
    """(below, value) of (path, below) rows, below as it stands in a URI."""

    def batch_of(below: list[str], pages: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(below, pa.string()), pa.array(pages, pa.binary())], names=["below", "value"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        pages: list[bytes] = []
        held = 0
        for batch in batches:
            for uri, below in zip(batch.column("path").to_pylist(), batch.column("below").to_pylist()):
                store, path = file_system(uri)
                with store.open_input_stream(path, compression=_CODECS.get(os.path.splitext(below)[1].lower())) as stream:
                    pages.append(stream.read())
                names.append(_ESCAPED.sub(lambda found: quote(found[0], safe=""), below))
                held += len(pages[-1])
                if held >= _BYTES or len(pages) >= _PAGES:
                    yield batch_of(names, pages)
                    names, pages, held = [], [], 0
        yield batch_of(names, pages)

    read_rows = files.select("path", "below").mapInArrow(read, "below string, value binary")
    return read_rows.withColumn("value", F.col("value").cast("string"))
