"""What the text operators share: Arrow blocks of bounded size.

An operator reads only its key and text columns (so extra columns, whatever
their names, never reach it) and maps Arrow batches of whole texts to rows.
``map_blocks`` cuts the batches so that one block holds about ``BLOCK_BYTES``
of text; a longer text is a block of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20
#: Bytes that one Arrow batch between the JVM and a Python worker may hold.
ARROW_BATCH_BYTES = 32 << 20
WHITE = b" \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (texts can be long) and let workers import
    this package where the driver did; elsewhere it is shipped as usual."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def id_text(df: DataFrame, id_col: str, text: str, *more: Column) -> DataFrame:
    """(doc_id, text) and ``more``, whatever else ``df`` has."""
    prepare(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *more)


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches where the text column passes ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def map_blocks(df: DataFrame, text: str, schema: str, fn: Callable[[pa.RecordBatch], dict | None],
               limit: int = BLOCK_BYTES) -> DataFrame:
    """``fn`` maps a block to columns named as in ``schema`` (arrays or lists)."""
    names, types = [], []
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    for f in arrow:
        names.append(f.name)
        types.append(f.type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, limit):
            out = fn(block)
            if out is None:
                continue
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) and x.type == t else pa.array(x, type=t) if not isinstance(x, pa.Array)
                 else x.cast(t) for x, t in ((out[n], t) for n, t in zip(names, types))], names=names)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """``df`` with the rows whose mask is true, all columns as they were."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            yield block.filter(pa.array(fn(block)))

    return df.mapInArrow(run, df.schema)


def texts(block: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in block.column(name).cast(pa.binary()).to_pylist()]


def words_of(block: pa.RecordBatch, name: str = "text", lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a block in one Arrow array, and the
    number of words of each text (null: none)."""
    col = pc.fill_null(block.column(name), "")
    if lower:
        col = pc.ascii_lower(col)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(col))
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    if len(size) and not size.all():  # an empty text splits into one empty string
        starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
        empty = size == 0
        counts = counts - (np.add.reduceat(np.append(empty, False), starts) * (counts > 0))
        flat = flat.filter(pa.array(~empty))
    return flat, counts


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other letter left."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of an id's text modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MAPPED: dict = {}


def mapped_file(key: str, data: bytes, load: Callable[[str], object]):
    """``load(path)`` of a file with ``data`` that a worker process maps once
    for a ``key`` (one that the driver made for the data).

    The file lies in the worker's own temporary folder and is unlinked as soon
    as it is mapped; the mapping stays.
    """
    if key not in _MAPPED:
        _MAPPED.clear()
        handle, path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as f:
            f.write(data)
        _MAPPED[key] = load(path)
        os.unlink(path)
    return _MAPPED[key]


def new_key() -> str:
    return uuid.uuid4().hex
