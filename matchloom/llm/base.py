"""What the operators of this folder share: words, held-out rows, Arrow scans, scratch tables.

Every operator reads only the columns it names, so extra columns with any names are ignored;
null text counts as empty text. A null ``doc_id`` is kept as null and never matches a remainder.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: A word is a run of anything but ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE = 4 << 20  # bytes of text that a Python function gets at once
FOLD = str.maketrans(UPPER, LOWER)
#: The same for UTF-8; ``bytes.split()`` then gives the words.
BYTE_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def ships(name: str) -> None:
    """Send the module's functions along with tasks: executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ships(__name__)


def remainder(divisor: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``divisor``; -1 for a null ``doc_id``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor, F.lit(-1)).cast("int")


def fold(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null or blank text. Splitting at one plain character is
    several times faster than at a pattern."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * 5), " "), "")


def map_batches(df: DataFrame, make: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``make`` turns the columns of an Arrow batch (name to list) into the output columns."""
    types = [to_arrow_type(f.dataType) for f in T.StructType.fromDDL(schema)]
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                made = make({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[n], type=t) for n, t in zip(names, types)], names=names)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text (a list's values count 32 each): what is made of a slice fits in memory
    whatever the length of the texts."""
    weight = np.ones(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            weight += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        elif pa.types.is_list(column.type):
            weight += 32 * pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(np.diff(np.cumsum(weight) // size)) + 1
    for a, b in zip([0, *cut], [*cut, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)
