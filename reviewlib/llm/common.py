"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"
# High bits of ids are folded onto low ones, this far below, to place them in a bitmap.
_FOLD = 29


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one that the session names in ``spark.checkpoint.dir``.

    Only a plain local session may do without the setting: it has one process and one disk.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="reviewlib-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, and safe
    when executors are lost. ``codec`` compresses it otherwise than the session says."""
    path = scratch(df.sparkSession)
    write = df.write.option("compression", codec) if codec else df.write
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns most operators read, with no other that could clash."""
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


# Bytes of text that one call of a function given to map_texts sees, at least one text.
_SLICE = 1 << 20


def slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about a megabyte of the string column at ``at``."""
    ends = np.cumsum(pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + _SLICE)))
        yield batch.slice(lo, hi - lo)
        lo = hi


def map_texts(
    df: DataFrame,
    text: str,
    schema: T.StructType,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """``df`` plus the columns of ``schema``, which replace columns of the same name.

    ``make`` is called once per task and gives a function from some texts to the new columns.
    """
    new = {f.name.lower() for f in schema.fields}
    kept = [c for c in df.columns if c.lower() not in new]
    own = "_text"
    while own in kept:
        own += "_"
    rows = df.select(*(quoted(c) for c in kept), quoted(text).cast("string").alias(own))
    out = T.StructType([f for f in rows.schema.fields[:-1]] + list(schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, len(kept)):
                columns = part.columns[:-1] + function(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return rows.mapInArrow(run, out)


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """Bits set for the values of a long column, at least 128 to a value up to a bound of
    16 MB. It may go to all tasks: when it is full it only lets more rows pass."""
    count = df.count()
    bits = min(27, max(16, (128 * count).bit_length()))
    folded = F.col(column).bitwiseXOR(F.shiftrightunsigned(column, _FOLD))
    slot = folded.bitwiseAND(F.lit((1 << bits) - 1))
    words = df.select(
        F.shiftright(slot, 6).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int")).alias("bit"),
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def maybe_in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False only for values that :func:`bitmap` has not seen."""
    folded = values.view(np.uint64) ^ (values.view(np.uint64) >> np.uint64(_FOLD))
    slot = (folded & np.uint64(64 * len(bits) - 1)).astype(np.int64)
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


def bin_of(key: Column, probes: list[int]) -> Column:
    """How many of the ascending ``probes`` are at or below ``key``, by binary search."""
    array = F.lit(probes)
    top = 1 << max(0, len(probes).bit_length() - 1)
    steps = F.lit([top >> i for i in range(top.bit_length())])

    def further(low: Column, step: Column) -> Column:
        passed = F.coalesce(F.get(array, low + step - 1) <= key, F.lit(False))
        return low + F.when(passed, step).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), further)
