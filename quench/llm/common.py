"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quench.session import scratch_path

#: Broadcast hints are given only to tables measured to be at most this large.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """Every input column packed in one struct, so that names an operator adds cannot clash."""
    return F.struct(*[col(c) for c in df.columns])


def text_rows(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> tuple[DataFrame, int | None]:
    """``id`` and the text for a Python stage, and ``row`` with ``carry``; a text inside ``row`` is not sent twice:
    the number is its place there (None: it is the column ``text``)."""
    own = [col(id_col).alias("id"), *([whole_row(docs).alias("row")] if carry else [])]
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    if carry and kinds.get(text_col) == T.StringType():
        return docs.select(*own), docs.columns.index(text_col)
    return docs.select(*own, text_of(text_col).alias("text")), None


def texts(batch: pa.RecordBatch, place: int | None) -> list[str]:
    """The batch's texts; null counts as empty."""
    column = batch.column(batch.schema.get_field_index("text" if place is None else "row"))
    return [t.as_py() or "" for t in (column if place is None else column.field(place))]


_IN_USE: dict[str, Callable[[], None]] = {}


def sole_cache(owner: str, clear: Callable[[], None]) -> None:
    """Frees what other operators' tasks have cached in this worker process, which outlives their stages."""
    for other in [o for o in _IN_USE if o != owner]:
        _IN_USE.pop(other)()
    _IN_USE[owner] = clear


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later uses neither recompute it
    nor depend on files that only a lost executor held."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def least_hashed(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """The ``n`` rows of least id hash. A share that holds about ``2 n`` rows is filtered first, so that
    neither the tasks nor the driver sort and send more than a few rows each."""
    place = F.pmod(F.xxhash64(col(id_col)), F.lit(1 << 40))
    share = min(1.0, 2.0 * n / max(df.count(), 1))
    return df.filter(place < F.lit(int(share * (1 << 40)) + 1)).orderBy(place, id_col).limit(n)
