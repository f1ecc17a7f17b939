"""Rows, locators and Arrow batches shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.session import staged

#: A word: only ASCII white space parts words here.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(docs: DataFrame, name: str = "_locator") -> DataFrame:
    """`docs` with a column that names each row's place: file and row number in it.

    The place is the same whenever the files are read again, which a generated row number
    is not. `docs` is a table read from files, with columns chosen or rows filtered at most; a
    frame without files is written to the working folder, once for each frame object, so that
    every call for one object gives the same places. A column of the caller's that has the
    locator's name is left out (`spare` finds a free one); one called `_metadata` stays as it is.
    """
    try:
        return _placed(docs, name)
    except AnalysisException:
        if getattr(docs, "_written", None) is None:
            docs._written = staged(docs, "located")
        return _placed(docs._written, name)


def _placed(docs: DataFrame, name: str) -> DataFrame:
    origin = docs.metadataColumn("_metadata")
    place = F.concat_ws("#", origin["file_path"], origin["row_index"].cast("string")).alias(name)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()], place)


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever they run, once."""
    context = spark.sparkContext
    if getattr(context, "_has_loadkit", False):
        return
    top = Path(__file__).parent.parent
    where = Path(tempfile.mkdtemp(prefix="loadkit-code-")) / "loadkit_code.zip"
    with zipfile.ZipFile(where, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(str(where))
    context._has_loadkit = True


def by_batch(df: DataFrame, columns: list, schema: str, fn: Callable[[pa.RecordBatch], dict], keeps: bool = False) -> DataFrame:
    """fn over Arrow batches of `columns`; it returns a dict of arrays in the order of `schema`.

    Unless fn `keeps` something from task to task, what others kept in the worker goes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    ship(df.sparkSession)
    return df.select(*columns).mapInArrow(run, schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of `rows` rows at most, without copies; what is made of a part is all that is held."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(column: pa.Array) -> list[str]:
    return [s or "" for s in column.to_pylist()]


def same(a, b):
    """Equality that also holds between nulls."""
    return a.eqNullSafe(b)


_remembered: dict = {}


def remembered(name, make: Callable):
    """What a Python worker keeps from task to task under `name`. Workers outlive operators, so
    only what was asked for last is kept: an operator's cache goes when another one's begins."""
    if name not in _remembered:
        _remembered.clear()
        _remembered[name] = make()
    return _remembered[name]


def forget() -> None:
    _remembered.clear()


def spare(df: DataFrame, name: str = "_locator") -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
