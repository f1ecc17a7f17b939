"""File formats as immutable values that turn into Spark reader options."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from ..functions.times import spark_format

_NAMED: dict[str, "FileFormat"] = {}


@dataclass(frozen=True)
class FileFormat:
    """How the files of a stage are read.

    `null_if` texts and, when `empty_as_null`, empty fields become NULL after parsing;
    `skip_header` drops that many leading lines of each file.
    """

    kind: str
    delimiter: str = ","
    record_delimiter: str | None = None
    skip_header: int = 0
    quote: str = '"'
    escape: str = '"'
    null_if: tuple[str, ...] = ()
    empty_as_null: bool = True
    trim_space: bool = False
    error_on_column_count_mismatch: bool = True
    multi_line: bool = False
    date_format: str | None = None
    timestamp_format: str | None = None
    strip_outer_array: bool = False
    strip_null_values: bool = False
    allow_duplicate: bool = False
    binary_as_text: bool = True
    extra: tuple[tuple[str, str], ...] = field(default=())

    @staticmethod
    def csv(**kw) -> "FileFormat":
        return FileFormat("csv", **kw)

    @staticmethod
    def json(**kw) -> "FileFormat":
        return FileFormat("json", **kw)

    @staticmethod
    def parquet(**kw) -> "FileFormat":
        return FileFormat("parquet", **kw)

    @staticmethod
    def orc(**kw) -> "FileFormat":
        return FileFormat("orc", **kw)

    @staticmethod
    def avro(**kw) -> "FileFormat":
        return FileFormat("avro", **kw)

    @staticmethod
    def named(name: str) -> "FileFormat":
        if name not in _NAMED:
            raise KeyError(f"no file format named {name}; known: {sorted(_NAMED)}")
        return _NAMED[name]

    def register(self, name: str) -> "FileFormat":
        _NAMED[name] = self
        return self

    def with_(self, **kw) -> "FileFormat":
        return replace(self, **kw)

    @property
    def text(self) -> bool:
        """Fields arrive as text and are cast by the loader."""
        return self.kind in ("csv", "json")

    def options(self) -> dict[str, str]:
        """Options for spark.read. Paths are taken as they are: no partition guessing."""
        o = {"recursiveFileLookup": "true", **dict(self.extra)}
        if self.kind == "csv":
            o |= {
                "sep": self.delimiter, "quote": self.quote, "escape": self.escape, "columnPruning": "false",
                "header": str(self.skip_header > 0).lower(), "enforceSchema": "true", "multiLine": str(self.multi_line).lower(),
                "ignoreLeadingWhiteSpace": str(self.trim_space).lower(), "ignoreTrailingWhiteSpace": str(self.trim_space).lower(),
                "emptyValue": "",
            }
            if self.record_delimiter:
                o["lineSep"] = self.record_delimiter
        if self.kind == "json":
            o |= {"primitivesAsString": "true"}
            if self.multi_line or self.strip_outer_array:
                # a NUL is no character of JSON, so the whole file is one record. `multiLine` would do too, but it goes
                # back into the file for the text of every number, some KB each time
                o["lineSep"] = "\0"
        if self.kind == "parquet":
            o |= {"binaryAsString": str(self.binary_as_text).lower()}
        if self.date_format:
            o["dateFormat"] = spark_format(self.date_format)
        if self.timestamp_format:
            o["timestampFormat"] = spark_format(self.timestamp_format)
            o["timestampNTZFormat"] = spark_format(self.timestamp_format)
        return o


FileFormat.json(strip_null_values=False).register("json_format")
FileFormat.csv(skip_header=1, null_if=("NULL", "null", ""), trim_space=True).register("csv_format")
FileFormat.parquet().register("parquet_format")
FileFormat.orc().register("orc_format")


def reader(spark, fmt: FileFormat, **options):
    """spark.read for a format; says plainly when a format needs a package that is missing."""
    if fmt.kind == "avro" and not avro_available(spark):
        raise RuntimeError("the avro source needs the spark-avro package on the class path")
    return spark.read.format(fmt.kind).options(**(fmt.options() | options))


def avro_available(spark) -> bool:
    try:
        spark.read.format("avro").schema("a int").load([])
        return True
    except Exception:
        return False
