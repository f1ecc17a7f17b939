"""WARC archives of pages: written with revisit records, read back by verified chains of records.

A payload may hold the bytes that begin a record. So where a part of an archive is read alone,
each such place is only a candidate, and its header names where its successor must begin.
Every task resolves the candidates of its part to the first place behind the part; pointer
jumping over these, from the start of each file, leaves the places where a chain that begins at
the file's start enters a part. Reading goes from those places on, from record to record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.session import release, staged

from .common import forget, located, ship
from .token_files import _publish, store

MAGIC, END = b"WARC/1.", b"\r\n\r\n"
#: Bytes of a payload that make it worth a revisit record.
LEAST = 100
#: Bytes of an archive before the next one begins, and of a part that one task reads.
ARCHIVE, PART = 1 << 30, 1 << 23
#: The reader's first guess of a header's length.
_HEAD = 1 << 14
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY, _REFERS_KEY = "Loadkit-Key", "Loadkit-Refers-To-Key"
_RECORDS = "path string, offset bigint, record_type string, record_id string, key bigint, target_uri string, payload_bytes bigint, payload_digest string, refers_to_id string, refers_to bigint"


def record_id(key: int | None, locator: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{key} {locator}'.encode()).digest())}>"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record; fields that are None are left out, and line ends in values become blanks."""
    lines = [f"{name}: {re.sub(r'[\r\n]+', ' ', str(value))}\r\n" for name, value in fields if value is not None]
    return b"WARC/1.1\r\n" + "".join(lines).encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + END


def _page(key, uri, locator, digest, payload: bytes, first, date: str) -> bytes:
    """A response, or a revisit if `first` is the (key, locator) of the response with the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", record_id(key, locator)), ("WARC-Date", date), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"), (_KEY, key), ("Content-Type", "application/http; msgtype=response"),
    ]
    if first:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(*first)), (_REFERS_KEY, first[0])]
    return record(fields, http + (b"" if first else payload))


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(locator, key, digest, bytes) -> for each row that revisits another one: locator, first_key, first_locator.

    Of rows with equal digests and `least` bytes or more, the one with the smallest key comes
    first (of equal keys the one whose place comes first; a null key is more than all). Rows of a
    digest are dealt over salts before anything meets, so a payload may have any number of copies.
    """
    salts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.where(F.col("bytes") >= least).withColumn("salt", F.pmod(F.xxhash64("locator"), F.lit(salts)))
    low = F.min(F.struct(F.col("key").isNull(), "key", "locator")).alias("low")
    some = rows.groupBy("digest", "salt").agg(low, F.count(F.lit(1)).alias("n"))
    whole = some.groupBy("digest").agg(F.min("low").alias("first"), F.sum("n").alias("n")).where("n > 1")
    first = some.select("digest", "salt").join(whole.select("digest", "first"), "digest")
    met = rows.join(first, ["digest", "salt"]).where(F.col("locator") != F.col("first.locator"))
    return met.select("locator", F.col("first.key").alias("first_key"), F.col("first.locator").alias("first_locator"))


def write(pages: DataFrame, folder: str, date: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = LEAST, archive: int = ARCHIVE) -> DataFrame:
    """Write a record per row of `pages` below `folder`; returns the manifest: path, bytes, records.

    Payloads are in UTF-8, null ones empty; null keys and addresses are left out of a record.
    Equal payloads of at least `least` bytes are written once; the others revisit it (see
    `revisits`). Repeated rows give a record each, columns but these three are not read, an empty
    table gives no archive. A task writes its rows to archives of about `archive` bytes, as its
    own copies that take their names when all are complete. The manifest counts: what a lost
    task left behind is in no manifest. `date` is the date of all records.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(payload), F.lit(""))
    rows = located(pages).select(F.col("_locator").alias("locator"), F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), html.alias("payload"), F.sha2(html, 256).alias("digest"))
    light = staged(rows.select("locator", "key", "digest", F.octet_length("payload").cast("long").alias("bytes")), "payloads")
    told = staged(revisits(light, least), "revisits")
    records = rows.join(told, "locator", "left").select("key", "uri", "locator", "digest", "payload", "first_key", "first_locator")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        task = TaskContext.get()
        (fs, root), attempt = store(folder), str(task.taskAttemptId())
        done, out, path, size, count = [], None, None, 0, 0
        for batch in batches:
            texts = batch.column("payload").cast(pa.binary()).to_pylist()
            others = [batch.column(c).to_pylist() for c in ("key", "uri", "locator", "digest", "first_key", "first_locator")]
            for text, k, u, place, digest, first_key, first_place in zip(texts, *others, strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path = f"{task.partitionId():07d}-{len(done):05d}.warc"
                    out = fs.open_output_stream(f"{root}/{path}.{attempt}")
                    size, count = out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, path)), ("WARC-Date", date), ("WARC-Filename", path), ("Content-Type", "application/warc-fields")], b"software: loadkit\r\n")), 1
                size += out.write(_page(k, u, place, digest, text, (first_key, first_place) if first_place else None, date))
                count += 1
                if size >= archive:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        for path, _, _ in done:
            _publish(fs, f"{root}/{path}", attempt)
        for path, size, count in done:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "bytes": [size], "records": [count]})

    ship(spark)
    manifest = staged(records.mapInArrow(run, "path string, bytes bigint, records bigint"), "archives")
    release(light)
    release(told)
    return manifest


class Part:
    """Bytes of a file from `low` on, read as they are asked for."""

    def __init__(self, file, low: int, size: int):
        self.file, self.low, self.end, self.held = file, low, size, b""

    def upto(self, at: int) -> None:
        """Hold all bytes before `at`, as far as the file has them."""
        more = min(at, self.end) - self.low - len(self.held)
        if more > 0:
            self.held += self.file.read_at(more, self.low + len(self.held))

    def take(self, a: int, b: int) -> bytes:
        self.upto(b)
        return self.held[a - self.low : b - self.low]

    def header(self, at: int) -> tuple[dict[str, str], int] | None:
        """Fields of the header at a place, names in lower case, and where it ends; None if there is no whole header with a length."""
        reach = _HEAD
        while True:
            self.upto(at + reach)
            stop = self.held.find(END, at - self.low)
            if stop >= 0 or at + reach >= self.end:
                break
            reach *= 4
        if stop < 0 or not self.held.startswith(MAGIC, at - self.low):
            return None
        fields = {}
        for line in self.held[at - self.low : stop].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdecimal():
            return None
        return fields, self.low + stop + len(END)


def successors(part: Part, low: int, high: int) -> tuple[list[int], list[int]]:
    """Candidates from `low` to before `high`: where a record may begin, and where its successor then must (-1: behind the file's end)."""
    part.upto(high + len(MAGIC) - 1)
    at, places, following = part.held.find(MAGIC, low - part.low), [], []
    while at >= 0 and part.low + at < high:
        place = part.low + at
        if place == 0 or part.held[at - 1 : at] == b"\n":
            found = part.header(place)
            if found:
                places.append(place)
                stop = found[1] + int(found[0]["content-length"]) + len(END)
                following.append(stop if stop <= part.end else -1)
        at = part.held.find(MAGIC, at + 1)
    return places, following


def exits(places: np.ndarray, following: np.ndarray, high: int) -> np.ndarray:
    """Where the chain from each candidate of a part leaves it: the first place from `high` on, -1 if
    the chain comes to a place in the part where no record can begin. By pointer jumping."""
    at = np.searchsorted(places, following)
    inside = (following < high) & (np.where(at < len(places), places[np.minimum(at, len(places) - 1)], -1) == following)
    out = np.where(following >= high, following, -1)
    jump = np.where(inside, at, np.arange(len(places)))
    while (jump[jump] != jump).any():
        jump = jump[jump]
    return out[jump]


def entries(manifest: DataFrame, part: int = PART) -> DataFrame:
    """(path, bytes, low, at, exit): for each part of each archive where the chain from the file's start enters it, and leaves it.

    Tasks emit the candidates of their parts; those that nothing leads to are left out, and the
    rest is followed from the files' starts by doubling, in as many rounds as the parts of a
    file have binary digits.
    """
    spark = manifest.sparkSession
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.floor((F.greatest("bytes", F.lit(1)) - 1) / part))).alias("k"))
    ranges = ranges.select("path", "bytes", (F.col("k") * part).cast("long").alias("low"))
    known = ranges.agg(F.count(F.lit(1)).alias("n"), F.max("low").alias("low")).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = store(row["path"])
                low, high = row["low"], min(row["low"] + part, row["bytes"])
                with fs.open_input_file(path) as file:
                    # the byte before tells whether a line begins at `low`
                    places, following = successors(Part(file, max(0, low - 1), min(file.size(), row["bytes"])), low, high)
                if places:
                    out = exits(np.array(places), np.array(following), high)
                    yield pa.RecordBatch.from_pydict({"path": [row["path"]] * len(places), "bytes": [row["bytes"]] * len(places), "low": [low] * len(places), "at": pa.array(places, pa.int64()), "exit": pa.array(out, pa.int64())})

    ship(spark)
    spread = ranges.repartition(max(1, known.n), "path", "low")
    found = staged(spread.mapInArrow(run, "path string, bytes bigint, low bigint, at bigint, exit bigint"), "candidates")
    ends = found.where("exit >= 0").select("path", F.col("exit").alias("at")).distinct()
    meant = staged(found.join(ends, ["path", "at"], "left_semi").select("path", "at", "exit"), "meant")
    places = found.where("at = 0").select("path", "at")
    jumps = places.join(found, ["path", "at"]).select("path", "at", "exit").union(meant)
    for _ in range(int((known.low or 0) // part).bit_length()):
        places = staged(places.union(places.join(jumps, ["path", "at"]).select("path", F.col("exit").alias("at"))).distinct(), "places")
        beyond = jumps.select("path", F.col("at").alias("exit"), F.col("exit").alias("beyond"))
        jumps = staged(jumps.join(beyond, ["path", "exit"]).select("path", "at", F.col("beyond").alias("exit")), "jumps")
    return staged(found.join(places, ["path", "at"], "left_semi"), "entries")


def damaged(manifest: DataFrame, reached: DataFrame) -> DataFrame:
    """Archives whose chain of records does not end where the file does: path, bytes, whole (bytes in whole records up to the break, by parts)."""
    ends = reached.groupBy("path").agg(F.max("exit").alias("whole"))
    return manifest.join(ends, "path", "left").select("path", "bytes", F.coalesce("whole", F.lit(-1)).alias("whole")).where("whole <> bytes")


def walk(part: Part, at: int, high: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, fields and block of each record from `at` on that begins before `high`; it ends where no whole record follows."""
    while at < high:
        found = part.header(at)
        if found is None:
            return
        fields, start = found
        stop = start + int(fields["content-length"])
        if part.take(stop, stop + len(END)) != END:
            return
        yield at, fields, part.take(start, stop)
        at = stop + len(END)


def read(manifest: DataFrame, part: int = PART, payload: bool = True, strict: bool = True) -> DataFrame:
    """Every response and revisit record of the archives: path, offset, record_type, record_id, key,
    target_uri, payload_bytes, payload_digest, refers_to_id, refers_to (the key of the response) and,
    if asked for, payload (null in a revisit).

    manifest: path and bytes of archives. A revisit tells the length and digest of the whole
    payload in its headers; a response's are taken from the payload and must agree with its
    header. An archive that is cut off or overwritten raises an error; with `strict` off the
    records up to the break are returned, and `damaged` names such archives. A task holds one part
    and one record. An empty manifest gives no record.
    """
    reached = entries(manifest, part)
    if strict and (bad := damaged(manifest, reached).limit(3).collect()):
        raise ValueError("archives with a broken chain of records: " + ", ".join(f"{r.path} ({r.whole} of {r.bytes} bytes)" for r in bad))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = store(row["path"])
                high, out, held = min(row["low"] + part, row["bytes"]), [], 0
                with fs.open_input_file(path) as file:
                    view = Part(file, row["at"], min(file.size(), row["bytes"]))
                    view.upto(max(row["exit"], high))
                    for at, fields, block in walk(view, row["at"], high):
                        if fields.get("warc-type") in ("response", "revisit"):
                            out.append(_told(row["path"], at, fields, block))
                            held += len(block)
                        if held > 1 << 23:
                            yield _batch(out)
                            out, held = [], 0
                if out:
                    yield _batch(out)

    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([r if payload else {n: v for n, v in r.items() if n != "payload"} for r in rows], schema=_SCHEMA if payload else _SCHEMA.remove(10))

    n = reached.count()
    spread = reached.repartition(max(1, n), "path", "low")
    return spread.mapInArrow(run, _RECORDS + (", payload binary" if payload else ""))


_SCHEMA = pa.schema([(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (c.split() for c in _RECORDS.split(", "))] + [("payload", pa.binary())])


def _told(path: str, at: int, fields: dict[str, str], block: bytes) -> dict:
    """What a response or a revisit says."""
    cut = block.find(END) + len(END)
    length = next(int(line[15:]) for line in block[:cut].lower().split(b"\r\n") if line.startswith(b"content-length:"))
    digest, body = fields["warc-payload-digest"].removeprefix("sha256:"), None
    if fields["warc-type"] == "response":
        body = block[cut:]
        if len(body) != length or hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"the payload at {at} of {path} is not the one that its header names")
    key, refers = fields.get(_KEY.lower()), fields.get(_REFERS_KEY.lower())
    return {
        "path": path, "offset": at, "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "key": None if key is None else int(key), "target_uri": fields.get("warc-target-uri"),
        "payload_bytes": length, "payload_digest": digest, "refers_to_id": fields.get("warc-refers-to"), "refers_to": None if refers is None else int(refers), "payload": body,
    }
