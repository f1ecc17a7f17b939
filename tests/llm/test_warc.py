import hashlib
import os

import numpy as np
import pytest
from loadkit.llm import queries, warc
from loadkit.llm.token_files import store

DATE = "2024-01-31T00:00:00Z"


def plain(rows):
    """rows: [(page_id, html)] -> per page what the contract asks for."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        head = first.get(b, i)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if head == i else "revisit", None if head == i else head))
    return sorted(out)


def got(df):
    return sorted((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def evil(n):
    """A page that holds whole records, their magic at line starts among them."""
    inner = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("Loadkit-Key", 99), ("WARC-Payload-Digest", "sha256:0")], b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx")
    return f"<p>{n}</p>" + inner.decode() * n + "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "\nWARC/1.0\r\n\r\n"


@pytest.fixture(scope="module")
def pages():
    same = "é" * 60
    return [(1, "a" * 99), (2, "a" * 99), (3, same), (4, same), (-5, same), (6, None), (7, ""), (8, "b" * 100), (9, "b" * 100), *[(10 + k, evil(k)) for k in range(40)], (90, evil(7)), (91, "z" * 300_000), (92, "z" * 300_000)]


def frame(spark, path, rows):
    spark.createDataFrame([(i, f"http://x/{i}", t, "m", 1) for i, t in rows], "page_id long, url string, html string, locator string, digest int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_records_come_back_from_parts_of_any_size(spark, folder, pages):
    df = frame(spark, folder(), pages)
    manifest = warc.write(df, folder("warc"), DATE, archive=20_000)
    assert manifest.count() > 5
    for part in (1 << 23, 5000, 700):
        found = warc.read(manifest, part)
        assert got(found) == plain(pages)
    texts = {i: (t or "").encode() for i, t in pages}
    for r in found.collect():
        assert r.target_uri == f"http://x/{r.key}"
        assert (r.payload is None) if r.record_type == "revisit" else bytes(r.payload) == texts[r.key]
    ids = {r.key: r.record_id for r in found.collect()}
    assert len(set(ids.values())) == len(pages)
    assert all(r.refers_to_id == ids[r.refers_to] for r in found.collect() if r.record_type == "revisit")
    assert sum(r.records for r in manifest.collect()) == len(pages) + manifest.count()


def test_entries_are_where_records_begin(spark, folder, pages):
    """Against one walk over each file; magic in payloads leads nowhere."""
    manifest = warc.write(frame(spark, folder(), pages), folder("warc"), DATE)
    for part in (900, 4000):
        entries = {}
        for r in warc.entries(manifest, part).collect():
            entries.setdefault(r.path, []).append((r.low, r.at, r.exit))
        for m in manifest.collect():
            fs, path = store(m.path)
            with fs.open_input_file(path) as f:
                raw = f.read()
            places, at = [], 0
            while at < len(raw):
                head = raw.index(b"\r\n\r\n", at)
                length = int(next(x for x in raw[at:head].decode().split("\r\n") if x.startswith("Content-Length"))[15:])
                places.append(at)
                at = head + 4 + length + 4
            places.append(at)
            want = []
            for low in range(0, len(raw), part):
                inside = [p for p in places[:-1] if low <= p < low + part]
                if inside:
                    want.append((low, inside[0], places[places.index(inside[-1]) + 1]))
            assert sorted(entries[m.path]) == want
            assert raw.count(b"WARC/1.") > len(places)


def test_exits_by_pointer_jumping():
    places, following = np.array([10, 20, 25, 40, 50]), np.array([20, 40, 33, 60, 50 + 70])
    assert warc.exits(places, following, 55).tolist() == [60, 60, -1, 60, 120]


def test_damaged_archives_are_named(spark, folder, pages):
    manifest = warc.write(frame(spark, folder(), pages), folder("warc"), DATE)
    victim = max(manifest.collect(), key=lambda r: r.bytes)
    path = victim.path.removeprefix("file:")
    with open(path, "r+b") as f:
        f.truncate(victim.bytes - 10)
    for part in (1 << 23, 3000):
        with pytest.raises(ValueError, match=os.path.basename(path)):
            warc.read(manifest, part)
        assert [r.path for r in warc.damaged(manifest, warc.entries(manifest, part)).collect()] == [victim.path]
        some = got(warc.read(manifest, part, strict=False))
        assert len(some) == len(pages) - 1 and set(some) < set(plain(pages))


def test_odd_rows(spark, folder):
    """Null keys and addresses, repeated rows, line ends in addresses, an empty table."""
    big = "q" * 500
    rows = [(None, "u", big), (5, "u\r\nWARC-Type: x", big), (5, "u", big), (4, None, big), (None, None, "s"), (None, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path := folder())
    df = spark.read.parquet(path)
    found = warc.read(warc.write(df, folder("warc"), DATE)).collect()
    assert sorted((r.key or -1, r.record_type, r.refers_to) for r in found) == [(-1, "response", None), (-1, "response", None), (-1, "revisit", 4), (4, "response", None), (5, "revisit", 4), (5, "revisit", 4)]
    assert {r.target_uri for r in found} == {"u", "u WARC-Type: x", None}
    assert warc.read(warc.write(df.limit(0), folder("warc"), DATE)).collect() == []


def test_whole_table(spark, sf):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    found = queries.op12(spark, sf).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == plain(rows)
