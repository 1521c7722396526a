"""WARC archives: exact round trip through the index."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from aerolag.llm import warc
from tests.llm.conftest import prose


def sample():
    pick = random.Random(9)
    html = [f"<p>{prose(pick, pick.randint(1, 200))}</p>" for _ in range(40)]
    html += [html[1], html[1], html[2], "short", "short", None, "", "é" * 60, "é" * 60, "a\r\n\r\nWARC/1.1\r\n" * 20]
    rows = [(100 - i, f"http://x.org/{i}", text, "c") for i, text in enumerate(html)]
    return rows + [(None, "u\r\nX: y", html[3], "c"), (7, None, html[1], "c"), rows[1]]


def expected(rows):
    first = {}
    for page, _, text, _ in rows:
        data = (text or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    found = []
    for page, _, text, _ in rows:
        data = (text or "").encode()
        refers = first.get(data) if first.get(data) != page else None
        kind = "response" if refers is None else "revisit"
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(found, key=str)


def test_round_trip(spark, tmp_path):
    rows = sample()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(3)
    folder = f"file://{tmp_path}/archives"
    index = warc.write_archives(pages, folder)
    read = warc.read_records(index, folder)
    found = read.select("page", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(row) for row in found.collect()), key=str) == expected(rows)
    responses = read.where("record_type = 'response'").collect()
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in responses)
    # A selection reads those records only.
    few = warc.read_records(index.where("page IN (60, 61, 62)"), folder)
    assert sorted(row["page"] for row in few.collect()) == [60, 61, 62]


def test_index_places_are_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame(sample(), "page_id bigint, url string, html string, digest string")
    index = warc.write_archives(pages.coalesce(1), str(tmp_path / "w")).orderBy("file", "offset").collect()
    data = (tmp_path / "w" / index[0]["file"]).read_bytes()
    at = 0
    for row in index:
        assert row["offset"] == at
        record = zlib.decompress(data[at : at + row["length"]], 31)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        at += row["length"]
    assert at == len(data)


def test_archives_roll_over_and_empty_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    assert len({place[0] for place in _written_places(tmp_path)}) > 1
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    index = warc.write_archives(none, str(tmp_path / "e"))
    assert warc.read_records(index.withColumn("x", F.lit(1)), str(tmp_path / "e")).count() == 0


def _written_places(tmp_path):
    writer = warc._Writer(str(tmp_path / "r"))
    pick = random.Random(1)
    places = [writer.write(prose(pick, 200).encode()) for _ in range(9)]
    writer.close()
    return places


def test_neighbouring_ranges_are_merged():
    places = [(0, 10), (10, 10), (20 + warc.GAP, 10), (31 + 2 * warc.GAP, 5), (40 + 2 * warc.GAP, warc.READ_BYTES)]
    assert list(warc.merged_ranges(places)) == [[0, 1, 2], [3], [4]]


def test_payloads_beyond_a_read_come_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 300)
    pages = spark.createDataFrame([(i, f"u{i}", chr(97 + i) * (90 * i)) for i in range(12)], "page_id int, url string, html string")
    index = warc.write_archives(pages, tmp_path.as_uri())
    for given in (True, False):
        rows = warc._read(tmp_path.as_uri(), given)(
            index.select("page", "url", "file", "offset", "length").orderBy("file", "offset").toArrow().to_batches()
        )
        batches = list(rows)
        assert (len(batches) > 3) == given
        found = {p: n for b in batches for p, n in zip(b["page"].to_pylist(), b["payload_bytes"].to_pylist())}
        assert found == {i: 90 * i for i in range(12)}
