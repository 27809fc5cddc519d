"""Packages are read back as written, and by other ZIP readers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest

from meterlake.llm import warc
from meterlake.llm.common import checkpointed
from tests.llm.data import SF, ordered, rows

PAYLOAD = "z" * 200
PAGES = [
    (1, None, PAYLOAD), (1, "u v\r\nw", PAYLOAD), (2, "http://a.b/c", PAYLOAD), (None, "q", PAYLOAD),
    (None, "q", "y" * 200), (None, "q", "y" * 200), (3, "q", "s"), (4, "q", "s"), (5, "q", None),
    (6, "é", "é" * 60), (7, "", "é" * 60), (8, "q", "x" * 300_000),
]


def test_query_equals_sql(spark):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    expected = rows(f"select {', '.join(columns)} from ({warc.OP4_SQL})")
    assert ordered(warc.op4_warc(spark, SF).select(columns).collect()) == ordered(expected)


@pytest.mark.parametrize("zip64", [False, True])
def test_packages(spark, tmp_path, zip64):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string")
    packages = checkpointed(warc.write_packages(pages, str(tmp_path), package_bytes=300, zip64=zip64))
    found = warc.read_packages(packages).collect()
    assert len(found) == len(PAGES) == sum(r.records for r in packages.collect())
    kinds = ordered((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds == ordered(
        [(1, "response", None), (1, "response", None), (2, "revisit", 1), (None, "revisit", 1)]
        + [(None, "response", None)] * 2
        + [(k, "response", None) for k in (3, 4, 5, 6, 8)]
        + [(7, "revisit", 6)]
    )
    texts = {p: (h or "").encode() for p, _, h in PAGES if p is not None}
    assert all(r.payload == texts[r.page_id] for r in found if r.record_type == "response" and r.page_id)
    files = sorted(Path(tmp_path).iterdir())
    assert len(files) == packages.count() and all(f.suffix == ".wacz" for f in files)
    for file in files:
        with zipfile.ZipFile(file) as package:
            assert package.testzip() is None
            assert all(i.compress_type == zipfile.ZIP_STORED for i in package.infolist())


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    packages = checkpointed(warc.write_packages(pages, str(tmp_path)))
    assert packages.count() == 0 and warc.read_packages(packages).count() == 0


def reader(data: bytes) -> warc.ZipReader:
    return warc.ZipReader(pa.PythonFile(io.BytesIO(data), mode="r"))


def test_zip_of_others_and_comments():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        package.writestr("a/b.txt", b"one")
        package.writestr(zipfile.ZipInfo("c"), b"two" * 100)
        package.writestr("d", b"three" * 100, zipfile.ZIP_DEFLATED)
        package.comment = b"PK\x05\x06 a comment that looks like an end"
    found = reader(out.getvalue())
    assert list(found.members) == ["a/b.txt", "c", "d"]
    assert found.read(found.start_of("c"), found.members["c"].size) == b"two" * 100
    with pytest.raises(ValueError, match="not stored"):
        found.start_of("d")
    with pytest.raises(ValueError, match="not a ZIP"):
        reader(b"nothing of the kind")


def test_zip64_members():
    data = b"".join(warc.zip_package([("a", b"x" * 50), ("é", b"")], zip64=True))
    found = reader(data)
    assert {m.name: m.size for m in found.members.values()} == {"a": 50, "é": 0}
    assert found.read(found.start_of("a"), 50) == b"x" * 50
