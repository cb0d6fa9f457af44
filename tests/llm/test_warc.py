from __future__ import annotations

import gzip
import hashlib
import re
from collections import Counter
from pathlib import Path

import pytest

from kpiloom.llm import store, warc

LONG = "<p>é🙂 the same page again</p>\r\n\r\n" * 5
ROWS = [
    (5, "http://a/5", LONG),
    (3, "http://a/3\r\nX: y", LONG),
    (9, None, LONG),
    (4, "http://a/4", "<p>short</p>"),
    (6, "http://a/6", "<p>short</p>"),
    (7, "http://a/7", None),
    (8, "http://a/8", ""),
    (None, "http://a/none", LONG),
    (2, "http://a/2", "x" * 300_000),
    (10, "http://a/10", "y" * 99),
    (11, "http://a/11", "y" * 99),
    (12, "http://a/12", "y" * 100),
    (12, "http://a/12", "y" * 100),
]


def folder_for(session, name):
    return store.new_folder(session, name).removeprefix("file:")


def plain(rows):
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if len((html or "").encode()) >= 100:
            first.setdefault(html, []).append(i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        taken = first.get(html)
        revisit = bool(taken) and (taken[0] != i or (taken.count(i) > 1 and out[i, len(data), hashlib.sha256(data).hexdigest(), "response", None]))
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", taken[0] if revisit else None] += 1
    return out


def records(frame):
    rows = frame.collect()
    whole = lambda x: None if x is None else int(x)
    return Counter((whole(r.key), r.payload_bytes, r.payload_digest, r.record_type, whole(r.refers_to)) for r in rows)


@pytest.fixture
def pages(session):
    return session.createDataFrame([(*r, "z") for r in ROWS], "page_id BIGINT, url STRING, html STRING, digest STRING")


@pytest.mark.parametrize("layout", [warc.Layout(), warc.Layout(shard_bytes=2000), warc.Layout(file_bytes=200)])
def test_round_trip(session, pages, layout):
    folder = folder_for(session, "warc")
    manifest = warc.written(pages, folder, layout=layout)
    read = warc.read_back(manifest, folder, with_payload=True)
    assert records(read) == plain(ROWS)
    payloads = Counter((r.key, r.payload) for r in read.collect() if r.record_type == "response")
    assert payloads["2", "x" * 300_000] == 1 and payloads["7", ""] == 1 and payloads["3", LONG] == 1
    assert {r.url for r in read.collect() if r.key == "3"} == {"http://a/3%0D%0AX: y"}
    for entry in manifest.collect():
        data = Path(folder, entry["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == entry.sha256 and len(data) == entry.bytes
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == entry.records
    left = [p for p in Path(folder, "_temporary").iterdir()]
    assert left == []


def test_files_depend_on_the_records_alone(session, pages):
    layout = warc.Layout(shard_bytes=3000, file_bytes=500)
    one, two = folder_for(session, "warc"), folder_for(session, "warc")
    first = warc.written(pages.repartition(7), one, layout=layout)
    second = warc.written(pages.orderBy("html").coalesce(1), two, layout=layout)
    listed = lambda m: sorted((r["name"], r.sha256, r.records) for r in m.collect())
    assert listed(first) == listed(second) and first.count() > 3


def test_shards_take_even_bytes_and_files_roll(session):
    html = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(40))
    rows = [(i, f"http://a/{i}", f"{i} {html}" * (1 + 9 * (i % 50 == 0))) for i in range(300)]
    folder, layout = folder_for(session, "warc"), warc.Layout(shard_bytes=200_000, file_bytes=50_000)
    pages = session.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    manifest = warc.written(pages.repartition(5), folder, layout=layout)
    placed, before = {}, 0
    for i, _, text in rows:
        placed[str(i)] = before // layout.shard_bytes
        before += len(text) + warc.HEAD_BYTES
    found = {r.key: int(r.file.split("-")[1]) for r in warc.read_back(manifest, folder).collect()}
    assert found == placed and max(placed.values()) > 3
    files = manifest.collect()
    assert max(f["roll"] for f in files) > 0 and max(f["bytes"] for f in files) < 50_000 + 20_000
    assert sorted(f.shard for f in files if f["roll"] == 0) == sorted(set(placed.values()))


def test_names_of_records_are_their_own(session, pages):
    folder = folder_for(session, "warc")
    manifest = warc.written(pages, folder)
    data = b"".join(gzip.decompress(Path(folder, f["name"]).read_bytes()) for f in manifest.collect())
    names, referred = (Counter(re.findall(rb"WARC-" + kind + rb": (\S+)", data)) for kind in (b"Record-ID", b"Refers-To"))
    assert len(names) == len(ROWS) and set(referred) < set(names)


def test_commit_may_be_repeated_and_reports_loss(session, pages):
    folder = folder_for(session, "warc")
    manifest = warc.written(pages, folder)
    before = manifest.collect()
    entries = session.createDataFrame(before, manifest.schema)
    assert warc._committed(session, entries, folder).collect() == before
    name = before[0]["name"]
    Path(folder, name).write_bytes(b"cut")
    with pytest.raises(Exception, match="is whole"):
        warc._committed(session, entries, folder)


def test_damage_is_found():
    row = {"bytes": 3, "repeat": 0, "digest": hashlib.sha256(b"abc").hexdigest(), "url": None, "key": "1"}
    data = warc.record(row, b"abc", None, warc.Layout())
    assert warc.parsed(data)["payload"] == "abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(data.replace(b"abc", b"abd"))


def test_no_pages(session, pages):
    folder = folder_for(session, "warc")
    manifest = warc.written(pages.limit(0), folder)
    assert manifest.collect() == [] and warc.read_back(manifest, folder).collect() == []
