"""Legacy archives and their conversion: round trips, versions, revisits."""

import collections
import gzip
import hashlib

import pytest

from playledger.llm import web_archive as wa
from playledger.llm.queries import QUERIES
from tests.conftest import rows

PAGES = "page_id long, url string, html string, path string, digest string"


def brute_pages(pages):
    groups, found = collections.defaultdict(list), []
    for page_id, html in pages:
        groups[(html or "").encode()].append(page_id)
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, page_id in enumerate(ids):
            again = len(body) >= 1000 and k < len(ids) - 1
            found.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", ids[-1] if again else None))
    return sorted(found, key=repr)


def test_whole_table(spark):
    found = QUERIES["op13_arc_converter"](spark, "/root/testdata/sf0.01")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint"),
    ]
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert rows(found) == brute_pages([(r.page_id, r.html) for r in pages.collect()])


def test_copies_nulls_and_bodies_that_look_like_records(spark, monkeypatch):
    monkeypatch.setattr(wa, "ARCHIVE_BYTES", 2000)
    body = "é\r\n\r\nWARC/1.1 x\0\nhttp://a 0.0.0.0 20200101000000 text/html 3\n" * 40
    pages = [(i, f"http://a b/ü{i}\n", body if i % 3 else "short") for i in range(40)]
    pages += [(None, None, None), (None, "", body), (37, "u", body), (7, "dns:x", None), (-5, "x y", "z" * 1000), (-6, "x", "z" * 1000)]
    pages += [(60, "x", "y" * 999), (61, "x", "y" * 999), (70, "http://q", "k" * 5_000_000), (None, "a", "n" * 1000), (None, "b", "n" * 1000)]
    frame = spark.createDataFrame([(*p, "p", "d") for p in pages], PAGES)
    assert rows(wa.archived_pages(frame)) == brute_pages([(p[0], p[2]) for p in pages])
    assert wa.archived_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_files_are_gzip_archives_of_both_versions(spark, scratch, monkeypatch):
    monkeypatch.setattr(wa, "ARCHIVE_BYTES", 1)
    frame = spark.createDataFrame([(i, "http://h/", "x" * 2000, "", "") for i in range(4)], PAGES).coalesce(1)
    wa.write_arcs(frame, f"{scratch}/arc")
    wa.convert_arcs(spark, f"{scratch}/arc", f"{scratch}/warc")
    contents = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{scratch}/arc").collect()]
    assert len(contents) == 4
    opened = sorted(gzip.decompress(c).split(b"\n")[1] for c in contents)
    assert opened == [b"1 0 pages"] * 2 + [b"2 0 pages"] * 2
    kinds = collections.Counter()
    for r in spark.read.format("binaryFile").load(f"{scratch}/warc").collect():
        records = list(wa.warc_records(bytes(r.content)))
        kinds.update(x.fields["WARC-Type"] for x in records)
        assert len({x.fields["WARC-Record-ID"] for x in records}) == len(records)
        for x in records:
            assert x.fields["WARC-Date"] == "2024-01-01T00:00:00Z"
            assert x.payload == b"" or x.fields["WARC-Type"] != "revisit"
    assert kinds == {"warcinfo": 4, "response": 1, "revisit": 3}


def test_foreign_archives(spark):
    """Without compression, bare newlines, spaces in urls, bodies of any bytes, blocks that are not HTTP, short dates."""
    first = b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 77\n1 0 Somebody\nURL IP-address Archive-date Content-type Archive-length\n"
    first = first.replace(b" 77\n", b" %d\n" % (len(first) - first.index(b"\n") - 1))
    http = b"HTTP/1.0 200 OK\nContent-type: image/gif\n\n\x00\xff\xfe"
    data = first + b"\nhttp://h/a b.gif 1.2.3.4 199609 image/gif %d\n%s\n\ndns:h 1.2.3.4 19960923 text/dns 5\nh A 1\n" % (len(http), http)
    opening, image, dns = wa.arc_records(data)
    assert image.version == 1 and image.fields["URL"] == "http://h/a b.gif" and image.payload == b"\x00\xff\xfe"
    assert wa.iso_date(image.fields["Archive-date"]) == "1996-09-01T00:00:00Z"
    warc = b"".join(wa.converted(r, None) for r in (opening, image, dns))
    assert [r.fields["WARC-Type"] for r in wa.warc_records(warc)] == ["warcinfo", "response", "resource"]
    assert [r.payload for r in wa.warc_records(warc)][1:] == [b"\x00\xff\xfe", b"h A 1"]


@pytest.mark.parametrize(
    "spoil", [lambda d: d[: len(d) // 2], lambda d: d.replace(b"body", b"bodY"), lambda d: d.replace(b"WARC/1.1", b"XXXX/1.1")]
)
def test_damaged_archives_are_errors(spoil):
    record = next(iter(wa.arc_records(wa.arc_head(1, "n", "2020") + wa.arc_record(1, "u", "0", "2020", "t", b"HTTP/1.1 200\r\n\r\nbody", "n"))))
    assert record.version == 1
    records = list(wa.arc_records(wa.arc_head(2, "n", "2020") + wa.arc_record(2, "u", "0", "2020", "t", b"HTTP/1.1 200\r\n\r\nbody", "n")))
    assert [r.version for r in records] == [2, 2]
    with pytest.raises(ValueError):
        list(wa.warc_records(spoil(wa.converted(records[1], None))))
    with pytest.raises(ValueError):
        list(wa.arc_records(b"http://no/filedesc 0 2020 t 3\nabc\n"))
