import hashlib
import io

import pytest

from creatorlens.llm import arc
from creatorlens.llm.common import filesystem, shared_folder

V1 = (b"filedesc://a.arc 0.0.0.0 19970101000000 text/plain 77\n1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n"
      b"\nXXXXXXXXXXXXX")


def _v1(*records):
    body = b"1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n\n"
    head = b"filedesc://a.arc 0.0.0.0 19970101000000 text/plain %d\n" % len(body)
    return head + body + b"".join(records)


def _v2(*records):
    body = b"2 0 Org\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n"
    head = b"filedesc://b.arc 0.0.0.0 19990101 text/plain 200 - - 0 b.arc %d\n" % len(body)
    return head + body + b"".join(records)


def test_versions_and_lengths():
    one = b"http://x.org/a b 1.2.3.4 19980203040506 text/html 5\nab\nc\n\n"
    got = list(arc.arc_records(io.BytesIO(_v1(one, b"\n", b"dns:x 0.0.0.0 1998 text/dns 0\n\n"[:-1])), "a"))
    assert [(h["URL"], c) for h, c in got] == [("http://x.org/a b", b"ab\nc\n"), ("dns:x", b"")]
    two = b"http://x.org/ 1.2.3.4 19980203040506 text/html 200 abc - 100 b.arc 3\nxyz\n"
    (head, content), = arc.arc_records(io.BytesIO(_v2(two)), "b")
    assert (head["Result-code"], head["Checksum"], head["Filename"], content) == ("200", "abc", "b.arc", b"xyz")
    with pytest.raises(ValueError, match="ends after"):
        list(arc.arc_records(io.BytesIO(_v1(b"http://x/ 1.2.3.4 1998 text/html 50\nabc\n")), "a"))
    with pytest.raises(ValueError, match="header line"):
        list(arc.arc_records(io.BytesIO(_v1(b"nonsense\n")), "a"))


def test_dates_and_urls():
    assert arc.iso_date("19980203040506") == "1998-02-03T04:05:06Z" and arc.iso_date("-") == "1970-01-01T00:00:00Z"
    assert arc.plain_url("a b\n") == "a%20b%0A" and arc.plain_url(None) == "-"


def test_converts_plain_archives(spark):
    """Uncompressed files of both versions, with records that are not HTTP."""
    arcs, warcs = shared_folder(spark, "test-arc"), shared_folder(spark, "test-warc")
    fs, at = filesystem(arcs)
    fs.create_dir(at, recursive=True)
    page = lambda i, body: (lambda b: b"http://x.org/%d 1.2.3.4 19980203040506 text/html %d\n" % (i, len(b)) + b + b"\n")(arc.http_block(str(i), body))
    with fs.open_output_stream(f"{at}/a.arc") as out:
        out.write(_v1(page(3, b"z" * 100), page(1, b"z" * 100), page(2, b"z" * 99), page(4, b"z" * 99), b"dns:x 0.0.0.0 19980203 text/dns 4\nabcd\n"))
    names = arc.convert(spark, arcs, ["a.arc"], warcs)
    got = {r.target_uri: r for r in arc.read_warc(arc.files_frame(spark, names), warcs).collect()}
    assert [got[f"http://x.org/{i}"].record_type for i in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"]
    assert got["http://x.org/3"].refers_to == "1" and got["http://x.org/3"].payload_bytes == 100
    assert (got["dns:x"].record_type, got["dns:x"].payload_bytes, got["dns:x"].warc_date) == ("resource", 4, "1998-02-03T00:00:00Z")
    assert len({r.record_id for r in got.values()}) == 5


def test_messy_pages(spark, tmp_path):
    long = "é" * 70 + "<p>"
    rows = [(1, None, None), (2, "http://a b/", ""), (3, "u", long), (4, "u", long), (5, "", long), (5, "", long), (None, "u", long), (6, "u", "x" * 100),
            (7, "u", "x" * 99), (8, "u", "x" * 99), (6, "u", "x" * 100), (None, "n", "q" * 200), (None, "n", "q" * 200), (9, "u", "HTTP/1.1 200\r\n\r\n" * 20)]
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumnsRenamed({}).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, arc.op9_warc(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        first = min(same, default=None)
        again = len(body) >= 100 and first is not None and page != first
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert arc.op9_warc(spark, str(tmp_path)).collect() == []
