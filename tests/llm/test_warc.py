import gzip

import pytest

from millrace.llm import warc

PAGES = "page_id long, url string, html string, record string"
BIG = "é<p>\r\n\n" * 40


def test_query(same_as_sql):
    same_as_sql("op3_warc")


def test_records(files):
    rows = [(5, "u5", BIG, ""), (2, "u2", BIG, ""), (2, "u2", BIG, ""), (None, None, BIG, ""), (7, "a\r\nb", "small", ""),
            (8, "u8", "small", ""), (9, "u9", None, ""), (10, "u10", "", ""), (11, "u11", "x" * 3_000_000 + "\n", "")]
    got = [tuple(r) for r in warc.archived(files(rows, PAGES, "pages")).collect()]
    assert len(got) == len(rows)
    kinds = sorted((str(p), n, kind, str(to)) for p, n, _, kind, to in got)
    size = len(BIG.encode())
    assert kinds == sorted([
        ("5", size, "revisit", "2"), ("2", size, "response", "None"), ("2", size, "revisit", "2"), ("None", size, "revisit", "2"),
        ("7", 5, "response", "None"), ("8", 5, "response", "None"), ("9", 0, "response", "None"), ("10", 0, "response", "None"),
        ("11", 3_000_001, "response", "None"),
    ])
    assert warc.archived(files([], PAGES, "none")).count() == 0


def test_index_and_members(spark, files, tmp_path):
    rows = [(i, f"u{i}", f"{i} " + BIG, "") for i in range(30)]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_whole(warc.as_records(files(rows, PAGES, "pages")), raw)
    warc.normalise(spark, raw, out)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "raw").glob("part*")))
    index = warc.read_index(spark, out)
    entries = index.collect()
    archives = {p.name: p.read_bytes() for p in (tmp_path / "out" / "kind=archive").glob("part*")}
    for e in entries:
        one = gzip.decompress(archives[e.archive][e.offset : e.offset + e.length])
        assert one in whole and e.record_id.encode() in one and one.count(b"WARC/1.1") == 1
    assert len(entries) == 30
    assert sorted(gzip.decompress(b"".join(archives.values()))) == sorted(whole)
    some = warc.read_at(spark, out, index.filter("uri in ('u3', 'u17')")).collect()
    assert {(r.uri, bytes(r.payload).decode()) for r in some} == {("u3", "3 " + BIG), ("u17", "17 " + BIG)}


def test_large_member_ends_in_zero():
    record = b"a" * ((1 << 24) + 5)
    packed = warc.member(record)
    assert packed[-1] == 0 and gzip.decompress(packed) == record
    assert b"".join(warc.inflated(packed)) == record


def test_cut_off_archives():
    lines = warc.Records("x")
    for line in (b"WARC/1.1\r", b"Content-Length: 5\r", b"\r", b"ab"):
        assert lines.add(line) is None
    with pytest.raises(ValueError, match="cut off"):
        lines.end()
    with pytest.raises(ValueError, match="cut off"):
        list(warc.inflated(warc.member(b"abc" * 100)[:-3]))
