from __future__ import annotations

import hashlib

import pytest

from tripmart.llm.warc import MARKER, WarcFormat, cuts, read_payloads, read_records, round_trip, write_archives

PAGES = "page_id long, url string, html string, digest string, row_id string, value string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*row, "extra", "extra", "extra") for row in rows], PAGES)


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data) if first.get(data) != page else None
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(found, key=str)


LONG = "é" * 400 + "<p>text\r\n\r\nmore</p>" * 90
ROWS = [
    (5, "http://a.example/x", LONG),
    (3, "http://a.example/y", LONG),
    (9, None, LONG),
    (None, "http://a.example/z", LONG),
    (1, "http://b.example/", None),
    (2, "http://b.example/ with space\r\nX: y", ""),
    (4, "u", "short"),
    (6, "u", "short"),
    (7, "u", f"{MARKER} inside {MARKER}{MARKER}" + "q" * 300 + "\r\n\r\n"),
    (8, "u", "A: b\r\n\r\n" * 200),
    (8, "u", "A: b\r\n\r\n" * 200),
    (10, "http://a.example/WARC/1.1", "ends like a version line WARC/1.1"),
    (11, "u", "x" * 99 + "€" * 50 + MARKER + "WARC/1.1"),
]


@pytest.mark.parametrize("chunk", [7, 100, 64 * 1024])
def test_round_trip(spark, chunk):
    found = round_trip(pages_of(spark, ROWS), WarcFormat(chunk_bytes=chunk, batch_bytes=900)).collect()
    assert sorted((tuple(row) for row in found), key=str) == expected(ROWS)


def test_archives_are_standard_records(spark, tmp_path):
    folder = str(tmp_path / "warc")
    write_archives(pages_of(spark, ROWS), folder, WarcFormat(chunk_bytes=500, compression="none"))
    kinds = []
    for path in sorted((tmp_path / "warc").glob("part-*")):
        data = path.read_bytes()
        while data:
            assert data.startswith(MARKER.encode())
            head, _, data = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert hashlib.sha256(data[:size]).hexdigest() == fields["WARC-Block-Digest"].removeprefix("sha256:")
            assert data[size : size + 4] == b"\r\n\r\n"
            data = data[size + 4 :]
            kinds.append(fields["WARC-Type"])
    assert kinds.count("response") == 10 and kinds.count("revisit") == 3 and kinds.count("continuation") > 3
    assert read_records(spark, folder).count() == len(kinds)


def test_damage_is_an_error(spark, tmp_path):
    write_archives(pages_of(spark, [(1, "u", "payload " * 50)]), str(tmp_path / "warc"), WarcFormat(compression="none"))
    (path,) = [p for p in (tmp_path / "warc").glob("part-*") if p.stat().st_size]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.txt").write_bytes(path.read_bytes().replace(b"payload payload", b"payload pAyload", 1))
    with pytest.raises(Exception, match="damaged record"):
        read_payloads(spark, str(tmp_path / "bad")).collect()


def test_empty_table(spark):
    assert round_trip(pages_of(spark, [])).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 7, 9, 64])
def test_chunks_end_at_characters_and_inside_markers(size):
    text = "aé€😀" * 20 + MARKER * 3 + "WARC/1.1" + "😀" * 9 + "WARC/1.1"
    data = text.encode()
    spans = list(cuts(memoryview(data), size))
    assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(data)
    for a, b in spans:
        chunk = data[a:b]
        assert chunk.decode() and (len(chunk) <= size or len(chunk.decode()) == 1)
        assert MARKER.encode() not in chunk + b"\r\n\r\n"
    assert list(cuts(memoryview(b""), size)) == [(0, 0)]


def test_cutting_takes_time_in_proportion():
    import time

    def seconds(megabytes):
        data = memoryview("<p>some text é</p>\n".encode() * (megabytes * 50_000))
        begin = time.process_time()
        assert sum(b - a for a, b in cuts(data, 64 * 1024)) == len(data)
        return time.process_time() - begin

    seconds(1)
    assert seconds(64) < 16 * max(seconds(16), 0.01)


def test_long_payload(spark):
    html = "<p>long é</p>\n" * 600_000
    rows = [(1, "u", html), (2, "u", html), (3, "u", html[:-1])]
    assert sorted((tuple(row) for row in round_trip(pages_of(spark, rows)).collect()), key=str) == expected(rows)
