"""Archives: an exact round trip, and transactions put together."""

import base64
import gzip
import hashlib

from textweft.llm.warc import SEPARATOR, assemble, mark_revisits, read_archives, resolve_revisits, write_archives

HTML = ["<p>a</p>", "<p>a</p>", "", None, "é 가 😀\r\n\r\nx", f"begin{SEPARATOR}WARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz{SEPARATOR}", "x" * 300_000, "\r\n\r\n", "WARC/1.1\r\n", "\n", "<p>a</p>"]


def slow(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        first = last.get(h or "")
        revisit = first is not None and i != first
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


def pages(spark):
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(HTML)]
    rows += [(None, "http://n", "<p>a</p>"), (None, None, "only"), (20, "u\r\nX: y", "same"), (20, "u\r\nX: y", "same"), (19, "v", "same")]
    return rows, spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, uuid string").repartition(3)


def test_round_trip(spark, tmp_path):
    rows, table = pages(spark)
    write_archives(table, str(tmp_path / "a"))
    records = read_archives(spark, str(tmp_path / "a"))
    assert records.count() == 3 * len(rows) and records.filter('damage is not null').count() == 0
    captures = assemble(records)
    got = captures.collect()
    assert len(got) == len(rows)
    assert all(r.request.concurrent_to == r.record_id == r.metadata.concurrent_to for r in got)
    responses = sorted(r.response.payload.decode() for r in got if r.response.type == "response")
    kept = {h or "" for _, _, h in rows}
    assert responses == sorted([*kept, "same"])  # repeated rows of the largest id are both responses
    resolved = resolve_revisits(captures).collect()
    assert sorted(map(str, (tuple(r) for r in resolved))) == slow(rows)


def test_without_payloads_and_empty(spark, tmp_path):
    _, table = pages(spark)
    write_archives(table.limit(0), str(tmp_path / "none"))
    assert assemble(read_archives(spark, str(tmp_path / "none"), payloads=False)).collect() == []


def test_foreign_transactions(spark):
    columns = "record_id string, type string, concurrent_to string, target_uri string, date string, digest string, content_type string, fields map<string,string>, payload_bytes long, payload_digest string"
    row = lambda i, t, c, f: (i, t, c, "u", None, None, None, f, 1, "d")
    rows = [row("r", "response", None, {}), row("q2", "request", "r", {}), row("q1", "request", "r", {}), row("m", "metadata", "q1", {"page-id": "4"})]
    rows += [row("i", "warcinfo", None, {}), row("lone", "metadata", None, {}), row("s", "revisit", None, {})]
    got = {r.record_id: r for r in assemble(spark.createDataFrame(rows, columns)).collect()}
    assert set(got) == {"r", "s"}
    assert got["r"].request.record_id == "q1" and got["r"].metadata.fields == {"page-id": "4"}
    assert got["s"].request is None and got["s"].metadata is None


def record(kind, block, version=b"1.0", length=None, extra=b""):
    size = str(len(block)).encode() if length is None else length
    head = b"WARC/" + version + b"\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <" + kind + b">\r\n" + extra
    return head + b"Content-Length: " + size + b"\r\n\r\n" + block + b"\r\n\r\n"


def read(spark, tmp_path, data, name="a.warc", split=False):
    folder = tmp_path / name.replace(".", "-")
    folder.mkdir()
    (folder / name).write_bytes(data)
    rows = read_archives(spark, str(folder)).collect()
    return [(r.type, r.damage, None if r.payload is None else bytes(r.payload)) for r in rows]


def test_foreign_archives(spark, tmp_path):
    bodies = [b"\xff\xfe raw \x00 bytes", "é".encode("latin-1"), b"", b"see WARC/1.0 and WARC/1.1\r\n here", record(b"inner", b"x")]
    plain = [record(b"warcinfo", b"a: b\r\n"), *[record(b"resource", x) for x in bodies], record(b"resource", b"last", b"1.1")]
    want = [("warcinfo", None, b"a: b\r\n"), *[("resource", None, x) for x in bodies], ("resource", None, b"last")]
    assert read(spark, tmp_path, b"".join(plain)) == want
    # compressed record by record, as crawlers write them
    assert read(spark, tmp_path, b"".join(gzip.compress(r) for r in plain), "b.warc.gz") == want


def test_damaged_records_are_set_apart(spark, tmp_path):
    good = record(b"resource", b"good")
    cut = record(b"response", b"x" * 50)[:-30]
    for i, (bad, damage) in enumerate([
        (record(b"response", b"abc", length=b"many"), "no length"),
        (record(b"response", b"abc", length=b"-1"), "no length"),
        (record(b"response", b"abc", length=b"99999999999999"), "length beyond what is read"),
        (record(b"response", b"abcdef", length=b"2"), "wrong length"),
        (record(b"response", b"abc", length=b"60"), "cut short"),
        (cut, "cut short"),
        (b"WARC/1.0\r\nWARC-Type: response", "no header"),
    ]):
        found = read(spark, tmp_path, good + bad + good + good, f"d{i}.warc")
        assert [(k, d) for k, d, _ in found if k == "resource"] == [("resource", None)] * 3, damage
        assert [d for _, d, _ in found if d] == [damage]
    assert [d for _, d, _ in read(spark, tmp_path, good + cut, "end.warc")] == [None, "cut short"]


def test_a_file_that_ends_early_does_not_reach_into_the_next(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.warc").write_bytes(record(b"response", b"x" * 500)[:-100])
    (folder / "b.warc").write_bytes(record(b"resource", b"whole") * 3)
    found = read_archives(spark, str(folder)).coalesce(1).collect()
    assert sorted((r.type, r.damage) for r in found) == [("resource", None)] * 3 + [("response", "cut short")]


def test_hot_payloads_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("textweft.lookup.BROADCAST_BYTES", 0)
    rows = [(i, "u", "" if i % 3 else f"p{i % 7}") for i in range(60)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r._first for r in mark_revisits(table).collect()}
    last = {}
    for i, _, h in rows:
        last[h] = i
    assert got == {i: None if last[h] == i else last[h] for i, _, h in rows}
