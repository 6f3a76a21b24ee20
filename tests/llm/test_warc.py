"""Archives: round trip, revisits, and what the salvage reader recovers from damaged files."""

import gzip
import hashlib
import io
import random

import pytest

from listmill.llm import warc

DATE = "2024-01-01T00:00:00Z"


def walked(data):
    return list(warc.walk(warc.Window(io.BytesIO(data), len(data))))


def records(n, packed=True):
    out = [warc.page_record(i, f"http://x/{i}", b"<p>" + str(i).encode() * 400, None, DATE) for i in range(n)]
    return [warc.member(r) if packed else r for r in out]


def ids(found):
    return [warc._page_of(r.fields["warc-record-id"]) for _, _, r in found if not isinstance(r, str)]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut out", "insert", "head", "tail"])
def test_records_behind_damage_are_recovered(packed, damage):
    parts = records(8, packed)
    start = sum(map(len, parts[:3]))
    data = bytearray(b"".join(parts))
    lost = {3}
    if damage == "flip":
        at = start + len(parts[3]) // 2
        data[at : at + 4] = bytes(b ^ 255 for b in data[at : at + 4])
    elif damage == "cut out":
        del data[start + 20 : start + 60]
    elif damage == "insert":
        data[start + 30 : start + 30] = b"\x1f\x8b\x08WARC/1.1\r\n" * 5
    elif damage == "head":
        data[0:5] = b"junk!"
        lost = {0}
    else:
        del data[-30:]
        lost = {7}
    found = walked(bytes(data))
    assert ids(found) == [i for i in range(8) if i not in lost]
    gaps = [(a, n) for a, n, r in found if isinstance(r, str)]
    assert len(gaps) == 1
    at = 0
    for first, n, _ in found:  # records and gaps cover the file
        assert first == at
        at += n
    assert at == len(data)


def test_random_damage_never_breaks_the_reader(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 700)  # borders of the buffer everywhere
    rng = random.Random(3)
    whole = b"".join(records(20))
    assert ids(walked(whole)) == list(range(20))
    for _ in range(40):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 5)):
            at = rng.randrange(len(data))
            data[at : at + rng.randint(0, 50)] = rng.randbytes(rng.randint(0, 50))
        found = walked(bytes(data))
        assert len(ids(found)) >= 9
        assert sum(n for _, n, _ in found) == len(data)


def test_a_gzip_of_many_records_reads_as_a_gap():
    data = gzip.compress(b"".join(records(2, False))) + records(1)[0]
    found = walked(data)
    assert ids(found) == [0] and isinstance(found[0][2], str)


def test_round_trip(spark, tmp_path):
    big, small = "ä" * 600, "s" * 999
    rows = [(1, "http://a\r\nb", big), (5, None, big), (3, "", big), (5, "x", big), (None, "y", big), (7, "z", small), (8, "z", small),
            (9, "u", None), (10, "u", ""), (None, "n", "n" * 2000), (None, "n", "n" * 2000), (11, "l", "long " * 300_000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string")
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=str)
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None] if len(data) >= 1000 else []
        original = max(same, default=None)
        revisit = original is not None and page_id != original
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_payloads_and_gaps_of_written_archives(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"{i} ".encode() * 900, None) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, payload binary, original long").repartition(3)
    manifest = warc.write_archives(df, str(tmp_path / "w"), archive_bytes=2000)
    files = [r.path for r in manifest.collect()]
    assert len(files) > 3 and sum(r.records for r in manifest.collect()) == 40
    got = warc.read_archives(manifest).collect()
    assert {(r.page_id, bytes(r.payload)) for r in got} == {(i, p) for i, _, p, _ in rows}
    with open(files[0], "r+b") as f:
        f.seek(100)
        f.write(b"\0" * 20)
    damaged = warc.read_archives(manifest).collect()
    gaps = [r for r in damaged if r.problem]
    assert len(gaps) == 1 and gaps[0].path == files[0] and gaps[0].first_byte == 0
    assert len(damaged) - 1 == 39
