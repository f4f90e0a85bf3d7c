"""WARC archives: exact round trips, magic inside payloads, damage."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from scoreloom.llm.warc import read_warc, warc_round_trip, write_warc
from scoreloom.sources.tables import with_positions

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "http://a/ b", "<p>" + "x" * 200), (2, "u", "<p>" + "x" * 200), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u\r\nWARC-Type: x", "é\r\n\r\n" * 40), (8, "u", FAKE * 30), (9, "u", FAKE * 30), (10, "u", "xWARC/1.WARC/1."), (11, "u", "WARC/1." * 3000),
    (12, "u", FAKE[:-4]), (13, "u", "tail " + FAKE), (14, "u", "y" * 300_000), (0, "late", "<p>" + "x" * 200), (2, "again", "<p>" + "x" * 200),
    (None, "u", "<p>" + "x" * 200), (None, "u", None),
]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def want() -> Counter:
    groups = defaultdict(list)
    for page, _, html in PAGES:
        groups[html or ""].append(page)
    out = Counter()
    for page, _, html in PAGES:
        raw = (html or "").encode()
        first = min((p for p in groups[html or ""] if p is not None), default=None)
        again = len(raw) >= 100 and page is not None and page > first
        out[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    return out


def test_round_trip(spark, small_splits):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, id string, start int")
    assert Counter(tuple(r) for r in warc_round_trip(pages.repartition(2)).collect()) == want()
    assert warc_round_trip(pages.limit(0)).count() == 0


def test_damage_ends_a_file(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}" + "z" * 150) for i in range(6)], "page_id long, url string, html string")
    write_warc(pages.coalesce(1), str(tmp_path / "w"))
    (part,) = (tmp_path / "w").glob("part-*")
    whole = part.read_bytes()
    at = whole.index(b"<p>3")
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(whole[: at + 20])
    (tmp_path / "cut" / "b.warc").write_bytes(b"junk" + whole)
    got = read_warc(spark, str(tmp_path / "cut")).collect()
    assert sorted(r.record_id for r in got) == ["0", "1", "2"]


def test_magic_in_headers(spark, small_splits, tmp_path):
    """In a url of our own (escaped when written) and in foreign headers, also several times and before the length."""
    pages = spark.createDataFrame(
        [(i, f"http://a/{i}/WARC/1.1" if i % 2 else "u", f"<p>{i}" + "z" * 150) for i in range(9)], "page_id long, url string, html string"
    )
    assert sorted(r.page_id for r in warc_round_trip(pages.coalesce(1)).collect()) == list(range(9))

    def record(n: int, extra: str, body: str) -> str:
        return (f"WARC/1.1\r\nWARC-Type: response\r\n{extra}WARC-Record-ID: <urn:page:{n}>\r\nContent-Length: {len(body)}\r\n"
                f"WARC-Target-URI: http://b/WARC/1.1\r\n\r\n{body}\r\n\r\n")

    bodies = ["a" * 20, "b" * 9000, "WARC/1.1\r\n" * 900, FAKE, "", "c"]
    extras = ["", "X: WARC/1.1\r\n", "X: 1WARC/1.1\r\n", "", "X: WARC/1.0\r\n" * 900, "X: Content-Length: 7WARC/1.\r\n"]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes("".join(map(record, range(6), extras, bodies)).encode())
    got = {(r.record_id, r.length, r.digest, r.url) for r in read_warc(spark, str(tmp_path / "f")).collect()}
    assert got == {(str(i), len(b), hashlib.sha256(b.encode()).hexdigest(), "http://b/WARC/1.1") for i, b in enumerate(bodies)}


def test_scans_split_anew(spark, small_splits, tmp_path):
    """The result stays when later scans of the same files are split in another way."""
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_warc(pages.coalesce(1), str(tmp_path / "w"))
    (tmp_path / "t.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(9000)))
    read = read_warc(spark, str(tmp_path / "w"))
    placed = with_positions(spark.read.option("header", True).csv(str(tmp_path / "t.csv")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    got = Counter((r.record_type, r.length, r.digest) for r in read.collect())
    assert got == _kinds()
    assert sorted((r.pos, int(r.id)) for r in placed.collect()) == [(i, i) for i in range(9000)]


def _kinds() -> Counter:
    out = Counter()
    for (_, length, digest, kind, _), n in want().items():
        out[kind, length, digest] += n
    return out
