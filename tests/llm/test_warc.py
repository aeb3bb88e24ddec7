import base64
import hashlib
import random

import duckdb
from tramloom.llm import queries, warc

_SHAPE = "page_id long, url string, html string"


def brute(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[digest(h)] = max(best.get(digest(h), i), i)
    out = []
    for i, _, h in rows:
        d = digest(h)
        to = None if d not in best or best[d] == i else best[d]
        out.append(((i is None, i or 0), len((h or "").encode()), d, "response" if to is None else "revisit", to or -1))
    return sorted(out)


def _rows(df):
    return sorted(((r["page_id"] is None, r["page_id"] or 0), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] if r["refers_to"] is not None else -1) for r in df.collect())


def _odd():
    rng = random.Random(4)
    nasty = ["", None, "a", "x\r\n\r\ny\r\n\r\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "été \U0001f600", "\r\n", "long " * 30000]
    rows = [(i, f"http://h/{i}", rng.choice(nasty)) for i in range(60)]
    rows += [(70, None, "a"), (71, "http://h/\r\nX-Bad: 1", "b"), (72, "", "b"), (72, "again", "b"), (73, "u", "only one")]
    return rows


def test_round_trip_of_odd_pages(spark):
    rows = _odd()
    assert _rows(warc.archived_pages(spark.createDataFrame(rows, _SHAPE).repartition(3))) == brute(rows)


def test_sql_says_the_same():
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    rows = _odd() + [(None, "u", "same"), (80, "u", "same"), (None, "v", "alone")]
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    got = con.execute(queries.OP10_SQL).fetchall()
    assert sorted(((i is None, i or 0), n, d, t, to if to is not None else -1) for i, n, d, t, to in got) == brute(rows)


def test_archives_hold_each_payload_once(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"payload {i % 4} " * 50) for i in range(40)]
    path = f"{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(rows, _SHAPE), path)
    data = b"".join(p.read_bytes() for p in (tmp_path / "warc").glob("part-*"))
    records = list(warc.parse_records(data))
    assert len(records) == 40 and sum(h[b"WARC-Type"] == b"response" for h, _ in records) == 4
    for h, payload in records:
        if h[b"WARC-Type"] == b"response":
            assert h[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest())
        else:
            assert payload == b"" and h[b"WARC-Refers-To"] in {x[b"WARC-Record-ID"] for x, _ in records}
    assert len(warc.read_archives(spark, path).collect()) == 40


def test_least_size_and_empty_table(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "a" * 50), (4, "u", "a" * 50)]
    got = {r["page_id"]: r["record_type"] for r in warc.archived_pages(spark.createDataFrame(rows, _SHAPE), min_bytes=10).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.archived_pages(spark.createDataFrame([], _SHAPE)).collect() == []


def test_null_ids(spark):
    rows = [(None, "u", "same"), (5, "u", "same"), (None, "v", "alone"), (None, "w", "alone")]
    got = _rows(warc.archived_pages(spark.createDataFrame(rows, _SHAPE)))
    assert got == brute(rows)


def test_text_ids_of_any_characters(spark):
    ids = ["null", "", None, "a>b", "x\r\ny", "100%0A", "é", "z", "y"]
    rows = [(i, f"http://x/{n}", "same" if n > 6 else f"page {n}") for n, i in enumerate(ids)]
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archived_pages(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert got == {(i, "response", None) for i in ids[:8]} | {("y", "revisit", "z")}


def test_revisits_are_dealt_by_size_too(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "one payload") for i in range(3000)]
    path = f"{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(rows, _SHAPE).coalesce(1), path, archive_bytes=200_000, compression="none")
    sizes = [p.stat().st_size for p in (tmp_path / "warc").glob("part-*") if p.stat().st_size]
    assert len(sizes) >= 7 and max(sizes) < 300_000
    assert warc.read_archives(spark, path).count() == 3000
