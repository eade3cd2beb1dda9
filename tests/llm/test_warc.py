import base64
import gzip
import hashlib
import os

import duckdb
import pytest

from quarrystone.llm import warc
from quarrystone.llm.common import shared_dir

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
KIND = "page_id bigint, url string, html string"


def brute(rows, min_bytes=0):
    """Each row in the order of its id: of equal payloads the last one is the response."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    bodies = [(r[2] or "").encode() for r in order]
    last = {b: k for k, b in enumerate(bodies)}
    out = []
    for k, (r, b) in enumerate(zip(order, bodies)):
        first = len(b) < min_bytes or last[b] == k
        out.append((r[0], len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", None if first else order[last[b]][0]))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def write(spark, rows, **options):
    root = shared_dir(spark)
    warc.write_archives(spark.createDataFrame(rows, KIND), root, **options)
    return root


def files(root):
    folder = root.removeprefix("file://").removeprefix("file:")
    return {n: open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder)) if n.endswith(".warc.gz")}


@pytest.fixture(scope="module")
def some():
    return [(k, f"http://h.example/{k % 7}", f"<p>{'text ' * (k % 11)}{k % 13}é</p>") for k in range(300)]


def test_query_equals_sql(spark, small):
    df = warc.op11_warc(spark, small)
    assert df.columns == COLUMNS
    db = duckdb.connect()
    db.execute(f"create view pages as select * from read_parquet('{small}/pages.parquet')")
    rows = db.sql(f"select {', '.join(COLUMNS)} from ({warc.ORACLE_SQL['op11_warc']})").fetchall()
    assert result(df) == sorted(rows, key=str) and len(rows) == 50


@pytest.mark.parametrize("least", [0, 30])
def test_equal_payloads(spark, some, least):
    assert result(warc.read_archives(spark, write(spark, some, min_bytes=least, shard_bytes=20_000))) == brute(some, least)


def test_same_bytes_whatever_the_partitions(spark, some):
    options = {"shard_bytes": 20_000, "roll_bytes": 3000}
    first = files(write(spark, some, **options))
    root = shared_dir(spark)
    spark.range(3).count()
    warc.write_archives(spark.createDataFrame(some[::-1], KIND).repartition(9), root, **options)
    assert files(root) == first
    # several shards, and files that were rolled
    assert len({n[:11] for n in first}) > 3 and any(n.endswith("-00002.warc.gz") for n in first)


def test_files_are_plain_warc(spark, some):
    root = write(spark, some)
    (name, data), *more = files(root).items()
    assert not more and "_temporary" not in os.listdir(root.removeprefix("file://").removeprefix("file:"))
    text = gzip.decompress(data)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.count(b"WARC/1.1\r\n") == 301
    assert f"WARC-Filename: {name}".encode() in text
    row = warc.manifest(spark, root).collect()
    assert [(r["name"], r["bytes"], r["records"]) for r in row] == [(name, len(data), 300)]


def test_round_trip_and_references(spark, some):
    rows = warc.read_archives(spark, write(spark, some, shard_bytes=20_000), with_payload=True).collect()
    html = {r["record_id"]: r["html"] for r in rows if r["record_type"] == "response"}
    ids = {r["record_id"]: r["page_id"] for r in rows}
    assert len(ids) == len(rows) == 300
    for r in rows:
        source = some[r["page_id"]]
        assert r["url"] == source[1]
        assert html[r["refers_to_id"] or r["record_id"]] == source[2]
        assert r["refers_to"] == (ids[r["refers_to_id"]] if r["refers_to_id"] else None)


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and ids, and addresses that fit no header line."""
    rows = [
        (None, None, None), (1, "http://x/a b\r\nX: y", ""), (1, "http://x/", "same"), (1, "http://x/", "same"), (1, "http://x/", "same"), (1, "http://y/é", "same"),
        (2, None, "\r\n\r\nWARC/1.1\r\n"), (3, "u", "x" * 3_000_000 + "é"), (None, "v", "lone"), (None, "v", "lone"), (-5, "w", None), (4, "", "\x00"),
    ]
    root = shared_dir(spark)
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as digest", "2 as SHARD", "3 as lead_id", "4 as record_type")
    warc.write_archives(df, root, shard_bytes=5000)
    assert result(warc.read_archives(spark, root)) == brute(rows)
    back = warc.read_archives(spark, root, with_payload=True).where("page_id = 3").first()
    assert back["html"] == "x" * 3_000_000 + "é"


def test_empty_table(spark):
    root = write(spark, [])
    assert warc.manifest(spark, root).count() == 0 and result(warc.read_archives(spark, root)) == []


def test_damage_is_found(spark, some):
    root = write(spark, some, level=0)
    folder = root.removeprefix("file://").removeprefix("file:")
    (name, data), = files(root).items()
    for bad in (data[:-40], data.replace(b"text text", b"texx text", 1)):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(bad)
        with pytest.raises(Exception, match="PythonException|zlib|ValueError"):
            warc.read_archives(spark, root).count()


def test_publishing_again_changes_nothing(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary/a").write_bytes(b"abc")
    batch = warc._listing([("f.warc.gz", "_temporary/a", 3, 1)])
    for _ in range(2):
        assert list(warc._publish(str(tmp_path))([batch])) == [batch]
        assert (tmp_path / "f.warc.gz").read_bytes() == b"abc"
    with pytest.raises(OSError):
        list(warc._publish(str(tmp_path))([warc._listing([("g", "_temporary/a", 3, 1)])]))
    assert isinstance(batch, pa.RecordBatch)


def test_shards_weigh_about_the_same(spark):
    keys = spark.range(20_000).selectExpr("id as page_id", "sha1(cast(id as string)) as digest", "if(id < 5000, 4000L, 100L) as bytes")
    bounds = warc._bounds(keys, 1 << 20)
    got = keys.select(warc._shard(bounds).alias("s"), "page_id", "bytes").groupBy("s").agg({"bytes": "sum", "page_id": "count"}).collect()
    assert len(got) == len(bounds) + 1
    plain = [sum((r["page_id"], r["digest"]) >= b for b in bounds) for r in keys.where("page_id % 997 = 0").orderBy("page_id").collect()]
    assert plain == [r["s"] for r in keys.where("page_id % 997 = 0").orderBy("page_id").select(warc._shard(bounds).alias("s")).collect()]
    weights = [r["sum(bytes)"] + 600 * r["count(page_id)"] for r in got]
    assert max(weights) < 3 * (1 << 20)
