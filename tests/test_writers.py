import json
import os
import urllib.parse

from pyspark.sql import functions as F

from quarrystone.sources import writers


def folders(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")) for d in os.listdir(path) if "=" in d}


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.option("header", True).csv(path).select("document", "n", "v").collect())


def test_one_document_is_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(d, str(k), "old") for d in ("a", "b", "c d/e") for k in range(3)], "document string, n string, v string")
    writers.rewrite_partitions(rows, path, "document", header=True)
    before, first = folders(path), read(spark, path)
    assert len(first) == 9 and all(len(f) == 1 for f in before.values())
    new = rows.where("document = 'b' and n < 2").withColumn("v", F.lit("new"))
    for _ in range(2):
        # a second run changes nothing
        writers.rewrite_partitions(new, path, "document", header=True)
        after = folders(path)
        assert read(spark, path) == sorted([r for r in first if r[0] != "b"] + [("b", "0", "new"), ("b", "1", "new")])
        assert {d: f for d, f in after.items() if d != "document=b"} == {d: f for d, f in before.items() if d != "document=b"}
    gone = spark.createDataFrame([("c d/e",), ("never there",)], "document string")
    assert [writers.drop_partitions(gone, path) for _ in range(2)] == [1, 0]
    assert {r[0] for r in read(spark, path)} == {"a", "b"}


def test_files_of_any_bytes(spark, tmp_path):
    path = str(tmp_path / "f")
    parts = [("a/b", 2, b"\x00\xff"), ("a/b", 1, b"one\r\n"), ("é", 1, b""), ("z", 1, b"x" * 3_000_000), ("z", 0, b"y"), (None, 1, b"no name")]
    df = spark.createDataFrame([(k, o, bytearray(v)) for k, o, v in parts], "k string, o int, v binary").repartition(3)
    for _ in range(2):
        got = {r["name"]: (r["bytes"], r["parts"]) for r in writers.write_files(df, path, "k", "o", "v", ".bin").collect()}
        assert got == {"a%2Fb.bin": (7, 2), "%C3%A9.bin": (0, 1), "z.bin": (3_000_001, 2), ".bin": (7, 1)}
        assert sorted(os.listdir(path)) == sorted(got)
    assert (tmp_path / "f" / "a%2Fb.bin").read_bytes() == b"one\r\n\x00\xff" and (tmp_path / "f/z.bin").read_bytes()[:2] == b"yx"
    assert urllib.parse.unquote("a%2Fb") == "a/b"


def test_json_sections(spark, tmp_path):
    path = str(tmp_path / "out" / "p.json")
    rows = [("list", None, k, json.dumps({"n": k, "t": 'a"\n'})) for k in range(500)] + [("map", f'k"{k}é', None, str(k)) for k in range(70)] + [("one", None, 0, None)]
    df = spark.createDataFrame(rows, "section string, key string, place int, value string").repartition(7)
    for _ in range(2):
        writers.write_json_sections(df, path, {"none": "object", "list": "array", "map": "object", "empty": "array", "one": "array"})
        got = json.load(open(path, encoding="utf-8"))
        assert list(got) == ["none", "list", "map", "empty", "one"]
        assert got == {"none": {}, "list": [{"n": k, "t": 'a"\n'} for k in range(500)], "map": {f'k"{k}é': k for k in range(70)}, "empty": [], "one": [None]}
    writers.write_json_sections(df.where("false"), path, {"a": "array"})
    assert json.load(open(path)) == {"a": []}


def test_payload_as_a_file(spark, small, tmp_path):
    """The written object is the entries, section by section, in order."""
    from quarrystone.operators import serving
    from quarrystone.plans import catalogue

    rows = catalogue.payload_entries(spark, small)
    path = str(tmp_path / "payload.json")
    writers.write_json_sections(rows, path, serving.SECTIONS)
    got = json.load(open(path, encoding="utf-8"))
    want = {s: [] if kind == "array" else {} for s, kind in serving.SECTIONS.items()}
    for r in sorted(rows.collect(), key=lambda r: (r.section, r.key.encode())):
        value = json.loads(r.value)
        if serving.SECTIONS[r.section] == "array":
            want[r.section].append(value)
        else:
            want[r.section][r.key] = value
    assert list(got) == list(want) and got == want and all(got.values())
    assert got["cycles"] == sorted(got["cycles"]) and len(got["by_program"]) == len({(p["cycle"], p["program"]) for p in got["by_program"]})
    assert all(len(b["points"]) <= 40 for b in got["box"].values())
