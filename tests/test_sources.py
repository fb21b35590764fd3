"""Payload files as a data source, state files set apart, pooled vectors."""

import json

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loomsift import queries, round_queries
from loomsift.operators import similarity
from loomsift.sources import quarantine, registry


def test_a_source_that_fails_stops_no_other(spark, tmp_path):
    (tmp_path / "good").write_text('{"id": "q", "title": "vid"}\n')
    (tmp_path / "bytes").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / "empty").write_text(" \n")
    (tmp_path / "none").write_text("not json")
    (tmp_path / "long").write_bytes(b"x" * (registry.PAYLOAD_MAX + 1))
    (tmp_path / "off").write_text('{"id": "z", "title": "never"}')
    names = ["long", "good", "bytes", "empty", "none", "gone", "off"]
    sources = [{"source": n, "type": "ytsearch", "url": f"https://{n}.example", "enabled": n != "off"} for n in names] + [{"source": "again", "type": "ytsearch", "path": str(tmp_path / "good")}]
    items, skipped = registry.collected(spark, sources, str(tmp_path))
    assert [(r.source, r.title) for r in items.orderBy("seq").collect()] == [("good", "vid"), ("again", "vid")]
    got = {r.source: r.problem.partition(":")[0] for r in skipped.collect()}
    assert got == {"long": "ValueError", "bytes": "UnicodeDecodeError", "empty": "empty", "none": "no entry", "gone": "FileNotFoundError"}
    assert registry.payloads(spark, sources, str(tmp_path)).rdd.getNumPartitions() == len(sources)
    assert registry.payloads(spark, [], "").count() == 0


def test_broken_state_is_set_apart_and_the_last_whole_one_served(spark, tmp_path):
    root, schema = str(tmp_path / "s"), "k string, n long"
    served = lambda: sorted((r.k, r.n) for r in quarantine.state_served(spark, root, schema)[0].collect())
    assert served() == [] and quarantine.set_apart(spark, root) == []
    for n in (1, 2, 3):
        path = quarantine.state_written(spark.createDataFrame([("a", n), ("b", None)], schema), root)
    assert served() == [("a", 3), ("b", None)]
    part = next(p for p in (tmp_path / "s").rglob("part-*.json") if str(p).startswith(path.removeprefix("file:")) and "a" in p.read_text())
    part.write_text('{"k": "a", "n"')
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert served() == [("a", 2), ("b", None)]
    assert len(quarantine.set_apart(spark, root)) == 1 and served() == [("a", 2), ("b", None)]


def test_broken_files_by_name(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"k": "a", "n": 1}\n\n{"k": "b", "n": "odd"}\n')
    (tmp_path / "two.json").write_text('{"k": "c", "n": 2}\n')
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "three.json").write_text("{")
    got = {r.file.rsplit("/", 1)[1]: (r.n, r.bad) for r in quarantine.health(spark, str(tmp_path), "k string, n long").collect()}
    assert got == {"one.json": (2, 1), "two.json": (1, 0), "three.json": (1, 1)}
    rows, moved = quarantine.quarantined(spark, str(tmp_path), "k string, n long")
    assert [(r.k, r.n) for r in rows.collect()] == [("c", 2)] and len(moved) == 2
    assert sorted(p.name.split(".corrupt-")[0] for p in tmp_path.rglob("*.corrupt-*") if "crc" not in p.name) == [".one.json", ".three.json"]
    assert quarantine.quarantined(spark, str(tmp_path), "k string, n long")[1] == []


def test_pooling(spark):
    rows = [("a", [1.0, 0.0], 3), ("a", [0.0, 2.0], 1), ("b", [0.0, 0.0], 1), ("c", None, 1), (None, [1.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "k string, v array<float>, n int")
    got = {r.k: [round(x, 6) for x in r.vector] for r in similarity.pooled(frame, "k", "v").collect()}
    assert got == {"a": [round(0.5 / 1.25**0.5, 6), round(1 / 1.25**0.5, 6)], "b": [0.0, 0.0]}
    weighted = {r.k: r.vector for r in similarity.pooled(frame, "k", "v", "n").collect()}
    assert abs(weighted["a"][0] / weighted["a"][1] - 1.5) < 1e-9


def test_embedding_by_words(spark):
    def make():
        return lambda words: np.array([[np.nan, 0] if w == "bad" else [len(w), 1.0] for w in words], np.float32)

    texts = [("1", "One two, two"), ("2", ""), ("3", None), ("4", "bad word"), ("5", "x " * 1000 + "muchlonger")]
    got = {r.id: r.embedding for r in similarity.embedded(spark.createDataFrame(texts, "id string, text string"), make, 2).collect()}
    assert got["2"] is None and got["3"] is None and got["4"] is None
    assert abs(got["1"][0] / got["1"][1] - 3) < 1e-6 and abs(got["5"][0] / got["5"][1] - 1) < 1e-6
    assert json.dumps(got["5"]) and F is not None


def test_connectors_equal_their_sql_on_odd_rows_in_any_time_zone(spark, sf_dir, tmp_path):
    """Links that strict parsers refuse, a document longer than a payload may be, a negative count, dates without a zone."""
    urls = [f"https://a.example/{p}" for p in ("<b>", '"q"', "|", "%zz", "{x}", "x^", "]]>", "x#y#z")] + ["https://my_host.example/", "https://a-.example/", "https://a.example.1x/"]
    texts = [("x" * (registry.PAYLOAD_MAX + 1), 1), ("plain", -5)]
    odd = {
        "documents": [{"doc_id": 10**6 + k, "text": t, "lang": "de", "source": "src1", "n_chars": n} for k, (t, n) in enumerate(texts)],
        "pages": [{"page_id": 10**6 + k, "url": u, "html": ""} for k, u in enumerate(urls)],
    }
    duck, zone = duckdb.connect(), spark.conf.get("spark.sql.session.timeZone")
    for name, rows in odd.items():
        whole = pq.read_table(f"{sf_dir}/{name}.parquet")
        pq.write_table(pa.concat_tables([whole, pa.Table.from_pylist(rows, schema=whole.schema)]), tmp_path / f"{name}.parquet")
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = sorted(tuple(r) for r in round_queries.feed_connectors(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    want = sorted(duck.sql(f"SELECT source, title, body, url, published_at FROM ({queries.ORACLES['feed_connectors']})").fetchall())
    assert len(found) == len(want) and all(a == b for a, b in zip(found, want))
