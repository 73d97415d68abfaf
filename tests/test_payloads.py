from __future__ import annotations

import difflib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loamline.functions import payloads
from loamline.operators import collections, model_steps, table_hints
from loamline.sources import databases, sinks


def test_spine_of_missing_columns(spark):
    df = spark.createDataFrame([("bq view", " Kenya ; kenya;; Mali", None), (None, None, "econ"), ("other", "", None)], "type string, place_of_focus string, domain string")
    got = [(r["doc_kind"], r["label"], r["source_kind"], r["geo_countries"], r["geo_country_primary"], r["geo_scope"], r["domains"]) for r in payloads.spine(df).collect()]
    assert got == [
        ("bq_table_description", "bq view", "bq_table_description_docx", "Kenya; Mali", "Kenya", "multi_country", None), ("other", None, None, None, None, "unknown", "econ"),
        ("other", None, None, None, None, "unknown", None),
    ]


def test_payload_keeps_allowed_scalars(spark):
    df = spark.createDataFrame([("body", "news", ["x" * 2000], 3, None)], "text string, doc_kind string, domains array<string>, chunk_index int, secret string")
    held = df.select(payloads.payload(df, "text", "news").alias("p")).first()["p"]
    assert set(held) == {"content", "doc_kind", "domains", "chunk_index"} and len(held["domains"]) == 1000 and held["chunk_index"] == "3"
    assert "secret" not in df.select(payloads.payload(df, "text").alias("p")).first()["p"]  # null


def test_residual_filter(spark):
    df = spark.createDataFrame(
        [(1, "news", None, "2023-05-01T00:00", "Kenya", "References"), (2, "x", "bq table", "soon", "Mali; Kenya", None), (3, "news", None, None, None, "body"), (4, "news", None, "2020-01-01", "Kenya", None)],
        "i int, doc_kind string, type string, published_at string, geo_countries string, section_role string",
    )
    ids = lambda **how: [r["i"] for r in df.where(payloads.passes(df, **how)).orderBy("i").collect()]
    assert ids(doc_kinds=["news"]) == [1, 3, 4] and ids(doc_kinds=["bq_table_description"]) == [2]
    assert ids(geo=" KENYA") == [1, 2, 4] and ids(start="2022-01-01") == [1, 2, 3] and ids(excluded_roles=["references"]) == [2, 3, 4] and ids() == [1, 2, 3, 4]


def test_title_similarity(spark):
    pairs = [("Maize doubles!", "maize  doubled"), (None, "x"), ("", ""), ("abcd efgh", "efgh abcd")]
    got = [r["s"] for r in spark.createDataFrame(pairs, "a string, b string").select(payloads.title_similarity("a", "b").alias("s")).collect()]
    assert got == [difflib.SequenceMatcher(None, "maize doubles", "maize doubled").ratio(), 0.0, 1.0, difflib.SequenceMatcher(None, "abcd efgh", "efgh abcd").ratio()]


def test_layouts_and_modes(spark):
    assert collections.vectors_of("ota_triple") == collections.LAYOUTS["ota_triple"] and collections.vectors_of("ota_triple", "metric") == ["metric_vector"]
    assert collections.vectors_of("dual", "no such") == ["sentence", "semantic"]
    with pytest.raises(ValueError, match="unknown search mode"):
        collections.vectors_of("other")


def test_hybrid_falls_back_to_dense(spark):
    dense = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.9)], "q long, i long, score double").withColumn("rank", F.lit(1))

    def broken():
        raise ImportError("no sparse model")

    for sparse in (None, broken):
        assert [(r["i"], r["rank"]) for r in collections.hybrid_or_dense(dense, sparse, "q", "i", 2).orderBy("rank").collect()] == [(11, 1), (10, 2)]


def test_collection_upserts_and_resets(spark, tmp_path):
    c = collections.Collection(spark, f"file://{tmp_path}", "tables", "data_description")
    c.create()
    rows = [("a", [1.0], [1.0], [1.0], {"content": "x", "secret": "y", "label": None}, "1"), ("a", [2.0], [1.0], [1.0], {"content": "z"}, "2"), ("b", [1.0], [1.0], [1.0], {}, "1")]
    points = spark.createDataFrame(rows, c.schema)
    c.upsert(points)
    c.upsert(points)
    assert sorted((r["id"], r["version"], r["payload"].get("content")) for r in c.read().collect()) == [("a", "2", "z"), ("b", "1", None)]
    c.create()
    assert c.read().count() == 2
    with pytest.raises(ValueError, match="no vector"):
        c.upsert(points.drop("table_vector"))
    c.create(reset=True)
    assert c.read().count() == 0


def test_csv_and_database(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Kisumu\nx,Mali\n")
    df = databases.read_csv(spark, f"file://{tmp_path}/a.csv", "id int, name string")
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "Kisumu"), (None, "Mali")]
    url = "jdbc:derby:memory:loam;create=true"
    try:
        databases.overwrite_table(df, url, "cities")
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no embedded database: {str(e)[:80]}")
    databases.overwrite_table(df, url, "cities")
    assert databases.read_table(spark, url, "cities").where("id = 1").count() == 1
    assert databases.read_table(spark, url, "cities", split=("id", 0, 10, 3)).count() == 2


def test_rendered_schema_is_bounded():
    about = {"table_name": "`p.d.t`", "description": "d" * 500, "primary_keys": ["a", {"b": "c"}, []], "grain": {"x": 1, "y": ["k", 2], "z": {}}, "columns": [{"name": f"c{i}", "type": "INT64", "description": "e", "example": 3} for i in range(40)]}
    text = table_hints.render_schema("t", about)
    assert text.startswith("Table: p.d.t\nDescription: ddd") and "Grain: x=1; y=[k, 2]" in text and "Primary keys: a, b=c" in text and len(text) <= 2400
    assert "  - c0 (INT64): e [ex: 3]" in text and "… 10 more columns" in text and table_hints.render_schema("t", None) == ""
    assert len(table_hints.render_schema("t", about, max_chars=100)) <= 100


def test_logical_tables(spark):
    guide = "Guide\nTable Name (in BigQuery) | Title | Category | Why\nx.bronze.arcgis_soil | Soil | Land | It matters | much\nx.bronze.arcgis_soil | again | - | -\n1. About soil (arcgis_soil)\nDetails here.\n"
    (one,) = table_hints.logical_tables(guide, "f")
    assert one["table_name"] == "arcgis_soil" and one["text"].endswith("Details here.") and "Why it matters: It matters| much".replace("| ", "|") in one["text"].replace("| ", "|")
    assert table_hints.logical_tables("see x.gold.prices. for more", "f")[0]["table_name"] == "prices" and table_hints.logical_tables("plain", "f")[0]["table_name"] == "f"
    df = spark.createDataFrame([(1, guide, "a"), (2, None, "b"), (3, " ", "c")], "id int, text string, name string")
    assert [(r["id"], r["table_name"]) for r in table_hints.explode_tables(df, "text", "name").collect()] == [(1, "arcgis_soil")]


def test_model_steps_survive_failures(spark):
    hits = spark.createDataFrame([(1, "q", "good", "news", 1), (1, "q", "bad", "bigquery", 2), (1, "q", "fair", None, 3)], "query long, question string, text string, source string, rank int")

    def score(question, text):
        return {"good": 0.5, "fair": 0.51}[text]  # fails for "bad"

    got = model_steps.rerank_with(hits, score, "question", "text", "source", "query", 3).orderBy("rank").collect()
    assert [(r["text"], round(r["rerank_score"], 2)) for r in got] == [("good", 0.54), ("fair", 0.51), ("bad", -1.0)]
    answers = model_steps.generate_with(hits, lambda q, c: f"said {c}" if c == "good" else None, "question", "text").orderBy("rank").collect()
    assert answers[0]["answer"] == "said good" and answers[1]["answer"].endswith("bad")
    assert model_steps.statements_for("?", ["h1", "h2"], lambda p: "SELECT  1" if "h1" in p else "SELECT 1") == ["SELECT  1"]
    items = spark.createDataFrame([(1, "u1"), (2, "u1"), (3, "bad"), (4, None)], "id int, url string")

    def fetch(u):
        if u == "bad":
            raise OSError(u)
        return f"<p>{u}</p>"

    assert sorted((r["id"], r["html"]) for r in model_steps.fetched(items, "url", fetch).collect()) == [(1, "<p>u1</p>"), (2, "<p>u1</p>"), (3, None), (4, None)]
    found = model_steps.searched(spark.createDataFrame([("a",), ("b",)], "q string"), "q", lambda q: [{"url": "http://x.org/p/", "title": q}, {"url": ""}]).collect()
    assert [(r["query"], r["url"]) for r in found] == [("a", "http://x.org/p/")]
    asked = iter(["second", None])
    assert model_steps.research("first", lambda q: [q, "note"], lambda q, n: next(asked), lambda q, n: ", ".join(n)) == "first, note, second"


def test_jobs_end():
    states = iter(["pending", "running", "Succeeded"])
    assert model_steps.run_job(lambda: "7", lambda j: next(states), sleep=lambda s: None) == "succeeded"
    with pytest.raises(RuntimeError, match="failed"):
        model_steps.run_job(lambda: "7", lambda j: "failed", sleep=lambda s: None)
    with pytest.raises(TimeoutError):
        model_steps.run_job(lambda: "7", lambda j: "running", timeout=20, sleep=lambda s: None)


def test_snapshots_are_restored_and_definitions_written(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    sinks.Snapshots(spark, root).write(spark.range(3), datetime(2024, 1, 1))
    sinks.Snapshots(spark, root).write(spark.range(5), datetime(2024, 1, 3))
    assert sinks.restore_all(spark, [root, f"{root}-missing"], datetime(2024, 1, 2), datetime(2024, 1, 5)) == {root: True, f"{root}-missing": False}
    assert sinks.Snapshots(spark, root).as_of(datetime(2024, 1, 9)).count() == 3
    text = sinks.source_definitions({"x": {}, "raw": {"t": [("a", "INT64", True)]}})
    assert text.index('"raw"') < text.index('"x"') and 'name: "a"' in text and "_placeholder" in text and "source('raw', 't')" in sinks.model_text("raw", "t")
