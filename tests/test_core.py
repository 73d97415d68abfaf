from __future__ import annotations

import hashlib
import json
import uuid
import zipfile
from collections import Counter
from datetime import UTC, date, datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamline.functions import chunking, facets, keys, pages
from loamline.functions.bibliography import bibliographic, citation
from loamline.functions.taxonomy import section_role
from loamline.functions.urls import normalise_url
from loamline.functions.vocabulary import CHUNK_NAMESPACE
from loamline.operators.chat_memory import compact
from loamline.operators.components import connected
from loamline.operators.dedup import manifest_new, sequential_duplicates
from loamline.operators.retrieval import dense_topk
from loamline.operators.sql_guard import extract_statements, strict_compat, validate_sql
from loamline.sources import files, sinks
from loamline.streaming.chunks import new_chunks, rolling_summaries


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_keys(spark):
    assert one(spark, keys.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(3))) == hashlib.md5(b"a||3").hexdigest()
    text = "  Some  text\n here "
    assert one(spark, keys.chunk_content_hash(F.lit(text))) == hashlib.sha256(" ".join(text.split()).encode()).hexdigest()
    h = hashlib.sha256(b"hello").hexdigest()[:16]
    assert one(spark, keys.chunk_id(CHUNK_NAMESPACE, "news", F.lit("d1"), F.lit(2), F.lit("hello"))) == str(uuid.uuid5(uuid.UUID(CHUNK_NAMESPACE), f"news|d1|2|{h}"))
    assert one(spark, keys.initcap_words(F.lit("guinea-BISSAU coast"))) == "Guinea-Bissau Coast"
    assert one(spark, keys.token_estimate(F.lit("ab"))) == 1


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://WWW.A.B/x//y/?utm_source=1&b=2&a=%20c+d#f", "https://a.b/x/y?b=2&a=+c+d"), ("http://a.b", "http://a.b/"), ("  ", ""), (None, None), ("https://a.b/p;q=1?x", "https://a.b/p?x="),
        ("https://www.a.b/?p=87&fbclid=z", "https://a.b/?p=87"),
    ],
)
def test_url(spark, url, want):
    assert one(spark, normalise_url(F.lit(url).cast("string"))) == want


def test_feed_addresses(spark):
    gates = ["news.gate.example"]
    none = F.lit(None).cast("string")
    go = lambda link, href=none, links=F.array().cast("array<string>"), summary=none: one(spark, pages.article_url(F.lit(link), href, links, summary, gates))
    gate = "https://news.gate.example/rss/articles/1"
    assert go("https://a.example/2024/story") == "https://a.example/2024/story"
    assert go(gate, F.lit("https://b.example/2024/story")) == "https://b.example/2024/story"
    assert go(gate, links=F.array(F.lit(gate), F.lit("https://c.example/x/y"))) == "https://c.example/x/y"
    assert go(gate, F.lit("https://d.example/"), summary=F.lit('<a href="https://d.example/2024/one/two">t</a>')) == "https://d.example/2024/one/two"
    assert go(gate, summary=F.lit("see https://e.example/a/b.")) == "https://e.example/a/b"


def test_snippets(spark):
    quality = lambda body, country, title, n, must: one(spark, pages.snippet_quality(F.lit(body), F.lit(country), F.lit(title), n, must))
    many = "https://a.example/x https://b.example/y https://c.example/z Kenya"
    assert not quality(many, "Kenya", "", 2, True)["ok"] and "domain" in quality(many, "Kenya", "", 2, True)["reason"]
    assert quality("Maize in Kenya https://a.example", "Kenya", "", 2, True)["ok"]
    assert quality(many, "Peru", "", 5, False)["ok"] and not quality("nothing", "Peru", "maize harvest", 5, True)["ok"]


def test_pages(spark):
    html = "<html><head><title> A\n b </title><meta property='article:published_time' content='2024-05-01T10:00:00Z'></head><body><nav>menu</nav><p>Text &amp; more</p><script>x()</script></body></html>"
    assert one(spark, pages.html_title(F.lit(html))) == "A b"
    assert pages.visible_text(html) == "A b Text & more"
    assert one(spark, pages.html_date(F.lit(html), pages.PUBLISHED_META)) == datetime(2024, 5, 1, 10)
    assert one(spark, pages.looks_binary(F.lit("%PDF-1.4"))) and not one(spark, pages.looks_binary(F.lit("text")))


def test_section_roles(spark):
    role = lambda title, path, table=False: one(spark, section_role(F.lit(title), F.lit(path), F.lit(table)))
    assert role("", "body") == "content" and role("x", "y", True) == "table" and role("References", "paper/x") == "references"
    assert role("", "paper/methods/sampling") == "methods" and role("Abstract", "www_journal") == "boilerplate"


def test_slices_of_days():
    assert files.day_slices("q", date(2024, 6, 1), date(2024, 6, 1)) == [("q+after:2024-06-01+before:2024-06-02", "[2024-06-01]")]
    years = files.day_slices("q", date(2000, 1, 1), date(2001, 12, 31))
    assert len(years) == 731 and years[-1][1] == "[2001-12-31]"


words = st.lists(st.text("abcdefghij", min_size=1, max_size=12), min_size=1, max_size=300).map(" ".join)


@settings(max_examples=40, deadline=None)
@given(words, st.integers(5, 60))
def test_word_windows_cover_the_text(text, target):
    pieces = chunking.split_words(text, target, target // 4)
    assert all(chunking.tokens(p) <= target or " " not in p for p in pieces)
    assert set(" ".join(pieces).split()) == set(text.split()) and pieces[0].split()[0] == text.split()[0]


@settings(max_examples=40, deadline=None)
@given(st.lists(words, min_size=1, max_size=8), st.integers(20, 80))
def test_packed_sentences_stay_within_the_target(parts, target):
    text = ". ".join(parts) + "."
    pieces = chunking.within(chunking.pack_sentences(text, target, target // 5), target, target // 5)
    assert all(chunking.tokens(p) <= target or " " not in p for p in pieces)
    assert set(text.split()) <= set(" ".join(pieces).split())


def test_rows_are_never_cut():
    pieces = chunking.split_rows("h | h\n" + "\n".join(f"row {i} | {'x' * 40}" for i in range(30)), 60)
    assert all(p.startswith("h | h") for p in pieces) and sum(p.count("row ") for p in pieces) == 30
    assert chunking.split_rows("head\n" + "y" * 1000, 20)[0] == "head"  # header alone before a row that is too long


def test_blocks_follow_headings():
    found = chunking.blocks("# Top\ntext one.\n## Sub\na | b | c\nmore text.\n# Next\nend.")
    assert [(p, k) for p, _, _, k in found] == [("top", "prose"), ("top/sub/table", "table"), ("top/sub", "prose"), ("next", "prose")]


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, None), (7, 7)]
    got = {r["node"]: r["grp"] for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {x: find(x) for x in list(parent)}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_sequential_duplicates(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *[None if x == 0 else f"{k}{x}" for k, x in zip("abc", rng.integers(0, 25, 3))]) for i in range(200)]
    got = {r["i"]: r["is_duplicate"] for r in sequential_duplicates(spark.createDataFrame(rows, "i int, k1 string, k2 string, k3 string"), "i", ["k1", "k2", "k3"]).collect()}
    seen: set[str] = set()
    for i, *ks in rows:
        known = [k for k in ks if k]
        assert got[i] == any(k in seen for k in known)
        if not got[i]:
            seen |= set(known)
    new = manifest_new(spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "i int, h string"), spark.createDataFrame([("b",)], "h string"), "h", "i")
    assert sorted(r["i"] for r in new.collect()) == [1, 3, 4]


def test_dense_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(900, None), (901, [1.0])]
    df = spark.createDataFrame(rows, "i long, v array<double>")
    got = {}
    for r in dense_topk(df, "i", "v", df.where("i % 100 = 0 and i < 300").select(F.col("i").alias("q"), F.col("v").alias("w")), "q", "w", 7).collect():
        got.setdefault(r["q"], []).append((r["rank"], r["i"]))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in (0, 100, 200):
        assert [i for _, i in sorted(got[q])] == np.argsort(-(unit @ unit[q]), kind="stable")[:7].tolist()


def test_sql_guard(spark):
    two = "Here:\n```sql\nSELECT a FROM raw.t1\n```\n--- QUERY ---\nSELECT b FROM raw.t2;"
    found = extract_statements(two)
    assert len(found) == 2 and "t1" in found[0] and "t2" in found[1]
    ok = lambda s: validate_sql(spark, s, {"raw"}, 10)
    assert ok("SELECT a FROM raw.t") == "SELECT a FROM raw.t LIMIT 10" and ok("SELECT a FROM raw.t LIMIT 3") == "SELECT a FROM raw.t LIMIT 3"
    assert ok("WITH c AS (SELECT 1 AS x FROM raw.t) SELECT c.x, 0.5 FROM c") is not None
    assert [ok(s) for s in ("DROP TABLE raw.t", "SELECT 1; DROP TABLE raw.t", "SELECT a FROM other.t", "SELECT a FROM t", "", None)] == [None] * 6
    assert strict_compat("SELECT t.a FROM raw.t", {"raw"}, 10) is None and strict_compat("SELECT a FROM raw.t", {"raw"}, 10) == "SELECT a FROM raw.t LIMIT 10"


def test_chat_folds_the_oldest(spark):
    turns = [(1, i, "user" if i % 2 else "assistant", f"turn {i} " + "x" * 30) for i in range(1, 17)] + [(1, 17, "system", "no"), (1, 18, "user", "  ")]
    r = compact(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"), 3, 4000).first()
    assert r["kept_turns"] == 6 and "turn 1 " in r["summary"] and "turn 16" not in r["summary"]


def test_a_chat_summary_holds_all_that_fits(spark):
    short = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(1, 301)]
    one_sided = [(2, i, "assistant", f"a{i}") for i in range(1, 201)]  # no user: all are kept
    r = {x["conv_id"]: x for x in compact(spark.createDataFrame(short + one_sided, "conv_id long, turn int, role string, text string"), 3, 4000).collect()}
    whole = "\n".join(f"{role}: {text}" for _, _, role, text in short[:294])
    assert (r[1]["summary"], r[1]["kept_turns"]) == (whole[-1200:], 6)
    assert (r[2]["summary"], r[2]["kept_turns"]) == ("", 200)


def test_readers_and_writers(spark, tmp_path):
    lines = tmp_path / "chunks.jsonl"
    lines.write_text("\n".join(['{"id": "a", "text": "t", "metadata": {"k": "v"}}', "", "{broken", '{"id": "b"}', '{"text": "x"}', '{"id": "c", "text": "u", "metadata": 3}']))
    got = {r["id"]: r["metadata"] for r in files.read_chunks(spark, str(lines)).collect()}
    assert got == {"a": {"k": "v"}, "c": {}}
    (tmp_path / "art").mkdir()
    (tmp_path / "art" / "a.txt").write_text("---\ntitle: 'A b'\npublished_at: 2024-01-02\n---\n\nBody\r\ntext")
    (tmp_path / "art" / "b.txt").write_text("no front matter")
    (tmp_path / "art" / "c.txt").write_text("---\ntitle: x\n---\n%PDF-1.4")
    arts = {r["body"]: r["title"] for r in files.read_articles(spark, str(tmp_path / "art"), ["title", "published_at"]).collect()}
    assert arts == {"Body\ntext": "A b", "no front matter": None}
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>One</w:t><w:t> two</w:t></w:p><w:p/><w:p><w:t>Three</w:t></w:p></w:document>')
    (tmp_path / "bad.docx").write_bytes(b"nothing")
    assert sorted(str(r["text"]) for r in files.read_docx(spark, str(tmp_path)).collect()) == ["None", "One two\nThree"]
    registry = tmp_path / "feeds.json"
    registry.write_text(json.dumps({"Kenya": ["u1", " "], "_note": ["x"], "Mali": "no list"}))
    assert [tuple(r) for r in files.read_registry(spark, str(registry)).collect()] == [("Kenya", "u1")]
    rss = "<rss><channel><item><title>T</title><link>http://a/b</link><description>D</description></item></channel></rss>"
    feeds = spark.createDataFrame([("f", rss), ("g", "<broken"), ("h", None)], "feed string, xml string")
    assert [(r["feed"], r["url"], r["title"]) for r in files.parse_feeds(feeds, "xml").collect()] == [("f", "http://a/b", "T")]
    assert '"k" BIGINT' in sinks.ddl("t", spark.range(1).withColumnRenamed("id", "k").schema)
    shots = sinks.Snapshots(spark, str(tmp_path / "shots"))
    assert shots.as_of(datetime(2024, 1, 1)) is None
    for day in (1, 3):
        shots.write(spark.range(day), datetime(2024, 1, day, tzinfo=UTC))
    assert shots.as_of(datetime(2024, 1, 2)).count() == 1 and shots.as_of(datetime(2024, 1, 9)).count() == 3
    old = spark.createDataFrame([("a", 1, "x")], "id string, v int, t string")
    new = spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], "id string, v int, t string")
    once = sinks.upsert(old, new, "id", "v")
    assert sorted(map(tuple, sinks.upsert(once, new, "id", "v").collect())) == [("a", 2, "y"), ("b", 1, "z")]


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.json").write_text('{"id": "a", "text": "same  text", "arrived": "2024-01-01T00:00:00Z"}\n{"id": "b", "text": "same text", "arrived": "2024-01-01T00:01:00Z"}\n{"id": "c", "text": "other", "arrived": "2024-01-01T00:02:00Z"}\n')
    q = new_chunks(spark, str(folder)).writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert Counter(r["content_hash"] for r in spark.table("fresh").collect()).most_common(1)[0][1] == 1 and spark.table("fresh").count() == 2
    turns = tmp_path / "turns"
    turns.mkdir()
    (turns / "1.json").write_text("\n".join(json.dumps({"conv_id": 1, "turn": i, "role": "user", "text": f"t{i}"}) for i in range(6)))
    t = spark.readStream.schema("conv_id long, turn int, role string, text string").json(str(turns))
    q = rolling_summaries(t, keep=2).writeStream.format("memory").queryName("sums").outputMode("update").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.table("sums").collect()[-1]
    assert last["kept_turns"] == 2 and "t3" in last["summary"] and "t5" not in last["summary"]


def test_semantic_split_parts_unlike_neighbours():
    parts = [f"sentence {i} " + "x" * 40 for i in range(6)]
    assert chunking.semantic_split(parts[:1], [[1.0]], 50) == parts[:1]
    got = chunking.semantic_split(parts, [[1, 0], [1, 0.01], [0, 1], [0.01, 1], [1, 1], [1, 1.02]], 26)
    assert "".join(got).replace("\n\n", "").replace(" ", "") == "".join(parts).replace(" ", "") and len(got) > 2


def test_bibliography(spark):
    text = "Soil carbon under shade trees in highlands\nAmina Otieno, John B. Mwangi and Grace Wanjiru\nAfrican Journal of Soil Science 12, pp. 34-56\ndoi: 10.1234/ajss.2020.15.\n© 2021 The authors"
    b = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(bibliographic(F.col("t")).alias("b")).select("b", citation(F.col("b")).alias("c")).collect()
    assert (b[0]["b"]["doi"], b[0]["b"]["year"], b[0]["b"]["pages"]) == ("10.1234/ajss.2020.15", 2021, "34-56")
    assert b[0]["b"]["title"].startswith("Soil carbon") and b[0]["b"]["authors"].startswith("Amina") and b[0]["b"]["journal"].startswith("African Journal")
    assert b[0]["c"].startswith("Amina Otieno") and b[1]["b"]["doi"] is None and b[2]["c"] == ""


def test_lanes(spark):
    df = spark.createDataFrame([("r", "a", None, "c")], "id string, insight string, metric string, advice string")
    assert [(r["chunk_index"], r["lane"]) for r in chunking.explode_lanes(df, "id", ["insight", "metric", "advice"]).collect()] == [(0, "insight"), (1, "advice")]


def test_facets(spark):
    today = F.lit("2026-05-31").cast("date")
    years = lambda t: tuple(one(spark, facets.year_range(F.lit(t), today)))
    assert years("yield from 2013 to 2022") == ("2013-01-01", "2022-12-31") and years("past 7 years") == ("2019-05-28", "2026-05-31") and years("none") == (None, None)
    assert one(spark, facets.countries(F.lit("agriculture in nigeria"))) == ["Nigeria"] and "Niger" not in one(spark, facets.countries(F.lit("products nigeria produces")))
    intents = ["will maize prices rise", "track the drought", "compare Kenya and Mali", "where should we plant", "should we fund it", "why did it fail", "maize"]
    assert [one(spark, facets.intent(F.lit(t))) for t in intents] == ["predictive", "monitoring", "compare", "locate", "decision_support", "diagnostic", "descriptive"]
    assert one(spark, facets.news_country(F.lit("Africa"), F.array(F.lit("Mali")))) is None
    assert one(spark, facets.news_country(F.lit(""), F.array(F.lit("West Africa"), F.lit("Mali")))) == "Mali"


def test_page_gates(spark):
    gate = lambda t, b: one(spark, pages.is_gate_page(F.lit(t), F.lit(b)))
    assert gate("Before you continue", "") and gate("", "Before you continue to Google") and not gate("Maize", "Prices fell.")
    assert one(spark, pages.better_title(F.lit("News"), F.lit("Maize prices fall"))) == "Maize prices fall"
    assert one(spark, pages.adds_little(F.lit("Maize prices fall"), F.lit("Maize prices fall, he said"))) and not one(spark, pages.adds_little(F.lit("Maize"), F.lit("x " * 200)))
    assert one(spark, pages.binary_payload(F.lit(bytearray(b" \n%PDF-1.7")))) and not one(spark, pages.binary_payload(F.lit(bytearray(b"<html>"))))


def test_far_points_find_their_site(spark):
    from loamline.plans.soil import nearest

    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 5000.0, -7000.0), (3, float("nan"), 0.0), (4, None, 0.0), (5, float("inf"), 1.0), (6, -3.0, 4.0)], "id long, lat double, lon double")
    sites = spark.createDataFrame([(7, 0.5, 0.5), (8, -900.0, 0.0), (9, 0.5, 0.5), (10, None, 1.0)], "site long, lat double, lon double")
    got = {r["id"]: (r["site"], round(r["distance"], 6)) for r in nearest(points, sites, 0.01).collect()}
    assert got == {1: (7, round(0.5**0.5, 6)), 2: (7, round((4999.5**2 + 7000.5**2) ** 0.5, 6)), 6: (7, round((3.5**2 + 3.5**2) ** 0.5, 6))}
    assert nearest(points, sites.limit(0), 1.0).count() == 0
