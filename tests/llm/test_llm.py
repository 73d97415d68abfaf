from __future__ import annotations

import re
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import compare  # noqa: E402

from loamline.llm import leakage, main_content, mixing, near_duplicates, queries, registry, residue, splitting, subjects  # noqa: E402

TOKENIZER = Path(mixing.TOKENIZERS)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, data, name):
    compare(spark, registry.queries()[name], registry.oracle_sql()[name], data)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, data, name):
    assert registry.queries()[name](spark, data).count() >= 0


# ---------------------------------------------------------------- 1: splitting
texts = st.lists(st.sampled_from(["word", "Another sentence ends here. ", "line\n", "\n\n", "x" * 90, "é", "Dr. Who said. Then"]), min_size=1, max_size=300).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(4, 60), st.integers(0, 15), st.integers(0, 10))
def test_pieces_are_within_the_limit_and_give_the_text_back(text, most, overlap, least):
    pieces = splitting.cut(text, most, overlap, least)
    assert all(max(1, (b - a) // 4) <= most for a, b in pieces) or len(text) // 4 <= most
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    out = ""
    for k, (a, b) in enumerate(pieces):
        assert a < b or not text
        assert k == 0 or (pieces[k - 1][0] < a <= pieces[k - 1][1] < b)
        out += text[a:b] if k == 0 else text[pieces[k - 1][1] : b]
    assert out == text


def test_an_edit_alters_neighbouring_pieces_only():
    rng = np.random.default_rng(5)
    text = " ".join(f"Sentence {i} speaks of {' '.join(rng.choice(list('abcdefghij'), 12))}." for i in range(900))
    changed = text[:20_000] + " An inserted remark." + text[20_000:]
    a, b = ({t[x:y] for x, y in splitting.cut(t, 300, 30, 20)} for t in (text, changed))
    assert len(a - b) <= 4 and len(b - a) <= 4 and len(a) > 30


def test_split_edge_cases(spark):
    rows = [("a", None, "news"), ("b", "", "news"), ("c", "x" * 500, "news"), ("c", "x" * 500, "news"), ("d", "y " * 900, None), ("e", "z " * 900, "unknown"), (None, "w " * 400, "news"), ("f", "q" * 400_000, "news")]
    df = spark.createDataFrame(rows, "id string, text string, kind string").withColumns({"_max": F.lit("x"), "piece": F.lit(1), "doc_kind": F.lit(2)})
    profiles = spark.createDataFrame([("news", 100, 10, 5), (None, 1, 1, 1)], "doc_kind string, max_tokens int, overlap_tokens int, min_tokens int")
    got = splitting.split_oversized(df, "text", "kind", profiles, ["id"]).collect()
    n = defaultdict(int)
    for r in got:
        n[r["id"]] += 1
        assert r["piece"] is not None and (r["id"] in ("d", "e") or len(r["piece"]) // 4 <= 100)
    assert n["a"] == 0 and n["b"] == n["d"] == n["e"] == 1 and n["c"] == 4 and n[None] > 1 and n["f"] > 1000
    assert splitting.split_oversized(df.limit(0), "text", "kind", profiles, ["id"]).count() == 0


# ---------------------------------------------------------------- 2: near duplicates
def brute_groups(rows, threshold):
    bag = lambda t: frozenset(re.findall(r"[^\W_]+", (t or "").lower()))
    parent = {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t, u in rows:
        for j, s, v in rows:
            a, b = bag(t), bag(s)
            if i < j and ((a and b and len(a & b) >= threshold * len(a | b)) or (u and u == v)):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    size = defaultdict(int)
    for i in parent:
        size[find(i)] += 1
    return {i: find(i) for i in parent if size[find(i)] > 1}


def test_groups_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = [[f"w{x}" for x in rng.integers(0, 4000, 12)] for _ in range(60)]
    rows = []
    for i in range(260):
        words = list(base[rng.integers(0, 60)])
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(0, 12)] = f"v{rng.integers(0, 9999)}"
        rows.append((i, " ".join(words), f"u{i // 2}" if i % 9 == 0 else None))
    rows += [(900, None, None), (901, "", "u1x"), (902, "!?", "u1x"), (903, "alone here", None), (904, rows[0][1], ""), (904, rows[0][1], "")]
    df = spark.createDataFrame(rows, "item long, title string, u string").withColumns({"grp": F.lit(1), "a": F.lit(2), "set_id": F.lit(3)})
    got = near_duplicates.near_duplicate_groups(df, "item", near_duplicates.words_of("title"), threshold=0.6, same_key=F.col("u"))
    assert {r["item"]: r["grp"] for r in got.collect()} == brute_groups(list(dict.fromkeys(rows)), 0.6)
    assert near_duplicates.near_duplicate_groups(df.limit(0), "item", near_duplicates.words_of("title"), threshold=0.6).count() == 0


def test_every_record_has_its_group(spark):
    rows = [(1, "maize harvest doubles"), (2, "maize harvest doubles"), (3, "goats on the road"), (4, None), (4, None), (None, "x")]
    df = spark.createDataFrame(rows, "item long, title string")
    got = near_duplicates.near_duplicate_groups(df, "item", near_duplicates.words_of("title"), threshold=0.6, alone=True)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_a_large_bucket_is_linked_without_all_its_pairs(spark):
    common = " ".join(f"story{k}" for k in range(30))
    rows = [(i, f"{common} tail{i}") for i in range(300)] + [(1000 + i, common.replace("story1 ", f"other{i} ")) for i in range(3)]
    df = spark.createDataFrame(rows, "item long, title string")
    got = near_duplicates.near_duplicate_groups(df, "item", near_duplicates.words_of("title"), threshold=0.8).collect()
    assert {r["grp"] for r in got} == {0} and len(got) == len(rows)


def test_five_word_shingles(spark):
    row = spark.createDataFrame([("a b c d e f",), ("a b",), (None,)], "t string").select(near_duplicates.shingles_of("t", 5).alias("s")).collect()
    assert [r["s"] for r in row] == [["a b c d e", "b c d e f"], ["a b"], []]


# ---------------------------------------------------------------- 3: residue
@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("In {{ crop }}, yield rose by {{percent}}.", "fields"), ("Dear [insert name here], the figures are enclosed.", "fields"), ("The price at %MARKET% moved by ${change} over the month.", "fields"),
        ("In TBD, yield of TBD reached TBD.", "fields"), ("Contact [à compléter] at the office.", "fields"), ("Prepared by <author> for <%= crop %>.", "fields"),
        ("Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "filler"), ("Your text goes here", "filler"), ("abc abc abc abc", "filler"), ("fsdlfkjldal f j   aklakllslaklsj asajfjd", "filler"),
        ("404 Not Found", "error"), ('{"status": 503, "error": "Service Unavailable"}', "error"), ("Access denied\nRequest id 12.", "error"), ("Please enable JavaScript to continue.", "demand"),
        ("Veuillez activer JavaScript pour afficher cette page.", "demand"), ("Home\nMarkets\nPlease enable JavaScript to continue.\n© 2024 Daily. All rights reserved.", "demand"),
        ("The template prints {{ season }} as a field name, and staff fill it by hand. Nothing else changed.", ""), ("Section 404 of the seed act forbids the sale of lots. It is in force since May.", ""),
        ("About 500 farmers learned JavaScript to maintain the board. They meet on Mondays in town.", ""), ("Sets such as {2, 3, 5} were drawn for plots in the north [19]. All were sown in May.", ""),
        ("```\n{{ crop }}\n```\nUse double braces in a template to insert a value there. It works in any file.", ""), ("1.5,2.5,3.5,4.5,5.5", ""), ("ACGTACGTACGTACGTACGT", ""), ("", ""), (None, ""), ("  \n ", ""),
        ("Farmers in the valley sold more maize this year. Prices fell at the market.\nPlease enable JavaScript to view the comments.", ""),
    ],
)
def test_residue(text, reason):
    assert residue.judge(text).reason == reason


@pytest.mark.parametrize("times", [1, 3, 7, 8, 9, 60])
@pytest.mark.parametrize("text", ["Under construction.", "bla bla bla.", "Em breve.", "Connection refused.", "Type your text here."])
def test_residue_whatever_its_length(text, times):
    assert residue.judge(" ".join([text] * times)).reason and residue.judge("\n".join([text] * times)).reason
    assert not residue.judge(" ".join([text] * times) + "\nFarmers in the valley sold more maize this year. Prices fell at the market in the town.").reason


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        *((x, "error") for x in (
            "400 Bad Request", "401 Unauthorized", "405 error", "408 Request Timeout", "451 page", "Connection refused", "Session ended", "Session has ended", "Access denied", "Permission is denied", "File has moved", "The site is down",
            "Record was removed", "Document is damaged", "Page introuvable", "Página não encontrada", "Ukurasa haupo", "Bad gateway", "Rate limited", "Syntax error", "Stack trace", "Undefined index", "Null pointer", "Out of memory",
            "Query failed", "Timeout after 30", "Incident code", "Text extraction failed", "Unable to decode", "Closed for maintenance", "En maintenance", "Come back later", "Try again in 5", "Are you a bot", "Verify you are", "Captcha",
            "Log in again", "Please upgrade", "Onyesho", "Session expirée", "Sessão expirada", "One more step", "Wrong address",
        )),
        *((x, "filler") for x in (
            "Type your text here", "Add your content here", "Insert the title here", "Heading goes here", "This is a dummy page", "Replace this before publishing", "Image placeholder", "This page is intentionally left blank", "TODO: write",
            "Coming soon", "Votre texte ici", "Texte provisoire", "Insira seu texto aqui", "Texto de exemplo", "Weka maandishi hapa", "Maandishi ya mfano", "Lorem ipsum dolor sit amet " * 20, "lorem ipsum dolor sit amet " * 2000,
        )),
        *((x, "demand") for x in ("Turn on scripting", "Enable cookies", "Switch them on", "Washa JavaScript", "Ative o JavaScript", "Activez JavaScript", "noscript")),
    ],
)
def test_every_wording_of_residue(text, reason):
    assert residue.judge(text).reason == reason


def test_a_long_text_repeats_its_words():
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in ("maize", "bean", "goat", "river", "market", "price") for b in ("ing", "ed", "er", "al", "ous", "ly", "ment", "ful", "ity", "ness")]
    assert residue.judge(" ".join(rng.choice(words, 3000)) + ".").reason == ""


def test_residue_edge_cases(spark):
    rows = [("a", None), (None, "404 Not Found"), ("b", "404 Not Found"), ("b", "404 Not Found"), ("c", "word " * 200_000)]
    df = spark.createDataFrame(rows, "id string, text string").withColumns({"reason": F.lit(1), "_id": F.lit(2)})
    got = sorted((str(r["id"]), r["reason"]) for r in residue.residue_of(df, "id", "text").collect())
    assert got == [("None", "error"), ("a", ""), ("b", "error"), ("b", "error"), ("c", "filler")]
    assert residue.residue_of(df.limit(0), "id", "text").count() == 0 and residue.drop_residue(df, "text").count() == 1


# ---------------------------------------------------------------- 7: main content
PAGE = """We use cookies to improve your visit. Accept all
Home | Markets | Weather | About

Home » News » Maize harvest doubles
Maize harvest doubles in the valley
The bakery now sells sorghum cookies, and mothers accept them for school.
Read also: Storm ruins the beans
What the figures show
Growers sold twice as much, the cooperative said.
ADVERTISEMENT
No trader wanted to share the costs.
Most read
Locusts threaten the coffee in the hills (3h ago)
Goats price below 300; traders eye the border
© 2024 Valley Daily. All rights reserved."""


@pytest.mark.parametrize("title", ["Maize harvest doubles in the valley", None, "Another title altogether"])
def test_main_content(title):
    kept = [n for n, good in main_content.main_lines(PAGE, title) if good]
    assert kept == [5, 6, 8, 9, 11]


HEAD = "Home | Markets | Weather | About\nMaize harvest doubles in the valley\n"
FOOT = "\nMost read\nLocusts threaten the coffee in the hills of Sonduale and Muathepuada, growers say\nCourt halts milk levy on lorries to Broraibar and Honyatisho after long protest\n© 2024 Valley Daily. All rights reserved."
WRAPPED = """Growers in the valley sold twice as much maize this year as they did
in the last one, and the cooperative built two stores to hold what the
mills of Muathepuada could not take before the rains came back in the
month of March. Prices fell at once, and traders at the border waited
for the buyers from Kisumu, who had promised to come with lorries."""


@pytest.mark.parametrize(
    ("body", "kept"),
    [
        (WRAPPED, 5),  # wrapped in mid-sentence
        ("Growers sold twice as much, the cooperative said.\nTraders at the border waited for two weeks for the buyers from the coast who had promised to come\nNo trader wanted to share the costs.", 3),  # no final mark
        ("Growers sold twice as much, the cooperative said.\nThe stores were full by March. Traders at the border waited for the buyers who had promised to come", 2),  # the last line is cut
        ("The cooperative advises its members on these points:\n• plant the early variety in the first two weeks after the rains\n• store the grain dry and in closed bags of no more than fifty kilograms", 3),
        ("Growers sold twice as much, the cooperative said.\n▶ Court halts milk levy on lorries to Broraibar and Honyatisho after long protest\nNo trader wanted to share the costs.", 2),  # a pointer is none
        ("Growers sold twice as much, the cooperative said.\nMost read\nCourt halts milk levy on lorries to Broraibar and Honyatisho after long protest\nNo trader wanted to share the costs.", 2),  # nor is a list of others
    ],
)
def test_long_lines_without_a_final_mark(body, kept):
    title = "Maize harvest doubles in the valley"
    page = HEAD + body + FOOT
    good = [n for n, x in main_content.main_lines(page, title) if x]
    n = body.count("\n") + 1
    skipped = {i + 3 for i, x in enumerate(body.split("\n")) if x.startswith(("▶", "Most", "Court"))}
    assert good == [2, *(i for i in range(3, 3 + n) if i not in skipped)] and len(good) == kept + 1


def test_markup_is_parsed():
    html = "<html><body>\n<nav><a>Home</a> <a>Markets</a></nav>\n<h1>Maize harvest doubles in the valley</h1>\n<p>Growers sold twice as much, the cooperative said.</p>\n<script>var x = 'A sentence, it seems.';</script>\n</body></html>"
    assert [n for n, good in main_content.main_lines(html, "Maize harvest doubles in the valley") if good] == [3, 4]


def test_main_content_edge_cases(spark):
    rows = [("a", None, "t"), ("b", "", "t"), ("c", " \n\r\n ", None), ("d", PAGE, None), ("d", PAGE, None), ("e", "A long line of text. " * 50_000, None)]
    df = spark.createDataFrame(rows, "id string, text string, title string").withColumns({"line_no": F.lit(1), "_text": F.lit(2)})
    got = main_content.main_content_lines(df, "id", "text", "title").collect()
    assert {r["id"] for r in got} == {"d", "e"} and sum(r["id"] == "d" and r["is_main"] for r in got) == 10
    assert main_content.main_content_lines(df.limit(0), "id", "text", "title").count() == 0
    assert main_content.main_content_text(df, "text", "title").where("id = 'd'").first()["main_text"].startswith("Maize harvest")


# ---------------------------------------------------------------- 8: leaks
def test_leaks_against_brute_force(spark):
    rng = np.random.default_rng(7)
    items = [(i, " ".join(f"q{x}" for x in rng.integers(0, 60, 40))) for i in range(12)]
    docs = []
    for d in range(120):
        words = [f"d{x}" for x in rng.integers(0, 99, 60)]
        if d % 2:
            part = items[rng.integers(0, 12)][1].split()
            k, n = rng.integers(0, 25), rng.integers(6, 18)
            words[20:20] = part[k : k + n]
        docs.append((d, "; ".join(words).upper()))
    docs += [(500, None), (None, items[0][1]), (501, ""), (502, items[3][1]), (502, items[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"_doc": F.lit(1), "longest": F.lit(2)})
    it = spark.createDataFrame([*items, (77, None), (78, "too short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(df, "doc_id", "text", it, "item_id", "text").where("longest >= 12").collect()}
    runs = defaultdict(set)
    for i, t in items:
        w = leakage.words(t)
        for k in range(len(w) - 11):
            runs[tuple(w[k : k + 12])].add(i)
    want = {(d, i) for d, t in docs if d is not None and t for w in [leakage.words(t)] for k in range(len(w) - 11) for i in runs.get(tuple(w[k : k + 12]), ())}
    assert got == want and want
    assert leakage.leaked_items(df.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0
    assert leakage.leaked_items(df, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0


def test_reordered_passages_are_found():
    words = [f"w{k}" for k in range(40)]
    index = leakage.Items([(1, " ".join(words))], 6)
    mixed = " ".join([*words[30:40], "x", *words[0:10], "y", *words[20:30], "z", *words[10:20]])
    ((item, tiling),) = leakage.leaks(mixed, index)
    assert item == 1 and tiling.longest == 10 and tiling.tiles == 4 and tiling.covered == 1.0


def test_item_blocks_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"t{i}x{k}" for k in range(20))) for i in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(f"t{i}x{k}" for k in range(3, 18))) for i in range(9)], "doc_id long, text string")
    monkeypatch.setattr(leakage, "MAX_BLOCK_ITEMS", 4)
    assert leakage.leaked_items(docs, "doc_id", "text", items, "item_id", "text").where("longest >= 12").count() == 9


# ---------------------------------------------------------------- 9: mixing
@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 500)), min_size=1, max_size=60), st.integers(0, 1000))
def test_pivoting_keeps_the_weight(rows, salt):
    part, weight = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    out = mixing.pivot(part, weight, np.arange(len(rows)), salt)
    open_ = (out > 1e-9) & (out < 1 - 1e-9)
    assert open_.sum() <= 1 and ((out >= 0) & (out <= 1)).all()
    assert abs((out * weight).sum() - (part * weight).sum()) < 1e-6 * max(1.0, weight.sum())


def test_pivoting_keeps_expectations():
    part, weight = np.array([0.2, 0.5, 0.7, 0.4]), np.array([3.0, 1.0, 2.0, 5.0])
    mean = np.mean([mixing.pivot(part, weight, np.arange(4), s) for s in range(8000)], axis=0)
    assert np.abs(mean - part).max() < 0.02


def test_mix_reaches_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PER_GROUP", 16)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = np.random.default_rng(8)
    rows = [(i, "a" if i < 900 else "b" if i < 1000 else "c", int(rng.integers(50, 150))) for i in range(1010)]
    rows += [(5000, None, 10), (None, "a", 10), (5001, "none", 10), (5002, "a", 0), (3, "a", rows[3][2])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int").withColumns({"key": F.lit(1), "weight": F.lit(2)})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 4), ("absent", 0.05, 3), (None, 0.1, 1), ("bad", -1.0, 1)], "source string, target_share double, max_repeats int")
    used, report = mixing.mix_sources(docs, "doc_id", "source", F.col("n"), targets)
    got = {r["source"]: r for r in report.collect()}
    for s, share, most in (("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.15, 4)):
        assert abs(got[s]["share_reached"] - share / 0.95) < 0.03 and got[s]["most_copies"] <= most
    assert got["absent"]["share_reached"] == 0 and used.groupBy("doc_id").count().where("count > 1").count() == 0
    c = sum(r[2] for r in rows if r[1] == "c")
    assert got["c"]["tokens_used"] == 4 * c  # the source that binds is used in full
    total = sum(r["tokens_used"] for r in got.values())
    assert all(abs(got[s]["tokens_used"] - share / 0.95 * total) < 200 for s, share in (("a", 0.5), ("b", 0.3)))
    used2, _ = mixing.mix_sources(docs, "doc_id", "source", F.col("n"), targets)
    assert sorted(map(tuple, used.collect())) == sorted(map(tuple, used2.collect()))  # a retry draws the same
    none, empty = mixing.mix_sources(docs.limit(0), "doc_id", "source", F.col("n"), targets)
    assert none.count() == 0 and all(r["tokens_used"] == 0 for r in empty.collect())


@pytest.mark.skipif(not TOKENIZER.exists(), reason="no vocabulary files")
def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([("The maize grew.",), ("",), (None,), ("word " * 50_000,)], "t string")
    assert [r["n"] for r in df.select(mixing.tokens_of(F.col("t")).alias("n")).collect()] == [4, 0, 0, 50_001]


# ---------------------------------------------------------------- 10: subjects
def test_sentences_know_abbreviations():
    got = subjects.sentences("Dr. Who noted approx. 3 percent less, e.g. in May (cf. Table 2). Then it rained!\n\nNew paragraph here")
    assert [p for p, _ in got] == [0, 0, 1] and got[0][1].endswith("Table 2).")


def corpus(n=400, seed=9):
    rng = np.random.default_rng(seed)
    names = ["farm_software", "sport_and_community", "livestock_health"]
    words = {s: [f"{s[:3]}{k}" for k in range(25)] for s in names}
    docs, truth, labels = [], {}, []
    for d in range(n):
        mine = [names[x] for x in rng.choice(3, rng.integers(1, 3), replace=False)]
        truth[d] = set(mine)
        text = "\n\n".join(" ".join(f"The {rng.choice(words[s])} of the {rng.choice(words[s])} near Town{rng.integers(0, 500)} was {rng.choice(words[s])}." for _ in range(5)) for s in mine)
        docs.append((d, text, "p", "s"))
        if d % 3 == 0:
            labels.append((d, mine[0] if rng.random() > 0.08 else names[rng.integers(0, 3)]))
    return names, docs, truth, labels


@pytest.mark.parametrize("n", [900, 998, 1200])
def test_words_of_the_model_whatever_the_number_of_labels(n):
    texts = [f"Common words stand in a sentence {'of maize' if i % 2 else 'of goats'}." for i in range(n)] + ["The zebu was sold."] * 3 + ["A kudu ran."]
    model = subjects.WordModel(["a", "b"]).fit(texts, [[i % 2] for i in range(n)] + [[0]] * 4, subjects.Passages([]))
    assert "zebu" in model.rows and "kudu" not in model.rows


@pytest.mark.parametrize("bound", ["MAX_SUBJECTS", "MAX_HELD_OUT"])
def test_more_subjects_or_items_than_the_bound_are_an_error(spark, monkeypatch, bound):
    monkeypatch.setattr(queries, bound, 2)
    with pytest.raises(ValueError, match="more than 2"):
        queries.p10_shares(spark, "/root/testdata/sf0.001")


def test_subjects_of_held_out_documents(spark):
    names, docs, truth, labels = corpus()
    passage = " ".join(f"zz{k}" for k in range(40))
    docs[1] = (1, docs[1][1] + "\n\n" + (passage + ". ") * 6, "p", "s")  # a held-out passage counts nothing
    docs += [(7000, None, None, None), (None, "text", None, None), (7001, "", None, None), (7002, "…", None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, publisher string, source string").withColumns({"subject": F.lit("x"), "n": F.lit(1), "pattern": F.lit(2)})
    lab = spark.createDataFrame([*labels, (None, names[0]), (3, None), (4, "no subject")], "doc_id long, subject string")
    how = {"address": "publisher", "source": "source"}
    got = defaultdict(set)
    for r in subjects.subject_shares(df, "doc_id", "text", names, lab, [(1, passage)], **how).where("share >= 0.25").collect():
        got[r["doc_id"]].add(r["subject"])
    known = {d for d, _ in labels}
    held = [d for d in truth if d not in known]
    assert sum(got[d] == truth[d] for d in held) > 0.97 * len(held) and got[1] == truth[1]
    assert not {7000, 7001, 7002, None} & set(got)
    assert subjects.subject_shares(df.limit(0), "doc_id", "text", names, lab, [], **how).count() == 0
    assert subjects.subject_shares(df, "doc_id", "text", names, lab.limit(0), [], **how).count() >= 0


def test_accuracies_are_learned_without_labels():
    rng = np.random.default_rng(10)
    y = rng.integers(0, 3, 20_000)
    votes = np.zeros((len(y), len(subjects.FUNCTIONS)), dtype=np.int64)
    for j, a in enumerate([0.95, 0.8, 0.6]):
        wrong = (y + rng.integers(1, 3, len(y))) % 3
        votes[:, j] = np.where(rng.random(len(y)) < a, y, wrong) + 1
        votes[rng.random(len(y)) < 0.3, j] = 0
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = subjects.Agreement(3).fit(rows, counts.astype(float))
    assert np.abs(model.accuracy[:3] - [0.95, 0.8, 0.6]).max() < 0.05


def test_density_decides_what_wording_cannot(monkeypatch):
    """Furniture without any known wording goes by its ratio; without the ratio next to nothing goes."""
    body = "The cooperative of the valley sold twice as much maize as last year, and built two stores for it. Traders waited at the border for weeks."
    page = "\n".join(["Alpha", "Beta", "Gamma delta", *[body] * 4, "Epsilon", "Zeta eta", "Storm over the hills ruins the beans of nine growers", "Theta"])
    kept = [n for n, good in main_content.main_lines(page) if good]
    assert kept == [3, 4, 5, 6, 7] or kept == [4, 5, 6, 7]  # the last heading before the text may be the headline
    all_text = "\n".join([body, "Growers agreed on this.", body, "So did the buyers of the coast."])
    assert all(good for _, good in main_content.main_lines(all_text))  # no furniture: nothing is parted
    menus = "\n".join(["Alpha", "Beta gamma delta epsilon", "Zeta", "Storm over the hills ruins beans"] * 3)
    assert not any(good for _, good in main_content.main_lines(menus))


# ---------------------------------------------------------------- bounds that must not change results
def test_a_wide_overlap_is_honoured():
    text = " ".join(f"Sentence {i} speaks of maize and beans." for i in range(400))
    pieces = splitting.cut(text, 100, 60, 20)
    repeated = [pieces[k - 1][1] - pieces[k][0] for k in range(1, len(pieces))]
    assert all(200 <= r <= 280 for r in repeated) and all((b - a) // 4 <= 100 for a, b in pieces) and all((b - a) // 4 >= 20 for a, b in pieces)


@pytest.mark.parametrize("profile", [(100, 100, 10), (100, 120, 10), (100, 0, 80)])
def test_impossible_profiles_are_errors(spark, profile):
    profiles = spark.createDataFrame([("news", *profile)], "doc_kind string, max_tokens int, overlap_tokens int, min_tokens int")
    with pytest.raises(ValueError, match="profile news"):
        splitting.split_oversized(spark.createDataFrame([("a", "t", "news")], "id string, text string, kind string"), "text", "kind", profiles, ["id"])


def test_an_item_id_may_stand_for_several_texts(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(20)) for c in "ab")
    items = spark.createDataFrame([(1, one), (1, two), (1, two), (2, one)], "item_id long, text string")
    docs = spark.createDataFrame([(10, one), (11, two), (12, f"{one} and {two}")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in leakage.leaked_items(docs, "doc_id", "text", items, "item_id", "text").collect())
    assert got == [(10, 1), (10, 2), (11, 1), (12, 1), (12, 1), (12, 2)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=25), st.integers(2, 4))
def test_tiles_against_word_by_word_tiling(text, item, shortest):
    text, item = np.array(text, dtype=np.int64), np.array(item, dtype=np.int64)
    starts = [(a, b) for a in range(len(text) - shortest + 1) for b in range(len(item) - shortest + 1) if (text[a : a + shortest] == item[b : b + shortest]).all()]
    free_text, free_item, lengths = [True] * len(text), [True] * len(item), []
    while True:  # the longest match of unmarked words, the first in the text and then on the diagonal
        best = (0, 0, 0)
        for a in range(len(text)):
            for b in range(len(item)):
                k = 0
                while a + k < len(text) and b + k < len(item) and text[a + k] == item[b + k] and free_text[a + k] and free_item[b + k]:
                    k += 1
                if k > best[0]:
                    best = (k, a, b)
        k, a, b = best
        if k < shortest:
            break
        lengths.append(k)
        for i in range(k):
            free_text[a + i] = free_item[b + i] = False
    got = leakage.tile(text, item, starts, shortest)
    assert (got.longest, got.tiles) == (max(lengths, default=0), len(lengths)) and abs(got.covered - sum(lengths) / len(item)) < 1e-12


def test_patterns_of_many_subjects_do_not_overflow(spark):
    names = [f"s{i:03d}" for i in range(600)]
    docs = spark.createDataFrame([(i, f"term{i % 600} stands here. " * 3, "p", "s") for i in range(1200)], "doc_id long, text string, publisher string, source string")
    labels = spark.createDataFrame([(i, names[i % 600]) for i in range(1200)], "doc_id long, subject string")
    got = subjects.subject_shares(docs, "doc_id", "text", names, labels, [], address="publisher", source="source").collect()
    assert {r["doc_id"] for r in got} <= set(range(1200)) and all(r["sentences"] <= 3 for r in got)
    assert sum(r["subject"] == names[r["doc_id"] % 600] for r in got) > 0.9 * len(got) > 0


@pytest.mark.parametrize("weighted", [False, True])
def test_hot_buckets_lose_no_group(spark, monkeypatch, weighted):
    """A third of all records shares its wording; groups as of all pairs, whatever the size from which a bucket counts as large."""
    rng = np.random.default_rng(12)
    core = [f"core{k}" for k in range(9)]
    rows = []
    for i in range(240):
        words = [*core, *(f"r{rng.integers(0, 5000)}" for _ in range(rng.integers(1, 9)))] if i % 3 == 0 else [f"w{rng.integers(0, 900)}" for _ in range(10)]
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join([*words[:-1], f"x{i}"])))
    df = spark.createDataFrame(rows, "item long, title string")
    n = len({frozenset(t.split()) for _, t in rows})
    count = defaultdict(int)
    for s in {frozenset(t.split()) for _, t in rows}:
        for w in s:
            count[w] += 1
    weight = lambda w: np.log1p(n / count[w]) ** near_duplicates.IDF_POWER if weighted else 1.0
    bags = {i: frozenset(t.split()) for i, t in rows}
    parent = {i: i for i in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in bags.items():
        for j, b in bags.items():
            if i < j and sum(weight(w) for w in a & b) >= 0.65 * sum(weight(w) for w in a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    want = {i: find(i) for i in bags}
    for large in (5, 40):
        monkeypatch.setattr(near_duplicates, "LARGE_BUCKET", large)
        got = near_duplicates.near_duplicate_groups(df, "item", near_duplicates.words_of("title"), threshold=0.65, weighted=weighted, alone=True)
        got = {r["item"]: r["grp"] for r in got.collect()}
        assert sum(got[i] == want[i] for i in bags) >= 0.99 * len(bags)


def test_a_failed_request_between_headings_of_other_stories():
    page = "Home\nMarkets\n429 Too Many Requests\nThe server could not complete the request.\nVaccines reach Nyakuatan and nine other towns; herders queue at the market\n"
    assert residue.judge(page).reason == "error"
    assert residue.judge("The council could not process the request of the growers in May, it said.\nIt will hear them again in June, the mayor told this paper.\nNo date was given by the office so far.").reason == ""
