"""Language, toxicity and decontamination against plain versions, and their accuracy on held-out rows."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from llm.conftest import DATA
from pyspark.sql import functions as F

from patronscope.llm import language, toxicity
from patronscope.llm.decontaminate import GAP, MATCH, MISMATCH, WORD, contaminated

PAGES = [
    (1, "https://a.example.de/x", "<html lang='de'><body>Das ist ein kurzer Text</body></html>"),
    (2, "https://a.example.de/y", "<html LANG=de-AT><p>Noch ein Text &uuml;ber das Wetter</p>"),
    (2, "https://a.example.de/y", "<html LANG=de-AT><p>Noch ein Text &uuml;ber das Wetter</p>"),
    (3, None, None), (4, "", ""), (5, "no address", "<script>x = 1</script>"), (None, "http://b.example.com", "the weather and the text"),
    (6, "//b.example.com:80/?q", "<html lang=xx>the weather is fine"), (7, "http://user@B.example.com./", "word " * 30_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    more = spark.createDataFrame([(*p, "mine", "mine") for p in PAGES], "page_id long, url string, html string, host string, vote string")
    return spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html").unionByName(more, allowMissingColumns=True)


@pytest.fixture(scope="module")
def language_model(spark):
    return language.fit(spark.read.parquet(f"{DATA}/documents.parquet"))


def test_language_is_the_fusion_of_all_evidence(spark, pages, language_model):
    names = language_model.languages
    size = len(names)
    parts = [r.asDict(recursive=True) for r in language.evidence(pages, language_model).collect()]
    votes, total = defaultdict(lambda: np.zeros(size)), np.zeros(size)
    for r in parts:
        if r["vote"] is not None:
            total[r["vote"]] += 1
            for key in ("declared", "suffix", "domain", "host"):
                votes[key, r[key]][r["vote"]] += 1
    want = []
    for r in parts:
        own = np.zeros(size)
        if r["vote"] is not None:
            own[r["vote"]] = 1
        rest = {k: votes[k, r[k]] - own if (k, r[k]) in votes else np.zeros(size) for k in ("declared", "suffix", "domain", "host")}
        everyone = total - own
        base = (everyone + language.SMOOTH) / (everyone.sum() + language.SMOOTH * size)
        domain = (rest["domain"] + language.DOMAIN_PAGES * base) / (rest["domain"].sum() + language.DOMAIN_PAGES)
        host = (rest["host"] + language.HOST_PAGES * domain) / (rest["host"].sum() + language.HOST_PAGES)
        logs = np.array(r["scores"]) + np.log(host)
        for key in ("declared", "suffix"):
            logs += np.log((rest[key] + language.SMOOTH) / (everyone + language.SMOOTH * (size + 2)))
        chance = np.exp(logs - logs.max())
        want.append((str(r["row"]["page_id"]), r["row"]["url"] or "", names[int(logs.argmax())], round(float(1 / chance.sum()), 9)))
    found = language.identify(pages, language_model)
    got = [(str(r["page_id"]), r["url"] or "", r["lang"], round(r["probability"], 9)) for r in found.select("row.page_id", "row.url", "lang", "probability").collect()]
    assert sorted(got) == sorted(want)
    assert found.select("row.*").columns == ["page_id", "url", "host", "vote"]


def test_language_without_rows_or_labels(spark, pages, empty, language_model):
    assert language.identify(pages.where("false"), language_model).count() == 0
    unknown = language.fit(empty)
    assert unknown.languages == []
    rows = language.identify(pages, unknown).collect()
    assert len(rows) == pages.count() and all(r["lang"] is None and r["probability"] is None for r in rows)


def test_pages_without_text(spark):
    labels = spark.createDataFrame([("es", "hola mundo y todos"), ("en", "hello world and all")], "lang string, text string")
    pages = spark.createDataFrame([(1, "http://a.es", "<p>hello world"), (2, "http://a.es", None)], "page_id long, url string, html string")
    found = {r["row"]["page_id"]: r for r in language.identify(pages, language.fit(labels)).collect()}
    assert found[1]["text_lang"] == "en" and found[2]["text_lang"] is None and found[2]["lang"] in ("en", "es")
    alone = language.identify(pages, language.fit(labels.where("lang = 'en'"))).collect()
    assert {r["row"]["page_id"]: r["text_lang"] for r in alone} == {1: "en", 2: None}


def test_marks_of_a_page():
    assert language.visible_text("a<b>c</b> <!-- x > y -->d<script>1 < 2</SCRIPT >e<style>f") == "a c   d e f"
    assert language.visible_text("x <!-- y <p>z < end") == "x  z < end"
    assert language.visible_text("no marks &amp; < more") == "no marks & < more"
    for mark in ("<script ", "<!--", "<", "<html "):  # linear also where nothing is closed
        assert len(language.visible_text(mark * 200_000)) > 0 and language.declared_language(mark * 200_000) == ""
    for page, code in [("<html lang=est>", "et"), ("<HTML  class=x LANG = 'de-AT'>", "de"), ("<html lang=fil>", "fil"), ("<html><p lang=en>", ""),
                       ("<html dir=ltr><html lang=fr>", "fr"), ("<html lang=spa", "es")]:
        assert language.declared_language(page) == code
    assert language.address_parts("http://news.bbc.co.uk/x") == ("news.bbc.co.uk", "bbc.co.uk", "uk")
    assert language.address_parts("http://www.shop.de") == ("www.shop.de", "shop.de", "de") and language.address_parts("http://co.uk")[1] == "co.uk"


def test_item_ids_keep_their_type(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    for kind, value in (("double", 1.5), ("string", "x"), ("int", 3)):
        items = spark.createDataFrame([(value, "one two three four five six seven eight nine ten")], f"item_id {kind}, text string")
        found = contaminated(docs, items)
        assert dict(found.dtypes)["item"] == kind and [r["item"] for r in found.collect()] == [value]


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and n_chars >= 100")
    model = language.fit(docs, held_out=toxicity.fold(F.col("doc_id")) == 0)
    rows = docs.where(toxicity.fold(F.col("doc_id")) == 0).select("lang", "text").collect()
    right = sum(model.languages[int(language.text_scores(r["text"], model).argmax())] == r["lang"] for r in rows)
    assert len(rows) > 100 and right >= 0.9 * len(rows)


def test_language_sample_of_copies_and_rare_languages(spark):
    often = [("en", f"the text number {i} of many") for i in range(900)]
    rare = [("fi", f"harvinainen kieli {i}") for i in range(5)]
    hot = [("en", "one text that is there very often")] * 500
    plain = spark.createDataFrame(often + rare + hot[:1], "lang string, text string")
    copies = spark.createDataFrame(often + rare + hot, "lang string, text string").repartition(3)
    want, got = language.fit(plain, max_labeled=60), language.fit(copies, max_labeled=60)
    assert got.languages == ["en", "fi"] and (got.scores == want.scores).all()
    at, n = language.trigram_counts("harvinainen kieli")
    whole = language.fit(spark.createDataFrame(rare, "lang string, text string"))
    assert (got.scores[1] == whole.scores[0]).all() and len(at)
    assert language.sample_shares({"a": 5, "b": 100, "c": 1000}, 65) == {"a": 1.0, "b": 0.3, "c": 0.03}


def brute_segments(scores, offset=0):
    """The segment of largest sum, the shortest of equals, then the same left and right of it."""
    best = max(((sum(scores[i:j]), i - j, -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    start = -best[2]
    end = start - best[1]
    return [*brute_segments(scores[:start], offset), (offset + start, offset + end, best[0]), *brute_segments(scores[end:], offset + end)]


def test_maximal_segments():
    chance = random.Random(3)
    for _ in range(200):
        scores = [chance.uniform(-3, 2.5) for _ in range(chance.randint(0, 25))]
        got, want = toxicity.maximal_segments(np.array(scores)), brute_segments(scores)
        assert [(s, e) for s, e, _ in got] == [(s, e) for s, e, _ in want]
        assert [x for *_, x in got] == pytest.approx([x for *_, x in want])


def label_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_scores(spark, small, odd, empty):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    model = toxicity.fit(small, labels.unionByName(label_frame(spark, [(None, 0, 1), (7, 0, None), (8, 0, 5)]).select("doc_id", "toxic")))
    docs = small.unionByName(odd).withColumn("score", F.lit("mine"))
    found = toxicity.score(docs, model)
    assert found.select("row.*").columns == [c for c in docs.columns if c != "text"]
    prior = math.log(model.share / (1 - model.share))
    want = []
    for r in docs.collect():
        words = [w for w in WORD.findall((r["text"] or "").lower())]
        scores = []
        for w in words:
            clean, toxic = model.tokens.get(w, (0, 0))
            share = model.stems.get(w[: toxicity.STEM], model.share)
            odds = math.log((toxic + toxicity.TOKEN_PRIOR * share) / (clean + toxicity.TOKEN_PRIOR * (1 - share)))
            scores.append(odds - prior - toxicity.DRIFT)
        size = math.log(model.constant * max(len(words), 1))
        tops = sorted((model.decay * x - size for *_, x in toxicity.maximal_segments(np.array(scores))), reverse=True) or [-size]
        chances = [tops[0]]
        for k in range(2, 1 + sum(x > 0 for x in tops)):
            total = sum(tops[:k])
            chances.append(total - math.log((2 * total) ** (k - 1) / (math.factorial(k) * math.factorial(k - 1))))
        x = max(chances)
        want.append((str(r["doc_id"]), round(1 / (1 + math.exp(-model.intercept - model.slope * x)), 6)))
    got = [(str(r[0]), round(r[1], 6)) for r in found.select("row.doc_id", "score").collect()]
    assert sorted(got) == sorted(want)
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_passages(spark, small):
    model = toxicity.fit(small, spark.read.parquet(f"{DATA}/labels.parquet"))
    model = model._replace(constant=1e-3)  # so that short passages are significant
    got = {r[0]: [tuple(p) for p in r[1]] for r in toxicity.score(small, model).select("row.doc_id", "passages").collect()}
    scores = toxicity.Scores(model)
    want = {r["doc_id"]: toxicity.passages(scores.of(r["text"]), model)[0] for r in small.collect()}
    assert got == want and any(want.values())
    assert all(0 <= start < end and score > 0 for found in got.values() for start, end, score in found)


@pytest.mark.parametrize("rows", [[], [(i, 0, 0) for i in range(40)], [(i, 0, 1) for i in range(40)]])
def test_toxicity_without_both_classes(spark, small, rows):
    model = toxicity.fit(small, label_frame(spark, rows))
    scores = {r[0] for r in toxicity.score(small, model).select("score").collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).select("row.doc_id", "score").join(labels.select("doc_id", "toxic"), "doc_id")
    rows = found.where(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT).collect()
    hits = sum(r["toxic"] == 1 and r["score"] >= 0.5 for r in rows)
    alarms = sum(r["toxic"] == 0 and r["score"] >= 0.5 for r in rows)
    toxic = sum(r["toxic"] == 1 for r in rows)
    assert toxic >= 20 and hits >= 0.8 * toxic and alarms <= 0.02 * len(rows), (toxic, hits, alarms, len(rows))


def brute_align(item, text):
    """Smith-Waterman score, cell by cell."""
    row, best = [0] * (len(text) + 1), 0
    for w in item:
        new = [0]
        for j, v in enumerate(text, 1):
            new.append(max(0, row[j - 1] + (MATCH if v == w else MISMATCH), row[j] + GAP, new[-1] + GAP))
        row = new
        best = max(best, max(row))
    return best / (MATCH * len(item)) if item else 0.0


def common_run(item, text):
    best, row = 0, [0] * (len(text) + 1)
    for w in item:
        row = [0, *[row[j] + 1 if v == w else 0 for j, v in enumerate(text)]]
        best = max(best, *row)
    return best


@pytest.mark.parametrize("block_bytes", [8_000_000, 400])
def test_decontamination(spark, odd, empty, block_bytes):
    chance = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(12, 40)))) for i in range(14)]
    items += [(20, items[0][1]), (21, "Tiny item"), (22, None), (23, ""), (None, "an item without any number at all")]
    rows = []
    for i in range(60):
        words = chance.choices(vocabulary, k=chance.randint(0, 120))
        if i % 2:
            copy = items[chance.randrange(14)][1].split()
            for _ in range(i % 9):
                at = chance.randrange(len(copy))
                copy[at : at + 1] = chance.choice([[], ["other"], [copy[at], "more"]])
            words[len(words) // 2 : len(words) // 2] = copy
        rows.append((i, " ".join(words).upper() if i % 3 else " ".join(words)))
    rows += [(70, "x tiny, item. y"), (71, items[3][1]), (71, items[3][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd.select("doc_id", "text")).withColumn("hits", F.lit(-1))
    got = {(str(r["id"]), str(r["item"])): r["score"] for r in contaminated(docs, benchmark, block_bytes=block_bytes).collect()}
    want, sure = {}, set()
    for r in docs.collect():
        text = WORD.findall((r["text"] or "").lower())
        if len(text) > 1000:
            continue
        for i, t in items:
            item = WORD.findall((t or "").lower())
            score = brute_align(item, text)
            if score >= 0.5:
                want[str(r["doc_id"]), str(i)] = score
                if common_run(item, text) >= min(8, len(item)):
                    sure.add((str(r["doc_id"]), str(i)))
    assert len(sure) >= 20 and sure <= set(got) <= set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    marked = contaminated(docs, benchmark, block_bytes=block_bytes, mark=True)
    assert marked.select("row.*").columns == docs.columns and marked.count() == docs.count()
    assert {r[0] for r in marked.where("hits > 0").select(F.col("row.doc_id").cast("string")).collect()} == {d for d, _ in got}
    assert contaminated(empty, benchmark).count() == 0 and contaminated(docs, benchmark.where("false")).count() == 0


def edited(copy, chance, kinds, edits):
    for at in sorted(chance.sample(range(len(copy)), edits), reverse=True):
        kind = chance.choice(kinds)
        copy[at : at + 1] = {"drop": [], "replace": ["other"], "insert": [copy[at], "more"]}[kind]
    return copy


@pytest.mark.parametrize("min_score", [0.5, 0.7])
def test_decontamination_finds_every_pair(spark, min_score):
    chance = random.Random(4)
    vocabulary = [f"w{i}" for i in range(150)]
    items = [(i, chance.choices(vocabulary, k=k)) for i, k in enumerate([1, 2, 3, 5, 8, 15, 15, 20, 31, 40])]
    items.append((10, "the same the same the same the other".split()))
    one = list(items[5][1])
    one[7] = "other"
    spread = [w for word in items[9][1] for w in (word, "more")]
    rows = [(0, one), (1, spread), (2, [w for i, w in enumerate(items[7][1]) for w in ([w, "x"] if i % 2 else [w])]), (3, ["the", "same"] * 9)]
    for i in range(4, 160):
        item = chance.choice(items)[1]
        copy = edited(list(item), chance, chance.choice([["drop"], ["replace"], ["insert"], ["drop", "replace", "insert"]]), chance.randint(0, len(item)))
        rows.append((i, chance.choices(vocabulary, k=chance.randint(0, 40)) + copy + chance.choices(vocabulary, k=chance.randint(0, 40))))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    found = contaminated(docs, benchmark, min_score=min_score).collect()
    scores = {(d, i): brute_align(item, text) for d, text in rows for i, item in items}
    want = {k: pytest.approx(x) for k, x in scores.items() if x >= min_score}
    assert {(r["id"], r["item"]): r["score"] for r in found} == want and (0, 5) in want
