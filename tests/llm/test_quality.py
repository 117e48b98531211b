from collections import Counter

from llm.conftest import same_rows

from patronscope.llm.quality import beta_prior, quality_rules, strict_bound


def brute(text):
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered, lines, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in lines
            lines.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_counts(small, odd, empty):
    docs = small.unionByName(odd)
    found = quality_rules(docs)
    got = found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same_rows(got, [(r["doc_id"], *brute(r["text"])) for r in docs.collect()])
    assert found.where("kept and base_failed").count() == 0
    assert found.select("row.*").columns == docs.columns
    assert quality_rules(empty).count() == 0


def test_strict_hosts(spark):
    """Strong violations go anywhere, mild ones only at a host that stands out, clean documents stay everywhere."""
    good = " ".join(f"word{i}" for i in range(40))
    mild, strong = " ######", " ####### %%%%%%%"
    rows = [(i, good + (mild if i % 10 else "") + f" {i}", "bad") for i in range(200)]
    rows += [(1000 + i, good + (mild if i == 0 else strong if i < 5 else "") + f" {i}", "fine") for i in range(200)]
    rows += [(2000, good + mild, None), (2001, good + strong, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality_rules(docs).where("kept").select("row.doc_id").collect()}
    assert kept == {i for i in range(200) if i % 10 == 0} | {1000} | {1000 + i for i in range(5, 200)} | {2000}


def test_junk_of_the_given_documents_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_rules(docs, keep_text=False).select("row.doc_id", "kept", "base_failed").join(labels, "doc_id").collect()
    good, bad = ([r for r in found if r["quality"] == q] for q in (1, 0))
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.02 * len(bad) < sum(not r["base_failed"] for r in bad)


def test_prior():
    assert beta_prior(0, None, None, None) == (0.0, 1.0)
    assert beta_prior(3, 10, 0, 0.0) == (0.0, 1.0)
    a, b = beta_prior(2, 200, 100, 90 * 90 / 100 + 10 * 10 / 100)
    assert a == b and a + b >= 1
    assert strict_bound(1.0, 1.0) == 0.5 + (0.25 / 3) ** 0.5 and strict_bound(0.0, 1.0) == 0.0
