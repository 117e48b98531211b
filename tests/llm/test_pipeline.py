"""The whole pipeline against plain versions of its stages."""

import hashlib
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import tiktoken
from llm.conftest import DATA, SCHEMA, same_rows
from llm.test_judged import brute_align
from llm.test_quality import brute
from llm.test_simhash import brute_fingerprint, brute_groups

from patronscope.llm.bpe import read_ranks
from patronscope.llm.decontaminate import WORD
from patronscope.llm.quality import MAX_DUP_LINES, MAX_SYMBOLS_PER_WORD, STRONG, WORD_LENGTH, beta_prior, quality_rules, strict_bound


def brute_quality(rows):
    judged = []
    for r in rows:
        words, chars, symbols, dup, _, failed = brute(r["text"])
        lines = sum(bool(line.strip(" \t\n\x0b\x0c\r")) for line in (r["text"] or "").split("\n"))
        mild, strong = (
            symbols > t * MAX_SYMBOLS_PER_WORD * words or dup > t * MAX_DUP_LINES * lines
            or not WORD_LENGTH[0] / t * words <= chars <= WORD_LENGTH[1] * t * words for t in (1, STRONG)
        )
        judged.append((r, failed or strong, failed or mild))
    known = [(r["source"], bad) for r, _, bad in judged if r["source"] is not None]
    total, failures = Counter(s for s, _ in known), Counter(s for s, bad in known if bad)
    a, b = beta_prior(len(total), len(known), sum(failures.values()), sum(failures[s] ** 2 / total[s] for s in total))
    strict = {s for s in total if (failures[s] + a) / (total[s] + a + b) > strict_bound(a, b)}
    return [r for r, failed, bad in judged if not failed and not (r["source"] in strict and bad)]


def brute_copies(rows):
    prints = [(r, brute_fingerprint(r["text"])) for r in rows]
    first = {}
    for r, p in prints:
        first[p] = min(first.get(p, r["doc_id"]), r["doc_id"])
    groups = brute_groups(first)
    return list({r["doc_id"]: r for r, p in prints if groups[p] == r["doc_id"]}.values())


def brute_cut(rows, length=50):
    first = {}
    data = [(r, r["text"].encode()) for r in rows]
    for r, d in data:
        for p in range(len(d) - length + 1):
            w = d[p : p + length]
            first[w] = min(first.get(w, r["doc_id"]), r["doc_id"])
    for r, d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if first[d[p : p + length]] < r["doc_id"]:
                gone[p : p + length] = b"\x01" * length
        text = bytes(b for b, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore")
        yield {**r, "text": text, "n_chars": len(text)}


def leaks(text, items):
    words = WORD.findall(text.lower())
    known = set(words)
    # a pair of which too few words are shared cannot reach the score
    return any(2 * sum(w in known for w in item) >= len(item) and brute_align(item, words) >= 0.5 for item in items if item)


def test_pipeline(spark, odd, small, folder):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    texts = [r["text"] for r in items.orderBy("item_id").collect()]
    shared = " ".join(f"passage{i}" for i in range(60))
    long = " ".join(f"word{i} é" if i % 50 else f"line{i}\n" for i in range(9000))
    planted = [(20_001, f"Some own words come first here. {texts[0]} And a few more.", "en", "planted", None), (20_002, texts[1].lower(), None, None, 5),
               (20_003, shared + " one end of it, unlike the other", "en", "planted", 1), (20_004, "Another begin, then the same: " + shared, "en", "planted", 1),
               (20_005, long, "en", "planted", 1), (20_006, long, "fr", "elsewhere", 2), (20_007, long + " last", "fr", None, 2)]
    docs = small.where("doc_id < 110").unionByName(odd).unionByName(spark.createDataFrame(planted, SCHEMA))
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]

    good = brute_quality(rows)
    kept = brute_copies(good)
    item_words = [WORD.findall(t.lower()) for t in texts]
    clean = [r for r in brute_cut(kept) if not leaks(r["text"], item_words)]
    assert len(rows) > len(good) > len(kept) > len(clean) > 40
    assert not {20_001, 20_002, 20_006, 20_007} & {r["doc_id"] for r in clean}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(Path(P.path("byte_bpe_multi_50k.tiktoken")).read_bytes()), special_tokens={})
    want = []
    for r in clean:
        ids = np.array(encoding.encode_ordinary(r["text"]), "<u4").tobytes()
        want.append((r["doc_id"], r["lang"], r["source"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    pending = quality_rules(docs, keep_text=False)
    got = corpus_pipeline.run(spark, folder)
    assert pending.count() == len(rows)  # the run frees its own tables only
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    same_rows(got.drop("ids").collect(), want)


def test_stages_keep_the_columns(spark, odd, empty, folder):
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, folder)
            assert found.columns == docs.columns and found.count() <= docs.count()
    assert corpus_pipeline.tokenize(spark, empty, folder).count() == 0
    rows = corpus_pipeline.tokenize(spark, odd, folder).collect()
    assert len(rows) == odd.count()


def test_executors_need_no_copy_of_the_package(folder):
    """Started in an empty folder, with the package on the path of the driver alone."""
    names = ["op7_language", "op8_decontamination", "op9_toxicity", "op11_packing", "op12_whitening", "op13_alignment"]
    code = f"""
import sys
sys.path.insert(0, {str(Path(corpus_pipeline.__file__).parent)!r})
from patronscope.llm.queries import QUERIES
from patronscope.session import build_session
spark = build_session("alone", "local[4]", spark__sql__shuffle__partitions="4", spark__checkpoint__dir={folder!r})
for name in {names}:
    QUERIES[name](spark, {DATA!r}).write.format("noop").mode("overwrite").save()
    print("done", name)
"""
    clean = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    ran = subprocess.run([sys.executable, "-c", code], cwd=folder, env=clean, capture_output=True, text=True, timeout=600)
    assert [line for line in ran.stdout.splitlines() if line.startswith("done")] == [f"done {n}" for n in names], ran.stderr[-2000:]
