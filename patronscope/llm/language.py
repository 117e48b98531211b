"""Language of web pages by Bayesian fusion of four kinds of evidence.

* text: naive Bayes over hashed character trigrams of the visible text, learned from labelled documents;
* declared markup language: how often pages of each language declare each value;
* address suffix: how often each language has each suffix (the last label of the host);
* host prior: shares of the languages at the host, smoothed toward those of the registered domain,
  which are smoothed toward the shares of all pages. The page's own vote is taken out.

The last three are grouped counts over all pages of the text's first verdicts. All counting and fusing
is done with joins and column expressions; a hot host is split by adaptive execution.

Learning takes a hash sample of about ``MAX_LABELED`` different labelled texts: a documented bound, dealt evenly over the languages.
A language with fewer texts than its part is taken whole, and the others get the rest. All pages are counted and judged.

Defined cases: a null or empty page has no text evidence, so the other evidence and the prior decide; a null or
odd address has the empty host; ties go to the language first in alphabetical order; an empty
table gives an empty result; repeated rows are judged one by one; without labelled documents there is
no language and the result is null; very long pages are judged whole, in time linear in their length; input columns pass through inside
``row``, so their names cannot clash.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType

from patronscope.llm.common import Shared, packed_rows, schema_with
from patronscope.session import settle

BUCKETS = 1 << 15
MAX_LABELED = 8_000
#: Digests are cut to so many values to draw a part of the texts.
DRAWS = 1 << 40
#: Trigrams of one text are strongly dependent; their evidence counts this share.
TEXT_WEIGHT = 0.3
#: Pages that the domain's shares are worth at a host, and those of all pages at a domain.
HOST_PAGES, DOMAIN_PAGES = 5.0, 20.0
#: Added to each count of declared values and suffixes.
SMOOTH = 1.0

OPENED = re.compile(r"(?i)<(?:(!--)|(script|style)\b)?")
CLOSED = {"!--": re.compile("-->"), "script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>")}
ROOT = re.compile(r"(?i)<html\b")
DECLARED = re.compile(r"(?i)\blang\s*=\s*[\"']?\s*([a-z]{2,})")
#: Three-letter codes of languages that have one of two letters. Fixed values of the standard.
THREE_LETTERS = {
    "ara": "ar", "bul": "bg", "cat": "ca", "ces": "cs", "cze": "cs", "dan": "da", "deu": "de", "ger": "de", "ell": "el", "gre": "el", "eng": "en",
    "spa": "es", "est": "et", "fas": "fa", "per": "fa", "fin": "fi", "fra": "fr", "fre": "fr", "heb": "he", "hin": "hi", "hrv": "hr", "hun": "hu",
    "ind": "id", "ita": "it", "jpn": "ja", "kor": "ko", "lit": "lt", "lav": "lv", "nld": "nl", "dut": "nl", "nor": "no", "pol": "pl", "por": "pt",
    "ron": "ro", "rum": "ro", "rus": "ru", "slk": "sk", "slo": "sk", "slv": "sl", "srp": "sr", "swe": "sv", "tha": "th", "tur": "tr", "ukr": "uk",
    "vie": "vi", "zho": "zh", "chi": "zh",
}
#: Second-level names under which country domains register names. Fixed values.
SECOND_LEVEL = {"ac", "co", "com", "edu", "gob", "gov", "gouv", "net", "or", "org"}
HOST = re.compile(r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # language x bucket, log probability


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character trigrams of the lower-case text, digits and marks as one space, with counts."""
    points = np.frombuffer((" " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA77) + points[2:]
    mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.unique((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, return_counts=True)


def sample_shares(sizes: dict[str, int], bound: int) -> dict[str, float]:
    """The part of each language's texts to take, so that about ``bound`` are taken and small languages whole."""
    shares, left = {}, float(bound)
    for rank, (name, size) in enumerate(sorted(sizes.items(), key=lambda x: x[1])):
        shares[name] = min(1.0, left / (len(sizes) - rank) / size)
        left -= shares[name] * size
    return shares


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", max_labeled: int = MAX_LABELED, held_out: Column | None = None) -> Model:
    """Learn the trigrams of each language; ``BUCKETS`` counts per language reach the driver."""
    known = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    known = known.select(F.lower(F.col(f"`{lang}`")).alias("lang"), F.col(f"`{text}`").alias("text"))
    digests = known.select("lang", F.xxhash64("text").alias("digest")).distinct()
    sizes = {r["lang"]: r["count"] for r in digests.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((0, BUCKETS)))
    limits = [F.lit(x) for name, share in sample_shares(sizes, max_labeled).items() for x in (name, math.ceil(share * DRAWS))]
    drawn = F.pmod(F.xxhash64("text"), F.lit(DRAWS)) < F.create_map(*limits)[F.col("lang")]
    sample = known.where(drawn).dropDuplicates(["lang", "text"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = trigram_counts(value)
                sums.setdefault(kind, np.zeros(BUCKETS, np.int64))[at] += n
        for kind, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "bucket", "n"])

    rows = sample.mapInArrow(tally, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.full((len(languages), BUCKETS), 0.5)
    for i, name in enumerate(languages):
        own = rows[rows["lang"] == name]
        counts[i, own["bucket"]] += own["n"]
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def text_scores(text: str, model: Model) -> np.ndarray:
    """Log likelihood per language, up to a constant, with the best at zero."""
    at, n = trigram_counts(text)
    scores = TEXT_WEIGHT * (model.scores[:, at] @ n) if len(at) else np.zeros(len(model.languages))
    return scores - scores.max(initial=-np.inf) if len(scores) else scores


def text_verdict(text: str, model: Model) -> tuple[np.ndarray, int | None]:
    """The scores of a text and its most likely language; None without evidence."""
    scores = text_scores(text, model)
    known = len(model.languages) == 1 and len(trigram_counts(text)[0])
    return scores, int(scores.argmax()) if scores.any() or known else None


def visible_text(page: str) -> str:
    """The text without tags, comments, scripts and styles. What is not closed is not searched for again, so the time
    is linear in the page."""
    out, at, missing = [], 0, set()
    while found := OPENED.search(page, at):
        kind, end = (found[1] or found[2] or "").lower(), None
        if kind and kind not in missing:
            end = CLOSED[kind].search(page, found.end())
            if not end:
                missing.add(kind)
        stop = end.end() if end else page.find(">", found.start()) + 1
        if not stop:  # no tag ends from here on
            break
        out.append(page[at : found.start()])
        at = stop
    return html.unescape(" ".join([*out, page[at:]]))


def declared_language(page: str) -> str:
    """The primary language code of the first root tag that declares one, or an empty text."""
    at = 0
    while root := ROOT.search(page, at):
        at = page.find(">", root.start()) + 1 or len(page)
        said = DECLARED.search(page, root.end(), at)
        if said:
            code = said[1].lower()
            return THREE_LETTERS.get(code, code)
    return ""


def address_parts(url: str | None) -> tuple[str, str, str]:
    """(host, registered domain, suffix) in lower case; empty if there is none."""
    found = HOST.match(url or "")
    host = found[1].lower().strip(".") if found else ""
    labels = host.split(".")
    size = 3 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL else 2
    return host, ".".join(labels[-size:]), labels[-1] if len(labels) > 1 else ""


def evidence(pages: DataFrame, model: Model, page: str = "html", url: str = "url") -> DataFrame:
    """(row, host, domain, suffix, declared, scores, vote) for every page; ``vote`` is null without text."""
    shared = Shared(pages.sparkSession, "language", model)
    rows = packed_rows(pages, page, url=F.col(f"`{url}`").cast("string"))
    names = ["host", "domain", "suffix", "declared"]
    schema = schema_with(
        rows.schema["row"].dataType, *[(n, StringType()) for n in names], ("scores", ArrayType(DoubleType())), ("vote", LongType())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = set(model.languages)
        for batch in batches:
            out = []
            for data, address in zip(batch.column("data").to_pylist(), batch.column("url").to_pylist(), strict=True):
                source = data.decode()
                declared = declared_language(source)
                declared = declared if declared in known or not declared else "other"
                scores, vote = text_verdict(visible_text(source), model)
                out.append((*address_parts(address), declared, scores.tolist(), vote))
            kinds = [pa.string()] * 4 + [pa.list_(pa.float64()), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=schema.names)

    return rows.mapInArrow(run, schema)


def _votes(found: DataFrame, key: str, size: int) -> DataFrame:
    """(key, <key>_votes): pages per language at each value of ``key``."""
    counts = [F.count(F.when(F.col("vote") == i, 1)).cast("double") for i in range(size)]
    return found.where("vote is not null").groupBy(key).agg(F.array(*counts).alias(f"{key}_votes"))


def identify(pages: DataFrame, model: Model, page: str = "html", url: str = "url") -> DataFrame:
    """(row, lang, probability, text_lang, declared) for every page."""
    size = len(model.languages)
    if not size:
        rows = packed_rows(pages, page).select("row")
        return rows.select("row", *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"))])
    found = settle(evidence(pages, model, page, url), "evidence")
    total = F.array(*[F.lit(float(x)) for x in found.agg(*[F.count(F.when(F.col("vote") == i, 1)) for i in range(size)]).first()])
    for key in ("declared", "suffix", "domain", "host"):
        found = found.join(_votes(found, key, size), key, "left")

    own = F.array(*[F.coalesce((F.col("vote") == i).cast("double"), F.lit(0.0)) for i in range(size)])
    zero = F.array(*[F.lit(0.0)] * size)

    def others(votes: Column) -> Column:
        """Votes without that of the page itself."""
        return F.zip_with(F.coalesce(votes, zero), own, lambda n, o: n - o)

    def summed(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def shares(votes: Column, weight: float, base: Column) -> Column:
        return F.zip_with(votes, base, lambda n, b: (n + F.lit(weight) * b) / (summed(votes) + F.lit(weight)))

    def likelihood(votes: Column, everyone: Column) -> Column:
        """Log share of the pages of each language that have this value."""
        return F.zip_with(votes, everyone, lambda n, t: F.log((n + F.lit(SMOOTH)) / (t + F.lit(SMOOTH * (size + 2)))))

    found = found.select("*", others(total).alias("_all")).select(
        "*", F.transform(F.col("_all"), lambda n: (n + F.lit(SMOOTH)) / (summed(F.col("_all")) + F.lit(SMOOTH * size))).alias("_base"),
        *[others(F.col(f"{k}_votes")).alias(f"_{k}") for k in ("declared", "suffix", "domain", "host")],
    )
    found = found.select("*", shares(F.col("_domain"), DOMAIN_PAGES, F.col("_base")).alias("_domain_share"))
    prior = F.transform(shares(F.col("_host"), HOST_PAGES, F.col("_domain_share")), lambda x: F.log(x))
    parts = [F.col("scores"), prior, likelihood(F.col("_declared"), F.col("_all")), likelihood(F.col("_suffix"), F.col("_all"))]
    fused = parts[0]
    for more in parts[1:]:
        fused = F.zip_with(fused, more, lambda a, b: a + b)
    names = F.array(*map(F.lit, model.languages))
    fused = found.select("row", "declared", "vote", fused.alias("_logs"))
    best = F.array_max("_logs")
    return fused.select(
        "row", F.get(names, (F.array_position("_logs", best) - 1).cast("int")).alias("lang"),
        (1 / summed(F.transform(F.col("_logs"), lambda x: F.exp(x - best)))).alias("probability"),
        F.get(names, F.col("vote").cast("int")).alias("text_lang"), "declared",
    )
