"""Quality rules per document, judged together with the failure rate of the document's host.

Document rules are column expressions. Failures are counted by host, the rates are shrunk
with a beta prior fitted to all hosts, and the verdicts are joined back. A document that fails the base rules, or breaks a
further rule by more than ``STRONG`` times its bound, is rejected anywhere. One that breaks a further rule mildly is rejected at
strict hosts, whose shrunk rate is more than a standard deviation of the prior above its mean.

Defined cases: a null text has no words; a document without words fails the base rules; a null
host forms no group and is not strict; repeated rows are judged one by one; very long texts are judged whole; an empty table gives an
empty result. Input columns stay inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import WHITE, let, words_of
from patronscope.session import settle

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Further rules: symbols per word, share of repeated lines, mean length of words.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES = 0.3
WORD_LENGTH = (2.0, 15.0)
#: A further rule is broken strongly beyond so many times its bound; the shortest mean length counts inversely.
STRONG = 2.0

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more; windows compare by 64-bit hash."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(found: Column) -> Column:
        gaps = F.transform(found, lambda p, i: F.least(F.get(found, i + 1) - p, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)

    def repeated(sorted_: Column) -> Column:
        kept = F.filter(
            sorted_,
            lambda e, i: F.coalesce(F.get(sorted_, i - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(sorted_, i + 1)["h"] == e["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(kept, lambda e: e["p"])), covered)

    def counted(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(placed), repeated)
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, counted))


def text_stats(text: Column) -> Column:
    """The counts of one text as a struct of longs."""

    def bare(t: Column) -> Column:
        return F.translate(t, WHITE, "")

    def lines(t: Column) -> Column:
        full = F.filter(F.split(t, "\n"), lambda line: bare(line) != "")
        return let(full, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))

    def of(t: Column) -> Column:
        return let(
            F.struct(words_of(t).alias("w"), lines(t).alias("l")),
            lambda s: F.struct(
                F.size(s["w"]).cast("long").alias("n_words"),
                F.char_length(bare(t)).cast("long").alias("word_chars"),
                (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                s["l"]["n"].cast("long").alias("n_lines"),
                s["l"]["dup"].cast("long").alias("n_dup_lines"),
                let(s["w"], _repeat_words).alias("n_repeat_words"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def base_failures() -> Column:
    """The base rules over the columns of ``STATS``."""
    words = F.col("n_words")
    return (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)


def further_failures(times: float = 1.0) -> Column:
    """The further rules, with their bounds taken so many times."""
    words = F.col("n_words")
    return (
        (F.col("n_symbols") > times * MAX_SYMBOLS_PER_WORD * words)
        | (F.col("n_dup_lines") > times * MAX_DUP_LINES * F.col("n_lines"))
        | ~F.col("word_chars").between(WORD_LENGTH[0] / times * words, WORD_LENGTH[1] * times * words)
    )


def measure(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True) -> DataFrame:
    """(row, host, the counts, base_failed, any_failed, strong) for every document.

    The counts come out of ``explode``, so that a filter on them is not pushed below and computes them again.
    """
    kept = [docs[f"`{c}`"] for c in docs.columns if keep_text or c != text]
    stats = docs.select(F.struct(*kept).alias("row"), docs[f"`{host}`"].alias("host"), F.explode(F.array(text_stats(docs[f"`{text}`"]))).alias("stats"))
    base = base_failures()
    return stats.select("row", "host", "stats.*").withColumns({
        "base_failed": base, "any_failed": base | further_failures(), "strong": base | further_failures(STRONG),
    })


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, docs, failed, rate, strict): failure rates shrunk toward the mean of all hosts.

    The prior Beta(a, b) has the mean failure rate of all documents and the variance between
    hosts that sampling does not explain. The counts are written, so that ``measured`` is read once; one row of sums goes to the driver.
    """
    hosts = settle(measured.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("any_failed").cast("long")).alias("failed")
    ), "hosts")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("docs").alias("docs"), F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("squares"),
    ).first()
    a, b = beta_prior(sums["hosts"], sums["docs"], sums["failed"], sums["squares"])
    rate = (F.col("failed") + F.lit(a)) / (F.col("docs") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn("strict", F.col("rate") > F.lit(strict_bound(a, b)))


def strict_bound(a: float, b: float) -> float:
    """Mean and one standard deviation of Beta(a, b)."""
    mean = a / (a + b)
    return mean + math.sqrt(mean * (1 - mean) / (a + b + 1))


def beta_prior(hosts: int, docs: int | None, failed: int | None, squares: float | None) -> tuple[float, float]:
    """Moments of the host rates, weighted by documents; ``squares`` is the sum of failed² / docs."""
    if not docs or not 0 < failed < docs:
        share = (failed or 0) / docs if docs else 0.0
        return share, 1.0 - share
    mean = failed / docs
    spread = mean * (1 - mean)
    between = squares / docs - mean * mean - spread * hosts / docs
    strength = max(spread / between - 1, 1.0) if between > spread * 1e-6 else 1e6
    return mean * strength, (1 - mean) * strength


def apply_hosts(measured: DataFrame, rates: DataFrame) -> DataFrame:
    """``measured`` with ``host_rate`` and ``kept``. Adaptive execution splits a hot host in the join."""
    strict = F.coalesce(F.col("strict"), F.lit(False))
    return measured.join(rates.select("host", F.col("rate").alias("host_rate"), "strict"), "host", "left").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("strong") & ~(strict & F.col("any_failed"))
    ).drop("strict")


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True) -> DataFrame:
    """(host, row, counts, base_failed, any_failed, strong, host_rate, kept) for every document.

    ``row`` holds the input columns, the text only with ``keep_text``. Without texts the counts are written
    once to the shared folder; with texts they are computed again for the verdicts, as
    that takes less than another copy of the texts.
    """
    measured = measure(docs, text, host, keep_text)
    if not keep_text:
        measured = settle(measured, "quality")
    return apply_hosts(measured, host_rates(measured))
