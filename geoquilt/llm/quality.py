"""Quality rules on documents, and host verdicts from the failures of all documents of a host.

Each document is measured on its whole text and fails rules of its own. Failures are counted by host; a host's failure
rate of a rule is shrunk towards the rate of all hosts with a beta prior fitted to the hosts by moments, so a host with
few documents needs more evidence than one with many. A host is rejected where the beta distribution that a rule's failures
leave of its rate lies above a limit: the rate less SURE standard deviations exceeds ``times`` the rate of all hosts, or
``least`` where that is less, or ``most`` where it is more. The verdict is joined back to the host's documents.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has no words and fails for shortness, as an empty one does. Null hosts
form one host. Repeated rows count each. A rate that equals the limit isn't above it. Very long texts are measured whole,
in arrays of their words. An empty table gives an empty table; columns of the input that clash with added
ones are replaced. Only DataFrame functions are used; no row is shuffled but the counts by host.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import broadcast_if_small, materialize

# Fixed values
WORD_GAPS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

WINDOW = 5
#: Standard deviations below a rate that leave 5 in 100 of the normal distribution.
SURE = 1.645
RULES = ("short", "repetition", "symbols", "dup_lines")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def in_runs(items: Column, key: Callable[[Column], Column]) -> Column:
    """Of a sorted array, the items whose key equals that of a neighbour."""
    last = F.size(items) - 1
    return F.filter(
        items,
        lambda x, i: ((i > 0) & (key(F.get(items, i - 1)) == key(x))) | ((i < last) & (key(F.get(items, i + 1)) == key(x))),
    )


def repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more. Equal digests only propose windows; their words are then compared."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    digests = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get(at, i - 1))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda n, g: n + g)

    def exact(proposed: Column) -> Column:
        windows = F.sort_array(F.transform(proposed, lambda x: F.struct(F.slice(words, x["i"] + 1, WINDOW).alias("h"), x["i"].alias("i"))))
        return let(windows, lambda s: let(F.sort_array(F.transform(in_runs(s, lambda x: x["h"]), lambda x: x["i"])), covered))

    def several(hs: Column) -> Column:
        marked = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(marked, lambda s: let(in_runs(s, lambda x: x["h"]), exact))

    found = let(digests, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(several(hs)))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(found)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the MEASURES of each whole text."""
    t = F.coalesce(docs[text], F.lit(""))
    words = F.array_remove(F.split(F.translate(t, WORD_GAPS, " " * len(WORD_GAPS)), " "), "")
    by_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, WORD_GAPS, "")) > 0)
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    out = docs.select(
        *[docs[c] for c in docs.columns if c not in {*MEASURES, "_w", "_l"}],
        by_words.alias("_w"),
        by_lines.alias("_l"),
        F.length(F.translate(t, WORD_GAPS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    out = out.withColumns({"n_words": F.col("_w.n"), "n_repeat_words": F.col("_w.r"), "n_lines": F.col("_l.n"), "n_dup_lines": F.col("_l.d")})
    return out.drop("_w", "_l")


def failures() -> dict[str, Column]:
    """For each rule, whether a measured document fails it."""
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repetition": F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n,
        "symbols": F.lit(10) * F.col("n_symbols") > n,
        "dup_lines": F.lit(10) * F.col("n_dup_lines") > F.lit(3) * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, host: str, times: float, least: float, most: float) -> DataFrame:
    """(host, n_docs, for each rule its failures k_ and its shrunk rate, and host_failed): one row for each host."""
    counts = measured.groupBy(measured[host].alias("host")).agg(
        F.count(F.lit(1)).cast("double").alias("n_docs"), *[F.sum(bad.cast("double")).alias(f"k_{rule}") for rule, bad in failures().items()]
    )
    counts = materialize(counts, "host-counts")
    n = F.col("n_docs")
    sums = counts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("n"), *[F.sum(f"k_{r}").alias(f"k_{r}") for r in RULES], *[F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / n).alias(f"q_{r}") for r in RULES]).first()
    shrunk, failed = [], F.lit(False)
    for r in RULES:
        mean = sums[f"k_{r}"] / sums["n"] if sums["n"] else 0.0
        # spread between hosts: the weighted variance of their rates, without what chance alone gives
        spread = sums[f"q_{r}"] / sums["n"] - mean * mean - mean * (1 - mean) * sums["hosts"] / sums["n"] if sums["n"] else 0.0
        strength = min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1e6
        rate = (F.col(f"k_{r}") + F.lit(mean * strength)) / (n + F.lit(strength))
        shrunk.append(rate.alias(f"rate_{r}"))
        deviation = F.sqrt(rate * (F.lit(1.0) - rate) / (n + F.lit(strength + 1)))
        failed = failed | (rate - F.lit(SURE) * deviation > F.lit(min(most, max(least, times * mean))))
    return counts.select("host", "n_docs", *[f"k_{r}" for r in RULES], *shrunk, failed.alias("host_failed"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep: Sequence[str] | None = None, times: float = 3.0, least: float = 0.2, most: float = 0.5) -> DataFrame:
    """The ``keep`` columns (default: all), the MEASURES, base_failed, host_rate (the largest of a host's shrunk rates), host_failed and kept."""
    keep = list(docs.columns if keep is None else keep)
    keep = [c for c in keep if c not in {*MEASURES, "base_failed", "host_rate", "host_failed", "kept"}]
    measured = measure(docs, text).select(*keep, *MEASURES, F.col(host).alias("_host"))
    measured = materialize(measured, "measured")
    hosts = host_rates(measured, "_host", times, least, most)
    hosts = hosts.select(F.col("host").alias("_at"), F.greatest(*[f"rate_{r}" for r in RULES]).alias("host_rate"), "host_failed")
    joined = measured.join(broadcast_if_small(hosts, hosts.count()), F.col("_host").eqNullSafe(F.col("_at")), "left").drop("_at", "_host")
    bad = failures()
    return joined.withColumn("base_failed", bad["short"] | bad["repetition"]).withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
