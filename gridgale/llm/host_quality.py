"""Quality rules with verdicts on hosts, with column functions only.

Each document is measured and held against rules. Failures of each rule, and of any
rule, are counted by host, and a host's rates of failing are shrunk towards those of all
hosts by beta priors that the hosts themselves give. Documents fail by themselves or with their host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.llm.common import SPACES, let, words, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words
MIN_WORDS = 20
RULES = ("short", "repeats", "symbols", "repeated_lines")
ANY = "any_rule"
HOST_RATE = 0.8


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of `window` words that occurs twice or more in the text.

    Runs are compared by 64-bit hashes. Only a text with a repeated run is sorted.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(h: Column) -> Column:
        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), in_order)

    def in_order(runs: Column) -> Column:
        n = F.size(runs)
        again = F.filter(
            runs,
            lambda x, k: (F.get(runs, k - 1)["h"] == x["h"]) | ((k + 1 < n) & (F.get(runs, k + 1)["h"] == x["h"])),
        )
        return let(F.array_sort(F.transform(again, lambda x: x["i"])), total)

    def total(starts: Column) -> Column:
        n = F.size(starts)
        parts = F.transform(
            starts, lambda p, k: F.when(k + 1 < n, F.least(F.get(starts, k + 1) - p, F.lit(window))).otherwise(window)
        )
        return F.aggregate(parts, F.lit(0).cast("long"), lambda a, b: a + b)

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))

    return let(
        word_list,
        lambda w: F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(let(hashes(w), counted)),
    )


def measures(text: Column) -> dict[str, Column]:
    """The base counts of a text; of null, zeros."""
    given = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(given, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(given, SPACES, "")).cast("long"),
        "n_symbols": (F.length(given) - F.length(F.translate(given, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_lines": F.size(lines).cast("long"),
    }


def rules() -> dict[str, Column]:
    """Which rules a document fails."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > 30 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def beta_prior(hosts: DataFrame, rule: str) -> tuple[float, float]:
    """Prior failures and passes, by the moments of the hosts' rates.

    The mean is that of all documents. The spread is that of the rates about it, less
    what chance alone gives hosts of that size; with no spread left the prior is as
    strong as all documents together, with full spread it is one document.
    """
    n, f = F.col("n"), F.col(rule)
    mean = hosts.agg((F.sum(f) / F.sum(n)).alias("m"), F.sum(n).alias("n")).first()
    if mean is None or mean["n"] is None:
        return 0.5, 0.5
    m, docs = float(mean["m"]), float(mean["n"])
    if m in (0.0, 1.0):
        return m * docs, (1 - m) * docs
    spread = hosts.agg(
        F.sum(n * (f / n - m) * (f / n - m)).alias("s"), F.count("*").alias("k"), (F.sum(n * n) / F.sum(n)).alias("q")
    ).first()
    room = docs - float(spread["q"])
    between = (float(spread["s"]) - (spread["k"] - 1) * m * (1 - m)) / room if room > 0 else 0.0
    strength = docs if between <= 0 else min(docs, max(1.0, m * (1 - m) / between - 1))
    return m * strength, (1 - m) * strength


def judge_documents(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", host: str = "source", host_rate: float = HOST_RATE
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with the base counts, the rules failed,
    `base_failed`, `host_failed`, the host's highest shrunken rate `host_rate`, and `kept`. The
    rates are those of failing each rule and of failing any of them.

    A document fails by itself when it is short or repeats itself; it fails with its host
    when the host's highest rate is over `host_rate`, also when its failures are of several rules. A null or empty
    text has no words and fails as short. Null is a host of its own. Repeated rows count
    each. An empty table stays empty. The measured rows are written once, without
    texts unless carried, and hosts are counted from there; a host may hold any share of
    the rows, since counts are combined before they are shuffled.
    """
    body = F.col(f"`{text}`")
    spread = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"),
        F.col(f"`{host}`").cast("string").alias("host"), body.alias("_text"), words(body).alias("_words"),
    )
    counted = spread.select("row", "host", *[c.alias(name) for name, c in measures(F.col("_text")).items()])
    measured = written(counted.withColumns(rules()), "quality-measured")
    hosts = measured.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES],
        F.sum(F.greatest(*RULES).cast("long")).alias(ANY),
    )
    hosts = written(hosts, "quality-hosts")
    rates = []
    for rule in (*RULES, ANY):
        a, b = beta_prior(hosts, rule)
        rates.append((F.col(rule) + F.lit(a)) / (F.col("n") + F.lit(a + b)))
    verdicts = hosts.select(F.col("host").alias("_host"), F.greatest(*rates).alias("host_rate"))
    judged = measured.join(verdicts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    failed = F.col("short") | F.col("repeats")
    return judged.withColumns({
        "base_failed": failed,
        "host_failed": F.col("host_rate") > host_rate,
        "kept": ~failed & (F.col("host_rate") <= host_rate),
    }).drop("host")
