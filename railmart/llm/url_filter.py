"""URL filters: rules by host and path prefix, and for the rest a logistic regression on hashed character n-grams of host and path.

The model is trained here, from a small table of labelled URLs (`examples`, or any of at most MOST_LABELLED rows); a heavier class is
balanced by weights. Scoring works on Arrow batches; only the URL column is read.

Defined cases: a null URL or one without `://` has empty host and path, no rule, and the model's verdict on empty text, which is the one
of the intercept: allow. Repeated rows are judged alike. An empty table gives an empty result. Other columns of the pages are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.llm import common

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
BUCKETS = 1 << 14
SIZES = (3, 4, 5)
PRIOR = 0.2
MOST_LABELLED = 100_000

#: Host words of pages to leave out and to keep. Each makes two example URLs, with the next word of its list or alone.
BLOCKED_WORDS = (
    "casino", "win", "bets", "free", "pills", "cheap", "adult", "xxx", "spam", "farm", "ads", "track", "poker", "slots", "jackpot", "loans",
    "payday", "porn", "cams", "escort", "viagra", "crack", "warez", "phish", "malware", "click", "bonus", "lotto", "dating", "replica",
)
ALLOWED_WORDS = (
    "news", "library", "weather", "docs", "school", "recipes", "health", "university", "garden", "travel", "museum", "music", "science",
    "history", "forum", "wiki", "maps", "jobs", "sports", "photos", "code", "thering", "tionon", "thanre", "erthin", "anther", "stonth",
    "handin", "theound", "ingther",
)
PATHS = ("en/12", "de/7.html", "fr/41?page=2&ref=x", "es/9/", "en/305#top", "en/88?utm_source=feed", "about", "2024/03/page.html")
SUBDOMAINS, ENDINGS = ("", "www.", "blog.", "m."), ("com", "org", "net")


def examples() -> list[tuple[str, int]]:
    """The small labelled table: URLs with 1 (block) or 0; both classes have the same subdomains, endings and paths."""
    out = []
    for label, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for k, word in enumerate(words):
            for turn, name in enumerate((word, f"{word}-{words[(k + 1) % len(words)]}")):
                at = 2 * k + turn
                host = f"{SUBDOMAINS[at % len(SUBDOMAINS)]}{name}.example.{ENDINGS[at % len(ENDINGS)]}"
                out.append((f"http://{host}/{PATHS[at % len(PATHS)]}", label))
    return out


def host_of(url: str = "url") -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; both null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def gram_rows(hosts: Sequence[str], paths: Sequence[str]) -> list[np.ndarray]:
    """For each URL the distinct buckets of its character n-grams; host and path are hashed apart."""
    out = []
    for host, path in zip(hosts, paths, strict=True):
        found: list[np.ndarray] = [np.zeros(0, np.uint64)]
        for salt, text in ((1, host), (2, path)):
            codes = np.frombuffer(f"^{text}$".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
            for n in SIZES:
                if text and len(codes) >= n:
                    grams = np.full(len(codes) - n + 1, salt * 16 + n, np.uint64)
                    for j in range(n):
                        grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[j : len(codes) - n + 1 + j]
                    found.append(common.mix(grams))
        out.append(np.unique(np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64))
    return out


def margins(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds; each URL's n-gram vector has length 1."""
    sums = np.array([weights[r].sum() / np.sqrt(max(len(r), 1)) for r in rows], dtype=np.float64)
    return sums + bias


def train(hosts: Sequence[str], paths: Sequence[str], labels: Sequence[int], steps: int = 400, rate: float = 2.0, decay: float = 1e-4):
    """Full-batch gradient descent; classes weigh alike."""
    rows, y = gram_rows(hosts, paths), np.asarray(labels, dtype=np.float64)
    weights, bias = np.zeros(BUCKETS), 0.0
    if not len(y):
        return weights, bias
    at = np.concatenate(rows)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = np.array([1 / np.sqrt(max(len(r), 1)) for r in rows])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(steps):
        z = np.bincount(of, weights[at], minlength=len(rows)) * scale + bias
        error = share * (1 / (1 + np.exp(-z)) - y)
        weights -= rate * len(rows) ** 0.5 * (np.bincount(at, (error * scale)[of], minlength=BUCKETS) + decay * weights)
        bias -= rate * error.sum()
    return weights, bias


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, prior: float = PRIOR) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of blocking, which blocks from 0.5 on.

    prior: the expected share of URLs to block; training weighs both classes alike, so it shifts the log-odds.
    labelled: columns url and label (1: block), at most MOST_LABELLED rows; default is the table of this module."""
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(examples(), "url string, label int")
    known = labelled.select(host_of().alias("host"), path_of().alias("path"), "label").limit(MOST_LABELLED + 1).toArrow()
    if known.num_rows > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled URLs: pass a sample")
    columns = known.to_pydict()
    weights, bias = train(columns["host"], columns["path"], columns["label"])
    kept = spark.sparkContext.broadcast((weights, min(bias, 0.0) + float(np.log(prior / (1 - prior)))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = kept.value
        for batch in batches:
            got = batch.to_pydict()
            z = margins(gram_rows(got["host"], got["path"]), w, b)
            yield batch.append_column("score", pa.array(1 / (1 + np.exp(-z)), pa.float64()))

    split = pages.select(F.col("page_id"), host_of().alias("host"), path_of().alias("path"))
    kind = split.schema["page_id"].dataType.simpleString()
    rule, verdict = rule_of(rules)
    by_model = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return split.mapInArrow(score, f"page_id {kind}, host string, path string, score double").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "pages").select("page_id", "url"))
