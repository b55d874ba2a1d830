"""URL filter: rules first, else logistic regression on hashed character n-grams.

The model is fitted on a small labelled table inside one Spark expression. With weights that
start at zero, every step of gradient descent stays a sum over the labelled rows, so the fit
keeps one coefficient per row and the matrix of common n-grams; the coefficients then turn into
one weight per hash bucket. The weights, of a fixed number, reach all tasks as a constant, and
every url is judged in the scan, without a shuffle.

Nulls and edge cases: a null url and one without ``://`` have an empty host and path, fit no rule
and are judged by the intercept and the n-grams of nothing. Urls that repeat are judged alike. No other column than
those named is read, except to be passed on.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.llm.text import let
from carebase.session import written

BUCKETS = 2**14
GRAMS = (3, 4, 5)
EPOCHS = 150
RATE, BIAS_RATE = 0.5, 2.0
DECAY = 0.01
# The fit compares all pairs of labelled rows, so their number is bounded.
MAX_LABELLED = 1000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

# Words in hosts of unwanted and of ordinary sites, and words that go with both.
BLOCKED_WORDS = (
    "casino bets betting poker slots jackpot lottery pills viagra ads adclick track tracker spam farm "
    "adult xxx porn cams loans payday warez crack torrents replica"
).split()
ALLOWED_WORDS = (
    "news paper weather library university school museum history science cooking garden recipes "
    "health clinic hospital software docs wiki travel railway maps theatre orchestra letters forum "
    "council bookshop translation mathematics nation thing stone other thousand thread ensemble"
).split()
COMPANIONS = "free online best my web win x shop city world cheap top".split()
DOMAINS = ("example.com", "example.org", "example.net")
PREFIXES = ("", "www.", "m.", "blog.")
PATHS = ("/en/1207.html", "/de/348", "/fr/5512/", "/es/76", "/about", "/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): each word with three companions; all but the words occurs in both classes."""
    rows = []
    for blocked, listed in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for i, word in enumerate(listed):
            for k, domain in enumerate(DOMAINS):
                n = i + 5 * k
                pair = (word, COMPANIONS[n % len(COMPANIONS)])
                name = "-".join(pair if n % 2 else pair[::-1])
                path = PATHS[(n + k) % len(PATHS)]
                rows.append((f"https://{PREFIXES[n % len(PREFIXES)]}{name}.{domain}{path}", blocked))
    values = ", ".join(f"('{url}', {blocked})" for url, blocked in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, blocked)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path up to ``?``, ``#`` or the end."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(known, parts, 1)
    return (
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
        F.regexp_extract(known, parts, 2),
    )


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    named = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        inside = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        fits = inside & F.startswith(path, F.lit(rule.path))
        named = F.when(fits, F.lit(rule.host + rule.path)).otherwise(named)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return named, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """The distinct hash buckets of the character n-grams of host and path."""

    def grams(part: str, marked: Column, n: int) -> Column:
        def of(chars: Column) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.size(chars) - n + 1, F.lit(1)))
            return F.transform(
                starts,
                lambda i: F.pmod(
                    F.xxhash64(F.lit(part), F.array_join(F.slice(chars, i, n), "")),
                    F.lit(BUCKETS),
                ).cast("int"),
            )

        return let(F.split(marked, ""), of)

    marked = {
        "host": F.concat(F.lit("^"), host, F.lit("$")),
        "path": F.concat(F.lit("^"), path, F.lit("$")),
    }
    lists = [grams(part, text, n) for part, text in marked.items() for n in GRAMS]
    return F.array_distinct(F.concat(*lists))


def fit_weights(labelled: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """One row with ``weights``, an array of a weight per bucket, the last being the intercept.

    ``labelled`` has url and blocked (0 or 1); rows without a label are left out. The fit takes
    at most ``MAX_LABELLED`` rows, those with the smallest hashes.
    """
    rows = labelled.where("blocked IS NOT NULL").select(
        gram_buckets(*host_and_path(F.col("url"))).alias("all"),
        F.col("blocked").cast("double").alias("y"),
        F.xxhash64("url").alias("h"),
    )
    bounded = written(rows.orderBy("h", "y").limit(MAX_LABELLED), "labelled")
    rows = bounded.select("h", "y", F.col("all").alias("grams"))
    together = rows.agg(F.array_sort(F.collect_list(F.struct("h", "y", "grams"))).alias("rows"))
    # Rows are scaled to length one, so the n-grams that two rows share become a cosine.
    norm = "sqrt(cast(size(a.grams) AS double) * size(b.grams))"
    kernel = f"transform(rows, a -> transform(rows, b -> size(array_intersect(a.grams, b.grams)) / {norm}))"
    # Stored, or else the optimizer would compute the matrix anew in every epoch.
    compared = written(together.selectExpr("rows", f"{kernel} AS kernel"), "compared")
    margin = "aggregate(zip_with(s.alpha, k, (p, q) -> p * q), s.bias, (x, y) -> x + y)"
    errors = f"zip_with(rows, kernel, (r, k) -> r.y - 1D / (1D + exp(-{margin})))"
    step = f"""transform(array({errors}), e -> struct(
        zip_with(s.alpha, e, (a, x) -> a * {1 - DECAY}D + {RATE}D * x) AS alpha,
        s.bias + {BIAS_RATE}D * aggregate(e, 0D, (x, y) -> x + y) / size(rows) AS bias))[0]"""
    zero = "struct(transform(rows, r -> 0D) AS alpha, 0D AS bias)"
    fitted = (
        compared.where("size(rows) > 0")
        .selectExpr("rows", f"aggregate(sequence(1, {epochs}), {zero}, (s, i) -> {step}) AS fit")
        .selectExpr("explode(arrays_zip(rows, fit.alpha)) AS row", "fit.bias AS bias")
        .selectExpr("row.rows.grams AS grams", "row.alpha AS alpha", "bias")
    )
    fitted = written(fitted, "fitted")
    shares = fitted.selectExpr("explode(grams) AS bucket", "alpha / sqrt(size(grams)) AS share")
    intercept = fitted.select(F.lit(BUCKETS).alias("bucket"), "bias").distinct()
    sums = shares.unionAll(intercept).groupBy("bucket").agg(F.sum("share").alias("weight"))
    every = labelled.sparkSession.range(BUCKETS + 1).select(F.col("id").cast("int").alias("bucket"))
    ordered = every.join(sums, "bucket", "left").agg(
        F.array_sort(
            F.collect_list(F.struct("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight")))
        ).alias("all")
    )
    return ordered.select(F.col("all.weight").alias("weights"))


def judge_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages``.

    ``score`` is the log-odds of being unwanted; without a rule, a positive one blocks.
    """
    labelled = labelled_urls(pages.sparkSession) if labelled is None else labelled
    weights = written(fit_weights(labelled), "weights").scalar()
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    parsed = parsed.withColumns(
        {"grams": gram_buckets(F.col("host"), F.col("path")), "weights": weights}
    )
    known = F.filter(
        F.transform("grams", lambda g: F.get("weights", g)), lambda w: w != 0
    )
    score = let(
        known,
        lambda found: F.aggregate(found, F.lit(0.0), lambda a, b: a + b)
        / F.sqrt(F.greatest(F.size(found), F.lit(1))),
    ) + F.get("weights", F.lit(BUCKETS))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return parsed.withColumn("score", score).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, judged).alias("verdict"),
        "score",
    )


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    judged = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict")
