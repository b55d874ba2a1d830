"""Quality classifier from weak labels, for low quality and for toxic language.

1. Heuristic labellers vote on every document: bad, good, or nothing. Votes are counted by pattern;
   there are at most three to the number of labellers of them, whatever the number of documents.
2. Expectation-maximisation over the pattern counts estimates how often each labeller votes what
   on good and on bad documents, and so how probable it is that a document of a pattern is bad.
3. These probabilities label a bounded sample of documents, on which a linear scorer on hashed
   words, symbols and binned measures is trained. Its weights, of a fixed number, score every
   document in one pass without a shuffle.

The sample is the one bounded step: ``SAMPLE`` different texts, those of the lowest hashes, each
with the number of its copies as its weight, and of each up to ``SAMPLED_WORDS`` of its distinct
words. So a large group of copies takes one place, and the same table gives the same model. Votes,
counts and scores cover all documents and whole texts.

Nulls and edge cases: a null text is an empty one; a text without words gets no vote and is not
rejected. Equal texts get equal scores. On an empty table all weights are zero. Other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebase.llm.text import pieces, words
from carebase.session import written

BUCKETS = 2**16
SAMPLE = 5000
SAMPLED_WORDS = 4096
EM_STEPS = 100
TRAIN_STEPS = 200
RATE, MOMENTUM, DECAY = 1.0, 0.9, 1e-4
# Up to the square of this number, each distinct word counts in full.
FULL_ROOT = 8
BAD, GOOD, NONE = 0, 1, 2

# Words that tell running text, and words that insult.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be this by from at or an have not but which "
    "der die das und ist nicht von mit den ein eine zu im auf für sich des dem "
    "le la les et est des du un une que qui dans pour par sur pas au avec "
    "el los las de en es por con para una del se no lo como más su"
).split()
INSULTS = (
    "idiot idiots stupid moron morons loser losers dumb fool fools imbecile jerk bastard "
    "trash scum worthless pathetic disgusting clown clowns filth vermin garbage bitch"
).split()
PERSONAL, SCORNFUL = INSULTS[:13], INSULTS[13:]


SYMBOLS = r"[#$%&*|^~<>{}=\\!]"


def _measured(docs: DataFrame, key: Column) -> DataFrame:
    """What the labellers look at, per document. Lists that several measures need are columns."""
    known = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    listed = known.select(
        "key",
        "text",
        words("text").alias("plain"),
        pieces(F.col("text"), r"[.!?\n]+\s*").alias("sentences"),
    ).withColumn("distinct", F.array_distinct("plain"))

    def count(pattern: str) -> Column:
        return (F.size(F.split("text", pattern, -1)) - 1).cast("double")

    def found(column: str, known: list[str]) -> Column:
        return F.size(F.filter(column, lambda w: w.isin(known))).cast("double")

    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")
    n = F.greatest(F.size("plain"), F.lit(1)).cast("double")
    n_sentences = F.greatest(F.size("sentences"), F.lit(1))
    twins = F.filter("plain", lambda w, i: w == F.get("plain", i + 1))
    return listed.select(
        "key",
        "distinct",
        F.array_distinct(F.regexp_extract_all("text", F.lit(SYMBOLS + "+"), F.lit(0))).alias("marks"),
        F.size("plain").cast("double").alias("words"),
        (count(SYMBOLS + "+") / n).alias("symbols"),
        (count("[A-Z][A-Z]+") / n).alias("shouts"),
        (F.size(F.array_distinct("sentences")) / n_sentences).alias("fresh_sentences"),
        (F.size("distinct") / n).alias("fresh_words"),
        (F.size(twins) / n).alias("twins"),
        (found("plain", STOP_WORDS) / n).alias("stops"),
        (chars / n).alias("length"),
        found("distinct", PERSONAL).alias("personal"),
        found("distinct", SCORNFUL).alias("scornful"),
    )


def _vote(bad: Column, good: Column) -> Column:
    voted = F.when(bad, BAD).when(good, GOOD).otherwise(NONE)
    return F.when(F.col("words") > 0, voted).otherwise(NONE)


def quality_votes() -> list[Column]:
    c = F.col
    return [
        _vote(c("symbols") > 0.1, c("symbols") < 0.03),
        _vote(c("shouts") > 0.2, F.lit(False)),
        _vote((c("twins") > 0.15) & (c("words") > 5), c("twins") < 0.08),
        _vote((c("fresh_words") < 0.35) & (c("words") > 20), c("fresh_words") > 0.45),
        _vote((c("fresh_sentences") < 0.5) & (c("words") > 20), c("fresh_sentences") > 0.65),
        _vote((c("length") < 3) | (c("length") > 8.2), c("length").between(4.5, 7.5)),
        _vote((c("stops") < 0.03) & (c("words") > 10), c("stops") > 0.1),
    ]


def toxic_votes() -> list[Column]:
    personal, scornful, n = F.col("personal"), F.col("scornful"), F.col("words")
    insults = personal + scornful
    return [
        _vote(personal > 0, F.lit(False)),
        _vote(scornful > 0, F.lit(False)),
        _vote(insults > 0.004 * n, insults == 0),
        _vote(insults > 1, insults == 0),
    ]


TARGETS = {"low_quality": quality_votes, "toxic": toxic_votes}


def _pattern(votes: list[Column]) -> Column:
    return F.concat(*(v.cast("string") for v in votes))


def fit_labellers(counts: dict[str, int]) -> dict[str, float]:
    """The probability of being bad for each pattern of votes.

    Starts from the belief that a single vote against a document tells more than many for it.
    Documents without any vote count as good.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    votes = np.array([[int(v) for v in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], dtype=float)
    bad = np.where((votes == BAD).any(1), 0.8, 0.02)
    for _ in range(EM_STEPS):
        shares = []
        for belief in (bad, 1 - bad):
            mass = belief * weight
            by_vote = np.stack([(mass[:, None] * (votes == v)).sum(0) for v in (BAD, GOOD, NONE)])
            shares.append((by_vote + 0.5) / (mass.sum() + 1.5))
        prior = (bad * weight).sum() / weight.sum()
        prior = min(max(prior, 1e-3), 0.5)
        logs = [
            np.log(p) + np.log(share[votes, np.arange(votes.shape[1])]).sum(1)
            for p, share in zip((prior, 1 - prior), shares, strict=True)
        ]
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        if np.abs(new - bad).max() < 1e-6:
            break
        bad = new
    bad = np.where((votes == NONE).all(1), 0.0, bad)
    return dict(zip(patterns, bad.tolist(), strict=True))


def feature_buckets(kind: str) -> Column:
    """Distinct buckets of the words, the runs of symbols or the binned measures."""
    binned = [
        F.concat(F.lit(f"{name}:"), F.floor(F.least(F.col(name), F.lit(top)) * scale).cast("string"))
        for name, top, scale in (
            ("symbols", 1.0, 20), ("shouts", 1.0, 20), ("fresh_sentences", 1.0, 10),
            ("fresh_words", 1.0, 10), ("stops", 0.5, 30), ("length", 20.0, 1), ("twins", 1.0, 20),
            ("personal", 3.0, 1), ("scornful", 3.0, 1),
        )
    ]

    values = {"word": "distinct", "symbol": "marks", "measure": F.array(*binned)}[kind]
    return F.array_distinct(
        F.transform(values, lambda v: F.pmod(F.xxhash64(F.lit(kind), v), F.lit(BUCKETS)).cast("int"))
    )


def featured(docs: DataFrame, key: Column) -> DataFrame:
    """Votes and feature buckets of every document, stored: the one pass over the texts."""
    votes = [_pattern(labellers()).alias(name) for name, labellers in TARGETS.items()]
    return written(
        _measured(docs, key).select(
            "key",
            "words",
            *votes,
            feature_buckets("word").alias("buckets"),
            F.concat(feature_buckets("symbol"), feature_buckets("measure")).alias("marks"),
        ),
        "featured",
    )


def _entries(words_: pa.Array, marks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of each feature, the intercept of each row last."""
    n = len(words_)
    sizes = [np.diff(lists.offsets.to_numpy()) for lists in (words_, marks)]
    damped = 1 / np.maximum(1, sizes[0] ** 0.5 / FULL_ROOT)
    owner = np.concatenate([np.repeat(np.arange(n), size) for size in sizes] + [np.arange(n)])
    bucket = np.concatenate([words_.flatten(), marks.flatten(), np.full(n, BUCKETS)])
    value = np.ones(len(owner))
    value[: sizes[0].sum()] = np.repeat(damped, sizes[0])
    return owner, bucket.astype(np.int64), value


def train_scorer(
    entries: tuple[np.ndarray, np.ndarray, np.ndarray], bad: np.ndarray, copies: np.ndarray
) -> np.ndarray:
    """Logistic regression on presence of words and marks; the last weight is the intercept.

    The words of long documents count less each, so that many words do not drown a mark. A text
    counts as often as it occurs.
    """
    weights = np.zeros(BUCKETS + 1)
    if not len(bad):
        return weights
    owner, bucket, value = entries
    share = copies / copies.sum()
    speed = np.zeros(BUCKETS + 1)
    for _ in range(TRAIN_STEPS):
        margin = np.bincount(owner, weights[bucket] * value, len(bad))
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - bad) * share
        slope = np.bincount(bucket, error[owner] * value, BUCKETS + 1) + DECAY * weights
        speed = MOMENTUM * speed - RATE * slope
        weights += speed
    return weights


@dataclass(frozen=True)
class QualityModel:
    """For each target, the probability of each pattern and the weights of the scorer."""

    beliefs: dict[str, dict[str, float]]
    weights: dict[str, np.ndarray]


def sampled(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Up to ``sample`` different rows, those of the lowest hashes, with the number of copies.

    Rows are told apart by a hash of votes and features; only what may be in the sample is grouped
    with its features.
    """
    hashed = rows.withColumn("place", F.xxhash64(*TARGETS, "buckets", "marks"))
    different = hashed.select("place").distinct().count()
    # Twice the share that would do on average; the lowest of them are then taken exactly.
    share = min(1.0, 2 * sample / max(different, 1) + 0.001)
    low = hashed.where(F.col("place") <= int(-(2**63) + share * (2**64 - 1)) if share < 1 else F.lit(True))
    first = F.slice(F.array_sort("buckets"), 1, SAMPLED_WORDS).alias("buckets")
    grouped = low.select("place", *TARGETS, first, "marks").groupBy("place")
    kept = (*TARGETS, "buckets", "marks")
    texts = grouped.agg(F.count("*").alias("copies"), *(F.first(name).alias(name) for name in kept))
    return texts.orderBy("place").limit(sample)


def fit(rows: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fits on the stored votes and buckets of all documents."""
    beliefs = {
        name: fit_labellers({r[0]: r[1] for r in rows.groupBy(name).count().collect()})
        for name in TARGETS
    }
    chosen = sampled(rows, sample).select("copies", *TARGETS, "buckets", "marks").toArrow()
    chosen = chosen.combine_chunks()
    buckets, marks = (
        chosen[name].chunk(0) if chosen.num_rows else pa.array([], pa.list_(pa.int32()))
        for name in ("buckets", "marks")
    )
    entries, copies = _entries(buckets, marks), chosen["copies"].to_numpy()
    bad = {
        name: np.array([beliefs[name][pattern] for pattern in chosen[name].to_pylist()])
        for name in TARGETS
    }
    return QualityModel(
        beliefs, {name: train_scorer(entries, bad[name], copies) for name in TARGETS}
    )


def score(rows: DataFrame, model: QualityModel) -> DataFrame:
    """(key, low_quality, toxic, rejected): log-odds of being bad; a positive one rejects."""
    values = [tuple(model.weights[name].tolist() for name in TARGETS)]
    schema = ", ".join(f"{name} array<double>" for name in TARGETS)
    weights = written(rows.sparkSession.createDataFrame(values, schema), "weights")
    weighed = rows.select(
        "key", "words", "buckets", "marks", *(weights.select(n).scalar().alias(f"w_{n}") for n in TARGETS)
    )

    def total(name: str) -> Column:
        w = F.col(f"w_{name}")
        words_, marks = (
            F.aggregate(of, F.lit(0.0), lambda s, b: s + F.get(w, b)) for of in ("buckets", "marks")
        )
        damped = words_ / F.greatest(F.lit(1.0), F.sqrt(F.size("buckets")) / FULL_ROOT)
        return (damped + marks + F.get(w, F.lit(BUCKETS))).alias(name)

    scored = weighed.select("key", "words", *(total(name) for name in TARGETS))
    bad = (F.col("low_quality") > 0) | (F.col("toxic") > 0)
    return scored.select("key", *TARGETS, (bad & (F.col("words") > 0)).alias("rejected"))


def classify(docs: DataFrame, key: Column) -> DataFrame:
    rows = featured(docs, key)
    return score(rows, fit(rows))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all columns.

    A verdict depends on the text alone, so texts are compared by their hash.
    """
    bad = classify(docs, F.md5("text")).where("rejected")
    bad = bad.select(F.col("key").alias("_bad_text")).distinct()
    return docs.join(bad, F.md5(docs["text"]) == F.col("_bad_text"), "left_anti")


def op7_weak_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, F.col("doc_id")).withColumnRenamed("key", "doc_id")
