"""Secret scan with multipart credential linking.

Strong parts (assigned secrets, access key ids, long hexadecimal strings) are always reported.
Weak parts (login names, mixed-case keys without a name, endpoints) are common in harmless text;
they are reported only where an interval join finds the parts that complete them within the same
scope, ``SCOPE`` characters between starts. Before the join, strong and weak parts are reduced to
the first and last start per bucket of positions, so that a document full of keys makes no pairs.

A scan needs one pass over the texts and keeps only lengths; positions are running totals of
the lengths of matches and of the gaps between them.

Nulls and edge cases: a null or empty text has no parts. Weak parts that overlap a strong one are
dropped. Rows that share an id are separate documents with a row each; equal texts have equal
parts. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carebase.session import written

SCOPE = 300
MASK = "[secret]"

# The kinds in their order, each with its pattern and the roles that it needs nearby.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "login": r"(?i:user(?:name)?|login|account|client_?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}",
    "key": r"[A-Za-z0-9+/_-]{32,}={0,2}",
    "endpoint": r"(?:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp|ftp)://[^\s\"'<>]+",
}
KINDS = tuple(PATTERNS)
STRONG = ("assign", "access", "hex")
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "login": "id", "key": "secret"}
NEEDS = {"login": ("secret",), "key": ("id",), "endpoint": ("id", "secret")}
ASSIGNED_LENGTH = 6


def _found(text: Column, kind: str) -> Column:
    """(kind, gap, length, kept) of each match; the gap is the text since the match before."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.transform(whole, lambda m: F.lit(True))
    if kind == "assign":
        values = F.regexp_extract_all(text, pattern, F.lit(2))
        kept = F.transform(values, lambda v: F.length(v) >= ASSIGNED_LENGTH)
    if kind == "key":  # upper and lower case and a digit
        mixed = r"^(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9])"
        kept = F.transform(whole, lambda m: m.rlike(mixed))
    gaps = F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(whole))
    found = F.transform(
        F.arrays_zip(gaps.alias("g"), whole.alias("m"), kept.alias("k")),
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("length"),
            x["k"].alias("kept"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,gap:int,length:int,kept:boolean>>")
    return F.when(text.rlike(PATTERNS[kind]), found).otherwise(none)


def scan_parts(docs: DataFrame, key: Column) -> DataFrame:
    """(row, key, found): every document with what the patterns match in its text, stored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            key.alias("key"),
            F.concat(*(_found(text, kind) for kind in KINDS)).alias("found"),
        ),
        "parts",
    )


def part_spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, stop) of all parts, in code points, weak ones included."""
    rows = scanned.select("row", F.posexplode("found").alias("i", "part")).select(
        "row", "i", "part.*"
    )
    upto = Window.partitionBy("row", "kind").orderBy("i")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.col("length")).over(upto)
    spans = rows.select(
        "row", "kind", (stop - F.col("length")).alias("start"), stop.alias("stop"), "kept"
    )
    return spans.where("kept").drop("kept")


def _is_strong(kind: str = "kind") -> Column:
    return F.col(kind) < len(STRONG)


def linked_weak_spans(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans for which all the roles they need occur within ``scope``."""
    by_start = Window.partitionBy("row").orderBy("start")
    strong_stop, strong_start = (F.when(_is_strong(), F.col(c)) for c in ("stop", "start"))
    before = F.max(strong_stop).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(strong_start).over(by_start.rangeBetween(1, Window.unboundedFollowing))
    placed = spans.select("*", before.alias("before"), after.alias("after"))
    overlaps = (F.coalesce("before", F.lit(0)) > F.col("start")) | (
        F.coalesce("after", F.col("stop")) < F.col("stop")
    )
    bucket = F.floor(F.col("start") / scope)
    parts = placed.where(_is_strong() | ~overlaps).select(
        "row", "kind", "start", "stop", bucket.alias("bucket")
    )
    role = F.get(F.array(*(F.lit(ROLES.get(kind)) for kind in KINDS)), F.col("kind"))
    complete = (
        parts.select("row", "bucket", "start", role.alias("role"))
        .where("role IS NOT NULL")
        .groupBy("row", "bucket", "role")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
        # Seen from the buckets before, of and after each part.
        .select(
            "row", F.explode(F.expr("sequence(bucket - 1, bucket + 1)")).alias("bucket"),
            "role", "first", "last",
        )
    )
    near = F.least(
        F.abs(F.col("first") - F.col("start")), F.abs(F.col("last") - F.col("start"))
    )
    weak = parts.where(~_is_strong())
    linked = weak.join(complete, ["row", "bucket"]).where(
        # Within one bucket all starts are near, whatever lies between first and last.
        (near <= scope) | ((F.col("first") <= F.col("start")) & (F.col("last") >= F.col("start")))
    )
    roles = linked.groupBy("row", "kind", "start", "stop").agg(F.collect_set("role").alias("roles"))
    needed = [
        (F.col("kind") == KINDS.index(kind))
        & F.array_contains("roles", needs[0])
        & F.array_contains("roles", needs[-1])
        for kind, needs in NEEDS.items()
    ]
    return roles.where(needed[0] | needed[1] | needed[2]).drop("roles")


def secret_spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, stop) of all spans to report."""
    spans = written(part_spans(scanned), "spans")
    return spans.where(_is_strong()).unionByName(linked_weak_spans(spans))


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every document with its spans, an array of (start, kind, stop) in order."""
    scanned = scan_parts(docs, F.col("doc_id"))
    found = secret_spans(scanned).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    return (
        scanned.select("row", F.col("key").alias("doc_id"))
        .join(found, "row", "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
    )


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents with every reported span replaced by ``mask``; n_chars follows the text.

    Documents without a span keep all their columns as they are.
    """
    scanned = scan_parts(docs, F.md5("text"))
    spans = secret_spans(scanned).select("row", "start", "stop")
    before = Window.partitionBy("row").orderBy("start", "stop")
    seen = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(seen < F.col("start"), F.lit(True)).cast("int")
    islands = (
        spans.select("*", fresh.alias("fresh"))
        .select("*", F.sum("fresh").over(before).alias("island"))
        .groupBy("row", "island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    )
    # Equal texts have equal spans, so one row per text suffices.
    by_text = (
        islands.groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("_cuts"))
        .join(scanned.select("row", "key"), "row")
        .groupBy(F.col("key").alias("_digest"))
        .agg(F.min("_cuts").alias("_cuts"))
    )
    text = docs["text"]
    joined = docs.join(by_text, F.md5(text) == F.col("_digest"), "left")
    cuts = F.col("_cuts")
    starts = F.concat(F.array(F.lit(0).cast("long")), cuts["stop"])
    ends = F.concat(cuts["start"], F.array(F.length(text).cast("long")))
    kept = F.zip_with(
        starts, ends, lambda s, e: F.substring(text, (s + 1).cast("int"), (e - s).cast("int"))
    )
    masked = F.when(cuts.isNull(), text).otherwise(F.array_join(kept, mask))
    changed = {"text": masked}
    if "n_chars" in docs.columns:
        length = F.length(masked).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(cuts.isNull(), docs["n_chars"]).otherwise(length)
    return joined.select(*(changed[c].alias(c) if c in changed else docs[c] for c in docs.columns))


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def listed(spans: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
            ),
            ",",
        )

    base = F.filter("spans", lambda s: s["kind"] < len(STRONG))

    def count(kind: str) -> Column:
        # With a second argument the function would get the index of each span.
        of_kind = F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, STRONG),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )

