"""Operators with Python in their tasks, and the pipeline, against brute force."""

import hashlib
import itertools
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from carebase.llm import main_text, merkle, near_duplicates, secret_links, weak_quality

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    frame = spark.createDataFrame(full, DOCS)
    return frame.withColumns({c: F.lit("clash") for c in ("id", "label", "bands", "bucket", "words")})


# --- main text ----------------------------------------------------------------
PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><main><article><h1>Title</h1>
<p>First  para with <a href=x>link</a> &amp; more<br>text.<p>Ok.<aside>side</aside><div class="ad">buy</div>
<ul><li>one<li>two</ul><form><label>Name</label></form><p>End &#233;&nbsp;x</article><section id="comments">
<p>A reader comment that is long enough to look like the text of an article, more than eighty.</p></section>
</main><footer>c</footer>"""


def test_main_text_of_a_page(spark):
    html = [PAGE, None, "", "<p>", "</div><b>", "no markup at all but a text long enough to be a paragraph of its own, by far.", PAGE]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    got = {r.page_id: r for r in main_text.extract(pages.withColumn("text", F.lit("clash"))).collect()}
    assert got[0].text.split("\n") == ["Title", "First para with link & more text.", "Ok.", "one", "two", "End é x"]
    assert got[0].n_chars == len(got[0].text) and got[6].text == got[0].text
    assert [got[i].text for i in (1, 2, 3, 4)] == [""] * 4
    assert got[5].text == html[5]
    assert main_text.extract(pages.limit(0)).count() == 0


def test_the_cut_is_a_minimum():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 9)
        scores = [rng.choice([-3.0, -1.0, -0.5, 0.0, 0.7, 2.0, 4.0]) for _ in range(n)]
        edges = [(i, i + 1, 1.0) for i in range(n - 1)]
        edges += [(a, b, 0.6) for a in range(n) for b in range(a + 2, n) if rng.random() < 0.2]

        def cost(labels):
            cut = sum(abs(s) for s, k in zip(scores, labels, strict=True) if (s > 0) != k and s)
            return cut + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(main_text.min_cut(scores, edges)) == pytest.approx(best)


def test_long_pages_stay_in_proportion():
    page = "<article>" + "<p>abc def</p><div class=ad>x</div>" * 3000
    assert main_text.main_text(page) == "\n".join(["abc def"] * 3000)


# --- Merkle fingerprints --------------------------------------------------------
def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i * 7 % 101, " ".join(rng.choice(["a", "bé", "c.", "😀", "\n", "\n\n"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(1000, ""), (1001, "x"), (2**60 + 1, "y z"), (-5, None)]
    got = {r.doc_id: r for r in merkle.compare_with_next(docs_of(spark, rows)).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (merkle.fingerprint(text), merkle.fingerprint(changed))
        assert (r.near_edited == 1) == (text == changed) and (r.near_next == 1) == (text == following)


def test_fingerprints_of_odd_tables(spark):
    one = merkle.compare_with_next(docs_of(spark, [(3, "only one")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert merkle.compare_with_next(docs_of(spark, [(1, "a")]).limit(0)).count() == 0
    odd = merkle.compare_with_next(docs_of(spark, [(None, "n"), (None, "m"), (2, "a"), (2, "a"), (2, "b")])).collect()
    assert sorted(map(str, (r.doc_id for r in odd))) == ["2", "2", "2", "None", "None"]


def test_fingerprints_locate_edits():
    text = "A first. Second one here.\n\nNew section. With words.\nLast line."
    assert merkle.fingerprint(text) != merkle.fingerprint(text + " ")
    assert merkle.differing_branches(merkle.fingerprint(text), merkle.fingerprint(text.replace("words", "other"))) == [(1, 1)]
    rng = random.Random(1)
    long = " ".join(rng.choice(["lorem", "ipsum", "dolor.", "sit"]) + str(i) for i in range(400))
    assert 0.4 < merkle.likeness(merkle.fingerprint(long), merkle.fingerprint(long[: len(long) // 2] + "z" * 900)) < 0.9


# --- near duplicates ------------------------------------------------------------
def components_by_hand(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 3]) for k in range(max(len(w) - 2, 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(seed=2, groups=6, members=45):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([2, 12, 60, 120]))]
        for _ in range(members):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            rows.append(" ".join(words))
    rows += ["", None, " \t\n", "One TWO", "one two", "É x y", "é x y", "one"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("small", "block"), [(24, 384), (3, 4)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_duplicates, "SMALL", small)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rows = near_rows()
    got = near_duplicates.group_near_duplicates(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_by_hand(rows)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got) and len(got) == len(rows)


def test_near_duplicates_of_odd_tables(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "a b c d"), (7, "x")]
    got = near_duplicates.group_near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("5", "5", True), ("5", "5", True), ("7", "7", True), ("9", "5", False),
        ("None", "None", True), ("None", "None", True),
    ]
    empty = docs_of(spark, rows).limit(0)
    assert near_duplicates.group_near_duplicates(empty).count() == 0
    kept = near_duplicates.without_near_duplicates(docs_of(spark, rows))
    assert kept.count() == 5 and kept.columns == docs_of(spark, rows).columns


def test_copies_are_no_links(spark, monkeypatch):
    stored = {}

    def counted(df, name):
        table = written(df, name)
        stored[name] = stored.get(name, 0) + table.count()
        return table

    written = near_duplicates.written
    monkeypatch.setattr(near_duplicates, "written", counted)
    rows = [(i, "one text of many copies") for i in range(300)] + [(900, "text of another kind"), (7, "")]
    # Rows of one id link the classes of their texts.
    rows += [(900, "a third and other text"), (40, "a third and other text")]
    got = near_duplicates.group_near_duplicates(docs_of(spark, rows)).collect()
    assert {r.component_id for r in got if r.doc_id < 300 and r.doc_id not in (7, 40)} == {0}
    assert {r.component_id for r in got if r.doc_id in (7, 40, 900)} == {0}
    assert len(got) == len(rows) and stored["links"] < 20


def test_outsiders_without_plausible_partners_send_no_texts():
    rng = np.random.default_rng(8)
    signs = rng.integers(0, 256, (9, near_duplicates.REGISTERS), dtype=np.uint8)
    signs[7, :60], signs[8, :60] = signs[0, :60], signs[1, :60]
    block = pd.DataFrame({
        "key": 5, "i": 0, "j": 0, "id": range(9), "label": [0, 1, 2, 3, 4, 5, 6, 7, 1],
        "outside": [True] * 4 + [False] * 5, "n": 50, "signs": [x.tobytes() for x in signs],
    })
    # 1 and 8 agree, but have one label already.
    assert list(near_duplicates._block_candidates(block)["id"]) == [0, 7]
    assert near_duplicates._block_candidates(block.assign(n=[9, *[50] * 8])).empty


def test_long_texts_of_a_block_are_counted_in_bounded_memory():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 2**64, 90_000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, 80_000)) for _ in range(60)]
    tracemalloc.start()
    both = near_duplicates.shared_counts(sets[:30], sets[30:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    for i, j in ((0, 0), (3, 17), (29, 29)):
        assert both[i, j] == len(np.intersect1d(sets[i], sets[30 + j]))
    assert near_duplicates.shared_counts(sets[:2], []).shape == (2, 0)


def test_words_are_hashed_alike_in_any_window(monkeypatch):
    hasher = near_duplicates.WordHasher()
    text = " ".join(f"word{i} \x0b\x1c" for i in range(3000)) + " é"
    whole = hasher(text)
    monkeypatch.setattr(near_duplicates, "WINDOW_BYTES", 64)
    assert (near_duplicates.WordHasher()(text) == whole).all()
    assert len(whole) == len(text.encode().split())


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    for size in (1, 5, 60, 96, 97, 700):
        both = rng.integers(0, 2**63, size, dtype=np.uint64)
        own = [rng.integers(0, 2**63, max(size // 4, 1), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([both, x])) for x in own)
        x, y = near_duplicates.super_minhash(a), near_duplicates.super_minhash(b)
        assert abs((x == y).mean() - size / (size + 2 * max(size // 4, 1))) < 0.2
        assert np.isfinite(x.view(np.float64)).all()


# --- quality classifier -----------------------------------------------------------
def test_classifier_agrees_with_held_out_labels(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = weak_quality.classify(docs, F.col("doc_id")).withColumnRenamed("toxic", "score").withColumnRenamed("key", "doc_id")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    seen = rows.join(labels, "doc_id").collect()
    assert rows.count() == docs.count()
    right = sum((r.low_quality > 0) == (r.quality == 0) for r in seen)
    assert right >= 0.95 * len(seen)
    clean = [r for r in seen if r.quality == 1 and r.toxic == 0]
    assert sum(r.rejected for r in clean) <= 0.02 * len(clean)
    insulted = docs.where(F.lower("text").rlike(r"\b(idiot|moron|worthless|pathetic|scum)\b")).select("doc_id")
    caught = rows.join(insulted, "doc_id").agg(F.avg((F.col("score") > 0).cast("int"))).first()[0]
    assert caught >= 0.95


def test_expectation_maximisation_finds_good_labellers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    votes = [np.where(rng.random(4000) < p, np.where(truth, 0, 1), 2) for p in (0.9, 0.7, 0.8)]
    noise = np.where(rng.random(4000) < 0.02, 0, 1)
    patterns = ["".join(map(str, v)) for v in zip(*votes, noise, strict=True)]
    counts = {p: patterns.count(p) for p in set(patterns)}
    belief = weak_quality.fit_labellers(counts)
    assert np.mean([(belief[p] > 0.5) == t for p, t in zip(patterns, truth, strict=True)]) > 0.96
    assert weak_quality.fit_labellers({}) == {}


def test_classifier_on_odd_rows(spark):
    odd = docs_of(spark, [(1, None), (2, ""), (3, " "), (None, "a plain sentence of words."), (4, "x" * 100_000)])
    got = {r.key: r.rejected for r in weak_quality.classify(odd, F.col("doc_id")).collect()}
    assert [got[i] for i in (1, 2, 3)] == [False] * 3 and len(got) == 5
    assert weak_quality.classify(odd.limit(0), F.col("doc_id")).count() == 0
    assert weak_quality.keep_good(odd).columns == odd.columns


# --- pipeline ---------------------------------------------------------------------
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, before, SMALL), name)
        assert docs.count() <= before.count()
        if name != "source_mix":
            assert docs.columns == columns
        if name == "near_duplicates":
            groups = near_duplicates.group_near_duplicates(before).where("kept").count()
            assert docs.count() == groups
        if name == "secret_scan":
            assert docs.count() == before.count()
            left = secret_links.scan_documents(docs).where(F.size("spans") > 0)
            assert left.count() == 0
    assert docs.columns == [*columns, "taken"] and docs.count() > 0
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_on_odd_rows(spark):
    odd = docs_of(spark, [(1, None), (2, ""), (2, ""), (None, "a plain sentence of words."), (3, "token = abcdef99 here")])
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            assert stage(spark, docs, SMALL).count() <= docs.count(), name


def test_registered(spark):
    names = set(registry.queries())
    assert {"pipeline", *(f"op{i}" for i in range(1, 11))} <= {n.split("_")[0] for n in names}
