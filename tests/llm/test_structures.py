"""Prefix trie, byte-pair encoding and Merkle manifest against brute force."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carebase.llm import bpe, manifest, prefix_trie

BPE = public_tokenizers.path(bpe.VOCABULARY)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix trie --------------------------------------------------------------------------------
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def brute_trie(sequences):
    """``sequences``: conversation to its list of (name, code points)."""
    if not sequences:
        return set()
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * (n[-1][1] if n else 0) for n in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.add(
            (min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, sha(ends))
        )
    return rows


def trie_of(spark, sequences, **limits):
    rows = [(c, 0, None, 0) for c in sequences]
    for c, turns in sequences.items():
        rows += [(c, i, sha(name)[:16].encode(), n) for i, (name, n) in enumerate(turns, 1)]
    df = spark.createDataFrame(rows, "conv_id long, position long, turn binary, n_chars long")
    got = [tuple(row) for row in prefix_trie.prefix_trie(df, **limits).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("limits", [{}, {"conversations": 2}, {"turns": 3}, {"conversations": 3, "turns": 5}])
def test_trie_equals_brute_force_whatever_the_shards(spark, limits):
    rnd = random.Random(7)
    names = [(name, rnd.randint(0, 9)) for name in "abc"]
    sequences = {
        c * 7 - 20: [rnd.choice(names) for _ in range(rnd.choice([0, 1, 2, 3, 9]))] for c in range(25)
    }
    sequences |= {1000 + c: [names[0], names[1]] for c in range(12)}
    assert trie_of(spark, sequences, **limits) == brute_trie(sequences)


def test_a_long_conversation_streams(spark):
    turns = [(str(i % 5), 1) for i in range(40)]
    sequences = {1: turns[:3], 2: turns, 3: turns[:20], 4: turns, 9: []}
    assert trie_of(spark, sequences, turns=4) == brute_trie(sequences)


def rebuilt_by_hand(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            both = f"{len(role.encode())}:{role}{len(text.encode())}:{text}"
            turns.setdefault(c, []).append((t is not None, t or 0, sha(both), len(text)))
    turns = {c: [(name, n) for *_, name, n in sorted(said)] for c, said in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


def test_odd_conversations(spark):
    rows = [
        (0, 2, "user", "b"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""),
        (1, 1, "user", "x"), (7, 1, "user", "x" * 100_000), (7, 2, "a", "é😀"), (7, 2, "b", "z"),
        (101, 1, "user", "no head"), (103, 5, "u", "a"), (103, 5, "u", "a"), (None, 1, "u", "lost"),
    ] + [(c, t, "user", f"t{t}") for c in range(200, 212) for t in range(8)]
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumns({"n_chars": F.lit("x"), "pre": F.lit(1)})
    got = {tuple(row) for row in prefix_trie.prefix_trie(prefix_trie.rebuilt(df)).collect()}
    assert got == brute_trie(rebuilt_by_hand(rows))
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(df.limit(0))).count() == 0


# --- byte-pair encoding -------------------------------------------------------------------------
@pytest.fixture(scope="module")
def vocabulary():
    with open(BPE, "rb") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def scan_merged(symbols, merges):
    """Merges found by looking at all pairs every time."""
    symbols = list(symbols)
    while True:
        ranked = [(merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in merges]
        if not ranked:
            return symbols
        i = min(ranked)[1]
        symbols[i : i + 2] = [merges[symbols[i], symbols[i + 1]][1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.randoms(use_true_random=False))
def test_segment_tree_merges_like_a_scan(symbols, rnd):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    rnd.shuffle(pairs)
    merges = {pair: (rank, rnd.randrange(8)) for rank, pair in enumerate(pairs[:20])}
    assert bpe.merged(symbols, merges) == scan_merged(symbols, merges)


@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.one_of(
    st.text(max_size=8),
    st.sampled_from(["<|endoftext|>", "<|endof", "'s", "'LL", "  ", "\n\n ", "\x1c", "\x85", "日本", "١٢", "\U0001e900"]),
)).map("".join))
def test_encodes_like_the_library(vocabulary, library, text):
    ids = list(vocabulary.encode(text))
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_every_character_is_cut_like_the_library(vocabulary, library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(characters), 256):
        text = "".join(f"a{c}1{c}! {c}\n {c} " for c in characters[start : start + 256])
        assert list(vocabulary.encode(text)) == library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 50256), max_size=20))
def test_decodes_broken_utf8_like_the_library(vocabulary, library, ids):
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces_and_a_full_memory(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcde", k=rnd.randint(1, 9))) for _ in range(300)]
    text = " ".join(words * 2) + "".join(rnd.choices("abcdefgh", k=30_000))
    assert list(vocabulary.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len(vocabulary.pieces) <= 8


def test_bpe_columns(spark, library):
    rows = [(1, "a b"), (2, None), (3, ""), (4, "a b"), (5, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "keep": F.lit(2)})
    out = bpe.decoded(bpe.encoded(df, BPE), BPE)
    assert out.columns == ["doc_id", "text", "ids", "keep", "decoded"]
    for row in out.collect():
        text = dict(rows)[row.doc_id] or ""
        assert row.ids == library.encode(text, add_special_tokens=False).ids and row.decoded == text
    assert bpe.decoded(bpe.encoded(df.limit(0), BPE), BPE).count() == 0
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decoded(none, BPE).first().decoded == ""


def test_a_large_vocabulary_is_refused(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        bpe.read_vocabulary(spark, BPE)


def test_op12_equals_the_library(spark, library):
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {row.doc_id: tuple(row)[1:] for row in bpe.op12_bpe(spark, data).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(text))


# --- manifest -----------------------------------------------------------------------------------
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def hand_leaf(row):
    values = [row[0], row[3], row[2], row[4], row[1]]
    cells = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return sha("".join(cells))


def hand_tree(leaves, fanout):
    """The root of one tree and the path of each leaf."""
    paths, levels = [[] for _ in leaves], [leaves]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)])
    for i, path in enumerate(paths):
        for level in levels[:-1]:
            run = level[i - i % fanout : i - i % fanout + fanout]
            path.append((run[: i % fanout], run[i % fanout + 1 :]))
            i //= fanout
    return levels[-1][0], paths


def hand_manifest(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault((row[2] is not None, (row[2] or "").encode()), []).append(row)
    trees = []
    for _, members in sorted(groups.items()):
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, hand_leaf(r)))
        trees.append((members, *hand_tree([hand_leaf(r) for r in members], fanout)))
    root, above = hand_tree([subroot for _, subroot, _ in trees], fanout)
    out = []
    for (members, subroot, paths), top in zip(trees, above, strict=True):
        for row, path in zip(members, paths, strict=True):
            proof = "".join("".join(before + after) for before, after in path + top)
            out.append((row[0], hand_leaf(row), subroot, root, sha(proof)))
    return sorted(out, key=repr)


def manifest_rows(df, fanout, changed=None):
    proofs = manifest.manifest(df, fanout=fanout, changed=changed)
    digests = (manifest.as_hex(F.col(name)).alias(name) for name in ("leaf", "subroot", "root"))
    same = manifest.folded(F.col("seen"), F.col("path")) == F.col("root")
    rows = proofs.select("doc_id", *digests, manifest.proof_digest(F.col("path")), same).collect()
    return sorted((tuple(r)[:5] for r in rows), key=repr), [r[5] for r in rows]


ODD = [
    (5, "Plain", "en", "web", 5), (5, "plain", "en", "web", 5), (5, "plain", "en", "web", 5),
    (None, "é😀", "en", None, None), (7, None, None, "web", 0), (8, "", None, "", 0),
    (9, "x" * 100_000, "de", "web", 1), (-3, "A", "Ä", "s", 1), (4, "b", "", "s", 1),
]


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_manifest_equals_brute_force(spark, fanout):
    rows = ODD + [(100 + i, f"t{i}", "en", "web", i) for i in range(70)]
    df = spark.createDataFrame(rows, DOCUMENTS).withColumns({"leaf": F.lit(1), "tree": F.lit("x"), "idx": F.lit(2)})
    got, verified = manifest_rows(df, fanout)
    assert got == hand_manifest(rows, fanout)
    assert all(verified)


@pytest.mark.parametrize("rows", [ODD[:1], ODD[4:5], ODD[1:3]])
def test_manifest_of_few_rows(spark, rows):
    got, verified = manifest_rows(spark.createDataFrame(rows, DOCUMENTS), 8)
    assert got == hand_manifest(rows, 8) and all(verified)


def test_manifest_of_nothing(spark):
    assert manifest_rows(spark.createDataFrame([], DOCUMENTS), 8) == ([], [])


def test_a_changed_field_does_not_verify(spark):
    df = spark.createDataFrame(ODD, DOCUMENTS)
    got, verified = manifest_rows(df, 8, {"text": F.lower("text")})
    assert got == hand_manifest(ODD, 8)
    changed = [row for row in ODD if row[1] is not None and row[1] != row[1].lower()]
    assert verified.count(False) == len(changed) == 2
