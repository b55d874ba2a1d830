"""Byte-pair encoding and decoding with a public vocabulary.

A text is cut at added tokens, then into pieces by the vocabulary's pattern; each piece is merged
on its own. A segment tree stands over the ranks of its adjacent pairs: the root yields the
leftmost pair of the lowest rank, and a merge updates three leaves and their ancestors, until no
pair can be merged. So a piece of n bytes takes n log n steps, also one of a hundred thousand
characters without a blank. Pieces repeat, so every worker remembers the ids of the short pieces
it has merged, up to ``REMEMBERED`` (some 30 MB); longer ones are merged each time.

The vocabulary is a file of bounded size (``MAX_VOCABULARY`` bytes, else refused). The driver reads
it and broadcasts it, so executors need no file. Encoding is per row: nothing is shuffled, and a
task holds one Arrow batch.

Nulls and edge cases: a null text is encoded like an empty one, to no ids, and null or empty ids
decode to an empty text. Added tokens inside a text become their ids, as the library does it unless
told otherwise. A text is UTF-8 and may hold any character, NUL included; ids that do not form
UTF-8 decode to replacement characters; ids outside the vocabulary are skipped. Ties between
pairs of equal rank go to the leftmost. Repeated rows give equal results; empty tables give empty
ones. Other columns are kept, but for one of the output's name, which is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cache, cached_property
from itertools import pairwise
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.json"
MAX_VOCABULARY = 64 * 2**20
REMEMBERED = 2**17
LONGEST_REMEMBERED = 64

# --- Fixed values: the pattern that cuts texts, with its character classes as parameters --------
PATTERN = (
    "'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{blanks}{letters}{digits}]+"
    "|[{blanks}]+(?![^{blanks}])|[{blanks}]+"
)
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# ------------------------------------------------------------------------------------------------
BEYOND_PLANE_0 = re.compile("[\U00010000-\U0010ffff]")


class SegmentTree:
    """Minimum over leaves that can be changed one by one."""

    def __init__(self, leaves: list[int], empty: int):
        self.size = size = 1 << (len(leaves) - 1).bit_length() if leaves else 1
        self.nodes = nodes = [empty] * size + leaves + [empty] * (size - len(leaves))
        for i in range(size - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left < right else right

    def lowest(self) -> int:
        return self.nodes[1]

    def change(self, leaf: int, value: int) -> None:
        nodes = self.nodes
        i = leaf + self.size
        nodes[i] = value
        while i > 1:
            low, other = nodes[i], nodes[i ^ 1]
            i >>= 1
            low = other if other < low else low
            if nodes[i] == low:
                return
            nodes[i] = low


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``symbols`` with all pairs merged, lowest rank first, the leftmost of equal ones first.

    ``merges`` gives rank and product of a pair. A leaf holds rank * n + position of the pair that
    starts there, so the lowest leaf names its place.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    none = len(merges) * n + n

    def leaf(at: int, after: int) -> int:
        found = merges.get((symbols[at], symbols[after]))
        return found[0] * n + at if found else none

    tree = SegmentTree([leaf(i, i + 1) for i in range(n - 1)], none)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (low := tree.lowest()) < none:
        at = low % n
        gone = after[at]
        symbols[at] = merges[symbols[at], symbols[gone]][1]
        symbols[gone] = -1
        after[at] = following = after[gone]
        if gone < n - 1:
            tree.change(gone, none)
        if following < n:
            before[following] = at
            tree.change(at, leaf(at, following))
        else:
            tree.change(at, none)
        if before[at] >= 0:
            tree.change(before[at], leaf(before[at], at))
    return [symbol for symbol in symbols if symbol >= 0]


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary's token texts."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    shifted = {b: chr(256 + i) for i, b in enumerate(others)}
    return {b: chr(b) for b in printable} | shifted


@cache
def piece_pattern(end: int) -> re.Pattern:
    """The pattern for texts of characters below ``end``.

    Letters and digits are what Python's character database has as such. One pattern for all
    characters would be slow: large sets are looked up in a bitmap only below 2**16.
    """

    def spans(kind: str) -> str:
        marks = [i for i in range(end) if unicodedata.category(chr(i))[0] == kind]
        starts = [b for a, b in pairwise([-2, *marks]) if b != a + 1]
        ends = [a for a, b in pairwise([*marks, end + 1]) if b != a + 1]
        return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(starts, ends, strict=True))

    return re.compile(PATTERN.format(letters=spans("L"), digits=spans("N"), blanks=BLANKS))


class Remembered(dict):
    """The ids of pieces, four bytes each; those of short ones are kept.

    They are kept in two generations: when the recent one is full it becomes the older one, and what
    is met again there moves back.
    """

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of, self.older = ids_of, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.ids_of(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class Vocabulary:
    """Merges, token texts and added tokens of a byte-level vocabulary file."""

    def __init__(self, content: bytes):
        self.content = content

    @property
    def parsed(self) -> dict:
        """Read anew for each use: kept, it would fill more memory than what is taken from it."""
        return json.loads(self.content)

    @cached_property
    def added(self) -> dict[str, int]:
        return {token["content"]: token["id"] for token in self.parsed["added_tokens"]}

    @cached_property
    def cut(self) -> re.Pattern:
        tokens = sorted(self.added, key=len, reverse=True)
        return re.compile(f"({'|'.join(map(re.escape, tokens))})" if tokens else "((?!))")

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        byte_of = {c: b for b, c in byte_characters().items()}
        ids = self.parsed["model"]["vocab"]
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        return tokens | {i: token.encode() for token, i in self.added.items()}

    @cached_property
    def pieces(self) -> Remembered:
        model = self.parsed["model"]
        ids, characters = model["vocab"], byte_characters()
        first = [ids[characters[b]] for b in range(256)]
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[left], ids[right]] = (rank, ids[left + right])
        return Remembered(
            lambda piece: array("i", merged([first[b] for b in piece.encode()], merges)).tobytes()
        )

    def encode(self, text: str) -> array:
        pattern = piece_pattern(0x110000 if BEYOND_PLANE_0.search(text) else 0x10000)
        ids = array("i")
        for part in self.cut.split(text):
            if part in self.added:
                ids.append(self.added[part])
            else:
                ids.frombytes(b"".join(map(self.pieces.__getitem__, pattern.findall(part))))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.get, ids)).decode("utf-8", "replace")


@cache
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file for the functions below, read by the driver."""
    file = Path(path)
    if file.stat().st_size > MAX_VOCABULARY:
        raise ValueError(f"vocabulary of more than {MAX_VOCABULARY} bytes: {path}")
    return spark.sparkContext.broadcast(file.read_bytes())


def _ids_of(texts: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """A list of ids for each text, built from one flat buffer."""
    flat, ends = array("i"), array("i", [0])
    for text in texts:
        value = text.as_py()
        if value:
            flat.extend(vocabulary.encode(value))
        ends.append(len(flat))
    values = pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)])
    offsets = pa.Array.from_buffers(pa.int32(), len(ends), [None, pa.py_buffer(ends)])
    return pa.ListArray.from_arrays(offsets, values)


def encoder(vocabulary: Broadcast) -> Callable[[Column], Column]:
    """A column function: text to ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _vocabulary(vocabulary.value)
        for texts in batches:
            yield _ids_of(texts, known)

    return encode


def decoder(vocabulary: Broadcast) -> Callable[[Column], Column]:
    """A column function: ids to text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _vocabulary(vocabulary.value)
        for ids in batches:
            flat = ids.values.to_numpy(zero_copy_only=False)
            ends = ids.offsets.to_numpy()
            yield pa.array(
                [known.decode(flat[a:b].tolist()) for a, b in pairwise(ends)], pa.string()
            )

    return decode


def encoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text``, never null."""
    encode = encoder(read_vocabulary(df.sparkSession, path))
    return df.withColumn(ids, encode(F.col(f"`{text}`")))


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for, never null."""
    decode = decoder(read_vocabulary(df.sparkSession, path))
    none = F.array().cast("array<int>")
    return df.withColumn(text, decode(F.coalesce(F.col(f"`{ids}`"), none)))


def op12_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decoded(encoded(docs, path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
