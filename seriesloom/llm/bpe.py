"""Byte-level BPE encoding and decoding.

The encoder works prefix by prefix. For every prefix of a piece there is exactly one token that its encoding ends
with. An automaton over the vocabulary gives the longest token that is a suffix of the prefix, and each token knows
its longest proper suffix that is a token. The first of these whose predecessor (the last token of the remaining
prefix) is compatible with it is the one; following the stored tokens back from the end gives the ids.

Two adjacent tokens are compatible if the merges, applied in rank order, build both of them and never join across the
boundary. Going back in time from the finished pair, the token that was built later comes apart first; a merge of the
two pieces at the boundary matters if it ranks before both pieces' next merge.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Aside, Remembered, slices

#: The published splitting pattern of this family of vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same for ASCII, in the standard module's syntax (whose ``\s`` holds four more characters).
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
NEVER = 1 << 60
#: What a generation of a worker's caches holds: words with their punctuation, pieces, and compatible pairs of tokens.
#: Two generations take some 100 MB in all.
CHUNKS, PIECES, PAIRS = 150_000, 100_000, 150_000
LATE_SPACE = re.compile(r"\s ")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary read from the JSON text of a ``tokenizers`` file."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model, pre, norm = spec["model"], spec["pre_tokenizer"], spec["normalizer"]
        if model["type"] != "BPE" or norm or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only byte-level BPE files without normalizer and prefix space are supported")
        if any(a[k] for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must match literally")
        alphabet = byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        self._merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        ids = {as_bytes(s): i for s, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = 1 + max(*ids.values(), *self.added.values())
        self.bytes = [b""] * size
        for s, i in ids.items():
            self.bytes[i] = s
        for s, i in self.added.items():
            self.bytes[i] = s.encode()
        self.length = [len(s) for s in self.bytes]
        self.go: dict[int, int] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def prepare(self) -> None:
        """Build what only encoding needs: the merges by rank, and a trie of the tokens with failure links.

        ``longest[state]`` is the longest token that is a suffix of what the state has read.
        """
        added, alphabet, size = set(self.added.values()), byte_alphabet(), len(self.bytes)
        known = {s: i for i, s in enumerate(self.bytes) if s and i not in added}
        self.birth, self.left, self.right = [-1] * size, [0] * size, [0] * size
        for rank, pair in enumerate(self._merges):
            a, b = (bytes(alphabet[c] for c in part) for part in pair)
            x, y, z = known[a], known[b], known[a + b]
            if self.birth[z] >= 0 or max(self.birth[x], self.birth[y]) >= rank:
                raise ValueError("each token needs one merge, after those of its parts")
            self.merges[x, y] = rank
            self.birth[z], self.left[z], self.right[z] = rank, x, y
        self._merges = []
        ids = {s: i for s, i in known.items() if len(s) == 1 or self.birth[i] >= 0}
        go: dict[int, int] = {}
        token = [-1]
        order: list[tuple[int, int, int]] = []
        for s, i in sorted(ids.items()):
            state = 0
            for b in s:
                nxt = go.get(state << 8 | b)
                if nxt is None:
                    nxt = go[state << 8 | b] = len(token)
                    token.append(-1)
                    order.append((state, b, nxt))
                state = nxt
            token[state] = i
        depth = [0] * len(token)
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        fail, longest = [0] * len(token), token[:]
        self.shorter = [-1] * len(self.bytes)
        for parent, b, node in sorted(order, key=lambda x: depth[x[2]]):
            if parent:
                at = fail[parent]
                while at and (at << 8 | b) not in go:
                    at = fail[at]
                fail[node] = go.get(at << 8 | b, 0)
            if token[node] >= 0:
                self.shorter[token[node]] = longest[fail[node]]
            else:
                longest[node] = longest[fail[node]]
        self.trie, self.go, self.fail, self.longest = go, dict(go), fail, longest

    def _apart(self, x: int, y: int, until: int = NEVER) -> bool:
        """Whether no merge joins the last piece of ``x`` and the first piece of ``y`` before rank ``until``."""
        x_ends = y_ends = until
        while True:
            rank = self.merges.get((x, y), NEVER)
            if rank < x_ends and rank <= y_ends:
                return False
            if self.birth[x] < 0 and self.birth[y] < 0:
                return True
            if self.birth[x] > self.birth[y]:
                x_ends, x = self.birth[x], self.right[x]
            else:
                y_ends, y = self.birth[y], self.left[y]

    def fits(self, x: int, y: int) -> bool:
        key = x << 32 | y
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            known = self._fits[key] = self._apart(x, y)
        return known

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it."""
        known = self._whole.get(token)
        if known is None:
            known = self.birth[token] < 0 or (
                self.whole(self.left[token])
                and self.whole(self.right[token])
                and self._apart(self.left[token], self.right[token], self.birth[token])
            )
            self._whole[token] = known
        return known

    def _step(self, state: int, b: int) -> int:
        """The state after reading ``b``; found through the failure links once, then kept as a direct transition."""
        at, trie = state, self.trie
        while at and (at << 8 | b) not in trie:
            at = self.fail[at]
        to = self.go[state << 8 | b] = trie.get(at << 8 | b, 0)
        return to

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one piece (which no merge crosses)."""
        if not self.go:
            self.prepare()
        go, longest, shorter, length, fits = self.go, self.longest, self.shorter, self.length, self._fits
        last = [0] * (len(data) + 1)
        state, end = 0, 0
        for b in data:
            end += 1
            try:
                state = go[state << 8 | b]
            except KeyError:
                state = self._step(state, b)
            token = longest[state]
            while True:
                start = end - length[token]
                if start:
                    before = last[start]
                    try:
                        if fits[before << 32 | token]:
                            break
                    except KeyError:
                        if self.fits(before, token):
                            break
                elif self.whole(token):
                    break
                token = shorter[token]
            last[end] = token
        ids = []
        while end:
            ids.append(last[end])
            end -= length[last[end]]
        return ids[::-1]


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.find = regex.compile(PATTERN).findall
        self.find_ascii = re.compile(ASCII_PATTERN).findall
        self.pieces = Remembered(self._piece, PIECES)
        self.spaced = Remembered(lambda s: self._split(" " + s), CHUNKS)
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.added, key=len, reverse=True))) + ")")

    def _piece(self, piece: str) -> bytes:
        ids = self.vocabulary.encode_piece(piece.encode())
        return pack(f"<{len(ids)}I", *ids)

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find_ascii(text) if text.isascii() else self.find(text)))

    def _plain(self, text: str) -> bytes:
        # A piece never holds white space after other characters, so that a text may be cut before each space that
        # follows a non-space character. That holds for all its spaces unless white space stands before one.
        if LATE_SPACE.search(text):
            return self._split(text)
        first, *rest = text.split(" ")
        return self._split(first) + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.vocabulary.added):
            return self._plain(text)
        parts = self.split_added.split(text)
        added = self.vocabulary.added
        return b"".join(np.array([added[p]], "<u4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(text: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hash(text)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Vocabulary(text))
    return _ENCODERS[key]


def _mapped(df: DataFrame, path: str, column: str, cast: str, outs: dict[str, str], make, keep=None) -> DataFrame:
    """``df`` with the columns ``outs`` (name -> type) that ``make(encoder)`` computes from ``column``."""
    text = df.sparkSession.sparkContext.broadcast(Path(path).read_text())  # a vocabulary file: a few MB, whatever the data
    aside = Aside(df)
    df, column, keep = aside.docs, aside[column], aside.kept(outs, keep)
    schema = df.select(*keep).schema
    for name, kind in outs.items():
        schema = schema.add(name, kind)
    kinds = [{"binary": pa.binary(), "string": pa.string()}[kind] for kind in outs.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make(_encoder(text.value))
        for batch in slices(batches, "_in"):
            at = batch.schema.get_field_index("_in")
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            found = zip(*[one(x) for x in batch.column(at).to_pylist()], strict=True)
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, found, kinds)], [*keep, *outs])

    return aside.back(df.select(*keep, F.col(column).cast(cast).alias("_in")).mapInArrow(run, schema), outs)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a binary column ``out``: the ids of each whole text, little-endian unsigned 32-bit.

    ``path`` names a byte-level BPE file of the ``tokenizers`` library on the driver. Null texts are empty texts.
    A column named ``out`` is replaced; all others pass through, one output row per input row, repeated rows too; an
    empty table gives an empty one. Texts may be of any length that one Arrow string holds (2 GB).
    """
    return _mapped(docs, path, text, "string", {out: "binary"}, lambda e: lambda x: (e.encode(x or ""),))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with a string column ``out``: the text of the packed ids, special tokens included.

    Null ids give an empty text; bytes that are not UTF-8 become U+FFFD.
    """
    return _mapped(encoded, path, ids, "binary", {out: "string"}, lambda e: lambda x: (e.decode(x or b""),))


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", out: str = "ids", back: str = "decoded", keep: Sequence[str] | None = None
) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, which needs one Python worker per task; ``keep`` names the
    columns that pass through (all by default)."""

    def both(e: Encoder):
        def one(x: str | None) -> tuple[bytes, str]:
            ids = e.encode(x or "")
            return ids, e.decode(ids)

        return one

    return _mapped(docs, path, text, "string", {out: "binary", back: "string"}, both, keep)
