"""Token ids as Huffman-coded blocks.

A data set is a folder with two Parquet tables. ``codebook`` holds the code length of every id that occurs; lengths
come from the global counts, are limited to ``LIMIT`` bits by package-merge, and define the canonical codes. ``blocks``
holds runs of whole documents in ascending key order: keys, their token counts, the bit stream, and the bit offset of
every ``STEP``-th token. Blocks decode independently, and all checkpoints of a block at once, by table look-up.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.bpe import byte_alphabet
from seriesloom.llm.common import Remembered, freeing_shuffles, slices, written

LIMIT = 20
STEP = 128
BLOCK_TOKENS = 1 << 17
#: Words of a generation that a worker remembers: some 60 MB.
WORDS = 400_000


# ---- tokens


#: Characters that NFC leaves alone, whose case depends on nothing around them, and that are no white space.
_SIMPLE = re.compile("[!-~\u00a1-\u024f]+")


def _pattern(spec: str) -> str | None:
    """The splitting pattern of a tokenizer that lower-cases and then cuts out what matches, or None for any other."""
    parts = json.loads(spec)
    norm = (parts.get("normalizer") or {}).get("normalizers", [])
    pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    plain = sorted(n["type"] for n in norm) == ["Lowercase", "NFC", "Replace"]
    blank = any(n.get("pattern") == {"Regex": r"\s+"} and n.get("content") == " " for n in norm)
    cuts = pre[0].get("type") == "Split" and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and "Regex" in pre[0]["pattern"]
    level = len(pre) == 2 and pre[1].get("type") == "ByteLevel" and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
    return pre[0]["pattern"]["Regex"] if plain and blank and cuts and level else None


def _for_ascii(pattern: str) -> str | None:
    """The same pattern for lower-case ASCII in the standard module's syntax, if its properties stand in classes."""
    if r"\p" in re.sub(r"\[[^\]]*\]", "", pattern):
        return None
    plain = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
    return None if r"\p" in plain else plain


class WordEncoder:
    """Texts to packed ids with a tokenizer that drops white space between words.

    For such a tokenizer the ids of a text are those of its white-space separated words, one after another. Words are
    remembered in two generations of bounded size. New words of simple characters go to the library's model piece by
    piece, cut by the tokenizer's own pattern, since normalising changes nothing but their case; the others go through
    the whole tokenizer in one call, whose offsets tell which word an id belongs to.
    """

    def __init__(self, spec: str, kind: str = "<u4", limit: int = WORDS) -> None:
        self.tokenizer, self.kind, self.limit = _tokenizer(spec), kind, limit
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.is_added = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        pattern = _pattern(spec)
        self.find = pattern and regex.compile(pattern).findall
        plain = pattern and _for_ascii(pattern)
        self.find_ascii = re.compile(plain).findall if plain else self.find
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_alphabet().items()}
        self.pieces = Remembered(self._piece, limit)

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(text)]
        return pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def _whole(self, words: list[bytes]) -> dict[bytes, bytes]:
        text = [w.decode("utf-8", "replace") for w in words]
        found = self.tokenizer.encode(" ".join(text), add_special_tokens=False)
        starts = np.cumsum([len(t) + 1 for t in text])
        at = np.array([o[0] for o in found.offsets], np.int64)
        ids = np.array(found.ids, self.kind).tobytes()
        width = np.dtype(self.kind).itemsize
        ends = (np.searchsorted(at, starts, "left") * width).tolist()
        return {word: ids[a:b] for word, a, b in zip(words, [0, *ends], ends)}

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        if not self.find:
            return self._whole(words)
        out, rest = {}, []
        simple, is_added, piece = _SIMPLE.fullmatch, self.is_added, self.pieces.__getitem__
        for word in words:
            text = word.decode("utf-8", "replace").lower()
            if simple(text) and not is_added(text):
                found = self.find_ascii(text) if word.isascii() else self.find(text)
                out[word] = b"".join(map(piece, found))
            else:
                rest.append(word)
        return out | self._whole(rest) if rest else out

    def encode(self, data: bytes) -> bytes:
        words = data.split()
        young, old = self.young, self.old
        parts = list(map(young.get, words))
        if None in parts:
            gaps = [i for i, p in enumerate(parts) if p is None]
            unknown = []
            for word in {words[i] for i in gaps}:
                ids = old.get(word)
                if ids is None:
                    unknown.append(word)
                else:
                    young[word] = ids
            if unknown:
                young.update(self._learn(unknown))
            for i in gaps:
                parts[i] = young[words[i]]
        out = b"".join(parts)
        if len(young) > self.limit:
            self.young, self.old = {}, young
        return out


@lru_cache(maxsize=1)
def encoder(spec: str, kind: str) -> WordEncoder:
    """The encoder of this worker: what one task has learnt serves the next one."""
    return WordEncoder(spec, kind)


def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 2, kind: str = "<u4") -> DataFrame:
    """``doc, ids``: the ids of each whole text and the ``end`` id, packed as ``kind``. Null texts are empty texts."""
    spec = docs.sparkSession.sparkContext.broadcast(Path(path).read_text())  # a vocabulary file: a few MB, whatever the data
    last = np.array([end], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec.value, kind).encode
        for batch in slices(batches, "t"):
            ids = [encode(x or b"") + last for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc", "ids"])

    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("t"))
    return source.mapInArrow(run, "doc long, ids binary")


# ---- code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for symbols with these positive counts (package-merge)."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit in {limit} bits")
    if n == 1:
        return np.ones(1, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    merged, is_symbol = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_symbol.append(rank < n)
    take, lengths = 2 * (n - 1), np.zeros(n, np.int64)
    for level in reversed(is_symbol):
        symbols = int(level[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code: shorter codes first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        steps = np.left_shift(np.int64(1), LIMIT - lengths)
        starts = np.cumsum(steps) - steps
        size = int(ids.max()) + 1 if len(ids) else 0
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids] = (starts >> (LIMIT - lengths)).astype(np.uint64)
        self.length[ids] = lengths
        # Look-up by the next LIMIT bits; a code of one symbol leaves half of them without meaning.
        self.symbol, self.step = np.zeros((2, 1 << LIMIT), np.uint32)
        used = int(steps.sum())
        self.symbol[:used] = np.repeat(ids.astype(np.uint32), steps)
        self.step[:used] = np.repeat(lengths.astype(np.uint32), steps)

    def pack(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Bit stream and checkpoints."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n_words = int(ends[-1] // 64) + 2 if len(ids) else 1
        word, room = starts >> 6, 64 - (starts & 63)
        code = self.code[ids]
        over = np.maximum(lengths - room, 0).astype(np.uint64)
        high = np.where(over > 0, code >> over, code << np.maximum(room - lengths, 0).astype(np.uint64))
        out = np.zeros(n_words, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] = np.bitwise_or.reduceat(high, first)
            cut = np.flatnonzero(over)
            out[word[cut] + 1] |= code[cut] << (np.uint64(64) - over[cut])
        return out.astype(">u8").tobytes(), starts[::STEP].astype("<u4").tobytes()

    def unpack(self, bits: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block; one lane per checkpoint."""
        spare = STEP * LIMIT // 8 + 8  # lanes that are past their end read on into zeros
        raw = np.frombuffer(bits + bytes(spare), np.uint8).astype(np.uint32)
        windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.uint32)
        out = np.zeros((STEP, len(at)), np.uint32)
        shift = np.uint32(32 - LIMIT)
        for i in range(min(STEP, n)):
            seen = (windows[at >> 3] << (at & 7)) >> shift
            out[i] = self.symbol[seen]
            at = at + self.step[seen]
        return out.T.reshape(-1)[:n]


# ---- data set


def write(docs: DataFrame, tokenizer: str, path: str, key: str = "doc_id", text: str = "text", end: int = 2) -> None:
    """Encode ``docs`` and write the data set to ``path`` (a folder that all executors reach).

    Documents follow in ascending key order, null keys first, repeated keys by their ids. An empty table gives an
    empty data set.
    """
    spark = docs.sparkSession
    size = max(_tokenizer(Path(tokenizer).read_text()).get_vocab_size(with_added_tokens=True), end + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize
    coded = written(tokens(docs, tokenizer, key, text, end, kind), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in slices(batches, "ids"):
            part = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            total[: len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    totals = coded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = totals.orderBy("id").toPandas()  # one row per id of the vocabulary at most
    ids = rows["id"].to_numpy(np.int64)
    lengths = code_lengths(rows["n"].to_numpy(np.int64)) if len(ids) else np.zeros(0, np.int64)
    book = [(int(i), int(n)) for i, n in zip(ids, lengths, strict=True)]
    spark.createDataFrame(book, "id long, length long").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((ids, lengths))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*shared.value)
        keys: list[int | None] = []
        held: list[bytes] = []
        size = before = 0

        def close() -> pa.RecordBatch:
            counts = np.array([len(x) // width for x in held], np.int64)
            stream, checkpoints = code.pack(np.frombuffer(b"".join(held), kind))
            arrays = [[before], [size], [keys], [counts.tolist()], [stream], [checkpoints]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], _BLOCK)

        for batch in slices(batches, "ids"):
            for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(doc)
                held.append(packed)
                size += len(packed) // width
                if size >= BLOCK_TOKENS:
                    yield close()
                    keys, held, size, before = [], [], 0, before + size
        if held:
            yield close()

    ordered = coded.repartitionByRange("doc").sortWithinPartitions("doc", "ids")
    made = ordered.mapInArrow(blocks, "before long, tokens long, docs array<long>, counts array<long>, bits binary, checkpoints binary")
    with freeing_shuffles(spark):
        made.select(F.spark_partition_id().alias("part"), "*").write.parquet(f"{path}/blocks")


_BLOCK = ["before", "tokens", "docs", "counts", "bits", "checkpoints"]


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of each document of a data set: ids before it, ids with the end id, and those ids
    (packed as little-endian unsigned 32-bit)."""
    book = spark.read.parquet(f"{path}/codebook").orderBy("id").toPandas()  # a vocabulary at most
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").toPandas()  # a row per part written
    bases = dict(zip(parts["part"].tolist(), (parts["n"].cumsum() - parts["n"]).tolist(), strict=True))
    shared = spark.sparkContext.broadcast((book["id"].to_numpy(np.int64), book["length"].to_numpy(np.int64), bases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, bases = shared.value
        code = Code(ids, lengths)
        for batch in slices(batches, "bits", 1 << 20):
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                data = code.unpack(row["bits"], row["checkpoints"], row["tokens"]).astype("<u4").tobytes()
                each = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                base = bases[row["part"]] + row["before"]
                arrays = [pa.array(row["docs"], pa.int64()), pa.array(base + starts), pa.array(counts), pa.array(each, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, [key, "start", "n_tokens", "ids"])

    return blocks.select("part", *_BLOCK).mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids binary")
