from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesloom.llm import bpe, chat, mixing, quality, queries, token_output, warc
from seriesloom.llm.common import WordHashes, new_path, rolled
from tests.llm import brute
from tests.oracle import compare, connection

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "the", "Hello", "x-Y_z", "don't", "\x7f", "<|END", "  ", " ", "\n", "\t", "é", "ß", "日本", "<|endoftext|>", "'s", "'ll", "123", "!!!", "\x1c", "\x85", " ", "　", "aaaa", "́", "\U0001f600", "\r\n", "Ing", "​", "_", "Σ", "İ", "<|startoftext|>"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)


@pytest.fixture(scope="module")
def byte_encoder():
    with open(BYTE) as f:
        return bpe.Encoder(bpe.Vocabulary(f.read()))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bpe_equals_the_library(byte_encoder, byte_library, text):
    ids = byte_library.encode(text, add_special_tokens=False).ids
    packed = byte_encoder.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert byte_encoder.decode(packed) == byte_library.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=40) | st.text("aeinrst ", min_size=1, max_size=60).map(str.encode))
def test_prefix_programme_equals_rank_order_merging(byte_encoder, data):
    v = byte_encoder.vocabulary
    if not v.merges:
        v.prepare()
    ranks = {(v.bytes[x], v.bytes[y]): r for (x, y), r in v.merges.items()}
    assert [v.bytes[i] for i in v.encode_piece(data)] == brute.bpe(data, ranks)


def test_bpe_query_on_the_table(spark, sf, byte_library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        ids = byte_library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        want[doc_id] = (len(ids), hashlib.sha256(packed).hexdigest(), brute.sha(byte_library.decode(ids, skip_special_tokens=False)))
    found = queries.op3_bpe(spark, sf).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == want


def test_bpe_edges(make, edge):
    docs = make(edge).withColumn("ids", F.lit("own"))
    out = bpe.decode(bpe.encode(docs, BYTE), BYTE)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(r["decoded"] == (r["text"] or "") for r in rows.values())
    assert rows[0]["ids"] == rows[1]["ids"] == b""
    assert bpe.encode(docs.limit(0), BYTE).count() == 0


def test_bpe_refuses_other_files():
    with open(WORD) as f, pytest.raises(ValueError):
        bpe.Vocabulary(f.read())


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_words_encode_as_the_library_does(texts):
    encoder = _word_encoder()
    for text in texts:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == ids


def _word_encoder(kept=[]):  # noqa: B006
    if not kept:
        with open(WORD) as f:
            kept.append(token_output.WordEncoder(f.read()))
        kept[0].limit = 20
    return kept[0]


@pytest.mark.parametrize("n, vocabulary", [(1, 5), (100, 3), (127, 300), (128, 300), (5000, 1), (70_000, 40_000)])
def test_huffman_round_trip(n, vocabulary):
    ids = (np.random.default_rng(0).zipf(1.3, n) % vocabulary).astype("<u4")
    symbols, counts = np.unique(ids, return_counts=True)
    lengths = token_output.code_lengths(counts)
    assert lengths.max() <= token_output.LIMIT
    code = token_output.Code(symbols, lengths)
    bits, checkpoints = code.pack(ids)
    assert (code.unpack(bits, checkpoints, n) == ids).all()


def test_code_lengths_are_optimal_and_limited():
    assert token_output.code_lengths(np.array([1, 1, 2, 4, 8])).tolist() == [4, 4, 3, 2, 1]
    limited = token_output.code_lengths(np.array([1, 1, 2, 4, 8, 16, 32, 64]), 4)
    assert limited.max() == 4 and (2.0 ** -limited).sum() == 1
    with pytest.raises(ValueError):
        token_output.code_lengths(np.ones(5), 2)


def test_token_query_on_the_table(spark, sf):
    library = token_output._tokenizer(open(WORD).read())
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want, start = {}, 0
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = queries.op10_token_output(spark, sf).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in found} == want


def test_a_worker_learns_words_once(spark):
    """Tasks of one worker share what it has learnt, and the ids stay those of the library."""
    library, texts = Tokenizer.from_file(WORD), ["Hello wondrous x-Y_z", "wondrous <|endoftext|> Hello", None]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts * 2)], "doc_id long, text string").coalesce(1)
    found = {r["doc"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_output.tokens(docs, WORD).collect()}
    assert found == {i: [*library.encode(x or "", add_special_tokens=False).ids, 2] for i, x in enumerate(texts * 2)}
    spec = open(WORD).read()
    first = token_output.encoder(spec, "<u2")
    first.encode(b"Hello wondrous")
    again = token_output.encoder(str(spec.encode(), "utf-8"), "<u2")
    assert again is first and b"wondrous" in again.young
    assert token_output.encoder(spec, "<u4") is not first


def test_token_edges(spark, make, edge, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 500)
    path = new_path(spark, "tokens")
    token_output.write(make(edge + [(3, "one")]).withColumn("start", F.lit("own")), WORD, path)
    rows = token_output.read(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    path = new_path(spark, "tokens")
    token_output.write(make(edge).limit(0), WORD, path)
    assert token_output.read(spark, path).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, connection(sf), sf, queries.QUERIES[name], queries.ORACLES[name])


def test_quality_measures():
    h = WordHashes()
    get = lambda text: dict(zip(quality.SIGNALS, quality.measure(text.encode(), h), strict=True))
    assert get("")["n_words"] == 0 and get("")["base_failed"]
    clean = " ".join(f"w{i}" for i in range(60))
    assert get(clean)["kept"] and get(clean)["n_repeat_words"] == 0
    assert get("a b c x a b c")["n_repeat_words"] == 6
    assert get("a\n \na\nb\na")["n_dup_lines"] == 2
    assert get("#x $ é|é <>")["n_symbols"] == 5 and get("#x $ é|é <>")["word_chars"] == 8
    ten = " ".join(f"r{i}" for i in range(10))
    loud = f"{clean} {ten} {ten}"
    assert get(loud)["dup_10gram_chars"] == pytest.approx(sum(len(w) for w in ten.split()) / len(loud.replace(" ", "")))
    assert get(loud)["kept"] and not get(f"{loud} {ten}")["kept"] and not get(f"{loud} {ten}")["base_failed"]
    assert get("\n".join([clean] * 3))["dup_line_share"] == pytest.approx(2 / 3)


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 12))
def test_rolling_hashes_tell_windows_apart(values, n):
    hashes = np.array([0x9E37_79B9_7F4A_7C15 * (v + 7) % 2**64 for v in values], np.uint64)
    found = rolled(hashes, n)
    windows = [tuple(values[i : i + n]) for i in range(len(values) - n + 1)]
    assert len(found) == len(windows)
    assert len(set(found.tolist())) == len(set(windows))


def test_quality_edges(make, edge):
    docs = make(edge).withColumn("KEPT", F.lit("own"))
    out = quality.with_signals(docs)
    assert out.count() == len(edge) and "KEPT" not in out.columns
    kept = quality.passing(docs)
    assert kept.columns == docs.columns and {r["KEPT"] for r in kept.collect()} <= {"own"}
    assert quality.with_signals(docs.limit(0)).count() == 0


def test_mix_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # budget 2415, weights 3 1 2 3: a stops at 200 and c at 20, and b : null = 1 : 3 until null stops at 1000
    assert found == {"a": 200.0, "c": 20.0, None: 1000.0, "b": 1195.0}


def test_mix_edges_and_order(make, edge):
    docs = make([*edge, (20, "x " * 50, None), (21, "y " * 40, None), (22, "z " * 30, "zz")]).withColumn("taken", F.lit("own"))
    out = mixing.mix(docs).cache()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == docs.count()
    assert rows[0]["size"] == 0 and rows[0]["positions"] == []
    assert all(r["taken"] <= 2 * r["size"] and len(r["positions"]) * r["size"] == r["taken"] for r in rows.values())
    assert all(0 <= p <= 1 for r in rows.values() for p in r["positions"])
    order = [r["position"] for r in mixing.training_order(out).collect()]
    assert order == sorted(order) and len(order) == sum(len(r["positions"]) for r in rows.values())
    assert mixing.mix(docs.limit(0)).count() == 0
    again = {r["doc_id"]: r["positions"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {i: r["positions"] for i, r in rows.items()}


def test_due_times_invert_the_schedule(spark):
    shares = [i / 20 for i in range(21)]
    df = spark.createDataFrame([(s, r) for s in shares for r in range(3)], "s double, r int")
    for r in df.select("s", "r", mixing.due_time(F.col("s"), F.col("r")).alias("t")).collect():
        times, factors = zip(*mixing.SCHEDULE, strict=True)
        grid = np.linspace(0, r["t"], 2001)
        weight = np.interp(grid, times, [f[r["r"]] for f in factors])
        whole = np.interp(np.linspace(0, 1, 2001), times, [f[r["r"]] for f in factors])
        assert np.trapezoid(weight, grid) / np.trapezoid(whole, np.linspace(0, 1, 2001)) == pytest.approx(r["s"], abs=1e-5)


def test_chat_log_folds(spark):
    log = [
        (1, 1, "m1", "message", "user", "hi"),
        (1, 2, "m2", "delta", "assistant", "wro"),
        (1, 3, "m2", "delta", None, "ng"),
        (1, 4, "m2", "regenerate", None, None),
        (1, 5, "m2", "delta", None, "ri"),
        (1, 6, "m2", "delta", None, "ght <|im_end|> \\"),
        (1, 7, "m1", "edit", None, "hello"),
        (1, 8, "m1", "delta", None, "!"),
        (None, 1, "m", "message", "assi\nst<|x", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message string, kind string, role string, text string").repartition(3)
    formatted = chat.format_log(events)
    rows = sorted(chat.parse(formatted).collect(), key=lambda r: (r["conv_id"] or 0, r["turn"]))
    assert [(r["conv_id"], r["role"], r["text"], r["loss"]) for r in rows] == [
        (None, "assi\nst<|x", "", None),
        (1, "user", "hello!", None),
        (1, "assistant", "right <|im_end|> \\", "right <|im_end|> \\"),
    ]
    assert chat.format_log(events.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown event kind"):
        chat.format_log(events.withColumn("kind", F.lit("odd"))).collect()


def test_chat_escapes_are_reversible(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["\\", "<", "|", ">", "n", "\n", "<|im_start|>", "x", "日"]) for _ in range(rnd.randint(0, 14))) for _ in range(300)]
    rows = [(i, 0, t, t) for i, t in enumerate(texts)] + [(i, 1, "assistant", t) for i, t in enumerate(texts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["turn"]): r for r in chat.parse(chat.format_log(chat.events_of_turns(turns))).collect()}
    for i, t in enumerate(texts):
        assert (found[i, 0]["role"], found[i, 0]["text"], found[i, 0]["loss"]) == (t, t, None)
        assert found[i, 1]["loss"] == t


def test_warc_round_trip_in_small_ranges(spark):
    rnd = random.Random(6)
    noise = lambda n: "".join(rnd.choice("abcdefghij é<>\r\n") for _ in range(n))
    big = noise(3000)
    pages = [(1, "http://a/ x\n", None), (2, None, ""), (3, "http://b/é", big), (9, "u", big), (7, "u", big), (4, "u", "short"), (5, "u", "short"), (9, "u", big)]
    pages += [(100 + i, "u", noise(rnd.randint(0, 5000))) for i in range(150)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = new_path(spark, "warc")
    warc.write(df, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = warc.read(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == len(pages)
    kinds = [(r["record_id"], r["record_type"], r["refers_to"]) for r in found if r["record_id"] in (3, 4, 5, 7, 9)]
    assert sorted(kinds, key=str) == sorted([(3, "revisit", 9), (7, "revisit", 9), (9, "response", None), (9, "response", None), (4, "response", None), (5, "response", None)], key=str)
    texts = {i: (t or "").encode() for i, _, t in pages}
    for r in found:
        assert r["payload_length"] == len(texts[r["record_id"]])
        assert r["payload_digest"] == hashlib.sha1(texts[r["record_id"]]).hexdigest()
        assert r["payload"] == (None if r["record_type"] == "revisit" else texts[r["record_id"]])


def test_warc_survives_chance_magic(spark, monkeypatch):
    """Magic inside a member, at every range size: stored members hold their content as it is."""
    plain = lambda data: zlib.compress(data, 0, 31)
    monkeypatch.setattr(warc, "_member", plain)
    pages = [(i, "u", None) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html binary")
    body = F.concat(F.lit(b"x"), F.unhex(F.lit("1F8B08")), F.lit(b"y" * 90), F.unhex(F.lit("1F8B0800")), F.lit(b"WARC"))
    path = new_path(spark, "warc")
    rows = [warc._record(i, "u", b"x" + warc.MAGIC + b"y" * 90 + warc.MAGIC + b"\0WARC%d" % i, "00" * 20, None, b"d")[:-1] for i in range(40)]
    made = spark.createDataFrame([(bytearray(r),) for r in rows], "value binary").repartition(2)
    assert df.count() and body is not None
    made.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("211", "500", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = {r["record_id"]: r["payload"] for r in warc.read(spark, path).collect()}
            assert len(found) == 40 and all(p.endswith(b"WARC%d" % i) for i, p in found.items())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_warc_of_nothing(spark):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0


def test_warc_reads_archives_of_others(spark, tmp_path):
    """A .warc.gz as other tools write it: own ids, chunked and compressed bodies, a damaged and a cut-off member."""

    def record(name: str, http: bytes, kind: str = "response", more: str = "") -> bytes:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{name}>\r\n{more}"
        head += f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
        return gzip.compress(head.encode() + http + b"\r\n\r\n")

    plain = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n"
    packed = gzip.compress(b"zipped body " * 50)
    chunked += b"%x\r\n%s\r\n%x;a=b\r\n%s\r\n0\r\n\r\n" % (10, packed[:10], len(packed) - 10, packed[10:])
    bad = bytearray(record("bad", b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * 40))
    bad[-5] ^= 255
    whole = [record("a", plain, more="WARC-Payload-Digest: sha1:zzz\r\n"), bytes(bad), record("b", chunked), record("c", b"", "revisit", "WARC-Refers-To: <urn:uuid:a>\r\n")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(whole) + record("d", plain)[:60])
    rows = warc.read(spark, str(tmp_path)).collect()
    found = {r["record_uri"]: r for r in rows if r["record_type"] != "damaged"}
    assert {k: v["payload"] for k, v in found.items()} == {"<urn:uuid:a>": b"hello", "<urn:uuid:b>": b"zipped body " * 50, "<urn:uuid:c>": None}
    assert found["<urn:uuid:c>"]["refers_to_uri"] == "<urn:uuid:a>" and found["<urn:uuid:a>"]["payload_digest"] is None
    assert [r["record_type"] for r in rows].count("damaged") == 2


def test_warc_large_payloads_and_null_keys(spark):
    noise = np.random.default_rng(1).integers(33, 126, 17 << 20, dtype=np.uint8).tobytes().decode()
    df = spark.createDataFrame([(1, "u", noise), (None, "u", "x"), (2, None, noise)], "page_id long, url string, html string")
    path = new_path(spark, "warc")
    warc.write(df, path)
    found = {r["record_id"]: r for r in warc.read(spark, path).collect()}
    assert found[2]["payload"] == noise.encode() and found[1]["refers_to"] == 2 and found[None]["payload"] == b"x"
