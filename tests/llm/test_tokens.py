"""BPE by prefix tables and token files, against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from ampora.llm import token_files
from ampora.llm.bpe import SuffixAutomaton, bpe_digests, encode, tokenizer
from ampora.llm.range_coder import HEAD, block_size, decode_block, encode_block
from ampora.llm.token_files import Encoder, read_tokens, token_file_digests, write_tokens
from ampora.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "\n", "a", "Hello, world.\nIt's 2024!", "x  y\t\tz ", "<|endoftext|>", "a<|endoftext|> b<|endo",
         "naïve Straße éàü 中文字 🙂🙂 ﬁ", "aaaaaaaaaaaaaaaaaaaaaaaaa", "\u00a0x\u2003y\x1cz\x00", "1234567 ½ Ⅷ",
         "word " * 3000, "q" * 5000, "THE!! END!!\n\n\n  indented\r\n"]


LIBRARY = Library.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_suffix_automaton_finds_every_word_that_ends_at_a_position():
    words = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"cab", b"bcab"]
    auto = SuffixAutomaton(words)
    text, state, have = b"abcabcab", 0, 0
    for i, byte in enumerate(text, 1):
        while byte not in auto.step[state]:
            state = auto.link[state]
            have = auto.depth[state]
        state, have = auto.step[state][byte], have + 1
        found, at = set(), state
        while at > 0:
            found |= {words[n] for size, n in auto.ends.get(at, ()) if size <= have}
            at = auto.up[at]
        assert found == {w for w in words if text[:i].endswith(w)}


def test_encoding_equals_the_library():
    tok = tokenizer(PATH)
    rng = random.Random(5)
    parts = ["a", "the", " the", "  ", "\n", "\t", "é", "ß", "中", "🙂", "1", " 12", "'s", "n't", ".", ",", "!!", "_", "ing", "\u00a0",
             "tion", "Qu", "xq", "<|endoftext|>", "\u0301"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(2000)]
    for text, ids in zip(texts, tok.encode_all(texts), strict=True):
        assert ids.tolist() == library_ids(text), text[:80]
        assert tok.decode(ids.tolist()) == text


def test_digests_for_nulls_long_texts_and_repeated_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, None, "x"), (None, "a", "y")]
    got = bpe_digests(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in enumerate(TEXTS):
        ids = library_ids(t)
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_digests(empty, PATH).collect() == []
    with pytest.raises(ValueError, match="token_ids"):
        encode(empty.withColumn("Token_IDs", F.lit(1)), PATH)


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 257, 5000])
@pytest.mark.parametrize("top", [1, 3, 50_000])
def test_range_coder_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    ids = (rng.integers(0, top, n) * rng.integers(0, 2, n)).astype(np.uint32)
    block = encode_block(ids)
    head, body = block[:HEAD.size], block[HEAD.size:]
    assert block_size(head) == len(body)
    assert (decode_block(head, body) == ids).all()


def test_range_coder_learns_and_detects_damage():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    block = encode_block(ids)
    assert len(block) < len(ids) // 2                       # under four bits an id, where order 0 needs 5.6
    block = encode_block(np.random.default_rng(4).integers(0, 50_000, 5000).astype(np.uint32))
    damaged = bytearray(block)
    damaged[len(block) // 2] ^= 0xFF
    with pytest.raises(ValueError, match="checksum"):
        decode_block(bytes(damaged[:HEAD.size]), bytes(damaged[HEAD.size:]))


def test_token_files_place_documents_in_one_stream(spark):
    rows = [(i * 3 % len(TEXTS), TEXTS[i * 3 % len(TEXTS)]) for i in range(len(TEXTS))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in token_file_digests(docs, PATH).collect()}
    start = 0
    for i, t in enumerate(TEXTS):
        ids = np.array([*library_ids(t), 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_null_and_repeated_ids_and_of_nothing(spark):
    docs = spark.createDataFrame([(7, "b"), (None, "n"), (7, "a"), (7, "a")], "doc_id long, text string")
    folder = scratch_path(spark, "t")
    back = read_tokens(write_tokens(docs, folder, PATH), folder).orderBy("start").collect()
    ids = [np.frombuffer(r.ids, "<u4")[:-1].tolist() for r in back]
    assert [r.doc_id for r in back] == [None, 7, 7, 7]
    assert ids == [library_ids(t) for t in ("n", "a", "a", "b")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_file_digests(empty, PATH).collect() == []


@pytest.mark.parametrize("entries", [token_files.CACHE_ENTRIES, 300])
def test_token_file_encoder_equals_the_library(monkeypatch, entries):
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", entries)
    rng, encoder = random.Random(6), Encoder(PATH)
    parts = ["a", "the", " the", " a", " 1,", "  ", "\n", "\t", "é", "中", "🙂", "1", " 12", "'s", "n't", ".", ",", "!!", "\u00a0", "\u2003",
             "\x1c", "\x85", "\x0b", "\r", "ing", " xq", "<|endoftext|>", "\u0301", " "]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(parts[:rng.choice([5, len(parts)])], k=rng.randrange(14))) for _ in range(4000)]
    for at in range(0, len(texts), 500):
        want = [[*library_ids(t), 0] for t in texts[at:at + 500]]
        ids, counts = encoder.encode(pa.array(texts[at:at + 500]))
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


def test_the_library_is_asked_for_new_units_only_and_for_several_at_once(monkeypatch):
    encoder, asked = Encoder(PATH), []
    ask = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda texts: asked.extend(texts) or ask(texts))
    words = [f"w{i}x" for i in range(900)]
    encoder.encode(pa.array(["first " + " ".join(words)]))
    assert len(asked) == 1 + 900 // token_files.JOINED      # 901 single units before
    asked.clear()
    encoder.encode(pa.array(["first " + " ".join(reversed(words))] * 3))
    assert asked == ["first"] * 3


def test_pieces_of_a_batch_have_every_row(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES", 10)
    for texts in ([], [""], ["", ""], ["a" * 30], ["a" * 30, "", "b" * 4, "c" * 9, "d"], ["ab"] * 20):
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
        pieces = [p["text"].to_pylist() for p in token_files._pieces(batch)]
        assert [t for p in pieces for t in p] == texts
        assert all(len(p) == 1 or sum(map(len, p)) <= 10 for p in pieces)
