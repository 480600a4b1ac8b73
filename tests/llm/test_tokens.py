import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from memloom.llm import bpe_stream, token_files

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
BITS = ["hello", "World", " ", "  ", "\n", "\t", "́", "e", "ß", "Σ", "İ", "١", "9", "42", "'s", "'re", "'", "!!", "#", "<|endoftext|>", "<|", "日本語", "한국",
        "ᄒ", "ᅡ", "\x1c", "\x85", " ", "\xa0", "𝒳", "ﬁ", "Ǆ", "_", "े", "न", "\x00"]


def texts(n=400):
    rng = random.Random(0)
    own = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [None, "", " ", "a" * 30_000, "".join(rng.choice("abcdehinort") for _ in range(20_000)), "word " * 9_000, *own]


@pytest.fixture(scope="module")
def merges():
    return bpe_stream.MergeList(WORD)


def test_encoder_equals_library(merges):
    library, own = Tokenizer.from_file(WORD), bpe_stream.StreamingEncoder(merges)
    for text in texts():
        want = library.encode(text or "", add_special_tokens=False).ids
        ids = memoryview(b"".join(own.stream([text or ""]))).cast("I").tolist()
        assert ids == want
        decoder = bpe_stream.IncrementalDecoder(merges)
        parts = "".join(decoder.feed(ids[k : k + 3]) for k in range(0, len(ids), 3)) + decoder.finish()
        assert parts == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("part", [16, 40, 1 << 16])
def test_stream_in_parts_equals_library(merges, part):
    library, own = Tokenizer.from_file(WORD), bpe_stream.StreamingEncoder(merges)
    own.PART = part
    for text in texts():
        text = text or ""
        stream = own.stream(text[k : k + 7] for k in range(0, len(text), 7))
        assert memoryview(b"".join(stream)).cast("I").tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_equals_library(merges):
    """In words of their own, inside of words, and where a part ends."""
    library, own = Tokenizer.from_file(WORD), bpe_stream.StreamingEncoder(merges)
    slow = bpe_stream.StreamingEncoder(merges)
    slow.PART = 24
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(1)
    for at in range(0, len(every), 128):
        own_signs = every[at : at + 128]
        text = " ".join(f"a{c}b {c} {c}9" for c in own_signs)
        mixed = "".join(rng.choice([c, c + "ab", rng.choice(every)]) for c in own_signs)
        for said in (text, mixed):
            want = library.encode(said, add_special_tokens=False).ids
            assert memoryview(b"".join(own.stream([said]))).cast("I").tolist() == want, at
        assert memoryview(b"".join(slow.stream(mixed[k : k + 5] for k in range(0, len(mixed), 5)))).cast("I").tolist() == want, at


def test_memory_does_not_grow_with_the_text(merges):
    own, peaks = bpe_stream.StreamingEncoder(merges), []
    sum(map(len, own.stream(["some words of the text, in lines\n" * 1000])))
    for unit in ("some words of the text, in lines\n", "abcdefghij"):
        for parts in (3, 9):
            decoder = bpe_stream.IncrementalDecoder(merges)
            tracemalloc.start()
            for ids in own.stream(unit * (60_000 // len(unit)) for _ in range(parts)):
                decoder.feed(memoryview(ids).cast("I").tolist())
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0] and peaks[3] < 1.3 * peaks[2]


def test_window_is_bounded(merges):
    transducer = bpe_stream.PieceTransducer(merges)
    for _ in range(200):
        transducer.feed(b"ab" * 500)
        assert len(transducer.window) <= 2 * transducer.most


def test_bpe_report(spark, frame):
    library = Tokenizer.from_file(WORD)
    rows = [*enumerate(texts(60)), (3, "again"), (3, "again"), (None, "none")]
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = bpe_stream.bpe_report(frame(rows), WORD).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe_stream.bpe_report(frame([]), WORD).collect() == []


def expected_files(rows):
    library, start, out = Tokenizer.from_file(BYTE), 0, []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_library(spark, frame):
    rows = list(enumerate(texts()))
    shuffled = rows[:]
    random.Random(5).shuffle(shuffled)
    layout = token_files.Layout(BYTE, length=64, file_tokens=5_000)
    got = token_files.token_report(frame(shuffled), layout).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == expected_files(rows)


def test_token_files_odd_tables(spark, frame):
    layout = token_files.Layout(BYTE)
    assert token_files.token_report(frame([]), layout).collect() == []
    got = token_files.token_report(frame([(1, "a"), (None, "b"), (1, "a"), (1, None)]), layout).collect()
    assert sorted(r.n_tokens for r in got) == [1, 2, 2, 2] and sorted(r.start for r in got)[0] == 0
    assert [r.start for r in got if r.doc_id is None] == [0]


def test_random_access_is_a_view():
    ids = np.arange(700 * 32 - 5, dtype="<u2")
    data = token_files.stream_of(ids, [1], [len(ids)], 0, 0, 32) + b"\n"
    file = token_files.TokenFile(data)
    base = file.buffer.address
    for k in (0, 255, 256, 511, 512, 699):
        tokens, mask = file.sequence(k)
        size = min(32, len(ids) - 32 * k)
        assert tokens[:size].tolist() == ids[32 * k : 32 * k + size].tolist()
        assert sum(mask.to_pylist()) == size
        assert base <= tokens.ctypes.data < base + len(data)
    assert file.ids().tolist() == ids.tolist()
    with pytest.raises(IndexError):
        file.sequence(700)
