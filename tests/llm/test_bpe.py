"""BPE: ids and decoded text against the tokenizers library, streaming against one window."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from zonepulse.llm import bpe

PIECES = ["a", "b", "don't", "we'LL", "  ", "\n", "\x1c", "\x85", " ", "é", "é", "Σ", "ΑΣ", "İ", "ß", "中文",
          "1234", "½", "<|endoftext|>", "<|startoftext|>", "<|end", "😀", "%%%", "́", "ﬁ", "\x00", "in", "ing", "</w>"]


@pytest.fixture(scope="module")
def pair():
    return bpe.load(bpe.default_path()), Tokenizer.from_file(bpe.default_path())


def test_same_as_library(pair):
    ours, lib = pair
    rnd = random.Random(4)
    for _ in range(3000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 12)))
        ids = lib.encode(text, add_special_tokens=False).ids
        decoded = lib.decode(ids, skip_special_tokens=False)
        assert ours.encode(text) == ids
        assert ours.decode(ids) == decoded
        assert ours.digests(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                      hashlib.sha256(decoded.encode()).hexdigest())


@pytest.mark.parametrize("letters", ["a", "ab", "inthe", "erontihe"])
def test_stable_tokens_stream(pair, letters):
    ours, lib = pair
    rnd = random.Random(7)
    run = "".join(rnd.choice(letters) for _ in range(15_000))
    assert [i for block in ours.run_ids(run, block=1000) for i in block] == lib.encode(run, add_special_tokens=False).ids


def test_long_words_stream(pair):
    """Words beyond the cache go through the machine part by part, with the library's result."""
    ours, lib = pair
    rnd = random.Random(8)
    for n in (1, 64, 65, 511, 513, 20_000):
        word = "".join(rnd.choice("inthéer'1中%") for _ in range(n))
        text = f"x {word} the <|endoftext|>{word}"
        ids = lib.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        assert ours.digests(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                      hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert max(map(len, ours.words), default=0) <= bpe.REMEMBERED
    run = "inthe" * 9000
    assert len(list(ours.stream(run))) > 1                  # emitted before the run's end
    assert [int(i) for _, part, _ in ours.stream(run) for i in part.split()] == lib.encode(run, add_special_tokens=False).ids


def test_byte_level_machine():
    symbols = bpe.byte_symbols()
    text = "ab é 中 😀"
    tokens = {i: symbols[b] for i, b in enumerate(text.encode())}
    machine = bpe.Decoder(tokens, True)
    out = [machine.feed([i]) for i in tokens]
    assert "".join(out) + machine.finish() == text and "" in out
    assert bpe.Decoder({0: symbols[0xE4]}, True).feed([0]) == ""


def test_cache_forgets(pair):
    small = bpe.Bpe(bpe.default_path(), cache_words=3)
    text = " ".join(f"w{i}x" for i in range(50))
    assert small.digests(text) == pair[0].digests(text)
    assert len(small.words) <= 3 and len(small.words.old) <= 3


def test_documents(spark, pair):
    rows = [(1, "Hello the World <|endoftext|> x", "en", 5), (1, "Hello", "en", 1), (2, None, None, None), (3, " \n ", "", 0),
            (None, "word " * 70_000, "en", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int")
    got = sorted(map(tuple, bpe.token_digests(docs).collect()), key=str)
    assert got == sorted(((r[0], *pair[0].digests(r[1] or "")) for r in rows), key=str)
    encoded = bpe.encode_documents(docs)
    decoded = {r.doc_id: r.text for r in bpe.decode_documents(encoded).where("doc_id in (2, 3)").collect()}
    assert decoded == {2: "", 3: ""}
    assert bpe.token_digests(docs.limit(0)).count() == 0
