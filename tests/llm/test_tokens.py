"""Tokens against the public libraries."""

import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from navloom.llm import bpe, token_counts
from navloom.llm.queries import byte_ranks
from navloom.llm.transducer import MergeRules, Transducer
from tests.llm.conftest import LONG, PROSE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(byte_ranks()), special_tokens={},
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(byte_ranks(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.Counter(token_counts.read_pieces(path)), (
        sentencepiece.SentencePieceProcessor(model_file=path)
    )


def made_up(seed: int, n: int) -> list[str]:
    chance = random.Random(seed)
    letters = "abcdehinorst  \n\t'.,0123456789éèñ中文字😀 ▁AB-_=#/\u00a0\u3000\x00\x1c"
    texts = []
    for i in range(n):
        if i % 3:
            texts.append("".join(chance.choice(letters) for _ in range(chance.randint(0, 60))))
        else:
            texts.append(chance.choice("a0 =-é▁\n") * chance.randint(1, 300) + chance.choice(["", "b", "  c"]))
    return texts


def test_ids_equal_the_library(encoder, library):
    texts = ["", PROSE, LONG, *made_up(1, 1500)]
    ids, starts = encoder.texts(texts)
    for text, a, b in zip(texts, starts, starts[1:]):
        assert list(ids[a:b]) == library.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(encoder, library, pieces, text):
    assert list(encoder.texts([text])[0]) == library.encode_ordinary(text)
    counter, processor = pieces
    assert counter.texts([text])[0] == len(processor.encode(text))


def test_counts_equal_the_library(pieces):
    counter, processor = pieces
    texts = ["", " ", "<s>x</s>", PROSE, LONG, *made_up(2, 1500)]
    assert list(counter.texts(texts)) == [len(t) for t in processor.encode(texts)]


def test_full_machine_walks_on(library):
    ranks = bpe.read_ranks(byte_ranks())
    machine = Transducer(MergeRules(ranks), lambda i: bytes([i]), ranks, most=20)
    for word in (" unbelievably", "internationalisation", "zzzzqqq" * 30):
        assert [ranks[t] for t in machine.run(word.encode())] == library.encode_ordinary(word)


def test_stream_decodes_across_characters():
    data = "aé中😀\N{COMBINING ACUTE ACCENT}z".encode()
    tokens = {i: bytes([i]) for i in range(256)}
    for size in (1, 2, 3, 5):
        chunks = [list(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(bpe.decode_stream(chunks, tokens)) == data.decode()
    for broken in (b"\xe4\xb8", b"\xff\x80a", b"\xf0\x9f\x98\xf0", b"\xc3"):
        got = "".join(bpe.decode_stream([[b] for b in broken], tokens))
        assert got == broken.decode("utf-8", "replace")


def test_odd_tables(odd, odd_rows, empty, library):
    encoded = bpe.encode(odd, byte_ranks(), public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, byte_ranks()).collect()
    texts = [r[1] or "" for r in odd_rows]
    assert sorted(r.decoded for r in rows) == sorted(texts)
    assert sorted(map(list, (r.ids for r in rows))) == sorted(map(library.encode_ordinary, texts))
    order = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    counts = token_counts.count_tokens(odd, order).collect()
    assert sorted(r.n_bytes for r in counts) == sorted(len(t.encode()) for t in texts)
    assert {r.n_tokens for r in counts if r.doc_id in (1, 2)} == {0}
    assert bpe.encode(empty, byte_ranks(), public_tokenizers.PATTERN).count() == 0
    assert token_counts.count_tokens(empty, order).count() == 0


def test_unknown_ids_are_an_error(spark):
    frame = spark.createDataFrame([(1, [60_000])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(frame, byte_ranks()).collect()
