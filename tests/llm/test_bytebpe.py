import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerwatch.llm import bytebpe, queries

RANKS = [public_tokenizers.path(f"{name}.tiktoken") for name in ("byte_bpe_50k", "byte_bpe_multi_50k")]


@pytest.fixture(scope="module", params=RANKS)
def both(request):
    ranks = bytebpe.parse_ranks(bytebpe.read_ranks(request.param))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    return bytebpe.ByteBPE(ranks, public_tokenizers.PATTERN), library, ranks


def same(coder, library, text):
    ids = coder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:80]
    assert coder.decode(ids) == text.encode()


def test_random_texts_equal_the_library(both):
    coder, library, ranks = both
    rng, tokens = random.Random(3), list(ranks)
    for _ in range(3000):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", rng.choice([2, 3, 5]))
        same(coder, library, "".join(rng.choices(letters, k=rng.randint(1, 60))))
        same(coder, library, b"".join(rng.choices(tokens, k=rng.randint(1, 8))).decode("utf-8", "ignore"))
        signs = [" ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'", "1", "é", "中", "😀", "a", "B", "."]
        same(coder, library, "".join(rng.choices(signs, k=rng.randint(1, 30))))


@pytest.mark.parametrize("text", ["", " ", "a" * 200_000, " " * 70_000 + "x", "ab" * 50_000, "\n" * 9999,
                                  "<|endoftext|> is text", "é" * 20_000])
def test_long_and_special_texts(both, text):
    same(both[0], both[1], text)


def test_full_memos_change_nothing(both):
    _, library, ranks = both
    coder = bytebpe.ByteBPE(ranks, public_tokenizers.PATTERN, memo_pieces=2, memo_pairs=2)
    for i in range(50):
        same(coder, library, " ".join(f"w{i}x{j}" for j in range(20)) + " qwxzvk jjqqkkz")


def test_every_byte_needs_a_token():
    with pytest.raises(ValueError, match="no token"):
        bytebpe.ByteBPE({b"a": 0}, public_tokenizers.PATTERN)


def test_query_equals_the_library(spark, sf, real):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bytebpe.parse_ranks(bytebpe.read_ranks(RANKS[0])))
    expected = {}
    for doc_id, text in real:
        ids = library.encode_ordinary(text or "")
        expected[doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                            hashlib.sha256((text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in queries.op12_byte_bpe(spark, sf).collect()}
    assert got == expected


def test_nulls_repeats_and_clashing_names(spark, docs):
    rows = [(1, None), (2, ""), (None, "one two"), (2**60 + 1, "one two"), (5, "x"), (5, "x")]
    out = bytebpe.decode(bytebpe.encode(docs(rows, extra=True), RANKS[0], public_tokenizers.PATTERN),
                         RANKS[0], public_tokenizers.PATTERN)
    got = sorted(((r.doc_id or 0), bytes(r.decoded).decode()) for r in out.collect())
    assert got == sorted(((i or 0), t or "") for i, t in rows)
    none = bytebpe.encode(docs([(1, "x")]).limit(0), RANKS[0], public_tokenizers.PATTERN)
    assert none.collect() == []
