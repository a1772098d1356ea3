import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerwatch.llm import tokencount as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = t.TokenCounter(t.read_tokenizer(PATH)[0], memo_pieces=50)
ODD = st.sampled_from([" ", "  ", "\n", "\t ", "'s", "a", "Z9", "é", "日本", "😀", "<|endoftext|>",
                       " <|endoftext|> ", " ", " ", "...", "\r\n", "\u0085", "don't"])


def by_library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD | st.text(max_size=6), max_size=20).map("".join))
def test_pieces_add_up_to_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert COUNTER.count([text]) == [by_library(text)]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = t.TokenCounter(t.read_tokenizer(path)[0])
    library = Tokenizer.from_file(path)
    texts = ["Hello  World", "", "a\nb"]
    assert not counter.additive
    assert counter.count(texts) == [len(library.encode(x, add_special_tokens=False)) for x in texts]


def test_cache_encodes_distinct_misses_only(docs, spark, tmp_path):
    rows = [(1, "one two"), (2, "one two"), (3, None), (4, ""), (5, "x " * 600), (5, "x " * 600),
            (None, "three <|endoftext|> four")]
    path = str(tmp_path / "cache")
    got = t.count_tokens(docs(rows, extra=True), PATH, path).collect()
    want = sorted(((i or -1), len((x or "").encode()), by_library(x or ""), by_library(x or "") > 512)
                  for i, x in rows)
    assert sorted(((r[0] or -1), *r[1:]) for r in got) == want
    stored = spark.read.parquet(path)
    assert stored.count() == 4  # empty, and three others
    for limit in (0, 100):  # both ways to pick the missing texts
        more = docs([*rows, (9 + limit, f"new {limit}")])
        assert t.count_tokens(more, PATH, path, broadcast_rows=limit).count() == len(rows) + 1
    assert spark.read.parquet(path).count() == 6
    # Another tokenizer shares the folder, not the counts.
    other = public_tokenizers.path("word_bpe_49k.json")
    assert t.count_tokens(docs(rows), other, path).count() == len(rows)
    assert spark.read.parquet(path).groupBy("tokenizer").count().count() == 2


def test_empty_table(docs, tmp_path):
    assert t.count_tokens(docs([]), PATH, str(tmp_path / "c")).count() == 0
