"""Token counts against the library that owns the vocabulary."""

import random
import sys

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import textkernel as tk
from tidemark.llm import tokencounts

PATH = public_tokenizers.path(tokencounts.VOCABULARY)
PIECES = [
    "a", "s", "t", "re", "ve", "ll", "m", "d", "'", "''", " ", "  ", "\n", "\t", " ", "　", "\xa0", "1", "½", "é", "é", "漢", "字", "🙂", "!", "...", "-",
    "<|endoftext|>", "<|endoftext", "|>", "S", "'RE", "\x0b", "\x1c", "\x85", "​", "the", "aaaa", "२", "'s", "don't",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return tokencounts.Counter(PATH, known=500)


def compare(library, counter, texts):
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.of(*tk.text_bytes(pa.array(texts))).tolist() == want


def test_mixed_pieces(library, counter):
    rng = random.Random(1)
    for _ in range(40):
        compare(library, counter, ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(200)])


def test_every_character_beside_others(library, counter):
    """All code points, in samples of which each is whole: a character follows a letter, a blank and a number."""
    codes = [c for c in range(1, sys.maxunicode + 1, 7) if not 0xD800 <= c < 0xE000]
    compare(library, counter, ["".join(f"a{chr(c)} {chr(c)}1{chr(c)}'s" for c in codes[i : i + 500]) for i in range(0, len(codes), 500)])


def test_special_strings_inside_one_text_only(library, counter):
    compare(library, counter, ["<|endof", "text|>", "", "a<|endoftext|>", "<|endoftext|><|endoftext|> b", " <|endoftext|> ", "x  <|endoftext|>  y"])


def test_long_pretokens(library, counter):
    rng = random.Random(2)
    texts = ["a" * n for n in (1, 2, 3, 5, 511, 512, 513, 2000, 5001)] + ["ab" * 2000, "".join(rng.choices("漢字文本的是不了人", k=3000))]
    compare(library, counter, texts + ["".join(rng.choices("abcdefghijklmnop", k=n)) for n in (500, 3000, 60_000)])


def test_rounds_and_index_agree(counter):
    rng = random.Random(3)
    texts = ["".join(rng.choices("etaoin", k=rng.randint(1, 60))) for _ in range(300)]
    raw, first = tk.text_bytes(pa.array(texts))
    symbols = counter.vocabulary.of_byte[raw]
    by_rounds, by_index = (tokencounts.merged_counts(symbols, first, counter.vocabulary, long).tolist() for long in (1000, 0))
    assert by_rounds == by_index


def test_query(spark, library, tmp_path):
    rows = [(1, "Hello world, it's fine"), (2, None), (3, ""), (None, "a b"), (1, "Hello world, it's fine"), (4, "word " * 600), (5, " \n")]
    spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in tokencounts.op13_token_counts(spark, str(tmp_path)).collect()), key=str)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted(((i, len((t or "").encode()), count(t), count(t) > 512) for i, t in rows), key=str)
    assert tokencounts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokencounts.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
