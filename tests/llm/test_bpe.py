import random

import numpy as np
import pytest

from touchline.llm.bpe import WordBPE, encode
from corpus_pipeline import TOKENIZER


@pytest.fixture(scope="module")
def bpe():
    return WordBPE(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def same(bpe, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    ids, decoded = bpe.encode(text.encode())
    assert np.frombuffer(ids, np.int32).tolist() == expected, text
    assert decoded.decode() == library.decode(expected, skip_special_tokens=False), text


def test_equals_the_library_on_mixed_texts(bpe, library):
    cases = ["", "   ", "Hello  World's 123 ,,!!x", "<|endoftext|>a<|startoftext|>B<|endoftext", "ΣΑΣ Σ İ ǆ é", "don't'S a b\x1cc\x85d",
             "日本語\U0001f600x", "the" * 3000, "!!!" * 500, "á ́b", "x y　z​w", "'re're're'll"]
    for text in cases:
        same(bpe, library, text)


def test_equals_the_library_on_random_texts(bpe, library):
    rng = random.Random(5)
    tokens = [t.replace("</w>", "") for t in bpe.tokens.values()]
    ascii_tokens = [t for t in tokens if t.isascii()]
    for _ in range(1500):
        same(bpe, library, "".join(rng.choice(ascii_tokens) for _ in range(rng.randint(1, 12))))
    letters = "aeinrst'.!,<|> éèñßÜ0123\n\t"
    for _ in range(1500):
        same(bpe, library, "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))))


def test_equals_the_library_on_letters_of_many_scripts(bpe, library):
    rng = random.Random(6)
    for _ in range(1500):
        same(bpe, library, "".join(chr(rng.choice([rng.randint(32, 0x24F), rng.randint(0x370, 0x5FF), rng.randint(0x900, 0x97F), rng.randint(0x3040, 0x30FF), rng.randint(0x4E00, 0x4FFF)])) for _ in range(rng.randint(1, 20))))


def test_equals_the_library_on_every_character(bpe, library):
    ranges = [*range(0x20, 0xD800), *range(0xE000, 0x20000), *range(0x2B700, 0x2D000), *range(0x31300, 0x33500), 0x3D000, 0x10FFFF]
    texts = ["a" + chr(c) + "1" for c in ranges]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, e in zip(texts, expected, strict=True) if np.frombuffer(bpe.encode(t.encode())[0], np.int32).tolist() != e] == []


def test_rows_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "the cat", 5), (1, "the cat", 5), (2, None, 6), (3, "", 7), (None, "x", 8)], "doc_id long, text string, ids int")
    got = encode(docs, TOKENIZER).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded) for r in got) == [(0, 1, "x</w>"), (1, 2, "the</w> cat</w>"), (1, 2, "the</w> cat</w>"), (2, 0, ""), (3, 0, "")]
    assert encode(docs.limit(0), TOKENIZER).count() == 0
