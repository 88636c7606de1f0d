import random
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from touchline.functions import transliterate as T


def plain(*texts):
    return T.transliterated(pa.array(texts, pa.string())).to_pylist()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Москва – ‘Łódź’", "Moskva - 'Lodz'"), ("Beşiktaş Elazığ İstanbul", "Besiktas Elazig Istanbul"), ("Straße Ødegaard Æsir ÞÓR", "Strasse Odegaard Aesir ThOR"),
        ("Щукин ЁЛКА Зоря Київ Байков", "Shchukin YoLKA Zorya Kiyiv Baykov"), ("Ολυμπιακός ΠΑΟΚ ΑΕΚ Πανούλης", "Olybiakos PAOK AEK Panoulis"),
        ("東京 ไทย‽ 한국 हिन्दी", "東京 ไทย‽ 한국 हिन्दी"), ("ﬁne ｆｕｌｌ", "fine full"), ("áè", "ae"), ("й", "y"), ("😀 ok", "😀 ok"), ("plain\ttext\n", "plain\ttext\n"), ("", ""),
    ],
)
def test_texts(text, want):
    assert plain(text) == [want]


def test_longest_match_ends_with_its_row():
    assert plain("ο", "υ", None, "ου", "γγγ", "μμπ") == ["o", "y", None, "ou", "ngg", "mb"]


def slow(text):
    """The same, letter by letter."""
    table = T.with_capitals(T.MARKED)
    text = "".join(table.get(c, c) for c in unicodedata.normalize("NFC", text))
    text = "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F)
    table, out, i = T.with_capitals(T.LATIN | T.GREEK | T.CYRILLIC) | T.MARKS, "", 0
    while i < len(text):
        for n in (3, 2, 1):
            if len(text[i : i + n]) == n and text[i : i + n] in table and ord(text[i]) >= 0x80:
                out, i = out + table[text[i : i + n]], i + n
                break
        else:
            out, i = out + text[i], i + 1
    return unicodedata.normalize("NFKC", out)


def test_equals_a_walk_letter_by_letter():
    rnd = random.Random(4)
    letters = [*T.LATIN, *"αυγκξχμπντσζοευ", *"άύΟΥΓΚ", *T.CYRILLIC, *T.MARKED, *T.MARKS, *"aZ 9", "́", "東", "한", "\n", "😀"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(12))) for _ in range(3000)] + [None, ""]
    got = T.transliterated(pa.chunked_array([pa.array(texts[:7], pa.string()), pa.array(texts[7:], pa.string())])).to_pylist()
    assert got == [None if t is None else slow(t) for t in texts]
    sliced = T.transliterated(pa.array(texts, pa.string()).slice(5, 50)).to_pylist()
    assert sliced == got[5:55]


def test_in_spark(spark):
    df = spark.createDataFrame([(1, "Зенит"), (2, None), (3, "ok")], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(T.transliterate(F.col("t"))).collect()] == ["Zenit", None, "ok"]


def test_large_batches_go_in_pieces(monkeypatch):
    """Memory follows the piece and not the batch; the texts come out the same."""
    from touchline.functions import transliterate as module

    texts = pa.array(["Łódź\n", None, "", "Müller & Søn " * 30, "Щукин", "plain"] * 50)
    whole = module.transliterated(texts)
    sizes, original = [], module._piece
    monkeypatch.setattr(module, "_piece", lambda part: sizes.append(pc.sum(pc.binary_length(part)).as_py()) or original(part))
    monkeypatch.setattr(module, "PIECE_BYTES", 1000)
    assert module.transliterated(texts).equals(whole)
    assert len(sizes) > 20 and max(sizes) <= 2000
    assert module.transliterated(texts.slice(0, 0)).equals(texts.slice(0, 0))
