"""Transliteration into plain letters, by longest match over whole Arrow buffers.

A table maps runs of one or more letters to ASCII. Its trie is walked from every
letter of a batch at once, one step of depth a pass, so the work follows the text
and not the number of its rows. Letters that the table doesn't know lose their
marks and are kept.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

# Latin letters without a base letter plus mark.
LATIN = {
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ħ": "h", "ŋ": "ng", "ŧ": "t",
    "ĸ": "k", "ŀ": "l", "ƒ": "f", "ə": "e", "ʻ": "'", "ʼ": "'",
}
# Greek letters, and pairs that are read together.
GREEK = {
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n",
    "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps", "ω": "o",
    "ου": "ou", "αυ": "av", "ευ": "ev", "γγ": "ng", "γκ": "gk", "γχ": "nch", "γξ": "nx", "μπ": "b", "ντ": "nt", "τσ": "ts", "τζ": "tz",
}
# Cyrillic letters of Slavic languages.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l", "м": "m", "н": "n",
    "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "є": "ye", "і": "i", "ґ": "g", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c",
    "ђ": "dj", "џ": "dz", "ѕ": "dz",
}
# Cyrillic letters whose mark tells them from another letter.
MARKED = {"й": "y", "ё": "yo", "ї": "yi", "ў": "u", "ѓ": "gj", "ќ": "kj"}
# Punctuation, spaces and signs.
MARKS = {
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "«": '"', "»": '"', "‹": "'", "›": "'", "′": "'",
    "″": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "−": "-", "…": "...", "•": "*", "·": ".", "€": "EUR", "£": "GBP",
    "©": "(c)", "®": "(r)", "™": "(tm)", "×": "x", "÷": "/", "¿": "?", "¡": "!", "№": "No", " ": " ", " ": " ", "​": "",
    "­": "", "﻿": "",
}


def with_capitals(table: Mapping[str, str]) -> dict[str, str]:
    """The table and its entries in capitals: of the first letter only, and of all."""
    out = dict(table)
    for letters, plain in table.items():
        for upper in (letters[0].upper() + letters[1:], letters.upper()):
            if upper != letters and len(upper) == len(letters):
                all_up = len(letters) > 1 and upper == letters.upper()
                out.setdefault(upper, plain.upper() if all_up else plain[:1].upper() + plain[1:])
    return out


#: Bytes of the texts worked on at once; a longer text goes alone.
PIECE_BYTES = 1 << 20


class Trie:
    """Transitions of all nodes as sorted numbers (node, letter), and the entry that ends at each node."""

    def __init__(self, table: Mapping[str, str]):
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, str] = {}
        for letters, plain in table.items():
            at = 0
            for c in letters:
                at = nodes.setdefault((at, ord(c)), len(nodes) + 1)
            ends[at] = plain
        steps = sorted(((node << 21) + letter, to) for (node, letter), to in nodes.items())
        self.keys, self.to = (np.array(v, np.int64) for v in zip(*steps, strict=True))
        size = len(nodes) + 1
        self.ends = np.zeros(size, bool)
        self.ends[list(ends)] = True
        self.length = np.zeros(size, np.int64)
        self.length[list(ends)] = [len(p) for p in ends.values()]
        self.begin = np.zeros(size, np.int64)
        self.begin[list(ends)] = np.cumsum([0, *(len(p) for p in ends.values())])[:-1]
        self.plain = np.array([ord(c) for p in ends.values() for c in p], np.uint32)
        self.depth = max(map(len, table))

    def matches(self, letters: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leftmost longest matches that don't overlap: where each begins, how many letters it takes, its node."""
        start = np.flatnonzero(letters >= 0x80)
        node, best, taken = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        alive = np.arange(len(start))
        for step in range(self.depth):
            place = start[alive] + step
            alive = alive[(place < len(letters)) & (row[np.minimum(place, len(letters) - 1)] == row[start[alive]])] if len(alive) else alive
            if not len(alive):
                break
            key = (node[alive] << 21) + letters[start[alive] + step]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[found] == key
            alive = alive[known]
            node[alive] = self.to[found[known]]
            ended = alive[self.ends[node[alive]]]
            best[ended], taken[ended] = node[ended], step + 1
        hit = np.flatnonzero(taken)
        start, best, taken = start[hit], best[hit], taken[hit]
        keep = np.ones(len(start), bool)
        free = 0
        for i in np.flatnonzero(np.append(taken[:-1] > np.diff(start), False)) if len(start) else ():
            # a match that reaches into the next ones takes their letters
            if start[i] < free:
                continue
            free = start[i] + taken[i]
            keep[i + 1 : np.searchsorted(start, free)] = False
        # what was dropped can't drop others
        return start[keep], taken[keep], best[keep]

    def apply(self, letters: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The letters with matches replaced, and the row of each."""
        start, taken, node = self.matches(letters, row)
        if not len(start):
            return letters, row
        out = np.ones(len(letters), np.int64)
        for k in range(1, self.depth):
            out[start[taken > k] + k] = 0
        out[start] = self.length[node]
        place = np.concatenate([[0], np.cumsum(out)])
        result = np.repeat(letters, out)
        sizes = self.length[node]
        gather = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        result[gather + np.repeat(place[start], sizes)] = self.plain[gather + np.repeat(self.begin[node], sizes)]
        return result, np.repeat(row, out)


ALL_LETTERS = Trie(with_capitals(LATIN | GREEK | CYRILLIC) | MARKS)
MARKED_LETTERS = Trie(with_capitals(MARKED))


def _letters(text: str, line_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All code points of texts that each end with a line feed, and the row of each; `line_ends`: line feeds up to each end."""
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lines = np.cumsum(letters == 0x0A)
    before = lines - (letters == 0x0A)
    return letters, np.searchsorted(line_ends, before, "right")


def _text(letters: np.ndarray) -> str:
    return letters.astype("<u4").tobytes().decode("utf-32-le")


def _piece(texts: pa.Array) -> pa.Array:
    known = texts.cast(pa.large_string()).fill_null("")
    # a line feed behind each text, which no step moves or removes, keeps the rows apart in one string
    ended = pc.binary_join_element_wise(known, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    size = int(np.frombuffer(ended.buffers()[1], np.int64, len(ended) + 1)[-1]) if len(ended) else 0
    whole = str(memoryview(ended.buffers()[2])[:size], "utf-8") if size else ""
    if whole.isascii():
        return texts
    line_ends = np.cumsum(pc.count_substring(ended, "\n").to_numpy(zero_copy_only=False))
    letters, _ = MARKED_LETTERS.apply(*_letters(unicodedata.normalize("NFC", whole), line_ends))
    letters, row = _letters(unicodedata.normalize("NFD", _text(letters)), line_ends)
    kept = (letters < 0x300) | (letters > 0x36F)
    letters, _ = ALL_LETTERS.apply(letters[kept], row[kept])
    # signs of other widths and joined letters, such as a ligature, fall apart last
    out = unicodedata.normalize("NFKC", _text(letters)).encode("utf-8")
    ends = np.flatnonzero(np.frombuffer(out, np.uint8) == 0x0A)[line_ends - 1]
    words = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends + 1])), pa.py_buffer(out))
    plain = pc.utf8_slice_codeunits(words, 0, -1).cast(pa.string())
    return pc.if_else(texts.is_valid(), plain, pa.scalar(None, pa.string()))


def transliterated(texts: pa.Array) -> pa.Array:
    """Each text in plain letters; null stays null. Letters take many bytes each on the way, so texts go in pieces of bounded size."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // PIECE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    out = [_piece(texts.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:])]
    return out[0] if len(out) == 1 else pa.concat_arrays(out)


@arrow_udf(StringType())
def _transliterate(texts: pa.Array) -> pa.Array:
    return transliterated(texts)


def transliterate(c: Column) -> Column:
    """Text in plain letters: `Москва – ‘Łódź’` becomes `Moskva - 'Lodz'`; letters that no table knows are kept."""
    return _transliterate(c)
