"""Byte-pair encoding and decoding with a given word-end vocabulary, exact to the merge order.

Method: dynamic programming over the prefixes of a pre-token. An Aho-Corasick automaton (a suffix automaton of the
vocabulary) gives every token that ends at a position. Merge order allows exactly one of them to be the last token of
the prefix: the one that is *compatible* with the last token of what stands before it. Two tokens are compatible if
merging their joined text gives the same two tokens again. The unique last token of each prefix is stored, and
following the back-pointers from the end gives the ids. The cost is linear in the text, also for one very long word.

Rows stay where they are: no shuffle, and a row's ids depend on that row alone.
"""

from __future__ import annotations

import array
import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.words import pieces

END = "</w>"
#: Stands for END behind the last byte of a pre-token; not one of the 256 characters that stand for bytes.
MARK = "\x00"
#: Entries that a worker remembers of each kind; beyond that it starts anew. Memory only, never results.
REMEMBERED = 400_000


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Code points of a private plane, which are neither letters nor numbers nor white space.
PRIVATE = 0xF0000


# What the pattern engine takes for letters and the vocabulary's library, with older tables, does not.
NEWER_LETTERS = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7cf a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee
11b0a 11db0-11ddb 11df1 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2
1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed
1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Capitals that the library lowers and Python does not yet, first and last, and their first small letter.
NEWER_CAPITALS = "1c89-1c89:1c8a a7cb-a7cb:264 a7cc-a7cc:a7cd a7ce-a7ce:a7cf a7d2-a7d2:a7d3 a7d4-a7d4:a7d5 a7da-a7da:a7db a7dc-a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"


def newer_letters() -> frozenset[str]:
    ends = [[int(x, 16) for x in r.split("-")] for r in NEWER_LETTERS.split()]
    return frozenset(chr(c) for e in ends for c in range(e[0], e[-1] + 1))


def newer_capitals() -> dict[int, int]:
    out = {}
    for entry in NEWER_CAPITALS.split():
        first, last, small = (int(x, 16) for x in re.split("[-:]", entry))
        out |= {c: small + c - first for c in range(first, last + 1)}
    return out


class WordBPE:
    """One vocabulary, with what the worker remembers of earlier words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or spec.get("decoder"):
            raise ValueError("this is not a BPE vocabulary with word ends and plain decoding")
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.token_bytes = {i: t.encode() for i, t in self.tokens.items()}
        self.special = {t: (array.array("i", [i]).tobytes(), t.encode()) for t, i in special.items()}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split)
        self.newer, self.capitals = newer_letters(), newer_capitals()
        self.characters = byte_characters()
        # a token's rank is the place of the merge that makes it; single characters come before all merges
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for place, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            pair_ids = (vocab[left], vocab[right])
            self.merged.setdefault(pair_ids, made)
            if made not in self.rank:
                self.rank[made], self.parts[made] = place, pair_ids
        self.matches = ahocorasick.Automaton()
        for text, i in vocab.items():
            marked = text[: -len(END)] + MARK if text.endswith(END) else text
            # only tokens that merging can make, or single characters, ever stand in an encoding
            if i in self.rank or len(marked.rstrip(MARK)) == 1:
                self.matches.add_word(marked, (i, len(marked)))
        self.matches.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, tuple[bytes, bytes]] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined texts of a and b gives a and b."""
        if len(self.pairs) >= 4 * REMEMBERED:
            self.pairs.clear()
        known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Undo the merges beside the boundary, the latest first. The boundary must not be able to merge before a merge
        # that was undone; of merges of one rank the leftmost goes first.
        before = len(self.rank) + 1
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and self.rank[joined] < before:
                return False
            of_left, of_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if of_left < 0 and of_right < 0:
                return True
            if of_left > of_right:
                left, before = self.parts[left][1], of_left
            else:
                right, before = self.parts[right][0], of_right + 1

    def last_tokens(self, text: str) -> tuple[list[int], list[int]]:
        """For each prefix of a marked pre-token its unique last token, or -1, and where that token begins."""
        last, back = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        pairs, compatible = self.pairs.get, self.compatible
        for at, (token, length) in self.matches.iter(text):
            if last[at + 1] >= 0:
                continue
            begin = at + 1 - length
            if begin:
                before = last[begin]
                if before < 0:
                    continue
                fits = pairs((before, token))
                if not (compatible(before, token) if fits is None else fits):
                    continue
            last[at + 1], back[at + 1] = token, begin
        return last, back

    def word(self, pre_token: bytes) -> tuple[bytes, bytes]:
        """Ids of one normalised pre-token, as 32-bit numbers, and its tokens joined by spaces."""
        known = self.words.get(pre_token)
        if known is not None:
            return known
        if pre_token.isalnum():  # only ASCII letters and digits, which stand for themselves
            text = pre_token.decode() + MARK
        else:
            text = "".join(map(self.characters.__getitem__, pre_token)) + MARK
        last, back = self.last_tokens(text)
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end = back[end]
        ids.reverse()
        found = array.array("i", ids).tobytes(), b" ".join(map(self.token_bytes.__getitem__, ids))
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        if len(pre_token) <= 64:
            self.words[pre_token] = found
        return found

    def plain(self, text: str) -> list[tuple[bytes, bytes]]:
        """Ids and tokens of the pre-tokens of text without special tokens."""
        if not text.isascii():
            # letter by letter, so that a capital sigma gives the same small one wherever it stands
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(self.capitals)
        text = text.lower()
        words = self.pattern.findall(text)
        if not text.isascii() and (there := set(text) & self.newer):
            away = {ord(c): chr(PRIVATE + i) for i, c in enumerate(sorted(there))}
            back = {ord(v): chr(k) for k, v in away.items()}
            words = [w.translate(back) for w in self.pattern.findall(text.translate(away))]
        return [self.word(w.encode()) for w in words]

    def chunk(self, raw: bytes) -> tuple[bytes, bytes]:
        """Ids and tokens of text without ASCII white space."""
        if raw.isalpha():  # one word of ASCII letters
            return self.remember(raw, self.word(raw.lower()))
        text = raw.decode()
        parts, at = [], 0
        for m in self.special_pattern.finditer(text) if "<" in text else ():
            parts += self.plain(text[at : m.start()])
            parts.append(self.special[m[0]])
            at = m.end()
        parts += self.plain(text[at:])
        return self.remember(raw, (b"".join([ids for ids, _ in parts]), b" ".join([tokens for _, tokens in parts])))

    def remember(self, raw: bytes, found: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
        if len(raw) <= 64:
            if len(self.chunks) >= REMEMBERED:
                self.chunks.clear()
            self.chunks[raw] = found
        return found

    def encode(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids and decoded text. No normalisation step or pre-token crosses ASCII white space."""
        known, chunk = self.chunks.get, self.chunk
        found = [known(raw) or chunk(raw) for raw in text.split()]
        return b"".join([ids for ids, _ in found]), b" ".join([tokens for ids, tokens in found if ids])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBPE:
    """Loaded once in each worker."""
    return WordBPE(path)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids and decoded text of each row.

    Returns id_column, `ids` (array of int) and `decoded` (the tokens of the ids joined by a space, which is how a
    vocabulary without a decoder is read back). A null text counts as empty: no ids, empty decoded text. Repeated rows
    are encoded each; an empty table gives none; other columns of docs don't matter. `path` must name a file that
    every executor can open, as an installed package's data.
    """
    source = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    made = T.StructType([source.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for part in pieces(batch, limit=4 << 20):
                found = [bpe.encode(t or b"") for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                bounds = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(ids) // 4 for ids, _ in found], out=bounds[1:])
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join([i for i, _ in found]), np.int32)))
                decoded = pa.array([d for _, d in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, decoded], names=["id", "ids", "decoded"])

    return source.mapInArrow(run, made).withColumnRenamed("id", id_column)


def digests(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """id_column, `n_tokens`, `ids_sha256` (of the decimal ids joined by a space), `decoded_sha256` and `ids`."""
    return encode(docs, path, id_column).select(
        id_column,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


def decode(path: str, ids: list[int]) -> str:
    """The text of ids, as `encode` returns it."""
    tokens = vocabulary(path).tokens
    return " ".join(tokens[i] for i in ids)
