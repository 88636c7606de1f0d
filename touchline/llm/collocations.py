"""Phrase collocation mining: the phrases of two or three words that occur more often than their parts suggest.

Method: prefix-free parsing. Texts are cut into pieces at `[.,;:!?]` and line breaks, and pieces into words. A pair of
neighbouring words of a piece whose fingerprint is 0 modulo PERIOD triggers a cut: the chunk ends with that pair and the
next chunk begins with it, so chunks overlap by two words and equal passages give equal chunks. (Where the pair ends its
piece, no phrase goes on and there is no overlap.) A dictionary holds each distinct chunk of a language once, with how
often the parse uses it. Phrases are counted inside distinct chunks only, weighted by that frequency. A phrase belongs
to the chunk in which it begins before the closing pair, so those inside an overlap count once.

Where nothing triggers for LONGEST words, the chunk is cut there in the same way. Where texts are cut does not change
any count.

Shuffles: the chunks (combined before they move), then phrases that each block of chunks has already counted, packed by
a hash of the phrase into buckets of about BUCKET entries. What follows works on phrases that occur `least` times.

Defined results: null text is empty; a null language is `und`; empty texts, texts without words and empty tables give no
phrase; repeated rows count as often as they occur; ties are broken as stated. A text longer than SLICE bytes is parsed
in overlapping slices. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.words import LOWER, U64, buffers, fingerprints_between, gathered, mix
from touchline.session import stage

#: One pair of words in so many ends a chunk; the overlap is one word less than the longest phrase.
PERIOD = 32
LONGEST = 256
WORDS = 3
OVERLAP = WORDS - 1
#: Bytes parsed at a time, bytes of chunks counted at a time, entries of a bucket.
SLICE = 2 << 20
BLOCK = 4 << 20
BUCKET = 1 << 20
#: Hot words are spread over so many join keys, and the best of a language over so many tasks.
SALTS = 16
#: Entries of phrases that a byte of text may give: three for a word and its blank, rarely less than six bytes.
ENTRIES_PER_BYTE = 0.5

# What separates words, and what separates pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Segments:
    """Words of texts that lie one after the other: their bytes, and which of them begin a piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        kind = _KIND[data]
        inside = kind == 0
        left = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        right = np.concatenate([inside[1:], [False]]) if len(data) else inside
        firsts, lasts = bounds[:-1], bounds[1:] - 1
        left[firsts[firsts < len(data)]] = False
        right[lasts[lasts >= 0]] = False
        self.start = np.flatnonzero(inside & ~left)
        self.end = np.flatnonzero(inside & ~right) + 1
        self.text = np.searchsorted(bounds, self.start, "right") - 1
        seen = np.concatenate([[0], np.cumsum(kind == 2)])
        self.opens = np.ones(len(self.start), bool)
        self.opens[1:] = (self.text[1:] != self.text[:-1]) | (seen[self.start[1:]] != seen[self.end[:-1]])
        self.data, self.inside = data, inside

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with a blank behind each, a line feed where its piece ends, and where each word begins."""
        place = np.concatenate([[0], np.cumsum(self.end - self.start + 1)])
        out = np.full(place[-1], 0x20, np.uint8)
        of_word = np.ones(len(out), bool)
        of_word[place[1:] - 1] = False
        out[place[1:][np.append(self.opens[1:], True)[: len(self.start)]] - 1] = 0x0A
        out[of_word] = self.data[self.inside]
        return out, place


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places from each start to its end, one range after the other."""
    sizes = end - start
    return np.arange(sizes.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def _texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an array of texts."""
    place = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(place), pa.py_buffer(data[_ranges(start, end)])).cast(pa.string())


def parse(data: np.ndarray, bounds: np.ndarray, goes_on: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Chunks of lower-cased texts: the text of each, its words (pieces divided by line feeds), and whether the next chunk
    takes up its last two words.

    `goes_on`: the last piece is continued elsewhere, from its last two words on.
    """
    seg = Segments(data, bounds)
    n = len(seg.start)
    if not n:
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, bool)
    place = np.arange(n)
    new_text = np.ones(n, bool)
    new_text[1:] = seg.text[1:] != seg.text[:-1]
    closes = np.append(new_text[1:], True)
    ends_piece = np.append(seg.opens[1:], True)
    code = fingerprints_between(data, seg.start, seg.end)
    pair = np.zeros(n, U64)
    pair[1:] = mix(code[:-1] * U64(0x9E3779B97F4A7C15) ^ code[1:])
    # a chunk has at least one word before its closing pair, and the pair lies in one piece
    lone = new_text | np.append(False, new_text[:-1])
    may = ~seg.opens & ~lone & ~closes
    cut = may & (pair % U64(PERIOD) == 0)
    # where nothing triggers for long, the first pair behind every LONGEST words since the last cut
    since = place - np.maximum.accumulate(np.where(cut | new_text, place, 0))
    due = since // LONGEST
    cut |= may & (due > 0) & (np.append(0, due[:-1]) < due)
    ends = np.flatnonzero(cut | closes)
    goes = cut[ends] & ~ends_piece[ends]
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = np.where(goes[:-1], ends[:-1] - (OVERLAP - 1), ends[:-1] + 1)
    if goes_on:
        goes[-1] = True
    words, at = seg.joined()
    return seg.text[starts], _texts(words, at[starts], at[ends + 1] - 1), goes


def slices(data: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Cut a long text where a piece ends, or else between words with the last two words repeated (then true)."""
    at, size = 0, limit
    while len(data) - at > size:
        window = _KIND[data[at + size : at + size + limit]]
        found = np.flatnonzero(window == 2)
        if len(found):
            to = at + size + int(found[0]) + 1
            yield data[at:to], False
            at, size = to, limit
            continue
        blank = np.flatnonzero(window)
        if len(blank):
            part = data[at : at + size + int(blank[0])]
            seg = Segments(part, np.array([0, len(part)]))
            if len(seg.start) > OVERLAP and not seg.opens[-OVERLAP:].any():
                yield part, True
                at, size = at + int(seg.start[-OVERLAP]), limit
                continue
        size *= 2
    yield data[at:], False


def _parsed(limit: int):
    """Chunks of batches of texts, `limit` bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", limit):
            raw, bounds = buffers(batch.column("text"))
            data = LOWER[raw]
            if batch.num_rows == 1:
                parts = ((part, np.array([0, len(part)]), on) for part, on in slices(data, limit))
            else:
                parts = iter([(data, bounds, False)])
            for part, edges, on in parts:
                text, chunk, goes = parse(part, edges, on)
                if len(text):
                    yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(text)), chunk, pa.array(goes)], names=["lang", "chunk", "goes"])

    return run


def dictionary(docs: DataFrame) -> DataFrame:
    """Distinct chunks of each language with how often the parse uses them: lang, chunk, goes, n."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    parsed = texts.mapInArrow(_parsed(SLICE), "lang string, chunk string, goes boolean")
    return parsed.groupBy("lang", "chunk", "goes").agg(F.count("*").alias("n"))


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys: the place of the first and the sum of their weights; and which of them each place has."""
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[order], np.arange(len(first)))
    return first, np.add.reduceat(weights[order], edges), number


class Counts:
    """Phrases of one to WORDS words inside a block of chunks, counted: language, bytes with a blank behind, count.

    The empty phrase occurs once for each word, so its count is the number of words.
    """

    def __init__(self, batch: pa.RecordBatch):
        data, bounds = buffers(batch.column("chunk"))
        seg = Segments(data, bounds)
        self.words, at = seg.joined()
        lang = batch.column("lang").dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        lang_of = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[seg.text]
        weight = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)[seg.text]
        goes = np.asarray(batch.column("goes").to_numpy(zero_copy_only=False), bool)[seg.text]
        n = len(seg.start)
        place = np.arange(n)
        own = ~goes | (place + OVERLAP < np.searchsorted(seg.text, seg.text, "right"))
        last = np.append(np.flatnonzero(seg.opens)[1:], n)[np.cumsum(seg.opens) - 1] - 1
        # numbers of words are exact: the words themselves are looked up, not their fingerprints
        sizes = np.concatenate([[0], np.cumsum(seg.end - seg.start)])
        word = pa.LargeStringArray.from_buffers(n, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[seg.inside]))).dictionary_encode()
        single = word.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        of_lang = single + lang_of * len(word.dictionary)
        one = np.unique(of_lang, return_inverse=True)[1].astype(np.int64)
        first, sums, _ = _sums(lang_of[own], weight[own])
        empty = np.full(len(first), len(self.words))
        found = [(lang_of[own][first], empty, empty, sums)]
        run = one
        for size in range(1, WORDS + 1):
            begins = np.flatnonzero(own & (place + size - 1 <= last))
            if not len(begins):
                break
            keys = run[begins] if size == 1 else run[begins] * (one.max() + 1) + one[begins + size - 1]
            first, sums, number = _sums(keys, weight[begins])
            where = begins[first]
            found.append((lang_of[where], at[where], at[where + size], sums))
            run = np.zeros(n, np.int64)
            run[begins] = number
        self.lang, self.start, self.end, self.count = (np.concatenate(x) for x in zip(*found, strict=True))


_PACKED = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("entries", pa.int64()), ("size", pa.int64()), ("packed", pa.binary())])
_PACKED_DDL = "lang string, bucket long, entries long, size long, packed binary"


def _pack(counts: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, bytes]:
    """Counts, then phrases with a line feed behind each; compressed, and the size before."""
    ends = np.cumsum(np.maximum(end - start, 1))
    lines = np.full(int(ends[-1]), 0x0A, np.uint8)
    of_word = np.ones(len(lines), bool)
    of_word[ends - 1] = False
    lines[of_word] = words[_ranges(start, np.maximum(end - 1, start))]
    raw = counts.astype("<i8").tobytes() + lines.tobytes()
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(entries: int, size: int, packed: bytes) -> tuple[np.ndarray, pa.Array]:
    raw = np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), np.uint8)
    lines = raw[8 * entries :]
    ends = np.flatnonzero(lines == 0x0A)
    return raw[: 8 * entries].view("<i8"), _texts(lines, np.concatenate([[0], ends[:-1] + 1]), ends)


def _packed(buckets: int, block: int):
    """One row for each language and bucket that a block of chunks has phrases of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "chunk", block):
            if not batch.num_rows:
                continue
            c = Counts(batch)
            code = fingerprints_between(c.words, c.start, np.maximum(c.end - 1, c.start))
            key = c.lang * buckets + (code % U64(buckets)).astype(np.int64)
            order = np.argsort(key, kind="stable")
            edges = np.flatnonzero(np.diff(key[order], prepend=-1))
            rows = []
            for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
                part = order[a:b]
                size, packed = _pack(c.count[part], c.words, c.start[part], c.end[part])
                lang, bucket = divmod(int(key[order[a]]), buckets)
                rows.append({"lang": c.langs[lang], "bucket": bucket, "entries": b - a, "size": size, "packed": packed})
            for a in range(0, len(rows), 1024):
                yield pa.RecordBatch.from_pylist(rows[a : a + 1024], schema=_PACKED)

    return run


def _merged(least: int):
    """Phrases of a bucket with their sums; those that occur less than `least` times go, but for the empty one."""

    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack(e, s, p) for e, s, p in zip(*(group.column(k).to_pylist() for k in ("entries", "size", "packed")), strict=True)]
        table = pa.table({"phrase": pa.chunked_array([p for _, p in parts]), "n": np.concatenate([n for n, _ in parts])})
        sums = table.group_by("phrase").aggregate([("n", "sum")])
        sums = sums.filter(pc.or_(pc.greater_equal(sums["n_sum"], least), pc.equal(sums["phrase"], "")))
        lang = pa.array([group.column("lang")[0].as_py()] * len(sums), pa.string())
        return pa.table({"lang": lang, "phrase": sums["phrase"], "f": sums["n_sum"]})

    return run


def frequent_phrases(docs: DataFrame, least: int = 10) -> DataFrame:
    """Phrases of one to three words that occur `least` times in a language, and the empty phrase, once a word.

    Columns lang, phrase, f. The number of buckets follows the bytes of text, so that a bucket's size doesn't.
    """
    bytes_ = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(bytes_ * ENTRIES_PER_BYTE / BUCKET))
    packed = dictionary(docs).mapInArrow(_packed(buckets, BLOCK), _PACKED_DDL)
    return packed.groupBy("lang", "bucket").applyInArrow(_merged(least), "lang string, phrase string, f long")


def _part(df: DataFrame, parts: DataFrame, part: str, out: str) -> DataFrame:
    """Join the count of a part; hot parts are spread over SALTS keys."""
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS).cast("long"))
    each = parts.select(F.col("lang"), F.col("phrase").alias(part), F.col("f").alias(out), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    return df.withColumn("_salt", salt).join(each, ["lang", part, "_salt"]).drop("_salt")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The best `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a is how often the phrase occurs, l and r how often its two parts do at the cut with the lowest score (the shortest
    left part on a tie), n the number of words of the language, score floor(1000000 * a * a / (l * r)), computed in
    decimals. A phrase is left out if a longer one that holds it occurs in at least `share` percent of its places.
    """
    found = stage(frequent_phrases(docs, least), "phrases").withColumn("words", F.size(F.split("phrase", " ")))
    parts = found.where("phrase != ''").select("lang", "phrase", "f", "words")
    longer = parts.where(F.col("words") > 2)
    inside = F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))
    held = longer.select("lang", F.explode(inside).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    kept = parts.where(F.col("words") > 1).join(held, ["lang", "phrase"], "left")
    kept = kept.where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("f")))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("_left", F.expr("substring_index(phrase, ' ', k)")).withColumn("_right", F.expr("substring_index(phrase, ' ', k - words)"))
    shorter = parts.where(F.col("words") < WORDS)
    cuts = _part(_part(cuts, shorter, "_left", "l"), shorter, "_right", "r")
    ratio = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(ratio.cast("long").alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("_cut")).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of each salt first, so that no task holds all phrases of a language
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("_salt")
    some = scored.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    words = found.where("phrase = ''").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
