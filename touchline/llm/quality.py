"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation says how far each is to be trusted.

Method: every rule looks at measures of a whole text and votes 1 (good), -1 (bad) or 0 (abstains). Rows with the same
votes are counted, so that a table of any size shrinks to at most 3 ** rules patterns before anything leaves the
executors. Expectation-maximisation over the counts estimates the share of good texts and, for each rule, how often it
votes what in good and in bad texts; each pattern's posterior probability of being good follows by Bayes' rule. A text
is kept if that probability reaches the threshold, instead of having to pass every rule.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.words import SPACE, buffers, fingerprints_between, pieces, windows, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_odd_ends", "n_function_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
#: Bytes that a word of running text ends in: letters, digits, what belongs to a letter beyond ASCII, plain punctuation.
_PLAIN_END = _UPPER | _LOWER
_PLAIN_END[[*b"0123456789.,;:?)'\"", *range(0x80, 0x100)]] = True
# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = """
the of and to a in is was that for it with as on be at by this from
der die das und den ein eine mit zu im von dem ist nicht auf
le la les de des du un une et que pour dans en au par sur
el los las del y por con se una al lo es su
"""


def _known_words() -> np.ndarray:
    return np.sort(words_of(pa.array([FUNCTION_WORDS])).fingerprints())


def _per(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of true flags in each range."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys in order of group: whether the same group has the key elsewhere, and whether it has it earlier."""
    order = np.lexsort((keys, group))
    k, g = keys[order], group[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (g[1:] == g[:-1])
    anywhere = same.copy()
    anywhere[:-1] |= same[1:]
    out, earlier = np.zeros(len(k), bool), np.zeros(len(k), bool)
    out[order], earlier[order] = anywhere, same
    return out, earlier


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measures of each text."""
    data, bounds = buffers(texts)
    words = words_of(texts)
    n = len(bounds) - 1
    first, lead = words.first, (data & 0xC0) != 0x80
    out = {"n_words": np.diff(first), "word_chars": _per(lead & ~SPACE[data], bounds)}
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _UPPER | _LOWER)):
        out[name] = _per(table[data], bounds)
    out["n_shouts"] = _per(data[words.end - 1] == ord("!"), first)

    out["n_odd_ends"] = _per(~_PLAIN_END[data[words.end - 1]], first)

    word, known = words.fingerprints(), _known_words()
    out["n_function_words"] = _per(known[np.minimum(np.searchsorted(known, word), len(known) - 1)] == word, first)
    at_three, at = windows(word, first, 3)
    twice, _ = repeated(at_three, words.doc[at])
    cover = np.zeros(len(words.start) + 3, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 3, -1)
    out["n_repeat_words"] = _per(np.cumsum(cover)[: len(words.start)] > 0, first)

    # lines: from each text's start or line feed to the next line feed or the text's end
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([bounds[:-1], feeds + 1]))
    ends = np.sort(np.concatenate([bounds[1:], feeds]))
    worded = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends = starts[worded], ends[worded]
    line_doc = np.searchsorted(bounds, starts, "right") - 1
    _, earlier = repeated(fingerprints_between(data, starts, ends), line_doc)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = np.bincount(line_doc[earlier], minlength=n)
    return out


def measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`row`, a struct of all columns of docs, and the MEASURES of each row (long)."""
    source = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text_column].cast("string").alias("text"))
    made = T.StructType([source.schema["row"], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    # a text that the row holds already isn't sent beside it
    at = docs.columns.index(text_column) if source.schema["row"].dataType[text_column].dataType == T.StringType() else None
    if at is not None:
        source = source.select("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if at is not None:
                row = batch.column("row")
                batch = pa.RecordBatch.from_arrays([row, row.flatten()[at]], names=["row", "text"])
            for part in pieces(batch):
                found = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], names=["row", *MEASURES])

    return source.mapInArrow(run, made)


@dataclass(frozen=True)
class Rule:
    """Votes bad from `bad` on, good up to `good`, and abstains between, on the share part / whole in per cent."""

    name: str
    part: Callable[[], Column]
    whole: Callable[[], Column]
    good: float
    bad: float

    def vote(self) -> Column:
        share, whole = 100 * self.part(), self.whole()
        return F.when(whole == 0, 0).when(share >= self.bad * whole, -1).when(share <= self.good * whole, 1).otherwise(0)


def _c(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


#: A rule that looks for one defect abstains where it finds none, as other defects may be there.
NEVER = -1.0
#: Shares in per cent up to which a rule votes good, and from which it votes bad.
RULES = (
    Rule("symbols", _c("n_symbols"), _c("n_words"), NEVER, 15),
    Rule("repeated words", _c("n_repeat_words"), _c("n_words"), NEVER, 40),
    Rule("repeated lines", _c("n_dup_lines"), _c("n_lines"), NEVER, 40),
    Rule("capitals", _c("n_upper"), _c("n_letters"), NEVER, 50),
    Rule("shouting", _c("n_shouts"), _c("n_words"), NEVER, 20),
    Rule("word ends", _c("n_odd_ends"), _c("n_words"), 5, 20),
    Rule("function words", lambda: F.col("n_words") - F.col("n_function_words"), _c("n_words"), 88, 98),
    Rule("letters", lambda: F.col("word_chars") - F.col("n_letters"), _c("word_chars"), 20, 50),
    Rule("word length", lambda: F.abs(F.col("word_chars") - 6 * F.col("n_words")), lambda: 6 * F.col("n_words"), 25, 65),
)


@dataclass(frozen=True)
class Estimate:
    """What expectation-maximisation found: the share of good texts, and how often each rule's vote is right."""

    good: float
    accuracy: list[float]

    def posterior(self, votes: tuple[int, ...]) -> float:
        """Probability of good. A rule that abstains says nothing."""
        odds = math.log(self.good / (1 - self.good))
        for vote, right in zip(votes, self.accuracy, strict=True):
            odds += vote * math.log(right / (1 - right))
        return 1 / (1 + math.exp(-odds))


def estimate(counts: dict[tuple[int, ...], int], rules: int, rounds: int = 500, trust: float = 0.8, weight: float = 20.0) -> Estimate:
    """Fit to vote patterns and their counts.

    Rules start out right in a share `trust` of their votes, as many texts good as bad. Those beliefs count as much as
    `weight` votes, which keeps the classes from swapping and a rule that hardly votes from being trusted blindly.
    """
    total = sum(counts.values())
    now = Estimate(0.5, [trust] * rules)
    for _ in range(rounds if total else 0):
        p = {votes: now.posterior(votes) for votes in counts}
        accuracy = []
        for j in range(rules):
            right = sum(n * (p[votes] if votes[j] > 0 else 1 - p[votes]) for votes, n in counts.items() if votes[j])
            cast = sum(n for votes, n in counts.items() if votes[j])
            accuracy.append((right + weight * trust) / (cast + weight))
        after = Estimate((sum(n * p[votes] for votes, n in counts.items()) + weight / 2) / (total + weight), accuracy)
        moved = abs(after.good - now.good) + sum(abs(a - b) for a, b in zip(after.accuracy, now.accuracy, strict=True))
        now = after
        if moved < 1e-10:
            break
    return now


def _judged(docs: DataFrame, text_column: str, threshold: float, rules: tuple[Rule, ...]) -> DataFrame:
    """`row`, the MEASURES, votes, posterior, base_failed and kept."""
    if len(rules) > 12:
        raise ValueError("more than 12 rules make more patterns than one table should hold")
    votes = F.array(*(r.vote() for r in rules)).alias("votes")
    patterns = measures(docs.select(docs[text_column].alias("text"))).select(votes).groupBy("votes").agg(F.count("*").alias("n"))
    counts = {tuple(r["votes"]): r["n"] for r in patterns.collect()}
    found = estimate(counts, len(rules))
    table = docs.sparkSession.createDataFrame([(list(v), found.posterior(v)) for v in counts], "votes array<int>, posterior double")
    judged = measures(docs, text_column).select("*", votes).join(F.broadcast(table), "votes")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("row", *MEASURES, "votes", "posterior", failed.alias("base_failed"), (~failed & (F.col("posterior") >= threshold)).alias("kept"))


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id_column, the MEASURES, `votes` (array of int, in the order of rules), `posterior` and `base_failed`, `kept`.

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word windows. kept: not base_failed
    and posterior >= threshold. A null or empty text has no words, so it fails. Repeated rows are judged alike and each
    counts; an empty table gives no row; other columns don't matter. The patterns of votes, at most
    3 ** len(rules), are the only thing that reaches the driver.
    """
    judged = _judged(docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")), "text", threshold, rules)
    return judged.select(F.col("row.id").alias(id_column), *MEASURES, "votes", "posterior", "base_failed", "kept")


def drop_bad(docs: DataFrame, text_column: str = "text", threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that `judge` keeps, with all their columns; no text is shuffled."""
    return _judged(docs, text_column, threshold, rules).where("kept").select("row.*")
