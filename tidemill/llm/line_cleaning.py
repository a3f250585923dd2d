"""Quality rules, line first: judge every line, remove what fails, reject texts that lose too much.

A line with words fails if one of these holds (``LineRules`` has the numbers):

* *punctuation*: marks (``MARKS``) make up more than a tenth of its word characters, or it is shorter
  than ten words and does not end like a sentence;
* *navigation*: at least two of its words are bare separators and they are an eighth of its words;
* *boilerplate*: it contains one of ``PHRASES``, in any case.

Lines without words are neither kept nor failed. The text is rejected if failing lines hold more than
half of its word characters, or if the base rules fail: fewer than 20 words, or more than 30 % of the
words inside eight-word windows that occur twice or more.

Null texts count as empty, and empty texts fail the base rules. Repeated rows are judged one by one.
Columns other than the id and the text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import blocks

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MARKS = "#*$%&|<>!~^_=+@{}[]"
SEPARATORS = ("|", ">", "»", "›", "•", "·")
SENTENCE_END = r"[.!?…:;\"”’»)]['\"”’»)]*[\x20\x09-\x0D]*$"
PHRASES = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "licensed under the",
    "click here to",
    "sign up for our newsletter",
    "lorem ipsum",
)


@dataclass(frozen=True)
class LineRules:
    """Integer limits, so that SQL and arrays agree exactly."""

    marks_per_1000: int = 100
    short_line: int = 10
    min_separators: int = 2
    separators_per_1000: int = 125
    lost_per_1000: int = 500
    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_failed_lines bigint, "
    "lost_chars bigint, clean_text string"
)


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(characters.encode("ascii"), np.uint8)] = True
    return table


def _separator_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that are one bare separator."""
    found = np.zeros(len(starts), bool)
    size = ends - starts
    for mark in SEPARATORS:
        code = mark.encode()
        at = np.flatnonzero(size == len(code))
        for k, byte in enumerate(code):
            at = at[data[starts[at] + k] == byte]
        found[at] = True
    return found


def _judge(data: np.ndarray, offsets: np.ndarray, rules: LineRules) -> dict[str, np.ndarray | list[str]]:
    n = len(offsets) - 1
    starts, ends, owner = blocks.words(data, offsets)
    l_start, l_end, l_owner = blocks.lines(data, offsets)
    letters = (data & 0xC0) != 0x80  # first bytes of code points
    in_words = letters & blocks.NOT_SPACE[data]
    count = lambda owners, wanted: np.bincount(owners[wanted], minlength=n).astype(np.int64)
    word_chars = blocks.span_sums(in_words, offsets[:-1], offsets[1:])
    n_symbols = blocks.span_sums(_flags(SYMBOLS)[data], offsets[:-1], offsets[1:])
    n_words = np.bincount(owner, minlength=n).astype(np.int64)

    line_of = np.searchsorted(l_start, starts, "right") - 1
    # Empty lines share no byte with a word; of lines with one start, the last is the one with bytes.
    l_words = np.bincount(line_of, minlength=len(l_start)).astype(np.int64)
    has_words = l_words > 0
    at = np.flatnonzero(has_words)
    _, again = blocks.repeated(l_owner[at], blocks.span_hashes(data, l_start[at], l_end[at]))
    n_dup_lines = count(l_owner[at], again)

    w_hash = blocks.span_hashes(data, starts, ends)
    first, w = blocks.window_hashes(w_hash, owner, rules.window)
    twice, _ = blocks.repeated(owner[first], w)
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + rules.window, -1)
    n_repeat = count(owner, np.cumsum(cover[:-1]) > 0)

    l_chars = blocks.span_sums(in_words, l_start, l_end)
    l_marks = blocks.span_sums(_flags(MARKS)[data], l_start, l_end)
    l_seps = np.bincount(line_of[_separator_words(data, starts, ends)], minlength=len(l_start))
    whole = data.tobytes()
    texts = pa.array([whole[a:b] for a, b in zip(l_start[at].tolist(), l_end[at].tolist(), strict=True)], pa.binary())
    texts = texts.cast(pa.string())
    sentence = pc.match_substring_regex(texts, SENTENCE_END).to_numpy(zero_copy_only=False).astype(bool)
    phrase = pc.match_substring_regex(texts, "|".join(PHRASES), ignore_case=True).to_numpy(zero_copy_only=False).astype(bool)
    bad = (1000 * l_marks[at] > rules.marks_per_1000 * l_chars[at]) | ((l_words[at] < rules.short_line) & ~sentence)
    bad |= (l_seps[at] >= rules.min_separators) & (1000 * l_seps[at] >= rules.separators_per_1000 * l_words[at])
    bad |= phrase
    lost = np.bincount(l_owner[at], weights=l_chars[at] * bad, minlength=n).astype(np.int64)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.repeat_percent * n_words)
    clean: list[list[str]] = [[] for _ in range(n)]
    for text, doc in zip(texts.filter(pa.array(~bad)).to_pylist(), l_owner[at][~bad].tolist(), strict=True):
        clean[doc].append(text)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": ~failed & (1000 * lost <= rules.lost_per_1000 * word_chars),
        "n_lines": np.bincount(l_owner[at], minlength=n).astype(np.int64),
        "n_failed_lines": count(l_owner[at], bad),
        "lost_chars": lost,
        "clean_text": ["\n".join(x) for x in clean],
    }


def line_cleaning(docs: DataFrame, rules: LineRules | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, verdicts and the text of the lines that passed."""
    rules = rules or LineRules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in blocks.text_blocks(batch.column("text")):
                found = _judge(data, offsets, rules)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(a, b - a), **found})

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA)
