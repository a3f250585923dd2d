"""Line rules against a plain version."""

from __future__ import annotations

import re

import pytest

from tidemill.llm import line_cleaning as lc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, rules):
    text = text or ""
    words = WORD.findall(text)
    seen, covered, width = {}, set(), rules.window
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {i + k for i in places for k in range(width)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    bad, clean = [], []
    for line in lines:
        own = WORD.findall(line)
        chars = len("".join(own))
        marks = sum(c in lc.MARKS for c in line)
        seps = sum(w in lc.SEPARATORS for w in own)
        fails = 1000 * marks > rules.marks_per_1000 * chars
        fails |= len(own) < rules.short_line and not re.search(lc.SENTENCE_END.replace("$", r"\Z"), line)
        fails |= seps >= rules.min_separators and 1000 * seps >= rules.separators_per_1000 * len(own)
        fails |= any(p in line.lower() for p in lc.PHRASES)
        (bad if fails else clean).append(line)
    lost, all_chars = sum(len("".join(WORD.findall(x))) for x in bad), len("".join(words))
    failed = len(words) < rules.min_words or 100 * len(covered) > rules.repeat_percent * len(words)
    kept = not failed and 1000 * lost <= rules.lost_per_1000 * all_chars
    return len(words), all_chars, sum(c in lc.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), failed, kept, "\n".join(clean)


def rows_of(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"]
    return sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in lc.line_cleaning(df).collect())


EDGE = [
    (1, None),
    (2, ""),
    (3, "\n \n\t"),
    (4, "a b c d e f g h " * 3),
    (4, "a b c d e f g h " * 3),
    (5, "Home | News | Sport | About\n" + "This is one long enough sentence of many words here, all right. " * 3),
    (6, "x y \x85z é … 日本。\nAll RIGHTS reserved.\n" + " ".join(f"w{i}" for i in range(30))),
    (None, "\nsame line here.\nsame line here.\n\nsame  line here."),
    (7, "w " * 30000),
    (8, "one.\r\ntwo!\x0b three"),
]


def test_edge_rows(spark):
    df = spark.createDataFrame([(*r, "no", 1) for r in EDGE], "doc_id bigint, text string, kept string, n_words int")
    assert rows_of(df) == sorted((str(i), *plain(t, lc.LineRules())) for i, t in EDGE)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(df) == sorted((str(r["doc_id"]), *plain(r["text"], lc.LineRules())) for r in df.collect())


def test_empty_table(spark):
    assert lc.line_cleaning(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("limit,kept", [(500, False), (600, True)])
def test_loss_limit(spark, limit, kept):
    """11 of 20 equally long words stand in lines without the end of a sentence."""
    text = "".join(f"a{i:03d}\n" for i in range(11)) + " ".join(f"b{i:03d}" for i in range(8)) + " bbb."
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = lc.line_cleaning(df, lc.LineRules(lost_per_1000=limit)).first()
    assert (found["lost_chars"], found["word_chars"], found["kept"]) == (44, 80, kept)
