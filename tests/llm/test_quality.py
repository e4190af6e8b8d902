"""Base counts of the quality rules against a plain count, on odd texts."""

from __future__ import annotations

import random
import re
from collections import Counter

from cartpulse.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + j for i, window in enumerate(windows) if often[window] > 1 for j in range(3)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def test_base_counts_by_hand(frame):
    draw = random.Random(6)
    pieces = ["a", "bb", "é", " x", "\x1c", "\n", " \n", "\n\n", "#*", "<>|", "same line here\n", "\t", "\x0b", "漢字", "\r\n", "a bb a bb a"]
    texts = [" ".join(draw.choice(pieces) for _ in range(draw.choice((0, 3, 60, 300)))) for _ in range(120)]
    texts += [None, "", "\n", "a\na\nA\n a\na"]
    rows = list(enumerate(texts))
    docs = frame("doc_id bigint, text string, label string, features int", [(*row, "l", 1) for row in rows])
    labels = frame("doc_id bigint, quality int", [(i, i % 2) for i in range(60)])
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality.quality_rules(docs, labels).collect()
    }
    assert got == {i: by_hand(text) for i, text in rows}
    kept = quality.quality_rules(docs, labels).filter("kept and base_failed").count()
    assert kept == 0
