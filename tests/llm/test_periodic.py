"""Periodic runs against a search over all periods, the contract's digests, and the defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cartpulse.llm import periodic


def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                part = words[i : j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        doc_id,
        len(found),
        *((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])),
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def periodic_words(draw):
    k = draw.choice([1, 2, 3, 5])
    words = [b"abcde"[draw.randrange(k)] for _ in range(draw.randint(0, 60))]
    for _ in range(draw.randint(0, 3)):
        unit = [b"abcde"[draw.randrange(k)] for _ in range(draw.randint(1, 9))]
        at = draw.randint(0, len(words))
        repeated = unit * draw.randint(2, 8)
        words[at:at] = repeated[: len(repeated) - draw.randrange(len(unit))]
    return [bytes([c]) for c in words]


@pytest.mark.parametrize("seed", range(10))
def test_runs_by_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(200):
        words = periodic_words(draw)
        got = [tuple(run) for run in periodic.runs(periodic.word_names(words)).tolist()]
        assert got == brute_runs(words), words


def test_query_by_brute_force(frame):
    draw = random.Random(11)
    rows = [(i, " ".join(w.decode() for w in periodic_words(draw))) for i in range(150)]
    rows += [
        (200, None), (201, ""), (202, " \n\t"), (None, "a " * 9), (203, "x y " * 7), (203, "x y " * 7),
        (204, "a b\x0bc\x0ca\rb\tc\n" * 8), (205, "\x1c \x85 " * 9), (206, "one"),
    ]
    docs = frame("doc_id int, text string, start int, words string", [(*row, 1, "w") for row in rows])
    got = [tuple(row) for row in periodic.planted_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted((brute_row(*row) for row in rows), key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) and any(row[1] for row in got)


def test_collapsed_text_and_a_very_long_one(frame):
    docs = frame("doc_id bigint, text string", [(1, "so a b a b a b a b end"), (2, "w " * 300_000 + "x")])
    rows = {row.doc_id: row for row in periodic.periodic_runs(docs).collect()}
    assert rows[1].collapsed == "so a b end" and (rows[1].start, rows[1].length, rows[1].period) == (1, 8, 2)
    assert rows[2].collapsed == "w x" and rows[2].exponent_milli == 300_000_000
    assert periodic.periodic_runs(frame("doc_id bigint, text string", [])).collect() == []
