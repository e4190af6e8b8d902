"""Jaccard join: prefixes, links and components against brute force, and the defined cases."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from cartpulse.llm import adaptjoin
from tests.conftest import rows_of


BITS = "bits0 bigint, bits1 bigint, bits2 bigint, bits3 bigint"


def shingle_set(text, k=5):
    words = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc_id, _), own in zip(group, rows, sets, strict=True):
        if doc_id is not None and own:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(
        ((doc_id, len(s), least.get(g) if s else doc_id) for (doc_id, _), s, g in zip(rows, sets, group, strict=True)),
        key=repr,
    )


def texts_with_copies(seed, n):
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for number in range(n):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice((1, 4, 6, 40, 200)))]
        words += passage * (number % 3 == 0)
        texts.append(words)
        for _ in range(draw.choice((0, 0, 1, 6))):
            edited = list(words)
            for at in draw.sample(range(len(words)), len(words) * draw.randint(0, 50) // 1000):
                edited[at] = f"edit{draw.randrange(10**6)}"
            texts.append(edited)
    return [" ".join(words) for words in draw.sample(texts, len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_brute_force(frame, seed):
    rows = list(enumerate(texts_with_copies(seed, 50)))
    got = rows_of(adaptjoin.jaccard_components(frame("doc_id bigint, text string", rows)))
    assert got == brute(rows)
    assert len({component for _, _, component in got}) < len(rows)


def test_a_group_similar_to_an_unlinked_text_only(frame):
    """Copies with edits of their own: alike to the text they come from, less so to one another."""
    draw = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = [(100, " ".join(base))]
    for n in range(30):
        edited = list(base)
        for at in draw.sample(range(300), 6):
            edited[at] = f"edit{n}-{at}"
        rows.append((n, " ".join(edited)))
    assert rows_of(adaptjoin.jaccard_components(frame("doc_id bigint, text string", rows))) == brute(rows)


def test_defined_cases(frame):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO\n"), (6, "É b c d e"), (7, "é b c d e"),
        (None, "one two"), (8, "x " * 50_000), (9, "x x x x x x"), (9, "some other text of one id here"),
        (9, "some other text of one id here"), (10, "some other text of one id here"),
    ]
    schema = "doc_id int, text string, node string, n int, token string, digest string, root int"
    docs = frame(schema, [(i, t, "node", 1, "t", "d", 2) for i, t in rows])
    assert rows_of(adaptjoin.jaccard_components(docs)) == brute(rows)
    assert adaptjoin.jaccard_components(frame("doc_id bigint, text string", [])).collect() == []


def test_prefixes_of_linked_sets_share_the_smaller_number_asked_for():
    draw = np.random.default_rng(5)
    asked = set()
    for _ in range(400):
        n = int(draw.integers(1, 60))
        a = draw.choice(1 << 20, n, replace=False).astype("<u8")
        b = np.unique(np.concatenate([a[: n - n // 9], draw.choice(1 << 20, n // 9).astype("<u8")]))
        frequency = draw.choice([1, 3, 40, 1000], 1 << 20, p=[0.1, 0.1, 0.3, 0.5])
        common = len(np.intersect1d(a, b))
        if 9 * common < 4 * (len(a) + len(b)):
            continue
        m_a, prefix_a, _ = adaptjoin.prefix_of(np.sort(a), frequency[np.sort(a)])
        m_b, prefix_b, _ = adaptjoin.prefix_of(b, frequency[b])
        asked |= {m_a, m_b}
        assert len(np.intersect1d(prefix_a, prefix_b)) >= min(m_a, m_b)
    assert len(asked) > 2  # costs lengthened some prefixes


def test_rare_tokens_ask_for_one_match_and_frequent_ones_for_more():
    assert adaptjoin.matches_to_ask(np.ones(100, dtype=np.int64), 100) == 1
    assert adaptjoin.matches_to_ask(np.full(100, 1000, dtype=np.int64), 100) == adaptjoin.MOST_MATCHES


def test_bitmaps_never_differ_in_more_bits_than_the_sets_in_tokens():
    draw = np.random.default_rng(6)
    for _ in range(300):
        a, b = (draw.integers(0, 1 << 63, int(draw.integers(1, 300))).astype("<u8") for _ in range(2))
        b = np.concatenate([b, a[: int(draw.integers(0, len(a) + 1))]])
        a, b = np.unique(a), np.unique(b)
        apart = adaptjoin.bits_apart(adaptjoin.bitmap(a), adaptjoin.bitmap(b))
        assert apart <= len(np.setxor1d(a, b)) and (apart > 0 or len(np.setxor1d(a, b)) % 2 == 0)


def test_marks_and_own_tokens(spark):
    draw = random.Random(9)
    prefixes = [[draw.randrange(-(1 << 63), 1 << 63) for _ in range(21)] for _ in range(30)]
    for n, prefix in enumerate(prefixes):
        prefix[3] = prefixes[n // 2][3]  # shared by some
    rows = [(n, 100, 1, 5, 6, 0, 0, 0, 0, prefix) for n, prefix in enumerate(prefixes)]
    schema = f"node bigint, n bigint, matches int, last_seen bigint, last_token bigint, {BITS}, prefix array<bigint>"
    postings = adaptjoin.shared_postings(spark.createDataFrame(rows, schema))
    held = Counter(token for prefix in prefixes for token in prefix)
    want = [(token, n, pos, sum(held[t] == 1 for t in prefix), sum(held[t] > 1 for t in prefix[:pos])) for n, prefix in enumerate(prefixes) for pos, token in enumerate(prefix) if held[token] > 1]
    assert rows_of(postings, "token", "node", "pos", "own", "rank") == sorted(want, key=repr) and want


def test_no_pairs_within_a_component(spark):
    nodes = [(i, 100, 1, list(range(20)), 0) for i in range(200)] + [(500, 100, 1, [3], 500)]
    rows = [(token, node, n, m, pos, 0, 1, 2, pos, 0, 0, 0, 0, root) for node, n, m, prefix, root in nodes for pos, token in enumerate(prefix)]
    schema = f"token bigint, node bigint, n bigint, matches int, pos int, own int, last_seen bigint, last_token bigint, rank int, {BITS}, root bigint"
    found = rows_of(adaptjoin.complete_pairs(spark.createDataFrame(rows, schema)))
    assert found == [(i, 500) for i in sorted(range(200), key=lambda i: repr((i, 500)))]
