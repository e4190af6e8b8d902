"""The pipeline's near-dedup by exact shingle similarity."""

from __future__ import annotations

import random

from cartpulse.llm import adaptjoin, simhash


def test_stage_keeps_documents_that_share_a_running_line(frame):
    draw = random.Random(7)
    line = " ".join(f"line{i}" for i in range(10))
    texts = [
        "\n".join([f"{line}\n" * 50, " ".join(f"w{draw.randrange(10**6)}" for _ in range(1500))])
        for _ in range(12)
    ]
    kept = simhash.dedup_stage(frame("doc_id bigint, text string", list(enumerate(texts))))
    assert kept.count() == 12


def shingle_sets(texts):
    words = [t.split() for t in texts]
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]


def test_stage_finds_all_pairs_by_brute_force(frame):
    draw = random.Random(8)
    texts = []
    for n in range(150):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice((6, 40, 300)))]
        edited = list(words)
        for at in draw.sample(range(len(words)), max(1, len(words) * draw.randint(5, 40) // 1000)):
            edited[at] = f"edit{n}"
        texts += [" ".join(words), " ".join(edited)]
    texts = draw.sample(texts, len(texts))
    sets = shingle_sets(texts)
    group = list(range(len(texts)))
    near = 0
    for i, a in enumerate(sets):
        for j in range(i):
            share = len(a & sets[j])
            if share and 5 * share >= 4 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
                near += 0.8 <= share / len(a | sets[j]) < 0.85
    assert near >= 10
    kept = simhash.dedup_stage(frame("doc_id bigint, text string", list(enumerate(texts)))).collect()
    first = {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_stage_links_by_fingerprints_first(frame, monkeypatch):
    draw = random.Random(9)
    words = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    near = [*words[:-1], "edit"]
    assert bin(simhash.fingerprint(" ".join(words), 3) ^ simhash.fingerprint(" ".join(near), 3)).count("1") <= 3
    # equal fingerprints, but nothing in common: the exact check parts them
    texts = [" ".join(words), " ".join(near), " ".join(f"x{i}" for i in range(9)), "a b", "c d"]
    docs = frame("doc_id bigint, text string", list(enumerate(texts)))
    nodes = adaptjoin.keyed(docs).selectExpr("row_key as node")
    key = {row.row_key: row.doc_id for row in adaptjoin.keyed(docs).collect()}
    found = {frozenset((key[r.a], key[r.b])) for r in simhash.near_rows(docs, nodes).collect()}
    assert found == {frozenset((0, 1))}
    monkeypatch.setattr(simhash, "fingerprint", lambda text, k: 5)
    assert simhash.near_rows(docs, nodes).count() == 4
    # what leaders would find comes from fingerprints, too; either way links are exact
    monkeypatch.setattr(adaptjoin, "leader_pairs", lambda postings: postings.selectExpr("node as a", "node as b").limit(0))
    assert sorted(row.doc_id for row in simhash.dedup_stage(docs).collect()) == [0, 2, 3, 4]
