"""Small cases of every operator: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cartpulse.llm import (
    bestfit,
    boosting,
    completion,
    components,
    langid,
    lines,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    tools,
    warc,
)
from cartpulse.llm.tokens import WordIds

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key int"
TEXTS = [
    None, "", " \n\t", "one two", "Déjà vu, naïve café. " * 3, "a b c d e f g\nsame line\n\nx",
    "a b c d e f g\nsame line\n\nx", "1 2 3", "word " * 30_000, "SAME LINE\n same line \ny",
]


def odd_docs(frame):
    rows = [(i, t, "en" if i % 2 else "fr", None if i == 1 else "s", 0, "r", 1) for i, t in enumerate(TEXTS)]
    return frame(DOCS, [*rows, rows[5], (None, "no id here", None, "t", None, None, None)])


def empty(frame, schema=DOCS):
    return frame(schema, [])


# ------------------------------------------------------------------ packing


def best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - x)
    return sorted(rooms)


def fewest(lengths, capacity):
    best = {0: (1, 0)}
    for mask in range(1 << len(lengths)):
        bins, used = best[mask]
        for i, x in enumerate(lengths):
            if not mask >> i & 1:
                new = (bins, used + x) if used + x <= capacity else (bins + 1, x)
                best[mask | 1 << i] = min(best.get(mask | 1 << i, new), new)
    return best[(1 << len(lengths)) - 1][0]


@pytest.mark.parametrize("seed", range(40))
def test_plans(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 50, 100])
    lengths = [draw.randint(capacity // 5, capacity // 2 + 3) for _ in range(draw.randint(1, 9))]
    counts = dict(Counter(lengths))
    greedy = bestfit.best_fit_decreasing(counts, capacity)
    rooms = sorted(capacity - sum(a * b for a, b in f) for f, n in greedy for _ in range(n))
    assert rooms == best_fit(lengths, capacity)
    plan = completion.bin_completion(counts, capacity)
    placed = Counter()
    for filling, times in plan:
        assert sum(a * b for a, b in filling) <= capacity
        for length, each in filling:
            placed[length] += each * times
    assert placed == counts
    assert completion.lower_bound(counts, capacity) <= fewest(lengths, capacity)
    assert completion.size(plan) == fewest(lengths, capacity)
    exact = completion.bin_completion(counts, capacity, max_nodes=None, width=None)
    assert completion.size(exact) == fewest(lengths, capacity)
    assert all(sum(x * n for x, n in filling) <= capacity for filling, _ in exact)


@pytest.mark.parametrize("seed", range(20))
def test_fillings_without_a_width_are_all_undominated_ones(seed):
    draw = random.Random(seed)
    left = dict(Counter(draw.randint(2, 12) for _ in range(draw.randint(1, 9))))
    room, most = draw.randint(5, 25), draw.randint(0, 25)
    pieces = [x for x, n in left.items() for _ in range(n)]
    every = {
        tuple(sorted((x for i, x in enumerate(pieces) if mask >> i & 1), reverse=True))
        for mask in range(1 << len(pieces))
    }
    want = {f for f in every if room - most <= sum(f) <= room and completion.undominated(list(f), room, left)}
    got = completion.fillings(left, room, most, None)
    if left.get(room):
        assert got == [(room,)]
    else:
        assert set(got) == want and len(got) == len(want)
        assert [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)
        assert completion.fillings(left, room, most, 1) == got[:1]


@pytest.mark.parametrize("text", ["I'LL don't 12 <|endoftext|>x", "É́ ǅ漢字 a\x1cb\x85c", "Σ ΑΣ", "", "a..b,c", "\x0bß\xa0"])
def test_ids_are_the_tokenizers(text):
    known = WordIds(TOKENIZER)
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(known.document(text), "<u4").tolist() == [*want, 0]


def test_packing_round_trip(spark, frame):
    docs = odd_docs(frame)
    known = WordIds(TOKENIZER)
    want = sorted(known.document(t) for t in [*TEXTS, TEXTS[5], "no id here"])
    placed = packing.pack(docs, TOKENIZER, completion.bin_completion).collect()
    taken = Counter()
    for row in placed:
        taken[row.sequence_id] += row.length
    assert max(taken.values()) <= 2048
    for sequence in taken:
        at = 0
        for row in sorted((r for r in placed if r.sequence_id == sequence), key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
    assert sum(r.length for r in placed) * 4 == sum(map(len, want))
    assert {r.ids_crc32 for r in placed if r.doc_id == 3} == {zlib.crc32(known.document(TEXTS[3]))}
    found = {}
    for row in bestfit.packed_matrices(docs, TOKENIZER).collect():
        ids = np.frombuffer(bytes(row.token_ids), "<u2")
        bounds = row.cu_seqlens
        assert bounds[-1] == row.n_tokens and row.position_resets == bounds[:-1]
        assert bestfit.position_ids(row.n_tokens, row.position_resets).max() < 2048
        for k, (doc, piece) in enumerate(zip(row.doc_ids, row.pieces, strict=True)):
            part = ids[bounds[k] : bounds[k + 1]].astype("<u4").tobytes()
            found.setdefault((doc, piece), []).append(part)
    whole = b"".join(found[8, p][0] for p in range(len([k for k in found if k[0] == 8])))
    assert whole == known.document(TEXTS[8]) and len(found[5, 0]) == 2
    assert packing.pack(empty(frame), TOKENIZER, completion.bin_completion).count() == 0
    assert bestfit.packed_matrices(empty(frame), TOKENIZER).count() == 0


# ------------------------------------------------------------------ lines, near copies


def test_line_dedup(frame):
    docs = odd_docs(frame)
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.line_dedup(docs, 3).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (9, 3, 2, sha("y")) in got and (0, 1, 0, sha("")) in got
    assert (5, 4, 4 - 1 - 0, sha("")) in got  # three lines repeat in three documents, the empty one stays
    kept = {r.doc_id: r for r in lines.dedup_stage(docs, 3).collect()}
    assert lines.dedup_stage(docs, 3).columns == docs.columns
    assert sum("same line" in (r.text or "").lower() for r in kept.values()) == 1
    assert lines.line_dedup(empty(frame)).count() == 0


def test_line_runs_skip_settled_keys(spark, frame):
    runs = lines.LineRuns(spark, min_docs=1, fanout=2)
    key = lambda *names: [(n.encode(), 0, 1) for n in names]
    for names in (("a", "b"), ("b", "c"), ("c", "d"), ("a", "e")):
        added = runs.add(frame("key binary, batch int, doc_id bigint", key(*names)))
        last = {bytes(r.key) for r in added.collect()}
    assert last == {b"e"}
    assert {bytes(r.key) for r in runs.frequent().collect()} == {b"a", b"b", b"c", b"d", b"e"}


def test_near_duplicates_by_brute_force(frame):
    draw = random.Random(3)
    base = [" ".join(draw.choice("abcdefgh") * 3 for _ in range(60)) for _ in range(6)]
    texts = TEXTS[:8] + base + [b + " tail" for b in base] + base[:3]
    docs = frame("doc_id bigint, text string", list(enumerate(texts)))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [simhash.fingerprint(t, 3) for t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for a, p in enumerate(prints):
            for b, q in enumerate(prints):
                if (p ^ q).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    assert [got[i].component_id for i in range(len(texts))] == group
    assert got[0].fingerprint == "0" * 16 and got[2].component_id == 0
    kept = simhash.dedup_stage(odd_docs(frame))
    assert kept.columns == odd_docs(frame).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and None in ids and 0 in ids and 1 not in ids
    assert simhash.near_duplicates(empty(frame)).count() == 0


@pytest.mark.parametrize(("radius", "segments"), [(3, 2), (5, 3), (2, 4)])
def test_links_lose_nothing(frame, radius, segments):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << i for i in draw.sample(range(64), k)) for b in base for k in range(7)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(r.a, r.b) for r in simhash.links(frame("fp bigint", [(s,) for s in signed]), radius, segments).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert got == want


def test_components_of_a_long_chain(frame):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components.components(frame("x bigint, y bigint", edges)).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[101] == 100


# ------------------------------------------------------------------ mixing


@pytest.mark.parametrize("seed", range(10))
def test_schedule_deviates_by_less_than_a_block(seed):
    draw = random.Random(seed)
    weights = {f"s{i}": draw.random() + 0.05 for i in range(draw.randint(1, 8))}
    blocks = {name: draw.randint(1, 300) for name in weights}
    schedule = mixing.Schedule(blocks, weights, 200)
    slots = {n: schedule.slots(n, np.arange(k)).tolist() for n, k in blocks.items()}
    assert sorted(s for own in slots.values() for s in own) == list(range(sum(blocks.values())))
    quota = mixing.quotas(weights, 200)
    for name, own in slots.items():
        had = set(own)
        given = 0
        for t in range(min(max(s) for s in slots.values()) + 1):
            given += t in had
            assert abs(given - quota[name] * (t + 1) / sum(quota.values())) < 1


def test_mixing_keeps_all_rows(frame):
    docs = odd_docs(frame)
    assert mixing.mixing_stage(docs).columns == docs.columns
    assert mixing.mixing_stage(docs).count() == docs.count()
    rows = mixing.mixing_order(docs).collect()
    assert {r.source for r in rows} == {None, "s", "t"}
    assert mixing.mixing_order(empty(frame)).count() == 0
    with pytest.raises(ValueError):
        mixing.quotas({"a": 0.0}, 10)


def shingle_sets(texts):
    words = [t.split() for t in texts]
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]


def test_stage_keeps_one_of_near_copies_and_all_others(frame):
    draw = random.Random(5)
    texts, group = [], []
    for n in range(40):
        words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
        for copy in range(1 + n % 3):
            edited = list(words)
            for at in draw.sample(range(400), 4 * copy):  # 20 of 400 shingles for 4 words
                edited[at] = "edit"
            texts.append(" ".join(edited))
            group.append(n)
    sets = shingle_sets(texts)
    for i, n in enumerate(group):
        first = group.index(n)
        assert len(sets[i] & sets[first]) / len(sets[i] | sets[first]) >= 0.8
    kept = simhash.dedup_stage(frame("doc_id bigint, text string", list(enumerate(texts)))).collect()
    assert sorted(group[r.doc_id] for r in kept) == list(range(40))
    assert all(r.doc_id == group.index(group[r.doc_id]) for r in kept)


# ------------------------------------------------------------------ fingerprints


def test_merkle_by_brute_force(frame):
    docs = frame("doc_id bigint, text string, tree int", [(i, t, 1) for i, t in enumerate(TEXTS[:8])])
    rows = {r.doc_id: r for r in merkle.fingerprints_with_edits(docs).collect()}
    for i, text in enumerate(TEXTS[:8]):
        own, following = text or "", TEXTS[(i - 1) % 8] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert rows[i].n_chars == len(own)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (rows[i].fingerprint == rows[i].edited_fingerprint) == (own == edited)
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    assert rows[5].fingerprint == rows[6].fingerprint and rows[6].near_next == 1
    assert merkle.fingerprints_with_edits(odd_docs(frame)).count() == 12
    assert merkle.fingerprints_with_edits(empty(frame)).count() == 0


def test_branches_locate_edits(frame):
    df = frame("l string, r string", [("a\n\nb\nc", "a\n\nb\nd"), ("x", "x"), (None, "")])
    trees = merkle.with_tree(merkle.with_tree(df, "l", "lt"), "r", "rt")
    got = trees.select(merkle.differing_branches(F.col("lt"), F.col("rt")).alias("d")).collect()
    assert [[tuple(x) for x in r.d] for r in got] == [[(1, 1)], [], []]


# ------------------------------------------------------------------ quality, language


def test_trees_learn_and_keep_their_signs():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(1500) < 0.05)).astype(float)
    trees = boosting.fit(x, y, np.array([-1, -1, 0]))
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.9
    for row in x[:20]:
        for column in (0, 1):
            line = np.repeat(row[None], 50, 0)
            line[:, column] = np.linspace(0, 1, 50)
            assert (np.diff(trees.scores(line)) <= 1e-12).all()
    assert boosting.fit(x[:0], y[:0], np.zeros(3)).scores(x[:2]).tolist() == [0.5, 0.5]


def test_quality_rules(frame):
    labels = frame("doc_id bigint, quality int, toxic int", [(3, 1, 0), (8, 0, 0), (99, 1, 0), (4, None, 0)])
    rows = {r.doc_id: r for r in quality.quality_rules(odd_docs(frame), labels).collect()}
    assert rows[0].n_words == 0 and rows[0].base_failed and not rows[0].kept
    assert rows[8].n_repeat_words == 30_000 and rows[8].base_failed
    assert rows[9].n_dup_lines == 0 and rows[5].word_chars == 16
    assert quality.quality_rules(empty(frame), empty(frame, "doc_id bigint, quality int")).count() == 0
    assert quality.repeated_words(b"a b c x a b c".split()) == 6
    assert quality.repeated_words(b"a a a a".split()) == 4


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_language_cases(frame):
    rows = {r.doc_id: r for r in langid.identify(odd_docs(frame)).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[7].lang_pred == "und"
    assert rows[3].lang_pred in ("en", "fr") and 0 <= rows[3].score <= 1
    assert langid.language_stage(odd_docs(frame)).columns == odd_docs(frame).columns
    assert langid.identify(empty(frame)).count() == 0


# ------------------------------------------------------------------ WARC, tool calls


def test_warc_round_trip_and_salvage(spark, frame, tmp_path):
    page = "<p>" + "é" * 120
    rows = [(1, "u", page), (0, None, page), (2, "v\r\nX", "short"), (3, "v", "short"), (None, "w", page), (4, "z", None)]
    pages = frame("page_id bigint, url string, html string, record int", [(*r, 0) for r in rows])
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert got[0].record_type == "response" and got[1].refers_to == 0 and got[None].refers_to == 0
    assert got[2].record_type == got[3].record_type == "response" and got[4].payload_bytes == 0
    assert got[1].payload_bytes == len(page.encode())
    assert got[1].payload_digest == hashlib.sha256(page.encode()).hexdigest()
    assert warc.round_trip(empty(frame, "page_id bigint, url string, html string")).count() == 0
    warc.write_archives(pages, str(tmp_path / "w"))
    files = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    assert sum(gzip.decompress(f).count(b"WARC/1.1\r\n") for f in files) == 6


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_later_records(packed):
    whole = [warc.record(i, "u", b"payload %d" % i * 50, "d", None) for i in range(5)]
    parts = [warc.member(w) if packed else w for w in whole]
    broken = bytearray(parts[2])
    broken[len(broken) // 2] ^= 0xFF
    data = parts[0] + parts[1] + bytes(broken) + b"junk" + parts[3] + parts[4][:-20]
    found = list(warc.salvage(data))
    records = [int(f[2]["page-id"]) for f in found if isinstance(f[2], dict)]
    gaps = [(at, size) for at, size, what, _ in found if isinstance(what, str)]
    assert records == [0, 1, 3]
    start = len(parts[0]) + len(parts[1])
    assert gaps[0] == (start, len(parts[2]) + 4) and sum(gaps[-1]) == len(data)
    assert sum(size for _, size, _, _ in found) == len(data)


def test_large_member_ends_in_zero():
    assert warc.member(b"x" * (1 << 24))[-1] == 0


def test_tool_calls(frame):
    schema = "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>, level int"
    calls = frame(schema, [
        (1, 0, "a", "search", '{"query":"é\\n", "limit": 3}', ["b"], 9),
        (1, 1, "b", "search", '{"limit":"x","z":1}', None, 9),
        (1, 2, "c", "none", "{}", ["d"], 9), (1, 3, "d", "search", "[1]", ["c"], 9),
        (1, 4, None, "search", None, ["a"], 9), (None, 5, "a", "search", '{"query":"q"}', ["gone"], 9),
    ])
    results = frame("conv_id bigint, call_id string, turn bigint, content string",
                    [(1, "a", 7, "late"), (1, "a", 6, "early"), (2, "a", 1, "other"), (None, "a", 1, None)])
    got = {(r.conv_id, r.turn): r for r in tools.link(calls, results).collect()}
    first = got[1, 0]
    assert (first.level, first.n_results, first.arguments_valid, first.problems) == (1, 2, True, "")
    assert first.canonical == '{"arguments":{"limit":3,"query":"é\\n"},"depends_on":["b"],"id":"a","name":"search","result":"early"}'
    assert got[1, 1].problems == "no result; limit is no integer; query is missing; z is unknown"
    assert got[1, 2].level is None and "cycle" in got[1, 3].problems
    assert got[1, 4].level == 0 and "no identifier" in got[1, 4].problems
    assert got[None, 5].n_results == 1 and "dependency is missing" in got[None, 5].problems
    assert [r.conv_id for r in tools.orphan_results(calls, results).collect()] == [2]
    assert tools.link(calls.limit(0), results.limit(0)).count() == 0
