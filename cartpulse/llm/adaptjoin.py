"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles; two are linked when the sets have a
similarity of 4/5 or more. All sets are read in one common order, tokens seen often
last. A set of ``n`` tokens shares ``c = ceil(4n/5)`` with any set it is linked to, so
the first ``n - c + m`` tokens of both have at least ``m`` in common: a prefix may be
lengthened by a token for every further match that is then asked for. Every document
takes the ``m`` that its estimated cost is least for: the matches its prefix meets, plus
the sets they make it verify, at most one for every ``m`` matches.

Of two prefixes, what the one that ends first shares is in the other. So a set of ``n`` of
which ``own`` tokens are in no other prefix shares ``n - own`` at most with a set whose
prefix ends later, and a pair whose sizes ask for more never meets. A pair that does is
verified if it shares at least the smaller ``m`` of the two, if what follows the last
shared token can still fill up the overlap, and if the bits that its bitmaps differ in
leave room for it. Likewise for what lies before and after a shared token. All of this
only lets pairs go that cannot be linked.

A group of similar documents isn't expanded into pairs:

1. Equal sets are folded to one node.
2. Every shared token is led by the node with the fewest tokens of its own, most often
   the text that the others were made from. Nodes are compared with the leaders they meet.
3. The complete join then looks for pairs of different components only, and a token
   whose nodes are all in one component makes none.

How often a token is seen is counted over all documents by its slot. The counts steer
the order and ``m``; any counts give the same links.

Defined cases: words are runs without white space (space, \\t \\n \\v \\f \\r), A-Z
lower-cased; a text of fewer words than a shingle is one shingle; a text without words,
or null, is an empty set, linked with nothing, its own component. Repeated rows and equal
ids are rows of their own; a null ``doc_id`` stays null and is a component's id only if
all its ids are null. An empty table gives no rows. Other columns are not read. Shingles
are told apart by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm import tables
from cartpulse.llm.components import components
from cartpulse.llm.similar import frequent_slots, keyed, seen_often, shingle_hashes

MOST_MATCHES = 8
# Verifying a set costs about as much as a match for every so many of its tokens.
TOKENS_PER_MATCH = 4
# Lists of up to so many keys are sent to all tasks, longer ones meet their rows in a shuffle.
KEYS_TO_SEND = 1 << 20
# Bits that mark shared tokens, in parts of the size that Spark's bitmap functions have.
MARKS = 1 << 25
_PART = 32_768
ROW = (
    "doc_id bigint, row_key bigint, digest binary, n bigint, matches int,"
    " prefix array<bigint>, bitmap binary, last_seen bigint, last_token bigint,"
    " bits0 bigint, bits1 bigint, bits2 bigint, bits3 bigint"
)
# What a posting tells of its node; the last token, in unsigned order, and its count say
# where the prefix ends; the bits are a bitmap of 256 places.
BITS = ("bits0", "bits1", "bits2", "bits3")
OF_NODE = ("n", "matches", "last_seen", "last_token", *BITS)
OF_TOKEN = ("pos", "own", "rank")
POSTING = (
    "token bigint, node bigint, n bigint, matches int, last_seen bigint, last_token bigint,"
    " bits0 bigint, bits1 bigint, bits2 bigint, bits3 bigint, pos int"
)


def required(n):
    """Tokens that a set of ``n`` shares with any set it is linked to."""
    return (4 * n + 4) // 5


def matches_to_ask(frequencies: np.ndarray, n: int) -> int:
    """The ``m`` of least estimated cost for a set whose tokens are seen so often, in order."""
    least = n - required(n)
    m = np.arange(1, min(MOST_MATCHES, required(n)) + 1)
    met = np.cumsum(frequencies[: least + len(m)] - 1)[least + m - 1]
    cost = least + m + met + met / m * (n / TOKENS_PER_MATCH)
    return int(m[np.argmin(cost)])


def prefix_of(tokens: np.ndarray, frequencies: np.ndarray) -> tuple[int, np.ndarray, int]:
    """(``m``, the prefix in the common order, how often its last token is seen) of a set of hashes."""
    n = len(tokens)
    if not n:
        return 1, tokens, 0
    order = np.lexsort((tokens, frequencies))
    m = matches_to_ask(frequencies[order], n)
    kept = order[: n - required(n) + m]
    return m, tokens[kept], int(frequencies[kept[-1]])


def bitmap(tokens: np.ndarray, bits: int | None = None) -> bytes:
    """A bit for every place, at least ``2n`` of them, set if an odd number of tokens fall there."""
    if bits is None:
        bits = max(64, 1 << int(2 * len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def bits_apart(left: bytes, right: bytes) -> int:
    """Tokens that only one of two sets has, at least so many; the longer bitmap is folded."""
    if len(left) > len(right):
        left, right = right, left
    folded = np.frombuffer(right, np.uint64).reshape(-1, len(left) // 8)
    folded = np.bitwise_xor.reduce(folded, axis=0)
    return int(np.bitwise_count(folded ^ np.frombuffer(left, np.uint64)).sum())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for at in range(0, rows.num_rows, 256):
            yield rows.slice(at, 256)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes, "<u8").view("<i8")


def _rows(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    slots, counts = frequent_slots(docs, words_per_shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = seen_often(slots, counts)
        for part in _parts(batches):
            digests, sizes, asked, prefixes, bitmaps, ends, few = [], [], [], [], [], [], []
            for text in part.column("text"):
                tokens = np.unique(shingle_hashes(text.as_py(), words_per_shingle))
                m, prefix, often = prefix_of(tokens, seen(tokens))
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                sizes.append(len(tokens))
                asked.append(m)
                prefixes.append(_signed(prefix))
                bitmaps.append(bitmap(tokens))
                few.append(np.frombuffer(bitmap(tokens, 256), "<i8"))
                ends.append((often, int(prefix[-1]) - (1 << 63) if len(prefix) else 0))
            columns = [
                part.column("doc_id"),
                part.column("row_key"),
                pa.array(digests, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(asked, pa.int32()),
                pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(bitmaps, pa.binary()),
                *[pa.array(end, pa.int64()) for end in zip(*ends, strict=True)],
                *[pa.array(part) for part in np.stack(few).T.copy()],
            ]
            yield pa.record_batch(columns, [column.split()[0] for column in ROW.split(", ")])

    return keyed(docs).mapInArrow(run, ROW)


def _with_both(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (a, b) with columns of both nodes, called a_... and b_..."""
    for side in "ab":
        named = [F.col(name).alias(f"{side}_{name}") for name in columns]
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *named), side)
    return pairs


def near_enough(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``pairs`` whose bitmaps leave room for a similarity of 4/5."""

    @F.pandas_udf("long")
    def apart(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(map(bits_apart, left, right), dtype="int64")

    both = _with_both(pairs, nodes, "n", "bitmap")
    size = F.col("a_n") + F.col("b_n")
    # the sets have (size - common) / 2 in common at most, and size * 4 / 9 at least
    kept = both.filter(apart("a_bitmap", "b_bitmap") * 9 <= size)
    return tables.stored(kept.select("a", "b"), "join-near")


def _sets(docs: DataFrame, pairs: DataFrame, words_per_shingle: int) -> DataFrame:
    """(node, hashes) of the nodes in ``pairs``; a node is the row key of a text that has the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            own = [
                _signed(np.unique(shingle_hashes(t.as_py(), words_per_shingle)))
                for t in part.column("text")
            ]
            yield pa.record_batch(
                [part.column("row_key"), pa.array(own, pa.list_(pa.int64()))], ["node", "hashes"]
            )

    named = tables.stored(
        pairs.select(F.explode(F.array("a", "b")).alias("row_key")).distinct(), "join-named"
    )
    texts = _by_key(keyed(docs), "row_key", named, "left_semi").select("row_key", "text")
    # a repeated row gives its set again
    found = texts.mapInArrow(run, "node bigint, hashes array<bigint>").dropDuplicates(["node"])
    return tables.stored(found, "join-sets")


def verified(
    docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words_per_shingle: int
) -> DataFrame:
    """The stored ``pairs`` (a, b) of nodes whose sets have a similarity of 4/5 or more."""
    near = near_enough(pairs, nodes)
    both = _with_both(near, _sets(docs, near, words_per_shingle), "hashes")
    size = F.size("a_hashes") + F.size("b_hashes")
    common = F.size(F.array_intersect("a_hashes", "b_hashes"))
    return both.filter(common * 9 >= size * 4).select("a", "b")


def _marks(tokens: DataFrame) -> np.ndarray:
    """``MARKS`` bits, those of the ``tokens`` set: a bounded number, however many tokens there are."""
    place = F.pmod(F.col("token"), F.lit(MARKS)) + 1  # the functions count from 1
    parts = (
        tokens.groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    marks = np.zeros((MARKS // _PART, _PART // 8), dtype=np.uint8)
    for row in parts:
        marks[row["part"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return marks.ravel()


def shared_postings(nodes: DataFrame) -> DataFrame:
    """(token, node, its ``OF_NODE``, pos, own, rank) of the tokens that several prefixes have.

    ``own`` is how many tokens of the node's prefix no other one has, ``rank`` how many
    before this one another has. Most tokens are a node's own: a mark for each of the
    others keeps them from being shuffled once more.
    """
    listed = nodes.select(F.explode("prefix").alias("token"))
    often = listed.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    shared = tables.stored(often.select("token"), "join-tokens")
    marks = _marks(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            prefixes = rows.column("prefix")
            tokens = prefixes.flatten().to_numpy()
            lengths = np.diff(prefixes.offsets.to_numpy())
            place = tokens & (MARKS - 1)
            met = np.flatnonzero(marks[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            owner = np.repeat(np.arange(len(lengths)), lengths)[met]
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            columns = [pa.array(tokens[met])]
            columns += [rows.column(c).take(pa.array(owner)) for c in ("node", *OF_NODE)]
            columns.append(pa.array((met - begin[owner]).astype(np.int32)))
            yield pa.record_batch(columns, ["token", "node", *OF_NODE, "pos"])

    marked = nodes.select("node", *OF_NODE, "prefix").mapInArrow(run, POSTING)
    # rows of one document's prefix; no more than it has tokens
    of_node = Window.partitionBy("node")
    length = F.expr("n - (4 * n + 4) div 5 + matches")
    postings = marked.join(shared, "token", "left_semi").withColumns(
        {
            "own": length - F.count("*").over(of_node),
            "rank": F.row_number().over(of_node.orderBy("pos")) - 1,
        }
    )
    return tables.stored(postings, "join-postings")


def _asked_for(met: DataFrame) -> DataFrame:
    """Pairs (a, b) to verify, of one row for each token that x and y share, whichever is x."""
    in_order = F.col("x") < F.col("y")

    def of(side: str, name: str) -> Column:
        other = "y" if side == "x" else "x"
        return F.when(in_order, F.col(f"{side}_{name}")).otherwise(F.col(f"{other}_{name}"))

    names = ("n", "matches", "pos")
    sides = [of(side, name).alias(f"{to}_{name}") for side, to in ("xa", "yb") for name in names]
    ordered = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *sides)
    most = [F.max(f"{side}_{name}").alias(f"{side}_{name}") for side in "ab" for name in names]
    rest = F.least(F.col("a_n") - 1 - F.col("a_pos"), F.col("b_n") - 1 - F.col("b_pos"))
    return (
        ordered.groupBy("a", "b")
        .agg(F.count("*").alias("shared"), *most)
        .filter(
            (F.col("shared") >= F.least("a_matches", "b_matches"))
            & ((F.col("shared") + rest) * 9 >= (F.col("a_n") + F.col("b_n")) * 4)
        )
        .select("a", "b")
    )


def _side(postings: DataFrame, side: str, *more: str) -> DataFrame:
    named = [F.col(old).alias(f"{side}_{old}") for old in (*OF_NODE, *OF_TOKEN, *more)]
    return postings.select("token", F.col("node").alias(side), *named)


def _alike() -> Column:
    """Whether two sets that share a token may share as many as a link takes.

    The one whose prefix ends first shares none of its own tokens. Before the token both
    share at most what either shares with anyone, after it at most what is left of either.
    The places that their bitmaps differ in are tokens that one of them lacks.
    """
    x_first = (F.col("x_last_seen") < F.col("y_last_seen")) | (
        (F.col("x_last_seen") == F.col("y_last_seen"))
        & (F.col("x_last_token") < F.col("y_last_token"))
    )
    x_most, y_most = (F.col(f"{side}_n") - F.col(f"{side}_own") for side in "xy")
    x_rest, y_rest = (F.col(f"{side}_n") - F.col(f"{side}_pos") for side in "xy")
    sizes = F.least("x_n", "y_n") * 5 >= F.greatest("x_n", "y_n") * 4
    least = (F.col("x_n") + F.col("y_n")) * 4
    around = F.least("x_rank", "y_rank") + F.least(x_rest, y_rest)
    apart = sum(
        (F.bit_count(F.col(f"x_{bits}").bitwiseXOR(F.col(f"y_{bits}"))) for bits in BITS), F.lit(0)
    )
    return (
        sizes
        & (F.when(x_first, x_most).otherwise(y_most) * 9 >= least)
        & (around * 9 >= least)
        & (apart * 9 <= F.col("x_n") + F.col("y_n"))
    )


def leader_pairs(postings: DataFrame) -> DataFrame:
    """Pairs of a node and a leader of one of its tokens."""
    rank = F.struct("own", F.xxhash64("node"), "node", *OF_NODE, "pos", "rank")
    led = postings.groupBy("token").agg(F.min(rank).alias("lead")).select("token", "lead.*")
    x, y = _side(postings, "x"), _side(led, "y")
    return _asked_for(x.join(y, "token").filter((F.col("x") != F.col("y")) & _alike()))


def complete_pairs(postings: DataFrame) -> DataFrame:
    """All pairs of nodes with different ``root`` that may be linked.

    Of the components that a token's nodes are in, the one with the most is matched with
    the others and these among themselves, so nodes of one large component never meet.
    """
    by_root = postings.groupBy("token", "root").agg(F.count("*").alias("held"))
    major = by_root.groupBy("token").agg(
        F.max(F.struct("held", "root")).alias("most"), F.count("*").alias("roots")
    )
    several = major.filter(F.col("roots") > 1).select("token", F.col("most.root").alias("major"))
    live = tables.stored(postings.join(several, "token"), "join-live")
    x = _side(live, "x", "root", "major")
    y = _side(live.filter(F.col("root") != F.col("major")), "y", "root")
    once = (F.col("x_root") == F.col("x_major")) | (F.col("x") < F.col("y"))
    met = x.join(y, "token").filter((F.col("x_root") != F.col("y_root")) & once & _alike())
    return _asked_for(met)


def _rooted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of their component, themselves without an edge."""
    found = components(edges).withColumnsRenamed({"node": "of_node", "root": "of_root"})
    joined = nodes.join(found, F.col("node") == F.col("of_node"), "left")
    return joined.withColumn("root", F.coalesce("of_root", "node")).drop("of_node", "of_root")


def jaccard_groups(
    docs: DataFrame,
    words_per_shingle: int = 5,
    proposed: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): every row's ``doc_id``, ``row_key``, ``n`` and ``digest``, and of every
    digest of a set that is not empty the ``root`` of its component and the ``keeper``, the
    row of smallest id, then key.

    ``proposed`` gives pairs (a, b) of the nodes, which are row keys, that another method
    finds near. They are verified like those of leaders, and the complete join looks for
    pairs of the components that are left.
    """
    rows = tables.stored(_rows(docs, words_per_shingle), "join-rows")
    firsts = [F.any_value(name).alias(name) for name in (*OF_NODE, "prefix", "bitmap")]
    keeper = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("keeper")
    folded = rows.filter("n > 0").groupBy("digest").agg(keeper, *firsts)
    nodes = tables.stored(folded.withColumn("node", F.col("keeper.row_key")), "join-nodes")
    postings = shared_postings(nodes)

    led = leader_pairs(postings)
    if proposed is not None:
        given = proposed(nodes.select("node")).filter("a <> b")
        ordered = given.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        led = led.unionByName(ordered).distinct()
    led = tables.stored(led, "join-led")
    links = tables.stored(verified(docs, nodes, led, words_per_shingle), "join-links")
    rooted = tables.stored(_rooted(nodes.select("node"), links), "join-rooted")

    left = tables.stored(complete_pairs(postings.join(rooted, "node")), "join-left")
    links = links.unionByName(verified(docs, nodes, left, words_per_shingle))
    groups = _rooted(nodes.select("digest", "node", "keeper"), links)
    return rows.select("doc_id", "row_key", "n", "digest"), groups.drop("node")


def jaccard_components(docs: DataFrame, words_per_shingle: int = 5) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    rows, groups = jaccard_groups(docs, words_per_shingle)
    least = groups.groupBy("root").agg(F.min("keeper.doc_id").alias("component_id"))
    named = groups.join(least, "root").select("digest", "component_id")
    return (
        rows.select("doc_id", "digest", F.col("n").alias("n_shingles"))
        .join(named, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
    )


def one_of_each_group(
    docs: DataFrame,
    words_per_shingle: int = 5,
    proposed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The documents' own columns, one document of each component: smallest id, then key.

    Texts without words count as copies of each other here. What is looked for are the
    rows that go, mostly few, so that the texts need no shuffle where these are few.
    """
    rows, groups = jaccard_groups(docs, words_per_shingle, proposed)
    keepers = groups.groupBy("root").agg(F.min("keeper").alias("keeper")).select("keeper")
    wordless = rows.filter("n = 0").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("keeper")
    )
    kept = tables.stored(
        keepers.unionByName(wordless).select(F.col("keeper.row_key").alias("row_key")).dropna(),
        "join-keepers",
    )
    by_key = rows.groupBy("row_key").agg(F.count("*").alias("rows"))
    going = tables.stored(by_key.join(kept, "row_key", "left_anti").select("row_key"), "join-going")
    repeated = tables.stored(
        by_key.filter("rows > 1").join(kept, "row_key", "left_semi").select("row_key"),
        "join-repeated",
    )
    key = tables.free_name(docs, "row_key")
    marked = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    either = tables.stored(going.unionByName(repeated), "join-not-plain")
    plain = _by_key(marked, key, either, "left_anti")
    once = _by_key(marked, key, repeated, "left_semi").dropDuplicates([key])
    return plain.unionByName(once).select(*docs.columns)


def _by_key(rows: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    if keys.count() <= KEYS_TO_SEND:
        keys = F.broadcast(keys)
    return rows.join(keys, rows[key] == keys["row_key"], how)


# Words per document, its shingles, links of all pairs that share one, then components.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
  FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS c
  FROM shingles l JOIN shingles r ON l.s = r.s AND l.doc_id <> r.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least m ON m.doc_id = d.doc_id
"""
