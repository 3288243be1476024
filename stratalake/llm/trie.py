"""Prefix trie of conversations by fixed-length block hashing.

A node is a distinct sequence of first turns (role and text); its members are the
conversations that start with it. Conversations are hashed in blocks of ``BLOCK`` turns
and grouped by (prefix, block) digests first: one row for all conversations that agree in
a whole block. Only where several blocks follow one prefix are they taken apart turn by
turn and merged as far as they agree; elsewhere a block's turns are nodes as they stand.

Sums over subtrees need no walk down the trie. Each node belongs to its smallest member,
and a conversation owns the nodes of its path from some depth on. Words that a node saves
are counted once for each member that does not own it, so a conversation adds, to every
node of its path, its words from there to where it begins to own. A childless node is
counted by its owner. Both are sums over members, taken with the member counts.

Turns travel as digests. A conversation is cut into slots of ``SLOT`` turns, so that one
conversation, however long, is many rows; prefixes across slots are running xors of slot
digests. Every grouping is summed before it is shuffled, and joins on a prefix that many
share broadcast the few prefixes that are that common (:func:`join_unique`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_unique, staged

BLOCK = 4
SLOT = 256  # turns, a multiple of BLOCK
#: Members that end in one node are hashed in runs of this many ids.
RUN_BITS = 8
HEADS = 4
HEAD_EVERY = 20


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def ordered(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, slot, start, turns: runs of turns in order of turn number, ``start`` turns before them.

    A null turn number comes first; equal ones are ordered by the digest of role and text.
    Null role or text is empty. Rows without a conversation id are left out.
    """
    turn = F.col(turn_col).cast("long")
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.when(turn.isNull(), _long(-(2**63))).otherwise(F.shiftright(turn, 8)).alias("slot"),
        F.struct(
            turn.isNotNull().alias("numbered"), F.coalesce(turn, _long(0)).alias("turn"),
            turn_digest(F.col(role_col), F.col(text_col)).alias("digest"), words.alias("words"),
        ).alias("t"),
    )
    slots = rows.groupBy("conv_id", "slot").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    slots = staged(slots.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["words"]))), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.select("conv_id", "slot", F.coalesce(F.sum(F.size("turns")).over(before), F.lit(0)).alias("start"))
    return slots.join(starts, ["conv_id", "slot"])


def plain(slots: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest, words of the turns as they are."""
    return slots.select("conv_id", "start", F.posexplode("turns").alias("i", "t")).select(
        "conv_id", (F.col("start") + F.col("i")).alias("pos"), "t.*"
    )


def conversations_of(slots: DataFrame) -> DataFrame:
    """conv_id, n: the number of turns."""
    return slots.groupBy("conv_id").agg(F.sum(F.size("turns")).alias("n"))


def with_heads(slots: DataFrame, heads: int = HEADS, every: int = HEAD_EVERY) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of conversation c - c % every, then c's own after its first h.

    h is crc32(c as text) % heads. Returns the turns (as :func:`plain`) and conv_id, n of every conversation.
    """
    slots = staged(slots, "trie-starts")
    most = heads - 1
    first = plain(slots.where((F.col("conv_id") % every == 0) & (F.col("start") < most)))
    first = first.where(F.col("pos") < most).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    convs = conversations_of(slots).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(first, "base", "left")
    # slice() counts from 1; h = 0 or an absent base gives no turns
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice(F.array(F.struct(_long(0).alias("pos"), F.lit(b"").alias("digest"), _long(0).alias("words"))), 1, 0))
    convs = convs.withColumn("head", head).withColumn("k", F.size("head"))
    convs = staged(convs.select("conv_id", "n", "h", "k", "head"), "trie-heads")
    shift = slots.select("conv_id", "slot").join(convs.select("conv_id", "h", "k"), "conv_id")
    own = slots.join(shift, ["conv_id", "slot"]).select("conv_id", "h", "k", "start", F.posexplode("turns").alias("i", "t"))
    own = own.where(F.col("start") + F.col("i") >= F.col("h"))
    own = own.select("conv_id", (F.col("start") + F.col("i") - F.col("h") + F.col("k")).alias("pos"), "t.*")
    heads_ = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    return own.unionByName(heads_), convs.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


def _slots(turns: DataFrame) -> DataFrame:
    """Slots by position, with the digest (p1, p2) and words of all before, and their own digest (h1, h2)."""
    cut = turns.groupBy("conv_id", F.floor(F.col("pos") / SLOT).alias("slot"))
    cut = cut.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("t"))
    cut = cut.select("conv_id", "slot", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))
    for i in (1, 2):
        cut = cut.withColumn(f"h{i}", F.xxhash64(F.lit(i), "slot", "digests"))
    cut = staged(cut.withColumn("sum", F.aggregate("words", _long(0), lambda a, x: a + x)), "trie-slots")
    before = Window.partitionBy("conv_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    run = [F.coalesce(F.bit_xor(f"h{i}").over(before), _long(0)).alias(f"p{i}") for i in (1, 2)]
    run.append(F.coalesce(F.sum("sum").over(before), _long(0)).alias("said"))
    return cut.join(cut.select("conv_id", "slot", *run), ["conv_id", "slot"])


def _key(at: Column) -> Column:
    """Digest of all turns before place ``at`` of a slot; its end is the next slot's start."""
    whole = at == SLOT
    some = F.slice("digests", F.lit(1), F.when(whole, 0).otherwise(at).cast("int"))
    base = [F.when(whole, F.col(f"p{i}").bitwiseXOR(F.col(f"h{i}"))).otherwise(F.col(f"p{i}")) for i in (1, 2)]
    return F.struct(F.xxhash64(F.lit(3), *base, some).alias("a"), F.xxhash64(F.lit(4), *base, some).alias("b"))


def _root_key() -> Column:
    """What :func:`_key` gives at the start of every conversation."""
    none, zero = F.array().cast("array<binary>"), _long(0)
    return F.struct(F.xxhash64(F.lit(3), zero, zero, none).alias("a"), F.xxhash64(F.lit(4), zero, zero, none).alias("b"))


def _blocks(slots: DataFrame, *extra: str) -> DataFrame:
    """One row a block: conv_id, depth and prefix before it, keys, words of its turns, ``said`` words before each, ends."""
    rows = slots.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("digests") - 1, F.lit(BLOCK))))
    size = F.least(F.lit(BLOCK), F.size("digests") - F.col("at"))
    rows = rows.withColumn("keys", F.transform(F.sequence(F.lit(0), size), lambda j: _key(F.col("at") + j)))
    before = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda j: F.aggregate(F.slice("words", F.lit(1), F.col("at") + j), F.col("said"), lambda a, x: a + x),
    )
    depth = F.col("slot") * SLOT + F.col("at")
    # under names of their own first: inside one select an alias may hide a column of its name
    rows = rows.select(
        "conv_id", depth.alias("depth"), F.col("keys")[0].alias("prefix"), F.slice("keys", F.lit(2), size).alias("b1"),
        F.slice("words", F.col("at") + 1, size).alias("b2"), before.alias("b3"), (depth + size == F.col("n")).alias("ends"), *extra,
    )
    return rows.withColumnsRenamed({"b1": "keys", "b2": "words", "b3": "said"})


BLOCK_KEY = ["depth", "prefix", "keys", "words", "said"]


def _refine(blocks: DataFrame, sums: list[str], each: list[str]) -> DataFrame:
    """Nodes of grouped blocks: depth, key, parent, words, said, conv_id, n, ends and ``sums``; ``each`` has one column a turn."""
    blocks = staged(blocks, "trie-blocks")
    forks = blocks.groupBy("depth", "prefix").agg(F.count("*").alias("siblings")).where("siblings > 1")
    marked = join_unique(blocks, forks, ["depth", "prefix"], "siblings", "left")
    last = F.col("j") == F.size("keys") - 1
    turns = marked.select("*", F.posexplode("keys").alias("j", "key")).select(
        F.col("siblings").isNotNull().alias("fork"), (F.col("depth") + F.col("j") + 1).alias("t0"), "key",
        F.when(F.col("j") == 0, F.col("prefix")).otherwise(F.get("keys", F.col("j") - 1)).alias("parent"),
        F.get("words", F.col("j")).alias("t1"), F.get("said", F.col("j")).alias("t2"), "conv_id", "n",
        F.when(last, F.col("ends")).otherwise(0).alias("t3"), *sums,
        *([F.get(F.array(*each), F.col("j")).alias("saved")] if each else []),
    )
    turns = staged(turns.withColumnsRenamed({"t0": "depth", "t1": "words", "t2": "said", "t3": "ends"}), "trie-turns")
    added = [*sums, *(["saved"] if each else [])]
    merged = turns.where("fork").groupBy("depth", "key", "parent", "words", "said").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("ends").alias("ends"), *[F.sum(c).alias(c) for c in added]
    )
    return turns.where("not fork").drop("fork").unionByName(merged)


def _member_digests(ends: DataFrame) -> DataFrame:
    """depth, key, ends_sha256 of (depth, key, conv_id): runs of ids are joined in parallel, then hashed run by run."""
    runs = ends.groupBy("depth", "key", F.shiftright("conv_id", RUN_BITS).alias("run"))
    runs = runs.agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    runs = runs.select("depth", F.col("key.a").alias("a"), F.col("key.b").alias("b"), "run", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    runs = runs.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "run")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["depth", "a", "b", "ends_sha256"]
        at, state, out = None, None, []

        def table():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.string()])], names)

        for batch in batches:
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == at:
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode())
            if out:
                yield table()
                out.clear()
        if at is not None:
            out.append((*at, state.hexdigest()))
            yield table()

    found = runs.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")
    return found.select("depth", F.struct("a", "b").alias("key"), "ends_sha256")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, pos from 0 without gaps, digest, words).

    ``convs`` has conv_id, n (turns) of every conversation once, those without turns
    included. One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. No conversation, no node.
    """
    convs = staged(convs, "trie-convs")
    slots = _slots(turns)
    slots = staged(slots.join(convs, "conv_id"), "trie-prefixes")  # a slot is many turns: no conversation is a hot key here
    said = slots.groupBy("conv_id").agg(F.sum("sum").alias("all_words"))

    member = [F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.sum(F.col("ends").cast("long")).alias("ends")]
    first = _refine(_blocks(slots).groupBy(*BLOCK_KEY).agg(*member), [], [])
    # from which depth on a conversation owns its path, and whether that ends in a childless node
    owned = first.groupBy("conv_id").agg(
        F.min(F.struct("depth", "said")).alias("top"), F.max((F.col("n") == F.col("ends")).cast("long")).alias("leaf")
    )
    owner = convs.join(said, "conv_id", "left").join(owned, "conv_id", "left")
    owner = owner.select(
        "conv_id", "n", F.coalesce("top.said", "all_words", _long(0)).alias("shared"), F.coalesce("leaf", _long(0)).alias("leaf")
    )
    owner = staged(owner, "trie-owners")
    blocks = _blocks(slots.join(owner.select("conv_id", "shared", "leaf"), "conv_id"), "shared", "leaf")
    each = [f"s{j}" for j in range(BLOCK)]
    saved = [F.sum(F.greatest(F.col("shared") - F.get("said", F.lit(j)), _long(0))).alias(c) for j, c in enumerate(each)]
    nodes = _refine(blocks.groupBy(*BLOCK_KEY).agg(*member, F.sum("leaf").alias("leaves"), *saved), ["leaves"], each)

    root = owner.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.sum((F.col("n") == 0).cast("long")).alias("ends"),
        F.greatest(F.sum("leaf"), _long(1)).alias("leaves"), F.sum("shared").alias("saved"),
    ).where("n > 0")
    root = root.select(_long(0).alias("depth"), _root_key().alias("key"), F.lit(None).cast("struct<a: long, b: long>").alias("parent"), "conv_id", "n", "ends", "leaves", "saved")
    nodes = staged(nodes.select(*root.columns).unionByName(root), "trie-nodes")

    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key"))
    nodes = nodes.join(kids.agg(F.count("*").alias("n_children")), ["depth", "key"], "left").fillna(0, ["n_children"])
    ends = _blocks(slots).where("ends").select((F.col("depth") + F.size("keys")).alias("depth"), F.element_at("keys", -1).alias("key"), "conv_id")
    turnless = convs.where("n = 0").select(_long(0).alias("depth"), _root_key().alias("key"), "conv_id")
    ends = ends.unionByName(turnless)
    nodes = staged(nodes.join(_member_digests(ends), ["depth", "key"], "left"), "trie-linked")

    above = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("many")
    )
    below = join_unique(nodes.where("depth > 0"), above, ["depth", "parent"], "many", "inner").drop("many")
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """:func:`trie` of conversations as they are.

    Turn numbers may be null, negative, repeated or have gaps (see :func:`ordered`);
    repeated rows are turns of their own. Rows without a conversation id are left out;
    an empty table has no nodes. Other columns are ignored. Ids must be whole numbers.
    """
    slots = staged(ordered(conversations, **columns), "trie-starts")
    return trie(plain(slots), conversations_of(slots))


def rebuilt_trie(conversations: DataFrame, heads: int = HEADS, every: int = HEAD_EVERY, **columns: str) -> DataFrame:
    """:func:`trie` of conversations rebuilt by :func:`with_heads`; rows are taken as in :func:`prefix_trie`."""
    return trie(*with_heads(ordered(conversations, **columns), heads, every))


#: Paths as text; subtrees by listing every node's ancestors.
SQL = """
WITH tbl AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256))::BIGINT AS i))),
o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce([4294967295::BIGINT] ||
    list_transform(range(1, strlen(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), tbl),
b AS (
  SELECT h.conv_id, 0 AS side, pos, said, words FROM h JOIN o ON o.conv_id = h.base AND o.pos <= h.h
  UNION ALL SELECT h.conv_id, 1, pos, said, words FROM h JOIN o ON o.conv_id = h.conv_id AND o.pos > h.h),
c AS (
  SELECT h.conv_id, coalesce(list(said ORDER BY side, pos) FILTER (said IS NOT NULL), []) AS path, coalesce(list(words ORDER BY side, pos) FILTER (said IS NOT NULL), []) AS words
  FROM h LEFT JOIN b USING (conv_id) GROUP BY 1),
m AS (SELECT conv_id, d, path[1:d] AS node, coalesce(words[d], 0) AS words, len(path) = d AS ends FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM c)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words, count(*) FILTER (ends) AS ends,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ended
  FROM m GROUP BY 1, 2),
a AS (SELECT node[1:i] AS node, (n - 1) * words AS saved, (n = ends)::INT AS leaf FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM n)),
s AS (SELECT node, sum(saved)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves FROM a GROUP BY 1),
k AS (SELECT node[1:d - 1] AS node, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
FROM n JOIN s ON n.node = s.node LEFT JOIN k ON n.node = k.node LEFT JOIN n p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.node[1:n.d - 1]
"""
