"""The prefix trie of conversations, by truncation peeling (operator 12).

Peeling starts at the maximum depth: the conversations that end there are
the deepest nodes.  Their last turn is stripped, equal ones are regrouped,
the conversations that end at this depth join them, and so on up to the
root.  A node is met once, when everything below it is already summed up.

Level by level over all conversations this would be a job per turn, so
the trie is cut where it gets light:

1. Turns become 128-bit hashes mixed with their position.  A prefix is the
   exclusive or of its turns' hashes, and its parent is the same without
   the last.  Positions come from a dense index over a range partitioning,
   running hashes from blocks of positions, so one conversation may hold
   any share of the rows.
2. Conversations that are equal as a whole are one path with their count
   and smallest id.
3. A prefix with more than ``LIGHT`` turns at and below it is heavy; this
   is counted with partial sums.  Everything below the heavy prefixes is
   dealt to tasks, whole subtries of at most ``LIGHT`` turns each, and
   peeled there from the deepest turn up.
4. The heavy prefixes on top, the crown, take over the sums of the
   subtries below them and are peeled in one task if there are at most
   ``LIGHT`` of them, else level by level, a job each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefeed.llm.common import named, parts_for, saved, ship
from linefeed.operators.index import with_dense_index
from linefeed.operators.joins import join_dimension

#: Conversations come in families of this many ids; the first turns of a family's first one open all of them.
FAMILY, SHARED = 20, 4
#: Turns of a subtrie that is peeled in one task, at most.
LIGHT = 20_000
#: Positions whose hashes are added up together, and conversation ids written out together.
BLOCK, IDS = 4096, 16_384

#: What separates the words of a turn, as a class of Java and RE2.
BLANKS = r"[\x20\x09-\x0D]+"


# --- rebuilt conversations -----------------------------------------------------------

def ordered_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv_id, pos, role, digest, words``: every conversation's turns numbered from 0.

    Order is by turn, null first; equal turns stand by role, then by the
    SHA-256 of their text.  Null roles and texts are empty; rows without a
    conversation id belong to none and are left out; repeated rows are
    turns each.  Only the texts' digests are shuffled.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    words = F.size(F.filter(F.split(text, BLANKS), lambda w: w != "")).cast("long")
    rows = messages.where(named(conv_col).isNotNull()).select(
        named(conv_col).cast("long").alias("conv_id"), named(turn_col).cast("long").alias("turn"),
        F.coalesce(named(role_col), F.lit("")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        words.alias("words"))
    placed = with_dense_index(rows, ["conv_id", "turn", "role", "digest"], name="place")
    firsts = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return saved(placed.join(firsts, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("pos"),
                                                       "role", "digest", "words"))


def borrowed(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its family: a checksum of its id, below ``SHARED``."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(SHARED))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (``conv_id, pos, role, digest, words, length``) and all conversations (``conv_id, length``).

    A conversation is the first turns of its family's first one (all if it
    has fewer, none if it is absent), and its own turns after as many.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = saved(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    convs = sizes.select("conv_id", "n", base.alias("base"), borrowed(F.col("conv_id")).alias("h"))
    bases = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("has"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    convs = saved(convs.select("conv_id", "base", "h", "taken", (
        F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = (turns.join(convs, "conv_id").where("pos >= h")
           .withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")))
    heads = turns.where((F.col("pos") < SHARED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.where("taken > 0"), "base").where("pos < taken")
    columns = ["conv_id", "pos", "role", "digest", "words", "length"]
    return own.select(columns).unionAll(heads.select(columns)), convs.select("conv_id", "length")


# --- prefixes --------------------------------------------------------------------------

def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv_id, depth, length, words, a, b, up_a, up_b``: the hash of every prefix and of the prefix before it."""
    turn = ["pos", "role", "digest"]
    rows = rebuilt.select("conv_id", "pos", "length", "words", F.floor(F.col("pos") / BLOCK).alias("block"),
                          F.xxhash64(*turn).alias("own_a"), F.xxhash64(F.lit("second"), *turn).alias("own_b"))
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"a": F.bit_xor("own_a").over(within), "b": F.bit_xor("own_b").over(within)})
    # the few conversations longer than a block start every further one with the hash of the blocks before
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rebuilt.where(F.col("length") > BLOCK)
              .select("conv_id", F.floor(F.col("pos") / BLOCK).alias("block"), F.xxhash64(*turn).alias("a"),
                      F.xxhash64(F.lit("second"), *turn).alias("b"))
              .groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
              .select("conv_id", "block", F.bit_xor("a").over(earlier).alias("before_a"),
                      F.bit_xor("b").over(earlier).alias("before_b")))
    rows = rows.join(blocks, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({k: F.col(k).bitwiseXOR(F.coalesce(f"before_{k}", zero)) for k in "ab"})
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "length", "words", "a", "b",
                       F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"),
                       F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b"))


ENDS = "depth long, a long, b long, n_same long, conv_id long, ends_sha256 string"


def distinct_ends(ends: DataFrame) -> DataFrame:
    """Per distinct whole conversation (``depth, a, b``): how many there are, the smallest id, the digest of all ids.

    Ids are gathered by ranges of ``IDS`` numbers, so a row stays small; the
    ranges of one conversation then pass by in order through a running
    SHA-256, one at a time.
    """
    key = ["depth", "a", "b"]
    chunk = F.floor(F.col("conv_id") / IDS)
    chunks = ends.groupBy(*key, chunk.alias("chunk")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    parts = parts_for(ends.sparkSession)
    chunks = chunks.repartition(parts, *key).sortWithinPartitions(*key, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, low, digest, done = None, 0, 0, None, []
        for batch in batches:
            for *at, _, many, least, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == now:
                    digest.update(b",")
                    n += many
                else:
                    if now:
                        done.append((*now, n, low, digest.hexdigest()))
                    now, n, low, digest = at, many, least, hashlib.sha256()
                digest.update(ids.encode())
            yield _ends(done)
            done = []
        if now:
            yield _ends([(*now, n, low, digest.hexdigest())])

    return chunks.mapInArrow(run, ENDS)


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["depth", "a", "b", "n_same", "conv_id", "ends_sha256"])


# --- peeling ---------------------------------------------------------------------------

NODE = ("depth long, a long, b long, up_a long, up_b long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
SUMS = ("n_children", "n_leaves", "saved_tokens")


def _levels(depth: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal depths, the deepest first; ``depth`` ascends."""
    cuts = np.flatnonzero(np.diff(depth)) + 1
    return reversed(list(zip([0, *cuts], [*cuts, len(depth)], strict=True)))


def _peel(depth: np.ndarray, parent: np.ndarray, words: np.ndarray, convs: np.ndarray, low: np.ndarray,
          sums: dict[str, np.ndarray]) -> None:
    """Strip the last turn from the deepest nodes and merge them into their parents, level by level.

    The arrays go by node, ascending by depth, and are completed in place.
    ``convs`` starts as the conversations that end at a node and ``low`` as
    the smallest of their ids; ``parent`` is -1 where the peeling stops.
    """
    kids, leaves, spared = (sums[s] for s in SUMS)
    for first, last in _levels(depth):
        here = slice(first, last)
        leaves[here] += kids[here] == 0
        spared[here] += (convs[here] - 1) * words[here]
        up = parent[here]
        inside = up >= 0
        up = up[inside]
        np.add.at(kids, up, 1)
        for of in (leaves, spared, convs):
            np.add.at(of, up, of[here][inside])
        np.minimum.at(low, up, low[here][inside])


def _peel_paths(table: pa.Table) -> pa.Table:
    """All nodes of some subtries, from the turns of their distinct conversations."""
    col = {name: table.column(name).to_numpy() for name in table.column_names if name != "ends_sha256"}
    by_conv = np.lexsort((col["depth"], col["conv_id"]))
    col = {name: values[by_conv] for name, values in col.items()}
    ends = table.column("ends_sha256").take(pa.array(by_conv))
    # equal prefixes are one node
    order = np.lexsort((col["b"], col["a"], col["depth"]))
    new = np.ones(len(order), dtype=bool)
    for i, name in enumerate(("depth", "a", "b")):
        differs = np.diff(col[name][order]) != 0
        new[1:] = differs if i == 0 else new[1:] | differs
    node = np.empty(len(order), dtype=np.int64)
    node[order] = np.cumsum(new) - 1
    head = order[new]
    n = len(head)
    # a turn's parent is the node of the turn before it, in the row above
    parent = np.full(n, -1, dtype=np.int64)
    inner = np.flatnonzero(col["depth"] > col["top"])
    parent[node[inner]] = node[inner - 1]
    ended = np.flatnonzero(col["depth"] == col["length"])
    convs, low = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(convs, node[ended], col["n_same"][ended])
    np.minimum.at(low, node[ended], col["conv_id"][ended])
    sums = {s: np.zeros(n, np.int64) for s in SUMS}
    _peel(col["depth"][head], parent, col["words"][head], convs, low, sums)
    end_of = np.full(n, -1, dtype=np.int64)
    end_of[node[ended]] = ended
    return pa.table({
        **{name: col[name][head] for name in ("depth", "a", "b", "up_a", "up_b")}, "conv_id": low,
        "parent_conv_id": pa.array(np.where(parent < 0, 0, low[parent]), mask=parent < 0), "n_convs": convs, **sums,
        "ends_sha256": ends.take(pa.array(end_of, mask=end_of < 0))})


def _peel_crown(table: pa.Table) -> pa.Table:
    """The heavy nodes, which bring the sums of the subtries below them; their conversations are counted already."""
    order = np.argsort(table.column("depth").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    col = {name: table.column(name).to_numpy() for name in table.column_names if name != "ends_sha256"}
    place = {at: i for i, at in enumerate(zip(*(col[c].tolist() for c in ("depth", "a", "b")), strict=True))}
    parent = np.array([place.get((d - 1, a, b), -1) for d, a, b in zip(
        *(col[c].tolist() for c in ("depth", "up_a", "up_b")), strict=True)], dtype=np.int64)
    sums = {s: col[s].copy() for s in SUMS}
    ended = col["n_convs"].copy()
    np.subtract.at(ended, parent[parent >= 0], col["n_convs"][parent >= 0])  # peeling adds them again
    low = col["conv_id"].copy()
    _peel(col["depth"], parent, col["words"], ended, low, sums)
    return pa.table({
        **{name: col[name] for name in ("depth", "a", "b", "up_a", "up_b", "conv_id")},
        "parent_conv_id": pa.array(np.where(parent < 0, 0, low[parent]), mask=parent < 0),
        "n_convs": ended, **sums, "ends_sha256": table.column("ends_sha256")})


def _crown_by_levels(crown: DataFrame) -> DataFrame:
    """``_peel_crown`` as a job per level, for a crown that is too large for one task."""
    deepest = crown.agg(F.max("depth")).first()[0]
    if deepest is None:
        return crown.sparkSession.createDataFrame([], NODE)
    done, below = [], None
    ids = crown.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
                       F.col("conv_id").alias("parent_conv_id"))
    for depth in range(deepest, -1, -1):
        here = crown.where(F.col("depth") == depth)
        if below is not None:
            got = below.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
                F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("spared"))
            here = here.join(got, ["a", "b"], "left")
            here = here.withColumns({s: F.col(s) + F.coalesce(g, F.lit(0)) for s, g in zip(
                SUMS, ("kids", "leaves", "spared"), strict=True)})
        here = here.withColumns({"n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
                                 "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")})
        below = saved(here.select("depth", "a", "b", "up_a", "up_b", "conv_id", "n_convs", *SUMS, "ends_sha256"))
        done.append(below)
    nodes = reduce(DataFrame.unionAll, done)
    return nodes.join(ids, ["depth", "up_a", "up_b"], "left").select(*(c.split()[0] for c in NODE.split(", ")))


def prefix_trie(messages: DataFrame, light: int = LIGHT, rebuilt: bool = True) -> DataFrame:
    """Every node of the trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a sequence of first turns (role and text); ``conv_id`` is the
    smallest conversation that starts with it, so it and the depth name the
    node.  With ``rebuilt`` false, conversations are taken as they are.  A
    conversation without turns is a member of the root alone.  Order, nulls
    and ties are those of ``ordered_turns``; no conversations give no rows,
    not even a root.
    """
    ship(messages.sparkSession)
    turns = ordered_turns(messages)
    if rebuilt:
        rows, convs = rebuild(turns)
    else:
        convs = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
        rows = turns.join(convs, "conv_id")
    every = saved(prefixes(rows))
    zero = F.lit(0).cast("long")
    ends = saved(distinct_ends(every.where("depth = length").select("depth", "a", "b", "conv_id").unionAll(
        convs.where("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))))
    paths = saved(every.join(ends.select("conv_id", "n_same", "ends_sha256"), "conv_id").withColumn(
        "ends_sha256", F.when(F.col("depth") == F.col("length"), F.col("ends_sha256"))))

    # the crown: prefixes with more than ``light`` turns at and below them, and the root
    key = ["depth", "a", "b"]
    heavy = saved(paths.groupBy(*key, "up_a", "up_b", "words").agg(
        F.sum("n_same").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.max("ends_sha256").alias("ends_sha256"))
        .where(F.col("weight") > light).drop("weight"))
    root = (ends.agg(F.sum("n_same").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                     F.max(F.when(F.col("depth") == 0, F.col("ends_sha256"))).alias("ends_sha256"))
            .where("n_convs is not null")
            .select(*(zero.alias(c) for c in (*key, "up_a", "up_b", "words")), "n_convs", "conv_id", "ends_sha256"))
    crown = heavy.unionByName(root)

    # whole subtries below it go to tasks; a conversation is under its heavy prefixes one by one
    on_heavy = join_dimension(paths.select("conv_id", *key), heavy.select(*key), key, "left_semi")
    tops = on_heavy.groupBy("conv_id").agg((F.count("*") + 1).alias("top"))
    under = paths.join(tops, "conv_id", "left").withColumn("top", F.coalesce("top", F.lit(1).cast("long")))
    under = under.where("depth >= top")
    n_rows = paths.count()
    bins = max(1, -(-n_rows // light))
    homes = under.where("depth = top").select("conv_id", F.pmod(F.xxhash64("depth", "a", "b"), F.lit(bins)).alias("bin"))
    light_nodes = saved(under.join(homes, "conv_id").groupBy("bin").applyInArrow(
        lambda table: _peel_paths(table.drop_columns(["bin"])), NODE))

    # what hangs on the crown is added to it
    is_top = F.col("parent_conv_id").isNull()
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    hung = light_nodes.where(is_top).groupBy(*up).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"))
    crown = saved(crown.join(hung, key, "left").fillna(0, list(SUMS)))
    crown_nodes = (saved(crown.groupBy().applyInArrow(_peel_crown, NODE)) if crown.count() <= light
                   else saved(_crown_by_levels(crown)))
    parents = crown_nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"),
                                 F.col("b").alias("up_b"), F.col("conv_id").alias("parent"))
    hanging = join_dimension(light_nodes.where(is_top), parents, ["depth", "up_a", "up_b"], "left").withColumn(
        "parent_conv_id", F.col("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", *SUMS,
               F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")]
    return (light_nodes.where(~is_top).select(columns).unionAll(hanging.select(columns))
            .unionAll(crown_nodes.select(columns)))


#: The same in DuckDB.  A conversation's prefixes are hashes of all turns so
#: far; a node's subtree is found through the first conversation of each node.
ORACLE = """
WITH RECURSIVE ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), crc(conv_id, rest, c) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT conv_id, rest[2:], list_reduce(
    [xor(c, ascii(rest[1])::BIGINT)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  FROM crc WHERE rest <> ''
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(c, 4294967295::BIGINT) % 4 AS h FROM crc WHERE rest = ''
), rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth,
         sha256(to_json([role, text])::VARCHAR) AS turn,
         len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words
  FROM rebuilt
), prefixes AS (
  SELECT conv_id, depth, words, sha256(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS p
  FROM numbered
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id
), nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = length), ''))
           AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY depth, p
), parents AS (
  SELECT n.depth, n.p, n.conv_id, n.words, n.n_convs, n.ends_sha256, q.p AS up
  FROM nodes n LEFT JOIN prefixes q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1
), kids AS (
  SELECT depth - 1 AS depth, up AS p, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
), whole AS (
  SELECT parents.*, coalesce(n_children, 0) AS n_children FROM parents LEFT JOIN kids USING (depth, p)
), subtrees AS (
  SELECT a.depth, a.p, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((w.n_convs - 1) * w.words) AS saved_tokens
  FROM whole w JOIN prefixes a ON a.conv_id = w.conv_id AND a.depth <= w.depth GROUP BY a.depth, a.p
)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN subtrees s USING (depth, p) LEFT JOIN nodes u ON u.depth = w.depth - 1 AND u.p = w.up
"""


def brute_force(rows: list[tuple], rebuilt: bool = True) -> list[tuple]:
    """The trie's rows from (conv_id, turn, role, text), prefix by prefix; for tests."""
    import re
    import zlib
    turns: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            text = text or ""
            turns.setdefault(c, []).append(
                ((t is not None, t or 0, role or "", hashlib.sha256(text.encode()).digest()), (role or "", text)))
    own = {c: tuple(x for _, x in sorted(t)) for c, t in turns.items()}
    whole = dict(own)
    if rebuilt:
        for c in own:
            h = zlib.crc32(str(c).encode()) % SHARED
            base = c - int(np.fmod(c, FAMILY))
            whole[c] = own.get(base, ())[:h] + own[c][h:]
    members: dict[tuple, list] = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    out = []
    for p, of in members.items():
        below = [q for q in members if q[:len(p)] == p]
        inner = {q[:-1] for q in below if q}
        spared = sum((len(members[q]) - 1) * len([w for w in re.split(r"[\x20\x09-\x0D]+", q[-1][1]) if w])
                     for q in below if q)
        ends = ",".join(map(str, sorted(c for c in of if len(whole[c]) == len(p))))
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of),
                    sum(len(q) == len(p) + 1 for q in below), sum(q not in inner for q in below), spared,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out
