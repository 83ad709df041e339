"""Prefix trie of conversations, encoded as balanced parentheses shard by shard.

Every conversation is the path of its turns' digests. Paths are sorted over the
cluster and cut into shards; a shard writes its part of the trie as balanced
parentheses in depth-first order. A range min-max tree over blocks of excess finds
the close of every node and with it the subtree; ranks of leaf pairs count leaves,
cumulative arrays add up savings. Only the prefixes of a shard's first and last path
(its spine) can also stand in other shards: their parts are corrected by what the
neighbours share, and added up by node. All other nodes are final where they arise.

Long conversations are cut into segments of ``SEGMENT`` turns. The segments behind
one prefix form a trie of their own, whose totals are hung to its top in the level
above, from the deepest level upwards; no row holds more than one segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.storage import small, written
from tabloom.operators.ordering import number_rows

FAMILY = 20
HEADS = 4
SEGMENT = 1024
SHARD_TURNS = 200_000
BLOCK = 64
PACKET_IDS = 20_000
DIGEST = 16
NOBODY = np.iinfo(np.int64).max


def _digest(role: Column, text: Column) -> Column:
    """Hex digest of a turn; the length of the role keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * DIGEST)


def rebuilt_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, digest, words) of every rebuilt turn, and (conv_id, length) of every conversation.

    Turns are ordered by ``turn`` (NULL first), equal ones by digest. A conversation
    takes its first turns, up to three, from the first of its family of twenty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    light = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        _digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    numbered = written(number_rows(written(light, "trie-turns"), ["turn", "digest"], ["conv_id"], "rn"), "trie-numbered")

    heads = numbered.where(F.col("rn") < HEADS).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("rn", "digest", "words"))).alias("heads"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = numbered.groupBy("conv_id").agg(F.max("rn").alias("own")).withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "heads"), "base", "left")
    convs = convs.withColumn("brought", F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.col("h").cast("int")))
    convs = written(convs.select("conv_id", "h", "own", "brought", F.size("brought").cast("bigint").alias("nb")), "trie-convs")

    first = convs.select("conv_id", F.posexplode("brought").alias("at", "t")).select("conv_id", (F.col("at") + 1).cast("bigint").alias("at"), "t.digest", "t.words")
    rest = numbered.join(convs.select("conv_id", "h", "nb"), "conv_id").where("rn > h")
    rest = rest.select("conv_id", (F.col("rn") - F.col("h") + F.col("nb")).alias("at"), "digest", "words")
    lengths = convs.select("conv_id", (F.col("nb") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return first.unionByName(rest), lengths


def _segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and level: path and words of its turns there, and the names of the prefixes before and after."""
    level = F.floor((F.col("at") - 1) / segment).cast("int")
    packed = turns.groupBy("conv_id", level.alias("level")).agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("t"))
    packed = packed.select("conv_id", "level", F.array_join("t.digest", "").alias("hex"), F.col("t.words").alias("words"))
    empty = lengths.where("length = 0").select("conv_id", F.lit(0).alias("level"), F.lit("").alias("hex"), F.array().cast("array<bigint>").alias("words"))
    rows = packed.unionByName(empty).join(lengths, "conv_id")
    full = F.sha2(F.concat_ws("|", F.col("level").cast("string"), "hex").cast("binary"), 256)
    halves = [F.conv(F.substring(full, a, 15), 16, 10).cast("bigint") for a in (1, 16)]
    upto = Window.partitionBy("conv_id").orderBy("level")  # one row per segment of a conversation
    name = lambda window: F.concat_ws("-", *[F.hex(F.bit_xor(h).over(window)) for h in halves])
    return rows.select(
        "conv_id",
        "level",
        name(upto.rowsBetween(Window.unboundedPreceding, -1)).alias("root"),
        F.unhex("hex").alias("path"),
        "words",
        F.when((F.col("level") + 1) * segment < F.col("length"), name(upto.rowsBetween(Window.unboundedPreceding, 0))).alias("next_root"),
    )


class Parentheses:
    """A balanced sequence of +1 and -1 with a range min-max tree over blocks of excess."""

    def __init__(self, signs: np.ndarray, block: int = BLOCK):
        self.block = block
        excess = np.cumsum(signs, dtype=np.int32)
        self.excess = excess
        blocks = 1 << max(0, int(-(-len(excess) // block) - 1).bit_length())
        padded = np.full(blocks * block, np.iinfo(np.int32).max, np.int32)
        padded[: len(excess)] = excess
        self.rows = padded.reshape(blocks, block)
        self.least = [self.rows.min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))

    def _in_block(self, block: np.ndarray, target: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Place of the first excess at or below ``target`` behind column ``after``; -1 if the block has none."""
        out = np.full(len(block), -1, np.int64)
        for a in range(0, len(block), 1 << 15):
            part = slice(a, a + (1 << 15))
            hit = (self.rows[block[part]] <= target[part, None]) & (np.arange(self.block) > after[part, None])
            column = hit.argmax(axis=1)
            out[part] = np.where(hit.any(axis=1), block[part] * self.block + column, -1)
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The position that closes each open position."""
        target = self.excess[opens] - 1
        node = opens // self.block
        found = self._in_block(node, target, opens % self.block)
        todo = np.flatnonzero(found < 0)
        node, top = node[todo], np.full(len(todo), -1)
        for depth in range(len(self.least) - 1):  # up, until the right neighbour holds the target
            climbing = np.flatnonzero(top < 0)
            beside = node[climbing] ^ 1
            there = (node[climbing] & 1 == 0) & (self.least[depth][beside] <= target[todo[climbing]])
            node[climbing] = np.where(there, beside, node[climbing] >> 1)
            top[climbing[there]] = depth
        for depth in range(len(self.least) - 1, 0, -1):  # down, to the leftmost block that does
            falling = np.flatnonzero(top == depth)
            left = node[falling] * 2
            node[falling] = np.where(self.least[depth - 1][left] <= target[todo[falling]], left, left + 1)
            top[falling] = depth - 1
        found[todo] = self._in_block(node, target[todo], np.full(len(todo), -1))
        return found


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start."""
    most = min(len(a), len(b)) // DIGEST
    if a[: most * DIGEST] == b[: most * DIGEST]:
        return most
    differ = np.frombuffer(a, np.uint8, most * DIGEST) != np.frombuffer(b, np.uint8, most * DIGEST)
    return int(differ.argmax()) // DIGEST


def _key(root: str, path: bytes, depth: int = 0) -> str:
    return hashlib.md5(f"{root}|".encode() + path[: depth * DIGEST]).hexdigest()


#: Columns of the rows a shard returns; ``kind`` is node, spine, edge or ends.
FIELDS = {
    "kind": "string", "task": "int", "seq": "int", "key": "string", "parent": "string", "root": "string", "depth": "int", "conv_id": "bigint", "parent_conv_id": "bigint",
    "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "gain": "bigint", "words": "bigint", "ends": "string", "next_root": "string",
    "left": "boolean", "right": "boolean", "last_root": "string", "first_path": "binary", "last_path": "binary", "before": "array<bigint>",
}
_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _ARROW[t]) for n, t in FIELDS.items()], names=list(FIELDS))


def shard_rows(rows: list[tuple], level: int, task: int, seq: int) -> Iterator[dict]:
    """Nodes, spine, edge and packets of ids of one shard of sorted paths.

    A row is (root, path, words, conv_id, more, next_root, x_children, x_leaves, x_gain);
    ``more`` is 0 where the conversation ends, 1 where it goes on a level below, 2 for
    the totals of that level, which count no conversation.
    """
    n = len(rows)
    closes, opens, ends_at = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n, np.int64)
    depth: list[int] = []
    parent: list[int] = []
    word: list[int] = []
    opened: list[int] = []
    at: list[int] = []
    root, path = None, b""
    for i, row in enumerate(rows):
        shared = _common(path, row[1]) if row[0] == root else -1
        root, path = row[0], row[1]
        size = len(path) // DIGEST
        closes[i], opens[i] = len(at) - 1 - shared, size - shared
        for d in range(shared + 1, size + 1):
            parent.append(at[d - 1] if d else -1) if d == shared + 1 else parent.append(len(depth) - 1)
            depth.append(d)
            word.append(row[2][d - 1] if d else 0)
            opened.append(i)
        at = at[: shared + 1] + list(range(len(depth) - int(opens[i]), len(depth)))
        ends_at[i] = at[-1]
    closes[n] = len(at)
    spine_first, spine_last = set(range(int(opens[0]))), set(at)

    signs = np.repeat(np.tile([-1, 1], n + 1), np.stack([closes, opens], axis=1).ravel()).astype(np.int8)
    row_at = np.repeat(np.arange(n + 1), closes + opens)
    tree = Parentheses(signs)
    open_at = np.flatnonzero(signs == 1)
    close_at = tree.findclose(open_at)
    first, last = np.array(opened), row_at[close_at]
    size = (close_at - open_at + 1) // 2

    more, conv = np.array([r[4] for r in rows]), np.array([NOBODY if r[3] is None else r[3] for r in rows] + [NOBODY], np.int64)
    upto = lambda values: np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    members = upto(more < 2)
    n_convs = members[last] - members[first]
    lowest = np.minimum.reduceat(conv, np.stack([first, last], axis=1).ravel())[::2]
    cut = np.zeros(len(depth), bool)
    cut[ends_at[more > 0]] = True
    pair = np.zeros(len(signs) + 1, np.int64)
    pair[open_at] = (size == 1) & ~cut
    leaves = np.cumsum(pair)
    x_leaves, x_gain = upto([r[7] for r in rows]), upto([r[8] for r in rows])
    n_leaves = leaves[close_at] - leaves[open_at] + pair[open_at] + x_leaves[last] - x_leaves[first]
    word_of = np.array(word, np.int64)
    gains, words = upto(n_convs * word_of), upto(word_of)
    node = np.arange(len(depth))
    gain = gains[node + size] - gains[node] + x_gain[last] - x_gain[first]
    total_words = words[node + size] - words[node]
    above = np.array(parent)
    n_children = np.bincount(above[above >= 0], minlength=len(depth))
    np.add.at(n_children, ends_at, np.array([r[6] for r in rows]))

    ids: dict[int, list[int]] = {}
    below: dict[int, str] = {}
    for i in np.flatnonzero(more == 0):
        ids.setdefault(int(ends_at[i]), []).append(rows[i][3])
    for i in np.flatnonzero(more == 1):
        below[int(ends_at[i])] = rows[i][5]
    spine = spine_first | spine_last
    for v in range(len(depth)):
        owner, d = rows[opened[v]], depth[v]
        made = {
            "kind": "spine" if v in spine else "node", "task": task, "seq": seq, "root": owner[0], "depth": d, "key": _key(owner[0], owner[1], d), "conv_id": int(lowest[v]), "n_convs": int(n_convs[v]),
            "n_children": int(n_children[v]), "n_leaves": int(n_leaves[v]), "gain": int(gain[v]), "words": int(total_words[v]), "next_root": below.get(v),
        }
        if d and (parent[v] in spine or (level and d == 1)):
            made["parent"] = _key(owner[0], owner[1], d - 1)
        elif d:
            made["parent_conv_id"] = int(lowest[parent[v]])
        if v in spine:
            made |= {"left": v in spine_first, "right": v in spine_last}
            own = ids.get(v, [])
            for a in range(0, len(own), PACKET_IDS):
                yield {"kind": "ends", "task": task, "seq": seq, "key": made["key"], "depth": a // PACKET_IDS, "ends": ",".join(map(str, own[a : a + PACKET_IDS]))}
        else:
            made["ends"] = hashlib.sha256(",".join(map(str, ids.get(v, []))).encode()).hexdigest()
        yield made
    tail = rows[-1]
    yield {
        "kind": "edge", "task": task, "seq": seq, "root": rows[0][0], "first_path": rows[0][1], "last_root": tail[0], "last_path": tail[1],
        "before": [0, *np.cumsum(rows[0][2]).tolist()], "n_leaves": int(not cut[ends_at[-1]]),
    }


def _shards(rows: DataFrame, level: int, turns: int, shard_turns: int) -> DataFrame:
    order = ["root", "path", "more", "conv_id"]
    names = ["root", "path", "words", "conv_id", "more", "next_root", "x_children", "x_leaves", "x_gain"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += 1 + len(row[2])
                if size >= 2 * shard_turns:
                    yield _batch(list(shard_rows(held, level, task, seq)))
                    seq, held, size = seq + 1, [], 0
        if held:
            yield _batch(list(shard_rows(held, level, task, seq)))

    dealt = rows.select(*names).repartitionByRange(1 + turns // shard_turns, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(encode, ", ".join(f"`{n}` {t}" for n, t in FIELDS.items()))


def _shared_with_neighbours(edges: DataFrame) -> DataFrame:
    """(task, seq, shared, left_open, before): what a shard has in common with the one before it, and whether its last node goes on behind it."""
    line = Window.orderBy("task", "seq")  # one row per shard
    beside = edges.select(
        "task", "seq", "root", "first_path", "last_root", "last_path", "before", "n_leaves",
        F.lag("last_root").over(line).alias("prev_root"), F.lag("last_path").over(line).alias("prev_path"), F.lead("root").over(line).alias("foll_root"), F.lead("first_path").over(line).alias("foll_path"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, again = [], []
            for root, first, last_root, last, leaf, prev_root, prev, foll_root, foll in zip(*(batch[c].to_pylist() for c in ("root", "first_path", "last_root", "last_path", "n_leaves", "prev_root", "prev_path", "foll_root", "foll_path"))):
                shared.append(_common(prev, first) if prev_root == root else -1)
                again.append(leaf if foll_root == last_root and _common(last, foll) == len(last) // DIGEST else 0)
            yield pa.RecordBatch.from_arrays([batch["task"], batch["seq"], pa.array(shared, pa.int32()), pa.array(again, pa.int64()), batch["before"]], names=["task", "seq", "shared", "again", "before"])

    return beside.mapInArrow(compare, "task int, seq int, shared int, again bigint, before array<bigint>")


def _merged_spines(out: DataFrame) -> DataFrame:
    """One row per node that stands on the spine of a shard, with the parts of all shards added up."""
    sides = _shared_with_neighbours(out.where("kind = 'edge'"))
    spine = out.where("kind = 'spine'").drop("before", "ends").join(sides, ["task", "seq"])
    doubled = F.col("left") & (F.col("depth") <= F.col("shared"))
    repeated = F.element_at("before", F.col("shared") + 1) - F.when(F.col("depth") == 0, 0).otherwise(F.element_at("before", F.greatest("depth", F.lit(1))))
    parts = spine.select(
        "key", "parent", "root", "depth", "next_root", "conv_id", "n_convs", "gain",
        (F.col("words") - F.when(doubled, repeated).otherwise(0)).alias("words"),
        (F.col("n_children") - F.when(F.col("left") & (F.col("depth") < F.col("shared")), 1).otherwise(0)).alias("n_children"),
        (F.col("n_leaves") - F.when(F.col("right"), F.col("again")).otherwise(0)).alias("n_leaves"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_convs", "gain", "words", "n_children", "n_leaves")]
    nodes = parts.groupBy("key").agg(*[F.max(c).alias(c) for c in ("parent", "root", "depth", "next_root")], F.min("conv_id").alias("conv_id"), *sums)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch["key"].to_pylist(), batch["ends"].to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield _pairs(done)
        yield _pairs([] if now is None else [(now, sha.hexdigest())])

    packets = out.where("kind = 'ends'").select("key", "task", "seq", "depth", "ends")
    ends = packets.repartition("key").sortWithinPartitions("key", "task", "seq", "depth").mapInArrow(digest, "key string, ends string")
    return nodes.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())))


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.string())], names=["key", "ends"])


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment: int = SEGMENT, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    NULL roles and texts are empty; rows without conversation id are left out; turns
    with equal numbers follow the order of their digests, and repeated rows are turns of
    their own. A conversation without turns belongs to the root. An empty table has no
    node. Other columns are not read. Turns are equal if role and text are.
    """
    turns, lengths = rebuilt_turns(conversations, conv_col, turn_col, role_col, text_col)
    segments = written(_segments(turns, lengths, segment), "trie-segments")
    sizes = {r["level"]: r["turns"] + r["n"] for r in segments.groupBy("level").agg(F.sum(F.size("words")).alias("turns"), F.count(F.lit(1)).alias("n")).collect()}
    levels, totals = [], None
    for level in range(max(sizes, default=0), -1, -1):
        here = segments.where(F.col("level") == level)
        zero = [F.lit(0).cast("bigint").alias(c) for c in ("x_children", "x_leaves", "x_gain")]
        rows = here.select("root", "path", "words", "conv_id", F.col("next_root").isNotNull().cast("int").alias("more"), "next_root", *zero)
        if totals is not None:
            tops = here.where("next_root IS NOT NULL").groupBy(F.col("next_root").alias("key_root")).agg(F.min(F.struct("root", "path", "words")).alias("top"))
            hung = tops.join(totals, "key_root").select(
                "top.*", F.lit(None).cast("bigint").alias("conv_id"), F.lit(2).alias("more"), F.lit(None).cast("string").alias("next_root"), "x_children", "x_leaves", "x_gain"
            )
            rows = rows.unionByName(hung)
        out = written(_shards(rows, level, sizes.get(level, 0), shard_turns), f"trie-shards-{level}")
        inner = out.where("kind = 'node'").select(F.lit(False).alias("spine"), *NODE)
        merged = _merged_spines(out).withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(F.lit(True).alias("spine"), *NODE)
        nodes = written(inner.unionByName(merged).withColumn("level", F.lit(level)), f"trie-nodes-{level}")
        totals = nodes.where("depth = 0").select(F.col("root").alias("key_root"), F.col("n_children").alias("x_children"), F.col("n_leaves").alias("x_leaves"), (F.col("gain") - F.col("words")).alias("x_gain"))
        levels.append(nodes if level == 0 else nodes.where("depth > 0"))

    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    spines = every.where("spine").select("key", "conv_id")
    tops = every.where("next_root IS NOT NULL").select(F.md5(F.concat("next_root", F.lit("|")).cast("binary")).alias("key"), "conv_id")
    parents = small(written(spines.unionByName(tops).select(F.col("key").alias("parent"), F.col("conv_id").alias("_above")), "trie-parents"))
    joined = every.join(parents, "parent", "left")
    return joined.select(
        "conv_id",
        (F.col("level") * segment + F.col("depth")).cast("bigint").alias("depth"),
        F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("gain") - F.col("words")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


NODE = ["key", "parent", "root", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "gain", "words", "ends", "next_root"]

SQL = r"""
WITH t AS (SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS k,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, sha256(k) AS k, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(k)) AS rn FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
             xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM o)),
heads AS (SELECT c.conv_id, rn AS pos, k, w FROM c JOIN o ON o.conv_id = c.base WHERE rn <= h),
r AS (SELECT * FROM heads UNION ALL
      SELECT c.conv_id, rn - h + coalesce(nb, 0), k, w FROM c JOIN o USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS nb FROM heads GROUP BY conv_id) USING (conv_id) WHERE rn > h),
s AS (SELECT c.conv_id, coalesce(list(k ORDER BY pos) FILTER (k IS NOT NULL), []) AS ks, list(w ORDER BY pos) AS ws FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, array_to_string(ks[1 : d], ',') AS key, array_to_string(ks[1 : d - 1], ',') AS up, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, d = len(ks) AS over
      FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, any_value(up) AS up, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (over) AS ends FROM p GROUP BY key, d),
kids AS (SELECT up AS key, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY up, d),
m AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids USING (key, d)),
below AS (SELECT a.key, a.d, count(*) FILTER (m.n_children = 0) AS n_leaves, CAST(sum((m.n_convs - 1) * m.w) AS BIGINT) AS saved FROM m JOIN p a ON a.conv_id = m.conv_id AND a.d <= m.d GROUP BY a.key, a.d)
SELECT m.conv_id, m.d AS depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN below USING (key, d) LEFT JOIN m above ON m.d > 0 AND above.key = m.up AND above.d = m.d - 1
"""
