"""The trie of conversations that begin alike, from the order of their turn sequences.

A turn is a code of 16 bytes, a conversation the sequence of its codes.  In sorted order the conversations
that share d turns are neighbours, and the length of the common beginning of two neighbours is an edge:
a union-find takes the edges from the longest to the shortest, and each union makes, or widens, the node
where the two sides part.  What lies between a component's top and the next union is a chain of nodes with
one child each.

Tasks do this for ranges of the order.  A node that does not reach the first or the last conversation
of its range is complete.  The others lie on the beginnings of these two: the forest of a range contracts to
two sequences with what hangs from them at each depth, and forests of neighbouring ranges merge by the same
union-find, up to ``FAN`` at a time, until one is left.  So no task sees more than a range or
``FAN`` forests, and nodes that wait for their parent's name hold a reference to a node of their own range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise, ship_package

CODE = 16
#: Turns and conversations of a range, forests that merge at once, bytes of ids in one row.
RANGE_TURNS, FAN, CHUNK = 1 << 19, 64, 1 << 20
#: Stands for a null conv_id inside.
NO_ID = -(1 << 63)

RECORD = "struct<ref:long,n:long,least:long,children:long,leaves:long,saved:long,size:long,ends:boolean>"
ROW = ("kind string, part long, ref long, up_part long, up_ref long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
       f" n_leaves long, saved_tokens long, ends_sha256 string, seq long, ids string, forest struct<first:binary,last:binary,open:array<{RECORD}>>")
NAMES = [field.split()[0] for field in ROW.split(", ")[:15]] + ["forest"]
RECORD_TYPE = pa.struct([(name, pa.int64()) for name in ("ref", "n", "least", "children", "leaves", "saved", "size")] + [("ends", pa.bool_())])
TYPES = [pa.string(), *[pa.int64()] * 11, pa.string(), pa.int64(), pa.string(),
         pa.struct([("first", pa.binary()), ("last", pa.binary()), ("open", pa.list_(RECORD_TYPE))])]
EMPTY = hashlib.sha256(b"").hexdigest()


def shared(one: bytes, two: bytes) -> int:
    """Codes that two sequences begin with in common, by halving."""
    low, high = 0, min(len(one), len(two)) // CODE
    while low < high:
        middle = (low + high + 1) // 2
        if one[low * CODE:middle * CODE] == two[low * CODE:middle * CODE]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """What is known of a node so far: members, the least of them, complete children, sums over complete subtrees."""

    __slots__ = ("children", "ends", "kids", "least", "leaf", "leaves", "n", "refs", "saved", "size")

    def __init__(self, size: int = 0) -> None:
        self.n, self.least, self.children, self.leaves, self.saved, self.size = 0, None, 0, 0, 0, size
        self.ends, self.leaf, self.kids, self.refs = False, None, [], []

    def add(self, n: int, least: int | None, children: int, leaves: int, saved: int) -> None:
        self.n += n
        self.children += children
        self.leaves += leaves
        self.saved += saved
        if least is not None and (self.least is None or least < self.least):
            self.least = least

    def take(self, other: Node) -> None:
        self.add(other.n, other.least, other.children, other.leaves, other.saved)
        self.size, self.ends = max(self.size, other.size), self.ends or other.ends
        self.leaf = other.leaf if self.leaf is None else self.leaf
        if len(other.kids) > len(self.kids):
            self.kids, other.kids = other.kids, self.kids
        self.kids += other.kids
        self.refs += other.refs


class Forest:
    """Union-find over neighbouring sequences, each with nodes that stand at some depths of it."""

    def __init__(self, keys: list[bytes], standing: list[dict[int, Node]], sizes: list[list[int]] | None, final: bool) -> None:
        self.keys, self.standing, self.sizes, self.final = keys, standing, sizes, final
        self.up = list(range(len(keys)))
        self.low, self.high = list(self.up), list(self.up)
        self.depth = [len(key) // CODE for key in keys]
        self.node = [self._standing(at, depth) for at, depth in enumerate(self.depth)]
        #: Complete nodes as [depth, node, parent's least member, reference to an open parent]; open ones by reference.
        self.closed: list[list] = []
        self.open: dict[int, Node] = {}

    def _standing(self, at: int, depth: int) -> Node:
        found = self.standing[at].pop(depth, None)
        if found is None:
            found = Node(self.sizes[at][depth - 1] if self.sizes and depth else 0)
        return found

    def _finish(self, at: int) -> int | None:
        """Close the node of a component or leave it open; the index of a closed one."""
        node, depth = self.node[at], self.depth[at]
        if not self.final and (self.low[at] == 0 or self.high[at] == len(self.keys) - 1):
            ref = 2 * depth + (self.low[at] != 0)
            self.open[ref] = node
            for kid in node.kids:
                self.closed[kid][3] = ref
            return None
        node.leaves = node.leaves if node.children else 1
        node.saved += (node.n - 1) * node.size
        for kid in node.kids:
            self.closed[kid][2] = node.least
        self.closed.append([depth, node, None, None])
        node.kids = []
        return len(self.closed) - 1

    def _raise(self, at: int, depth: int) -> None:
        while self.depth[at] > depth:
            below, index = self.node[at], self._finish(at)
            self.depth[at] -= 1
            above = self.node[at] = self._standing(at, self.depth[at])
            if index is not None:
                above.add(below.n, below.least, 1, below.leaves, below.saved)
                above.kids.append(index)

    def _find(self, at: int) -> int:
        while self.up[at] != at:
            self.up[at] = at = self.up[self.up[at]]
        return at

    def merge(self, edges: list[int]) -> None:
        """``edges[i]`` is the number of codes that sequences i and i + 1 begin with in common."""
        for edge in sorted(range(len(edges)), key=edges.__getitem__, reverse=True):
            one, two = self._find(edge), self._find(edge + 1)
            self._raise(one, edges[edge])
            self._raise(two, edges[edge])
            if self.high[two] - self.low[two] > self.high[one] - self.low[one]:
                one, two = two, one
            self.up[two] = one
            self.low[one], self.high[one] = min(self.low[one], self.low[two]), max(self.high[one], self.high[two])
            self.node[one].take(self.node[two])
            if len(self.standing[two]) > len(self.standing[one]):
                self.standing[one], self.standing[two] = self.standing[two], self.standing[one]
            for depth, node in self.standing[two].items():
                if depth in self.standing[one]:
                    self.standing[one][depth].take(node)
                else:
                    self.standing[one][depth] = node
            self.node[two], self.standing[two] = None, {}
        top = self._find(0)
        self._raise(top, 0)
        self._finish(top)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row.get(name) for row in rows], kind) for name, kind in zip(NAMES, TYPES)], NAMES)


def _rows_of(forest: Forest, part: int, digest) -> Iterator[dict]:
    """Rows of complete nodes and of the contracted forest."""
    for depth, node, parent, ref in forest.closed:
        yield {"kind": "node", "conv_id": node.least, "depth": depth, "parent_conv_id": parent, "up_part": None if ref is None else part,
               "up_ref": ref, "n_convs": node.n, "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved,
               "ends_sha256": digest(node)}
    if forest.open:
        records = [{"ref": ref, "n": node.n, "least": node.least, "children": node.children, "leaves": node.leaves, "saved": node.saved,
                    "size": node.size, "ends": node.ends} for ref, node in forest.open.items()]
        yield {"kind": "forest", "part": part, "forest": {"first": forest.keys[0], "last": forest.keys[-1], "open": records}}


def _in_batches(rows: Iterator[dict], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _written(number: int) -> str:
    return "" if number == NO_ID else str(number)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one range: rows (conv_id, key, sizes) by key, then conv_id."""
    part, convs, keys, sizes, firsts = TaskContext.get().partitionId(), [], [], [], []
    for batch in batches:
        for conv, key, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not keys or key != keys[-1]:
                keys.append(key)
                sizes.append(size)
                firsts.append(len(convs))
            convs.append(conv)
    if not keys:
        return
    standing = []
    for at, (begin, end) in enumerate(zip(firsts, [*firsts[1:], len(convs)])):
        node = Node(sizes[at][-1] if sizes[at] else 0)
        node.n, node.least, node.ends, node.leaf = end - begin, convs[begin], True, (begin, end)
        standing.append({len(keys[at]) // CODE: node})
    forest = Forest(keys, standing, sizes, final=False)
    forest.merge([shared(one, two) for one, two in zip(keys, keys[1:])])

    def ends(node: Node) -> str:
        return ",".join(map(_written, convs[slice(*node.leaf)])) if node.leaf else ""

    def rows() -> Iterator[dict]:
        yield from _rows_of(forest, part, lambda node: hashlib.sha256(ends(node).encode()).hexdigest())
        for ref, node in forest.open.items():
            if node.leaf:
                begin, end = node.leaf
                step = CHUNK // 21
                for seq, at in enumerate(range(begin, end, step)):
                    yield {"kind": "ends", "part": part, "ref": ref, "seq": seq, "ids": ",".join(map(_written, convs[at:min(at + step, end)]))}

    yield from _in_batches(rows())


def _unite(final: bool):
    """Merges the forests of a group, rows (group, list of (part, forest))."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, forests in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forests.sort(key=lambda row: row["part"])
                keys, standing = [], []
                for row in forests:
                    sides: tuple[dict, dict] = ({}, {})
                    for record in row["forest"]["open"]:
                        node = Node(record["size"])
                        node.add(*(record[name] for name in ("n", "least", "children", "leaves", "saved")))
                        node.ends, node.refs = record["ends"], [(row["part"], record["ref"])]
                        sides[record["ref"] % 2][record["ref"] // 2] = node
                    keys += [row["forest"]["first"], row["forest"]["last"]]
                    standing += sides
                forest = Forest(keys, standing, None, final)
                forest.merge([shared(one, two) for one, two in zip(keys, keys[1:])])

                def rows(forest: Forest = forest, group: int = group) -> Iterator[dict]:
                    yield from _rows_of(forest, group, lambda node: None if node.ends else EMPTY)
                    for _, node, _, _ in forest.closed:
                        for part, ref in node.refs:
                            yield {"kind": "link", "part": part, "ref": ref, "conv_id": node.least}
                    for own, node in forest.open.items():
                        for part, ref in node.refs:
                            yield {"kind": "link", "part": part, "ref": ref, "up_part": group, "up_ref": own}

                yield from _in_batches(rows())

    return work


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of nodes whose members lie in several ranges: rows (conv_id, depth, part, seq, ids) in order."""
    at, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        for conv, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4))):
            if (conv, depth) != at:
                if at is not None:
                    yield done()
                at, state = (conv, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if at is not None:
        yield done()


# DataFrames

def turn_codes(rows: DataFrame) -> DataFrame:
    """Per turn of ``rows`` (conv_id, turn, role, text): conv_id, place from 0, code (32 hexadecimal digits), size (bytes of the text).

    A null role or text is empty.  Turns go by number, null first, equal numbers by code.  Texts are
    not exchanged.
    """
    if rows.schema["conv_id"].dataType.typeName() not in ("byte", "short", "integer", "long", "void"):
        raise TypeError("conv_id must be a whole number")
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    code = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    coded = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id"), F.col("turn").alias("_turn"),
                        code.alias("code"), F.octet_length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "code")
    return coded.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "code", "size")


def sequences(ids: DataFrame, *turns: DataFrame) -> DataFrame:
    """Per conv_id of ``ids``: key (the codes of its turns as bytes) and sizes.  Each of ``turns`` (conv_id, place, code, size)
    follows the one before it; a conversation without turns has an empty key."""
    parts = [table.select("conv_id", F.lit(k).alias("_k"), "place", "code", "size") for k, table in enumerate(turns)]
    none = ids.select("conv_id", F.lit(-1).alias("_k"), F.lit(0).cast("long").alias("place"), F.lit("").alias("code"), F.lit(0).cast("long").alias("size"))
    whole = none
    for part in parts:
        whole = whole.unionByName(part)
    listed = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("_k", "place", "code", "size"))).alias("_turns"))
    real = listed.withColumn("_turns", F.filter("_turns", lambda turn: turn["_k"] >= 0))
    return real.select("conv_id", F.unhex(F.array_join("_turns.code", "")).alias("key"), F.col("_turns.size").alias("sizes"))


def trie_of(found: DataFrame, range_turns: int = RANGE_TURNS, fan: int = FAN) -> DataFrame:
    """The trie of sequences (conv_id, key, sizes), with a row a node as ``conversation_trie`` says."""
    spark = found.sparkSession
    ship_package(spark)
    found = materialise(found, "sequences")
    total = found.agg(F.sum(F.size("sizes") + F.lit(1))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_turns))
    dealt = found.select("conv_id", "key", "sizes").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    levels = [materialise(dealt.mapInArrow(_build, ROW), "trie-0")]
    # Some exchanges make more partitions than they are asked for.
    last = levels[0].filter("kind = 'forest'").agg(F.max("part")).first()[0]
    parts = 1 if last is None else last + 1
    while True:
        final = parts <= fan
        group = (F.lit(0) if final else F.floor(F.col("part") / fan)).cast("long").alias("group")
        gathered = levels[-1].filter("kind = 'forest'").select(group, "part", "forest").groupBy("group").agg(F.collect_list(F.struct("part", "forest")).alias("forests"))
        levels.append(materialise(gathered.mapInArrow(_unite(final), ROW), f"trie-{len(levels)}"))
        parts = -(-parts // fan)
        if final:
            break

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes, known = None, None
    for level in reversed(levels):
        own = level.filter("kind = 'node'")
        named = own.filter("up_ref IS NULL").select(names)
        if known is not None:
            parents = known.select(F.col("part").alias("up_part"), F.col("ref").alias("up_ref"), F.col("conv_id").alias("_parent"))
            waiting = own.filter("up_ref IS NOT NULL").drop("parent_conv_id").join(parents, ["up_part", "up_ref"])
            named = named.unionByName(waiting.withColumnRenamed("_parent", "parent_conv_id").select(names))
        nodes = named if nodes is None else nodes.unionByName(named)
        links = level.filter("kind = 'link'")
        if level is levels[0]:
            break
        sure = links.filter("up_ref IS NULL").select("part", "ref", "conv_id")
        if known is not None:
            sure = sure.unionByName(links.filter("up_ref IS NOT NULL").select("part", "ref", "up_part", "up_ref").join(
                known.select(F.col("part").alias("up_part"), F.col("ref").alias("up_ref"), "conv_id"), ["up_part", "up_ref"]).select("part", "ref", "conv_id"))
        known = sure
    ends = levels[0].filter("kind = 'ends'").select("part", "ref", "seq", "ids").join(known, ["part", "ref"]).select(
        "conv_id", F.floor(F.col("ref") / 2).alias("depth"), "part", "seq", "ids")
    order = ["conv_id", "depth", "part", "seq"]
    digests = ends.repartition("conv_id", "depth").sortWithinPartitions(*order).mapInArrow(_digests, "conv_id long, depth long, ends_sha256 string")
    spread = nodes.filter("ends_sha256 IS NULL").drop("ends_sha256").join(digests, ["conv_id", "depth"]).select(names)
    whole = nodes.filter("ends_sha256 IS NOT NULL").unionByName(spread)

    def shown(name: str) -> Column:
        return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)

    return whole.select(shown("conv_id"), "depth", shown("parent_conv_id"), *names[3:])


def conversation_trie(rows: DataFrame, range_turns: int = RANGE_TURNS, fan: int = FAN) -> DataFrame:
    """The trie of all conversations of ``rows`` (conv_id, turn, role, text), a row a node: conv_id (the least
    member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a sequence of turns that some conversation begins with, its members are these conversations.
    n_leaves counts the childless nodes of its subtree, itself included; saved_tokens sums, over the subtree,
    (members - 1) times the bytes of the last turn's text; ends_sha256 is of the ids, in decimal, ascending
    and joined by commas, of the members that end there.

    A null role or text is empty; turns go by number, null first, equal numbers by code; repeated rows are turns
    of their own.  Rows without a conv_id are one conversation, the least, written as an empty text.  An
    empty table has no nodes.  Further columns are not read.  Turns are equal if their MD5 are.  A conversation's codes are
    one value, 24 bytes a turn, so one of up to about 80 million turns can be held; texts are never gathered.
    """
    turns = materialise(turn_codes(rows), "turns")
    return trie_of(sequences(turns.select("conv_id").distinct(), turns), range_turns, fan)
