"""Sharding by a hierarchical weighted hash tree.

A row starts at the root and descends region, rack and shard levels. At each node every child draws u in (0, 1) from a hash of the
row's key and the child's name; the child with the least -ln(u) / weight takes the row, so children get shares in proportion to their
weights. A node's weight is the sum of its shards'. If a shard is added, only the weights on its path change, and draws of other
nodes stay: rows move only into the subtree whose weight grew. The regions and racks of the first BASE shards are fixed; each shard beyond
them opens a region of its own. Such a subtree is the shard itself, so rows move only into it: the law `key` holds for every number of
shards from the base on, and fewer are refused. Another base, such as the number of shards that a cluster began with, can be given.

Each level is one expression: the children of the node that a row has reached are looked up, their draws made and the least taken.

Rows are narrow when they are shuffled (key, size, checksum, shards) and are stored once before, so texts are read once. Slots number each
shard's rows without gaps in order of the key: rows are dealt by ranges, counted by range and shard, and each adds the counts before it.

Defined cases: a null key is the text `null` and takes its place like any key; null text has 0 bytes and checksum 0; texts of any length
are only measured and summed; repeated rows get the same shard and slots of their own; rows whose key, checksum and size are equal are
numbered as they come; other columns are ignored. An empty table gives an empty one. Fewer shards than the base are a ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARDS, BASE, RACKS, PER_RACK = 24, 24, 2, 4


@dataclass(frozen=True)
class Node:
    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def tree(shards: int, racks: int = RACKS, per_rack: int = PER_RACK, weights: dict[int, float] | None = None, base: int | None = None) -> Node:
    """The first `base` shards (all if None) in order fill racks, racks fill regions; each other shard has a region of its own."""
    base = shards if base is None else base
    if not 1 <= base <= shards:
        raise ValueError(f"{shards} shards are fewer than the base of {base}, which would move rows between them")
    regions: list[list[list[int]]] = []
    for s in range(shards):
        if s >= base or s % (racks * per_rack) == 0:
            regions.append([[s]])
        elif s % per_rack == 0:
            regions[-1].append([s])
        else:
            regions[-1][-1].append(s)
    leaf = lambda s: Node(f"shard {s}", shard=s, own=(weights or {}).get(s, 1.0))
    number = iter(range(shards))
    return Node("root", tuple(Node(f"region {r}", tuple(Node(f"rack {next(number)}", tuple(map(leaf, of))) for of in rack)) for r, rack in enumerate(regions)))


def _draw(key: Column, name: Column, weight: Column) -> Column:
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", key, name)), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(u) / weight


def place(key: Column, root: Node) -> Column:
    """The shard of a key."""
    key, at, level = F.coalesce(key.cast("string"), F.lit("null")), F.lit(0), [root]
    while any(n.children for n in level):
        below = [(n.children or (n,)) for n in level]
        ends = [sum(map(len, below[:i])) for i in range(len(below))]
        row = lambda i: ", ".join(f"named_struct('name', '{c.name}', 'weight', {float(c.weight)!r}D, 'at', {ends[i] + j})" for j, c in enumerate(below[i]))
        children = F.get(F.expr(f"array({', '.join(f'array({row(i)})' for i in range(len(below)))})"), at)
        at = F.array_min(F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]), c["at"].alias("at"))))["at"]
        level = [c for of in below for c in of]
    return F.get(F.expr(f"array({', '.join(str(n.shard) for n in level)})"), at).cast("int")


def number(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Adds `slot`: from 0, without gaps in each shard, in the given order of all rows."""
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    fixed = cut(dealt).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    counts = fixed.groupBy("__part", shard).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(shard).orderBy("__part")) - F.col("__n")
    starts = counts.select("__part", shard, before.alias("__start"))
    own = F.row_number().over(Window.partitionBy("__part", shard).orderBy("__at"))
    return fixed.withColumn("__own", own).join(starts, ["__part", shard]).withColumn("slot", (F.col("__start") + F.col("__own") - 1).cast("long")).drop("__part", "__at", "__own", "__start")


def assign(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", base: int = BASE, racks: int = RACKS, per_rack: int = PER_RACK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one shard more) for each row."""
    body = F.coalesce(text, F.lit(""))
    rows = docs.select(
        F.col(doc_id),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(F.col(doc_id), tree(shards, racks, per_rack, base=base)).alias("shard"),
        place(F.col(doc_id), tree(shards + 1, racks, per_rack, base=base)).alias("grown_shard"),
    )
    return number(cut(rows), "shard", [doc_id, "text_crc32", "size"]).select(doc_id, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
