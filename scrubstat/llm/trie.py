"""Conversation prefix trie, its subtree sums by the Euler-tour technique.

1. Turns are put in order by one range sort over (conversation, turn), which splits long conversations, and each gets
   the hash of its whole prefix: a polynomial over 127-bit turn digests modulo the prime 2^127 - 1. Such a hash is a
   prefix sum, so pieces of a conversation in several partitions, and prefixes with an exchanged head, are put together
   by arithmetic.
2. Conversations are rebuilt: the head of one conversation goes before the rest of another (`rebuilt_members`).
3. Nodes are the groups of equal (depth, prefix hash); partial sums and minima take hot prefixes. (Smallest member,
   depth) names a node. Siblings are put in order by the smallest member, in a range sort.
4. Every node has an enter and an exit arc; the tour links them. Enter arcs of nodes with one smallest member follow each
   other, and so do exit arcs up to the next sibling: such runs, of at most `PIECE` arcs, become one element each.
5. The elements are list-ranked by pointer jumping: as many joins on unique keys as the number of elements has bits.
   Ranks give every arc its position in the tour.
6. Prefix sums of leaves and savings at arc positions, taken in blocks of `BLOCK` positions; a node's subtree is what lies
   between its two arcs.

The members that end at a node are sorted by range and hashed as a stream, in pieces of `CHUNK` bytes where a node's
members go over several partitions; only the finishing of one node's digest is sequential.

Defined results: rows without conversation id take no part; null role or text is empty, a null turn comes first; turns
of equal number go by the digest of their role and text, so repeated rows are turns each; an empty table gives no
rows, not even the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, scratch_path, write_through

PRIME = (1 << 127) - 1
POINT = 0x2545F4914F6CDD1D9E3779B97F4A7C15 % PRIME  # where the polynomials are evaluated; any large fixed number
HEAD = 5  # turns that a conversation may take over from another
PIECE, BLOCK, CHUNK = 1024, 1 << 14, 1 << 16
ZERO = bytes(16)


def turn_digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits of a turn."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)


def _number(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _bytes(n: int) -> bytes:
    return (n % PRIME).to_bytes(16, "big")


def prefix_hashes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, lengths) of turns(conv_id, turn, digest, chars): rows (conv_id, part, k, hash, prev, chars, skip, before)
    hold the place k in a piece of the conversation and the piece's own hashes up to the turn and before it, with the
    number of turns and the hash of all pieces before (0 and null in the first); lengths hold (conv_id, n)."""
    order = ["conv_id", "turn", "digest"]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def chain(frames):
        conv, h, k = None, 0, 0
        for f in frames:
            ks, hashes, prevs = [], [], []
            for c, d in zip(f["conv_id"].to_numpy(), f["digest"]):
                if c != conv:
                    conv, h, k = c, 0, 0
                prevs.append(_bytes(h))
                h, k = (h * POINT + int(d, 16) + 1) % PRIME, k + 1
                ks.append(k)
                hashes.append(_bytes(h))
            yield pd.DataFrame({"conv_id": f["conv_id"], "part": f["part"], "k": ks, "hash": hashes, "prev": prevs, "chars": f["chars"]})

    rows = write_through(placed.mapInPandas(
        chain, "conv_id bigint, part int, k bigint, hash binary, prev binary, chars bigint"), "trie-turns")
    pieces = write_through(rows.groupBy("conv_id", "part").agg(F.max("k").alias("n"), F.max_by("hash", "k").alias("hash")), "trie-pieces")
    lengths = write_through(pieces.groupBy("conv_id").agg(F.sum("n").alias("n"), F.count("*").alias("pieces")), "trie-lengths")

    def join(f):  # as many rows as the conversation has partitions
        f = f.sort_values("part")
        n, h, skip, before = 0, 0, [], []
        for m, x in zip(f["n"], f["hash"]):
            skip.append(n)
            before.append(_bytes(h))
            n, h = n + m, (h * pow(POINT, int(m), PRIME) + _number(x)) % PRIME
        return pd.DataFrame({"conv_id": f["conv_id"], "part": f["part"], "skip": skip, "before": before})

    offsets = pieces.join(lengths.where("pieces > 1").select("conv_id"), "conv_id", "left_semi").groupBy("conv_id").applyInPandas(
        join, "conv_id bigint, part int, skip bigint, before binary").where("skip > 0")
    rows = rows.join(write_through(offsets, "trie-offsets"), ["conv_id", "part"], "left")
    return rows.withColumn("skip", F.coalesce("skip", F.lit(0))), lengths.drop("pieces")


@F.pandas_udf(T.BinaryType())
def _moved(h: pd.Series, k: pd.Series, before: pd.Series, n: pd.Series, own: pd.Series, head: pd.Series) -> pd.Series:
    """Hash of k turns after those of `before`; with its head of hash `own`, n turns back, replaced by one of hash `head`."""
    out = []
    for x, i, b, m, o, g in zip(h, k, before, n, own, head):
        x = _number(x)
        if b is not None:
            x += _number(b) * pow(POINT, int(i), PRIME)
        if o != g:
            x += (_number(g) - _number(o)) * pow(POINT, int(m), PRIME)
        out.append(_bytes(x))
    return pd.Series(out, dtype=object)


def rebuilt_members(rows: DataFrame, lengths: DataFrame, taken: Column, giver: Column) -> tuple[DataFrame, DataFrame]:
    """(members, info): every conversation's turns after `taken` (at most HEAD) turns of the conversation `giver`, both
    conditions on conv_id. Members (conv_id, depth, hash, prev, chars, ends), one a turn; info (conv_id, n), one
    a conversation, n turns long."""
    zero = F.lit(ZERO)
    early = rows.withColumn("pos", F.col("k") + F.col("skip")).where(f"pos <= {HEAD}").select(
        "conv_id", F.struct("pos", _moved("hash", "k", "before", "k", zero, zero).alias("hash"),
                            _moved("prev", F.col("k") - 1, "before", "k", zero, zero).alias("prev"), "chars").alias("turn"))
    first = write_through(early.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("first")), "trie-heads")
    both = (lengths.join(first, "conv_id").withColumn("taken", taken.cast("int")).withColumn("giver", giver)
            .join(first.select(F.col("conv_id").alias("giver"), F.col("first").alias("given")), "giver", "left")
            .withColumn("given", F.coalesce(F.slice("given", 1, F.col("taken")), F.expr("cast(array() as array<struct<pos:bigint,hash:binary,prev:binary,chars:bigint>>)")))
            .withColumn("m", F.size("given")))
    info = write_through(both.select(
        "conv_id", "taken", "given", "m", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("taken"))).alias("n"),
        F.when(F.col("m") > 0, F.element_at("given", -1)["hash"]).otherwise(zero).alias("head"),
        F.when((F.col("taken") > 0) & (F.col("n") >= F.col("taken")), F.try_element_at("first", F.col("taken"))["hash"])
        .otherwise(zero).alias("own")), "trie-info")
    rest = rows.join(info.drop("given"), "conv_id").withColumn("after", F.col("k") + F.col("skip") - F.col("taken")).where("after > 0")
    rest = rest.select("conv_id", (F.col("m") + F.col("after")).alias("depth"),
                       _moved("hash", "k", "before", "after", "own", "head").alias("hash"),
                       _moved("prev", F.col("k") - 1, "before", F.col("after") - 1, "own", "head").alias("prev"), "chars", "n")
    heads = info.select("conv_id", F.explode("given").alias("t"), "n").select(
        "conv_id", F.col("t.pos").alias("depth"), "t.hash", "t.prev", "t.chars", "n")
    members = write_through(rest.union(heads).withColumn("ends", F.col("depth") == F.col("n")).drop("n"), "trie-members")
    return members, info.select("conv_id", "n")


def followed(df: DataFrame, keys: list[str], by: str, name: str) -> DataFrame:
    """The rows of df with `next`: the value of `by` that follows within equal keys, or null. Order comes from a range
    sort over keys and `by`, which splits long groups."""
    cols = [*keys, by]
    s = write_through(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_part", F.spark_partition_id())
                      .withColumn("_at", F.monotonically_increasing_id()), name)
    here = F.struct(*cols)
    firsts = s.groupBy("_part").agg(F.min_by(here, "_at").alias("_first"))  # one row a partition
    firsts = firsts.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_first"))
    lead = F.lead(here).over(Window.partitionBy("_part").orderBy("_at"))
    s = s.withColumn("_lead", lead).join(firsts, "_part", "left").withColumn("_lead", F.coalesce("_lead", "_first"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_lead.{k}") == F.col(k))
    return s.withColumn("next", F.when(same, F.col(f"_lead.{by}"))).drop("_part", "_at", "_lead", "_first")


def linked_nodes(members: DataFrame, info: DataFrame) -> DataFrame:
    """The nodes: (conv_id, depth, parent_conv_id, n_convs, chars, hash, n_children, first_child, next)."""
    found = write_through(members.groupBy("depth", "hash").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("prev").alias("prev"),
        F.first("chars").alias("chars")), "trie-found")
    top, convs = info.agg(F.min("conv_id"), F.count("*")).first()
    root = info.sparkSession.createDataFrame(
        [(top, 0, None, convs, 0, ZERO)] if convs else [],
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, chars bigint, hash binary")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "chars", "hash"]
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("hash").alias("prev"), F.col("conv_id").alias("parent_conv_id"))
    tree = write_through(
        found.where("depth = 1").withColumn("parent_conv_id", F.lit(top).cast("bigint")).select(*cols)
        .union(found.where("depth > 1").join(parents, ["depth", "prev"]).select(*cols)).union(root.select(*cols)), "trie-tree")
    kids = tree.where("depth > 0").select("parent_conv_id", "depth", "conv_id")
    order = followed(kids, ["parent_conv_id", "depth"], "conv_id", "trie-siblings").select("conv_id", "depth", "next")
    count = kids.groupBy("parent_conv_id", "depth").agg(F.count("*").alias("n_children"), F.min("conv_id").alias("first_child")).select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "first_child")
    count = write_through(count, "trie-children")
    return write_through(tree.join(count, ["conv_id", "depth"], "left").join(order, ["conv_id", "depth"], "left")
                         .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-linked")


def placed_arcs(nodes: DataFrame) -> DataFrame:
    """nodes with `enter` and `exit`, the positions of their arcs in the Euler tour, from 0."""
    starts = F.col("parent_conv_id").isNull() | (F.col("parent_conv_id") != F.col("conv_id"))
    breaks = F.when(starts | F.col("next").isNotNull() | (F.col("depth") % PIECE == 0), F.col("depth"))
    piece = Window.partitionBy("conv_id", F.expr(f"depth div {PIECE}"))
    later = piece.orderBy("depth").rowsBetween(1, Window.unboundedFollowing)
    n = write_through(nodes.withColumn("e", F.min("depth").over(piece)).withColumn(
        "x", F.coalesce(F.first(breaks, ignorenulls=True).over(later) - 1, F.max("depth").over(piece))), "trie-runs")
    last, top = F.col("last"), F.col("top")
    enter = n.groupBy("conv_id", F.col("e").alias("at")).agg(
        F.count("*").alias("w"), F.max_by(F.struct("depth", "first_child"), "depth").alias("last")).select(
        F.lit(0).alias("kind"), "conv_id", "at", "w",
        F.when(last["first_child"].isNull(), F.struct(F.lit(1).alias("kind"), F.col("conv_id"), last["depth"].alias("at")))
        .otherwise(F.struct(F.lit(0).alias("kind"), last["first_child"].alias("conv_id"), (last["depth"] + 1).alias("at"))).alias("next"))
    up = F.struct(F.lit(1).alias("kind"), F.coalesce(top["parent_conv_id"], F.col("conv_id")).alias("conv_id"), (top["depth"] - 1).alias("at"))
    leave = n.groupBy("conv_id", F.col("x").alias("at")).agg(
        F.count("*").alias("w"), F.min_by(F.struct("depth", "next", "parent_conv_id"), "depth").alias("top")).select(
        F.lit(1).alias("kind"), "conv_id", "at", "w",
        F.when(top["next"].isNotNull(), F.struct(F.lit(0).alias("kind"), top["next"].alias("conv_id"), top["depth"].alias("at")))
        .when(top["parent_conv_id"].isNotNull(), up).alias("next"))
    ranks = list_ranks(enter.union(leave))
    total = 2 * n.count()
    place = lambda kind, name: ranks.where(F.col("kind") == kind).select(
        "conv_id", F.col("at").alias(name), (F.lit(total) - F.col("rank")).alias(f"{name}_at"))
    return (n.join(place(0, "e"), ["conv_id", "e"]).join(place(1, "x"), ["conv_id", "x"])
            .withColumn("enter", F.col("e_at") + F.col("depth") - F.col("e"))
            .withColumn("exit", F.col("x_at") + F.col("x") - F.col("depth")).drop("e", "x", "e_at", "x_at"))


def list_ranks(elements: DataFrame) -> DataFrame:
    """(kind, conv_id, at, rank) of a linked list (kind, conv_id, at, w, next): the weight from an element to the end,
    its own included. Pointer jumping: an element skips to its successor's successor, twice a round. The list is written
    every round and the round before removed."""
    spark = elements.sparkSession

    def kept(df):
        path = scratch_path(spark, f"tables/trie-ranks-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    flat = elements.select("kind", "conv_id", "at", F.col("w").cast("bigint").alias("w"), F.col("next.kind").alias("n_kind"),
                           F.col("next.conv_id").alias("n_conv"), F.col("next.at").alias("n_at"))
    def jump(t):
        ahead = t.select(F.col("kind").alias("n_kind"), F.col("conv_id").alias("n_conv"), F.col("at").alias("n_at"),
                         F.col("w").alias("more"), F.col("n_kind").alias("k2"), F.col("n_conv").alias("c2"), F.col("n_at").alias("a2"))
        moved = t.where("n_kind is not null").join(ahead, ["n_kind", "n_conv", "n_at"]).select(
            "kind", "conv_id", "at", (F.col("w") + F.col("more")).alias("w"), F.col("k2").alias("n_kind"),
            F.col("c2").alias("n_conv"), F.col("a2").alias("n_at"))
        return t.where("n_kind is null").union(moved)

    t, path = kept(flat)
    for _ in range((t.count().bit_length() + 1) // 2):
        new, new_path = kept(jump(jump(t)))
        drop_scratch(spark, path)
        t, path = new, new_path
    return t.select("kind", "conv_id", "at", F.col("w").alias("rank"))


def subtree_sums(arcs: DataFrame, **values: Column) -> DataFrame:
    """(conv_id, depth, *names): sums of the values over each node's subtree, from prefix sums at arc positions."""
    own = [v.cast("bigint").alias(c) for c, v in values.items()]
    none = [F.lit(0).cast("bigint").alias(c) for c in values]
    sides = F.explode(F.array(F.struct(F.col("enter").alias("pos"), F.lit(False).alias("out"), *own),
                              F.struct(F.col("exit").alias("pos"), F.lit(True).alias("out"), *none)))
    a = write_through(arcs.select("conv_id", "depth", sides.alias("a")).select("conv_id", "depth", "a.*").withColumn(
        "block", F.expr(f"pos div {BLOCK}")), "trie-arcs")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row for BLOCK arcs
    totals = a.groupBy("block").agg(*[F.sum(c).alias(c) for c in values]).select(
        "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_0") for c in values])
    upto = Window.partitionBy("block").orderBy("pos")
    p = a.select("conv_id", "depth", "out", "block", *[F.sum(c).over(upto).alias(f"{c}_1") for c in values], *values).join(totals, "block")
    return p.groupBy("conv_id", "depth").agg(*[
        F.sum(F.when(F.col("out"), F.col(f"{c}_0") + F.col(f"{c}_1")).otherwise(F.col(c) - F.col(f"{c}_0") - F.col(f"{c}_1"))).alias(c)
        for c in values])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, hash, ends_sha256) of ends(depth, hash, conv_id): SHA-256 of each node's ids, ascending, comma-joined."""
    cols = ["depth", "hash", "conv_id"]
    s = ends.select(*cols).repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("part", F.spark_partition_id())
    names = ["depth", "hash", "part", "seq", "ids", "ends_sha256"]

    def pieces(frames):
        """Digests of the nodes that lie within the partition; pieces of ids for those that may go on in others."""
        node, first, seq, ids, size = None, True, 0, [], 0
        for f in frames:
            out = []
            for d, h, c, part in zip(f["depth"], f["hash"], f["conv_id"], f["part"]):
                if (d, h) != node:
                    if node is not None:
                        whole = not first and seq == 0
                        out.append((*node, part, seq, None if whole else ",".join(ids),
                                    hashlib.sha256(",".join(ids).encode()).hexdigest() if whole else None))
                        first = False
                    node, seq, ids, size = (d, h), 0, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
                if size >= CHUNK:
                    out.append((*node, part, seq, ",".join(ids), None))
                    seq, ids, size = seq + 1, [], 0
            yield pd.DataFrame(out, columns=names)
        if ids:
            yield pd.DataFrame([(*node, part, seq, ",".join(ids), None)], columns=names)

    found = write_through(s.mapInPandas(pieces, "depth bigint, hash binary, part int, seq int, ids string, ends_sha256 string"), "trie-ends")

    def finish(frames):
        node, state = None, None
        for f in frames:
            out = []
            for d, h, ids in zip(f["depth"], f["hash"], f["ids"]):
                if (d, h) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (d, h), hashlib.sha256(ids.encode())
                elif ids:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["depth", "hash", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["depth", "hash", "ends_sha256"])

    crossing = found.where("ids is not null").repartition("depth", "hash").sortWithinPartitions("depth", "hash", "part", "seq")
    return found.where("ids is null").select("depth", "hash", "ends_sha256").union(
        crossing.select("depth", "hash", "ids").mapInPandas(finish, "depth bigint, hash binary, ends_sha256 string"))


def prefix_trie(convs: DataFrame, taken: Column | None = None, giver: Column | None = None, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included: (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256). `taken` and `giver` are conditions on conv_id: the first `taken`
    turns (at most HEAD) of each conversation are replaced by those of the conversation `giver`."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = convs.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
        turn_digest(empty(role_col), empty(text_col)).alias("digest"), F.length(empty(text_col)).cast("bigint").alias("chars"))
    members, info = rebuilt_members(*prefix_hashes(turns), F.lit(0) if taken is None else taken,
                                    F.col("conv_id") if giver is None else giver)
    nodes = linked_nodes(members, info)
    sums = subtree_sums(placed_arcs(nodes), n_leaves=F.col("n_children") == 0, saved_tokens=(F.col("n_convs") - 1) * F.col("chars"))
    ends = ends_digests(members.where("ends").select("depth", "hash", "conv_id").union(
        info.where("n = 0").select(F.lit(0).cast("bigint"), F.lit(ZERO), "conv_id")))
    return (nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "hash")
            .join(write_through(sums, "trie-sums"), ["conv_id", "depth"]).join(write_through(ends, "trie-digests"), ["depth", "hash"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
