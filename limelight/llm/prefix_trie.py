"""A Z-fast trie over conversations, and what it says of shared prefixes.

A conversation is the sequence of 128-bit hashes of its prefixes, so equal hashes mean equal
prefixes and a node is named by the hash at its depth. The compacted trie has a node where
sequences part or end; it is hashed at its handle, the two-fattest depth of its edge (the
one divisible by the highest power of two). A sequence finds the node at which it leaves
the trie by fat binary search: as many probes of the handles as its length has bits.

Sequences come in batches that grow by a factor, chosen by hash. All of a batch leave the
trie built so far, cut the edges they leave from, and hang what is new below. A prefix that
many of a batch share is missing from a trie of a share of all sequences with a chance that
falls exponentially, so groups that hang in one place stay small however hot a prefix is;
equal conversations are merged before. Sums over subtrees go up by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.groups import lookup_join
from .common import map_batches, quoted, stored

#: Name of the textless root.
ROOT = bytes(16)
#: A node: its prefix's hash and depth; the hash and depth of the node above; the hashes
#: along its edge; the code points of all texts down to each of them, and above the edge.
NODE = (
    "node binary, depth int, parent binary, top int, edge array<binary>, chars array<bigint>, "
    "chars_above bigint"
)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
BLOCK = 1 << 15  # characters of listed ids that travel in one row


def two_fattest(above: Column, to: Column) -> Column:
    """The number in (above, to] that the highest power of two divides."""
    differing = above.bitwiseXOR(to)
    return to - F.pmod(to, F.pow(F.lit(2), F.length(F.bin(differing)) - 1).cast("int"))


def rebuilt(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", block: int = 100, heads: int = 6,
) -> DataFrame:
    """(conv_id, turns): every conversation with its first turns taken from its block's first.

    turns has a hash and the code points of the text per turn, in turn order (null first;
    equal turns by their hash). Of conversation c the first h turns are those of c - c %
    ``block``, h = crc32(c) % ``heads``; its own turns follow after its first h. Null roles
    and texts are empty; rows without a conversation are left out.
    """
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in (role_col, text_col))
    turn = quoted(turn_col)
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(quoted(conv_col).isNotNull()).select(
        quoted(conv_col).cast("bigint").alias("conv_id"),
        F.struct(
            turn.isNotNull().alias("numbered"), F.coalesce(turn, F.lit(0)).alias("turn"),
            F.unhex(F.md5(said)).alias("hash"), F.length(text).cast("bigint").alias("chars"),
        ).alias("t"),
    )
    own = rows.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list("t")),
        lambda t: F.struct(t["hash"].alias("hash"), t["chars"].alias("chars")),
    ).alias("own"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    first = own.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, heads - 1).alias("head")
    )
    base = F.col("conv_id") - F.col("conv_id") % block
    none = F.array().cast("array<struct<hash: binary, chars: bigint>>")
    return own.withColumns({"base": base, "h": h}).join(first, "base", "left").select(
        "conv_id", F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
            F.slice("own", F.col("h") + 1, F.size("own")),
        ).alias("turns"),
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, last, path, chars): hash and code points of every prefix, last the longest's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, paths, chars = [], [], []
            for turns_ in batch.column(1).to_pylist():
                name, total, path, sums = ROOT, 0, [], []
                for turn in turns_:
                    name = hashlib.blake2b(name + turn["hash"], digest_size=16).digest()
                    total += turn["chars"]
                    path.append(name)
                    sums.append(total)
                last.append(name)
                paths.append(path)
                chars.append(sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(last, pa.binary()), pa.array(paths, pa.list_(pa.binary())),
                 pa.array(chars, pa.list_(pa.int64()))],
                names=["conv_id", "last", "path", "chars"],
            )

    return map_batches(
        turns.select("conv_id", "turns"), run,
        "conv_id bigint, last binary, path array<binary>, chars array<bigint>",
    )


def exits(spark: SparkSession, trie: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` with the depth and name of the node each sequence passes last.

    Fat binary search for all at once: of the depths (passed, high] that are left, the
    two-fattest is looked up among the handles. A hit passes the node found if all of its
    edge is on the path, or else ends the search at the node above; a miss lowers ``high``. Every round halves
    what is left; sequences that are done leave the loop.
    """
    handles = trie.where("depth > 0").select(
        F.element_at("edge", two_fattest(F.col("top"), F.col("depth")) - F.col("top")).alias("handle"),
        F.col("node").alias("found"), F.col("depth").alias("found_depth"),
        F.col("top").alias("found_top"),
    )
    state = batch.select(
        "last", "path", "chars", F.lit(0).alias("passed"), F.size("path").alias("high")
    )
    done = []
    while True:
        state = stored(spark, state, "trie-search")
        done.append(state.where("passed >= high"))
        searching = state.where("passed < high")
        if searching.isEmpty():
            break
        probe = two_fattest(F.col("passed"), F.col("high"))
        probed = searching.withColumn("probe", probe).withColumn(
            "key", F.element_at("path", F.col("probe"))
        )
        met = lookup_join(probed, handles, "key", "handle", "left")
        on_path = (F.col("found_depth") <= F.size("path")) & (
            F.get("path", F.col("found_depth") - 1) == F.col("found")
        )
        state = met.select(
            "last", "path", "chars",
            F.when(F.col("found").isNull(), F.col("passed"))
            .when(on_path, F.col("found_depth")).otherwise(F.col("found_top")).alias("passed"),
            F.when(F.col("found").isNull(), F.col("probe") - 1)
            .when(on_path, F.col("high")).otherwise(F.col("found_top")).alias("high"),
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("high")


def _parts(key: str) -> Column:
    return F.get("edge", F.col(key) - F.col("top") - 1)


def _cut(trie: DataFrame, cuts: DataFrame) -> DataFrame:
    """The trie with its edges cut at the depths (node, cuts); a node for every cut."""
    bounds = F.array_sort(F.array_union(
        F.array("top", "depth"), F.coalesce("cuts", F.array().cast("array<int>"))
    ))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("bounds") - 2),
        lambda i: F.struct(F.get("bounds", i).alias("a"), F.get("bounds", i + 1).alias("b")),
    )
    edges = trie.where("depth > 0").join(cuts, "node", "left").withColumn("bounds", bounds)
    pieces = edges.withColumn("pair", F.explode(pairs)).withColumns({
        "a": F.col("pair.a"), "b": F.col("pair.b"),
    })
    size = F.col("b") - F.col("a")
    start = F.col("a") - F.col("top") + 1
    made = pieces.select(
        _parts("b").alias("node"), F.col("b").alias("depth"),
        F.when(F.col("a") == F.col("top"), F.col("parent")).otherwise(_parts("a")).alias("parent"),
        F.col("a").alias("top"), F.slice("edge", start, size).alias("edge"),
        F.slice("chars", start, size).alias("chars"),
        F.when(F.col("a") == F.col("top"), F.col("chars_above"))
        .otherwise(F.get("chars", F.col("a") - F.col("top") - 1)).alias("chars_above"),
    )
    return made.unionByName(trie.where("depth = 0"))


def subtrie(paths: list[list[bytes]], chars: list[list[int]], parent: bytes, top: int, above: int):
    """Nodes of the compacted trie of distinct paths that all begin with the same hash.

    ``paths`` and ``chars`` start below the node ``parent`` at depth ``top``.
    """
    children: dict[bytes, set[bytes]] = {}
    for path in paths:
        for name, below in zip(path, path[1:]):
            children.setdefault(name, set()).add(below)
    ends = {path[-1] for path in paths}
    explicit = ends | {name for name, below in children.items() if len(below) > 1}
    seen = set()
    for path, sums in zip(paths, chars):
        begin, upper = 0, parent
        for i, name in enumerate(path):
            if name not in explicit:
                continue
            if name not in seen:
                seen.add(name)
                yield (
                    name, top + i + 1, upper, top + begin, path[begin:i + 1], sums[begin:i + 1],
                    sums[begin - 1] if begin else above,
                )
            begin, upper = i + 1, name


def _hang(loose: DataFrame) -> DataFrame:
    """Nodes for the rests of sequences, one small trie per hash they begin with.

    Rows come sorted by that hash, so a task holds one group at a time.
    """
    names = [f.split()[0] for f in NODE.split(", ")]
    kinds = [pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.binary()),
             pa.list_(pa.int64()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            nodes: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if group and group[0][0] != row[0]:
                    nodes += built(group)
                    group = []
                group.append(row)
            if nodes:
                yield columns(nodes)
        if group:
            yield columns(built(group))

    def built(group: list[tuple]) -> list[tuple]:
        _, parent, top, above, _, _ = group[0]
        return list(subtrie([r[4] for r in group], [r[5] for r in group], parent, top, above))

    def columns(nodes: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*nodes), kinds)], names=names
        )

    rows = loose.select("key", "parent", "top", "above", "path", "chars")
    return map_batches(rows.repartition("key").sortWithinPartitions("key"), run, NODE)


def insert(spark: SparkSession, trie: DataFrame, batch: DataFrame) -> DataFrame:
    """The trie with a batch of distinct sequences (last, path, chars) in it."""
    at = stored(spark, exits(spark, trie, batch), "trie-exits")
    # the edge that a sequence enters next, if there is one, named by its first hash
    edges = trie.where("depth > 0").select(
        F.element_at("edge", 1).alias("entry"), "node", "edge", "depth",
    )
    entering = at.where(F.size("path") > F.col("passed")).withColumn(
        "key", F.get("path", F.col("passed"))
    )
    along = F.arrays_zip(
        F.slice("path", F.col("passed") + 1, F.size("edge")).alias("own"), F.col("edge").alias("edge")
    )
    shared = F.size(F.filter(along, lambda x: x["own"] == x["edge"]))
    placed = lookup_join(entering, edges, "key", "entry", "left").withColumn(
        "m", F.col("passed") + F.when(F.col("edge").isNull(), 0).otherwise(shared)
    ).select("last", "path", "chars", "node", "depth", "m")
    placed = stored(spark, placed, "trie-placed")
    cuts = placed.where("m < depth").groupBy("node").agg(F.collect_set("m").alias("cuts"))
    rest = placed.where(F.size("path") > F.col("m"))
    above = F.col("m") - 1
    loose = rest.select(
        F.get("path", F.col("m")).alias("key"),
        F.coalesce(F.when(F.col("m") > 0, F.get("path", above)), F.lit(ROOT)).alias("parent"),
        F.col("m").alias("top"),
        F.coalesce(F.when(F.col("m") > 0, F.get("chars", above)), F.lit(0)).alias("above"),
        F.slice("path", F.col("m") + 1, F.size("path")).alias("path"),
        F.slice("chars", F.col("m") + 1, F.size("path")).alias("chars"),
    )
    return stored(spark, _cut(trie, cuts).unionByName(_hang(loose)), "trie")


def build(
    spark: SparkSession, sequences: DataFrame, first: int = 4096, growth: int = 8
) -> DataFrame:
    """The compacted trie of distinct sequences (last, path, chars).

    The first batch has about ``first`` sequences, each further one ``growth`` times what
    is in the trie, chosen by the hash of the whole sequence.
    """
    total = sequences.count()
    trie = spark.createDataFrame([(ROOT, 0, None, 0, [], [], 0)], NODE)
    share = F.pmod(F.xxhash64("last"), F.lit(1 << 30)) / float(1 << 30)
    below, size = 0.0, first
    while total and below < 1:
        upto = 1.0 if size >= total else size / total
        trie = insert(spark, trie, sequences.where((share >= below) & (share < upto)))
        below, size = upto, size * (growth + 1)
    return trie


def _climb(spark: SparkSession, nodes: DataFrame, sums: list[str], lows: list[str]) -> DataFrame:
    """Sums and minima of every node's subtree, itself included.

    Pointer doubling: a node passes what it has of the nodes within 2^k below it to the one
    2^k above, so rounds grow with the logarithm of the trie's compacted depth. Each round
    adds up per receiver before it joins. The root, whose sums are those of all nodes, takes
    no part.
    """
    aggregates = [F.sum(c).alias(f"{c}_in") for c in sums] + [F.min(c).alias(f"{c}_in") for c in lows]
    state = stored(spark, nodes, "trie-sums")
    while not state.where(F.col("up").isNotNull()).isEmpty():
        rising = state.where(F.col("up").isNotNull())
        given = rising.groupBy(F.col("up").alias("node")).agg(*aggregates)
        further = lookup_join(
            rising.select("node", "up"),
            state.select(F.col("node").alias("met"), F.col("up").alias("next")), "up", "met",
        ).select("node", "next")
        added = [(F.col(c) + F.coalesce(f"{c}_in", F.lit(0))).alias(c) for c in sums]
        lowered = [F.least(c, f"{c}_in").alias(c) for c in lows]
        state = stored(spark, state.drop("up").join(given, "node", "left").join(
            further, "node", "left"
        ).select("node", F.col("next").alias("up"), *added, *lowered), "trie-sums")
    return state.drop("up")


def _joined_hashes(spark: SparkSession, members: DataFrame) -> DataFrame:
    """(last, sha256) of the ascending, comma-joined conv_ids of each sequence's members.

    SHA-256 takes its input in one order, so a sequence's ids meet in one task, but as
    blocks: sorted in ranges that may part within a sequence, written out as digits, and
    then streamed through the hash block by block.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, digits, size = None, None, [], 0
        for batch in batches:
            out: list[tuple] = []
            for last, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if last != key or size >= BLOCK:
                    if digits:
                        out.append((key, first, ",".join(digits)))
                    key, first, digits, size = last, conv, [], 0
                digits.append(str(conv))
                size += len(digits[-1]) + 1
            if out:
                yield _columns(out)
        if digits:
            yield _columns([(key, first, ",".join(digits))])

    def _columns(rows: list[tuple]) -> pa.RecordBatch:
        last, first, body = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(last, pa.binary()), pa.array(first, pa.int64()), pa.array(body)],
            names=["last", "first", "body"],
        )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            out = []
            for last, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if last != key:
                    if running is not None:
                        out.append((key, running.hexdigest()))
                    key, running = last, hashlib.sha256(body.encode())
                else:
                    running.update(b"," + body.encode())
            if out:
                yield pairs(out)
        if running is not None:
            yield pairs([(key, running.hexdigest())])

    def pairs(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])],
            names=["last", "sha256"],
        )

    listed = map_batches(
        members.select("last", "conv_id").repartitionByRange("last", "conv_id")
        .sortWithinPartitions("last", "conv_id"),
        blocks, "last binary, first bigint, body string",
    )
    return map_batches(
        stored(spark, listed, "trie-ends").repartition("last").sortWithinPartitions("last", "first"),
        hashes, "last binary, sha256 string",
    )


def prefix_nodes(
    spark: SparkSession, conversations: DataFrame, conv_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    first: int = 4096, growth: int = 8,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see ``rebuilt``).

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root:
    null), n_convs (members), n_children, n_leaves (childless nodes in the subtree, itself
    included), saved_tokens (summed over the subtree: members but one times the code points
    of the node's last text) and ends_sha256 (SHA-256 of the conv_ids that end here,
    ascending, comma-joined; of nothing where none does).

    Turns that repeat are turns of their own; conversations that are alike share all their
    nodes; one without any turn ends at the root. Rows without a conversation id don't
    count, other columns are not read. Long texts are hashed, never moved; a conversation's
    hashes (24 bytes a turn) form one row. An empty table gives no rows, not even a root.
    """
    members = stored(spark, prefixes(rebuilt(
        conversations, conv_col, turn_col, role_col, text_col
    )), "trie-members")
    sequences = stored(spark, members.groupBy("last").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"),
        F.first("path").alias("path"), F.first("chars").alias("chars"),
    ), "trie-sequences")
    trie = build(spark, sequences.where(F.size("path") > 0), first, growth)
    ending = sequences.select(
        F.col("last").alias("node"), F.col("n").alias("ending"), F.col("conv_id").alias("low"),
        F.coalesce(F.get("chars", F.size("chars") - 1), F.lit(0)).alias("read"),
    )
    below = trie.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("children")
    )
    facts = stored(spark, trie.select("node", "parent", "top", "depth", "chars", "chars_above").join(
        below, "node", "left"
    ).join(ending, "node", "left").select(
        "node", F.when(F.col("top") > 0, F.col("parent")).alias("up"),
        F.coalesce("children", F.lit(0)).alias("children"),
        F.coalesce("ending", F.lit(0)).alias("n"), "low",
        F.col("children").isNull().cast("bigint").alias("leaves"),
        # what its members read down to their ends, and the text of its own edge
        (F.coalesce("ending", F.lit(0)) * F.coalesce("read", F.lit(0))).alias("read"),
        F.when(
            F.col("depth") > 0, F.element_at("chars", -1) - F.col("chars_above")
        ).otherwise(0).alias("edge_chars"),
    ), "trie-facts")
    sums = ["n", "leaves", "read", "edge_chars"]
    inner = _climb(
        spark, facts.where(F.col("node") != F.lit(ROOT)).drop("children"), sums, ["low"]
    )
    whole = facts.groupBy().agg(
        F.lit(ROOT).alias("node"), *[F.sum(c).alias(c) for c in sums], F.min("low").alias("low")
    ).where("n > 0")
    totals = stored(spark, inner.unionByName(whole.select(inner.columns)).join(
        facts.select("node", "children"), "node"
    ), "trie-totals")
    return _expanded(trie, totals, _joined_hashes(spark, members))


def _expanded(trie: DataFrame, totals: DataFrame, ends: DataFrame) -> DataFrame:
    """Every depth of every edge as a node of its own."""
    upper = totals.select(F.col("node").alias("upper"), F.col("low").alias("upper_low"))
    rows = trie.join(totals, "node").join(ends.withColumnRenamed("last", "node"), "node", "left")
    rows = lookup_join(rows, upper, "parent", "upper", "left")
    at = F.explode(F.when(
        F.col("depth") > 0, F.sequence(F.col("top") + 1, F.col("depth"))
    ).otherwise(F.array(F.lit(0))))
    d, end = F.col("at"), F.col("at") == F.col("depth")
    above = F.when(d - 1 > F.col("top"), F.get("chars", d - F.col("top") - 2)).otherwise(
        F.col("chars_above")
    )
    # members read down to their ends, less what they read above; less each text once
    read = F.col("read") - F.col("n") * above
    once = F.col("edge_chars") - (above - F.col("chars_above"))
    return rows.withColumn("at", at).select(
        F.col("low").alias("conv_id"), d.cast("bigint").alias("depth"),
        F.when(d > F.col("top") + 1, F.col("low")).otherwise(F.col("upper_low")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(end, F.col("children")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (read - once).alias("saved_tokens"),
        F.when(end & F.col("sha256").isNotNull(), F.col("sha256"))
        .otherwise(EMPTY_SHA256).alias("ends_sha256"),
    )
