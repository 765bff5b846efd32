"""The trie of conversations that share their first turns, with totals of every subtree.

Subtree totals come from parallel tree contraction. The nodes of one smallest member follow each
other down the trie, as what shares a longer prefix is a part of what shares a shorter one; they
are chains, and all of them are compressed at once by a sum over each. What is left is the tree of
these paths. A round rakes all its leaves, whose totals are then known, into their parents, and
compresses chains of paths: of those with one child some that aren't neighbours, picked by coins,
hand their sum to their parent and their child too. So a chain of any length is gone after a
logarithmic number of join rounds, and a path with very many children receives one sum. At the end
compressed paths are expanded: each total is its own sum and the total of the path that it was left
above, found by jumping over paths that were compressed themselves; a node's total is the one of its
path without what hangs higher up on it.

Every round is planned by the driver, which keeps what it planned for a while, so that rounds cost
its memory; there are as many as paths hang on paths, or fewer, not as many as turns call for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

#: Turns of one conversation that one window group sums up.
SLICE = 4096
#: Sums that make up a prefix key, of numbers of 60 bits each.
LANES = 4


def _numbers(depth: Column, digest: Column) -> list[Column]:
    """Numbers of a turn at its place; a prefix is known by their sums."""
    told = F.sha2(F.concat_ws(":", depth.cast("string"), digest).cast("binary"), 256)
    return [F.conv(F.substring(told, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(LANES)]


def _key(depth: Column, sums: list[Column]) -> Column:
    told = F.concat_ws(".", depth.cast("string"), *[s.cast("decimal(38,0)").cast("string") for s in sums])
    return F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 32))


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0)] * LANES)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns with their place in the whole order of conversations, numbered from 0.

    A range-partitioned sort, so that a conversation of any length spans tasks; equal turns are
    told apart by a written number. Only one count per partition is broadcast."""
    turns = written(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).filter("conv_id is not null")
        .withColumn("nth", F.monotonically_increasing_id()), "trie-turns")
    order = ["conv_id", "turn", "role", "text", "nth"]
    placed = written(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.char_length("text").cast("long").alias("points"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("place")), "trie-places")
    part = F.shiftright("place", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "conv_id", "points", "digest", (F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("at"))


def rebuilt(conversations: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, digest, points, last).

    A conversation starts with the first turns, fewer than ``most`` by a hash of its id, of the
    first one of its block, and goes on with its own turns after as many."""
    turns = _ordered(conversations)
    counts = turns.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    counts = counts.withColumns({
        "h": F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)),
        "base": F.col("conv_id") - F.col("conv_id") % block})
    given = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = written(counts.join(given, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "conv_id", "first", "h", "base", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    mine = turns.join(convs, "conv_id").withColumn("pos", F.col("at") - F.col("first") + 1)
    own = mine.filter("pos > h").select("conv_id", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "digest", "points", "length")
    heads = mine.filter((F.col("pos") < most) & (F.col("conv_id") == F.col("base"))).select("base", "pos", "digest", "points")
    # At most five turns, of a first conversation that at most a block of others share.
    shared = convs.join(heads, "base").filter("pos <= k").select("conv_id", F.col("pos").alias("depth"), "digest", "points", "length")
    steps = own.unionByName(shared)
    return convs, steps.withColumn("last", F.col("depth") == F.col("length")).drop("length")


def _running(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (conv_id, depth, …, read twice) with the sums of ``columns`` over all up to each one's depth,
    in ``upto_`` columns. Window groups are slices, so that a conversation of any length spans tasks."""
    rows = rows.withColumn("slice", F.floor((F.col("depth") - 1) / SLICE))
    whole = rows.groupBy("conv_id", "slice").agg(*[F.sum(x).alias(x) for x in columns])
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select("conv_id", "slice", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"_c_{x}") for x in columns])
    inside = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({f"_s_{x}": F.sum(x).over(inside) for x in columns}).join(carried, ["conv_id", "slice"])
    return summed.select(*[c for c in rows.columns if c != "slice"], *[(F.col(f"_s_{x}") + F.col(f"_c_{x}")).alias(f"upto_{x}") for x in columns])


def _prefixes(steps: DataFrame) -> DataFrame:
    """Key and parent key of the prefix that ends at each turn."""
    numbers = [f"x{i}" for i in range(LANES)]
    steps = written(steps.withColumns(dict(zip(numbers, _numbers(F.col("depth"), F.col("digest"))))).drop("digest"), "trie-steps")
    upto = [F.col(f"upto_{x}") for x in numbers]
    before = [s - F.col(x) for s, x in zip(upto, numbers)]
    return written(_running(steps, numbers).select(
        "conv_id", "depth", "points", "last", _key(F.col("depth"), upto).alias("id"),
        _key(F.col("depth") - 1, before).alias("parent")), "trie-prefixes")


# --- contraction ------------------------------------------------------------------------


def subtree_sums(tree: DataFrame, columns: list[str]) -> DataFrame:
    """id and, for each of ``columns``, the sum over the subtree of every node of ``tree`` (id,
    parent, columns), by contraction. Parents are null at roots and nodes of the tree elsewhere."""
    none = F.lit(None).cast(tree.schema["id"].dataType)
    state = written(tree.select("id", "parent", *columns), "tree-0")
    raked: list[DataFrame] = []
    spliced: list[DataFrame] = []
    turn = 0
    while not state.isEmpty():
        turn += 1
        kids = state.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count(F.lit(1)).alias("kids"), F.min("id").alias("child"))
        now = state.join(kids, "id", "left")
        heads = [F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 0 for c in ("id", "parent")]
        # Two neighbours are never picked, as the coin of the upper one must differ; and the child of
        # a picked one must have children, which a leaf raked in this round has not.
        single = now.filter((F.col("kids") == 1) & F.col("parent").isNotNull() & heads[0] & ~heads[1])
        picked = written(single.join(kids.select(F.col("id").alias("child")), "child", "left_semi")
                         .select("id", "parent", "child", *columns), f"tree-picked-{turn}")
        given = now.filter("kids is null").select("parent", *columns).unionByName(picked.select("parent", *columns))
        news = (
            given.filter("parent is not null").select(F.col("parent").alias("id"), *columns, none.alias("_to"), F.lit(False).alias("_gone"))
            .union(picked.select(F.col("child").alias("id"), *[F.lit(0) for _ in columns], F.col("parent"), F.lit(False)))
            .union(picked.select("id", *[F.lit(0) for _ in columns], none, F.lit(True)))
            .groupBy("id").agg(*[F.sum(c).alias(f"_{c}") for c in columns], F.max("_to").alias("_to"), F.max("_gone").alias("_gone"))
        )
        after = written(now.join(news, "id", "left").select(
            "id", F.coalesce("_to", "parent").alias("parent"), "child",
            *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns],
            F.when(F.col("kids").isNull(), "raked").when(F.col("_gone"), "spliced").otherwise("kept").alias("fate")), f"tree-{turn}")
        raked.append(after.filter("fate = 'raked'").select("id", *columns))
        spliced.append(after.filter("fate = 'spliced'").select("id", "child", *columns))
        state = after.filter("fate = 'kept'").select("id", "parent", *columns)
    return _expanded(raked, spliced, columns, turn)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _expanded(raked: list[DataFrame], spliced: list[DataFrame], columns: list[str], rounds: int) -> DataFrame:
    """Totals of all nodes. A spliced node lies above one that stayed longer, so a path of jumps
    is no longer than there were rounds, and each jump doubles."""
    if not rounds:
        return None
    none = F.lit(None).cast(raked[0].schema["id"].dataType)
    nodes = written(_union([r.select("id", none.alias("child"), *columns) for r in raked] + spliced), "tree-open")
    for step in range(max(rounds - 1, 1).bit_length()):
        below = nodes.select(F.col("id").alias("child"), F.col("child").alias("_next"), *[F.col(c).alias(f"_{c}") for c in columns])
        still = nodes.filter("child is not null")
        jumped = still.join(below, "child").select("id", F.col("_next").alias("child"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in columns])
        nodes = written(nodes.filter("child is null").unionByName(jumped), f"tree-open-{step}")
    return nodes.select("id", *columns)


def _with_totals(nodes: DataFrame) -> DataFrame:
    """``nodes`` (id, conv_id, depth, parent_conv_id, n_convs, own) with ``n_children``, ``n_leaves`` and, as
    ``saved_tokens``, the sum of ``own`` over the subtree of each.

    A path has the nodes of one conv_id, at consecutive depths, and hangs on the node of its
    first one's parent_conv_id a turn higher."""
    paths = written(nodes.groupBy("conv_id").agg(
        F.max(F.when(F.col("parent_conv_id") != F.col("conv_id"), F.col("parent_conv_id"))).alias("over"),
        (F.min("depth") - 1).alias("at"), F.max("depth").alias("bottom"), F.sum("own").alias("saved")), "trie-paths")
    holding = paths.filter("over is not null").select(F.col("over").alias("conv_id"), F.col("at").alias("bottom")).distinct()
    tree = paths.join(holding.withColumn("held", F.lit(0)), ["conv_id", "bottom"], "left").select(
        F.col("conv_id").alias("id"), F.col("over").alias("parent"), F.coalesce("held", F.lit(1)).cast("long").alias("leaves"), "saved")
    totals = subtree_sums(tree, ["leaves", "saved"])
    if totals is None:
        return nodes.limit(0).withColumns({c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")})
    paths = written(paths.drop("saved").join(totals.withColumnRenamed("id", "conv_id"), "conv_id"), "trie-paths-summed")
    hung = paths.filter("over is not null").groupBy(F.col("over").alias("conv_id"), F.col("at").alias("depth")).agg(
        F.count(F.lit(1)).alias("hung"), F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    held = written(nodes.join(hung, ["conv_id", "depth"], "left").select(
        *nodes.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("hung", "_leaves")],
        (F.col("own") + F.coalesce("_saved", F.lit(0))).alias("_saved")), "trie-held")
    # A path's total without what its higher nodes hold themselves.
    return _running(held, ["_leaves", "_saved"]).join(paths.select("conv_id", "bottom", "leaves", "saved"), "conv_id").select(
        *nodes.columns, (F.col("hung") + (F.col("depth") < F.col("bottom")).cast("long")).alias("n_children"),
        (F.col("leaves") - F.col("upto__leaves") + F.col("_leaves")).alias("n_leaves"),
        (F.col("saved") - F.col("upto__saved") + F.col("_saved")).alias("saved_tokens"))


# --- the report -------------------------------------------------------------------------


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined numbers of each run of equal ids, as they stream by."""
    schema = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])
    current, running = None, None
    for batch in batches:
        done: list[tuple] = []
        ids, numbers = batch.column(0), batch.column(1)
        encoded = ids.dictionary_encode()
        codes = encoded.indices.to_numpy()
        names = encoded.dictionary.to_pylist()
        cuts = [0, *((codes[1:] != codes[:-1]).nonzero()[0] + 1).tolist(), len(codes)] if len(codes) else []
        for i, j in zip(cuts, cuts[1:]):
            if names[codes[i]] != current:
                if running is not None:
                    done.append((current, running.hexdigest()))
                current, running, mark = names[codes[i]], hashlib.sha256(), b""
            else:
                mark = b","
            running.update(mark + ",".join(map(str, numbers.slice(i, j - i).to_pylist())).encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], schema.types[k]) for k in (0, 1)], schema=schema)
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([running.hexdigest()], pa.string())], schema=schema)


def prefix_trie(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` and ``n_convs`` of its
    members, ``depth``, ``parent_conv_id``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its
    subtree, ``ends_sha256`` of the conversations that end there.

    Turns are ordered by ``turn``, null first; those of one number by role and text. Null role or
    text counts as empty. Rows without ``conv_id`` belong to no conversation. Repeated rows are
    turns of their own, texts of any length count whole, other columns don't matter, and without
    conversations there are no rows, the root included. Prefixes are told by 240 bits of sums of
    their turns' digests; a node where very many conversations end has its ids, and nothing else,
    hashed by one task as they stream by, because SHA-256 has one order.
    """
    convs, steps = rebuilt(conversations, block, most)
    prefixes = _prefixes(steps)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        _root().alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("points"))
    nodes = prefixes.groupBy("id", "parent", "depth", "points").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    nodes = written(nodes.select(root.columns).union(root), "trie-nodes")
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = written(nodes.join(above, "parent", "left").select(
        "id", "conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("points")).alias("own")), "trie-placed")
    ends = prefixes.filter("last").select("id", "conv_id").union(convs.filter("length = 0").select(_root(), "conv_id"))
    ends = ends.repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(_hashed, "id binary, ends_sha256 string")
    return _with_totals(placed).join(ends, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
