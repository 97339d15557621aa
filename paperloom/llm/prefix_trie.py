"""Prefix trie of conversations, built as a z-fast trie.

A conversation is the sequence of fingerprints of its prefixes: 128 bits that add up
turn by turn, so that they come from running sums. A compacted node is an edge
``(low, high]`` of a conversation that has it, and is found by its handle: the
fingerprint of the prefix whose length is the two-fattest number of the edge, the one
that most powers of two divide. Where a conversation leaves the trie is found by fat
binary search: it asks for the handle at the two-fattest length of what is still open
and goes on above or below, a join per step with the steps of all conversations at once.

Conversations are inserted in batches: of those that leave the trie by the same new
branch the longest goes in, the rest follow in the next batch, from where they left. A
conversation that was stored again after each of its turns takes one batch. In the end
sums over subtrees are taken by doubling parent pointers, and edges are expanded.

Rows are keyed by conversation and depth throughout: neither a long conversation nor a
common beginning ever is one task's or one row's.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import n_words, stored
from paperloom.session import shared_dir

# Turns of one conversation that are numbered in one window.
CHUNK = 4096
# Depths at which a conversation is compared with a node at a time, and steps of the search from one table to the next.
PROBES = 16
STEPS = 3
# Ids of a group of equal conversations that are joined to one string at a time.
IDS_AT_ONCE = 4096


def two_fattest(low: Column, high: Column) -> Column:
    """The number in ``(low, high]`` that the greatest power of two divides."""
    zeros = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, zeros), zeros)


def _running(rows: DataFrame, order: list[Column], chunk: Column, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with running values of each conversation, counted in chunks and shifted by the chunks before."""
    add = lambda c: F.bit_xor if c.startswith("p") else F.sum
    inside = Window.partitionBy("conv", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("chunk", chunk)
    totals = rows.groupBy("conv", "chunk").agg(*[add(c)(value).alias(c) for c, value in sums.items()])
    before = totals.select(F.col("conv").alias("its_conv"), F.col("chunk").alias("its_chunk"), *[F.coalesce(add(c)(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums])
    local = rows.withColumns({f"{c}_here": add(c)(value).over(inside) for c, value in sums.items()})
    joined = local.join(before, (F.col("conv") == F.col("its_conv")) & F.col("chunk").eqNullSafe(F.col("its_chunk")))
    whole = {c: F.col(f"{c}_here").bitwiseXOR(F.col(f"{c}_before")) if c.startswith("p") else F.col(f"{c}_here") + F.col(f"{c}_before") for c in sums}
    return joined.withColumns(whole).drop("chunk", "its_conv", "its_chunk", *[f"{c}_{x}" for c in sums for x in ("here", "before")])


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, depth, t1, t2, words``: the turns of each conversation from 1, as fingerprints.

    In order of the turn number, null first; turns of one number in a fixed order by
    their fingerprint. Null roles and texts are empty ones. Rows without a conversation
    belong to none and are left out; repeated rows are turns of their own.
    """
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        *[F.xxhash64(F.lit(k), F.length(role), role, text).alias(f"t{k}") for k in (1, 2)],
        n_words(text).alias("words"),
    )
    placed = _running(
        rows,
        [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")],
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**61))).cast("long"),
        {"depth": F.lit(1).cast("long")},
    )
    return placed.select("conv", "depth", "t1", "t2", "words")


def _keyed_table(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` in the shared folder, bucketed by ``keys``: joins on them leave it where it is."""
    spark = df.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", f"{shared_dir(spark).rstrip('/')}/{table}").saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name; the files stay
    return found


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, p1, p2, w`` of ``conv, depth, t1, t2, words``: fingerprint and words of each prefix, as a stored table."""
    lanes = {f"p{k}": F.xxhash64(F.lit(k), "depth", "t1", "t2") for k in (1, 2)}
    rows = _running(turns, [F.col("depth")], F.floor(F.col("depth") / CHUNK).cast("long"), {**lanes, "w": F.col("words")})
    return _keyed_table(rows.select("conv", "depth", "p1", "p2", "w"), ["conv", "depth"], "prefixes")


def _at(rows: DataFrame, known: DataFrame, conv: Column, depth: Column, **columns: str) -> DataFrame:
    """``rows`` with columns of the prefix of a conversation at a depth; null where there is none."""
    found = known.select(F.col("conv").alias("at_conv"), F.col("depth").alias("at_depth"), *[F.col(c).alias(new) for new, c in columns.items()])
    keyed = rows.withColumns({"of_conv": conv, "of_depth": depth})
    return keyed.join(found, (F.col("of_conv") == F.col("at_conv")) & (F.col("of_depth") == F.col("at_depth")), "left").drop("of_conv", "of_depth", "at_conv", "at_depth")


def _indexed(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Nodes ``rep, low, high`` with their handle (at ``fat``) and the fingerprint of their first turn's prefix."""
    nodes = nodes.withColumn("fat", two_fattest(F.col("low"), F.col("high")))
    handled = _at(nodes, known, F.col("rep"), F.col("fat"), f1="p1", f2="p2")
    return _at(handled, known, F.col("rep"), F.col("low") + 1, g1="p1", g2="p2")


def _common(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``conv, n, m, rep, low, high`` with ``m`` as far up as conversation and node agree; rows without a node keep it.

    Agreement only ever ends once, so it is enough to compare at ``PROBES`` depths and to go on between two of them.
    """
    columns = ["conv", "n", "m", "rep", "low", "high"]
    up = F.when(F.col("rep").isNull(), F.col("m")).otherwise(F.least("high", "n"))
    open_, done = rows.select(*columns, up.alias("up")), None
    while True:
        over = open_.filter("m >= up").select(columns)
        done = over if done is None else done.union(over)
        open_ = open_.filter("m < up")
        if not open_.limit(1).count():
            return done
        step = F.ceil((F.col("up") - F.col("m")) / PROBES).cast("long")
        probes = open_.withColumn("step", step)
        probes = probes.withColumn("try", F.explode(F.sequence(F.col("m") + F.col("step"), F.col("up"), F.col("step"))))
        probes = _at(_at(probes, known, F.col("conv"), F.col("try"), x1="p1", x2="p2"), known, F.col("rep"), F.col("try"), y1="p1", y2="p2")
        same = (F.col("x1") == F.col("y1")) & (F.col("x2") == F.col("y2"))
        agreed = probes.groupBy(*columns, "up", "step").agg(F.coalesce(F.max(F.when(same, F.col("try"))), F.col("m")).alias("to"))
        open_ = stored(agreed.select(
            "conv", "n", F.col("to").alias("m"), "rep", "low", "high", F.least(F.col("up"), F.col("to") + F.col("step") - 1).alias("up")
        ), "trie-common")


def _exits(active: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """``conv, n, m, rep, low, high``: how far each conversation follows the trie, and the edge inside of which it leaves it, if any."""
    handles = nodes.select("rep", "low", "high", F.col("fat").alias("h"), "f1", "f2")
    none = F.lit(None).cast("long")
    open_ = active.select("conv", "n", "m", F.col("m").alias("a"), F.col("n").alias("b"), none.alias("rep"), none.alias("low"), none.alias("high"), F.col("m").alias("sure"))
    done = None
    hits = handles.select(F.col("rep").alias("r"), F.col("low").alias("l"), F.col("high").alias("u"), "h", "f1", "f2")
    while open_ is not None:
        step = open_
        for _ in range(STEPS):
            searching = F.col("a") < F.col("b")
            asked = step.withColumn("fat", F.when(searching, two_fattest(F.col("a"), F.col("b"))).otherwise(-1 - F.col("conv")))
            asked = _at(asked, known, F.col("conv"), F.col("fat"), x1="p1", x2="p2")
            step = asked.join(hits, (F.col("fat") == F.col("h")) & (F.col("x1") == F.col("f1")) & (F.col("x2") == F.col("f2")), "left")
            hit = F.col("r").isNotNull()
            step = step.select(
                "conv", "n", "m",
                F.when(hit, F.least("u", "n")).otherwise(F.col("a")).alias("a"),
                F.when(hit | ~searching, F.col("b")).otherwise(F.col("fat") - 1).alias("b"),
                F.coalesce("r", "rep").alias("rep"),
                F.when(hit, F.col("l")).otherwise(F.col("low")).alias("low"),
                F.when(hit, F.col("u")).otherwise(F.col("high")).alias("high"),
                F.when(hit, F.col("fat")).otherwise(F.col("sure")).alias("sure"),
            )
        step = stored(step, "trie-search")
        over = step.filter("a >= b")
        done = over if done is None else done.union(over)
        open_ = step.filter("a < b")
        if not open_.limit(1).count():
            open_ = None
    # Of the last node found the handle is shared. If its whole edge is, the conversation ends there or may go on to a child.
    to = F.when(F.col("rep").isNull(), F.col("sure")).otherwise(F.least("high", "n"))
    last = _at(_at(done.withColumn("to", to), known, F.col("conv"), F.col("to"), x1="p1", x2="p2"), known, F.coalesce("rep", -1 - F.col("conv")), F.col("to"), y1="p1", y2="p2")
    shared = F.col("rep").isNull() | F.coalesce((F.col("x1") == F.col("y1")) & (F.col("x2") == F.col("y2")), F.lit(False))
    last = last.withColumn("goes_on", shared & (F.col("to") < F.col("n"))).select(
        "conv", "n", F.when(shared, F.col("to")).otherwise(F.col("sure")).alias("m"), "rep", "low", "high", "goes_on"
    )
    last = stored(last, "trie-last")
    gates = nodes.select(F.col("rep").alias("r"), F.col("low").alias("l"), F.col("high").alias("u"), "g1", "g2")
    onward = _at(last.filter("goes_on").select("conv", "n", "m"), known, F.col("conv"), F.col("m") + 1, x1="p1", x2="p2")
    onward = onward.join(gates, (F.col("m") == F.col("l")) & (F.col("x1") == F.col("g1")) & (F.col("x2") == F.col("g2")), "left")
    onward = onward.select("conv", "n", F.when(F.col("r").isNull(), F.col("m")).otherwise(F.col("m") + 1).alias("m"), F.col("r").alias("rep"), F.col("l").alias("low"), F.col("u").alias("high"))
    whole = _common(stored(last.filter("not goes_on").drop("goes_on").union(onward), "trie-met"), known)
    boundary = F.col("m") == F.col("high")
    return whole.withColumns({c: F.when(~boundary, F.col(c)) for c in ("rep", "low")}).withColumn("high", F.when(F.col("rep").isNotNull(), F.col("high")))


def insert(sequences: DataFrame, known: DataFrame) -> DataFrame:
    """Compacted nodes ``rep, low, high`` of different sequences ``conv, n`` (n at least 1), with prefixes ``known``."""
    spark = sequences.sparkSession
    columns = "rep long, low long, high long, fat long, f1 long, f2 long, g1 long, g2 long"
    nodes, active = spark.createDataFrame([], columns), stored(sequences.select("conv", "n", F.lit(0).cast("long").alias("m")), "trie-active")
    first = True
    while active.limit(1).count():
        if first:
            none = F.lit(None).cast("long")
            exits = active.select("conv", "n", "m", none.alias("rep"), none.alias("low"), none.alias("high"))
        else:
            exits = stored(_exits(active, nodes, known), "trie-exits")
        # Of the conversations that leave by one new branch the longest goes in.
        leaving = _at(exits.filter("m < n").select("conv", "n", "m"), known, F.col("conv"), F.col("m") + 1, x1="p1", x2="p2")
        longest = leaving.groupBy("m", "x1", "x2").agg(F.min(F.struct(-F.col("n"), F.col("conv"))).alias("best"))
        chosen = longest.select(F.col("best.conv").alias("inserted"))
        leaving = stored(leaving.select("conv", "n", "m").join(chosen, F.col("conv") == F.col("inserted"), "left"), "trie-leaving")
        leaves = leaving.filter("inserted is not null").select(F.col("conv").alias("rep"), F.col("m").alias("low"), F.col("n").alias("high"))
        # Edges left from inside are cut there.
        cuts = exits.filter("rep is not null").select("rep", "low", "high", F.col("m").alias("cut")).distinct()
        ends = cuts.union(cuts.select("rep", "low", "high", F.col("high").alias("cut")).distinct())
        by_edge = Window.partitionBy("rep", "high").orderBy("cut")
        parts = ends.select("rep", F.coalesce(F.lag("cut").over(by_edge), F.col("low")).alias("low"), F.col("cut").alias("high"))
        whole = nodes.join(cuts.select(F.col("rep").alias("r"), F.col("high").alias("u")).distinct(), (F.col("rep") == F.col("r")) & (F.col("high") == F.col("u")), "left_anti")
        nodes = stored(whole.unionByName(_indexed(parts.unionByName(leaves), known)), "trie-nodes")
        active = leaving.filter("inserted is null").select("conv", "n", "m")
        first = False
    return nodes.select("rep", "low", "high")


def _digests(members: DataFrame) -> DataFrame:
    """``n, p1, p2, ends_sha256``: digest of the ids of each group of equal sequences, ascending and comma-joined.

    Ids are joined in runs over ranges of all rows; a group's digest then reads its runs in order.
    """
    key = ["n", "p1", "p2"]

    def joined(batches):
        at, ids = None, []
        out = []
        for batch in batches:
            for n, p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (n, p1, p2) or len(ids) >= IDS_AT_ONCE:
                    if ids:
                        out.append((*at, ids[0], ",".join(map(str, ids))))
                    at, ids = (n, p1, p2), []
                ids.append(conv)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], runs.names)
                out = []
        if ids:
            out.append((*at, ids[0], ",".join(map(str, ids))))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(runs)], runs.names)

    def digested(batches):
        at, digest, out = None, None, []
        for batch in batches:
            for n, p1, p2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at == (n, p1, p2):
                    digest.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (n, p1, p2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(ended)], ended.names)
            out = []
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, digest.hexdigest()), ended)], ended.names)

    numbers = [(c, pa.int64()) for c in key]
    runs = pa.schema([*numbers, ("first", pa.int64()), ("ids", pa.string())])
    ended = pa.schema([*numbers, ("ends_sha256", pa.string())])
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = members.select(*key, "conv").repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
    rows = stored(ranged.mapInArrow(joined, "n long, p1 long, p2 long, first long, ids string"), "trie-runs")
    rows = rows.repartition(parts, *key).sortWithinPartitions(*key, "first")
    return rows.mapInArrow(digested, "n long, p1 long, p2 long, ends_sha256 string")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Sums over subtrees of ``key, up`` and values, by doubling the pointers ``up``; null at the top."""
    sums, now = ["n_convs", "path_words", "edge_words", "n_leaves"], nodes
    while now.filter("up is not null").limit(1).count():
        given = now.filter("up is not null").groupBy(F.col("up").alias("to")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in sums], F.min("least").alias("more_least")
        )
        above = now.select(F.col("key").alias("to_up"), F.col("up").alias("next"))
        moved = now.join(given, F.col("key") == F.col("to"), "left").join(above, F.col("up") == F.col("to_up"), "left")
        now = stored(moved.select(
            "key", F.col("next").alias("up"),
            *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in sums],
            F.least("least", "more_least").alias("least"),
        ), "trie-sums")
    return now


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct beginning of the conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    ``turns`` has ``conv, depth, t1, t2, words`` with depths from 1, ``members`` the id
    ``conv`` of every conversation, those without turns included. A node is named by its
    smallest member and its depth; the root has depth 0. Without members there is no row.
    """
    known = prefixes(turns)
    last = known.groupBy("conv").agg(F.max(F.struct("depth", "p1", "p2", "w")).alias("x"))
    last = last.select(F.col("conv").alias("c"), F.col("x.depth").alias("n"), "x.p1", "x.p2", "x.w")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    ends = stored(members.join(last, F.col("conv") == F.col("c"), "left").select("conv", *[zero(c) for c in ("n", "p1", "p2", "w")]), "trie-ends")
    groups = stored(ends.groupBy("n", "p1", "p2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"), F.first("w").alias("w")), "trie-groups")
    edges = insert(groups.filter("n > 0"), known)
    top = _at(_at(edges, known, F.col("rep"), F.col("high"), p1="p1", p2="p2", w_high="w"), known, F.col("rep"), F.col("low"), q1="p1", q2="p2", w_low="w")
    name = lambda depth, p, q: F.struct(F.col(depth).alias("d"), zero(p).alias("x"), zero(q).alias("y"))
    top = top.select("rep", "low", "high", name("high", "p1", "p2").alias("key"), name("low", "q1", "q2").alias("up"), "w_high", zero("w_low"))
    root = groups.agg(F.count("*").alias("some")).filter("some > 0")
    no = F.lit(None).cast("long")
    nil = F.lit(0).cast("long")
    root_key = F.struct(nil.alias("d"), nil.alias("x"), nil.alias("y"))
    roots = root.select(no.alias("rep"), nil.alias("low"), nil.alias("high"), root_key.alias("key"), F.lit(None).cast(top.schema["up"].dataType).alias("up"), nil.alias("w_high"), nil.alias("w_low"))
    top = stored(top.union(roots), "trie-top")
    children = top.filter("up is not null").groupBy(F.col("up").alias("of")).agg(F.count("*").alias("n_children"))
    own = groups.select(F.struct(F.col("n").alias("d"), F.col("p1").alias("x"), F.col("p2").alias("y")).alias("end"), "conv", "copies")
    valued = top.join(own, F.col("key") == F.col("end"), "left").join(children, F.col("key") == F.col("of"), "left")
    valued = stored(valued.select(
        "rep", "low", "high", "key", "up", "w_low", zero("n_children"),
        zero("copies").alias("n_convs"), (zero("copies") * F.col("w_high")).alias("path_words"),
        (F.col("w_high") - F.col("w_low")).alias("edge_words"), F.col("n_children").isNull().cast("long").alias("n_leaves"), F.col("conv").alias("least"),
    ), "trie-valued")
    sums = _subtrees(valued.select("key", "up", "n_convs", "path_words", "edge_words", "n_leaves", "least"))
    sums = stored(sums.drop("up").withColumnRenamed("key", "its"), "trie-subtrees")
    full = valued.select("rep", "low", "high", "key", "up", "w_low", "n_children").join(sums, F.col("key") == F.col("its"))
    above = sums.select(F.col("its").alias("parent"), F.col("least").alias("parent_least"))
    full = full.join(above, F.col("up") == F.col("parent"), "left")
    shas = _digests(ends).select(F.struct(F.col("n").alias("d"), F.col("p1").alias("x"), F.col("p2").alias("y")).alias("ended"), "ends_sha256")
    full = stored(full.join(shas, F.col("key") == F.col("ended"), "left"), "trie-full")
    # Every depth of an edge is a node; long edges are expanded in steps.
    start = F.explode(F.sequence(F.least(F.col("low") + 1, F.col("high")), F.col("high"), F.lit(CHUNK).cast("long")))
    opened = full.withColumn("start", start)
    opened = opened.withColumn("depth", F.explode(F.sequence("start", F.least(F.col("start") + (CHUNK - 1), F.col("high")))))
    opened = _at(opened, known, F.col("rep"), F.col("depth") - 1, w_above="w")
    above_words = F.coalesce("w_above", F.lit(0))
    return opened.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("low") + 1, F.col("least")).otherwise(F.col("parent_least")).alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("depth") < F.col("high"), nil + 1).otherwise(F.col("n_children")).alias("n_children"),
        "n_leaves",
        # Words of a path count once per conversation that ends below it, less once per node.
        (F.col("path_words") - F.col("n_convs") * above_words - (F.col("edge_words") - (above_words - F.col("w_low")))).alias("saved_tokens"),
        F.when((F.col("depth") == F.col("high")) & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
