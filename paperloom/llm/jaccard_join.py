"""N-gram Jaccard join: sets of word shingles, linked where their Jaccard similarity reaches a threshold.

Equal sets are collapsed first. Distinct sets meet in the inverted lists of their
rarest shingles (prefix filter). Lists are kept by size and position, and whole runs
of a list are skipped that a set cannot reach by size or by what is left behind the
position. A pair is worth a look only if it meets often enough in its lists. The
connected groups of such pairs are small; within one, full sets are compared. There
a set linked to one whose answers are known gets its own from them, corrected by the
lists of the shingles in which the two differ.

A list that is longer than ``LIST_ROWS`` comes from a large group of near copies or from
a passage that many texts share; pairs of it are not counted. Each set has a sketch, the
parities of its shingles by low bits: sets differ in as many shingles at least as their
sketches in bits. Sets of a long list are tied by one row each to one that the sketches
allow, and counted pairs must be allowed too, so what texts share by chance joins no
groups. Groups above ``GROUP_ROWS`` sets are split in blocks, and each pair of blocks is
a group of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import released, stored
from paperloom.llm.components import components
from paperloom.llm.shingles import mixed, shingle_set

PERCENT = 80
LIST_ROWS = 64
GROUP_ROWS = 4000
# Frequent shingles go last in every set; the list only steers speed, never a result.
FREQUENT = 300_000
SEEN_IN_TASK = 3
# Bits of the bitmap that says whose texts are needed again.
MARKS = 1 << 24
ROWS_AT_ONCE = 256
# A sketch has a power of two of bits, at least as many as the set has shingles within these bounds.
SKETCH_BITS = (256, 1 << 16)
_PLACE = 24  # bits


def prefix_length(n, percent: int = PERCENT):
    """Of a set of n: any set as similar shares one of so many of its first shingles."""
    return n - -(-percent * n // 100) + 1


def needed(n, m, percent: int = PERCENT):
    """Least intersection of linked sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def most_apart(n, m, percent: int = PERCENT):
    """Shingles at most that only one of two linked sets of n and m has; below 0 if no such sets are linked."""
    common = needed(n, m, percent)
    return np.where(common <= np.minimum(n, m), n + m - 2 * common, -1)


def sketch(shingles: np.ndarray) -> bytes:
    """Of each number that the low bits can be, whether an odd number of the set's shingles have it; none for an empty set."""
    if not len(shingles):
        return b""
    least, most = SKETCH_BITS
    bits = min(most, max(least, 1 << (len(shingles) - 1).bit_length()))
    return np.packbits(np.bincount(shingles & (bits - 1), minlength=bits) & 1).tobytes()


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of at least ``size`` bytes as rows of that size: either half of a sketch has the same lower bits."""
    if not size:
        return np.zeros((len(sketches), 0), np.uint64)
    rows = np.empty((len(sketches), size), np.uint8)
    for k, own in enumerate(sketches):
        rows[k] = np.bitwise_xor.reduce(np.frombuffer(own, np.uint8).reshape(-1, size))
    return rows.view(np.uint64)


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))


def _parts(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def frequent_shingles(bodies: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that tasks see often, with the documents counted; at most ``FREQUENT`` of them reach the driver."""

    def counted(batches):
        held, size = [], 0
        for part in _parts(batches):
            held += [shingle_set(t) for t in set(part.column(1).to_pylist())]
            size += sum(map(len, held[-part.num_rows :]))
            if size > 4_000_000:
                yield from often(held)
                held, size = [], 0
        if held:
            yield from often(held)

    def often(held):
        shingle, n = np.unique(np.concatenate(held), return_counts=True)
        keep = n >= SEEN_IN_TASK
        yield pa.RecordBatch.from_arrays([pa.array(shingle[keep]), pa.array(n[keep])], ["shingle", "n"])

    rows = bodies.mapInArrow(released(counted), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    shingle, n = top.column(0).to_numpy(), top.column(1).to_numpy()
    order = np.argsort(shingle)
    return shingle[order], n[order]


def sets_with_prefix(bodies: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, prefix, sketch``: size, 128-bit fingerprint, rarest shingles and sketch of each document."""
    known, counts = frequent

    def run(batches):
        for part in _parts(batches):
            n, f1, f2, prefixes, sketches = [], [], [], [], []
            for body in part.column(1).to_pylist():
                own = shingle_set(body)
                n.append(len(own))
                plain = own.view(np.uint64)
                f1.append(int(np.bitwise_xor.reduce(mixed(plain, 3)).view(np.int64)) if len(own) else 0)
                f2.append(int(np.sum(mixed(plain, 7), dtype=np.uint64).view(np.int64)) if len(own) else 0)
                first = prefix_length(len(own), percent) if len(own) else 0
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    own = own[np.lexsort((own, np.where(known[at] == own, counts[at], 0)))]
                prefixes.append(own[:first])
                sketches.append(sketch(own))
            columns = [pa.array(x, pa.int64()) for x in (n, f1, f2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *columns, pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "f1", "f2", "prefix", "sketch"],
            )

    return bodies.mapInArrow(released(run), "doc_id long, n_shingles long, f1 long, f2 long, prefix array<long>, sketch binary")


def _list_pairs(ids, sizes, places, percent: int):
    """``a, b, need``: pairs of one list that size and position leave possible, and how often they must meet.

    The list is in order of size, so runs are skipped at once. Below the end of the shorter
    prefix every common shingle is counted, so the intersection is at most the count and
    what lies behind a prefix.
    """
    order = np.argsort(sizes, kind="stable")
    ids, sizes, places = ids[order], sizes[order], places[order]
    ends = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    for k in range(len(ids)):
        others = slice(k + 1, ends[k])
        rest = np.minimum(sizes[k] - places[k], sizes[others] - places[others]) + np.minimum(places[k], places[others])
        least = needed(sizes[k], sizes[others], percent)
        ok = rest >= least
        behind = -(-percent * sizes[others][ok] // 100) - 1
        for other, need in zip(ids[others][ok], least[ok] - behind):
            yield (ids[k], other, need) if ids[k] < other else (other, ids[k], need)


def _tied(ids: np.ndarray, sizes: np.ndarray, sketches: list[bytes], percent: int):
    """``a, b`` of one long list: ties by which every two sets that their sketches let be linked are joined.

    Sets are visited from the least, each tied once, so a group of near copies is tied to
    its least set; that is the same one in the many lists of a group.
    """
    order = np.lexsort((ids, sizes))
    ids, sizes, sketches = ids[order], sizes[order], [sketches[k] for k in order]
    lengths = np.array([len(x) for x in sketches])
    for length in np.unique(lengths):
        # With the larger sets that one of this length can be linked to.
        most = sizes[lengths == length].max() * 100 // percent
        within = np.nonzero((lengths == length) | ((lengths > length) & (sizes <= most)))[0]
        own, n = _folded([sketches[k] for k in within], length), sizes[within]
        left = np.arange(len(within))
        while len(left) > 1:
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                at = todo.pop()
                low, high = np.searchsorted(n[left], [-(-percent * n[at] // 100), n[at] * 100 // percent + 1])
                near = left[low:high]
                apart = np.bitwise_count(own[near] ^ own[at]).sum(1, dtype=np.int64)
                met = apart <= most_apart(n[near], n[at], percent)
                todo.extend(near[met])
                for other in near[met]:
                    yield (ids[within[at]], ids[within[other]]) if ids[within[at]] < ids[within[other]] else (ids[within[other]], ids[within[at]])
                left = np.concatenate([left[:low], near[~met], left[high:]])


def _runs(batches, n_columns: int):
    """First column's value and the rows of the others, as lists, of each run of equal values; a run goes on over batches."""
    open_, held = None, None
    for batch in batches:
        keys = batch.column(0).to_numpy()
        turns = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
        for start, end in zip(turns[:-1], turns[1:]):
            if held is None or keys[start] != open_:
                if held:
                    yield open_, held
                open_, held = keys[start], [[] for _ in range(n_columns)]
            for k, column in enumerate(held):
                column += batch.column(k + 1).slice(start, end - start).to_pylist()
    if held:
        yield open_, held


def candidates(representatives: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b``: edges whose connected groups hold every linked pair of ``rep, n, prefix, sketch`` rows. Without sketches, long lists are tied whole."""
    if "sketch" not in representatives.columns:
        representatives = representatives.withColumn("sketch", F.lit(b""))
    entries = representatives.filter("n > 1").select("rep", "n", F.posexplode("prefix").alias("place", "shingle"))
    entries = entries.select("shingle", "rep", (F.shiftleft("n", _PLACE) + F.col("place")).alias("at"))

    def met(batches):
        """Runs of equal shingles; a run goes on over batches. Of short lists the pairs, of long ones the sets with the shingle."""
        open_, ids, at, long = None, [], [], False
        empty = lambda: {"a": [], "b": [], "need": [], "shingle": []}
        out = empty()

        def close():
            if len(ids) > 1:
                place = np.array(at)
                for a, b, need in _list_pairs(np.array(ids), place >> _PLACE, place & ((1 << _PLACE) - 1), percent):
                    out["a"].append(a), out["b"].append(b), out["need"].append(need), out["shingle"].append(None)

        for batch in batches:
            shingles, reps, places = (batch.column(i).to_numpy() for i in range(3))
            turns = np.concatenate([[0], np.nonzero(shingles[1:] != shingles[:-1])[0] + 1, [len(shingles)]])
            for start, end in zip(turns[:-1], turns[1:]):
                if open_ is None or shingles[start] != open_:
                    close()
                    open_, ids, at, long = shingles[start], [], [], False
                ids += reps[start:end].tolist()
                at += places[start:end].tolist()
                if long or len(ids) > LIST_ROWS:
                    out["a"] += ids
                    out["b"] += [None] * len(ids)
                    out["need"] += [None] * len(ids)
                    out["shingle"] += [open_] * len(ids)
                    ids, at, long = [], [], True
                if len(out["a"]) > 50_000:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = empty()
        close()
        yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("need", pa.int32()), ("shingle", pa.int64())])
    lists = entries.repartition("shingle").sortWithinPartitions("shingle")
    rows = stored(lists.mapInArrow(released(met), "a long, b long, need int, shingle long"), "jaccard-met")
    met_often = rows.filter("shingle is null").groupBy("a", "b").agg(F.count("*").alias("common"), F.min("need").alias("need"))
    met_often = met_often.filter("common >= need").select("a", "b")

    @F.arrow_udf("boolean")
    def can_link(n: pa.Array, own: pa.Array, m: pa.Array, other: pa.Array) -> pa.Array:
        most = most_apart(n.to_numpy(), m.to_numpy(), percent)
        apart = []
        for pair in zip(own.to_pylist(), other.to_pylist()):
            x, y = _folded(pair, min(map(len, pair)))
            apart.append(int(np.bitwise_count(x ^ y).sum()))
        return pa.array(np.array(apart, np.int64) <= most)

    def tied(batches):
        out = {"a": [], "b": []}
        for _, (ids, sizes, sketches) in _runs(batches, 3):
            for a, b in _tied(np.array(ids), np.array(sizes), sketches, percent):
                out["a"].append(a), out["b"].append(b)
            if len(out["a"]) > 50_000:
                yield pa.RecordBatch.from_pydict(out, edge)
                out = {"a": [], "b": []}
        yield pa.RecordBatch.from_pydict(out, edge)

    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    known = representatives.select("rep", "n", "sketch")
    sides = met_often.join(known.toDF("a", "n", "own"), "a").join(known.toDF("b", "m", "other"), "b")
    short = sides.filter(can_link("n", "own", "m", "other")).select("a", "b")
    long = rows.filter("shingle is not null").select("shingle", F.col("a").alias("rep")).join(known, "rep").select("shingle", "rep", "n", "sketch")
    long = long.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(released(tied), "a long, b long")
    return stored(short.union(long).distinct(), "jaccard-edges")


def answers(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT):
    """``k, places`` of every set of one group: the places of all other sets that it is linked to.

    A set that is linked to a counted one gets its counts of common shingles from that
    one's, corrected by the inverted lists of the shingles in which the two differ.
    """
    sizes = np.array([len(s) for s in sets])
    owner, values = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]

    def counts(shingles):
        spans = [owner[s:e] for s, e in zip(np.searchsorted(values, shingles, "left"), np.searchsorted(values, shingles, "right"))]
        return np.bincount(np.concatenate(spans), minlength=len(sets)) if spans else np.zeros(len(sets), np.int64)

    def near(k, common):
        found = 100 * common >= percent * (sizes + sizes[k] - common)
        found[k] = False
        return np.nonzero(found)[0]

    answered = np.zeros(len(sets), bool)
    for k in range(len(sets)):
        if answered[k]:
            continue
        common = counts(sets[k])
        places = near(k, common)
        answered[k] = True
        yield k, places
        for other in places[~answered[places]]:
            more, fewer = np.setdiff1d(sets[other], sets[k], True), np.setdiff1d(sets[k], sets[other], True)
            answered[other] = True
            yield other, near(other, common + counts(more) - counts(fewer))


def links(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``a, b, a_copies, b_copies``: every link (a < b) between different sets, each named by its least document, with the documents that hold the sets."""
    bodies = _bodies(docs, doc_id, text)
    return _all_links(bodies, *_representatives(bodies, percent)[1:], percent)


def n_links(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_links`` of :func:`classes`."""
    return classes(docs, percent, doc_id, text).select("doc_id", "n_links")


def _representatives(bodies: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets of all documents, ``f1, f2, rep, n, prefix, sketch`` of the different ones, and ``copied, copies``: the documents of each."""
    sets = stored(sets_with_prefix(bodies, frequent_shingles(bodies), percent), "jaccard-sets")
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    groups = full.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n_shingles", "prefix", "sketch")).alias("first"), F.count("*").alias("copies"))
    rows = groups.select("f1", "f2", F.col("first.doc_id").alias("rep"), F.col("first.n_shingles").alias("n"), "first.prefix", "first.sketch", "copies")
    rows = stored(rows, "jaccard-representatives")
    return sets, rows.drop("copies"), rows.select(F.col("rep").alias("copied"), "copies")


def _all_links(bodies: DataFrame, reps: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    placed = _placed(bodies, reps, copies, percent)

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("member")
        ids, block, out = part.member.to_numpy(), part.block.to_numpy(), []
        across = part.low.iloc[0] != part.high.iloc[0]
        for k, places in answers(ids, [np.frombuffer(s, np.int64) for s in part.shingles], percent):
            # Links within a block are those of the block's pair with itself.
            out += [(ids[k], ids[x]) for x in places if ids[k] < ids[x] and (not across or block[k] != block[x])]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    rows = placed.select("member", "group", "block", "low", "high", "shingles").groupBy("group", "low", "high")
    pairs = rows.applyInPandas(compared, "a long, b long")
    return pairs.join(copies.toDF("a", "a_copies"), "a").join(copies.toDF("b", "b_copies"), "b").select("a", "b", "a_copies", "b_copies")


def _around(bodies: DataFrame, reps: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    """``member, around, root``: documents with another set that a set is linked to, and a set that its links reach; of one group or pair of blocks.

    One row per set, however many links it has.
    """
    schema = pa.schema([("member", pa.int64()), ("around", pa.int64()), ("root", pa.int64())])

    def compared(part: pa.Table) -> pa.Table:
        ids, n, block = (part.column(c).to_numpy() for c in ("member", "copies", "block"))
        ids, first = np.unique(ids, return_index=True)  # a member that was read again
        n, block, shingles = n[first], block[first], part.column("shingles").take(first)
        across = part.column("low")[0] != part.column("high")[0]
        around, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for k, places in answers(ids, [np.frombuffer(x, np.int64) for x in shingles.to_pylist()], percent):
            if across:  # links within a block are those of the block's pair with itself
                places = places[block[places] != block[k]]
            around[k] = n[places].sum()
            joined = np.unique(root[np.append(places, k)])
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
        return pa.Table.from_arrays([pa.array(ids), pa.array(around), pa.array(ids[root])], schema=schema)

    rows = _placed(bodies, reps, copies, percent).select("member", "copies", "group", "block", "low", "high", "shingles")
    return rows.groupBy("group", "low", "high").applyInArrow(compared, "member long, around long, root long")


def classes(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs``; ``n_links`` counts the other rows that a row is linked to.

    A null or empty text, or one of white space, has no shingles and is alone; so is a
    row without an id, whose component is null. Rows that repeat an id and its text count
    as often; of different texts of one id it is open which stands for it.
    An empty table gives an empty one; other columns are not looked at.
    """
    bodies = _bodies(docs, doc_id, text)
    sets, reps, copies = _representatives(bodies, percent)
    found = stored(_around(bodies, reps, copies, percent), "jaccard-around")
    labels = components(found.filter("member != root").select(F.col("root").alias("a"), F.col("member").alias("b")), "jaccard")
    sums = found.groupBy("member").agg(F.sum("around").alias("around"))
    named = reps.join(copies, F.col("rep") == F.col("copied")).join(labels, F.col("rep") == F.col("id"), "left")
    named = named.join(sums, F.col("rep") == F.col("member"), "left").select(
        F.col("f1").alias("g1"),
        F.col("f2").alias("g2"),
        F.coalesce("component_id", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n_links"),
    )
    named = stored(named, "jaccard-classes")
    keyed = sets.withColumn("f1", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("f1")))
    return keyed.join(named, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def _marked(bodies: DataFrame, members: DataFrame) -> DataFrame:
    """``bodies`` without most of those that are no member.

    A bitmap of ``MARKS`` bits has the hashes of all members; texts without a mark are
    neither shuffled nor sent to a Python worker, only their ids are looked at. A row
    with the mark of another is left for the join to drop.
    """
    mark = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS)).cast("int")
    places = members.select(mark("member").alias("place")).distinct().toArrow().column(0).to_numpy()
    bits = np.zeros(MARKS, bool)
    bits[places] = True
    shared = bodies.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.arrow_udf("boolean")
    def has_mark(place: pa.Array) -> pa.Array:
        at = place.to_numpy()
        return pa.array((shared.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return bodies.filter(has_mark(mark("doc_id")))


def _placed(bodies: DataFrame, reps: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    """The sets of each group of candidates, once per pair of its blocks."""
    groups = components(candidates(reps, percent), "jaccard-groups").toDF("member", "group")
    sizes = groups.groupBy("group").agg(F.count("*").alias("rows"))
    members = groups.join(sizes.withColumnRenamed("group", "its"), F.col("group") == F.col("its")).join(copies, F.col("member") == F.col("copied"))
    members = stored(
        members.withColumn("blocks", F.ceil(F.col("rows") / GROUP_ROWS).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
        .select("member", "group", "copies", "blocks", "block"),
        "jaccard-members",
    )

    def shingled(batches):
        for part in _parts(batches):
            own = [shingle_set(t).tobytes() for t in part.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(own, pa.binary())], ["member", "group", "copies", "blocks", "block", "shingles"])

    chosen = members.join(_marked(bodies, members), F.col("member") == F.col("doc_id")).select("member", "group", "copies", "blocks", "block", "body")
    rows = chosen.mapInArrow(released(shingled), "member long, group long, copies long, blocks int, block int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0))))
    return rows.withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
