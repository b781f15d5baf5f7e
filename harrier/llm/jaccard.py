"""N-gram Jaccard join by a token-group matrix.

Texts with the same shingle set are one node. Nodes that share a token of their prefixes (the rarest tokens, enough
that two similar sets must share one) are candidates. Similar nodes are partitioned into groups of bounded size; a group
is shipped once with its token union, a query's overlap with the union bounds its overlap with every member, and
only groups whose bound reaches the threshold are opened, by one product of the query with the group's token-member
matrix. Rounds of two kinds open groups:

1. twice, groups of one: each node against the leader of its tokens' lists with which it shares most, where a list's
   leader is of its largest component so far. In a family of near copies almost every node links here, so rows stay
   linear in the nodes.
2. once, blocks of about ``block`` nodes of a component so far (or of nodes still alone), against the nodes of other
   components that share a prefix token with the block.

Sides of joins that grow with the corpus are merged, not broadcast, at every size (hints), so that the plan seen on a small
table is the plan of a large one.

Every pair of different components that shares a prefix token is so compared in full: no link is lost.

Defined cases: a null or empty text has no shingle, n_shingles 0, and is its own component. Repeated rows are one
node and link. A row with null doc_id takes part; the component is named by its smallest non-null doc_id. An empty
table gives an empty result. Very long texts are taken whole: their sets are compared as others are. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, plain, rows, set_key, shingle_set, utf8

#: Tokens counted as frequent at most; they only order the prefixes and split long lists, so the bound costs no link.
FREQUENT = 100_000
#: Rows of a token's list above which it is split, each part with a leader of its own.
LONG = 50_000
_SLICE = 2_000_000


def _tokens(text: str | None, k: int) -> np.ndarray:
    return shingle_set(utf8(text).lower(), k)


def _summary(k: int):
    """Per document its set's size and key (kind 0); per task the tokens it saw three times or more (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= 3
            return pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(often.sum(), np.int32)), "id": pa.array(token[often].view(np.int64)), "n": pa.array(n[often]), "node": pa.array(np.zeros(often.sum(), np.int64)), "key": pa.array(np.zeros(often.sum(), np.int64))})

        for batch in batches:
            ids, texts, keys = batch.column(0), batch.column(1), batch.column(2)
            n, node = [], []
            for i in range(batch.num_rows):
                t = _tokens(texts[i].as_py(), k)
                n.append(len(t))
                node.append(set_key(t) if len(t) else 0)
                held.append(t)
                size += len(t)
                if size >= _SLICE:
                    yield frequent()
                    held, size = [], 0
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(n), np.int32)), "id": ids, "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.int64()), "key": keys})
        if held:
            yield frequent()

    return run


def _prefixes(k: int, share: int, common: tuple[np.ndarray, np.ndarray]):
    """Rows (token, salt, node, n): each distinct set's rarest tokens. ``common``: frequent tokens, sorted, and their
    counts. The list of a token that is counted more than ``LONG`` times is split by salts from 1 on."""
    known, count = common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        out, held = [], 0

        def flush() -> pa.RecordBatch:
            token = np.concatenate([o[0] for o in out])
            node = np.repeat(np.array([o[1] for o in out], np.int64), [len(o[0]) for o in out])
            n = np.repeat(np.array([o[2] for o in out], np.int64), [len(o[0]) for o in out])
            salt = np.concatenate([o[3] for o in out])
            return pa.RecordBatch.from_pydict({"token": pa.array(token.view(np.int64)), "salt": pa.array(salt), "node": pa.array(node), "n": pa.array(n)})

        for (text,) in rows(batches, "text"):
            t = _tokens(text, k)
            if not len(t):
                continue
            key = set_key(t)
            if key in seen:
                continue
            seen.add(key)
            n = len(t)
            least = -(-share * n // 100)
            take = n - least + 1
            if len(known):
                at = np.minimum(np.searchsorted(known, t), len(known) - 1)
                weight = np.where(known[at] == t, count[at], 0)
                pick = np.argsort(weight, kind="stable")[:take]
                chosen, parts = t[pick], 1 + weight[pick] // LONG
                salt = np.where(parts > 1, 1 + key % parts, 0).astype(np.int32)
            else:
                chosen, salt = t[:take], np.zeros(take, np.int32)
            out.append((chosen, key, n, salt))
            held += take
            if held >= 200_000:
                yield flush()
                out, held = [], 0
            if len(seen) > 1_000_000:
                seen.clear()
        if out:
            yield flush()

    return run


def _open(k: int, share: int):
    """Open qualifying groups. Input sorted by (grp, part, role, node): a group's members, role 0, then its queries. A
    node whose document is repeated comes more than once; its repeats are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, matrix, last = None, [], None, None
        a, b = [], []

        def build():
            token = np.concatenate([m[0] for m in members])
            owner = np.repeat(np.arange(len(members)), [len(m[0]) for m in members])
            order = np.argsort(token, kind="stable")
            union, first = np.unique(token[order], return_index=True)
            sizes = np.array([len(m[0]) for m in members])
            return union, np.append(first, len(token)), owner[order], sizes

        for grp, part, role, node, comp, text in rows(batches, "grp", "part", "role", "node", "comp", "text"):
            if (grp, part) != current:
                current, members, matrix, last = (grp, part), [], None, None
            if (role, node) == last:
                continue
            last = (role, node)
            t = _tokens(text, k)
            if role == 0:
                members.append((t, node, comp))
                continue
            if not members:
                continue
            if matrix is None:
                matrix = build()
            union, first, owner, sizes = matrix
            at = np.minimum(np.searchsorted(union, t), len(union) - 1)
            hit = at[union[at] == t]
            if 100 * len(hit) < share * len(t):
                continue
            spans = first[hit + 1] - first[hit]
            where = np.repeat(first[hit] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            overlap = np.bincount(owner[where], minlength=len(members))
            # one link to each component says all about the query
            linked = {members[m][2]: members[m][1] for m in np.flatnonzero(100 * overlap >= share * (len(t) + sizes - overlap))}
            linked.pop(comp, None)
            a += [node] * len(linked)
            b += linked.values()
            if len(a) >= 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links(members: DataFrame, queries: DataFrame, source: DataFrame, scratch: Scratch, k: int, share: int, per_part: int = 64) -> DataFrame:
    """Links (a, b) of queries to members, both (grp, node, comp, held), one for each query and component. A group with
    many queries is opened in several parts, its members repeated in each, so that no task holds all queries of a hot
    group. ``held`` is the key of the row whose text stands for the node."""
    parts = queries.groupBy("grp").agg(F.ceil(F.count("*") / per_part).cast("int").alias("parts"))
    of = members.join(parts, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "node", "comp", "held")
    asked = queries.join(parts, "grp").select("grp", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node", "comp", "held")
    wanted = scratch.write(of.union(asked))
    ready = _with_texts(wanted, source).select("grp", "part", "role", "node", "comp", "text")
    ready = ready.repartition("grp", "part").sortWithinPartitions("grp", "part", "role", "node")
    found = scratch.write(ready.mapInArrow(_open(k, share), "a long, b long"))
    scratch.empty(wanted)
    return found


def _need(x: Column, y: Column, share: int) -> Column:
    """Least number of prefix tokens that two sets of sizes x and y share if they link.

    Up to the lower end of both prefixes all shared tokens are counted; behind it at most the rest of one set, so
    overlap <= counted + max(x - prefix, y - prefix), and a link needs share / (100 + share) of x + y.
    """

    def behind(n: Column) -> Column:
        return F.ceil(n * share / 100) - 1

    return F.ceil((x + y) * share / (100 + share)) - F.greatest(behind(x), behind(y))


def _least_need(n: Column, low: Column, high: Column, share: int) -> Column:
    """A lower bound of ``_need`` of a set of size n over all sizes low to high, low <= high.

    Up to n the need grows with the other size, so it is least at low. Above n it falls, but its two ceilings step at
    different sizes, so an inner size may need one token less than high; more than one it cannot.
    """
    above = _need(n, high, share) - F.when((low < high) & (n < high), 1).otherwise(0)
    return F.least(_need(n, low, share), above)


#: Bits of the filter in front of a join with texts at most, as a power of two: 8 MB. Beyond about ten million nodes it lets more texts through.
BITS = 26


def _with_texts(wanted: DataFrame, source: DataFrame) -> DataFrame:
    """``wanted`` with the text of its column ``held``, the key of a row of ``source``.

    A bit map of the keys, made by the executors and no larger than ``BITS`` says, lets only texts into the shuffle that
    may be wanted. A task sends each key once; what several tasks send is passed over by the reader.
    """
    many = wanted.select(F.approx_count_distinct("held").alias("n")).first()["n"]
    size = 1 << min(BITS, max(16, (16 * many).bit_length()))
    bit = F.pmod("held", F.lit(size))
    words = wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow()  # a row for each 64 bits
    mask = np.zeros(size >> 6, np.int64)
    mask[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    shared = wanted.sparkSession.sparkContext.broadcast(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, set()
        for batch in batches:
            key = batch.column(0).to_numpy()
            at = key & (size - 1)
            pick = []
            for i in np.flatnonzero((known[at >> 6] >> (at & 63)) & 1).tolist():
                if key[i] not in seen:
                    seen.add(key[i])
                    pick.append(i)
            if len(seen) > 1_000_000:
                seen.clear()
            if pick:
                yield batch.take(pa.array(pick))

    some = source.select(F.col("key").alias("held"), "text").mapInArrow(run, "held long, text string")
    return wanted.hint("merge").join(some, "held")


def _open_lists(mixed: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """The rows of lists (token, hot, node, comp, ..) that hold more than one component, and aggregates over each list.

    A window moves each row once; the long lists of hot tokens are combined before the shuffle and joined instead, which
    may be split.
    """
    some = {"lo": F.min("comp"), "hi": F.max("comp")} | (more or {})
    by_token = Window.partitionBy("token")
    cold = mixed.where("not hot").withColumns({n: c.over(by_token) for n, c in some.items()})
    hot = mixed.where("hot")
    hot = hot.join(hot.groupBy("token").agg(*[c.alias(n) for n, c in some.items()]), "token")
    return cold.where("lo <> hi").unionByName(hot.where("lo <> hi")).drop("lo", "hi")


def _shared(mixed: DataFrame, share: int) -> DataFrame:
    """(grp, node, n, comp) for each token that a node shares with a group of another component, or of nodes alone: once
    a pair of components, the smaller one asks. Both sides read one shuffle of the lists by token."""
    both = _open_lists(mixed)
    held = both.groupBy("token", "grp", "many").agg(F.min("size").alias("g_size"), F.min("comp").alias("g_comp"), F.min("node").alias("g_first"), F.max("node").alias("g_last"), F.min("n").alias("g_least"), F.max("n").alias("g_most"))
    q = both.select("token", "node", "n", "comp", "size", F.col("many").alias("q_many"), F.col("grp").alias("q_grp"))
    larger = F.col("many") & (F.col("g_comp") != F.col("comp")) & (F.struct("g_size", "g_comp") > F.struct("size", "comp"))
    alone = ~F.col("many") & ~F.col("q_many") & (F.col("q_grp") <= F.col("grp"))
    # a holder other than the node itself, of a size that can link
    other = (F.col("g_first") != F.col("node")) | (F.col("g_last") != F.col("node"))
    fits = (F.col("g_most") * 100 >= F.col("n") * share) & (F.col("g_least") * share <= F.col("n") * 100)
    return q.join(held, "token").where((larger | alone) & other & fits).select("grp", "node", "n", "comp")


def classes(docs: DataFrame, k: int = 5, share: int = 75, block: int = 128) -> DataFrame:
    """Per document: doc_id, key (of its doc_id and text), n_shingles, label (of its component) and component_id.
    Documents link at 100 * intersection >= share * union."""
    scratch = Scratch(docs.sparkSession)

    def fits(x: Column, y: Column) -> Column:
        return (F.least(x, y) * 100) >= (F.greatest(x, y) * share)

    source = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("key", F.xxhash64("doc_id", "text"))
    summary = scratch.write(source.mapInArrow(_summary(k), "kind int, id long, n long, node long, key long"))
    sets = summary.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "node", "key")
    top = summary.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(FREQUENT).toArrow()  # bounded by FREQUENT
    known = top.column("id").to_numpy().view(np.uint64)
    order = np.argsort(known)
    common = (known[order], top.column("n").to_numpy()[order])

    by_token = Window.partitionBy("token", "salt")
    lists = source.select("text").mapInArrow(_prefixes(k, share, common), "token long, salt int, node long, n long")
    lists = (
        lists.withColumn("first", F.min(F.struct("node", "n")).over(by_token))
        .withColumn("last", F.max("node").over(by_token))
        .where("salt > 0 or first.node <> last")
        .select("token", "salt", "node", "n", F.col("first.node").alias("leader"), F.col("first.n").alias("leader_n"))
        .dropDuplicates(["token", "salt", "node"])
    )
    lists = scratch.write(lists.withColumn("hot", F.col("salt") > 0).drop("salt"))
    # nodes that share a token, each with one row's key
    listed = lists.groupBy("node").agg(F.min("leader").alias("leader"))
    firsts = sets.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min("key").alias("held"))
    base = scratch.write(firsts.hint("merge").join(listed, "node"))
    links, nodes = None, base.select("node", "n", "held", F.col("node").alias("comp"))
    mixed = None
    for again in (False, True):
        if not again:
            of = lists.withColumn("comp", F.col("node")).withColumn("leader_comp", F.col("leader"))
        else:
            lead = F.max(F.struct("size", "comp", "node", "n"))
            mixed = _open_lists(mixed, {"lead": lead}).select("token", "hot", "node", "n", "comp", F.col("lead.node").alias("leader"), F.col("lead.comp").alias("leader_comp"), F.col("lead.n").alias("leader_n"))
            before, lists = lists, scratch.write(mixed)
            scratch.empty(before)
            of = lists
        pairs = of.where((F.col("comp") != F.col("leader_comp")) & fits(F.col("n"), F.col("leader_n")))
        pairs = pairs.groupBy("leader", "node").agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("n", "leader_n", "comp", "leader_comp")])
        # these rounds may miss links, the last may not: each node asks the one leader it shares most with
        pairs = pairs.where(F.col("c") * 2 >= _need(F.col("n"), F.col("leader_n"), share)).groupBy("node").agg(F.max(F.struct("c", "leader", "comp", "leader_comp")).alias("best"))
        pairs = pairs.select(F.col("best.leader").alias("grp"), "node", "best.comp", "best.leader_comp").join(nodes.select("node", "held").hint("merge"), "node")
        pairs = scratch.write(pairs)
        leaders = pairs.select("grp", F.col("grp").alias("node"), F.col("leader_comp").alias("comp")).distinct().join(nodes.select("node", "held").hint("merge"), "node")
        more = _links(leaders, pairs.drop("leader_comp"), source, scratch, k, share)
        scratch.empty(pairs)
        links = more if links is None else links.union(more)

        labels = components(links, scratch)
        nodes = base.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node"))
        sizes = nodes.groupBy("comp").agg(F.count("*").alias("size"))
        nodes = nodes.join(sizes, "comp").withColumn("many", F.col("size") > 1).withColumn("near", F.when(F.col("many"), F.col("comp")).otherwise(F.col("leader")))
        nodes = scratch.write(nodes.select("node", "n", "held", "comp", "size", "many", "near"))
        scratch.empty(labels)
        mixed = lists.select("token", "hot", "node").join(nodes.select("node", "n", "comp", "size").hint("merge"), "node")
    # members of like sizes, so that the bound of a group is close to its members' own
    nodes = nodes.withColumn("scale", F.floor(F.log("n") * 12))
    kinds = ["near", "many", "scale"]
    blocks = nodes.groupBy(*kinds).agg(F.ceil(F.count("*") / block).alias("blocks"))
    nodes = nodes.join(blocks, kinds)
    nodes = scratch.write(nodes.select("node", "n", "held", "comp", "size", "many", F.xxhash64(*kinds, F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("grp")))

    ranges = nodes.groupBy("grp").agg(F.min("n").alias("g_min"), F.max("n").alias("g_max"))
    mixed = lists.select("token", "hot", "node").join(nodes.select("node", "n", "comp", "size", "many", "grp").hint("merge"), "node")
    shared = _shared(mixed.where("not hot"), share).union(_shared(mixed.where("hot"), share))
    shared = shared.groupBy("grp", "node").agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("comp").alias("comp")).join(ranges, "grp")
    # sizes of members that can link with the query, and the least shared prefix that leaves room for a link
    low = F.greatest(F.col("g_min"), F.ceil(F.col("n") * share / 100))
    high = F.least(F.col("g_max"), F.floor(F.col("n") * 100 / share))
    queries = shared.where((low <= high) & (F.col("c") >= _least_need(F.col("n"), low, high, share))).select("grp", "node", "comp")
    queries = scratch.write(queries.join(nodes.select("node", "held").hint("merge"), "node"))
    scratch.empty(lists)
    members = nodes.select("grp", "node", "comp", "held").join(queries.select("grp").distinct(), "grp", "left_semi")
    links = links.union(_links(members, queries, source, scratch, k, share))
    scratch.empty(queries)

    # a component is named by the smallest doc_id of its nodes; a set without shingles links with nothing and keeps its own
    final = components(links, scratch)
    least = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = scratch.write(least.hint("merge").join(final, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "least"))
    names = scratch.write(labelled.groupBy("label").agg(F.min("least").alias("name")))
    named = scratch.write(labelled.join(names, "label").select("node", "label", "name"))
    found = sets.join(named.hint("merge"), "node", "left")
    return found.select("doc_id", "key", F.col("n").alias("n_shingles"), "label", F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 5, share: int = 75, block: int = 128) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return classes(docs, k, share, block).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, k: int = 5, share: int = 75) -> DataFrame:
    """One document of each component with all its columns: of the smallest doc_id, null ids last, then of the smallest
    key. Of rows that repeat its doc_id and text one is kept. Documents without a word are components of their own:
    all of different ids or texts are kept."""
    scratch = Scratch(docs.sparkSession)
    found = classes(docs, k, share).select("doc_id", "key", "label")
    linked = found.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    kept = scratch.write(linked.select(F.col("first.key").alias("kept")).union(found.where("label is null").select("key")).groupBy("kept").agg(F.lit(1).alias("one")).select("kept"))
    many = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("kept"))
    many = scratch.write(many.join(kept, "kept", "left_semi"))
    rows_of = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("kept"))
    # few documents are repeated whole: only they are dealt out to be counted once
    once = rows_of.join(kept.join(many, "kept", "left_anti"), "kept", "left_semi")
    again = rows_of.join(many, "kept", "left_semi").dropDuplicates(["kept"])
    return once.union(again).select("row.*")
