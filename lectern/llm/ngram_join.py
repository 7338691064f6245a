"""N-gram Jaccard join by prefix trees.

A document is the set of its n-word shingles, as 62-bit numbers in one global order.  Two sets that
are similar enough share one of the first elements of that order (the prefix), so only sets that are
connected by shared prefix elements, and near enough in size, are ever brought together.  The order puts rare shingles first:
those in a lower part of the range of hashes (see SAMPLE) by the number of documents that hold them, then other
ones, then those that a large share of all documents hold.  A set that holds more shingles of its
own among the sampled ones than a similar set may lack has no partner and goes no further.

Sizes are cut into bands, so wide that similar sets are in the same band or in neighbouring ones; a
cell holds two neighbouring bands.  A block, the sets of one cell that are connected, is joined in a trie of the whole sets: sets that begin alike share a path,
the overlap with a query is counted once for all sets below a node, and a subtree is left as soon as
the elements that remain cannot bring the overlap to the least that its sets need, or all its sets
are known to be linked with the query already.

Blocks of more than BLOCK sets, or BLOCK_ELEMENTS elements, are reduced first: every set is compared with one leading set of its
block, by a join, and only those not linked with it are compared, in square cells of bounded size,
with all others.  A set goes to as many cells as its block has parts; the cells are dealt to rounds, so
that about as many elements as all sets have are on disk for them at once.  Sets that are identical are one set throughout; the copies are rows of the
membership alone.  Linked sets become classes by distributed connected components.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import components, discard, free_names, in_arrow, join_spread, slices, written

#: A shingle counts as common when it makes up more than this share of all shingles; so there are at most 1 / COMMON of them.
COMMON = 2.0**-18
#: Share of all hashes whose shingles are counted over all documents to order them by rarity, as a
#: multiple of the share of a set that a similar one may lack: above 1, else no set can be left out.
SAMPLE = 4 / 3
#: Shingles whose common ones are counted together in a task.
COUNTED = 1 << 22
#: Sets of a block, and of one side of a cell; elements of these, over all their sets.
BLOCK, CELL = 2000, 1000
BLOCK_ELEMENTS, CELL_ELEMENTS = 1 << 22, 1 << 21
#: Distinct words whose hashes a worker keeps.
WORDS = 400_000

_LOW = np.uint64((1 << 62) - 1)
#: Bits of a set's size, at most, where sizes are packed.
_BITS = 26
_COMMON_BIT = np.int64(1 << 62)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words, made as they are met."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


class Shingler:
    """Whole texts to sorted arrays of distinct shingles."""

    def __init__(self, n: int, seed: int, common: np.ndarray | None = None) -> None:
        self.n, self.seed, self.common, self.table = n, seed, common, _Words(seed)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sets of these texts: words are runs of characters other than space and \\t to \\r, A-Z in lower case."""
        n, table = self.n, self.table
        if len(table) > WORDS:
            table.clear()
        split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
        ends = np.cumsum([0, *map(len, split)])
        h = np.fromiter(map(table.__getitem__, chain.from_iterable(split)), np.uint64, int(ends[-1]))
        m = max(0, len(h) - n + 1)
        x = h[:m] * _ODD[0]  # of all places at once; those across two texts are never taken
        for k in range(1, n):
            x = _mix(x + h[k : m + k] * _ODD[k % len(_ODD)])
        x = (_mix(x) & _LOW).astype(np.int64)
        out = []
        for words, a, b in zip(split, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a >= n:
                own = np.sort(x[a : b - n + 1])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif words:  # all words as one shingle, told apart from longer ones by its seed
                own = np.array([xxhash.xxh3_64_intdigest(b" ".join(words), self.seed + 1) & int(_LOW)], np.int64)
            else:
                own = x[:0]
            out.append(own)
        return [self._ordered(own) for own in out] if self.common is not None and len(self.common) else out

    def _ordered(self, x: np.ndarray) -> np.ndarray:
        """Common shingles get a leading bit and so come last."""
        at = np.minimum(np.searchsorted(self.common, x), len(self.common) - 1)
        found = self.common[at] == x
        return np.concatenate([x[~found], x[found] | _COMMON_BIT]) if found.any() else x


def _identity(x: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit numbers that name a set."""
    raw = x.tobytes()
    return xxhash.xxh3_64_intdigest(raw, 1) - (1 << 63), xxhash.xxh64_intdigest(raw, 2) - (1 << 63)


def _often(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The values that ``x`` holds more than ``least`` times, and how often; ``x`` is sorted in place, nothing of its size copied."""
    x.sort()
    k = int(least)
    values = np.unique(x[k:][x[k:] == x[: len(x) - k]])
    return values, np.searchsorted(x, values, "right") - np.searchsorted(x, values, "left")


def _signatures(docs: DataFrame, n: int, seed: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The table written, every row's set by name, and the common shingles.

    The table has a row per document (doc_id, sid, check, size, hash of the text) and, with a null sid, rows of
    shingles that are common within some COUNTED ones and their counts there.
    """
    kind = "string" if docs.schema["doc_id"].dataType.simpleString() == "string" else "bigint"
    schema = T.StructType.fromDDL(f"doc_id {kind}, sid bigint, chk bigint, size bigint, shingle bigint, text_hash bigint")
    arrow = pa.schema([("doc_id", pa.string() if kind == "string" else pa.int64()), ("sid", pa.int64()), ("chk", pa.int64()), ("size", pa.int64()), ("shingle", pa.int64()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, count = Shingler(n, seed), np.empty(COUNTED, np.int64), 0

        def common(shingles: np.ndarray) -> pa.RecordBatch:
            values, times = _often(shingles, max(1.0, COMMON * len(shingles) / 2))
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays([pa.nulls(len(values), arrow.field(0).type), none, none, pa.array(times, pa.int64()), pa.array(values, pa.int64()), none], schema=arrow)

        for part in slices(batches):
            sets = shingler(part.column(1).to_pylist())
            names = [_identity(x) for x in sets]
            sizes = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow.field(0).type), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(sets), pa.int64()), part.column(2)], schema=arrow)
            for x in sets:
                if count + len(x) > COUNTED:
                    yield common(held[:count])
                    count = 0
                if len(x) <= COUNTED:  # a set by itself has no shingle twice
                    held[count : count + len(x)] = x
                    count += len(x)
        if count:
            yield common(held[:count])

    table = written(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).transform(in_arrow, run, schema), "signatures")
    rows = table.where("sid IS NOT NULL").select("doc_id", "sid", "chk", "size", "text_hash")
    total = rows.agg(F.sum("size")).first()[0] or 0
    often = table.where("sid IS NULL").groupBy("shingle").agg(F.sum("size").alias("n")).where(F.col("n") > max(1.0, COMMON * total))
    # At most 1 / COMMON rows: each stands for more than that share of the total.
    common = np.array([r[0] for r in often.select("shingle").collect()], np.int64)
    return table, rows, np.sort(common)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))


def sample_border(percent: int) -> int:
    """Shingles below it are sampled."""
    return int(min(1.0, SAMPLE * (100 - percent) / 100) * 2.0**62)


def bands(percent: int) -> list[int]:
    """Where each band of sizes starts: a set similar to one of band b is in band b - 1, b or b + 1."""
    starts = [1]
    while starts[-1] < 1 << _BITS:
        starts.append(100 * starts[-1] // percent + 1)
    return starts


def _heads(docs: DataFrame, shingler, percent: int) -> DataFrame:
    """(sid, facts, rare, common) of every row's set.

    ``rare`` holds its sampled elements, or as many as the prefix needs; ``common`` the common ones
    that the prefix takes when there are too few others.  ``facts`` packs the band of its size, the
    number of sampled elements and the length of the prefix.
    """
    border = np.int64(sample_border(percent))
    starts = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shingler()
        for part in slices(batches):
            sets = [x for x in s(part.column(0).to_pylist()) if len(x)]
            names = [_identity(np.sort(x & np.int64(_LOW)))[0] for x in sets]
            facts, rare, common = [], [], []
            for x in sets:
                prefix = len(x) - -(-percent * len(x) // 100) + 1
                sampled, ordinary = np.searchsorted(x, [border, _COMMON_BIT]).tolist()
                facts.append((bisect_right(starts, len(x)) - 1) << 2 * _BITS | sampled << _BITS | prefix)
                rare.append(x[: max(sampled, min(prefix, ordinary))])
                common.append(x[ordinary : max(prefix, ordinary)])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(facts, pa.int64()), _lists(rare), _lists(common)], names=["sid", "facts", "rare", "common"])

    return docs.select("text").transform(in_arrow, run, "sid bigint, facts bigint, rare array<bigint>, common array<bigint>")


def _prefixes(heads: DataFrame, percent: int) -> DataFrame:
    """(sid, band, element): the elements of each set's prefix that another set may share.

    The number of documents that hold an element is counted where its rows meet; that never is a
    large share of all rows, since common elements take no part in it.
    """
    border = sample_border(percent)
    held = Window.partitionBy("element")
    each = heads.select("sid", "facts", F.explode("rare").alias("element"))
    each = each.select("sid", "facts", "element", F.count("*").over(held).alias("df"), F.min("sid").over(held).alias("a"), F.max("sid").over(held).alias("b")).where("a != b")
    rows = each.select("sid", "facts", "df", "element").union(heads.select("sid", "facts", F.lit(1 << 62).alias("df"), F.explode("common").alias("element")))
    sets = rows.groupBy("sid", "facts").agg(F.sort_array(F.collect_set(F.struct("df", "element"))).alias("shared"))
    ones = F.lit((1 << _BITS) - 1)
    sampled, prefix = F.shiftright("facts", _BITS).bitwiseAND(ones), F.col("facts").bitwiseAND(ones)
    alone = sampled - F.size(F.filter("shared", lambda e: e["element"] < border))
    left = F.when(sampled >= prefix, prefix - alone).otherwise(F.size("shared"))
    first = F.slice("shared", F.lit(1), F.col("left"))
    kept = sets.select("sid", F.shiftright("facts", 2 * _BITS).cast("int").alias("band"), left.cast("int").alias("left"), "shared").where("left > 0")
    return kept.select("sid", "band", F.explode(first).alias("e")).select("sid", "band", "e.element")


def _sets(texts: DataFrame, shingler) -> DataFrame:
    """(sid, blocks, elements) of ``texts`` (sid, blocks, text); rows whose text is not that of the set go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shingler()
        for part in slices(batches):
            sets = s(part.column(2).to_pylist())
            own = [_identity(np.sort(x & np.int64(_LOW)))[0] == sid for x, sid in zip(sets, part.column(0).to_pylist(), strict=True)]
            part = part.filter(pa.array(own, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*part.columns[:2], _lists([x for x, o in zip(sets, own, strict=True) if o])], names=["sid", "blocks", "elements"])

    return texts.select("sid", "blocks", "text").transform(in_arrow, run, f"sid bigint, blocks {texts.schema['blocks'].dataType.simpleString()}, elements array<bigint>")


class _Node:
    __slots__ = ("edge", "kids", "least", "most", "member", "one")

    def __init__(self, edge: np.ndarray, size: int, member: int | None = None) -> None:
        self.edge, self.kids, self.least, self.most, self.member = edge, {}, size, size, member
        self.one = member  # a member if all sets below are known to be linked, else None


class Trie:
    """A radix trie of sorted sets that finds, and links, the sets similar to a new one.

    ``doors`` names, for each element, the subtrees of the root with a set that has it in its
    prefix; a similar set shares an element of its own prefix with it, so no other needs a visit.
    """

    def __init__(self, percent: int) -> None:
        self.percent, self.root, self.parent = percent, _Node(np.empty(0, np.int64), 1 << 62), {}
        self.root.most = 0
        self.links: list[tuple[int, int]] = []
        self.doors: dict[int, set[int]] = {}

    def prefix(self, x: np.ndarray) -> list[int]:
        return x[: len(x) - -(-self.percent * len(x) // 100) + 1].tolist()

    def find(self, x: int) -> int:
        up = self.parent.setdefault(x, x)
        while up != self.parent[up]:
            self.parent[up] = self.parent[self.parent[up]]
            up = self.parent[up]
        self.parent[x] = up
        return up

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def _known(self, node: _Node, own: int) -> bool:
        return node.one is not None and self.find(node.one) == own

    def add(self, key: int, x: np.ndarray) -> None:
        """Links ``key`` with every class that holds a similar set, then stores it."""
        self.find(key)
        self._search(key, x)
        self._insert(key, x)

    def _search(self, key: int, x: np.ndarray) -> None:
        n, percent = len(x), self.percent
        # Overlap that a set of size m needs: 100 i >= percent (n + m - i).
        need = lambda m: -(-percent * (n + m) // (100 + percent))
        low, high = -(-percent * n // 100), 100 * n // percent
        doors = set().union(*[self.doors[e] for e in self.prefix(x) if e in self.doors])
        todo = [(self.root.kids[k], 0, 0, 0) for k in doors]
        while todo:
            node, overlap, depth, at = todo.pop()
            if node.most < low or node.least > high or self._known(node, self.find(key)):
                continue
            least = need(max(node.least, low))
            edge = node.edge
            # A first look without counting: all of this edge and what follows, at best.
            if overlap + min(n - at, node.most - depth) < least:
                continue
            where = np.searchsorted(x, edge)
            hit = x[np.minimum(where, n - 1)] == edge
            overlap += int(hit.sum())
            depth += len(edge)
            at = int(where[-1]) + int(hit[-1])
            if overlap + min(n - at, node.most - depth) < least:
                continue
            if node.member is not None and overlap >= need(depth) and self.join(key, node.member):
                self.links.append((key, node.member))
            todo += [(k, overlap, depth, at) for k in node.kids.values()]

    def _insert(self, key: int, x: np.ndarray) -> None:
        node, at, n = self.root, 0, len(x)
        for e in self.prefix(x):
            self.doors.setdefault(e, set()).add(int(x[0]))
        while True:
            node.least, node.most = min(node.least, n), max(node.most, n)
            if node is not self.root and node.one is not None and self.find(node.one) != self.find(key):
                node.one = None
            if at == n:
                if node.member is None:
                    node.member = key
                else:
                    self.join(key, node.member)
                return
            kid = node.kids.get(int(x[at]))
            if kid is None:
                node.kids[int(x[at])] = _Node(x[at:], n, key)
                return
            k = min(len(kid.edge), n - at)
            differ = np.flatnonzero(kid.edge[:k] != x[at : at + k])
            same = int(differ[0]) if len(differ) else k
            if same < len(kid.edge):  # the edge is cut where the new set leaves it
                upper = _Node(kid.edge[:same], n)
                upper.least, upper.most, upper.one, upper.member = kid.least, kid.most, kid.one, None
                kid.edge = kid.edge[same:]
                upper.kids[int(kid.edge[0])] = kid
                node.kids[int(x[at])] = upper
                kid = upper
            node, at = kid, at + same


def join_sets(keys: list[int], sets: list[np.ndarray], percent: int, linked: list[bool] | None = None) -> list[tuple[int, int]]:
    """Pairs that span the classes of the similar ones among ``sets``; those ``linked`` are one class from the start.

    The elements are put into an order of their own: the fewer of these sets hold one, the earlier
    it comes.  A set with more elements that no other holds than a similar set may lack is left out.
    """
    if len(keys) < 2:
        return []
    _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(held), np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(len(held))
    alone = int((held == 1).sum())
    place = rank[place]
    ends = np.cumsum([0, *map(len, sets)]).tolist()
    trie, lead = Trie(percent), None
    order = sorted(range(len(keys)), key=lambda k: not (linked and linked[k]))
    for k in order:
        x = np.sort(place[ends[k] : ends[k + 1]])
        if linked and linked[k]:  # these need no search among themselves
            lead = keys[k] if lead is None else lead
            trie.join(keys[k], lead)
        if int(np.searchsorted(x, alone)) > len(x) - -(-percent * len(x) // 100):
            continue
        if linked and linked[k]:
            trie.find(keys[k])
            trie._insert(keys[k], x)
        else:
            trie.add(keys[k], x)
    return trie.links


def _cells(rows: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) within the cells of ``rows`` (block, ci, cj, sid, linked, elements), one trie a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, sets, linked = None, [], [], []

        def flush() -> pa.RecordBatch:
            links = join_sets(keys, sets, percent, linked)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["u", "v"])

        for batch in batches:
            cells = list(zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True))
            values = batch.column(5)
            ends, flat = values.offsets.to_numpy(), values.values.to_numpy()
            for k, (block, ci, cj, sid, known) in enumerate(cells):
                if (block, ci, cj) != now:
                    if len(keys) > 1:
                        yield flush()
                    now, keys, sets, linked = (block, ci, cj), [], [], []
                keys.append(sid)
                sets.append(flat[ends[k] : ends[k + 1]].copy())
                linked.append(known)
        if len(keys) > 1:
            yield flush()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = rows.select("block", "ci", "cj", "sid", "linked", "elements").repartition(parts, "block", "ci", "cj").sortWithinPartitions("block", "ci", "cj", "sid")
    return cells.transform(in_arrow, run, "u bigint, v bigint")


def _block_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) among ``sets`` (sid, block, elements, members, lead): block by block; ``read_from`` names the tables they stand in."""
    none = F.lit(0)
    held = sets.groupBy("block").agg(F.sum(F.size("elements")).alias("held"), F.count("*").alias("n"))
    big = written(held.where((F.col("held") > BLOCK_ELEMENTS) | (F.col("n") > BLOCK)).select("block", "n"), "big")
    total, volume = sets.agg(F.count("*"), F.sum(F.size("elements"))).first()
    if big.isEmpty():
        links = _cells(sets.select("block", none.alias("ci"), none.alias("cj"), "sid", F.lit(False).alias("linked"), "elements"), percent)
        links.read_from = [big]
        return links
    small = sets.join(big, "block", "left_anti").select("block", none.alias("ci"), none.alias("cj"), "sid", F.lit(False).alias("linked"), "elements")
    tables = [written(_cells(small, percent), "links")]
    leads = written(sets.where("sid = lead").select("block", F.col("elements").alias("lead_elements")).join(big, "block"), "leads")
    both = F.size(F.array_intersect("elements", "lead_elements"))
    near = 100 * both >= percent * (F.size("elements") + F.size("lead_elements") - both)
    large = join_spread(sets.drop("members"), leads, ["block"], total, ["sid"])
    marked = written(large.select("block", "sid", "lead", "elements", near.alias("linked")), "led")
    tables.append(written(marked.where("linked AND sid != lead").select(F.col("sid").alias("u"), F.col("lead").alias("v")), "links"))
    # How many parts each kind is dealt to: by its sets and by their elements.
    own_elements = lambda own: F.sum(F.when(own, F.size("elements")).otherwise(0))
    parts = lambda own: F.ceil(F.greatest(F.count_if(own) / CELL, own_elements(own) / CELL_ELEMENTS)).cast("int")
    linked = F.col("linked")
    facts = marked.groupBy("block").agg(parts(~linked).alias("gr"), parts(linked).alias("gk"), own_elements(~linked).alias("er"), own_elements(linked).alias("ek"), F.count("*").alias("n")).where("gr > 0")
    rest = written(facts, "rest")
    rounds = -(-(rest.agg(F.sum(F.expr("er * (gr + gk) + ek * gr"))).first()[0] or 0) // max(volume, 1))
    gr, gk = F.col("gr"), F.col("gk")
    dealt = join_spread(marked, rest.drop("er", "ek"), ["block"], total, ["sid"]).withColumn("sub", F.pmod(F.xxhash64("sid"), F.when(linked, gk).otherwise(gr)).cast("int"))
    dealt = written(dealt, "dealt")
    discard(big, leads, marked, rest)
    others = F.sequence(F.lit(0), gr - 1)
    # A row that is not linked meets all others of its kind and all linked ones; cells (i, j) with j from gr on hold the latter.
    own = F.concat(
        F.transform(others, lambda i: F.struct(F.least("sub", i).alias("ci"), F.greatest("sub", i).alias("cj"))),
        F.transform(F.when(gk > 0, F.sequence(gr, gr + gk - 1)).otherwise(F.array().cast("array<int>")), lambda j: F.struct(F.col("sub").alias("ci"), j.alias("cj"))),
    )
    of_linked = F.transform(others, lambda i: F.struct(i.alias("ci"), (F.col("sub") + gr).cast("int").alias("cj")))
    for k in range(rounds):
        now = F.filter(F.when(linked, of_linked).otherwise(own), lambda c: F.pmod(F.xxhash64("block", c["ci"], c["cj"]), F.lit(rounds)) == k)  # noqa: B023
        cells = dealt.select("block", "sid", "linked", "elements", F.explode(now).alias("c"))
        tables.append(written(_cells(cells.select("block", "c.ci", "c.cj", "sid", "linked", "elements"), percent), "links"))
    discard(dealt)
    links = reduce(DataFrame.union, tables)
    links.read_from = tables
    return links


def near_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents linked by similar shingle sets.

    ``docs`` has doc_id and text; other columns are not read.  A document's set is that of its
    distinct ``n``-word shingles, with fewer words all of them as one.  Two sets are linked when
    100 * intersection >= percent * union.  Returns a row per row: doc_id, n_shingles, component_id
    (least doc_id that links reach).  A document without words or text (null) has no shingles, is
    linked with nothing and is its own class.  A row with a null doc_id has the class of the rows with
    the same set, null where there are none; it links nothing by itself.  Repeated rows are copies of
    one another.  An empty table gives no rows.

    Shingles are 62-bit hashes and sets are named by 64-bit ones; should two different sets ever
    get one name, that is noticed and all is done again with other seeds.
    """
    return _classes(docs, n, percent).drop("text_hash")


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``near_classes`` with the hash of each row's text.  Tables go as soon as what is read from them is written."""
    for seed in range(0, 50, 10):
        signatures, rows, common = _signatures(docs, n, seed)
        sets = written(rows.where("size > 0").groupBy("sid").agg(F.min("doc_id").alias("least"), F.min("chk").alias("a"), F.max("chk").alias("b"), F.count("*").alias("n")), "sets")
        if sets.where("a != b").isEmpty():
            break
        discard(signatures, sets)
    else:
        raise RuntimeError("names of sets collide")
    held = docs.sparkSession.sparkContext.broadcast(common)  # bounded by COMMON
    shingler = lambda: Shingler(n, seed, held.value)
    total = lambda table: table.agg(F.sum("n")).first()[0] or 0

    heads = written(_heads(docs, shingler, percent), "heads")
    prefixes = written(_prefixes(heads, percent), "prefixes")
    discard(heads)
    each = prefixes.select("sid", "element", F.explode(F.array("band", F.col("band") - 1)).alias("cell"))
    shared = each.groupBy("element", "cell").agg(F.min("sid").alias("first"), F.max("sid").alias("last"), F.count("*").alias("held")).where("first != last")
    shared = written(shared.select("element", "cell", "first", "held", F.col("held").alias("n")), "shared")
    stars = written(join_spread(each, shared, ["element", "cell"], total(shared), ["sid"]).groupBy("sid", "cell", "first").agg(F.sum("held").alias("weight")), "stars")
    discard(prefixes, shared)
    node = lambda c: F.xxhash64(c, "cell")  # noqa: E731  should two nodes get one number, their blocks are one
    blocks = components(stars.select(node("sid").alias("u"), node("first").alias("v")))
    weight = stars.groupBy("sid", "cell").agg(F.sum("weight").alias("weight")).withColumn("node", node("sid"))
    members = written(blocks.join(weight, "node").select("sid", F.col("label").alias("block"), "weight"), "members")
    counts = written(members.groupBy("block").agg(F.count("*").alias("members"), F.max_by("sid", F.struct("weight", "sid")).alias("lead"), F.count("*").alias("n")), "counts")

    of_set = join_spread(members, counts, ["block"], total(counts), ["sid"]).groupBy("sid").agg(F.collect_list(F.struct("block", "members", "lead")).alias("blocks"))  # two at most
    wanted = of_set.join(sets, "sid").select("sid", "blocks", F.col("least").alias("doc_id"))
    elements = written(_sets(docs.select("doc_id", "text").join(wanted, "doc_id"), shingler), "elements")
    discard(stars, members, counts)
    found = elements.select("sid", F.explode("blocks").alias("b"), "elements").select("sid", "b.*", "elements")
    each = _block_links(found, percent)
    links = written(each, "links")
    discard(elements, *each.read_from)

    labels = components(links)
    class_of = labels.join(sets, F.col("node") == F.col("sid")).select("sid", "label", "least")
    least = class_of.groupBy("label").agg(F.min("least").alias("component"))
    class_of = class_of.join(least, "label").select("sid", "component")
    named = written(sets.join(class_of, "sid", "left").select("sid", F.coalesce("component", "least").alias("component"), "n"), "named")
    discard(sets, links)
    whole = join_spread(rows.where("size > 0"), named, ["sid"], total(named), ["doc_id", "text_hash"])
    own = ["doc_id", F.col("size").alias("n_shingles")]
    classes = whole.select(*own, "component", "text_hash").union(rows.where("size = 0").select(*own, "doc_id", "text_hash")).withColumnRenamed("component", "component_id")
    classes.read_from = [signatures, named]
    return classes


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, one row of each class of near duplicates (the one of least doc_id).

    Rows without words stay, and so do rows with a null doc_id.  Of rows that share a doc_id only those
    go whose own text is near another's.
    """
    classes = _classes(docs, n, percent)
    own = free_names(docs, "__hash")[0]
    gone = written(classes.where("doc_id != component_id").select("doc_id", F.col("text_hash").alias(own)).distinct(), "gone")
    discard(*classes.read_from)
    named = docs.withColumn(own, F.xxhash64("text"))
    return named.join(gone, ["doc_id", own], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
