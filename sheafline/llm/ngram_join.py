"""N-gram Jaccard join with a prefix tree, and the groups its links make.

Which sets meet. Two sets of Jaccard similarity t or more differ in at most
H = (1 - t) / (1 + t) * (sum of their sizes) n-grams. The n-grams are dealt by hash
into more than H parts, so two such sets agree in a whole part. A set writes one key
per part: the part's content. The number of parts depends on a class of sizes; a set
also writes keys for the next class if a partner may be there. Parts that are
empty agree without saying much, so there are ``spare`` parts besides; a set whose
empty parts come near that number writes keys for these too. Two linked sets then
share ``need`` keys of a class, two at least, and as many as a set's own ``least``:
the parts, less those that can differ from a partner of any size, less its empty ones.

Chance makes unlike sets share a key, often a single n-gram of a passage many texts
have. So sets are weeded before they meet: keys that one set alone has go, then the
keys of a set that has fewer than ``least`` left in a class, since no partner can be
among them; keys that are then alone go too, and so on, ``WEEDINGS`` times. What is
left are candidates: few sets with a key are paired and must share the ``least`` of
both; many sets with a key all are. Candidates that hang together form a cluster. No
pair above the threshold is lost.

In a large collection sets with common keys chain to clusters of unlike sets that
grow faster than the data. Where the blocks of large clusters would take more than all
candidates do once, the sets of these clusters are linked once more, by n-grams: two linked sets share t of the n-grams of each, so in any
one order of n-grams their first common one is among the first (1 - t) n + 1 of each. The
order is by number of sets of a class of sizes in the cluster, rarest first; n-grams that
one set has alone use up places and link nothing, and a set with too many of these goes.
This takes a row per n-gram and class of these sets, whatever the size of the cluster.
Again no pair is lost.

How they are joined. The sets of a cluster go to blocks of bounded size. In a block
all sets share one order of n-grams, most frequent first, and form a prefix tree.
One walk through the tree carries, for the path so far, its overlap with every set
of the block; sets with a common beginning share that work. A subtree is left as
soon as no set outside its own group could still reach the threshold with what is
left of both. Clusters of more than one block have some sets of theirs in every
block; then sets of a cluster that still are in different groups meet block by
block.

Texts with the same set are one class from the start. Links are not expanded: the
result is the group of each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ascii_lower, bitmap, checkpointed, lean, list_parts, may_hold, mix, with_first, word_array
from .components import components
from .substrings import _chunks, window_hashes

WORDS = 4
#: Least similarity, as a fraction of whole numbers.
THRESHOLD = (85, 100)
CLASS_RATIO = 1.25
#: A block holds about so many n-grams or texts.
BLOCK_GRAMS = 200_000
BLOCK_TEXTS = 1500
#: Texts of a large cluster that are in each of its blocks.
PIVOTS = 16
#: Sets with a key are paired up to this number.
FEW = 8
#: Times that sets without enough shared keys are left out.
WEEDINGS = 2
CLASS_BITS = 7
#: Bits of the bitmap that keeps texts outside all clusters out of the shuffle (4 MB).
FILTER_BITS = 1 << 25
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---- sets -------------------------------------------------------------------


def gram_sets(words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and hashes of each text's different n-grams; a shorter text has its whole sequence as one."""
    grams = window_hashes(words, length)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(np.arange(len(grams)) + length <= ends[: len(grams)])
    text, value = np.searchsorted(offsets, at, "right") - 1, grams[at]
    count = np.diff(offsets)
    for size in range(1, length):
        short = np.flatnonzero(count == size)
        if len(short):
            whole = window_hashes(words, size)[offsets[short]]
            text, value = np.concatenate([text, short]), np.concatenate([value, mix(whole + np.uint64(size))])
    _, first = np.unique(mix(value + text.astype(np.uint64) * _STEP), return_index=True)
    first = first[np.argsort(text[first], kind="stable")]
    text, value = text[first], value[first]
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(count)))]), value


def _segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def set_sums(grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of each set that are equal for equal sets."""
    return tuple(_segment_sums(mix(grams + np.uint64(seed)), offsets).astype(np.int64) for seed in (1, 2))


# ---- keys -------------------------------------------------------------------


class Parts:
    """Size classes, and the number of parts of each, for one threshold."""

    def __init__(self, threshold: tuple[int, int]):
        self.num, self.den = threshold
        ratio = max(CLASS_RATIO, self.den / self.num)
        self.start = [1]
        while self.start[-1] < 1 << 40:
            self.start.append(max(self.start[-1] + 1, ceil(self.start[-1] * ratio)))
        most = np.array(self.start[1:], np.int64) - 1
        differ = (self.den - self.num) * 2 * most // (self.den + self.num)
        self.spare = 2 + differ // 5
        self.need = 2 + differ // 40
        self.parts = differ + 1 + self.spare
        self.most = most
        self.start = np.array(self.start[:-1], np.int64)

    def classes(self, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sets, class of each) of every class sets of these sizes write keys for."""
        home = np.searchsorted(self.start, sizes, "right") - 1
        step = 0
        rows = np.flatnonzero(sizes > 0)
        while len(rows):
            yield rows, home[rows] + step
            step += 1
            rows = rows[sizes[rows] * self.den >= self.num * self.start[home[rows] + step]]

    def _slots(self, grams: np.ndarray, offsets: np.ndarray, rows: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each n-gram, and its part among the parts of all the sets."""
        size = offsets[rows + 1] - offsets[rows]
        parts = self.parts[kind]
        first = np.cumsum(parts) - parts
        at = np.repeat(offsets[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        spot = mix(grams[at] + np.uint64(7)) >> np.uint64(33)
        return at, np.repeat(first, size) + (spot * np.repeat(parts, size).astype(np.uint64) >> np.uint64(31)).astype(np.int64)

    def _empty(self, slot: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The number of empty parts of each set."""
        parts = self.parts[kind]
        owner = np.repeat(np.arange(len(kind)), parts)
        return np.bincount(owner[np.bincount(slot, minlength=len(owner)) == 0], minlength=len(kind))

    def least(self, grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(set, class, number of keys it shares with any linked set that meets it there), sorted by set."""
        found = [np.zeros((0, 3), np.int64)]
        for rows, kind in self.classes(np.diff(offsets)):
            _, slot = self._slots(grams, offsets, rows, kind)
            size = offsets[rows + 1] - offsets[rows]
            partner = np.minimum(size * self.den // self.num, self.most[kind])
            differ = (self.den - self.num) * (size + partner) // (self.den + self.num)
            shared = np.maximum(self.need[kind], self.parts[kind] - differ - self._empty(slot, kind))
            found.append(np.stack([rows, kind, shared], 1))
        every = np.concatenate(found)
        return tuple(every[np.argsort(every[:, 0], kind="stable")].T)

    def keys(self, grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, key) of every key of several sets."""
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for rows, kind in self.classes(np.diff(offsets)):
            owner, key = self._of_class(grams, offsets, rows, kind)
            owners.append(owner)
            found.append(key)
        return np.concatenate(owners), np.concatenate(found)

    def _of_class(self, grams, offsets, rows, kind) -> tuple[np.ndarray, np.ndarray]:
        at, slot = self._slots(grams, offsets, rows, kind)
        parts = self.parts[kind]
        total = np.zeros(parts.sum(), np.uint64)
        np.add.at(total, slot, mix(grams[at] + np.uint64(11)))
        held = np.bincount(slot, minlength=len(total))
        owner = np.repeat(np.arange(len(rows)), parts)
        number = np.arange(len(total)) - np.repeat(np.cumsum(parts) - parts, parts)
        name = mix((np.repeat(kind, parts) << 40).astype(np.uint64) + number.astype(np.uint64))
        # The last bits name the class.
        key = mix(np.where(held > 0, mix(total), np.uint64(3)) + name) << np.uint64(CLASS_BITS)
        key |= np.repeat(kind, parts).astype(np.uint64)
        # A set with fewer empty parts shares ``need`` others with any partner.
        written = (held > 0) | (self._empty(slot, kind) > self.spare[kind] + 1 - self.need[kind])[owner]
        return rows[owner[written]], key[written]


# ---- the prefix tree --------------------------------------------------------


def groups_in_block(sets: list[np.ndarray], threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """For each set the first set of its group: groups hang together by links of the threshold or more."""
    num, den = threshold
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    group = np.arange(n)
    owner = np.repeat(np.arange(n), sizes)
    values, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # One order for all sets: most frequent first. What stands in one set only adds to no overlap.
    order = np.lexsort((values, -count))
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    shared = count[code] > 1
    owner, code = owner[shared], rank[code[shared]]
    holds = np.zeros((int((count > 1).sum()), n), np.uint8)
    holds[code, owner] = 1
    ordered = np.lexsort((code, owner))
    paths = np.split(code[ordered], np.cumsum(np.bincount(owner, minlength=n))[:-1])
    length = np.array([len(p) for p in paths], np.int64)
    line = sorted(range(n), key=lambda i: paths[i].astype(">u4").tobytes())
    line_paths, line_of = [paths[i] for i in line], np.array(line)

    # (first, end, depth, overlaps): the sets from first to end share a path of that depth.
    stack = [(0, n, 0, np.zeros(n, np.int64))]
    while stack:
        lo, hi, depth, overlap = stack.pop()
        members = line_of[lo:hi]
        left = length[members].max() - depth
        reach = overlap + np.minimum(left, length - overlap)
        alive = (num + den) * reach >= num * (sizes[members].min() + sizes)
        alive[members] = True
        if (group[alive] == group[members[0]]).all():
            continue
        a, b = line_paths[lo], line_paths[hi - 1]
        end = min(len(a), len(b))
        unlike = np.flatnonzero(a[depth:end] != b[depth:end])
        reached = depth + int(unlike[0]) if len(unlike) else end
        for k in range(depth, reached, 4096):
            overlap = overlap + holds[a[k : min(k + 4096, reached)]].sum(0, dtype=np.int64)
        while lo < hi and len(line_paths[lo]) == reached:
            own = line_of[lo]
            for other in np.unique(group[(num + den) * overlap >= num * (sizes[own] + sizes)]):
                one, two = sorted((group[own], other))
                if one != two:
                    group[group == two] = one
            lo += 1
        if lo < hi:
            branch = np.array([p[reached] for p in line_paths[lo:hi]])
            cuts = [0, *(np.flatnonzero(branch[1:] != branch[:-1]) + 1), hi - lo]
            stack.extend((lo + i, lo + j, reached, overlap) for i, j in zip(cuts[:-1], cuts[1:]))
    return group


# ---- the join ---------------------------------------------------------------


def _numbered(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(doc_id, words as numbers, ...) of the lower-cased texts."""
    words = word_array(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.transform(words, lambda w: F.xxhash64(w)).alias("words"), *more)


MEASURES = "doc_id bigint, n bigint, sum_a bigint, sum_b bigint, kinds array<int>, least array<int>"


def _measure(length: int, threshold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(threshold)
        for batch in batches:
            offsets, words = list_parts(batch.column(1))
            for a, b in _chunks(offsets):
                where, grams = gram_sets(words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length)
                sums = set_sums(grams, where)
                arrays = [batch.column(0).slice(a, b - a), *map(pa.array, (np.diff(where), *sums))]
                owner, *classes = parts.least(grams, where)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))]), pa.int32())
                arrays += [pa.ListArray.from_arrays(ends, pa.array(c, pa.int32())) for c in classes]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "sum_a", "sum_b", "kinds", "least"])

    return run


def _write_keys(length: int, threshold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(threshold)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            offsets, words = list_parts(batch.column(1))
            ids = batch.column(0).to_numpy()
            for a, b in _chunks(offsets):
                where, grams = gram_sets(words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length)
                new = np.zeros(b - a, bool)
                for i, pair in enumerate(zip(*(s.tolist() for s in set_sums(grams, where)))):
                    # Of equal sets in a task one writes keys.
                    if pair not in seen:
                        seen.add(pair)
                        new[i] = True
                owner, key = parts.keys(grams, where)
                kept = new[owner]
                yield pa.RecordBatch.from_arrays([pa.array(key[kept].astype(np.int64)), pa.array(ids[a + owner[kept]])], ["key", "doc_id"])

    return run


def _with_sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, words = list_parts(batch.column(1))
            for a, b in _chunks(offsets):
                where, grams = gram_sets(words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length)
                sets = pa.ListArray.from_arrays(pa.array(where.astype(np.int32)), pa.array(grams.astype(np.int64)))
                rest = [c.slice(a, b - a) for c in batch.columns[2:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), sets, *rest], ["doc_id", "grams", "cluster", "blocks"])

    return run


def _with_grams(length: int, threshold: tuple[int, int]):
    """A row per n-gram and class of sizes; the n-grams of different clusters and classes are different numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(threshold)
        for batch in batches:
            offsets, words = list_parts(batch.column(1))
            ids, cluster = (batch.column(k).to_numpy() for k in (0, 2))
            for a, b in _chunks(offsets):
                where, grams = gram_sets(words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length)
                for rows, kind in parts.classes(np.diff(where)):
                    size = where[rows + 1] - where[rows]
                    at = np.repeat(where[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    salt = mix(mix(cluster[a + rows].astype(np.uint64)) + kind.astype(np.uint64))
                    found = mix(grams[at] + np.repeat(salt, size)).view(np.int64)
                    sizes = [pa.array(np.repeat(x, size), pa.int32()) for x in (size, kind)]
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.repeat(ids[a + rows], size)), *sizes], ["gram", "node", "n", "kind"])

    return run


def _join_block(threshold: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("doc_id", "ascending")])
        cluster, ids = table["cluster"].to_numpy(), table["doc_id"].to_numpy()
        offsets, grams = list_parts(table["grams"])
        grams = grams.view(np.uint64)
        edge = np.flatnonzero(np.diff(cluster)) + 1
        us, vs = [], []
        for a, b in zip([0, *edge], [*edge, len(cluster)]):
            group = groups_in_block([grams[offsets[i] : offsets[i + 1]] for i in range(a, b)], threshold)
            us.append(ids[a:b])
            vs.append(ids[a:b][group])
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        apart = u != v
        return pa.table({"u": pa.array(u[apart]), "v": pa.array(v[apart])})

    return run


def _taking_part(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, words, ...) of the texts in ``placed``, which has node and further columns."""
    placed = checkpointed(placed, "placed")
    taking_part = bitmap(placed.select(F.xxhash64("node").alias("key")), "key", FILTER_BITS)
    rows = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text_col).alias("text"))
    rows = rows.filter(may_hold(taking_part, F.xxhash64("node"), FILTER_BITS)).join(placed, "node")
    return _numbered(rows, "node", "text", *placed.columns[1:])


def _links_of_blocks(docs: DataFrame, placed: DataFrame, length: int, threshold: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """Edges (u, v) inside the blocks; ``placed`` says (node, cluster, blocks) of the texts that take part."""
    sets = _taking_part(docs, placed, id_col, text_col).mapInArrow(
        lean(_with_sets(length)), "doc_id bigint, grams array<bigint>, cluster bigint, blocks array<bigint>"
    )
    spread = sets.select("doc_id", "grams", "cluster", F.explode("blocks").alias("block"))
    return spread.groupBy("block").applyInArrow(_join_block(threshold), "u bigint, v bigint")


def _closer(docs: DataFrame, members: DataFrame, length: int, threshold: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """Edges (u, v) that hang together what may link in large clusters; ``members`` says (node, cluster)."""
    num, den = threshold
    grams = _taking_part(docs, members, id_col, text_col).mapInArrow(
        lean(_with_grams(length, threshold)), "gram bigint, node bigint, n int, kind int"
    )
    same = W.partitionBy("gram")
    shared = grams.withColumn("sets", F.count("*").over(same)).filter("sets > 1")
    # Sets of one node and size are taken as one here, which makes their beginning longer.
    own = W.partitionBy("node", "n", "kind")
    ranked = shared.withColumns({"held": F.count("*").over(own), "place": F.row_number().over(own.orderBy("sets", "gram"))})
    first = ranked.filter(F.expr(f"place <= held + 1 - ({num}L * n + {den - 1}) div {den}")).select("gram", "node")
    first = checkpointed(first, "first-grams")
    # Written out: the join meets two plain tables, and Spark can split the rows of a common n-gram.
    least = checkpointed(first.groupBy("gram").agg(F.min("node").alias("v")), "least")
    return first.join(least, "gram").filter("node > v").select(F.col("node").alias("u"), "v").distinct()


def _holders(keys: DataFrame, first: DataFrame, bounds: DataFrame) -> DataFrame:
    """(key, node, kind, least) of the sets that may have a partner, by keys they share.

    ``first`` names the set each text has, ``bounds`` says (node, kind, least).
    """
    kind = F.col("key").bitwiseAND(F.lit((1 << CLASS_BITS) - 1)).cast("int")

    def shared(rows: DataFrame) -> DataFrame:
        return rows.withColumn("size", F.count("*").over(W.partitionBy("key"))).filter("size > 1").drop("size")

    # Most keys stand alone and end here.
    rows = checkpointed(shared(keys), "shared")
    # Texts with equal sets are one.
    rows = rows.join(first.select("doc_id", F.col("first").alias("node")), "doc_id").select("key", "node").distinct()
    rows = rows.withColumn("kind", kind).join(bounds, ["node", "kind"])
    enough = W.partitionBy("node", "kind")
    for _ in range(WEEDINGS):
        rows = shared(rows).withColumn("held", F.count("*").over(enough)).filter("held >= least").drop("held")
        rows = checkpointed(rows, "holders")
    return rows


def _candidates(holders: DataFrame) -> DataFrame:
    """Edges (node, other) between sets that share enough keys of a class, or one key with many others."""
    same = W.partitionBy("key")
    sized = holders.withColumns({"size": F.count("*").over(same), "other": F.min("node").over(same)}).filter("size > 1")
    many = sized.filter((F.col("size") > FEW) & (F.col("node") > F.col("other"))).select("node", "other").distinct()
    # At most FEW - 1 entries.
    before = F.collect_list(F.struct("node", "least")).over(same.orderBy("node").rowsBetween(1 - FEW, -1))
    pairs = sized.filter(F.col("size") <= FEW).select("node", "kind", "least", before.alias("before"))
    pairs = pairs.select("node", "kind", "least", F.explode("before").alias("b")).select("node", F.col("b.node").alias("other"), "kind", F.greatest("least", "b.least").alias("least"))
    enough = pairs.groupBy("node", "other", "kind", "least").agg(F.count("*").alias("keys")).filter("keys >= least")
    return many.unionByName(enough.select("node", "other").distinct())


def _clusters(rooted: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, cluster, n) of every member, its smallest one among them, and (cluster, grams, blocks) of every cluster."""
    members = rooted.unionByName(rooted.select(F.col("root").alias("node"), "root").distinct())
    members = checkpointed(members.join(sizes, "node").select("node", F.col("root").alias("cluster"), "n"), "members")
    clusters = members.groupBy("cluster").agg(F.sum("n").alias("grams"), F.count("*").alias("texts"))
    need = F.ceil(F.greatest(F.col("grams") / BLOCK_GRAMS, F.col("texts") / BLOCK_TEXTS)).cast("bigint")
    return members, checkpointed(clusters.select("cluster", "grams", need.alias("blocks")), "clusters")


def _extent(clusters: DataFrame) -> tuple[int, int, int]:
    """All n-grams, the number of clusters larger than a block, and the n-grams of these times their blocks."""
    copies = F.when(F.col("blocks") > 1, F.col("grams") * F.col("blocks"))
    return tuple(x or 0 for x in clusters.agg(F.sum("grams"), F.count(copies), F.sum(copies)).first())


def jaccard_groups(
    docs: DataFrame,
    length: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Two texts link when their sets of ``length``-word shingles (lower case; a
    shorter text is one shingle) have a Jaccard similarity of at least
    ``threshold``. A null or empty text has no shingle and links with nothing; a row
    without an id takes no part and has no component; rows that repeat an id count
    as one document and are returned each; other columns are left behind; an empty
    table gives no rows.
    """
    measured = checkpointed(
        _numbered(docs, id_col, text_col).mapInArrow(lean(_measure(length, threshold)), MEASURES), "sets"
    )
    same = ["n", "sum_a", "sum_b"]
    real = measured.filter("n > 0 AND doc_id IS NOT NULL")
    first = checkpointed(with_first(real, same).select("doc_id", "n", "first").distinct(), "classes")

    keys = _numbered(docs.filter(F.col(id_col).isNotNull()), id_col, text_col)
    keys = keys.mapInArrow(lean(_write_keys(length, threshold)), "key bigint, doc_id bigint")
    each = real.join(first.filter("doc_id = first").select("doc_id", "n"), ["doc_id", "n"])
    each = each.select(F.col("doc_id").alias("node"), F.explode(F.arrays_zip("kinds", "least")).alias("c")).select("node", "c.*")
    bounds = each.withColumnRenamed("kinds", "kind").groupBy("node", "kind").agg(F.min("least").alias("least"))
    edges = _candidates(_holders(keys, first, bounds))
    candidates = components(edges.select(F.col("node").alias("u"), F.col("other").alias("v")))

    sizes = first.filter("doc_id = first").groupBy(F.col("doc_id").alias("node")).agg(F.max("n").alias("n"))
    members, clusters = _clusters(candidates, sizes)
    total, large, copies = _extent(clusters)
    # Blocks of large clusters may take as much as all sets together, not more.
    while copies > total:
        kept = members.join(clusters.filter("blocks = 1").select("cluster"), "cluster").select("node", "cluster")
        loose = members.join(clusters.filter("blocks > 1").select("cluster"), "cluster").select("node", "cluster")
        closer = components(_closer(docs, loose, length, threshold, id_col, text_col))
        kept = kept.filter("node <> cluster").select("node", F.col("cluster").alias("root"))
        members, clusters = _clusters(kept.unionByName(closer), sizes)
        before = copies
        total, large, copies = _extent(clusters)
        # Counted within smaller clusters, more n-grams stand alone: again, as long as it halves what is left.
        if 2 * copies > before:
            break
    packs = max(1, ceil(total / BLOCK_GRAMS))
    # Small clusters share blocks; the blocks of a large one are its own.
    sized = members.join(clusters.select("cluster", "blocks"), "cluster")
    small = sized.filter("blocks = 1").select(
        "node", "cluster", F.array(F.pmod(F.xxhash64("cluster"), F.lit(packs))).alias("blocks")
    )
    if not large:
        links = _links_of_blocks(docs, small, length, threshold, id_col, text_col)
    else:
        big = sized.filter("blocks > 1").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
        name = lambda *of: F.xxhash64("cluster", *of).bitwiseOR(F.lit(-(1 << 63)))
        pivot = F.row_number().over(W.partitionBy("cluster").orderBy("node"))
        pivots = big.withColumn("place", pivot).filter(F.col("place") <= PIVOTS).select("node", "place")
        each = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: name(k))
        spread = F.when(F.col("place").isNotNull(), each).otherwise(F.array(name(F.col("part"))))
        once = big.join(pivots, "node", "left").select("node", "cluster", spread.alias("blocks"))
        links = checkpointed(_links_of_blocks(docs, small.unionByName(once), length, threshold, id_col, text_col), "links")
        links = links.unionByName(_links_across(docs, big, components(links), length, threshold, id_col, text_col))
    roots = components(links).select(F.col("node").alias("first"), "root")
    by_doc = first.join(roots, "first", "left").select("doc_id", "n", F.coalesce("root", "first").alias("component"))
    by_doc = by_doc.groupBy("doc_id", "n").agg(F.min("component").alias("component"))
    return measured.join(by_doc, ["doc_id", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _links_across(docs: DataFrame, big: DataFrame, roots: DataFrame, length: int, threshold, id_col: str, text_col: str) -> DataFrame:
    """Edges between texts of a large cluster that its blocks left in different groups.

    All but the largest group of a cluster are dealt into blocks of their own, and
    each of these meets each block of the cluster: no two texts of different groups
    miss each other.
    """
    grouped = big.join(roots, "node", "left").select("node", "cluster", "n", "blocks", "part", F.coalesce("root", "node").alias("group"))
    grouped = checkpointed(grouped, "groups")
    sizes = grouped.groupBy("cluster", "group").agg(F.count("*").alias("texts"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("texts", "group")).alias("m")).select("cluster", F.col("m.group").alias("main"))
    marked = grouped.join(main, "cluster")
    others = marked.filter("group <> main")
    need = F.ceil(F.greatest(F.sum("n") / BLOCK_GRAMS, F.count("*") / BLOCK_TEXTS)).cast("bigint")
    others_blocks = others.groupBy("cluster").agg(need.alias("rows"))
    marked = marked.join(others_blocks, "cluster").withColumn("row", F.pmod(F.xxhash64("node", F.lit(2)), F.col("rows")))

    def name(row, part):
        return F.xxhash64("cluster", row, part, F.lit(3))

    counted = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    as_column = F.transform(counted("rows"), lambda r: name(r, F.col("part")))
    as_row = F.when(F.col("group") != F.col("main"), F.transform(counted("blocks"), lambda p: name(F.col("row"), p)))
    blocks = F.array_union(as_column, F.coalesce(as_row, F.array().cast("array<bigint>")))
    placed = marked.select("node", "cluster", blocks.alias("blocks"))
    return _links_of_blocks(docs, placed, length, threshold, id_col, text_col)
