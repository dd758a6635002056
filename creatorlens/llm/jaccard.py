"""N-gram Jaccard join by a prefix tree: documents whose shingle sets share 85 % of their union, and the
components that these links form.  The words of a shingle and the percentage are parameters (4 and 85 here and
by default).

A document's set holds the hashes of its distinct 4-word shingles in one global order: the more documents
share a shingle (once, twice, 4 or 16 times at least), the later it comes; among equals hashes decide.  Equal
sets are one *node*.  Two sets that link share a shingle of their first |s| - ceil(0.85 |s|) + 1 in that order
(their prefix), and the first that they share lies in the short prefix of the smaller set, of
|s| - ceil(170 |s| / 185) + 1; so a passage that many documents share seldom makes two of them meet.

1. One pass counts how often the upper 32 bits of the shingles' hashes occur.  Tasks send sorted, packed
   numbers by ranges; the counts become bit tables of bounded size, which fix the order.
2. One pass sends the prefix shingles; a partial aggregate finds those that two nodes or more share.  They
   are marked in a bit table of bounded size.
3. One pass gives each document's node, and the sets of the nodes that own a marked shingle.
4. Each node is compared with one centre, the smallest node met most often under its shingles.  This joins
   most copies of a large group in linear work; shingles whose nodes are all joined need no more.
5. Of the other shingles, one for each distinct list of nodes is kept; shingles whose nodes overlap share a group as
   long as its sets fit a block, so that each set travels there once.  A group's nodes are cut into blocks by
   length class and a hash, so that a task's sets have a bounded size, and blocks whose lengths allow a link
   meet.  There the sets form a trie; every set traverses it once, sharing the overlap of common paths, and
   leaves subtrees whose remaining lengths cannot reach the threshold, whose sets are joined with it, or that
   share an earlier shingle with it (that shingle's sets meet elsewhere).
6. The links' components are found by alternating large and small stars.

Links inside a component that is known already are not looked for, so a group of copies is never expanded
into its pairs; no link between different components is lost.  The counts steer only the order, never the
result.  Shingles and nodes are told apart by 61 and 128 bits of hashes.

Words are runs of bytes other than blank and 09-0D, A-Z lower-cased.  A text of fewer words is one shingle;
null texts and texts without words have an empty set and link with nothing.  Rows with equal ids are
documents of their own, whose component is named by the smallest id in it (null ids are passed over).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creatorlens.llm.common import free_name, mark_table, row_keys, slices, table, written
from creatorlens.llm.words import BLANKS, WordHasher, distinct, marked, mix, ngrams, segment_sums

WORDS, PERCENT = 4, 85  # of the query and by default
LEVELS = (2, 4, 16)  # documents that share a shingle at least
RANGES, COUNTED = 1 << 12, 1 << 21  # ranges of the 32-bit numbers counted apart; shingles packed at a time
LEVEL_BITS = 1 << 16, 1 << 28  # least and most bits of a level's table (8 for each number)
BLOCK_SHINGLES = 1 << 20  # sum of set sizes that a block may have, but for one set larger than that
STRIDE = 32  # shingles of a trie's edge
_words = WordHasher(BLANKS)


# ---------------------------------------------------------------- sets

def order_of(tables: list[np.ndarray]):
    """Maps hashes to their places in the global order; ``tables``: packed bits of each level."""
    def order(hashes: np.ndarray) -> np.ndarray:
        number, level = hashes >> np.uint64(32), np.zeros(len(hashes), np.uint64)
        for i, bits in enumerate(tables):
            at = number >> np.uint64(32 - (len(bits) * 8).bit_length() + 1)
            hit = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
            level += hit.astype(np.uint64) * (level == i)
        return level << np.uint64(61) | hashes >> np.uint64(3)

    return order


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes and their offsets."""
    sets, ends = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, hashes, offsets in _words.texts(column):
        own, at, _ = distinct(*ngrams(hashes, offsets, words, whole_if_shorter=True))
        sets.append(own)
        ends.append(ends[-1][-1] + at[1:])
    return np.concatenate(sets), np.concatenate(ends)


def node_ids(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set: two sums of its mixed hashes."""
    with np.errstate(over="ignore"):
        a = mix(segment_sums(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), offsets))
        b = mix(segment_sums(mix(sets + np.uint64(0x14057B7EF767814F)), offsets) + np.diff(offsets).astype(np.uint64))
    return a.view(np.int64), b.view(np.int64)


def prefix_sizes(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)


def least_overlap(x, y, percent: int = PERCENT):
    """The smallest intersection with which sets of these sizes link: 100 i >= percent (x + y - i)."""
    return -(-percent * (x + y) // (100 + percent))


def in_short_prefix(sizes: np.ndarray, some: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which of the prefixes' shingles belong to the short prefixes, too."""
    rank = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
    return rank <= np.repeat(sizes - least_overlap(sizes, sizes, percent), some)


def sorted_sets(sets: np.ndarray, offsets: np.ndarray, order) -> np.ndarray:
    out = order(sets)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        out[a:b].sort()
    return out


def _take(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def packed_numbers(docs: DataFrame, text_col: str, words: int = WORDS) -> DataFrame:
    """(range, wide, numbers, often, times): sorted numbers of a range as gaps (16 bits; or 32, if wide), and
    which of them occur several times among the documents packed together (equal sets count once)."""
    span = (1 << 32) // RANGES
    names = ["range", "wide", "numbers", "often", "times"]

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique((np.concatenate(held) >> np.uint64(32)).astype(np.uint32), return_counts=True)
        cuts = np.searchsorted(values, np.arange(RANGES + 1, dtype=np.uint64) * np.uint64(span))
        rows = []
        for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if a < b:
                own, times = values[a:b] - np.uint32(r * span), counts[a:b]
                gaps = np.diff(own, prepend=np.uint32(0))
                wide, several = bool(gaps.max() >= 1 << 16), times > 1
                rows.append((r, wide, gaps.astype(np.uint32 if wide else np.uint16).tobytes(), own[several].tobytes(),
                             np.minimum(times[several], 255).astype(np.uint8).tobytes()))
        types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                sets, offsets = shingle_sets(part.column(0), words)
                for key, a, b in zip(node_ids(sets, offsets)[0].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    if b > a and key not in seen:
                        seen.add(key)
                        held.append(sets[a:b])
                        size += b - a
                if size > COUNTED:
                    yield pack(held)
                    held, size, seen = [], 0, set()
        if held:
            yield pack(held)

    return docs.select(text_col).mapInArrow(run, "range int, wide boolean, numbers binary, often binary, times binary")


def shared_numbers(packed: DataFrame) -> DataFrame:
    """(range, numbers, levels, n0, n1, ...): the numbers that reach a level, and how many reach each.  A task
    holds the counts of one range, a million numbers at most."""
    span, counts = (1 << 32) // RANGES, [f"n{i}" for i in range(len(LEVELS))]

    def joined(values: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        value, time = np.concatenate(values), np.concatenate(times)
        order = np.argsort(value, kind="stable")
        value, time = value[order], time[order]
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        return value[first], np.minimum(np.add.reduceat(time, first), 1 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i) for i in range(5))))
        for r, own in itertools.groupby(rows, key=lambda r: r[0].as_py()):
            values, times, size = [], [], 0
            for _, wide, gaps, often, more in own:
                gaps = np.frombuffer(gaps.as_buffer(), np.uint32 if wide.as_py() else np.uint16)
                often = np.frombuffer(often.as_buffer(), np.uint32)
                values += [np.cumsum(gaps, dtype=np.uint32), often]
                times += [np.ones(len(gaps), np.int32), np.frombuffer(more.as_buffer(), np.uint8).astype(np.int32) - 1]
                size += len(gaps) + len(often)
                if size > 2 * span:
                    value, time = joined(values, times)
                    values, times, size = [value], [time], len(value)
            value, total = joined(values, times)
            numbers, total = value[total >= LEVELS[0]], total[total >= LEVELS[0]]
            levels = np.searchsorted(LEVELS, total, side="right")
            yield pa.RecordBatch.from_arrays([
                pa.array([r], pa.int32()), pa.array([numbers.astype(np.uint32).tobytes()]), pa.array([levels.astype(np.uint8).tobytes()]),
                *[pa.array([int((levels > i).sum())], pa.int64()) for i in range(len(LEVELS))]], names=["range", "numbers", "levels", *counts])

    rows = packed.repartition("range").sortWithinPartitions("range")
    return rows.mapInArrow(run, f"range int, numbers binary, levels binary, {', '.join(f'{c} long' for c in counts)}")


def level_tables(shared: DataFrame) -> list[np.ndarray]:
    """The levels' packed bit tables; each range fills its own part of them."""
    totals = shared.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(len(LEVELS))]).first()
    sizes = [min(max(LEVEL_BITS[0], 1 << (8 * n).bit_length()), LEVEL_BITS[1]) for n in totals]
    span = (1 << 32) // RANGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, numbers, levels in zip(*(batch.column(i) for i in range(3))):
                numbers, levels = np.frombuffer(numbers.as_buffer(), np.uint32), np.frombuffer(levels.as_buffer(), np.uint8)
                blobs = []
                for i, size in enumerate(sizes):
                    bits = np.zeros(size // RANGES, bool)
                    bits[numbers[levels > i] // (span // len(bits))] = True
                    blobs.append(np.packbits(bits, bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([r.as_py()] * len(sizes), pa.int32()), pa.array(range(len(sizes)), pa.int32()), pa.array(blobs)],
                                                 names=["range", "level", "bits"])

    tables = [np.zeros(size // 8, np.uint8) for size in sizes]
    found = shared.select("range", "numbers", "levels").mapInArrow(run, "range int, level int, bits binary").toArrow()  # at most the tables' bits
    for batch in found.to_batches():
        for r, i, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            part = len(tables[i]) // RANGES
            tables[i][r * part:(r + 1) * part] = np.frombuffer(bits.as_buffer(), np.uint8)
    return tables


def prefixes(docs: DataFrame, text_col: str, tables: list[np.ndarray], words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(token, a, b, short): the prefix shingles of every document's node; short is 1 in the short prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = order_of(tables)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                sets, offsets = shingle_sets(part.column(0), words)
                a, b = node_ids(sets, offsets)
                some = prefix_sizes(np.diff(offsets), percent)
                token = _take(sorted_sets(sets, offsets, order), offsets[:-1], some)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(np.repeat(a, some)), pa.array(np.repeat(b, some)),
                                                  pa.array(in_short_prefix(np.diff(offsets), some, percent).astype(np.int8))], names=["token", "a", "b", "short"])

    return docs.select(text_col).mapInArrow(run, "token long, a long, b long, short byte")


def document_sets(docs: DataFrame, id_col: str, text_col: str, tables: list[np.ndarray], marks: np.ndarray,
                  words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, k, l, n, a, b, hits, short, set) of the documents; k and l name id and text, the last three are for the
    nodes with a marked shingle in their prefix, once per node and task: the marked shingles of the prefix, how many
    of them lie in the short one, and the set, all in the global order."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = order_of(tables), set()
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                sets, offsets = shingle_sets(part.column(1), words)
                a, b = node_ids(sets, offsets)
                sizes = np.diff(offsets)
                some = prefix_sizes(sizes, percent)
                sets = sorted_sets(sets, offsets, order)
                token = _take(sets, offsets[:-1], some)
                hit = marked(marks, token)
                bounds = np.concatenate([[0], np.cumsum(some)])
                hits, short = (segment_sums(x.astype(np.int64), bounds) for x in (hit, hit & in_short_prefix(sizes, some, percent)))
                mine = np.zeros(len(sizes), bool)
                for i in np.flatnonzero(hits).tolist():
                    if (key := (int(a[i]), int(b[i]))) not in seen:  # copies within the task go no further
                        if len(seen) >= 200_000:
                            seen.clear()
                        seen.add(key)
                        mine[i] = True

                def lists(flat: np.ndarray, count: np.ndarray) -> pa.Array:
                    ends = np.concatenate([[0], np.cumsum(np.where(mine, count, 0))])
                    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)), mask=pa.array(~mine))

                empty = sizes == 0
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), part.column(3), pa.array(sizes), pa.array(a, mask=empty), pa.array(b, mask=empty),
                    lists(token[hit & np.repeat(mine, some)], hits), pa.array(short, mask=~mine), lists(_take(sets, offsets[:-1][mine], sizes[mine]), sizes)],
                    names=["id", "k", "l", "n", "a", "b", "hits", "short", "set"])

    return docs.select(id_col, text_col, *row_keys(id_col, text_col)).mapInArrow(
        run, f"id {id_type}, k long, l long, n long, a long, b long, hits array<long>, short long, set array<long>")


# ---------------------------------------------------------------- trie

class Trie:
    """Sets of ascending numbers in a tree whose edges hold ``STRIDE`` of them (a set's last edge fewer).

    ``group`` gives each set's known component.  Levels are built at once: a set's node at a level is told by
    its parent and the edge's content.
    """

    def __init__(self, sets: list[np.ndarray], group: np.ndarray, percent: int = PERCENT):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets])
        self.levels = []  # per level: edge values and offsets, parents, depth, smallest and largest set size, group
        flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        alive, parent = np.arange(len(sets)), np.zeros(len(sets), np.int64)
        depth = 0
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []  # per level: sets that end there and their nodes
        while len(alive):
            size = np.minimum(self.sizes[alive] - depth, STRIDE)
            edge = _take(flat, starts[alive] + depth, size)
            offsets = np.concatenate([[0], np.cumsum(size)])
            with np.errstate(over="ignore"):
                path = segment_sums(mix(edge.view(np.uint64) + (np.arange(len(edge)) - np.repeat(offsets[:-1], size)).astype(np.uint64)), offsets)
                path = mix(path + mix(parent.astype(np.uint64)) + size.astype(np.uint64))
            _, first, node = np.unique(path, return_index=True, return_inverse=True)
            by = np.argsort(node, kind="stable")
            cuts = np.searchsorted(node[by], np.arange(len(first)))
            own = group[alive][by]
            low, high = np.minimum.reduceat(own, cuts), np.maximum.reduceat(own, cuts)
            length = self.sizes[alive][by]
            self.levels.append((_take(edge, offsets[:-1][first], size[first]), np.concatenate([[0], np.cumsum(size[first])]), parent[first],
                                depth + size[first], np.minimum.reduceat(length, cuts), np.maximum.reduceat(length, cuts), np.where(low == high, low, -1)))
            depth += STRIDE
            done = self.sizes[alive] <= depth
            self.ends.append((alive[done], node[done]))
            alive, parent = alive[~done], node[~done]

    def links(self, probe: np.ndarray, group: int, first: int = 0) -> np.ndarray:
        """The sets of other groups that link with ``probe`` (a subtree of one group, ``group``, is not entered)
        and share nothing with it that comes before ``first``."""
        overlap, out, n = np.zeros(1, np.int64), [], len(probe)
        reached = np.ones(1, bool)
        for (edge, offsets, parent, depth, shortest, longest, own), (ends, at) in zip(self.levels, self.ends):
            nodes = np.flatnonzero(reached[parent] & ((own != group) | (own < 0)))
            size = (offsets[1:] - offsets[:-1])[nodes]
            values = _take(edge, offsets[:-1][nodes], size)
            place = np.searchsorted(probe, values)
            found = probe[np.minimum(place, n - 1)] == values
            bounds = np.concatenate([[0], np.cumsum(size)])
            here = overlap[parent[nodes]] + segment_sums(found.astype(np.int64), bounds)
            used = place[bounds[1:] - 1] + found[bounds[1:] - 1]  # of the probe, up to the edge's last value
            hope = here + np.minimum(longest[nodes] - depth[nodes], n - used)
            stay = hope >= least_overlap(n, shortest[nodes], self.percent)
            if first:
                stay &= segment_sums((found & (values < first)).astype(np.int64), bounds) == 0
            overlap = np.zeros(len(parent), np.int64)
            overlap[nodes] = here
            reached = np.zeros(len(parent), bool)
            reached[nodes[stay]] = True
            if len(ends):
                good = reached[at] & (overlap[at] >= least_overlap(n, self.sizes[ends], self.percent))
                out.append(ends[good])
            if not reached.any():
                break
        return np.concatenate(out) if out else np.empty(0, np.int64)


def forest(keys: list[tuple], sets: list[np.ndarray], labels: list[tuple], sides: list[int] | None, first: int = 0, percent: int = PERCENT) -> list[tuple]:
    """Links (key, key) that join the components among these sets; with ``sides`` only sets of side 0 are asked
    against sets of side 1.  Pairs that share a shingle before ``first`` are left to that shingle's sets."""
    names = {}
    group = np.array([names.setdefault(x, len(names)) for x in labels])
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    asked = [i for i in range(len(sets)) if sides is None or sides[i] == 0]
    told = np.array([i for i in range(len(sets)) if sides is None or sides[i] == 1], np.int64)
    if not len(asked) or not len(told) or len(names) < 2:
        return []
    trie, out = Trie([sets[i] for i in told], group[told], percent), []
    for i in asked:
        for j in told[trie.links(sets[i], group[i], first)].tolist():
            if (x := find(group[i])) != (y := find(group[j])):
                root[max(x, y)] = min(x, y)
                out.append((keys[i], keys[j]))
    return out


# ---------------------------------------------------------------- links

def star_links(nodes: DataFrame, entries: DataFrame) -> DataFrame:
    """(a, b, c, d): each node's link with its centre (c, d), if they link; ``nodes`` say the percentage."""
    centres = entries.groupBy("token").agg(F.min(F.struct("a", "b")).alias("z")).select("token", F.col("z.a").alias("c"), F.col("z.b").alias("d"))
    met = entries.join(centres, "token").filter((F.col("a") != F.col("c")) | (F.col("b") != F.col("d")))
    counted = met.groupBy("a", "b", "c", "d").agg(F.count("*").alias("times"))
    best = counted.groupBy("a", "b").agg(F.max(F.struct("times", "c", "d")).alias("best")).select("a", "b", "best.c", "best.d")
    best = written(best, "best-centres")
    own = nodes.select("a", "b", "set", "n", "percent")
    other = nodes.select(F.col("a").alias("c"), F.col("b").alias("d"), F.col("set").alias("other"), F.col("n").alias("m"))
    near = (F.least("n", "m") * 100 >= F.greatest("n", "m") * F.col("percent"))
    both = best.join(own, ["a", "b"]).join(other, ["c", "d"]).filter(near)
    shared = F.size(F.array_intersect("set", "other"))
    return both.filter(shared * (100 + F.col("percent")) >= (F.col("n") + F.col("m")) * F.col("percent")).select("a", "b", "c", "d")


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b, la, lb): each node's label: its centre's centre, its centre or itself (equal labels are joined)."""
    first = links.select("a", "b", "c", "d")
    second = links.select(F.col("a").alias("c"), F.col("b").alias("d"), F.col("c").alias("e"), F.col("d").alias("f"))
    up = first.join(second, ["c", "d"], "left")
    up = up.select("a", "b", F.coalesce("e", "c").alias("la"), F.coalesce("f", "d").alias("lb"))
    return (nodes.select("a", "b").join(up, ["a", "b"], "left")
            .select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")))


def families(sized: DataFrame) -> DataFrame:
    """``sized`` with (token, first): shingles whose nodes overlap become one group, where each set travels once.

    A shingle takes the smallest number within two steps over nodes and shingles.  A group whose sets have
    ``BLOCK_SHINGLES`` at most is named by that number, and all its pairs meet there (``first`` 0); the shingles of
    larger groups stay by themselves, and their pairs meet under the first shingle that they share."""
    group = sized.select("token", "a", "b", F.col("token").alias("g"))
    for _ in range(2):
        near = group.groupBy("a", "b").agg(F.min("g").alias("least"))
        told = group.join(near, ["a", "b"]).groupBy("token").agg(F.min("least").alias("g"))
        group = written(sized.select("token", "a", "b").join(told, "token"), "groups")
    rows = sized.join(group.select("token", "g").distinct(), "token")
    small = rows.select("g", "a", "b", "n").distinct().groupBy("g").agg(F.sum("n").alias("all")).filter(F.col("all") <= BLOCK_SHINGLES).select("g", F.lit(True).alias("small"))
    rows = rows.join(small, "g", "left").withColumn("small", F.coalesce("small", F.lit(False)))
    name = F.when(F.col("small"), F.xxhash64(F.lit("group"), "g")).otherwise(F.xxhash64(F.lit("shingle"), "token"))
    named = rows.withColumns({"first": F.when(F.col("small"), F.lit(0).cast("long")).otherwise(F.col("token")), "token": name})
    return written(named.groupBy("token", "first", "a", "b", "n", "la", "lb", "class").agg(F.max("short").alias("short")), "families")


def trie_links(nodes: DataFrame, entries: DataFrame, labels: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, c, d): links that join what the labels leave apart, found by tries of bounded blocks.

    What is used again is written first (labels, open shingles, their entries, the blocks' rows), so that no job has
    a plan that grows with the steps before it."""
    labels = written(labels, "labels")
    open_ = entries.join(labels, ["a", "b"]).groupBy("token").agg(
        F.min("la").alias("x"), F.max("la").alias("y"), F.min("lb").alias("z"), F.max("lb").alias("w"), F.count("*").alias("count"), F.max("short").alias("short"),
        F.bit_xor(F.xxhash64("a", "b")).alias("who"), F.bit_xor(F.xxhash64("b", "a")).alias("also"))
    open_ = open_.filter(((F.col("x") != F.col("y")) | (F.col("z") != F.col("w"))) & (F.col("short") == 1))
    open_ = written(open_.groupBy("who", "also", "count").agg(F.min("token").alias("token")).select("token"), "open-shingles")
    # lengths of one class differ by less than the threshold allows: a set links within its class and the next
    sized = entries.join(open_, "token").join(labels, ["a", "b"]).withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1000 / (10 * percent - 1)))).cast("int"))
    sized = families(written(sized, "open-entries"))
    blocks = (sized.groupBy("token", "class").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")))
    blocks = written(blocks, "blocks")
    around = lambda by, name: blocks.select("token", (F.col("class") - by).alias("class"), F.col("blocks").alias(name))
    sized = (sized.join(blocks, ["token", "class"]).join(around(1, "above"), ["token", "class"], "left")
             .join(around(-1, "below"), ["token", "class"], "left"))
    block = F.pmod(F.xxhash64("a", "b", F.lit(3)), F.col("blocks")).cast("int")
    task = lambda cross, low, i, j, side: F.struct(F.lit(cross).alias("cross"), low.alias("low"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    none = F.array().cast("array<struct<cross:int,low:int,i:int,j:int,side:int>>")
    same = F.flatten(F.transform(upto(F.col("blocks")), lambda t: F.when(t == F.col("block"), F.array(task(0, F.col("class"), t, t, 0))).when(
        t > F.col("block"), F.array(task(1, F.col("class"), F.col("block"), t, 0))).otherwise(F.array(task(1, F.col("class"), t, F.col("block"), 1)))))
    up = F.when(F.col("above").isNotNull(), F.transform(upto(F.col("above")), lambda t: task(2, F.col("class"), F.col("block"), t, 0))).otherwise(none)
    down = F.when(F.col("below").isNotNull(), F.transform(upto(F.col("below")), lambda t: task(2, F.col("class") - 1, t, F.col("block"), 1))).otherwise(none)
    spread = (sized.withColumn("block", block).select("token", "first", "a", "b", "la", "lb", "short", F.explode(F.concat(same, up, down)).alias("task"))
              .withColumn("key", F.xxhash64("token", "task.cross", "task.low", "task.i", "task.j")))
    spread = written(spread, "block-rows")
    # a task of one label has nothing to join, nor has one without a short prefix
    useful = (spread.groupBy("key").agg(F.min("la").alias("x"), F.max("la").alias("y"), F.min("lb").alias("z"), F.max("lb").alias("w"), F.max("short").alias("short"))
              .filter(((F.col("x") != F.col("y")) | (F.col("z") != F.col("w"))) & (F.col("short") == 1)).select("key"))
    rows = spread.join(useful, "key").join(nodes.select("a", "b", "set"), ["a", "b"]).select(
        "key", "first", F.col("task.cross").alias("cross"), F.col("task.side").alias("side"), "a", "b", "la", "lb", "set")
    rows = rows.repartition("key").sortWithinPartitions("key", "side", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield (*(c[i].as_py() for c in batch.columns[:8]), batch.column(8)[i].values.to_numpy().view(np.uint64))

        for _, own in itertools.groupby(members(), key=lambda r: r[0]):
            _, first, cross, side, a, b, la, lb, sets = zip(*own)
            found = forest(list(zip(a, b)), list(sets), list(zip(la, lb)), list(side) if cross[0] else None, first[0], percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i][j] for x in found], pa.int64()) for i in (0, 1) for j in (0, 1)], names=["a", "b", "c", "d"])

    return rows.mapInArrow(run, "a long, b long, c long, d long")


def components(links: DataFrame) -> DataFrame:
    """(a, b, ra, rb): the smallest node (ra, rb) of each linked node's component, by alternating stars.

    Each round writes the new edges to the shared folder and sums up the copy; equal sums end the search.  The
    number of rounds grows with the logarithm of the longest path.
    """
    def kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
        edges = written(edges, "edges")
        return edges, tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    point = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
    edges, before = kept(links.select(point("a", "b").alias("u"), point("c", "d").alias("v")).filter(F.col("u") != F.col("v")).distinct())
    while True:
        # large star: each node's larger neighbours meet the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()
        # small star: each node's smaller neighbours and itself meet the smallest of them (edges run from large to small)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges, after = kept(small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        if after == before:
            return edges.select("u.a", "u.b", F.col("v.a").alias("ra"), F.col("v.b").alias("rb"))
        before = after


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row's (id, k, l, n, a, b), and (a, b, least, ra, rb): the nodes with their smallest id and their component."""
    tables = level_tables(written(shared_numbers(packed_numbers(docs, text_col, words)), "shared-numbers"))
    shared = (prefixes(docs, text_col, tables, words, percent).groupBy("token")
              .agg(F.min("a").alias("x"), F.max("a").alias("y"), F.min("b").alias("z"), F.max("b").alias("w"), F.max("short").alias("short"))
              .filter(((F.col("x") != F.col("y")) | (F.col("z") != F.col("w"))) & (F.col("short") == 1)).select("token"))
    shared = written(shared, "shared-shingles")
    every = written(document_sets(docs, id_col, text_col, tables, mark_table(shared), words, percent), "document-sets")
    known = every.select("id", "k", "l", "n", "a", "b")
    nodes = written(every.filter(F.col("hits").isNotNull()).select("a", "b", "n", "hits", "short", "set").dropDuplicates(["a", "b"]), "candidate-sets")
    nodes = nodes.withColumn("percent", F.lit(percent))
    entries = nodes.select("a", "b", "n", "short", F.posexplode("hits").alias("at", "token"))
    entries = written(entries.select("a", "b", "n", "token", (F.col("at") < F.col("short")).cast("byte").alias("short")).join(shared, "token"), "entries")
    stars = written(star_links(nodes, entries), "star-links")
    links = stars.unionByName(trie_links(nodes, entries, labelled(nodes, stars), percent))
    roots = components(links)
    least = known.filter(F.col("n") > 0).groupBy("a", "b").agg(F.min("id").alias("least"))
    rooted = least.join(roots, ["a", "b"], "left").select("a", "b", "least", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
    return known, written(rooted, "roots")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row; links share ``percent`` of their shingles of ``words`` words."""
    known, rooted = _grouped(docs, id_col, text_col, words, percent)
    named = rooted.groupBy("ra", "rb").agg(F.min("least").alias("component_id"))
    return (known.join(rooted.join(named, ["ra", "rb"]).select("a", "b", "component_id"), ["a", "b"], "left")
            .select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component: that of the smallest id (null ids last; by hashes among equal ones).  Rows without
    words link with nothing and stay; of rows equal in id and text, one."""
    known, rooted = _grouped(docs, id_col, text_col, words, percent)
    place = F.struct(F.col("id").isNull().alias("late"), "id", "a", "b", "k", "l")
    first = known.filter(F.col("n") > 0).groupBy("a", "b").agg(F.min(place).alias("p"))  # copies meet here, before the join
    best = first.join(rooted, ["a", "b"]).groupBy("ra", "rb").agg(F.min("p").alias("p")).select("p.k", "p.l")
    kept = best.unionByName(known.filter(F.col("n") == 0).select("k", "l").distinct())
    k, l = row_keys(id_col, text_col)
    name = free_name(docs, "k"), free_name(docs, "l")
    rows = docs.withColumns({name[0]: k, name[1]: l})
    kept = kept.select(F.col("k").alias(name[0]), F.col("l").alias(name[1]))
    return rows.join(kept, list(name), "left_semi").dropDuplicates(list(name)).select(*docs.columns)


def op8_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
e AS (SELECT row, len(s) AS n, unnest(s) AS t FROM s),
c AS (SELECT t FROM e GROUP BY t HAVING count(*) > 1),
i AS (SELECT x.row AS p, y.row AS q, x.n AS n, y.n AS m, count(*) AS i FROM e x JOIN c USING (t) JOIN e y ON x.t = y.t AND x.row <> y.row
      AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY ALL),
l AS (SELECT p, q FROM i WHERE 100 * i >= 85 * (n + m - i)),
r AS (SELECT row AS root, row AS node FROM s UNION SELECT r.root, l.q FROM r JOIN l ON r.node = l.p),
k AS (SELECT root, min(doc_id) AS component_id FROM r JOIN s ON s.row = r.node GROUP BY root)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN k ON k.root = s.row
"""
