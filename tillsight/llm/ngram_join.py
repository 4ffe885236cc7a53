"""Documents whose sets of word n-grams overlap, by a prefix-tree join.

The n-grams have one order for all sets: rare ones first. Sets that overlap
enough share one of their first n-grams, so only sets that do are brought
together. There a trie of the sets, all written in that order, is walked for
one set at a time: the overlap so far is shared by all sets below a node, and a
subtree is left out as soon as what remains cannot make up the overlap needed.

Documents of equal sets are one node throughout. An n-gram of a single node
overlaps with nothing and is only counted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.components import components
from tillsight.llm.texts import (
    ascii_lower,
    hash_buckets,
    mixed,
    pieces,
    text_buffer,
    whole_windows,
    window_hashes,
    word_hashes,
    word_spans,
)
from tillsight.workspace import cut_lineage, discard, stored

SHINGLE = 5
#: Least size of the intersection in percent of the union.
PERCENT = 75
#: Sets in one trie, at most about; larger families are cut into blocks.
BLOCK_SETS = 2_000
#: Rows of sets that one task joins, about.
GROUP_SETS = 4_000

#: Sets that ask a trie in one walk at most, and bytes of what is held of them, about.
_MOST_ASKING = 512
_ASKING_BYTES = 32 << 20

_REMAINDER = np.uint64(1 << 40)


def _in_order(numbers: np.ndarray, below: int) -> np.ndarray:
    """A stable order of numbers less than ``below``; numpy counts those of 16 bits instead of comparing them."""
    return np.argsort(numbers.astype(np.uint16) if below <= 1 << 16 else numbers, kind="stable")


def _sets(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in a row, where texts begin, and a hash of each set."""
    data, bounds = text_buffer(piece.column("text"))
    data = ascii_lower(data)
    starts, ends, first = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    row_of_word = np.repeat(np.arange(piece.num_rows), np.diff(first))
    at = whole_windows(first, SHINGLE)
    grams = mixed(window_hashes(words, SHINGLE))[at]
    rows = row_of_word[at]
    lengths = np.diff(first)
    for size in range(1, SHINGLE):  # shorter texts are one shingle
        short = np.flatnonzero(lengths == size)
        if len(short):
            whole = mixed(window_hashes(words, size) ^ np.uint64(size))
            grams = np.concatenate([grams, whole[first[short]]])
            rows = np.concatenate([rows, short])
    order = np.argsort(grams)
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    again = order[np.union1d(again, again + 1)]  # the few that occur twice, in one text or several
    again = again[np.lexsort((grams[again], rows[again]))]
    repeated = (grams[again[1:]] == grams[again[:-1]]) & (rows[again[1:]] == rows[again[:-1]])
    new = np.ones(len(rows), dtype=bool)
    new[again[1:][repeated]] = False
    grams, rows = grams[new], rows[new]
    order = _in_order(rows, piece.num_rows)
    grams, rows = grams[order], rows[order]
    begins = np.searchsorted(rows, np.arange(piece.num_rows + 1))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(grams * np.uint64(0x9FB21C651E98DF25)), dtype=np.uint64)])
    sizes = np.diff(begins).astype(np.uint64)
    nodes = mixed((sums[begins[1:]] - sums[begins[:-1]]) ^ mixed(sizes))
    return grams, begins, nodes.astype(np.int64)


#: What pieces deal over buckets, and what comes of it: ``docs`` has rows of its own.
_DEALT = "bucket int, low binary, high binary, nodes binary, counts binary, docs binary"
_SHARED = "bucket int, group int, low binary, high binary, times binary, nodes binary, counts binary, docs binary"


def _ask(buckets: int):
    """The shingles of each node dealt over buckets, 40 bits of each; a node once per piece.

    Which node each document is goes along packed, so texts are read once.
    """

    def run(batches):
        for piece in pieces(batches):
            grams, begins, nodes = _sets(piece)
            sizes = np.diff(begins)
            ids = piece.column("doc_id")
            docs = np.concatenate([pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), sizes, nodes]).astype(np.int64)
            known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
            rows = [{
                "bucket": int(np.bitwise_xor.reduce(nodes) % buckets), "docs": docs.tobytes() + known.tobytes()
            }]
            _, once = np.unique(nodes, return_index=True)
            once = np.sort(once[sizes[once] > 0])
            keep = np.zeros(len(sizes), dtype=bool)
            keep[once] = True
            row = np.repeat(np.arange(len(sizes)), sizes)
            grams, row = grams[keep[row]], row[keep[row]]
            bucket = (grams % np.uint64(buckets)).astype(np.int64)
            rest = grams // np.uint64(buckets) % _REMAINDER
            order = _in_order(bucket, buckets)
            bucket, rest, row = bucket[order], rest[order], row[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            for number in np.flatnonzero(np.diff(edges)).tolist():
                part = slice(edges[number], edges[number + 1])
                mine, counts = np.unique(row[part], return_counts=True)
                rows.append({
                    "bucket": number, "low": rest[part].astype(np.uint32).tobytes(),
                    "high": (rest[part] >> np.uint64(32)).astype(np.uint8).tobytes(),
                    "nodes": nodes[mine].tobytes(), "counts": counts.astype(np.int32).tobytes(),
                })
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("bucket", pa.int32()), *((n, pa.binary()) for n in ("low", "high", "nodes", "counts", "docs"))]
            ))

    return run


def _documents(batches):
    """Which node each document is, unpacked; none if it has no words."""
    for batch in batches:
        for packed in batch.column("docs").to_pylist():
            count = len(packed) // 25
            ids, sizes, nodes = np.frombuffer(packed, np.int64, 3 * count).reshape(3, count)
            known = np.frombuffer(packed, bool, offset=24 * count)
            yield pa.record_batch(
                [pa.array(ids, mask=~known), pa.array(sizes), pa.array(nodes, mask=sizes == 0)],
                names=["doc_id", "n_shingles", "node"],
            )


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table[name].to_pylist() if x is not None), kind)


def _shared_shingles(buckets: int):
    """The shingles of a bucket that two nodes have, dealt over groups of nodes; ``docs`` as they are.

    With each comes in how many nodes it is, 255 standing for more; that is
    enough for an order.
    """

    def run(table: pa.Table) -> pa.Table:
        grams = _joined(table, "low", np.uint32).astype(np.int64)
        grams |= _joined(table, "high", np.uint8).astype(np.int64) << 32
        node = np.repeat(_joined(table, "nodes", np.int64), _joined(table, "counts", np.int32))
        order = np.argsort(grams)
        several = np.zeros(len(order), dtype=bool)
        several[1:] = grams[order[1:]] == grams[order[:-1]]
        several[:-1] |= several[1:]
        order = order[several]  # most shingles come once and are put in no further order
        grams, node = grams[order], node[order]
        order = np.lexsort((node, grams))
        grams, node = grams[order], node[order]
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (node[1:] != node[:-1])  # a node comes once per piece
        grams, node = grams[new], node[new]
        opens = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])[: len(grams)])
        times = np.diff(np.append(opens, len(grams)))
        times = np.repeat(np.minimum(times, 255), times)
        grams, node, times = grams[times > 1], node[times > 1], times[times > 1]
        group = node % buckets
        order = np.lexsort((grams, node, group))
        grams, node, times, group = grams[order], node[order], times[order], group[order]
        edges = np.searchsorted(group, np.arange(buckets + 1))
        rows = []
        for number in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[number], edges[number + 1])
            mine, counts = np.unique(node[part], return_counts=True)
            rows.append((
                table["bucket"][0].as_py(), number, grams[part].astype(np.uint32).tobytes(),
                (grams[part] >> 32).astype(np.uint8).tobytes(), times[part].astype(np.uint8).tobytes(),
                mine.tobytes(), counts.astype(np.int32).tobytes(), None,
            ))
        rows += [(None,) * 7 + (docs,) for docs in table["docs"].to_pylist() if docs is not None]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        columns = list(zip(*rows)) or [()] * 8
        return pa.table(
            [pa.array(x, kind) for x, kind in zip(columns, kinds)],
            names=["bucket", "group", "low", "high", "times", "nodes", "counts", "docs"],
        )

    return run


def needed_overlap(size: int, percent: int = PERCENT) -> int:
    """Least intersection of a set of this size with any set that it links to."""
    return -(-percent * size // 100)


def _ordered_sets(percent: int):
    """Whole sets in the common order, of nodes that may link to any other."""

    def run(shared: pa.Table, known: pa.Table) -> pa.Table:
        rows = {"node": [], "size": [], "tokens": [], "firsts": []}
        if shared.num_rows:
            counts = _joined(shared, "counts", np.int32)
            node = np.repeat(_joined(shared, "nodes", np.int64), counts)
            tokens = _joined(shared, "low", np.uint32).astype(np.int64)
            tokens |= _joined(shared, "high", np.uint8).astype(np.int64) << 32
            lengths = [len(x) for x in shared["high"].to_pylist()]
            tokens |= np.repeat(shared["bucket"].to_numpy().astype(np.int64), lengths) << 40
            times = _joined(shared, "times", np.uint8)
            order = np.lexsort((tokens, times, node))
            node, tokens, times = node[order], tokens[order], times[order]
            opens = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            sizes = dict(zip(known["node"].to_pylist(), known["size"].to_pylist()))
            for start, stop in zip(opens.tolist(), [*opens[1:].tolist(), len(node)]):
                size = sizes[int(node[start])]
                needed = needed_overlap(size, percent)
                if stop - start < needed:
                    continue
                rows["node"].append(int(node[start]))
                rows["size"].append(size)
                rows["tokens"].append(tokens[start:stop].tobytes() + times[start:stop].tobytes())
                # its own shingles come first in the order and take up places among the first
                rows["firsts"].append(size - needed + 1 - (size - (stop - start)))
        return pa.table({
            "node": pa.array(rows["node"], pa.int64()), "size": pa.array(rows["size"], pa.int32()),
            "tokens": pa.array(rows["tokens"], pa.binary()), "firsts": pa.array(rows["firsts"], pa.int32()),
        })

    return run


def _first_tokens(batches):
    for batch in batches:
        for piece in pieces([batch], "tokens"):
            firsts = [
                np.frombuffer(packed, np.int64, number).tolist()
                for packed, number in zip(piece["tokens"].to_pylist(), piece["firsts"].to_pylist())
            ]
            again = np.repeat(np.arange(piece.num_rows), [len(x) for x in firsts])
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for x in firsts for t in x], pa.int64()), piece["node"].take(pa.array(again))],
                names=["token", "node"],
            )


class SetTrie:
    """Sets in the common order, stored with shared beginnings.

    ``sets`` are arrays of numbers that rise along each set. Every set adds one
    segment: what it does not share with the set before it.
    """

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        keys = [values.astype(">u4").tobytes() for values in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets, self.sizes = sets, sizes
        count = len(sets)
        self.depth = np.zeros(count, np.int64)  # where the segment leaves the path it hangs on
        self.parent = np.full(count, -1, np.int64)
        starts, parts, path, at = [], [], [], 0
        previous = np.empty(0, np.int64)
        for place, member in enumerate(self.order):
            values = sets[member]
            reach = min(len(previous), len(values))
            differ = np.flatnonzero(previous[:reach] != values[:reach])
            shared = int(differ[0]) if len(differ) else reach
            while path and self.depth[path[-1]] >= shared and self.depth[path[-1]] > 0:
                path.pop()
            if shared == 0:
                path = []
            self.depth[place] = shared
            self.parent[place] = path[-1] if path else -1
            path.append(place)
            starts.append(at)
            parts.append(values[shared:])
            at += len(values) - shared
            previous = values
        self.starts = np.array([*starts, at], np.int64)
        self.flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        self._words, self._masks = self.flat // 64, _mask(self.flat)
        # per subtree: where it ends, its longest set and its smallest size
        self.stop = np.arange(1, count + 1)
        self.longest = np.array([len(sets[m]) for m in self.order], np.int64)
        self.smallest = np.array([sizes[m] for m in self.order], np.int64)
        for place in range(count - 1, -1, -1):
            above = self.parent[place]
            if above >= 0:
                self.stop[above] = max(self.stop[above], self.stop[place])
                self.longest[above] = max(self.longest[above], self.longest[place])
                self.smallest[above] = min(self.smallest[above], self.smallest[place])
        self._walk = list(zip(
            self.parent.tolist(), self.depth.tolist(), self.starts.tolist(), self.starts[1:].tolist(),
            self.stop.tolist(), self.longest.tolist(), self.smallest.tolist(), self.order,
        ))

    def linked(self, values: np.ndarray, size: int, numbers: int, percent: int = PERCENT) -> list[int]:
        """The sets that link to this one; ``numbers`` is more than the largest number of any set."""
        return [member for member, _ in self.linked_to([values], [size], numbers, percent)]

    def linked_to(self, asking: list[np.ndarray], sizes: list[int], numbers: int, percent: int = PERCENT):
        """(set of the trie, places of the asking sets that link to it), from one walk for all that ask.

        Of every node the walk knows who still can link to a set below it, and
        their overlaps so far. What asks is held as bits, so a segment is
        counted for all of them 64 numbers at a time.
        """
        bits, below = _bits(asking, numbers)
        lengths, sizes = np.array([len(x) for x in asking], np.int64), np.array(sizes, np.int64)
        known, place, walk = {}, 0, self._walk
        while place < len(walk):
            parent, depth, start, end, stop, longest, smallest, member = walk[place]
            who, overlap = np.arange(len(asking)), np.zeros(len(asking), np.int64)
            if parent >= 0:
                who, overlap = known[parent]
                above = walk[parent]
                overlap = overlap + self._hits(bits, who, above[2], above[2] + depth - above[1])
            left = lengths[who]
            if start < end:
                word, place_in_word = divmod(int(self.flat[start]), 64)
                before = bits[word, who] & np.uint64((1 << place_in_word) - 1)
                left = below[word, who] - np.bitwise_count(before)
            left = np.minimum(left, longest - depth)
            # overlap o of sizes m and n links if 100 o >= percent (m + n - o)
            able = (100 + percent) * (overlap + left) >= percent * (sizes[who] + smallest)
            if not able.any():
                place = stop
                continue
            who, overlap = who[able], overlap[able]
            if stop > place + 1:
                known[place] = who, overlap
            overlap = overlap + self._hits(bits, who, start, end)
            found = who[(100 + percent) * overlap >= percent * (sizes[who] + self.sizes[member])]
            if len(found):
                yield member, found
            place += 1

    def _hits(self, bits: np.ndarray, who: np.ndarray, start: int, end: int) -> np.ndarray:
        """How many numbers of this stretch each of ``who`` has."""
        if start == end:
            return np.zeros(len(who), np.int64)
        words = self._words[start:end]
        opens = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        masks = np.bitwise_or.reduceat(self._masks[start:end], opens)[:, None]
        rows = bits[words[opens]] if len(who) == bits.shape[1] else bits[words[opens][:, None], who]
        return np.bitwise_count(rows & masks).sum(axis=0, dtype=np.int64)


def _bits(sets: list[np.ndarray], numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit ``n % 64`` of row ``n // 64`` of a set's column for each of its numbers; how many it has from each row on."""
    words = numbers // 64 + 1
    bits = np.zeros((words, len(sets)), np.uint64)
    flat = np.concatenate(sets)
    key = np.repeat(np.arange(len(sets)), [len(x) for x in sets]) * words + flat // 64
    opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    if len(opens):
        bits[key[opens] % words, key[opens] // words] = np.bitwise_or.reduceat(_mask(flat), opens)
    below = np.cumsum(np.bitwise_count(bits)[::-1], axis=0, dtype=np.int64)[::-1]
    return bits, below


def _mask(numbers: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (numbers % 64).astype(np.uint64)


def _asking_at_once(numbers: int) -> int:
    """How many sets ask in one walk, for what is held of them."""
    return int(min(_MOST_ASKING, max(1, _ASKING_BYTES // (16 * (numbers // 64 + 1)))))


def _numbered(packed: list[bytes]) -> tuple[list[np.ndarray], int]:
    """Sets as numbers in the common order, from tokens and how often each occurs."""
    tokens = [np.frombuffer(x, np.int64, len(x) // 9) for x in packed]
    times = [np.frombuffer(x, np.uint8, offset=len(x) // 9 * 8) for x in packed]
    every, first = np.unique(np.concatenate(tokens), return_index=True)
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, np.concatenate(times)[first]))] = np.arange(len(every))
    return [rank[np.searchsorted(every, x)] for x in tokens], len(every)


def block_links(sets: list[np.ndarray], sizes: list[int], numbers: int, percent: int = PERCENT):
    """Links that connect all sets of a block that any links connect.

    Once one component has half of the sets it is settled, and its members are
    not looked up any more: every link that could still join two components has
    an end outside it.
    """
    trie, most = SetTrie(sets, sizes), _asking_at_once(numbers)
    label, waiting = np.arange(len(sets)), np.arange(len(sets))
    while len(waiting):
        asking, waiting = waiting[:most], waiting[most:]
        for member, found in trie.linked_to([sets[i] for i in asking], [sizes[i] for i in asking], numbers, percent):
            for other in _joining(label, member, asking[found]):
                yield other, member
        counts = np.bincount(label)
        if 2 * counts.max() >= len(sets):
            waiting = waiting[label[waiting] != counts.argmax()]


def _joining(label: np.ndarray, member: int, others: np.ndarray) -> list[int]:
    """One of ``others`` of each component that ``member`` was not in; ``label`` names the components and joins them."""
    own, joining = label[member], []
    others = others[label[others] != own]
    while len(others):
        joining.append(int(others[0]))
        label[label == label[others[0]]] = own
        others = others[label[others] != own]
    return joining


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = (list(x) for x in zip(*pairs)) if pairs else ([], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _members(table: pa.Table, names=("family", "block")) -> dict[tuple[int, ...], np.ndarray]:
    """Rows of each block of each family, or by other ``names``."""
    if not table.num_rows:
        return {}
    keys = [table[name].to_numpy() for name in names]
    order = np.lexsort((table["node"].to_numpy(), *reversed(keys)))
    new = np.any([np.diff(key[order]) != 0 for key in keys], axis=0)
    parts = np.split(order, np.flatnonzero(new) + 1)
    return {tuple(int(key[p[0]]) for key in keys): p for p in parts}


def _within_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes, sizes, packed = table["node"].to_numpy(), table["size"].to_numpy(), table["tokens"].to_pylist()
        pairs = []
        for rows in _members(table).values():
            if len(rows) > 1:
                sets, numbers = _numbered([packed[i] for i in rows])
                found = block_links(sets, sizes[rows].tolist(), numbers, percent)
                pairs += [(int(nodes[rows[a]]), int(nodes[rows[b]])) for a, b in found]
        return _links(pairs)

    return run


_PROBE = ("family", "block", "part")


def _against_blocks(percent: int):
    """Links of a part of the sets sent to a block with those in it, as many as connect what any connect."""

    def run(blocks: pa.Table, sent: pa.Table) -> pa.Table:
        pairs, probes = [], _members(sent, _PROBE)
        nodes, sizes, packed = (
            [*blocks[name].to_pylist(), *sent[name].to_pylist()] for name in ("node", "size", "tokens")
        )
        for key, rows in _members(blocks, _PROBE).items():
            if key not in probes:
                continue
            both = [*rows, *(probes[key] + blocks.num_rows)]
            sets, numbers = _numbered([packed[i] for i in both])
            trie, most = SetTrie(sets[: len(rows)], [sizes[i] for i in rows]), _asking_at_once(numbers)
            _, label = np.unique([nodes[i] for i in both], return_inverse=True)  # some are sent to their own block
            for first in range(len(rows), len(both), most):
                asking = np.arange(first, min(first + most, len(both)))
                told = trie.linked_to([sets[i] for i in asking], [sizes[both[i]] for i in asking], numbers, percent)
                for member, found in told:
                    pairs += [(nodes[both[i]], nodes[both[member]]) for i in _joining(label, member, asking[found])]
        return _links(pairs)

    return run


def _across_blocks(placed: DataFrame, links: DataFrame, groups: int, percent: int, block_sets: int) -> DataFrame:
    """Links between the blocks of families that have several.

    First one set of each component of each block is sent to all blocks of its
    family. That joins what is largely alike. Then every set outside the
    largest component of its family is sent to all blocks, so that each pair
    of which one is outside has been compared.
    """
    large = placed.filter("blocks > 1")

    def probe(sent: DataFrame) -> DataFrame:
        names = ["family", "block", "node", "size", "tokens"]
        # What is sent comes in parts no larger than a block, as all of a family may be sent.
        many = sent.groupBy("family", "blocks").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("parts"))
        many, many_at = stored(many, "sent-parts")
        keys = max(groups, many.agg(F.sum(F.col("blocks") * F.col("parts"))).first()[0] or 0)
        group = F.pmod(F.xxhash64(*_PROBE), F.lit(keys)).cast("int")
        every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
        of = many.select("family", "parts")
        blocks = large.select(*names).join(of, "family").withColumn("part", every("parts"))
        # columns of their own: both sides come from one table
        part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
        sent = sent.join(of, "family").withColumn("part", part)
        sent = sent.withColumn("block", every("blocks")).select(*[F.col(name).alias(name) for name in (*names, "part")])
        found = (
            blocks.withColumn("group", group).groupBy("group")
            .cogroup(sent.withColumn("group", group).groupBy("group"))
            .applyInArrow(_against_blocks(percent), "a bigint, b bigint")
        )
        found = cut_lineage(found.distinct(), "block-links")
        discard(many.sparkSession, many_at)
        return found

    def labelled(known: DataFrame) -> DataFrame:
        names = components(known)
        joined = large.join(names, "node", "left")
        return joined.withColumn("component", F.coalesce("component", "node"))

    first = labelled(links)
    chosen = first.groupBy("family", "block", "component").agg(F.min("node").alias("node")).select("node")
    links = links.union(probe(large.join(chosen, "node", "left_semi")))
    second = cut_lineage(labelled(links), "block-components")
    counts = second.groupBy("family", "component").count()
    largest = counts.groupBy("family").agg(F.max_by("component", F.struct("count", "component")).alias("_main"))
    outside = second.join(largest, "family").filter("component <> _main")
    return links.union(probe(outside))


def linked_components(
    docs: DataFrame, percent: int = PERCENT, block_sets: int = BLOCK_SETS, buckets: int | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id.

    Words are those of the text with A-Z lower-cased; a set is the distinct
    runs of five words, or the whole of a shorter text. Two documents link if
    their intersection is at least ``percent`` hundredths of their union;
    ``component_id`` is the least id that links lead to. Texts that are null or
    without words link with nothing. Documents without an id count as any
    other, but name no component unless they are alone in it, when it is null.
    Sets are compared by hashes of at least 40 bits beside the bucket's number.
    """
    needed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    buckets = buckets or hash_buckets(needed)
    asked = needed.mapInArrow(_ask(buckets), _DEALT)
    dealt, dealt_at = stored(
        asked.groupBy("bucket").applyInArrow(_shared_shingles(buckets), _SHARED), "shared-ngrams"
    )
    packed = dealt.filter("docs is not null").select("docs")
    known = cut_lineage(packed.mapInArrow(_documents, "doc_id bigint, n_shingles bigint, node bigint"), "nodes")
    shared = dealt.filter("docs is null").drop("docs")
    sizes = known.filter("node is not null").groupBy("node").agg(F.max("n_shingles").cast("int").alias("size"))
    sets = (
        shared.groupBy("group")
        .cogroup(sizes.groupBy(F.pmod("node", F.lit(buckets)).cast("int").alias("group")))
        .applyInArrow(_ordered_sets(percent), "node bigint, size int, tokens binary, firsts int")
    )
    sets = cut_lineage(sets, "ngram-sets")
    discard(needed.sparkSession, dealt_at)
    firsts = cut_lineage(
        sets.select("node", "tokens", "firsts").mapInArrow(_first_tokens, "token bigint, node bigint"),
        "first-ngrams",
    )
    least = firsts.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    together = firsts.join(least.filter("least < most"), "token").select(
        F.col("least").alias("a"), F.col("node").alias("b")
    )
    families = components(together).withColumnRenamed("component", "family")
    counts = families.groupBy("family").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("blocks"))
    placed = sets.join(families.join(counts, "family"), "node").drop("firsts")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = cut_lineage(placed, "ngram-families")
    groups = max(1, math.ceil(placed.count() / GROUP_SETS), min(buckets, placed.count() // 100))
    group = F.pmod(F.xxhash64("family", "block"), F.lit(groups)).cast("int")
    links = cut_lineage(
        placed.groupBy(group.alias("group")).applyInArrow(_within_blocks(percent), "a bigint, b bigint"),
        "ngram-links",
    )
    if not placed.filter("blocks > 1").isEmpty():
        links = _across_blocks(placed, links, groups, percent, block_sets)
    named = known.join(components(links), "node", "left")
    named = cut_lineage(named.withColumn("component", F.coalesce("component", "node")), "named")
    least_id = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    # Stored, so that the join has two plain sides and a component of very many documents is cut up.
    least_id = cut_lineage(least_id, "least-ids")
    return named.join(least_id, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The document of least id of every component, with the columns it has.

    Rows of one id and text are the same document and one of them stays;
    rows without an id stay.
    """
    found = linked_components(docs, percent)
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    unnamed = docs.filter("doc_id is null")
    return docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id", "text"]).union(unnamed)
