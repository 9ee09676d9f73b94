"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Its parity sketch has one bit per hash value, and each
shingle flips its bit, so the Hamming distance of two sketches is at most the symmetric difference
of the sets. Two sets of ``a`` and ``b`` shingles with a Jaccard similarity of ``p`` per cent differ in
at most ``(a + b) (100 - p) / (100 + p)`` shingles. Sketches are cut into more blocks than that, and by
the pigeonhole principle some blocks of a similar pair are equal. Blocks are joined, candidates
checked exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlib.llm.common import bitmap, id_and_text, maybe_in, slices, stored
from reviewlib.llm.components import components
from reviewlib.llm.words import Coder, mix, shingles

WIDTH = 5
PERCENT = 80

# Sketch bits kept with each document to reject candidates before their texts are read.
_SKETCH_WORDS = 8
# Below so many shingles a band is cut in several independent ways, since blocks may be empty.
_SMALL = 64
_WAYS = 4
# Keys that one task sends on at a time, and keys that one group of the join holds on average.
_SEND = 1 << 21
_GROUP = 1 << 20
_TAG = 64
# Sets of a key that are compared in one place, and how many of them with all at a time.
_BLOCK = 512
_ROWS = 128
# Members of a key that one row of the table of shared keys holds, and rows looked at at a time.
_MEMBERS = 128
_LOOK = 512
# Tables of keys are the most that waits on disk, so they are compressed harder.
_CODEC = "zstd"


class Bands:
    """Size bands, each 1.5 times as wide as the one before, and how they are cut.

    A similar pair lies in one band or in two neighbouring ones, so the sets at the upper
    end of a band are also cut as members of the next.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        while self.edges[-1] < 1 << 34:
            self.edges.append(self.edges[-1] * 3 // 2 + 1)
        self._cuts: dict[int, np.ndarray] = {}

    def differ(self, both: int) -> int:
        """The most shingles in which similar sets of ``both`` shingles together differ."""
        return both * (100 - self.percent) // (100 + self.percent)

    def largest_partner(self, n: int) -> int:
        return n * 100 // self.percent

    def of(self, n: int) -> Iterator[tuple[int, int, int]]:
        """(band, blocks, most differences from a partner) of each band that ``n`` shingles
        take part in; none if only equal sets are similar."""
        most = self.largest_partner(n)
        if not self.differ(n + most):
            return
        own = int(np.searchsorted(self.edges, n, "right"))
        for band in (own, own + 1):
            low, high = self.edges[band - 1], self.edges[band] - 1
            if most >= low:
                blocks = self.differ(2 * high) + 1 + high // 16
                yield band, blocks, self.differ(n + min(most, high))

    def cuts(self, blocks: int) -> np.ndarray:
        """Where hash values are cut into ``blocks`` equal ranges."""
        if blocks not in self._cuts:
            at = [(i << 64) // blocks for i in range(1, blocks)]
            self._cuts[blocks] = np.array(at, np.uint64)
        return self._cuts[blocks]

    def keys(self, found: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(tag, block keys) of a set of ascending shingle hashes, per band.

        The tag holds the band and how many of the keys the set must share with a similar one.
        Equal empty blocks say nothing, so they are left out, unless a set has so many that a
        similar one might share no others.
        """
        n = len(found)
        for band, blocks, most in self.of(n):
            ways, spare = [], []
            for way in range(_WAYS if self.edges[band] <= _SMALL else 1):
                hashes = np.sort(mix(found + np.uint64(way))) if way else found
                values = self._parities(hashes, blocks)
                place = np.arange(blocks, dtype=np.uint64) + np.uint64((band * _WAYS + way) << 40)
                filled = values != 0
                ways.append((mix(values + mix(place)), filled))
                spare.append(blocks - most - int((~filled).sum()))
            if max(spare) > 0:
                need = sum(max(0, x) for x in spare)
                yield need * _TAG + band, np.concatenate([k[filled] for k, filled in ways])
            else:
                yield _TAG + band, np.concatenate([k for k, _ in ways])

    def _parities(self, hashes: np.ndarray, blocks: int) -> np.ndarray:
        """Each block of the sketch as one value: the XOR of codes of its odd bits, of which a
        block has 2^32."""
        codes = np.zeros(len(hashes) + 1, np.uint64)
        np.bitwise_xor.accumulate(mix(hashes & np.uint64(0xFFFFFFFF)), out=codes[1:])
        ends = np.concatenate([[0], np.searchsorted(hashes, self.cuts(blocks)), [len(hashes)]])
        return codes[ends[1:]] ^ codes[ends[:-1]]


def _sketch(found: np.ndarray) -> np.ndarray:
    """The parity sketch folded to a few words, whose distance is still a lower bound."""
    counts = np.bincount((found % np.uint64(64 * _SKETCH_WORDS)).astype(np.int64), minlength=64 * _SKETCH_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``n`` distinct shingles, ``digest`` and ``sketch`` of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for group in coder.groups(batch.column(1)):
                for found in shingles(group, width):
                    sizes.append(len(found))
                    digests.append(_digest(found))
                    sketches.append(_sketch(found))
            words = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * _SKETCH_WORDS),
                        pa.array(words),
                    ),
                ],
                names=["doc_id", "n", "digest", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, sketch array<long>")


def _packed(values: np.ndarray) -> bytes:
    """Small whole numbers, compressed byte by byte: the lowest byte of each, then the next."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), _CODEC, asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, n * width, _CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


def _sent(keys: list, ids: list, tags: list, groups: int) -> pa.RecordBatch:
    """A row per group with its keys, their documents (as steps from one to the next, which
    compress well) and their tags.

    32 bits of a key go along: with the about ``_GROUP`` keys of a group they make a key in some
    thousand seem shared that is not, which only adds a candidate.
    """
    key, id, tag = (np.concatenate(x) for x in (keys, ids, tags))
    group = (key % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    present, first = np.unique(group[order], return_index=True)
    id, tag = id[order], tag[order]
    short = (key[order] // np.uint64(groups)).astype(np.uint32)
    steps = np.diff(id, prepend=0)
    steps[first] = id[first]
    ends = np.append(first, len(order)).tolist()
    rows = [slice(*x) for x in zip(ends[:-1], ends[1:])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(present),
            pa.array([short[x].tobytes() for x in rows], pa.binary()),
            pa.array([_packed(steps[x]) for x in rows], pa.binary()),
            pa.array([_packed(tag[x]) for x in rows], pa.binary()),
        ],
        names=["group", "keys", "steps", "tags"],
    )


def _shared_keys(docs: DataFrame, groups: int, width: int, percent: int) -> DataFrame:
    """``key``, ``centre``, ``split``, ``ids``, ``tags`` of the block keys that more than one set has:
    the centre is the smallest document with the key, the ids and tags are those of all sets that
    have it, the centre's first. A key of many sets is ``split`` over rows.
    A task sends on each of its sets once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, bands = Coder(), Bands(percent)
        seen: set[bytes] = set()
        keys, ids, tags, n = [], [], [], 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for part in coder.groups(batch.column(1)):
                for i, found in enumerate(shingles(part, width), part.lo):
                    digest = _digest(found)
                    if doc_ids[i] is None or digest in seen:
                        continue
                    seen.add(digest)
                    for tag, own in bands.keys(found):
                        keys.append(own)
                        ids.append(np.full(len(own), doc_ids[i], np.int64))
                        tags.append(np.full(len(own), tag, np.int32))
                        n += len(own)
                if n > _SEND:
                    yield _sent(keys, ids, tags, groups)
                    keys, ids, tags, n = [], [], [], 0
        if n:
            yield _sent(keys, ids, tags, groups)

    def join(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_py(), np.uint32) for x in table["keys"]]
        steps = [_unpacked(x.as_py(), len(k), np.int64) for x, k in zip(table["steps"], keys)]
        tags = [_unpacked(x.as_py(), len(k), np.int32) for x, k in zip(table["tags"], keys)]
        key, tag = np.concatenate(keys), np.concatenate(tags)
        id = np.concatenate([np.cumsum(x) for x in steps])
        order = np.lexsort((id, key))
        key, id, tag = key[order], id[order], tag[order]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        run = np.cumsum(new) - 1
        keep = size[run] > 1
        run, nth = run[keep], (np.arange(len(key)) - first[run])[keep]
        begin = np.flatnonzero(nth % _MEMBERS == 0)
        ends = pa.array(np.append(begin, len(run)), pa.int32())
        number = table["group"][0].as_py() << 32
        return pa.table(
            {
                "key": pa.array(number + run[begin]),
                "centre": pa.array(id[first][run[begin]]),
                "split": pa.array(size[run[begin]] > _MEMBERS),
                "ids": pa.ListArray.from_arrays(ends, pa.array(id[keep])),
                "tags": pa.ListArray.from_arrays(ends, pa.array(tag[keep])),
            }
        )

    sent = docs.mapInArrow(send, "group long, keys binary, steps binary, tags binary")
    return sent.groupBy("group").applyInArrow(
        join, "key long, centre long, split boolean, ids array<long>, tags array<int>"
    )


def _looks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, since each may hold many documents."""
    for batch in batches:
        for at in range(0, batch.num_rows, _LOOK):
            yield batch.slice(at, _LOOK)


def _members(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The documents of all rows of shared keys, and the centre of each."""
    ids = batch.column("ids")
    sizes = np.diff(ids.offsets.to_numpy())
    return ids.flatten().to_numpy(), np.repeat(batch.column("centre").to_numpy(), sizes)


def _centred(shared: DataFrame) -> DataFrame:
    """``doc_id``, ``centre`` of all keys, each pair of them once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _looks(batches):
            id, centre = _members(batch)
            order = np.lexsort((id, centre))
            id, centre = id[order], centre[order]
            new = np.append(True, (id[1:] != id[:-1]) | (centre[1:] != centre[:-1]))[: len(id)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(id[new]), pa.array(centre[new])], names=["doc_id", "centre"]
            )

    return shared.select("centre", "ids").mapInArrow(run, "doc_id long, centre long").distinct()


def _pair_code(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return mix(mix(one.view(np.uint64)) + other.view(np.uint64)).view(np.int64)


def _unsettled(shared: DataFrame, apart: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``tag`` of the keys with a document ``apart`` from its centre. A bitmap lets a few
    other keys pass, which only add candidates; keys of many sets are told by all their rows."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _pair_code(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(code)], names=["code"])

    bits = bitmap(apart.select("doc_id", "centre").mapInArrow(coded, "code long"), "code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _looks(batches):
            hit = np.append(0, np.cumsum(maybe_in(bits, _pair_code(*_members(batch)))))
            ends = batch.column("ids").offsets.to_numpy()
            hit = np.diff(hit[ends - ends[0]]) > 0
            batch = batch.append_column("hit", pa.array(hit))
            yield batch.filter(pa.array(hit | batch.column("split").to_numpy(zero_copy_only=False)))

    schema = "key long, centre long, split boolean, ids array<long>, tags array<int>, hit boolean"
    rows = stored(shared.mapInArrow(run, schema), _CODEC)
    many = rows.filter("split")
    many = many.join(many.filter("hit").select("key").distinct(), "key", "left_semi")
    rows = rows.filter("NOT split").select("key", "ids", "tags").union(many.select("key", "ids", "tags"))
    return rows.select("key", F.inline(F.arrays_zip("ids", "tags"))).toDF("key", "doc_id", "tag")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents that may be in ``ids`` (a bitmap lets few others pass; the join that follows is exact)."""
    bits = bitmap(ids, ids.columns[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            maybe = maybe_in(bits, own.fill_null(0).to_numpy()) & own.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(maybe))

    return docs.mapInArrow(run, "doc_id long, text string")


def _apart(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``u``, ``v``, ``apart`` of those ``pairs`` that sizes and sketches do not rule out."""
    left = nodes.select(F.col("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    right = nodes.select(F.col("u").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
    both = F.col("nu") + F.col("nv")
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .filter(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
        .withColumn("apart", _apart(F.col("su"), F.col("sv")))
        .filter(F.col("apart") * (100 + percent) <= both * (100 - percent))
        .select("u", "v", "apart")
    )


def _links(near: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``near`` (``u``, ``v``) that are similar, by their whole sets. Texts are moved and cut again,
    since they take less room than their sets."""
    near = near.select("u", "v")
    left = _texts_of(docs, near.select("u").distinct()).toDF("u", "a")
    right = _texts_of(docs, near.select("v").distinct()).toDF("v", "b")
    pairs = near.join(left, "u").join(right, "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            for part in slices(batch, 2):
                sets = [
                    [found for group in coder.groups(part.column(k)) for found in shingles(group, width)]
                    for k in (2, 3)
                ]
                similar = []
                for one, other in zip(*sets):
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    similar.append(100 * common >= percent * (len(one) + len(other) - common))
                yield part.select([0, 1]).filter(pa.array(similar, pa.bool_()))

    return stored(pairs.mapInArrow(run, "u long, v long").distinct())


def _compare(percent: int):
    """Within each ``key`` and pair of blocks ``i``, ``j``: the pairs of sets in different components that
    sizes and sketches do not rule out. Only those are given on."""

    def near(u, c, n, sketch, block) -> np.ndarray:
        found = []
        for at in range(0, len(u), _ROWS):
            rows = slice(at, at + _ROWS)
            apart = np.bitwise_count(sketch[rows, None] ^ sketch[None, :]).sum(2, dtype=np.int64)
            low, high = np.minimum(n[rows, None], n), np.maximum(n[rows, None], n)
            fits = (low * 100 >= high * percent) & (apart * (100 + percent) <= (low + high) * (100 - percent))
            fits &= (u[rows, None] > u) & (c[rows, None] != c)
            if block[0] != block[-1] or (block != block[0]).any():
                fits &= block[rows, None] != block
            a, b = np.nonzero(fits)
            found.append(np.stack([u[rows][a], u[b]], 1))
        return np.concatenate(found)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending")])
        # unsigned: numpy counts the bits of a negative number's absolute value
        words = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64)
        sketch = words.reshape(-1, _SKETCH_WORDS)
        key, i, j, block, u, c, n = (
            table[x].to_numpy() for x in ("key", "i", "j", "block", "u", "c", "n")
        )
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(key)]
        found = [
            near(u[a:b], c[a:b], n[a:b], sketch[a:b], block[a:b])
            for a, b in zip(cuts[:-1], cuts[1:])
            if b - a > 1
        ]
        pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
        return pa.table({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})

    return run


def _open_pairs(
    shared: DataFrame,
    centred: DataFrame,
    copies: DataFrame,
    part_of: DataFrame,
    nodes: DataFrame,
    percent: int,
) -> DataFrame:
    """Pairs that may be similar although they are in different components.

    A similar pair shares at least as many keys as the tags say, and all of them join different
    components. Sets with fewer such keys are out. Of the others each needs only its
    rarest keys: any similar pair shares one of those. The sets of a key are compared by their
    sketches in blocks of bounded size, every two blocks of a key in a place of their own.
    """

    def placed(rows: DataFrame, id: str, u: str, c: str) -> DataFrame:
        """Adds the set ``u`` and the component ``c`` of document ``id``."""
        own = copies.select(F.col("doc_id").alias(id), F.col("u").alias("_u"))
        rows = rows.join(own, id, "left").withColumn(u, F.coalesce("_u", id)).drop("_u")
        part = part_of.select(F.col("u").alias(u), F.col("c").alias("_c"))
        return rows.join(part, u, "left").withColumn(c, F.coalesce("_c", u)).drop("_c")

    ends = placed(placed(centred, "doc_id", "u", "c"), "centre", "v", "d")
    apart = stored(ends.filter("c != d").select("doc_id", "centre"), _CODEC)
    rows = placed(_unsettled(shared, apart), "doc_id", "u", "c")
    rows = stored(rows.select("key", "u", "tag", "c").distinct(), _CODEC)
    need = F.floor(F.col("tag") / _TAG)
    count = rows.groupBy("u", "tag").agg(F.count("*").alias("n"))
    able = count.filter(F.col("n") >= need)
    frequent = rows.join(able, ["u", "tag"])
    sizes = frequent.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    # a window holds the keys of one set, which its size bounds
    order = Window.partitionBy("u", "tag").orderBy("size", "key")
    rare = stored(
        frequent.join(sizes, "key")
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= F.col("n") - need + 1)
        .select("key", "u", "c", "size"),
        _CODEC,
    )
    tasks = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("size") / _BLOCK)
    own = F.pmod(F.xxhash64("u"), blocks)
    spread = (
        rare.join(nodes, "u")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .withColumn("place", F.pmod(F.xxhash64("key", "i", "j"), F.lit(4 * tasks)))
        .select("place", "key", "i", "j", "block", "u", "c", "n", "sketch")
    )
    return spread.groupBy("place").applyInArrow(_compare(percent), "u long, v long").distinct()


def similar_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row: documents are linked when their sets of
    ``width``-word shingles have a Jaccard similarity of at least ``percent``, and a component is named
    by its smallest id.

    A-Z count as a-z. A text with fewer words than ``width`` is one shingle; a null text or one
    without words has none and is linked with nothing. Rows that repeat an id count as one
    document with all their links; a null id is linked with nothing and its component is null.

    1. Equal sets fall together by digest.
    2. Every block key that two sets share makes its smallest member a candidate for the
       others. Each set is checked against the candidate with the nearest sketch; similar
       ones make components.
    3. A similar pair that is still in two components shares only keys that join different
       components. Those are few; all their pairs are checked.

    So no link between components is lost, and copies and near copies are never paired
    with each other beyond their first.
    """
    docs = id_and_text(docs, id, text)
    sets = stored(shingle_sets(docs, width))
    classes = (
        sets.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("u"),
            F.max("n").alias("n"),
            F.first("sketch").alias("sketch"),
        )
    )
    classes = stored(classes)
    member = stored(
        sets.select("doc_id", "n", "digest").join(classes.select("digest", "u"), "digest", "left")
        .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("u", "doc_id")).alias("u"))
    )
    copies = member.filter("doc_id != u").select("doc_id", "u").distinct()

    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(tasks, total * 6 // 10 // _GROUP)
    shared = stored(_shared_keys(docs, groups, width, percent), _CODEC)

    centred = stored(_centred(shared), _CODEC)
    centre = copies.select(F.col("doc_id").alias("centre"), F.col("u").alias("w"))
    pairs = (
        centred.join(copies, "doc_id", "left")
        .join(centre, "centre", "left")
        .select(F.coalesce("u", "doc_id").alias("a"), F.coalesce("w", "centre").alias("b"))
        .filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    # as a table, so that joins with it start from an exchange whose hot keys Spark can split
    nodes = stored(
        classes.groupBy("u").agg(F.max("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    near = _plausible(pairs, nodes, percent)
    nearest = near.groupBy("u").agg(F.min_by("v", F.struct("apart", "v")).alias("v"))
    links = _links(stored(nearest), docs, width, percent)
    still_open = _open_pairs(shared, centred, copies, components(links), nodes, percent)
    more = _links(stored(still_open), docs, width, percent)
    part_of = components(links.union(more))
    return (
        member.join(part_of, "u", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "u").alias("component_id"))
    )
