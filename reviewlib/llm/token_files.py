"""Token ids of documents in compact files: canonical length-limited Huffman codes in blocks.

A file set is a folder with two Parquet tables. ``book`` has a row per used id: ``id``, ``bits`` (the
length of its code). ``blocks`` has a row per block of neighbouring documents, in ascending order of
``doc_id`` from file to file and block to block:

    part, block   number of the range of ids, and of the block in it
    doc_ids       the documents, ascending
    counts        their numbers of ids
    n, earlier    ids in the block, and in the blocks before it in its part
    checkpoints   the bit at which each stretch starts: of each document in turn every
                  ``STRIDE``-th id, from its first
    data          the codes, first bit first; a document starts at a byte

Codes are canonical: of equal length they ascend with the id, and shorter ones come first. So the
lengths alone rebuild the book, a table of ``2^MAX_BITS`` entries decodes, and a reader may start at any
checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlib.llm.common import bin_of, id_and_text, scratch, slices
from reviewlib.llm.words import Coder, buffers

MAX_BITS = 18
STRIDE = 256
# Ids that a block gathers before it is closed; a longer document is a block of its own.
BLOCK = 1 << 18
# Pieces of text whose ids a Python worker remembers, for its next tasks too.
_CACHE = 1_000_000
# The UTF-8 bytes, as numbers, of the characters past ASCII that a pattern's \s takes.
_SPACES = [
    int.from_bytes(chr(c).encode())
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]


# -- codes -----------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts, by package-merge.

    In every round the cheapest items and packages of two are merged in order of weight; a symbol's
    length is how many of the chosen items of all rounds are its own.
    """
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    items = counts[order].astype(np.float64)
    rounds = []
    weights = items
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([items, pairs])
        by_weight = np.argsort(both, kind="stable")
        rounds.append(by_weight < n)  # whether the k-th cheapest is an item
        weights = both[by_weight]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_item in reversed(rounds):
        chosen = int(is_item[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[:take] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Book:
    """Codes of ids. ``ids`` ascend; ``bits`` are their code lengths."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        # the first code of a length follows the last of the length before, with zeros appended
        wide = np.cumsum(np.append(0, np.uint64(1) << (MAX_BITS - bits[order]).astype(np.uint64)))
        starts = wide[:-1].astype(np.int64)
        top = int(ids.max()) + 1 if len(ids) else 1
        self.bits = np.zeros(top, np.int64)
        self.codes = np.zeros(top, np.uint64)
        self.bits[ids] = bits
        self.codes[ids[order]] = (starts >> (MAX_BITS - bits[order])).astype(np.uint64)
        # which id, and how many bits of it, a window of MAX_BITS bits starts with
        self.symbol = np.zeros(1 << MAX_BITS, np.int32)
        self.length = np.ones(1 << MAX_BITS, np.uint8)
        spans = np.diff(np.append(starts, wide[-1].astype(np.int64)))
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(ids[order], spans)
        self.length[:filled] = np.repeat(bits[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The codes one after the other, and the bits at which they start and the last ends."""
        bits = self.bits[ids]
        at = np.concatenate([[0], np.cumsum(bits)])
        if not len(ids):
            return b"", at
        # each code in a window of 64 bits from the 32-bit word that it starts in
        shift = (64 - (at[:-1] & 31) - bits).astype(np.uint64)
        windows = self.codes[ids] << shift
        word = at[:-1] >> 5
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        merged = np.bitwise_or.reduceat(windows, first)
        words = np.zeros(int(word[-1]) + 2, np.uint64)
        words[word[first]] = merged >> np.uint64(32)
        words[word[first] + 1] |= merged & np.uint64(0xFFFFFFFF)
        return words.astype(">u4").tobytes()[: (int(at[-1]) + 7) // 8], at

    def decode(self, data: bytes, checkpoints: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of all stretches, ``sizes`` of each, decoded side by side from their checkpoints."""
        padded = np.frombuffer(data + bytes(8), np.uint8)
        longest = int(sizes.max()) if len(sizes) else 0
        out = np.zeros((longest, len(checkpoints)), np.int32)
        at = checkpoints.astype(np.int64)
        mask = (1 << MAX_BITS) - 1
        last = len(padded) - 4
        for k in range(longest):
            byte = np.minimum(at >> 3, last)
            window = (
                (padded[byte].astype(np.int64) << 24)
                | (padded[byte + 1].astype(np.int64) << 16)
                | (padded[byte + 2].astype(np.int64) << 8)
                | padded[byte + 3]
            )
            key = (window >> (32 - MAX_BITS - (at & 7))) & mask
            out[k] = self.symbol[key]
            at += self.length[key]
        return out.T[np.arange(longest) < sizes[:, None]]


# -- ids -------------------------------------------------------------------------------


class Ids:
    """Ids of texts by the tokenizers library.

    A byte-level tokenizer cuts a text by its published pattern before it looks at its vocabulary.
    That pattern never crosses a blank after something else than white space, punctuation after an
    ASCII letter, or either side of a line end without other white space, ASCII or not, beside it. So
    pieces cut there have the ids that they have in the text, and each different piece is encoded
    once and remembered. Another tokenizer gets whole texts.
    """

    def __init__(self, tokenizer: str, end_id: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.coder = Coder(lower=False)
        self.end = np.array([end_id], np.int32)
        parts = json.loads(tokenizer)
        before = parts.get("pre_tokenizer") or {}
        self.cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not parts.get("normalizer")
            and not parts.get("post_processor")
        )
        self.added = [t["content"].encode() for t in parts.get("added_tokens", [])]
        # every character of a byte-level token stands for a byte
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        letters = np.zeros(256, bool)
        letters[[*range(65, 91), *range(97, 123)]] = True
        self.letter = letters
        self.sign = np.zeros(256, bool)
        self.sign[33:127] = True
        self.sign &= ~letters
        self.sign[48:58] = False
        self.lead = np.zeros(256, bool)
        self.lead[[0xC2, 0xE1, 0xE2, 0xE3]] = True
        self._forget()

    def _forget(self) -> None:
        # codes of the known pieces, ascending, and the row of each
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _keep(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remembers pieces, whose ``codes`` ascend."""
        n, m = len(self.row), len(codes)
        while n + m > len(self.begin):
            self.begin, self.size = (np.append(x, np.zeros_like(x)) for x in (self.begin, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.begin[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + m] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        at = np.searchsorted(self.known, codes)
        self.known = np.insert(self.known, at, codes)
        self.row = np.insert(self.row, at, np.arange(n, n + m))

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        """The rows of pieces, -1 for those not known."""
        if not len(self.known):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        return np.where(self.known[at] == codes, self.row[at], -1)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in found]

    def _space(self, data: np.ndarray) -> np.ndarray:
        """Which bytes are of white space as the pattern has it, that of other scripts too."""
        space = self.coder.space[data]
        at = np.flatnonzero(self.lead[data])
        if len(at):
            last = len(data) - 1
            chars = data[np.minimum(at + np.arange(3)[:, None], last)].astype(np.int64)
            two = np.isin((chars[0] << 8) | chars[1], _SPACES)
            three = np.isin((chars[0] << 16) | (chars[1] << 8) | chars[2], _SPACES)
            for k, found in enumerate((two | three, two | three, three)):
                space[at[found] + k] = True
        return space

    def _learn(self, data: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Pieces that start with one blank and do not end with white space can follow each other in
        one text, and those that start with a letter can with a line end after each; the ids
        are told apart by the bytes they stand for. Others are encoded one by one."""
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        closed = ((last < 128) & (last > 32)) | ((last >= 128) & (before == 0xC3) & (ends - starts > 1))
        blank = (data[starts] == 32) & (ends - starts > 2) & closed
        blank &= ~self.coder.space[data[np.minimum(starts + 1, len(data) - 1)]]
        word = self.letter[data[starts]] & closed
        plain = blank | word
        for kind, gap in ((blank, 0), (word, 1)):
            if not kind.any():
                continue
            first, size = starts[kind], (ends - starts)[kind]
            upto = np.cumsum(size + gap)
            place = np.repeat(first - (upto - size - gap), size + gap) + np.arange(upto[-1])
            text = data[np.minimum(place, len(data) - 1)]
            if gap:
                text[upto - 1] = 10
            text = text.tobytes()
            if any(t in text for t in self.added):
                plain &= ~kind
                continue
            ids = self._encode([text.decode()])[0]
            stop = np.searchsorted(np.cumsum(self.bytes[ids]), upto) + 1
            if gap:
                ids = np.delete(ids, stop - 1)
            self._keep(codes[kind], ids, np.diff(stop, prepend=0) - gap)
        rest = ~plain
        if rest.any():
            pieces = [bytes(data[a:b]).decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
            found = self._encode(pieces)
            self._keep(codes[rest], np.concatenate(found), np.array([len(x) for x in found]))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each ended by the end id, and where the texts' ids start and end."""
        if not self.cuts:
            rows = [np.append(x, self.end) for x in self._encode(texts.fill_null("").to_pylist())]
            bounds = np.cumsum([0, *map(len, rows)])
            return np.concatenate([self.end[:0], *rows]), bounds
        offsets, data = buffers(texts)
        base, stop = int(offsets[0]), int(offsets[-1])
        data, offsets = data[base:stop], offsets - base
        if not len(data):
            return np.tile(self.end, len(texts)), np.arange(len(texts) + 1)
        cut = np.zeros(len(data) + 1, bool)
        solid = ~self._space(data)
        cut[1:-1] = (data[1:] == 32) & solid[:-1]
        whole = data.tobytes()
        if not any(t in whole for t in self.added):
            cut[1:-1] |= self.sign[data[1:]] & self.letter[data[:-1]]
            lone = np.flatnonzero((data[1:-1] == 10) & solid[:-2] & solid[2:]) + 1
            cut[lone] = cut[lone + 1] = True
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        codes = self.coder.codes(data, starts, ends)
        order = np.argsort(codes)
        ascending = codes[order]
        new = np.append(True, ascending[1:] != ascending[:-1])
        first, values = order[new], ascending[new]
        back = np.empty(len(codes), np.int64)
        back[order] = np.cumsum(new) - 1
        if len(self.row) > _CACHE:
            self._forget()
        rows = self._rows(values)
        missing = rows < 0
        if missing.any():
            at = first[missing]
            self._learn(data, values[missing], starts[at], ends[at])
            rows[missing] = self._rows(values[missing])
        rows = rows[back]
        wide = self.size[rows]
        total = np.cumsum(np.append(0, wide))
        place = np.repeat(self.begin[rows] - total[:-1], wide) + np.arange(total[-1])
        bounds = total[np.searchsorted(starts, offsets)]
        ids = np.insert(self.flat[place], bounds[1:], self.end[0])
        return ids, bounds + np.arange(len(bounds))


@lru_cache(maxsize=1)
def _ids(tokenizer: str, end_id: int) -> Ids:
    """One for all tasks of a Python worker, so that each takes over what those before it have learned."""
    return Ids(tokenizer, end_id)


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about a megabyte of text (the second column)."""
    for batch in batches:
        yield from slices(batch, 1)


def _width(tokenizer: str, end_id: int) -> str:
    """The unsigned type that holds every id."""
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_str(tokenizer).get_vocab().values(), default=0)
    return "<u2" if max(top, end_id) < 1 << 16 else "<u4"


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``part``, ``doc_id``, ``ids`` (packed) of documents (``doc_id``, ``text``, ``part``)."""
    width = _width(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ids(tokenizer, end_id)
        for batch in _by_text(batches):
            ids, bounds = encode(batch.column(1))
            data, bounds = ids.astype(width).tobytes(), bounds * np.dtype(width).itemsize
            packed = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), pa.array(packed, pa.binary())],
                names=["part", "doc_id", "ids"],
            )

    return docs.mapInArrow(run, "part int, doc_id long, ids binary")


def id_counts(packed: DataFrame, width: str) -> DataFrame:
    """``id``, ``n``: occurrences in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            _, data = buffers(batch.column(0))
            own = np.bincount(np.frombuffer(data, width))
            if len(own) > len(total):
                own, total = total, own
            total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(total[found])], names=["id", "n"]
        )

    return packed.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


# -- files -----------------------------------------------------------------------------

_BLOCKS = (
    "part int, block int, doc_ids array<long>, counts array<long>, n long, earlier long, "
    "checkpoints array<long>, data binary"
)


def _encoded(packed: DataFrame, width: str, book: Book) -> DataFrame:
    """``part``, ``doc_id``, ``n``, ``checkpoints``, ``data`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, coded, checkpoints = [], [], []
            for ids in batch.column(2):
                ids = np.frombuffer(ids.as_py(), width)
                data, at = book.encode(ids)
                sizes.append(len(ids))
                coded.append(data)
                checkpoints.append(at[:-1:STRIDE])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(checkpoints, pa.list_(pa.int64())),
                    pa.array(coded, pa.binary()),
                ],
                names=["part", "doc_id", "n", "checkpoints", "data"],
            )

    return packed.mapInArrow(run, "part int, doc_id long, n long, checkpoints array<long>, data binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that come sorted by part and id, put together."""
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int64())),
            ("n", pa.int64()),
            ("earlier", pa.int64()),
            ("checkpoints", pa.list_(pa.int64())),
            ("data", pa.binary()),
        ]
    )

    def closed(part: int, number: int, rows: list, earlier: int) -> pa.RecordBatch:
        bases = np.cumsum([0, *(8 * len(r["data"]) for r in rows)])
        at = np.concatenate([np.array(r["checkpoints"], np.int64) + b for r, b in zip(rows, bases)])
        row = {
            "part": part,
            "block": number,
            "doc_ids": [r["doc_id"] for r in rows],
            "counts": [r["n"] for r in rows],
            "n": sum(r["n"] for r in rows),
            "earlier": earlier,
            "checkpoints": at,
            "data": b"".join(r["data"] for r in rows),
        }
        return pa.RecordBatch.from_pylist([row], schema)

    part, number, rows, n, earlier = None, 0, [], 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["part"] != part or n + row["n"] > BLOCK):
                yield closed(part, number, rows, earlier)
                number, earlier = (number + 1, earlier + n) if row["part"] == part else (0, 0)
                rows, n = [], 0
            part = row["part"]
            rows.append(row)
            n += row["n"]
    if rows:
        yield closed(part, number, rows, earlier)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Writes the ids of every text to ``path``. ``tokenizer`` is the JSON of a tokenizer file, and
    ``end_id`` ends each document; a null text counts as empty and has the end id alone. Documents
    with a null id come first; rows that repeat an id stay apart, the shorter first.

    Texts are encoded once; their ids wait in the scratch folder, compressed, until all are counted.
    Only finished codes are shuffled. Ranges of ids are cut at quantiles.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id, text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts)).head()[0] if shares else None
    part = bin_of(F.col("doc_id"), sorted(set(cuts or [])))
    placed = docs.withColumn("part", F.coalesce(part, F.lit(0)).cast("int"))
    kept = scratch(spark)
    encode_ids(placed, tokenizer, end_id).write.option("compression", "zstd").parquet(kept)
    packed = spark.read.parquet(kept)

    width = _width(tokenizer, end_id)
    counts = id_counts(packed, width).orderBy("id").toPandas()  # at most the vocabulary
    ids = counts["id"].to_numpy(np.int64)
    bits = code_lengths(counts["n"].to_numpy(np.int64))
    rows = list(zip(ids.tolist(), bits.tolist()))
    spark.createDataFrame(rows, "id int, bits int").coalesce(1).write.parquet(f"{path}/book")

    coded = _encoded(packed, width, Book(ids, bits))
    ordered = coded.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "n", "data")
    ordered.mapInArrow(_blocks, _BLOCKS).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` of every document;
    ``ids`` is an array or, if ``packed``, unsigned 32-bit numbers, the lowest byte first. No shuffle."""
    # the book has at most the vocabulary, and there are as many parts as shuffle partitions
    rows = spark.read.parquet(f"{path}/book").orderBy("id").collect()
    book = Book(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))
    blocks = spark.read.parquet(f"{path}/blocks")
    first, seen = {}, 0
    for part, n in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        first[part], seen = seen, seen + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, _, doc_ids, counts, _, earlier, checkpoints, data = (c[row] for c in batch.columns)
                counts = counts.values.to_numpy(zero_copy_only=False)
                pieces = -(-counts // STRIDE)
                sizes = np.full(int(pieces.sum()), STRIDE, np.int64)
                sizes[np.cumsum(pieces) - 1] = counts - (pieces - 1) * STRIDE
                at = checkpoints.values.to_numpy(zero_copy_only=False)
                ids = book.decode(data.as_py(), at, sizes)
                bounds = np.cumsum(np.append(0, counts))
                if packed:
                    ends = pa.array(4 * bounds, pa.int32())
                    raw = pa.py_buffer(ids.astype("<u4").tobytes())
                    column = pa.Array.from_buffers(pa.binary(), len(counts), [None, ends.buffers()[1], raw])
                else:
                    column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                start = first[part.as_py()] + earlier.as_py()
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(start + bounds[:-1]), pa.array(counts), column],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    kind = "binary" if packed else "array<int>"
    return blocks.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids {kind}")
