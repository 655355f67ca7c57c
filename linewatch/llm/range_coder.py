"""Files of token ids, entropy-coded in blocks that stand alone.

Every block starts from a blank model and carries its checksum, so any one can be read, checked or
lost without the others. Inside a block ids are coded one by one. Two predictions, the id that last
followed the two ids before (order 2) and the one before (order 1), come with a confidence. How
likely either is right, or neither, is mixed from what each confidence has meant so far, and the
mixing weights follow which of them has been the better guide. An id that neither predicts is coded
by four 16-way choices from adaptive order-0 frequencies. The resulting probabilities drive a range
coder with 48-bit intervals and carries.

Blocks are coded side by side, an id of each at a time, as numpy vectors. All arithmetic is on
whole numbers, so a file reads the same on every machine.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linewatch.llm import tokens
from linewatch.llm.common import prepare, staged, table
from linewatch.session import scratch_path

#: Ids of a block, and blocks coded side by side: 4 million ids, 16 MB, are held before coding, and
#: the model of as many blocks, 51 MB. Half as many take almost as long.
BLOCK, LANES = 4096, 1024
END = 2

_TOTAL_BITS = 15
_TOTAL = 1 << _TOTAL_BITS
_MASK48, _LOW_RANGE = np.uint64((1 << 48) - 1), np.uint64(1 << 32)
_U16, _U32, _U15 = (np.uint64(x) for x in (16, 32, _TOTAL_BITS))
_LEAVES = 1024                       # hashed rows for the last four bits of an id
_DEPTHS = np.array([[0], [1], [17], [273]])  # where the rows of each four bits start in the order-0 tree
_ABOVE, _OWN = np.array([[16], [12], [8], [4]]), np.array([[12], [8], [4], [0]])  # shifts of an id
_LITERAL = 273 + _LEAVES             # rows of the order-0 tree
_LEAF = 2654435761 % _LEAVES
_ROUTE = 2 * 16                      # a row for each confidence of either prediction
_SLOTS = 1024
_MOST = 15                           # highest confidence
_FIELDS = 4                          # of a route: where its three symbols start, and the last one's end
_EVEN = (np.arange(16) * (_TOTAL // 16)).astype(np.int16)
#: Where frequencies move when a symbol is seen; each other symbol keeps one part of the total.
_TARGET = np.array([[j if j <= s else _TOTAL - 16 + j for j in range(16)] for s in range(16)],
                   np.int16)
#: The same of a route, whose other symbols are never seen, as one number.
_ROUTE_TARGET = np.ascontiguousarray(_TARGET[:3, :_FIELDS]).view(np.int64)[:, 0]
#: The next confidence, from 16 on if the prediction was right, where guesses have it.
_SURE = np.array([*(x >> 1 for x in range(16)), *(min(x + 1, _MOST) for x in range(16))], np.int32) << 16


class Encoder:
    """The range coder of some lanes, writing 16-bit words. Room for words grows as they are
    written: what a lane takes at worst is many times what it usually takes. A carry stays in the
    word that is written next and moves on at the end."""

    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, _MASK48)
        self.out, self.at = np.zeros(lanes * words, np.uint32), np.arange(lanes) * words
        self.begin, self.words = self.at.copy(), words

    def make_room(self, words: int) -> None:
        """Let every lane write so many words more."""
        needed = int((self.at - self.begin).max(initial=0)) + words
        if needed > self.words:
            lanes, most = len(self.low), max(needed, self.words * 3 // 2)
            wider = np.zeros((lanes, most), np.uint32)
            wider[:, : self.words] = self.out.reshape(lanes, self.words)
            begin = np.arange(lanes) * most
            self.at += begin - self.begin
            self.out, self.begin, self.words = wider.reshape(-1), begin, most

    def put(self, lanes: np.ndarray | slice, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Codes some symbols of each of these lanes, a row of starts and sizes after the other."""
        low, rng, at = (x[lanes] for x in (self.low, self.range, self.at))
        for start, size in zip(starts.astype(np.uint64), sizes.astype(np.uint64), strict=True):
            rng >>= _U15
            start *= rng
            low += start
            rng *= size
            full = (rng < _LOW_RANGE).nonzero()[0]
            some, here = low.take(full), at.take(full)
            self.out[here] = some >> _U32
            here += 1
            at[full] = here
            some <<= _U16
            some &= _MASK48
            low[full] = some
            rng[full] = rng.take(full) << _U16
        if not isinstance(lanes, slice):
            self.low[lanes], self.range[lanes], self.at[lanes] = low, rng, at

    def finish(self) -> list[bytes]:
        self.make_room(3)
        for shift, most in ((32, 0x1FFFF), (16, 0xFFFF), (0, 0xFFFF)):
            self.out[self.at] = (self.low >> np.uint64(shift)) & np.uint64(most)
            self.at += 1
        out = self.out.reshape(len(self.low), self.words)
        while (over := out > 0xFFFF).any():
            out[over] &= 0xFFFF
            out[:, :-1] += over[:, 1:]
        return [out[i, :n].astype("<u2").tobytes() for i, n in enumerate(self.at - self.begin)]


class Decoder:
    """The same, reading. What some lanes have is taken out and put back around their symbols."""

    def __init__(self, payloads: list[bytes]):
        n, most = len(payloads), max(map(len, payloads)) // 2 + 3
        words = np.zeros((n, most), np.uint16)
        for i, p in enumerate(payloads):
            w = np.frombuffer(p, "<u2")
            words[i, : len(w)] = w
        first, second, third = words[:, :3].astype(np.uint64).T
        self.state = [first << _U32 | second << _U16 | third, np.full(n, _MASK48), np.arange(n) * most + 3]
        self.words = words.reshape(-1)

    def take(self, lanes: np.ndarray | slice) -> list[np.ndarray]:
        return [x[lanes] for x in self.state]

    def give(self, lanes: np.ndarray, held: list[np.ndarray]) -> None:
        for x, y in zip(self.state, held, strict=True):
            x[lanes] = y

    @staticmethod
    def value(held: list[np.ndarray]) -> np.ndarray:
        """Which part of the total each lane's code lies in; what is held is then a part."""
        held[1] >>= _U15
        return (held[0] // held[1]).astype(np.uint16)  # at most the total, where the last symbol is meant

    def skip(self, held: list[np.ndarray], start: np.ndarray, size: np.ndarray) -> None:
        """Goes on behind the symbol that value() was in."""
        code, rng, at = held
        code -= rng * start.astype(np.uint64)
        rng *= size.astype(np.uint64)
        full = (rng < _LOW_RANGE).nonzero()[0]
        here = at.take(full)
        some = code.take(full)
        some <<= _U16
        some |= self.words.take(here, mode="clip")  # what goes on too far is told by its checksum
        code[full] = some
        here += 1
        at[full] = here
        rng[full] = rng.take(full) << _U16


def _span(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of symbols of rows of 16 and where they are. A row starts at 0, which also ends the
    one before; behind the last row there is another 0. at moves on by one."""
    start = flat.take(at)
    at += 1
    size = flat.take(at)
    size -= start
    size &= np.int16(_TOTAL - 1)
    return start, size


def _seen(rows: np.ndarray, symbol: np.ndarray) -> None:
    change = _TARGET.take(symbol, 0)
    change -= rows
    change >>= 4
    rows += change


class Model:
    """Predictions and frequencies of all lanes."""

    def __init__(self, lanes: int):
        self.tree = np.empty((lanes * _LITERAL, 16), np.int16)
        self.tree[:] = _EVEN
        self.trees = self.tree.view("V32").reshape(-1)
        # a route's row is read and written as one number
        self.routes = np.tile(_EVEN[:_FIELDS], lanes * _ROUTE).view(np.int64)
        self.guess = np.zeros(2 * lanes * _SLOTS, np.int32)     # id | confidence << 16
        self.trust = np.full((2, lanes), 1 << 12, np.int32)     # how well each order has guided
        self.past = np.zeros((2, lanes), np.uint32)
        self.lanes = np.arange(lanes)
        self.slot = np.stack([self.lanes, self.lanes + lanes]) * _SLOTS  # of each order and lane the first
        self.row = np.stack([self.lanes * _ROUTE, self.lanes * _ROUTE + 16])
        self.root, self.field = self.lanes * _LITERAL, self.lanes * _FIELDS
        # rows that were taken out, and a 0
        self.own, self.first = np.zeros(64 * lanes + 1, np.int16), np.arange(0, 64 * lanes, 16)

    def guessed(self, n: int) -> None:
        """What the next id of the first lanes may be (near), and mixed, where the three routes
        start and the last one ends."""
        one, two = self.past[:, :n]
        at, one = np.empty((2, n), np.uint32), one * np.uint32(40503)
        np.right_shift(one, np.uint32(4), out=at[0])
        np.right_shift(one + two * np.uint32(30011), np.uint32(3), out=at[1])
        at &= np.uint32(_SLOTS - 1)
        self.at = self.slot[:, :n] + at
        held = self.guess.take(self.at)
        self.near, self.sure = held & 0xFFFF, held >> 16
        self.where = self.row[:, :n] + self.sure
        self.each = self.routes.take(self.where).view(np.int16).reshape(2, n, _FIELDS)
        trust = self.trust[:, :n]
        share = (trust[1] << 4) // (trust[0] + trust[1])
        each = self.each.transpose(0, 2, 1).astype(np.int32)
        each[1] -= each[0]
        each[1] *= share
        each[0] <<= 4
        each[0] += each[1]
        each[0] >>= 4
        self.mixed = each[0]

    def span(self, route: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(route)
        flat, at = self.mixed.reshape(-1), route * n + self.lanes[:n]
        start = flat.take(at)
        at += n
        return start, flat.take(at) - start

    def told(self, route: np.ndarray, out: np.ndarray) -> None:
        """The route and the id were these. 2: order 2 is right, 1: only order 1 is, 0: neither."""
        n = len(out)
        at = self.field[:n] + route
        each = self.each.reshape(2, n * _FIELDS)
        size = each.take(at + 1, 1)
        size -= each.take(at, 1)
        trust = self.trust[:, :n]
        change = size - trust
        change >>= 5
        trust += change
        trust |= 1
        change = _ROUTE_TARGET.take(route).view(np.int16).reshape(n, _FIELDS) - self.each
        change >>= 4
        change += self.each
        self.routes[self.where] = change.view(np.int64)[:, :, 0]
        sure = self.sure
        sure += (self.near == out).astype(np.int32) << 4
        kept = np.where(sure > 0, self.near, out)
        kept |= _SURE.take(sure)
        self.guess[self.at] = kept
        self.past[1, :n] = self.past[0, :n]
        self.past[0, :n] = out


def _active(sizes: np.ndarray) -> list[int]:
    """How many lanes, of sizes that fall, have an id at each place."""
    return (len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")).tolist()


def compress(blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of each block of ids below 2^16."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    if not len(sizes):
        return []
    most = int(sizes[0])
    ids = np.zeros((most, len(blocks)), np.uint16)
    for lane, i in enumerate(order):
        ids[: sizes[lane], lane] = blocks[i]
    model, coder = Model(len(blocks)), Encoder(len(blocks), most // 2 + 8)
    for t, n in enumerate(_active(sizes)):
        if t % 64 == 0:
            coder.make_room(64 * 5)  # an id takes five words at most
        out = ids[t, :n].astype(np.int32)
        model.guessed(n)
        one, two = model.near == out
        route = np.maximum(two.astype(np.int64) << 1, one)
        start, size = model.span(route)
        coder.put(slice(n), start[None], size[None])
        open_ = (route == 0).nonzero()[0]
        if len(open_):
            # the rows of all four choices are known, and are different ones
            id_ = out.take(open_).astype(np.int64)
            node = id_ >> _ABOVE
            node[3] *= _LEAF
            node[3] &= _LEAVES - 1
            node += _DEPTHS
            node += model.root.take(open_)
            at, symbol = node.reshape(-1), (id_ >> _OWN & 15).reshape(-1)
            rows = model.own[: 16 * len(at)].reshape(-1, 16)
            model.tree.take(at, 0, rows, "clip")
            model.own[rows.size] = 0
            start, size = _span(model.own, model.first[: len(at)] + symbol)
            coder.put(open_, start.reshape(4, -1), size.reshape(4, -1))
            _seen(rows, symbol)
            model.trees[at] = rows.view("V32").reshape(-1)
        model.told(route, out)
    out = [b""] * len(blocks)
    for i, payload in zip(order, coder.finish(), strict=True):
        out[i] = payload
    return out


def decompress(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    if not order:
        return []
    size = np.array([sizes[i] for i in order])
    ids = np.zeros((int(size[0]), len(order)), np.uint16)
    model, coder = Model(len(order)), Decoder([payloads[i] for i in order])
    for t, n in enumerate(_active(size)):
        model.guessed(n)
        held = coder.take(slice(n))
        value = coder.value(held)
        route = (model.mixed[1] <= value).astype(np.int64)
        route += model.mixed[2] <= value
        coder.skip(held, *model.span(route))
        out = np.where(route == 2, model.near[1], model.near[0])
        open_ = (route == 0).nonzero()[0]
        if len(open_):
            # rows are numbered as in a heap: below row k are 16 k + 1 and so on; they are different ones
            held, root, node = coder.take(open_), model.root.take(open_), np.zeros(len(open_), np.int64)
            at, symbol = np.empty((4, len(open_)), np.int64), np.empty((4, len(open_)), np.int64)
            every = model.own[: 64 * len(open_)].reshape(4, -1, 16)
            model.own[every.size] = 0
            for depth in range(4):
                rows, child = every[depth], symbol[depth]
                np.add(root, node if depth < 3 else (node - 273) * _LEAF % _LEAVES + 273, out=at[depth])
                model.tree.take(at[depth], 0, rows, "clip")
                below = np.bitwise_count((rows.view(np.uint16) <= coder.value(held)[:, None]).view(np.uint64))
                np.add(below[:, 0], below[:, 1], out=child)
                node <<= 4
                node += child
                child -= 1
                # the row after these may be an old one, which starts at 0 too
                coder.skip(held, *_span(model.own[depth * rows.size:], model.first[: len(rows)] + child))
            every = every.reshape(-1, 16)
            _seen(every, symbol.reshape(-1))
            model.trees[at.reshape(-1)] = every.view("V32").reshape(-1)
            coder.give(open_, held)
            out[open_] = node - 4369
        model.told(route, out)
        ids[t, :n] = out
    back: list = [None] * len(order)
    for lane, i in enumerate(order):
        back[i] = ids[: size[lane], lane].astype(np.uint32)
    return back


def write_ids(docs: DataFrame, key: str, text: str, vocabulary: bytes, separator: str,
              path: str, end: int = END, block: int = BLOCK) -> None:
    """Writes the ids of every text, in ascending key order, to the folder `path`.

    A row of the files is a block: part and block (numbers that give the order), at (ids of the
    part before it), n_ids, first_doc (number of its first document in the part), doc_ids and
    doc_sizes (documents with ids in the block, and how many), crc32 (of the ids as little-endian
    unsigned 32-bit integers), payload. Spark's writer commits only files of tasks that ended.

    Null and empty texts are one end id. Null keys come first; repeated rows stay. Keys are spread
    by range, so a part is a share of the corpus; texts move once.
    """
    prepare(docs.sparkSession)

    def flush(part, number, at, first, ids, sizes, names, kind):
        # the blocks of whole ids; documents may lie in several
        ends = np.cumsum(sizes)
        cuts = list(range(0, len(ids), block))
        pieces = [ids[c: c + block] for c in cuts]
        payloads = []
        for i in range(0, len(pieces), LANES):
            payloads += compress(pieces[i: i + LANES])
        rows = {k: [] for k in ("first", "names", "sizes")}
        for c, p in zip(cuts, pieces, strict=True):
            a = int(np.searchsorted(ends, c, "right"))
            b = int(np.searchsorted(ends, c + len(p), "left"))
            low = np.maximum(ends[a: b + 1] - sizes[a: b + 1], c)
            rows["first"].append(first + a)
            rows["names"].append(names[a: b + 1])
            rows["sizes"].append((np.minimum(ends[a: b + 1], c + len(p)) - low).tolist())
        n = len(pieces)
        return pa.RecordBatch.from_arrays([
            pa.array([part] * n, pa.int32()), pa.array(range(number, number + n), pa.int64()),
            pa.array([at + c for c in cuts], pa.int64()),
            pa.array([len(p) for p in pieces], pa.int32()), pa.array(rows["first"], pa.int64()),
            pa.array(rows["names"], pa.list_(kind)), pa.array(rows["sizes"], pa.list_(pa.int32())),
            pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in pieces], pa.int64()),
            pa.array(payloads, pa.binary())],
            ["part", "block", "at", "n_ids", "first_doc", "doc_ids", "doc_sizes", "crc32",
             "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, "byte", separator)
        part = TaskContext.get().partitionId()
        number = at = first = 0
        held, sizes, names, kind, waiting = [], [], [], None, 0
        for batch in batches:
            keys, kind = batch.column(0).to_pylist(), batch.column(0).type
            for row, texts in tokens.batches_of(batch.column(1).to_pylist()):
                ids, ends = encoder.encode(texts, end)
                held.append(ids)
                sizes += np.diff(ends).tolist()
                names += keys[row: row + len(texts)]
                waiting += len(ids)
                if waiting >= BLOCK * LANES:
                    yield flush(part, number, at, first, np.concatenate(held),
                                np.array(sizes), names, kind)
                    number += -(-waiting // block)
                    at, first = at + waiting, first + len(names)
                    held, sizes, names, waiting = [], [], [], 0
        if names:
            yield flush(part, number, at, first, np.concatenate(held), np.array(sizes), names, kind)

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    source.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(
        run, f"part int, block long, at long, n_ids int, first_doc long, doc_ids array<{kind}>, "
             "doc_sizes array<int>, crc32 long, payload binary").write.parquet(path)


@cache
def _zeros(doublings: int) -> list[int]:
    """What 2^doublings zero bits make of each bit of a checksum."""
    if not doublings:
        return [0xEDB88320] + [1 << k for k in range(31)]
    half = _zeros(doublings - 1)
    return [_times(half, c) for c in half]


def _times(matrix: list[int], v: int) -> int:
    out, k = 0, 0
    while v:
        if v & 1:
            out ^= matrix[k]
        v, k = v >> 1, k + 1
    return out


def crc32_joined(first: int, second: int, size: int) -> int:
    """The checksum of two runs of bytes from those of both and the second's size: the first is
    moved on by that many zero bytes, in steps of powers of two."""
    bits = size * 8
    for k in range(bits.bit_length()):
        if bits >> k & 1:
            first = _times(_zeros(k), first)
    return first ^ second


def read_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """key, piece (from 0), ids, of every document of the files, checked block by block.

    A document in several blocks has several rows; part and doc number it, start says where in
    the part the piece begins. A block whose checksum differs ends the job with an error.
    """
    prepare(spark)
    blocks = spark.read.parquet(path).select(
        "part", "at", "n_ids", "first_doc", "doc_ids", "doc_sizes", "crc32", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, LANES):
                batch = whole.slice(i, LANES)
                got = decompress(batch["payload"].to_pylist(), batch["n_ids"].to_pylist())
                for ids, crc in zip(got, batch["crc32"].to_pylist(), strict=True):
                    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                        raise ValueError("a block of ids does not match its checksum")
                sizes = batch["doc_sizes"].flatten().to_numpy().astype(np.int64)
                count = np.asarray(batch["doc_sizes"].value_lengths(), np.int64)
                of = np.repeat(np.arange(len(got)), count)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                in_block = ends[:-1] - np.repeat(ends[np.cumsum(count) - count], count)
                within = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [batch["part"].take(pa.array(of)),
                     pa.array(batch["first_doc"].to_numpy()[of] + within),
                     batch["doc_ids"].flatten(), pa.array(batch["at"].to_numpy()[of] + in_block),
                     pa.ListArray.from_arrays(
                         pa.array(ends.astype(np.int32)),
                         pa.array(np.concatenate(got).view(np.int32)))],
                    ["part", "doc", "id", "start", "ids"])

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(
        run, f"part int, doc long, id {kind}, start long, ids array<int>").withColumnRenamed(
        "id", key)


def digests(pieces: DataFrame, key: str) -> DataFrame:
    """key, start (ids of all documents before), n_tokens and ids_crc32 of each document."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            flat = ids.flatten().to_numpy().astype("<i4").tobytes()
            size = np.asarray(ids.value_lengths(), np.int64)
            ends = np.cumsum(size)
            crc = [zlib.crc32(flat[4 * a: 4 * b])
                   for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(4)], pa.array(size), pa.array(crc, pa.int64())],
                ["part", "doc", "id", "start", "n", "crc"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch["pieces"].to_pylist():
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc32_joined(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(4)], pa.array(out, pa.int64())],
                ["part", "id", "start", "n_tokens", "ids_crc32"])

    kind = pieces.schema[key].dataType.simpleString()
    seen = staged(pieces.select("part", "doc", F.col(key).alias("id"), "start", "ids").mapInArrow(
        checked, f"part int, doc long, id {kind}, start long, n long, crc long"), "pieces")
    docs = seen.groupBy("part", "doc").agg(
        F.first("id").alias("id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("pieces"))
    docs = docs.select("part", "id", "start", "n_tokens", "pieces").mapInArrow(
        joined, f"part int, id {kind}, start long, n_tokens long, ids_crc32 long")
    # one row a part
    before = seen.groupBy("part").agg(F.sum("n").alias("_n")).select(
        F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"))
    return docs.join(before, F.col("part") == F.col("_part")).select(
        F.col("id").alias(key), (F.col("_before") + F.col("start")).alias("start"), "n_tokens",
        "ids_crc32")


def byte_vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    return tokens.vocabulary(public_tokenizers.path("byte_bpe_50k.json")), "<|endoftext|>"


def op5_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), "doc_id", "text", *byte_vocabulary(), path)
    return digests(read_ids(spark, path, "doc_id"), "doc_id")
