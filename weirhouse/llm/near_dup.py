"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct five-word shingles (fewer words: the whole sequence), as
64-bit hashes.  Each of 128 buckets keeps the least hash dealt to it, compressed to 16 bits: the
count of leading zeros and ten mantissa bits.  An empty bucket borrows from another one in a fixed
random order.  Documents with equal sets form a class, and only classes go on.

Bands of four registers bring classes together in groups.  Inside a group, similarity is
estimated from equal registers, corrected for chance collisions.  In two rounds every class proposes its
most similar partner, then its eight most similar ones, of other components whose estimate comes within four standard
errors of the threshold, by its registers and by a longer signature of 512 bytes; proposals are checked once,
exactly, on the full sets.  Links found merge components.  Groups with further candidates get their sets and check
all that are left where they meet; a group hands on only links that join components it did not know to be one, fewer
than it has classes.  A pair at the threshold shares a band with a
probability of 1 - 5e-6, and each estimate is that low with one of about 3e-5; nothing else is missed.

Skew: exact copies are collapsed with partial sums.  A group larger than ``block`` is split in
blocks, and each pair of blocks is a task of its own.  Components are label joins on written tables.

Null, empty and word-less texts have empty sets, linked with nothing.  Rows with a null id are linked
with nothing and kept.  Repeated rows: each is returned, with the component of its text; texts
that lead classes under one id count as linked.  An empty table gives no rows.  Columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirhouse.llm.common import drop_caches, quoted, ship, sliced, texts_of, write_once

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
BAND = 4
MANTISSA = 10
VALUE_BITS = 57
SLICE_BYTES = 4 << 20
BLOCK = 2048
MARKS = 1 << 20
SIGN_SCHEMA = "doc_id long, n_shingles long, digest1 long, digest2 long, registers binary"
LONG = 512
GROUP_COLUMNS = ["key", "band", "left", "right", "block", "rep", "n", "digest1", "digest2", "registers", "long", "component"]
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


#: Partners per class that a round proposes; after these rounds all others are checked where they meet.
PARTNERS = (1, 8)
#: Standard errors that an estimate may lie below the threshold.
ERRORS = 4
#: Pairs whose longer signatures are compared at a time.
PAIRS = 1 << 14
MULTIPLIERS = _mix(np.arange(1, SHINGLE + 2, dtype=np.uint64)) | _U(1)


def _borrow(registers: int) -> np.ndarray:
    """Where an empty bucket borrows from: random tries, then all buckets in order."""
    tries = _mix(np.arange(registers * 64, dtype=np.uint64) + _U(99)).reshape(registers, 64) % _U(registers)
    return np.concatenate([tries.astype(np.int64), (np.arange(registers)[:, None] + np.arange(registers)) % registers], axis=1)


BORROW = {r: _borrow(r) for r in (REGISTERS, LONG)}


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    split = [t.lower().split() for t in texts]  # on bytes, only A-Z are lowered
    flat = [w for words in split for w in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in number], np.uint64)
    h = hashes[np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))] if flat else np.zeros(0, np.uint64)
    out, at = [], 0
    with np.errstate(over="ignore"):
        for words in split:
            n = len(words)
            own, at = h[at : at + n], at + n
            m = min(n, SHINGLE)
            if not n:
                out.append(own)
                continue
            s = np.zeros(n - m + 1, np.uint64) + _U(m) * MULTIPLIERS[SHINGLE]
            for j in range(m):
                s += own[j : n - m + 1 + j] * MULTIPLIERS[j]
            out.append(np.unique(_mix(s)))
    return out


def compress(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of values below 2^57, plus 1; 0 is left for empty buckets."""
    lengths = np.zeros(len(values), np.int64)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= (_U(1) << _U(step))
        lengths[big] += step
        rest[big] >>= _U(step)
    lengths += rest > 0
    zeros = VALUE_BITS - lengths
    shift = (zeros + 1).astype(np.uint64)
    mantissa = ((values << shift) & ((_U(1) << _U(VALUE_BITS)) - _U(1))) >> _U(VALUE_BITS - MANTISSA)
    return (zeros.astype(np.uint64) * _U(1 << MANTISSA) + mantissa + _U(1)).astype(np.uint16)


def signatures(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each set; all 0 for an empty set."""
    counts = np.array([len(s) for s in sets], np.int64)
    h = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    none = _U(1) << _U(VALUE_BITS)
    least = np.full(len(sets) * registers, none, np.uint64)
    np.minimum.at(least, np.repeat(np.arange(len(sets)), counts) * registers + (h & _U(registers - 1)).astype(np.int64), h >> _U(7))
    own = np.where(least < none, compress(np.minimum(least, none - _U(1))), 0).astype(np.uint16).reshape(-1, registers)
    out, some, borrow = own.copy(), np.flatnonzero(counts), BORROW[registers]
    for step in range(borrow.shape[1]):
        rows, cols = np.nonzero(out[some] == 0)
        if not len(rows):
            break
        out[some[rows], cols] = own[some[rows], borrow[cols, step]]
        some = some[np.unique(rows)]
    return out


def long_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``LONG`` bytes for each set, the low mantissa bits of registers from other hashes."""
    with np.errstate(over="ignore"):
        return signatures([_mix(s + _U(11)) for s in sets], LONG).astype(np.uint8)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A number for each band of each row."""
    words = np.ascontiguousarray(registers).view(np.uint64)
    return _mix(words ^ _mix(np.arange(1, words.shape[1] + 1, dtype=np.uint64))).view(np.int64)


def digests(sets: list[np.ndarray]) -> list[pa.Array]:
    with np.errstate(over="ignore"):
        one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
        two = np.array([np.bitwise_xor.reduce(_mix(s + _U(7))) if len(s) else 0 for s in sets], np.uint64)
    return [pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]


def _sign(more: list[str]):
    """Signatures of each row, beside its ``more`` columns."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            for part in sliced(batch, "text", SLICE_BYTES):
                sets = shingle_sets(texts_of(part, "text"))
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *digests(sets), pa.array([r.tobytes() for r in signatures(sets)], pa.binary())]
                yield pa.record_batch([*columns, *(part.column(c) for c in more)], names=["doc_id", "n_shingles", "digest1", "digest2", "registers", *more])

    return sign


def _matrix(column: pa.Array, kind: type = np.uint16, width: int = REGISTERS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column("registers")))
            band = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
            yield pa.record_batch({"key": pa.array(keys.ravel()), "band": pa.array(band), "rep": batch.column("rep").take(pa.array(np.repeat(np.arange(len(keys)), keys.shape[1])))})


#: Chance that registers of different values agree: same zeros (about 1 in 3) and mantissa.
COLLISION = 1 / 3 / (1 << MANTISSA)
#: That of the bytes of longer signatures.
LONG_COLLISION = 1 / 256


def estimate(equal: np.ndarray, registers: int = REGISTERS, collision: float = COLLISION) -> np.ndarray:
    return np.maximum(0.0, (equal / registers - collision) / (1 - collision))


def lowest(small: np.ndarray, registers: int) -> np.ndarray:
    """The least estimate with which a pair at the threshold is reckoned, by the size of its smaller set."""
    least = PERCENT / 100
    return least - ERRORS * np.sqrt(least * (1 - least) / np.minimum(small, registers))


def _long_fits(long: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    parts = [(long[i[at : at + PAIRS]] == long[j[at : at + PAIRS]]).sum(axis=1) for at in range(0, len(i), PAIRS)]
    equal = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return estimate(equal, LONG, LONG_COLLISION) >= lowest(np.minimum(n[i], n[j]), LONG)


def _fitting(rows: dict[str, np.ndarray], a: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal registers of all pairs of ``a`` and ``right``, and which pairs of two components may be links."""
    regs, n, comp = rows["registers"], rows["n"], rows["component"]
    equal = np.zeros((len(a), len(right)), np.int16)
    for j in range(REGISTERS):
        equal += regs[a, j][:, None] == regs[right, j][None, :]
    small, large = np.minimum(n[a][:, None], n[right][None, :]), np.maximum(n[a][:, None], n[right][None, :])
    return equal, (estimate(equal) >= lowest(small, REGISTERS)) & (100 * small >= PERCENT * large) & (comp[a][:, None] != comp[right][None, :])


def _own(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs that belong to this band, the first that both share, and may be links by their longer signatures too."""
    words = np.ascontiguousarray(rows["registers"]).view(np.uint64)  # one per band
    own = np.flatnonzero((words[i] == words[j]).argmax(axis=1) == rows["band"][0])
    return own[_long_fits(rows["long"], rows["n"], i[own], j[own])]


def _steps(rows: dict[str, np.ndarray], pair: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some rows of the left block at a time, with all of the right one."""
    left, right = np.flatnonzero(rows["block"] == pair[0]), np.flatnonzero(rows["block"] == pair[1])
    step = max(1, (1 << 18) // max(1, len(right)))
    for at in range(0, len(left), step):
        yield left[at : at + step], right


def candidates(rows: dict[str, np.ndarray], most: int, pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of one group: the ``most`` likeliest partners of each class in other components;
    whether there are more.  ``pair``: only classes of these two blocks are paired."""
    out_a, out_b, more = [], [], False
    for a, right in _steps(rows, pair):
        equal, fits = _fitting(rows, a, right)
        if most >= len(right):
            i, j = np.nonzero(fits)
            i, j = a[i], right[j]
        else:
            equal[~fits] = -1
            top = np.argpartition(-equal, most - 1, axis=1)[:, :most]
            i, j = np.nonzero(np.take_along_axis(equal, top, axis=1) >= 0)
            i, j = a[i], right[top[i, j]]
            more |= bool((fits.sum(axis=1) > most).any())
        own = _own(rows, i, j)
        out_a.append(rows["rep"][i[own]])
        out_b.append(rows["rep"][j[own]])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), False
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return np.minimum(a, b), np.maximum(a, b), more


class _Union:
    """Which of a group's classes are known to be linked, components of earlier rounds included."""

    def __init__(self, component: np.ndarray):
        _, first, at = np.unique(component, return_index=True, return_inverse=True)
        self.up = first[at]

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def exact_links(rows: dict[str, np.ndarray], pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of one group: links between classes of the two blocks that are in different components, by their
    whole sets; enough of them to join all that are linked, so fewer than the group has classes."""
    sets = [np.frombuffer(x, np.uint64) for x in rows["set"]]
    sizes = np.array([len(x) for x in sets], np.int64)
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts, mark, union = np.cumsum(sizes) - sizes, np.zeros(len(known), np.int64), _Union(rows["component"])
    out = []
    for a, right in _steps(rows, pair):
        _, fits = _fitting(rows, a, right)
        i, j = np.nonzero(fits)
        i, j = a[i], right[j]
        own = _own(rows, i, j)
        i, j = i[own], j[own]
        cuts = np.flatnonzero(np.diff(i, prepend=-1))
        for at, end in zip(cuts, np.append(cuts[1:], len(i))[: len(cuts)], strict=True):
            x = int(i[at])
            others = np.array([y for y in j[at:end].tolist() if union.top(y) != union.top(x)], np.int64)
            if not len(others):
                continue
            mine = flat[starts[x] : starts[x] + sizes[x]]
            mark[mine] = 1
            where = np.concatenate([flat[starts[y] : starts[y] + sizes[y]] for y in others])
            both = np.add.reduceat(mark[where], np.cumsum(sizes[others]) - sizes[others])
            mark[mine] = 0
            for y in others[100 * both >= PERCENT * (sizes[x] + sizes[others] - both)].tolist():
                if union.join(x, y):
                    out.append((rows["rep"][x], rows["rep"][y]))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return np.minimum(a, b), np.maximum(a, b)


def _propose(most: int | None):
    """Streams over rows sorted by group; a group's rows may span batches.  With ``most`` proposals
    (a, b) and the keys of groups that have more; with None exact links."""

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c not in ("registers", "long")}
        column["registers"] = _matrix(batch.column("registers"))
        column["long"] = _matrix(batch.column("long"), np.uint8, LONG)
        cut = np.flatnonzero(np.diff(column["key"]) | np.diff(column["left"]) | np.diff(column["right"])) + 1
        out: tuple[list, list, list] = ([], [], [])
        for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            group, pair = {c: v[a:b] for c, v in column.items()}, (int(column["left"][a]), int(column["right"][a]))
            x, y, more = (*exact_links(group, pair), False) if most is None else candidates(group, most, pair)
            out[0].append(x)
            out[1].append(y)
            out[2].append(np.full(len(x), -1, np.int64))
            if more:
                for k, v in enumerate((-1, -1, column["key"][a])):
                    out[k].append(np.array([v], np.int64))
        a, b, key = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        if len(a):
            _, first = np.unique(np.stack((a, b, key), axis=1), axis=0, return_index=True)
            a, b, key = a[first], b[first], key[first]
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b), "more": pa.array(key)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            mark = [batch.column(c).to_numpy() for c in ("key", "left", "right")]
            change = np.flatnonzero(np.diff(mark[0]) | np.diff(mark[1]) | np.diff(mark[2]))
            if held and [m[0] for m in mark] != [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in ("key", "left", "right")]:
                yield emit(_joined(held))
                held = []
            if len(change):
                done = int(change[-1]) + 1
                yield emit(_joined([*held, batch.slice(0, done)]))
                held, batch = [], batch.slice(done)
            held.append(batch)
        if held:
            yield emit(_joined(held))

    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text", SLICE_BYTES):
            sets = shingle_sets(texts_of(part, "text"))
            long = [x.tobytes() for x in long_signatures(sets)]
            yield pa.record_batch([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(long, pa.binary()), *digests(sets)], names=["rep", "set", "long", "digest1", "digest2"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            s, t = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that link the same nodes: each node but the least of a component, to that least one."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least, low = np.minimum(label[u], label[v]), label.copy()
        for side in (u, v, label[u], label[v]):
            np.minimum.at(low, side, least)
        low = low[low]
        if (low == label).all():
            rest = np.flatnonzero(label < np.arange(len(nodes)))
            return nodes[rest], nodes[label[rest]]
        label = low


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if held:
        a, b = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for all nodes of ``edges`` (a, b).

    Each partition first makes its own edges stars, which shortens chains.  Then labels fall to the
    least among neighbours, then to their label's label, until none changes."""
    edges = edges.select("a", "b").mapInArrow(_stars, "a long, b long")
    ways = F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    both = write_once(edges.select(ways).distinct(), "edges")
    labels = write_once(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component")), "labels")
    while True:
        around = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        lower = labels.join(around, labels["node"] == around["u"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("far"))
        after = write_once(lower.join(jump, F.col("mid") == F.col("at")).select("node", F.least("mid", "far").alias("component"), "old"), "labels")
        labels = after.select("node", "component")
        if after.where(F.col("component") != F.col("old")).isEmpty():
            return labels


def _blocks(bands: DataFrame, block: int) -> DataFrame:
    """(key, band, left, right, block, rep): groups of two classes or more, cut in pairs of blocks."""
    sizes = bands.groupBy("key").count().where(F.col("count") > 1)
    n = F.ceil(F.col("count") / block)
    member = bands.join(sizes, "key").select("key", "band", "rep", n.alias("n_blocks"), F.pmod(F.xxhash64("rep"), n).alias("block"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    return member.select("key", "band", "rep", "block", other.alias("other")).select("key", "band", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "rep")


def links(docs: DataFrame, signed: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rep, n, digest1, digest2) of the classes, and (node, component) of linked classes."""
    some = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    grouped = some.groupBy("n_shingles", "digest1", "digest2").agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers"))
    classes = write_once(grouped.select("rep", F.col("n_shingles").alias("n"), "digest1", "digest2", "registers"), "classes")
    bands = classes.select("rep", "registers").mapInArrow(_bands, "key long, band int, rep long")
    places = write_once(_blocks(bands, block), "places")
    needed = places.select(F.col("rep").alias("doc_id")).distinct()
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).alias("mark")
    marks = F.broadcast(needed.select(mark).distinct())  # at most MARKS numbers: spares most texts the shuffle
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    node_sets = texts.withColumn("mark", mark).join(marks, "mark", "left_semi").select("doc_id", "text").join(needed, "doc_id", "left_semi")
    sets = write_once(node_sets.mapInArrow(_sets, "rep long, set binary, long binary, digest1 long, digest2 long"), "sets")
    # An id may have several texts, not all of them leading a class; equal rows count once.
    longs = sets.groupBy("rep", "digest1", "digest2").agg(F.first("long").alias("long"))
    leaders = classes.join(longs, ["rep", "digest1", "digest2"]).select("rep", "n", "digest1", "digest2", "registers", "long")
    members = write_once(places.join(leaders, "rep"), "members")

    tested, edges, found, active = None, None, None, members
    dealt = lambda rows: rows.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    for most in (*PARTNERS, None):
        if found is None:
            labelled = active.withColumn("component", F.col("rep"))
        else:
            labelled = active.join(found, active["rep"] == found["node"], "left").withColumn("component", F.coalesce("component", "rep"))
        group = labelled.select(*GROUP_COLUMNS)
        if most is None:
            group = group.join(sets.groupBy("rep", "digest1", "digest2").agg(F.first("set").alias("set")), ["rep", "digest1", "digest2"])
            new = write_once(dealt(group).mapInArrow(_propose(None), "a long, b long, more long").select("a", "b"), "links")
        else:
            proposed = write_once(dealt(group).mapInArrow(_propose(most), "a long, b long, more long"), "proposed")
            pairs = proposed.where(F.col("a") >= 0).select("a", "b").distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = write_once(pairs, "pairs")
            with_a = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
            with_both = with_a.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b")
            new = write_once(with_both.select("a", "b", "set_a", "set_b").mapInArrow(_verify, "a long, b long"), "links")
            tested = pairs if tested is None else tested.union(pairs)
        edges = new if edges is None else edges.union(new)
        if found is None or not new.isEmpty():
            found = components(edges)
        if most is None:
            break
        more = proposed.where(F.col("a") < 0).select(F.col("more").alias("key")).distinct()
        if more.isEmpty():
            break
        active = write_once(active.join(more, "key", "left_semi"), "active")
    return classes.select("rep", "n", "digest1", "digest2"), found


def _components(docs: DataFrame, block: int) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, further columns) with n_shingles, digest1, digest2 and component_id."""
    ship(docs.sparkSession)
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    more = [c for c in rows.columns if c not in ("doc_id", "text")]
    schema = SIGN_SCHEMA + "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in more)
    signed = write_once(rows.mapInArrow(_sign(more), schema), "signatures")
    classes, found = links(rows, signed, block)
    classes = classes.withColumnRenamed("n", "n_shingles").join(found, F.col("rep") == F.col("node"), "left")
    top = classes.select("n_shingles", "digest1", "digest2", F.coalesce("component", "rep").alias("least"))
    out = signed.drop("registers").join(top, ["n_shingles", "digest1", "digest2"], "left")
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("least")).otherwise(F.col("doc_id"))
    return out.withColumn("component_id", linked).drop("least")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    found = _components(docs.select("doc_id", "text"), block).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: of those with its least id the first by set and place.

    Rows are decided one by one, so where an id repeats a text of its own stays and a copy goes.  Rows
    with a null id or without words are in no component and stay."""
    # A row's number has to be the same in each later step, so it is written with the row.
    numbered = write_once(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc")), "numbered")
    found = _components(numbered.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"), "row"), BLOCK)
    linked = found.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    first = linked.where(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(F.min(F.struct("n_shingles", "digest1", "digest2", "row")).alias("first"))
    stays = first.select(F.col("first.row").alias("row"))
    gone = linked.select("row").join(stays, "row", "left_anti")
    return numbered.join(gone, "row", "left_anti").select(*[F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns])
