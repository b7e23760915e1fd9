"""Jaccard join in metric space: pivots, regions around them, exact joins inside.

A document is its set of distinct 4-word shingles; the Jaccard distance d of two
sets is a metric. Documents link at d <= eps (0.15). Equal sets are one class and
cost one row.

1. Pivots. Unrelated documents all lie at distance 1 from each other, so a pivot
   tells apart only what is near it, and every group needs one. Shingles are put in
   one order for all documents (common ones last, else by hash); linked sets share
   one of their first ``n - ceil(0.85 * n) + 1``. Of the documents that share such a
   shingle one becomes a pivot, the one in the fullest groups. A document that
   shares none links with nothing.
   Groups are kept apart by size (a factor of 0.85, and the next range).
2. Regions. A pivot's region holds the documents that share such a shingle in a
   group of that pivot, each with its distance to it: exact, but where parity
   bitmaps prove it to be 3 * eps or more. Those within eps link with the pivot. A
   region whose documents already hang together is done, since only who reaches
   whom is asked for.
3. Windows. By the triangle inequality linked documents differ by at most eps in
   their distance to a pivot. The other regions are cut into shells of width eps;
   a document goes to its own shell and, as a guest, to the next one inwards. The
   documents proven far are one shell, whose guests lie at 2 * eps or more. In
   shells of up to ``TRIED`` documents those without a possible partner by size,
   distance and bitmap leave before any set moves.
4. Recursion. Inside a shell further pivots, each farthest from the earlier ones,
   make Voronoi cells: a document is at home with its nearest pivot and replicated
   to every pivot at most 2 * eps farther away, so two linked documents meet where
   either is at home. Cells are split again until their documents hang together or
   few are left; those are compared in pairs, leaving out what sizes or parity
   bitmaps (each shingle flips one bit) rule out. A cell whose documents
   all lie alike to all pivots cannot be split and is compared so as well: its work
   grows with its square, with no cap. Shells above ``CELL`` shingles are cut into
   blocks, and each pair of blocks is one task's work, so memory is bounded.

The order of shingles needs only be the same everywhere, so common ones are marked
in a bitmap of fixed size; one that is marked by accident costs nothing but order.

Defined results: a null text or one without words has an empty set and is linked
with nothing; rows that share a doc_id are one document with several texts, whose
links are united; rows with a null doc_id have a null component and link with
nothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import written
from eventide.llm.minhash import connected

WIDTH = 4               # words of a shingle
THRESHOLD = 85          # percent
COMMON = 64             # documents that make a shingle a common one
MARKS = 1 << 22         # bits of a bitmap of shingles or sets
CELL = 1 << 21          # shingles that one task joins at a time
LEAF = 200              # documents compared in pairs
PIVOTS = 8              # pivots of a cell
PARITY = 1024           # bits of a bitmap, at least
TRIED = 1000            # documents of a shell whose bitmaps one task compares
OUTSIDE = 1000          # the shell of the documents far from a pivot
SLACK = 1e-9            # distances are rounded; windows are wider by this
PIECE = 1 << 20         # bytes of text hashed at a time
_U = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(32))


_BYTE = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]    # A-Z as a-z


class _Powers:
    """Powers of an odd base and of its inverse, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (np.concatenate((np.ones(1, _U), np.cumprod(np.full(n - 1, x, _U), dtype=_U)))
                                  for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _words(data: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """(where it begins, hash) of each word in UTF-8 bytes."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_BLANK[data]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = edge[::2], edge[1::2]
    up, down = powers.upto(len(data))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(_BYTE[data] * up, dtype=_U)))
    return begin, _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U))


def _word_hashes(raw: bytes, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """The same of a text of any length, a bounded piece at a time."""
    begins, hashes, lo = [], [], 0
    while lo < len(raw):
        after = _SPACE.search(raw, lo + PIECE)
        hi = after.start() if after else len(raw)
        begin, h = _words(np.frombuffer(raw, np.uint8, hi - lo, lo), powers)
        begins.append(begin + lo)
        hashes.append(h)
        lo = hi
    return (np.concatenate(begins), np.concatenate(hashes)) if begins else (np.zeros(0, np.int64), np.zeros(0, _U))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text its sorted distinct 64-bit shingles; with fewer words than ``width``
    the whole sequence is one. Short texts are hashed together."""
    powers = _Powers(0x9E3779B97F4A7C15)
    place = _mix(_U(0xA0761D6478BD642F) * np.arange(1, width + 1, dtype=_U)) | _U(1)
    lo = 0
    while lo < len(texts):
        raws, total = [], 0
        while lo + len(raws) < len(texts) and total < PIECE:
            raws.append((texts[lo + len(raws)] or "").encode())
            total += len(raws[-1]) + 1
        begin, h = _word_hashes(b"\n".join(raws), powers)
        runs = max(0, len(h) - width + 1)
        whole = np.zeros(runs, _U)
        for j in range(width):
            whole += h[j:j + runs] * place[j]
        whole = _mix(whole)
        first, at = 0, 0
        for raw in raws:
            at += len(raw) + 1
            last = int(np.searchsorted(begin, at))
            n = last - first
            if n >= width:
                s = np.sort(whole[first:last - width + 1])
                yield s[np.append(True, s[1:] != s[:-1])]
            elif n:
                yield _mix(np.array([(h[first:last] * place[:n]).sum(dtype=_U) + _U(n)], _U))
            else:
                yield np.zeros(0, _U)
            first = last
        lo += len(raws)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def parity(shingles: np.ndarray, bits: int | None = None) -> np.ndarray:
    """A bitmap in which each shingle flips one bit; a power of two of bits, at
    least two a shingle. Half as many bits are the exclusive or of its halves."""
    bits = bits or max(PARITY, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(_U)


def _folded(maps: list[np.ndarray]) -> np.ndarray:
    least = min(map(len, maps))
    return np.stack([np.bitwise_xor.reduce(m.reshape(-1, least), axis=0) for m in maps])


def _apart(one, other):
    """Bits in which two parity bitmaps differ, folded to one size; null where
    the sizes are more than a factor of four apart."""
    size = F.least(F.size(one), F.size(other))

    def fold(m):
        half = (F.size(m) / 2).cast("int")
        return F.when(F.size(m) > size, F.zip_with(
            F.slice(m, F.lit(1), half), F.slice(m, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(m)
    differ = F.zip_with(fold(fold(F.col(one))), fold(fold(F.col(other))), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda a, x: a + x)


def prefix(n: int, threshold: int) -> int:
    """Of two linked sets of at most ``n`` shingles in one order, so many first
    ones have one in common."""
    return n - -(-threshold * n // 100) + 1


def _marked(places, size: int = MARKS) -> np.ndarray:
    bits = np.zeros(size, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little")


def _has(marks: np.ndarray, place: np.ndarray) -> np.ndarray:
    return marks[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(20) & _U(MARKS - 1)).astype(np.int64)


def _key_place(key: bytes) -> int:
    return int.from_bytes(key[:8], "little") % MARKS


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, _U)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def common_marks(documents: DataFrame, threshold: int, width: int) -> np.ndarray:
    """Bitmap of the shingles that are among the first (by hash, half as many again
    as needed) of ``COMMON`` documents or more. Counted over all documents; the
    driver gets ``MARKS`` places at most."""
    def run(batches):
        for b in batches:
            lead = [np.zeros(0, _U)]
            for s in shingle_sets(b.column("text").to_pylist(), width):
                if len(s):
                    lead.append(s[:3 * prefix(len(s), threshold) // 2 + 1])
            token, n = np.unique(np.concatenate(lead), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])
    often = documents.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    place = F.shiftrightunsigned("token", 20).bitwiseAND(F.lit(MARKS - 1).cast("long")).cast("int")
    return _marked(often.select(place.alias("place")).distinct().toArrow().column("place").to_numpy())


def signatures(documents: DataFrame, marks: np.ndarray, threshold: int, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key, tokens (the first shingles), parity per row."""
    def run(batches):
        for b in batches:
            n, key, first, bits = [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), width):
                late = _has(marks, _place(s))
                n.append(len(s))
                key.append(set_key(s))
                first.append(np.concatenate((s[~late], s[late]))[:prefix(len(s), threshold) if len(s) else 0])
                bits.append(parity(s) if len(s) else s)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), _lists(first), _lists(bits)],
                ["doc_id", "n_shingles", "set_key", "tokens", "parity"])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, tokens array<long>, parity array<long>")


def sets_of(documents: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """(set_key, shingles), one row per set among ``keys`` (and some others, which
    fall on the same bits). No text moves."""
    def place_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                np.unique([_key_place(k) for k in b.column("set_key").to_pylist()]).astype(np.int32))], ["place"])
    wanted = _marked(keys.mapInArrow(place_of, "place int").distinct().toArrow().column("place").to_numpy())

    def run(batches):
        for b in batches:
            key, sets, total, had = [], [], 0, set()
            for s in shingle_sets(b.column("text").to_pylist(), width):
                k = set_key(s)
                if k in had:
                    continue
                had.add(k)
                if len(s) and _has(wanted, np.array([_key_place(k)]))[0]:
                    key.append(k)
                    sets.append(s)
                    total += len(s)
                if total > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), _lists(sets)], ["set_key", "shingles"])
                    key, sets, total = [], [], 0
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), _lists(sets)], ["set_key", "shingles"])
    return documents.where("doc_id is not null").select("text").mapInArrow(
        run, "set_key binary, shingles array<long>").dropDuplicates(["set_key"])


class _Joined:
    """Sets of one task: which hang together, and the links that showed it."""

    def __init__(self, sets: list[np.ndarray], groups: list, threshold: int):
        self.sets, self.threshold = sets, threshold
        self.eps = 1 - threshold / 100
        self.size = np.array([len(s) for s in sets], np.int64)
        first: dict = {}
        self.up = [first.setdefault(g, i) for i, g in enumerate(groups)]
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.root(i) for i in rows.tolist()], np.int64)

    def link(self, i: int, j: int):
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def near(self, both, total) -> np.ndarray:
        return 100 * both >= self.threshold * (total - both)

    def distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        """Of ``rows`` to a pivot; the near ones link."""
        p = self.sets[pivot]
        flat = np.concatenate([self.sets[i] for i in rows])
        at = np.searchsorted(p, flat)
        same = p[np.minimum(at, len(p) - 1)] == flat
        starts = np.cumsum(self.size[rows]) - self.size[rows]
        both = np.add.reduceat(same, starts, dtype=np.int64)
        total = self.size[rows] + len(p)
        for i in rows[self.near(both, total)].tolist():
            self.link(pivot, i)
        return 1 - both / (total - both)

    def join(self, rows: np.ndarray):
        todo = [rows]
        while todo:
            rows = todo.pop()
            roots = self.roots(rows)
            if len(rows) < 2 or (roots == roots[0]).all():
                continue
            if len(rows) <= LEAF:
                self.compare(rows)
                continue
            far, at, dist = np.full(len(rows), 2.0), int(np.argmax(self.size[rows])), []
            for _ in range(PIVOTS):
                dist.append(self.distances(rows[at], rows))
                far = np.minimum(far, dist[-1])
                at = int(np.argmax(far))
                if far[at] <= 0:
                    break
            dist = np.stack(dist)
            cells = dist <= dist.min(axis=0) + 2 * self.eps + SLACK
            cells = cells[[(dist.argmin(axis=0) == q).any() for q in range(len(dist))]]
            if cells.sum(axis=1).max() > 0.8 * len(rows):
                self.compare(rows, dist)
            else:
                todo += [rows[c] for c in cells]

    def compare(self, rows: np.ndarray, dist: np.ndarray | None = None):
        """Every pair that may change anything and that sizes, distances to pivots
        and parity bitmaps leave."""
        t = self.threshold
        order = np.argsort(self.size[rows], kind="stable")
        rows, dist = rows[order], None if dist is None else dist[:, order]
        size = self.size[rows]
        bits = _folded([parity(self.sets[i]) for i in rows])
        for x, i in enumerate(rows.tolist()):
            end = int(np.searchsorted(size, 100 * size[x] // t, "right"))
            others = np.arange(x + 1, end)
            if dist is not None and len(others):
                others = others[(np.abs(dist[:, others] - dist[:, [x]]) <= self.eps + SLACK).all(axis=0)]
            if not len(others):
                continue
            # |A xor B| <= total * (100 - t) / (100 + t) for every link
            apart = np.bitwise_count(bits[others] ^ bits[x]).sum(axis=1, dtype=np.int64)
            for j in rows[others[apart * (100 + t) <= (size[others] + size[x]) * (100 - t)]].tolist():
                if self.root(i) != self.root(j):
                    both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                    if self.near(both, len(self.sets[i]) + len(self.sets[j])):
                        self.link(i, j)


def _cells_of(table: pa.Table) -> list[np.ndarray]:
    """The rows of each cell (pivot, shell) of a table."""
    cell = np.unique(np.array([f"{p.hex()}:{s}" for p, s in zip(
        table.column("pivot").to_pylist(), table.column("shell").to_pylist(), strict=True)]), return_inverse=True)[1]
    order = np.argsort(cell, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(cell[order])) + 1)


def _may_link(threshold: int):
    """Of each cell the documents that sizes, distances to the pivot and parity
    bitmaps leave a possible partner."""
    eps = 1 - threshold / 100

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        size, comp = table.column("n").to_numpy().astype(np.int64), table.column("comp").to_numpy()
        dist = table.column("d").to_numpy(zero_copy_only=False)       # nan: far
        maps, left = table.column("parity"), np.zeros(len(size), bool)
        for rows in _cells_of(table):
            rows = rows[np.argsort(size[rows], kind="stable")]
            bits = _folded([maps[int(i)].values.to_numpy().view(_U) for i in rows])
            n = size[rows]
            for x, i in enumerate(rows.tolist()):
                others = np.arange(x + 1, int(np.searchsorted(n, 100 * n[x] // threshold, "right")))
                j = rows[others]
                others = others[(comp[j] != comp[i]) & ~(np.abs(dist[j] - dist[i]) > eps + SLACK)]
                if not len(others):
                    continue
                apart = np.bitwise_count(bits[others] ^ bits[x]).sum(axis=1, dtype=np.int64)
                hit = rows[others[apart * (100 + threshold) <= (n[others] + n[x]) * (100 - threshold)]]
                left[hit] = True
                left[i] |= bool(len(hit))
        return table.select(["pivot", "shell", "set_key", "n", "comp"]).filter(pa.array(left))
    return run


def _cell_links(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key, group = table.column("set_key").to_pylist(), table.column("comp").to_pylist()
        where: dict[bytes, int] = {}
        at = np.array([where.setdefault(k, len(where)) for k in key], np.int64)
        lists, sets, groups = table.column("shingles"), [], []
        for i in np.unique(at, return_index=True)[1]:
            sets.append(lists[int(i)].values.to_numpy().view(_U))
            groups.append(group[i])
        joined = _Joined(sets, groups, threshold)
        for rows in _cells_of(table):
            joined.join(np.unique(at[rows]))
        keys = list(where)
        return pa.table({"a": pa.array([keys[i] for i, _ in joined.links], pa.binary()),
                         "b": pa.array([keys[j] for _, j in joined.links], pa.binary())})
    return run


def jaccard_classes(documents: DataFrame, threshold: int = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links)
    per row."""
    eps = 1 - threshold / 100
    marks = common_marks(documents, threshold, width)
    sigs = written(signatures(documents, marks, threshold, width), "signatures")
    known = sigs.where("doc_id is not null and n_shingles > 0")
    classes = written(known.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"),
        F.first("parity").alias("parity")), "classes")

    # groups: a shingle and a range of sizes; a set is in the range of its size and the next
    def grouped(rows, *keys):
        full = rows.groupBy(*keys).agg(F.count("*").alias("members")).where("members > 1")
        return rows.join(full, list(keys))
    shared = grouped(classes.select("set_key", "n", F.explode("tokens").alias("token")), "token").drop("members")
    span = F.floor(F.log("n") / -F.log(F.lit(threshold / 100 - SLACK))).cast("int")
    members = written(grouped(shared.select("set_key", "token", F.explode(F.array(span, span + 1)).alias("span")),
                              "token", "span"), "members")

    # pivots, and the distances of the documents in their regions
    score = members.groupBy("set_key").agg(F.sum("members").alias("score"))
    pivots = members.join(score, "set_key").groupBy("token", "span").agg(
        F.max(F.struct("score", "set_key")).alias("p")).select("token", "span", F.col("p.set_key").alias("pivot"))
    brief = classes.select("set_key", "n", "parity")
    around = written(members.join(pivots, ["token", "span"]).where("pivot <> set_key").select(
        "pivot", "set_key").distinct().join(brief, "set_key").join(
        brief.toDF("pivot", "np", "pp"), "pivot").withColumn("apart", F.coalesce(_apart("pp", "parity"), F.lit(0))).select(
        "pivot", "set_key", "np", "n",
        (2 * F.col("apart") / (F.col("np") + F.col("n") + F.col("apart"))).alias("least")), "around")
    far = F.col("least") >= 3 * eps
    near = around.where(~far)
    sets = sets_of(documents, near.select("set_key").unionByName(near.select(F.col("pivot").alias("set_key"))), width)
    sets = written(sets, "sets")
    of_pivot = sets.select(F.col("set_key").alias("pivot"), F.col("shingles").alias("ps"))
    both = F.size(F.array_intersect("ps", "shingles"))
    region = written(near.join(sets, "set_key").join(of_pivot, "pivot").select(
        "pivot", "set_key", "np", "n", both.alias("both")), "regions")
    union = F.col("np") + F.col("n") - F.col("both")
    star = region.where(100 * F.col("both") >= threshold * union).select(
        F.col("pivot").alias("a"), F.col("set_key").alias("b"))

    rep = classes.select("set_key", "rep")

    def ends(pairs):
        return pairs.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").select(
            F.col("ra").alias("a"), F.col("rb").alias("b"))
    # a doc_id with several texts unites their classes
    of_id = known.select("doc_id", "set_key").join(rep, "set_key").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("z"), F.collect_set("rep").alias("reps")).where(
        "a <> z").select("a", F.explode("reps").alias("b"))
    edges = written(ends(star).unionByName(of_id).distinct(), "links")
    comps = connected(edges)

    # the regions that do not hang together yet, in shells around their pivots
    comp = classes.join(comps, classes["rep"] == comps["id"], "left").select(
        "set_key", F.coalesce("comp", "rep").alias("comp"))
    placed = region.select("pivot", "set_key", "n", (1 - F.col("both") / union).alias("d")).unionByName(
        around.where(far).select("pivot", "set_key", "n", F.lit(None).cast("double").alias("d"))).unionByName(
        around.select("pivot", F.col("pivot").alias("set_key"), F.col("np").alias("n"),
                      F.lit(0.0).alias("d")).distinct()).join(comp, "set_key")
    placed = written(placed, "placed")

    def mixed(rows, *keys):
        return rows.groupBy(*keys).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                       F.sum("n").alias("weight")).where("lo <> hi").select(*keys, "weight")
    own = F.floor((F.col("d") + SLACK) / eps).cast("int")
    inner = F.greatest(F.floor((F.col("d") - SLACK) / eps).cast("int") - 1, F.lit(0))
    at = F.when(F.col("d").isNull(), F.array(F.lit(OUTSIDE))).when(
        F.col("d") >= 2 * eps - SLACK, F.concat(F.sequence(inner, own), F.array(F.lit(OUTSIDE)))).otherwise(
        F.sequence(inner, own))
    shells = placed.join(mixed(placed, "pivot").select("pivot"), "pivot").withColumn("shell", F.explode(at))
    # small shells first lose the documents without a possible partner: bitmaps move, no sets
    sizes = shells.groupBy("pivot", "shell").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows")).where("lo <> hi")
    tried = written(shells.join(sizes.select("pivot", "shell", "rows"), ["pivot", "shell"]), "shells")
    some = F.col("rows") <= TRIED
    bin_of = F.pmod(F.xxhash64("pivot", "shell"), F.lit(max(1, tried.where(some).count() // (4 * TRIED))))
    able = tried.where(some).join(classes.select("set_key", "parity"), "set_key").withColumn("bin", bin_of).groupBy(
        "bin").applyInArrow(lambda t: _may_link(threshold)(t),
                            "pivot binary, shell int, set_key binary, n long, comp long")
    left = written(able.unionByName(tried.where(~some).select("pivot", "shell", "set_key", "n", "comp")), "left")
    cells = written(left.join(mixed(left, "pivot", "shell"), ["pivot", "shell"]), "cells")
    total = cells.agg(F.sum("n")).first()[0]
    if total:
        bins = max(1, total // CELL)
        blocks = F.ceil(F.col("weight") * 2 / CELL).cast("int")
        block = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
        small = F.col("weight") <= CELL
        pair = F.explode(F.when(small, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), blocks - 1)))
        cut = cells.withColumn("block", block).withColumn("other", pair).where(
            (F.col("other") < 0) | (F.col("other") != F.col("block")))
        cut = cut.select(
            "pivot", "shell", "set_key", "comp",
            F.when(small, F.pmod(F.xxhash64("pivot", "shell"), F.lit(bins))).otherwise(
                F.xxhash64("pivot", "shell")).alias("g0"),
            F.when(small, -1).otherwise(F.least("block", "other")).alias("g1"),
            F.when(small, -1).otherwise(F.greatest("block", "other")).alias("g2"))
        last = sets_of(documents, cells.select("set_key"), width)
        found = written(ends(cut.join(last, "set_key").groupBy("g0", "g1", "g2").applyInArrow(
            lambda t: _cell_links(threshold)(t), "a binary, b binary").distinct()), "links")
        if not found.isEmpty():
            comps = connected(edges.unionByName(found))
    top = rep.join(comps, rep["rep"] == comps["id"], "left").select("set_key", F.coalesce("comp", "rep").alias("comp"))
    return sigs.select("doc_id", "n_shingles", "set_key").join(top, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("comp", "doc_id")).alias("component_id"))
