"""Near-duplicate detection by circulant MinHash.

A document is its set of distinct 5-word shingles. Two permutations give every
signature coordinate: sigma places a shingle in a circle of 2^32 positions, and
pi, circularly shifted by k, gives coordinate k as the least
pi(sigma(s) + k mod 2^32) over the set. ``bands`` bands of ``rows`` coordinates
make the buckets. With 28 bands of 4, a pair at Jaccard 0.85 shares no bucket
with probability 1e-9 (4e-7 at 0.8).

Links are confirmed on the full shingle sets, without listing all pairs of a
group:

1. equal sets are one class (the group of exact copies costs one row);
2. star round: in each bucket only the pairs (member, center) are verified; the
   center is the member that sits in the fullest buckets, in a group of near
   copies the one closest to most of them;
3. components of the verified links; a bucket whose members are all in one
   component is done, as no pair in it can change anything;
4. rest round: the other buckets compare members of different components,
   block against block inside tasks. A pair is dropped only on proof: by the
   sizes, or because parity bitmaps (each shingle flips one of 1,024 bits)
   already differ in more places than the sets may. What is left is verified,
   so no link between different texts is lost to a cap. The comparisons of a
   group that one center does not explain grow with its square (spread over
   tasks, never emitted as pairs); their number has no cap.

Defined results: a null text or one without words has an empty set and links
with nothing; rows that share a doc_id are one document with several texts,
whose links are united; rows with a null doc_id have a null component and link
with nothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import releasing, text_key, written

SHINGLE = 5
THRESHOLD = 85          # percent
BANDS, ROWS = 28, 4
PARITY_WORDS = 16       # 1,024 bits
BLOCK = 1000            # members of a bucket compared at a time
SLICE_BYTES = 1 << 20   # text hashed at a time
_U = np.uint64


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_STEP = 0x9E3779B97F4A7C15 | 1
_PLACE = _mix64(np.arange(301, 301 + SHINGLE, dtype=_U)) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _sigma(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _pi(x: np.ndarray) -> np.ndarray:
    """In place, on uint32."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingles of each document. ``data``: the
    documents' UTF-8 bytes end to end; ``ends``: where each ends."""
    n_docs = len(ends)
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    edge = begins[begins < len(data)]
    first[edge] = solid[edge]  # a word never runs over the end of a document
    at = np.flatnonzero(first)
    if len(at):
        where = np.flatnonzero(solid)
        head = np.searchsorted(where, at)
        lengths = np.diff(np.append(head, len(where)))
        inside = np.arange(len(where)) - np.repeat(head, lengths)
        power = np.cumprod(np.concatenate((
            np.ones(1, _U), np.full(int(lengths.max()) - 1, _STEP & (2**64 - 1), _U))))
        word = np.add.reduceat(_BYTE[_LOWER[data[where]]] * power[inside], head)
        word = _mix64(word + lengths.astype(_U))
    else:
        word = np.zeros(0, _U)
    upto = np.searchsorted(at, ends)
    runs = max(0, len(word) - SHINGLE + 1)
    whole = np.zeros(runs, _U)
    for j in range(SHINGLE):
        whole += word[j:j + runs] * _PLACE[j]
    whole = _mix64(whole)
    lo = 0
    for d in range(n_docs):
        hi = int(upto[d])
        n = hi - lo
        if n >= SHINGLE:
            yield np.unique(whole[lo:hi - SHINGLE + 1])
        elif n:
            few = (word[lo:hi] * _PLACE[:n]).sum(dtype=_U) + _U(n)
            yield _mix64(np.array([few], _U))
        else:
            yield np.zeros(0, _U)
        lo = hi


def signature(shingles: np.ndarray, coords: int = BANDS * ROWS) -> np.ndarray:
    place = _sigma((shingles ^ (shingles >> _U(32))).astype(np.uint32))
    shift = np.arange(coords, dtype=np.uint32)
    out = np.full(coords, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(place), 512):
        np.minimum(out, _pi(place[i:i + 512, None] + shift).min(axis=0), out=out)
    return out


def _bands(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.arange(1, bands + 1, dtype=_U)
    for col in sig.reshape(bands, rows).T:
        h = _mix64(h * _U(0x9E3779B97F4A7C15) + col.astype(_U))
    return h.view(np.int64)


def _parity(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles & _U(64 * PARITY_WORDS - 1)).astype(np.int64),
                      minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingles) of a batch, a bounded slice of text at a time."""
    text = batch.column(column).fill_null("").cast(pa.large_string())
    size = pc.binary_length(text).to_numpy(zero_copy_only=False)
    lo, n = 0, len(text)
    while lo < n:
        hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:]), SLICE_BYTES, "right")))
        part = pa.concat_arrays([text.slice(lo, hi - lo)])  # its own buffers, offset 0
        ends = np.cumsum(size[lo:hi])
        raw = part.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[:int(ends[-1])] if raw else np.zeros(0, np.uint8)
        if part.offset or len(data) < int(ends[-1]) or (
                len(part) and np.frombuffer(part.buffers()[1], np.int64)[0] != 0):
            data = np.frombuffer("".join(part.to_pylist()).encode(), np.uint8)
        for k, s in enumerate(shingle_sets(data, ends)):
            yield lo + k, s
        lo = hi


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def signatures(documents: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, parity per document row."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n, key, band, par = [], [], [], []
            none = np.zeros(0, np.int64)
            for _, s in _sets(b, "text"):
                n.append(len(s))
                key.append(_set_key(s))
                band.append(_bands(signature(s, bands * rows), bands, rows) if len(s) else none)
                par.append(_parity(s) if len(s) else none)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 _lists(band), _lists(par)],
                ["doc_id", "n_shingles", "set_key", "bands", "parity"])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        releasing(run), "doc_id long, n_shingles long, set_key binary, bands array<long>, parity array<long>")


def shingles_of(documents: DataFrame) -> DataFrame:
    """set_key, shingles per document row, the empty sets left out."""
    def run(batches):
        for b in batches:
            key, sets = [], []
            for _, s in _sets(b, "text"):
                if len(s):
                    key.append(_set_key(s))
                    sets.append(s.view(np.int64))
                if sum(map(len, sets)) > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), _lists(sets)],
                                                     ["set_key", "shingles"])
                    key, sets = [], []
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), _lists(sets)],
                                                 ["set_key", "shingles"])
    return documents.select("text").mapInArrow(releasing(run), "set_key binary, shingles array<long>")


def _may_link(na, nb, threshold: int):
    """By sizes alone: the smaller set can make up enough of the union."""
    return 100 * F.least(na, nb) >= threshold * F.greatest(na, nb)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of set keys that link, on the full sets."""
    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), common.alias("both")).where(
        100 * F.col("both") >= threshold * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _near_pairs(threshold: int):
    """Of each group of bucket members, the pairs of different components that
    sizes and parity bitmaps cannot rule out."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket").to_numpy()
        comp = table.column("comp").to_numpy()
        size = table.column("n").to_numpy()
        side = table.column("side").to_numpy()
        key = table.column("set_key").to_pylist()
        bits = table.column("parity").combine_chunks().flatten().to_numpy().view(_U).reshape(-1, PARITY_WORDS)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        out_a, out_b = [], []
        for rows in np.split(order, cuts):
            if comp[rows[0]] == comp[rows].min() == comp[rows].max():
                continue
            sides = np.unique(side[rows])
            for x, i in enumerate(rows):
                others = rows[x + 1:] if len(sides) == 1 else rows[side[rows] > side[i]]
                others = others[comp[others] != comp[i]]
                if not len(others):
                    continue
                total = size[others] + size[i]
                ok = 100 * np.minimum(size[others], size[i]) >= threshold * np.maximum(size[others], size[i])
                apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
                # |A xor B| <= total * (100 - t) / (100 + t) for every link
                ok &= apart * (100 + threshold) <= total * (100 - threshold)
                for j in others[ok]:
                    a, b = sorted((key[i], key[j]))
                    out_a.append(a)
                    out_b.append(b)
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})
    return run


def connected(edges: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``edges`` (a, b): the least id it reaches.
    Least labels go to neighbours and pointers jump until nothing changes; each
    round's labels are written to the shared folder."""
    both = written(edges.where("a <> b").select("a", "b").unionByName(
        edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("comp").alias("m"))
        step = written(labels.join(near, labels["id"] == near["a"]).select(
            "id", F.least("comp", "m").alias("comp"), F.col("comp").alias("old")), "labels")
        up = step.select(F.col("id").alias("up"), F.col("comp").alias("top"))
        nxt = written(step.join(up, step["comp"] == up["up"], "left").select(
            "id", F.least("comp", F.coalesce("top", "comp")).alias("comp"), "old"), "labels")
        moved = not nxt.where("comp <> old").isEmpty()
        labels = nxt.select("id", "comp")
        if not moved:
            return labels


def near_duplicates(documents: DataFrame, threshold: int = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document row."""
    sigs = written(signatures(documents, bands, rows), "signatures")
    known = sigs.where("doc_id is not null and n_shingles > 0")
    classes = written(known.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), F.first("parity").alias("parity")), "classes")
    each = classes.select("set_key", F.explode("bands").alias("bucket"))
    full = each.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = written(each.join(full, "bucket"), "members")

    # star round
    score = members.groupBy("set_key").agg(F.sum("members").alias("score"))
    center = members.join(score, "set_key").groupBy("bucket").agg(
        F.max(F.struct("score", "set_key")).alias("c")).select("bucket", F.col("c.set_key").alias("center"))
    star = members.join(center, "bucket").where("set_key <> center").select(
        F.least("set_key", "center").alias("a"), F.greatest("set_key", "center").alias("b")).distinct()
    size = classes.select("set_key", "n")
    star = star.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where(
        _may_link(F.col("na"), F.col("nb"), threshold)).select("a", "b")
    inside = classes.join(members.select("set_key").distinct(), "set_key").select("rep").distinct()
    sets = written(shingles_of(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        inside, F.col("doc_id") == F.col("rep"), "left_semi")).dropDuplicates(["set_key"]), "sets")
    links = written(_verified(star, sets, threshold), "links")

    rep = classes.select("set_key", "rep")
    def ends(pairs):  # noqa: E306
        return pairs.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").select(
            F.col("ra").alias("a"), F.col("rb").alias("b"))
    # a doc_id with several texts unites their classes
    of_id = known.select("doc_id", "set_key").join(rep, "set_key").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("z"), F.collect_set("rep").alias("reps")).where(
        "a <> z").select("a", F.explode("reps").alias("b"))
    edges = written(ends(links).unionByName(of_id).distinct(), "links")
    comps = connected(edges)

    # rest round
    labelled = classes.join(comps, classes["rep"] == comps["id"], "left").select(
        "set_key", "n", "parity", F.coalesce("comp", "rep").alias("comp"))
    tagged = members.join(labelled.select("set_key", "comp"), "set_key")
    mixed = tagged.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(
        "lo <> hi").select("bucket")
    rest = members.join(mixed, "bucket").join(labelled, "set_key")
    parts = F.ceil(F.col("members") / BLOCK).cast("long")
    chunk = F.pmod(F.xxhash64("set_key"), parts)
    small = F.col("members") <= BLOCK
    n_rest = rest.count()
    bins = max(1, n_rest // 4000)
    rest = rest.withColumn("chunk", chunk).withColumn("other", F.explode(
        F.sequence(F.lit(0).cast("long"), parts - 1)))
    rest = rest.select(
        "bucket", "set_key", "n", "parity", "comp",
        F.when(F.col("chunk") == F.least("chunk", "other"), 0).otherwise(1).alias("side"),
        F.when(small, F.pmod(F.xxhash64("bucket"), F.lit(bins))).otherwise(F.col("bucket")).alias("g0"),
        F.when(small, -1).otherwise(F.least("chunk", "other")).alias("g1"),
        F.when(small, -1).otherwise(F.greatest("chunk", "other")).alias("g2"))
    more = rest.groupBy("g0", "g1", "g2").applyInArrow(
        lambda t: _near_pairs(threshold)(t), "a binary, b binary").distinct() if n_rest else None
    if more is not None:
        found = written(ends(_verified(more, sets, threshold)), "links")
        if not found.isEmpty():
            comps = connected(edges.unionByName(found))
    top = rep.join(comps, rep["rep"] == comps["id"], "left").select(
        "set_key", F.coalesce("comp", "rep").alias("comp"))
    return sigs.select("doc_id", "n_shingles", "set_key").join(
        top, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull(), None).otherwise(
            F.coalesce("comp", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(documents: DataFrame, threshold: int = 80) -> DataFrame:
    """One document of each group: the row whose doc_id is its component's
    least. Of rows with equal id and text one stays; rows with a null id stay.
    All columns are kept."""
    gone = near_duplicates(documents, threshold).where("not kept").select(
        F.col("doc_id").alias("_nd_id")).distinct()
    docs = documents.withColumn("_nd_key", text_key(F.col("text")))
    left = docs.join(gone, F.col("doc_id") == F.col("_nd_id"), "left_anti")
    lone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return left.withColumn("_nd_row", lone).dropDuplicates(
        ["doc_id", "_nd_key", "_nd_row"]).drop("_nd_key", "_nd_row")
