"""Exact n-gram Jaccard join by set relations: what one set's answers settle is not computed again.

Equal sets are one set. Of the others, sets that agree in a min-hash are compared with one of them,
the hub, and a link to the hub is an answer they share: a component of such links is closed, and no
pair inside it is looked at again. The rest is an index of prefixes: two sets that link share a word
sequence among the first ``n - ceil(0.8 n) + 1`` of each in one common order, rare ones first. The
lists of the index are kept by size in blocks that carry their greatest place in a prefix and the
components in them, and a set skips the blocks whose sizes or places rule a link out, or whose sets
its component already holds. Pairs whose prefixes share too little for what their sizes ask go too,
then pairs whose signatures differ in more bits than linked sets can; what is left is compared
exactly, hub by hub.

Links are between representatives of equal sets; components need no more pairs than these. Texts are
read twice: to count sequences, and to write each set's key, prefix and signature once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import (
    LOWER, as_long, gram_hashes, mix, ship, shipped, text_slices, word_bounds, word_hashes,
)
from docloom.operators.graph import components
from docloom.session import bounded_batches, cut_lineage

SHINGLE = 5
PERCENT = 80  # least similarity
SEEDS = (0x1B873593, 0x5BD1E995, 0x2545F491)  # min-hashes that find hubs
HUB_ROWS = 512  # sets compared with one hub in one task
BUCKET_POSTINGS = 2_000_000  # of prefixes, in one bucket of the index
PAIRS_HELD = 1_000_000  # pairs of a bucket before those met more than once are counted together
BROADCAST_ROWS = 1_000_000  # narrow rows, counted first, up to which a side goes to every task
COUNTED = np.uint64(int(0.4 * 2**64))  # frequencies are counted below this hash: prefixes seldom reach further
COMMON = 4  # least frequency that moves a sequence to the end of the order
MAX_COMMON = 1 << 22  # rows of the broadcast table of common sequences
BLOCK = 64  # postings of a block
SHORT = 128  # longer lists are read block by block
STEP_POSTINGS = 1 << 17  # of short lists, and pairs, looked at together
MARK = 512  # bits of the signature that goes with a set into every bucket
BATCH_BYTES = 4 << 20  # of an Arrow batch for Python
SENT_BYTES = 8 << 20  # of text whose sequences a task sends at once


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = LOWER[data]
    starts, ends, ranges = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    grams = gram_hashes(hashes, size)
    out = []
    for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        else:
            out.append(gram_hashes(hashes[a:b], b - a) ^ np.uint64(b - a) if b > a else np.empty(0, np.uint64))
    return out


def set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def signature(found: np.ndarray) -> bytes:
    """Parity of the members that fall on each of 2 n to 4 n bits. Sets that differ in d members
    differ in d bits at most, and in nearly as many when d is small."""
    width = max(MARK, 1 << int(2 * len(found) - 1).bit_length()) if len(found) else MARK
    place = (mix(found ^ np.uint64(0x7A3D9E15)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_link(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """False only where signatures prove that two sets do not link. A wide one folds to a narrow one."""
    if 100 * min(n_a, n_b) < PERCENT * max(n_a, n_b):
        return False
    x, y, width, narrow = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a), 8 * len(b)
    if width < narrow:
        x, y, width, narrow = y, x, narrow, width
    while width > narrow:
        width //= 2
        x = (x >> width) ^ (x & ((1 << width) - 1))
    shared = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))  # what linked sets have in common at least
    return (x ^ y).bit_count() <= n_a + n_b - 2 * shared


def folded(signatures: list[bytes]) -> np.ndarray:
    """The signatures, each of at least ``MARK`` bits, folded to ``MARK``, as rows of words."""
    out = np.empty((len(signatures), MARK // 64), np.uint64)
    for i, raw in enumerate(signatures):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(raw, np.uint64).reshape(-1, MARK // 64), axis=0)
    return out


def unruled(n: np.ndarray, mark: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of positions ``a`` and ``b`` their folded signatures do not rule out, as in ``may_link``."""
    both = n[a].astype(np.int64) + n[b]
    shared = -(-PERCENT * both // (100 + PERCENT))
    return np.bitwise_count(mark[a] ^ mark[b]).sum(axis=1, dtype=np.int64) <= both - 2 * shared


def described(docs: DataFrame, common, buckets: int) -> DataFrame:
    """(doc_id, sid, n, h0, h1, h2, prefix, signature): all that the join needs of each row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, levels = shipped(common)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                sets = shingle_sets(data, offsets)
                columns = np.array([[int(mix(found ^ np.uint64(s)).min()) for s in SEEDS] if len(found) else [0] * len(SEEDS)
                                    for found in sets], np.uint64).reshape(-1, len(SEEDS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array([set_key(x) for x in sets], pa.binary()),
                     pa.array([len(x) for x in sets], pa.int64()), *(as_long(columns[:, i]) for i in range(len(SEEDS))),
                     pa.array([prefix(x, ids, levels, buckets).tobytes() for x in sets], pa.binary()),
                     pa.array([signature(x) for x in sets], pa.binary())],
                    names=["doc_id", "sid", "n", *(f"h{i}" for i in range(len(SEEDS))), "prefix", "signature"])

    hashes = ", ".join(f"h{i} bigint" for i in range(len(SEEDS)))
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id bigint, sid binary, n bigint, {hashes}, prefix binary, signature binary")


def small(df: DataFrame) -> DataFrame:
    """``df``, hinted for broadcast if its rows, which are narrow, were counted as few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The (hub, doc) of ``pairs`` that signatures do not rule out."""
    marks = reps.select("rep", "n", "signature")
    sides = pairs.join(marks.toDF("hub", "n_a", "a"), "hub").join(marks.toDF("doc", "n_b", "b"), "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [may_link(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("a", "n_a", "b", "n_b")))]
            yield batch.select(["hub", "doc"]).filter(pa.array(found, pa.bool_()))

    return sides.select("hub", "doc", "a", "n_a", "b", "n_b").mapInArrow(run, "hub bigint, doc bigint")


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, z): compressed texts, for the joins that must move them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                raw = data.tobytes()
                z = [zlib.compress(raw[a:b], 1) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], pa.array(z, pa.binary())], names=["doc_id", "z"])

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id bigint, z binary")


def set_of(z: bytes) -> np.ndarray:
    data = np.frombuffer(zlib.decompress(z), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (hub, doc) of ``pairs`` that link, by comparing whole sets.

    A hub's set goes to as many tasks as its partners fill, and each partner's to one of them.
    """
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("salts"))
    sides = pairs.join(salts, "hub").select(
        "hub", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("is_hub"),
        F.col("doc").alias("rep"),
    ).unionByName(salts.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("is_hub"),
        F.col("hub").alias("rep")))
    dealt = cut_lineage(sides)
    wanted = dealt.groupBy("rep").agg(F.collect_list(F.struct("hub", "salt", "is_hub")).alias("sides")) \
        .join(reps.select("rep", "sid"), "rep")
    if dealt.count() <= BROADCAST_ROWS:  # then texts stay where they are, and most are not packed at all
        named = F.broadcast(dealt.select("rep").distinct())
        chosen = docs.select("doc_id", "text").join(named, F.col("doc_id") == F.col("rep"), "left_semi")
    else:
        chosen = docs
    rows = packed(chosen).join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "sid", "z", "sides")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, sid, z, own in zip(*(c.to_pylist() for c in batch.columns)):
                found = set_of(z)
                if set_key(found) != sid:
                    continue  # another text under the same doc_id
                raw = found.tobytes()
                step = max(1, BATCH_BYTES // max(1, len(raw)))
                for part in (own[k:k + step] for k in range(0, len(own), step)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([s["hub"] for s in part], pa.int64()), pa.array([s["salt"] for s in part], pa.int32()),
                        pa.array([s["is_hub"] for s in part], pa.bool_()), pa.array([rep] * len(part), pa.int64()),
                        pa.array([raw] * len(part), pa.binary())], names=["hub", "salt", "is_hub", "rep", "members"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub_sets = None, []
        for batch in batches:
            hubs, docs = [], []
            for hub, salt, is_hub, rep, raw in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.frombuffer(raw, np.uint64)
                if key != (hub, salt):
                    key, hub_sets = (hub, salt), []
                if is_hub:  # several, where one doc_id stands over different texts
                    hub_sets.append(found)
                elif any(similar(found, h) for h in hub_sets):
                    hubs.append(hub)
                    docs.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(docs, pa.int64())], names=["hub", "doc"])

    return rows.mapInArrow(emit, "hub bigint, salt int, is_hub boolean, rep bigint, members binary") \
        .repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("is_hub")) \
        .mapInArrow(compare, "hub bigint, doc bigint").distinct()


def common_sequences(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (see ``short_ids``), in order, and levels of the sequences found in at least ``COMMON``
    rows, or in more where that gives over ``MAX_COMMON`` of them. Counted over all rows."""
    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(held) if held else np.empty(0, np.uint64)
        bucket = (every & np.uint64(buckets - 1)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        high = (every[order] >> np.uint64(32)).astype(np.uint32)
        some = [i for i in range(buckets) if bounds[i] < bounds[i + 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([np.sort(high[bounds[i]:bounds[i + 1]]).tobytes() for i in some], pa.binary())],
            names=["bucket", "high"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                held += [found[found < COUNTED] for found in shingle_sets(data, offsets)]
                size += len(data)
                if size >= SENT_BYTES:
                    yield dealt(held)
                    held, size = [], 0
        yield dealt(held)

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        high = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["high"]])
        high.sort()
        runs = max(0, len(high) - COMMON + 1)
        kept = np.unique(high[:runs][high[COMMON - 1:] == high[:runs]])
        n = np.searchsorted(high, kept, side="right") - np.searchsorted(high, kept)
        return pa.table({"id": pa.array((kept.astype(np.int64) << 24) | bucket), "n": pa.array(n.astype(np.int64))})

    found = cut_lineage(docs.select("text").mapInArrow(emit, "bucket int, high binary")
                        .groupBy("bucket").applyInArrow(count, "id bigint, n bigint")
                        .withColumn("level", F.floor(F.log2("n")).cast("int")))
    steps = {r["level"]: r["rows"] for r in found.groupBy("level").agg(F.count("*").alias("rows")).collect()}
    least, total = max(steps, default=0) + 1, 0
    while least - 1 in steps and total + steps[least - 1] <= MAX_COMMON:
        least -= 1
        total += steps[least]
    rows = found.filter(F.col("level") >= least).select("id", F.col("level").cast("tinyint").alias("level")).toPandas()
    ids, levels = rows["id"].to_numpy(np.int64), rows["level"].to_numpy(np.int8)
    order = np.argsort(ids)
    return ids[order], levels[order]


def short_ids(found: np.ndarray, buckets: int) -> np.ndarray:
    """High half and bucket of each hash; equal for equal hashes, and seldom for others."""
    return ((found >> np.uint64(32)).astype(np.int64) << 24) | (found & np.uint64(buckets - 1)).astype(np.int64)


def prefix(found: np.ndarray, ids: np.ndarray, levels: np.ndarray, buckets: int) -> np.ndarray:
    """The hashes of ``found`` that its index entry holds."""
    own = short_ids(found, buckets)
    at = np.minimum(np.searchsorted(ids, own), max(len(ids) - 1, 0))
    level = np.where(ids[at] == own, levels[at], 0) if len(ids) else np.zeros(len(found), np.int64)
    need = len(found) + -(-PERCENT * len(found) // 100) * -1 + 1
    return found[np.lexsort((found, level))[:need]]


def pairs_of_lists(token: np.ndarray, size: np.ndarray, group: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs with equal token and different groups whose sizes and places can link.

    ``place`` is the token's in each set's common order: no more than the tokens up to it and those
    behind it can be shared. The lists come sorted by token, each by size.
    """
    def links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, m = size[a].astype(np.int64), size[b].astype(np.int64)
        most = np.minimum(place[a], place[b]) + np.minimum(n - place[a], m - place[b])
        return (group[a] != group[b]) & ((100 + PERCENT) * most >= PERCENT * (n + m))

    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    bounds = np.append(first, len(token))
    length = np.diff(bounds)
    stop = np.repeat(bounds[1:].astype(np.int32), length)
    short = np.flatnonzero(np.repeat((length > 1) & (length <= SHORT), length))
    for k in range(0, len(short), STEP_POSTINGS):
        active, step = short[k:k + STEP_POSTINGS], 1
        while len(active):
            active = active[active + step < stop[active]]
            # Sizes rise within a list: once one is too large, so are all behind it.
            active = active[100 * size[active].astype(np.int64) >= PERCENT * size[active + step].astype(np.int64)]
            found = active[links(active, active + step)]
            yield found, found + step
            step += 1
    for k in np.flatnonzero(length > SHORT).tolist():
        low, high = int(bounds[k]), int(bounds[k + 1])
        if (group[low:high] == group[low]).all():
            continue
        heads = np.arange(low, high, BLOCK)
        least = np.minimum.reduceat(group[low:high], heads - low)
        most = np.maximum.reduceat(group[low:high], heads - low)
        near, far = np.minimum.reduceat(place[low:high], heads - low), np.maximum.reduceat(place[low:high], heads - low)
        large = np.maximum.reduceat(size[low:high], heads - low)
        for i in range(low, high - 1):
            limit = 100 * int(size[i]) // PERCENT
            blocks = np.arange((i + 1 - low) // BLOCK, np.searchsorted(size[heads], limit, side="right"))
            # A block is skipped if it is all of this component, or no place in it leaves enough.
            bound = np.minimum(place[i], far[blocks]) + np.minimum(size[i] - place[i], large[blocks] - near[blocks])
            blocks = blocks[((least[blocks] != group[i]) | (most[blocks] != group[i]))
                            & ((100 + PERCENT) * bound.astype(np.int64) >= PERCENT * (int(size[i]) + size[heads[blocks]].astype(np.int64)))]
            if len(blocks):
                other = (heads[blocks][:, None] + np.arange(BLOCK)).ravel()
                other = other[(other > i) & (other < high)]
                other = other[size[other] <= limit]
                other = other[links(np.full(len(other), i), other)]
                yield np.full(len(other), i), other


def least_common(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many members the prefixes of linked sets of these sizes share at least: beyond the prefix
    that ends first, its set has ceil(0.8 n) - 1 members left to share."""
    return -(-PERCENT * (n + m) // (100 + PERCENT)) + PERCENT * -np.maximum(n, m) // 100 + 1


_ENTRY = np.dtype([("rep", "<i8"), ("root", "<i8"), ("n", "<i4"), ("mark", "<u8", (MARK // 64,))])


def open_pairs(reps: DataFrame, roots: DataFrame, buckets: int) -> DataFrame:
    """(hub, doc): pairs of representatives of different components that the index cannot rule out.

    A set's signature goes with it, so that most pairs end in the bucket where they meet: those that
    go on are few, though the pairs that meet grow with the square of a family of near copies.
    """
    rows = reps.select("rep", "n", "prefix", "signature").join(small(roots.withColumnRenamed("node", "rep")), "rep", "left") \
        .select("rep", F.coalesce("root", "rep").alias("root"), "n", "prefix", "signature")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.empty(batch.num_rows, _ENTRY)
            for name in ("rep", "root", "n"):
                table[name] = batch.column(name).to_numpy()
            table["mark"] = folded(batch.column("signature").to_pylist())
            raw = batch.column("prefix").to_pylist()
            lengths = np.array([len(p) // 8 for p in raw])
            token = np.frombuffer(b"".join(raw), np.uint64)
            owner = np.repeat(np.arange(len(raw)), lengths)
            place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            bucket = (token & np.uint64(buckets - 1)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for i in range(buckets):
                part = order[bounds[i]:bounds[i + 1]]
                if len(part):
                    used, local = np.unique(owner[part], return_inverse=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([i], pa.int32()), pa.array([(token[part] >> np.uint64(32)).astype(np.uint32).tobytes()], pa.binary()),
                        pa.array([local.astype(np.uint32).tobytes()], pa.binary()),
                        pa.array([place[part].astype(np.int32).tobytes()], pa.binary()),
                        pa.array([table[used].tobytes()], pa.binary())],
                        names=["bucket", "token", "owner", "place", "entries"])

    def met(held: list[dict]) -> Iterator[pa.RecordBatch]:
        """The pairs of one bucket, counted; those of a very full bucket in several parts."""
        entries = [np.frombuffer(r["entries"], _ENTRY) for r in held]
        table = np.concatenate(entries)
        by_size = np.argsort(table["n"], kind="stable")
        rank = np.empty(len(table), np.uint64)
        rank[by_size] = np.arange(len(table), dtype=np.uint64)
        shift = np.cumsum([0, *(len(e) for e in entries)]).tolist()
        del entries
        for r in held:
            r.pop("entries")
        table = table[by_size]
        key = np.concatenate([np.frombuffer(r["token"], np.uint32).astype(np.uint64) << np.uint64(32)
                              | rank[s:][np.frombuffer(r["owner"], np.uint32)] for r, s in zip(held, shift)])
        order = np.argsort(key)
        place = np.concatenate([np.frombuffer(r["place"], np.int32) for r in held])[order]
        held.clear()
        key = key[order]
        at, token = (key & np.uint64(0xFFFFFFFF)).astype(np.int32), (key >> np.uint64(32)).astype(np.uint32)
        del key, order, rank
        group = np.unique(table["root"], return_inverse=True)[1].astype(np.int32)[at]
        pairs, n = np.empty(0, np.int64), np.empty(0, np.int64)
        fresh, size, whole = [], 0, True

        def counted() -> tuple[np.ndarray, np.ndarray]:
            both, where = np.unique(np.concatenate([pairs, *fresh]), return_inverse=True)
            return both, np.bincount(where, np.concatenate([n, np.ones(size, np.int64)]), len(both)).astype(np.int64)

        def out(whole: bool) -> pa.RecordBatch:
            """With the bucket's whole counts, only pairs that reach their share; ``above`` is what exceeds the others'."""
            a, b = pairs >> 32, pairs & 0xFFFFFFFF
            share = -(-least_common(table["n"][a].astype(np.int64), table["n"][b].astype(np.int64)) // buckets)
            share = np.maximum(share, 1)
            kept = n >= (share if whole else 1)
            a, b, above = a[kept], b[kept], n[kept] - (share[kept] - 1 if whole else 0)
            swap = table["rep"][a] > table["rep"][b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            return pa.RecordBatch.from_arrays(
                [pa.array(table["rep"][a]), pa.array(table["rep"][b]), pa.array(table["n"][a]), pa.array(table["n"][b]), pa.array(above)],
                names=["hub", "doc", "n_hub", "n_doc", "above"])

        for a, b in pairs_of_lists(token, table["n"][at], group, place):
            a, b = at[a], at[b]
            kept = unruled(table["n"], table["mark"], a, b)
            if not kept.any():
                continue
            fresh.append(a[kept].astype(np.int64) << 32 | b[kept])
            size += len(fresh[-1])
            if size > PAIRS_HELD:
                pairs, n = counted()
                fresh, size = [], 0
                if len(pairs) > PAIRS_HELD:
                    whole = False
                    yield out(whole)
                    pairs, n = pairs[:0], n[:0]
        pairs, n = counted()
        if len(pairs):
            yield out(whole)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["bucket"] != bucket:
                    if held:
                        yield from met(held)
                    bucket, held = row["bucket"], []
                held.append(row)
        if held:
            yield from met(held)

    # Of the least number in common, one bucket holds its share: others' parts are below theirs, and a
    # pair goes on only from buckets where it reaches it.
    least = F.ceil(F.lit(PERCENT) * (F.col("n_hub") + F.col("n_doc")) / (100 + PERCENT)) \
        - F.greatest(*(F.ceil(PERCENT * F.col(c) / 100) - 1 for c in ("n_hub", "n_doc")))
    below = buckets * (F.greatest(F.ceil(least / buckets), F.lit(1)) - 1)
    return rows.mapInArrow(emit, "bucket int, token binary, owner binary, place binary, entries binary") \
        .repartition(buckets, "bucket").sortWithinPartitions("bucket") \
        .mapInArrow(meet, "hub bigint, doc bigint, n_hub int, n_doc int, above bigint") \
        .groupBy("hub", "doc", "n_hub", "n_doc").agg(F.sum("above").alias("above")) \
        .filter((F.col("hub") != F.col("doc")) & (F.col("above") + below >= least)).select("hub", "doc").distinct()


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    Null texts and texts without words have no shingles and are their own component. Rows with equal
    sets are in one component, repeated rows too. A doc_id over different texts ties them together. A row with a null doc_id is never the least of its
    component; alone, its component_id is null. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word and its space take about eight bytes; a fifth of the sequences is in prefixes.
    buckets = 1 << max(3, int(np.ceil(np.log2(max(1.0, size / 8 / 5 / BUCKET_POSTINGS)))))
    common = ship(docs.sparkSession, common_sequences(docs, buckets))
    info = cut_lineage(described(docs, common, buckets).withColumn("row", F.monotonically_increasing_id()))
    least = info.filter("n > 0 AND doc_id IS NOT NULL").groupBy("sid") \
        .agg(F.min(F.struct("doc_id", "row")).alias("x")).select("sid", F.col("x.doc_id").alias("rep"), F.col("x.row").alias("row"))
    chosen = cut_lineage(least)
    reps = info.drop("doc_id", "sid").join(small(chosen), "row")
    agree = reps.select("rep", F.posexplode(F.array(*(f"h{i}" for i in range(len(SEEDS))))).alias("i", "h"))
    hubs = agree.groupBy("i", "h").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    near = agree.join(hubs, ["i", "h"]).filter("rep <> hub").select("hub", F.col("rep").alias("doc")).distinct()
    links = cut_lineage(verified(docs, reps, cut_lineage(plausible(near, reps))))
    roots = components(links, "hub", "doc")
    rest = cut_lineage(plausible(open_pairs(reps, roots, buckets), reps))
    more = cut_lineage(verified(docs, reps, rest))
    roots = components(links.unionByName(more), "hub", "doc") if more.take(1) else roots
    named = chosen.select("sid", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("sid", F.coalesce("root", "rep").alias("component_id"))
    return info.select("doc_id", "sid", "n").join(named, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
