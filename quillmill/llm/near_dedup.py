r"""Near-duplicates through an LSH forest over MinHash signatures.

* Sets: A-Z lowered, words [^\x20\x09-\x0D]+, distinct shingles of five words; a text
  of fewer words is one shingle. Equal sets are one class from here on.
* Forest: TREES orders of the signatures, DEPTH values each. Neighbours in an order are
  those with a common prefix of FIRST_DEPTH values: a region.
* Candidates: inside a region, pairs whose signatures agree in at least CANDIDATE of
  their values are chained; the connected components of all chains are the clusters
  of candidates. A pair of similarity 0.75 shares no region of FIRST_DEPTH values with
  a chance of (1 - 0.75 ** 3) ** 22, 6 in a million.
* A region of more than REGION classes is chained in two rounds. The first refines it
  value by value and deals what is still larger at full depth into blocks, which finds
  most chains cheaply. The second cuts the whole region into blocks of BLOCK classes
  and lets every two blocks meet, so no pair of it is left out; only blocks that hold
  one and the same cluster of the first round need not meet.
* Links: a cluster's texts meet once, and pairs are confirmed on their full sets, those
  that are already connected excepted, beginning with the class that resembles the
  others most. A cluster beyond CLUSTER_SHINGLES or CLUSTER_CLASSES is cut into blocks
  and each pair of blocks is a group of its own, so no link is lost and no task holds
  it whole.

Defined cases: null, empty and wordless texts have an empty set, n_shingles 0, and are
linked with nothing; rows that share an id are one node; a null id has a null
component; a text may be of any length (a worker holds the whole text and its set); an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.ragged import chunks_by_size, offsets_of, worker
from quillmill.llm.spans import IS_SPACE, ROOTS, hash_spans, mix
from quillmill.session import bound_arrow_batches, cut_lineage, maybe_broadcast

SHINGLE = 5
TREES, FIRST_DEPTH, DEPTH = 22, 3, 5
SLOTS = TREES * DEPTH
REGION = 4096
#: Classes of a block of a larger region: two of them are about a region.
BLOCK = REGION // 2
#: Share of equal signature values from which a pair is a candidate: about five
#: standard deviations below 0.75 for 110 values.
CANDIDATE = 0.55
CLUSTER_SHINGLES, CLUSTER_CLASSES = 4_000_000, 6_000
CHUNK = 1_000_000  # bytes of text handled at once

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 2**32, SLOTS, dtype=np.uint32)
_MUL = _rng.integers(0, 2**32, SLOTS, dtype=np.uint32) | np.uint32(1)
_SALT = _rng.integers(0, 2**63, 16, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, and their offsets by text."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    data = _FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    word = ~IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))  # starts and ends take turns
    starts, ends = edges[0::2], edges[1::2]
    # words beyond 64 bytes are known by blake2b, others by two independent sums
    words = hash_spans(data, starts, ends, ROOTS[0], 64) ^ mix(hash_spans(data, starts, ends, ROOTS[1], 64))
    first = np.searchsorted(starts, offsets_of(lengths))  # first word of each text
    counts = np.diff(first)

    n_of = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    offsets = offsets_of(n_of)
    out = np.empty(offsets[-1], np.uint64)
    for size in range(1, SHINGLE + 1):
        mine = np.flatnonzero(counts >= SHINGLE if size == SHINGLE else counts == size)
        if not len(mine):
            continue
        at = np.repeat(first[mine] - (o := offsets_of(n_of[mine]))[:-1], n_of[mine]) + np.arange(o[-1])
        acc = np.full(len(at), _SALT[size], np.uint64)
        for k in range(size):
            acc = acc * np.uint64(0xC2B2AE3D27D4EB4F) + words[at + k]
        to = np.repeat(offsets[mine] - o[:-1], n_of[mine]) + np.arange(o[-1])
        out[to] = mix(acc)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[offsets[:-1][n_of > 0]] = True
    return out[fresh], offsets_of(fresh)[offsets] if len(out) else offsets


def all_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """shingle_sets() of more texts than are held at once, CHUNK bytes after CHUNK bytes."""
    parts = [shingle_sets(texts[i:j]) for i, j in chunks_by_size([len(t) for t in texts], CHUNK)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate([flat for flat, _ in parts]), offsets_of(np.concatenate([np.diff(o) for _, o in parts]))


def minhash(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint32 signatures (sets x SLOTS) of sets that are not empty."""
    high = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, SLOTS), np.uint32)
    for k in range(SLOTS):
        x = (high ^ _XOR[k]) * _MUL[k]
        x ^= x >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(x, offsets[:-1])
    return out


def _set_keys(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = np.diff(offsets) > 0
    keys = []
    for salt in _SALT[8:10]:
        key = np.zeros(len(full), np.uint64)
        if len(flat):
            key[full] = np.add.reduceat(mix(flat ^ salt), offsets[:-1][full])
        keys.append(key.view(np.int64))
    return keys[0], keys[1]


_SIGNED = "doc long, n int, k1 long, k2 long, trees array<long>, sig binary"


@worker("near_dedup")
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, the set's keys, a region key for each tree, and the lowest byte of each signature value."""
    for batch in batches:
        texts = batch.column(1)
        for i, j in chunks_by_size(pa.compute.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
            flat, offsets = shingle_sets([(t or "").encode() for t in texts[i:j].to_pylist()])
            n = np.diff(offsets)
            full = n > 0
            k1, k2 = _set_keys(flat, offsets)
            m = int(full.sum())
            sig = minhash(flat, np.append(offsets[:-1][full], len(flat))) if m else np.zeros((0, SLOTS), np.uint32)
            keys = np.empty((m, TREES), np.uint64)
            for t in range(TREES):
                acc = np.full(m, _SALT[10] + np.uint64(t), np.uint64)
                for d in range(FIRST_DEPTH):
                    acc = mix(acc * np.uint64(0xC2B2AE3D27D4EB4F) + sig[:, t * DEPTH + d])
                keys[:, t] = acc
            trees = pa.ListArray.from_arrays(pa.array(offsets_of(full * TREES), pa.int32()), pa.array(keys.view(np.int64).reshape(-1)))
            low = sig.astype(np.uint8).tobytes()
            sigs = pa.Array.from_buffers(
                pa.binary(), j - i, [None, pa.py_buffer(offsets_of(full * SLOTS).astype(np.int32)), pa.py_buffer(low)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int32)), pa.array(k1), pa.array(k2), trees, sigs],
                names=["doc", "n", "k1", "k2", "trees", "sig"],
            )


def _whole_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Tables of complete groups of rows, sorted by their first column, of about `limit` bytes or more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if sum(b.nbytes for b in held) > limit:
            key = batch.column(0).to_numpy()
            last = held[-1].column(0)[-1].as_py()
            cut = int(np.searchsorted(key != last, True))  # rows that still belong to the held group
            if cut < len(key):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
                continue
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _chain(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least index of each of n nodes' components, for edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _alike(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), bool)
    for s in range(0, len(i), 50_000):
        out[s : s + 50_000] = (sig[i[s : s + 50_000]] == sig[j[s : s + 50_000]]).mean(axis=1) >= CANDIDATE
    return out


@worker("near_dedup")
def _chain_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (region, rep, sig) by region -> edges (a, b) that chain the candidates of a region.

    With block and known, by region and block: what shares known is chained already, and
    where a region has two blocks, only pairs across them are compared.
    """
    for table in _whole_groups(batches, 4_000_000):
        region, rep = table.column("region").to_numpy(), table.column("rep").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, SLOTS)
        paired = "block" in table.column_names
        block, known = (table.column(c if paired else "rep").to_numpy() for c in ("block", "known"))
        heads = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        sizes = np.diff(np.append(heads, len(region)))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        small = np.repeat(sizes <= 64, sizes)
        for d in range(1, int(sizes[sizes <= 64].max(initial=1))):
            i = np.flatnonzero(small[:-d] & (region[d:] == region[:-d]))
            ok = _alike(sig, i, i + d)
            left.append(i[ok])
            right.append(i[ok] + d)
        for head, size in zip(heads[sizes > 64], sizes[sizes > 64], strict=True):
            # each class in turn against those after it that are not chained to it yet
            mine, label = sig[head : head + size], np.unique(known[head : head + size], return_inverse=True)[1]
            cut = int(np.sum(block[head : head + size] == block[head])) if paired else size
            for i in range(min(cut, size - 1)):
                after = i + 1 if cut == size else cut
                j = np.flatnonzero(label[after:] != label[i]) + after
                j = j[(mine[j] == mine[i]).mean(axis=1) >= CANDIDATE]
                if len(j):
                    left.append(np.full(len(j), head + i))
                    right.append(head + j)
                    label[np.isin(label, label[j])] = label[i]
        a, b = np.concatenate(left), np.concatenate(right)
        label = _chain(a, b, len(rep))
        # name a chain by its least class, so that trees agree on it
        low = rep.copy()
        np.minimum.at(low, label, rep)
        head = low[label]
        keep = head != rep
        yield pa.RecordBatch.from_arrays([pa.array(head[keep]), pa.array(rep[keep])], names=["a", "b"])


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @worker("near_dedup")
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (grp, rep, k1, text) by grp -> edges (a, b) from the least class to the others it is linked with."""
        for table in _whole_groups(batches, 8_000_000):
            group, rep = table.column("grp").to_numpy(), table.column("rep").to_numpy()
            flat, offsets = all_sets([(t or "").encode() for t in table.column("text").to_pylist()])
            # of rows that share an id, those whose set is the one that was signed
            mine = _set_keys(flat, offsets)[0] == table.column("k1").to_numpy()
            heads = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            a, b = [], []
            for start, stop in zip(heads[:-1], heads[1:], strict=True):
                rows = np.arange(start, stop)[mine[start:stop]]
                label = _link([flat[offsets[r] : offsets[r + 1]] for r in rows], rep[rows], percent)
                for m in np.unique(label):
                    ids = rep[rows[label == m]]
                    low = ids.min()
                    b += [x for x in ids.tolist() if x != low]
                    a += [int(low)] * (len(b) - len(a))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return confirm


def _link(sets: list[np.ndarray], ids: np.ndarray, percent: int) -> np.ndarray:
    """Labels of the components under 100 * intersection >= percent * union."""
    n = len(sets)
    label = np.arange(n)
    if n < 2:
        return label
    for same in {i: np.flatnonzero(ids == i) for i in ids[np.r_[False, np.diff(np.sort(ids)) == 0]]}.values():
        label[same] = same[0]  # rows of one id are one node
    sizes = np.array([len(s) for s in sets])
    sig = minhash(np.concatenate(sets), offsets_of(sizes)).astype(np.uint8) if n > 2 else None
    if sig is None:
        order = range(n)
    else:
        # the class that agrees most with the commonest signature values comes first
        common = np.array([np.bincount(sig[:, k], minlength=256).argmax() for k in range(SLOTS)])
        order = np.argsort(-(sig == common).sum(axis=1), kind="stable")
    for i in order:
        j = np.flatnonzero(label != label[i])
        if sig is not None and len(j):
            j = j[(sig[j] == sig[i]).mean(axis=1) >= CANDIDATE]
        for k in j[100 * np.minimum(sizes[j], sizes[i]) >= percent * np.maximum(sizes[j], sizes[i])]:
            if label[k] != label[i]:
                small, large = (sets[i], sets[k]) if sizes[i] < sizes[k] else (sets[k], sets[i])
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * both >= percent * (sizes[i] + sizes[k] - both):
                    label[label == label[k]] = label[i]
    return label


def _regions(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """region, rep, sig: the classes of each region that has several; larger ones are refined and dealt out."""

    def shared(rows: DataFrame, sizes: DataFrame) -> DataFrame:
        return rows.join(maybe_broadcast(sizes), "region")

    found = shared(rows, sizes)
    ready = found.filter(F.col("size") <= REGION).select("region", "rep", "sig")
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        large = found.filter(F.col("size") > REGION)
        if large.isEmpty():
            break
        if depth < DEPTH:
            value = F.expr(f"substring(sig, tree * {DEPTH} + {depth + 1}, 1)")
            refined = large.select("rep", "sig", "tree", F.xxhash64("region", value).alias("region"))
            found = shared(refined, _region_sizes(refined))
            ready = ready.unionByName(found.filter(F.col("size") <= REGION).select("region", "rep", "sig"))
        else:
            block = F.pmod(F.xxhash64("rep", "tree"), F.ceil(F.col("size") / REGION))
            ready = ready.unionByName(large.select(F.xxhash64("region", block).alias("region"), "rep", "sig"))
    return ready


def _region_sizes(rows: DataFrame) -> DataFrame:
    return cut_lineage(rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))


def _block_pairs(rows: DataFrame, large: DataFrame, clusters: DataFrame) -> DataFrame:
    """region, block, rep, sig, known: every two blocks of each large region as one group.

    A cluster that fills a block in a region has blocks of its own there, which need not
    meet each other; all other classes of the region share the mixed blocks.
    """
    members = cut_lineage(
        rows.join(maybe_broadcast(large.select("region")), "region")
        .join(maybe_broadcast(clusters), "rep", "left")
        .select("region", "rep", "sig", F.coalesce("cluster", "rep").alias("known"))
    )
    parts = cut_lineage(
        members.groupBy("region", "known").agg(F.count(F.lit(1)).alias("size"))
        .groupBy("region", F.when(F.col("size") >= BLOCK, F.col("known")).alias("own"))
        .agg(F.ceil(F.sum("size") / BLOCK).alias("blocks"))
    )

    def name(i: Column) -> Column:
        return F.xxhash64("region", F.coalesce("own", F.lit(-1).cast("long")), F.col("own").isNull(), i.cast("long"))

    blocks = cut_lineage(
        parts.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("region", "own", name(F.col("i")).alias("block"))
    )
    others = blocks.select("region", F.col("own").alias("own2"), F.col("block").alias("other"))
    pairs = cut_lineage(
        blocks.join(maybe_broadcast(others), "region")
        .filter("own is null or own2 is null or own <> own2")
        .select("block", F.xxhash64(F.least("block", "other"), F.greatest("block", "other")).alias("pair"))
    )
    pure = parts.filter("own is not null").withColumnRenamed("blocks", "own_blocks")
    mixed = parts.filter("own is null").select("region", F.col("blocks").alias("mixed_blocks"))
    dealt = (
        members.join(maybe_broadcast(pure.withColumn("known", F.col("own"))), ["region", "known"], "left")
        .join(maybe_broadcast(mixed), "region", "left")
        .withColumn("block", name(F.pmod(F.xxhash64("rep"), F.coalesce("own_blocks", "mixed_blocks"))))
    )
    return dealt.join(maybe_broadcast(pairs), "block").select(F.col("pair").alias("region"), "block", "rep", "sig", "known")


def _chains(classes: DataFrame) -> DataFrame:
    """rep, cluster: the components of the candidates that all regions chain."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def chained(regions: DataFrame, *order: str) -> DataFrame:
        return cut_lineage(
            regions.repartition(parts, "region").sortWithinPartitions(*order).mapInArrow(_chain_regions, "a long, b long").distinct()
        )

    def components(edges: DataFrame) -> DataFrame:
        return connected_components(edges).withColumnRenamed("component", "cluster").withColumnRenamed("node", "rep")

    rows = classes.select("rep", "sig", F.posexplode("trees").alias("tree", "region"))
    sizes = _region_sizes(rows)
    edges = chained(_regions(rows, sizes), "region")
    clusters = components(edges)
    large = sizes.filter(F.col("size") > REGION)
    if not large.isEmpty():
        more = chained(_block_pairs(rows, large, clusters), "region", "block")
        if not more.isEmpty():
            clusters = components(edges.unionByName(more))
    return clusters


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id, kept: a row for each row."""
    bound_arrow_batches(docs.sparkSession)
    signed = cut_lineage(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_sign, _SIGNED))
    # equal sets are one class, named by its least id; the copies of a set meet map-side first
    classes = cut_lineage(
        signed.filter("n > 0 and doc is not null")
        .groupBy("k1", "k2", "n")
        .agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("trees").alias("trees"), F.any_value("sig").alias("sig"))
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clusters = _chains(classes)

    members = classes.select("rep", "k1", "n").join(maybe_broadcast(clusters), "rep")
    sizes = cut_lineage(
        members.groupBy("cluster")
        .agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("size"))
        .select("cluster", F.ceil(F.greatest(F.col("shingles") / CLUSTER_SHINGLES, F.col("size") / CLUSTER_CLASSES)).alias("blocks"))
    )
    sized = members.join(maybe_broadcast(sizes), "cluster")
    # one group, or one for each pair of blocks
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    grouped = cut_lineage(
        sized.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("rep", "k1", F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("grp"), (F.col("blocks") > 1).alias("cut"))
    )
    wanted = maybe_broadcast(grouped.withColumnRenamed("rep", "doc"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).join(wanted, "doc")
    links = cut_lineage(
        texts.select("grp", F.col("doc").alias("rep"), "k1", "text")
        .repartition(parts, "grp")
        .sortWithinPartitions("grp")
        .mapInArrow(_confirm(percent), "a long, b long")
        .distinct()
    )
    if grouped.filter("cut").isEmpty():
        heads = links.select(F.col("b").alias("rep"), F.col("a").alias("component"))
    else:
        heads = connected_components(links).select(F.col("node").alias("rep"), "component")
    named = cut_lineage(
        classes.select("k1", "k2", "n", "rep", "copies")
        .join(maybe_broadcast(cut_lineage(heads)), "rep", "left")
        .filter("copies > 1 or component is not null")
        .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    )
    return (
        signed.select("doc", "n", "k1", "k2")
        .join(maybe_broadcast(named), ["k1", "k2", "n"], "left")
        .select(
            F.col("doc").alias(id_col),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )
