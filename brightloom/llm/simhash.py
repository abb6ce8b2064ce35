"""SimHash near-duplicates, linked through a grid over segment popcounts.

Fingerprint: 64 bits over the XXH64 values of 4-word shingles; links are fingerprints that differ in at most 4 bits.

Embedding: a fingerprint is cut into 32 segments of two bits, and every segment is mapped to its bit count. The Manhattan
distance of two such vectors is never above the number of differing bits. The 32 counts fall into three groups of
coordinates; a distance of at most 4 leaves a distance of at most 1 in some group. So a fingerprint is put into the grid cell
of its counts in each group and probes that cell and the cells one step up, and pairs that meet are verified by the bits.

* Equal fingerprints are one node, however many copies a text has; all counts over fingerprints, none over documents.
* A cell is compared as blocks of numpy rows; a cell with more than ``BLOCK`` fingerprints is dealt out as pairs of blocks,
  so that no task holds it whole. Each task reports a spanning forest of the verified links, not the pairs.
* Null and empty texts have fingerprint zero and link like any other. Null ids are never the smallest id unless alone.
* Shingles of long texts are hashed in slices; a text is never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from brightloom.llm.common import ascii_lower_table, id_and_text, partitions, texts_of
from brightloom.operators.components import connected_components
from brightloom.operators.joins import lookup_join
from brightloom.staging import stage

#: bits of the three coordinate groups, as (shift, segments)
GROUPS = ((0, 11), (22, 11), (44, 10))
#: fingerprints of a cell that are compared as one block
BLOCK = 4096
SEED = 42
_SLICE = 1 << 15


def text_bits(text: bytes | None, n: int, lower: bytes) -> int:
    """Fingerprint of one text, from its UTF-8 bytes."""
    words = (text or b"").translate(lower).split()  # bytes.split() cuts at space and the controls 9 to 13
    if not words:
        return 0
    count = max(1, len(words) - n + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, count, _SLICE):
        part = words[at : min(at + _SLICE, count) + n - 1]
        shingles = map(join, zip(*(part[i:] for i in range(n)))) if len(words) >= n else [join(words)]
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp): one row per row of ``docs``; digest is the MD5 of the text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = ascii_lower_table()
        for b in batches:
            texts = texts_of(b.column(1))
            bits = np.array([text_bits(t, shingle, lower) for t in texts], np.uint64).view(np.int64)
            digests = pa.array([hashlib.md5(t or b"", usedforsecurity=False).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), digests, pa.array(bits)], ["doc_id", "digest", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, digest binary, fp long")


def popcounts(fp: np.ndarray) -> np.ndarray:
    """The embedding, packed: bit counts (0 to 2) of the 32 two-bit segments, two bits each."""
    return fp - ((fp >> np.uint64(1)) & np.uint64(0x5555555555555555))


def grid_rows(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, fp, probe) rows: the own cell in each group, and probes of the cells one step up."""
    packed = popcounts(fps)
    cells, values, probes = [], [], []
    for g, (shift, segments) in enumerate(GROUPS):
        counts = [(packed >> np.uint64(shift + 2 * i)) & np.uint64(3) for i in range(segments)]
        # two bits a segment hold counts up to 2, and 3 above: one step up is always representable
        own = (packed >> np.uint64(shift)) & np.uint64((1 << (2 * segments)) - 1)
        mark = np.uint64(g << 24)
        cells.append(own | mark)
        values.append(fps)
        probes.append(np.zeros(len(fps), bool))
        for i, c in enumerate(counts):
            up = c < 2
            cells.append((own[up] + np.uint64(1 << (2 * i))) | mark)
            values.append(fps[up])
            probes.append(np.ones(int(up.sum()), bool))
    return np.concatenate(cells).astype(np.int64), np.concatenate(values), np.concatenate(probes)


def _verified(a: np.ndarray, b: np.ndarray, most: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the pairs of two blocks with at most ``most`` differing bits, compared a strip at a time."""
    u, v = a[:0], a[:0]
    strip = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), strip):
        i, j = np.nonzero(np.bitwise_count(a[at : at + strip, None] ^ b[None, :]) <= most)
        i = i + at
        keep = i < j if same else a[i] != b[j]
        u, v = np.concatenate([u, a[i[keep]]]), np.concatenate([v, b[j[keep]]])
        if len(u) > 1 << 18:
            u, v = spanning(u, v)
    return spanning(u, v)


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of a graph that are not the least of their component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        nxt = label.copy()
        np.minimum.at(nxt, la, low)
        np.minimum.at(nxt, lb, low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, label):
            break
        label = nxt
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare_cells(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    cells, fps, probes = [], [], []
    for b in batches:
        cells.append(b.column(0).to_numpy(zero_copy_only=False))
        fps.append(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        probes.append(b.column(2).to_numpy(zero_copy_only=False))
    if not cells:
        return
    cell, fp, probe = np.concatenate(cells), np.concatenate(fps), np.concatenate(probes)
    order = np.lexsort((probe, cell))
    cell, fp, probe = cell[order], fp[order], probe[order]
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    end = np.r_[start[1:], len(cell)]
    own = np.add.reduceat(~probe, start)
    us, vs, held = [], [], 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        return spanning(np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])

    # cells of one shape are compared together, rows against columns
    small = (own > 0) & (end - start <= 64) & (end - start > 1)
    for n in np.unique(end[small] - start[small]):
        at = start[small & (end - start == n)]
        for k in range(0, len(at), max(1, (1 << 20) // int(n * n))):
            rows = at[k : k + max(1, (1 << 20) // int(n * n)), None] + np.arange(n)
            x, p = fp[rows], probe[rows]
            near = np.bitwise_count(x[:, :, None] ^ x[:, None, :]) <= most
            near &= ~p[:, :, None] & (np.arange(n)[:, None] < np.arange(n)[None, :])
            c, i, j = np.nonzero(near)
            us.append(x[c, i])
            vs.append(x[c, j])
            held += len(c)
            if held > 1 << 20:
                u, v = reduced()
                us, vs, held = [u], [v], 0
    for s, e, o in zip(start[~small], end[~small], own[~small]):
        if o and e - s > 1:
            a, b = fp[s : s + o], fp[s + o : e]
            for x, y, same in ((a, a, True), (a, b, False)):
                u, v = _verified(x, y, most, same)
                us.append(u)
                vs.append(v)
                held += len(u)
            if held > 1 << 20:
                u, v = reduced()
                us, vs, held = [u], [v], 0
    u, v = reduced()
    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def _compare_split(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks of large cells: rows carry the pair's key, its side and the fingerprint; sorted by key."""
    held: dict = {}
    key = None

    def done() -> pa.RecordBatch:
        a, b = (np.array(held.get(s, []), np.int64).view(np.uint64) for s in (0, 1))
        u, v = _verified(a, b, most, False)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        for k, side, fp in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key is not None:
                    yield done()
                key, held = k, {}
            held.setdefault(side, []).append(fp)
    if key is not None:
        yield done()


def linked_pairs(fps: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """(u, v): links of a spanning forest per task, all within ``max_bits``; ``fps(fp)`` holds distinct fingerprints.

    Three groups of coordinates settle distances up to 5; more bits would need more probes.
    """
    if max_bits > 5:
        raise ValueError("three groups and one step find links of up to 5 bits")
    wide = partitions(fps)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 1 << 14):
                c, f, p = grid_rows(every[at : at + (1 << 14)])
                yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(f.view(np.int64)), pa.array(p)], ["cell", "fp", "probe"])

    rows = fps.select("fp").mapInArrow(place, "cell long, fp long, probe boolean")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("probe").cast("int")).alias("probes"))
    hot = stage(sizes.filter((F.col("n") > block) & (F.col("probes") < F.col("n"))).select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot-cells")
    if hot.isEmpty():
        return rows.repartition(wide, "cell").mapInArrow(lambda it: _compare_cells(it, max_bits), "u long, v long")
    # at most rows / block cells are hot; Spark broadcasts their table by its written size or shuffles
    marked = rows.join(hot, "cell", "left")
    usual = marked.filter("blocks is null").drop("blocks").repartition(wide, "cell").mapInArrow(lambda it: _compare_cells(it, max_bits), "u long, v long")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = marked.filter("blocks is not null").withColumn("_b", mine)
    # side 0: own rows, in block order; side 1: own rows of the same and later blocks, and all probes
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = dealt.filter("not probe").select("cell", F.explode(others).alias("j"), F.col("_b").alias("i"), F.lit(0).alias("side"), "fp")
    second = dealt.select("cell", F.col("_b").alias("j"), F.explode(others).alias("i"), F.lit(1).alias("side"), "fp")
    pairs = first.unionByName(second).withColumn("key", F.concat_ws(":", "cell", "i", "j"))
    split = (
        pairs.select("key", "side", "fp").repartition(wide, "key").sortWithinPartitions("key")
        .mapInArrow(lambda it: _compare_split(it, max_bits), "u long, v long")
    )
    return usual.unionByName(split)


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp, component_id, is_first): one row per row of ``docs``; component_id is the smallest reachable id.

    ``is_first`` marks the row of each component that has the smallest (id, digest), null ids last; rows that are equal in both
    are all marked.
    """
    marked = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "digest")
    classes = stage(marked.groupBy("fp").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    links = stage(linked_pairs(classes, max_bits), "links")
    nodes = links.select(F.col("u").alias("id")).union(links.select(F.col("v").alias("id"))).distinct()
    labels = connected_components(nodes, links).select(F.col("id").alias("fp"), "label")
    rooted = stage(classes.join(labels, "fp", "left").select("fp", "least", "n", F.coalesce("label", "fp").alias("label")), "rooted")
    least = rooted.groupBy("label").agg(F.min("least").alias("first"))
    answers = stage(rooted.join(least, "label").select("fp", "first", "n"), "answers")
    out = lookup_join(marked, answers, ["fp"], weight="n", how="inner", spread_by=["doc_id", "digest"])
    return out.select("doc_id", "digest", "fp", F.col("first")["doc_id"].alias("component_id"), (place == F.col("first")).alias("is_first"))


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, see ``near_duplicates``; all columns stay."""
    return only_first(docs, near_duplicates(docs, shingle, max_bits, id_col, text_col), id_col, text_col)


def only_first(docs: DataFrame, near: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each (doc_id, digest) that ``near`` marks as first; all columns stay."""
    last = F.lit((1 << 63) - 1)
    chosen = near.filter("is_first").select(F.coalesce("doc_id", last).alias("_id"), F.col("digest").alias("_digest")).distinct()
    packed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), last).alias("_id"), F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("_digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    numbered = packed.join(chosen, ["_id", "_digest"], "left_semi").withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_digest").orderBy("_id")))
    return numbered.filter("_n = 1").select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
