"""SimHash near-duplicates through a segment-popcount embedding.

Fingerprints: a text is lower-cased in A-Z, cut into words at ASCII white space, and every run of ``words`` words (the
whole sequence if there are fewer) is hashed with XXH64; a bit of the fingerprint is 1 if it is set in over half the
hashes.  A text without words has fingerprint zero and is linked like any other.

Candidates: the 64 bits are 32 segments of two bits, and a fingerprint maps to its 32 bit counts.  The Manhattan
distance of two such vectors never exceeds the Hamming distance.  Sorting the bits inside each segment writes the counts
in unary, so that distance is the bit count of an exclusive or.  The segments form 2k blocks; of two vectors at distance
k or less at least k blocks agree, so they share a cell of one of the C(2k, k) grids that fix the counts of k blocks.
The search is exact (no cell is capped): it keeps pairs within the Manhattan bound, then those within k bits, and takes each
pair in the first grid in which it shares a cell, so no pair comes twice.

Only distinct fingerprints are joined, so exact copies never form pairs.  Cells of up to ``DENSE_CELL`` fingerprints are
joined row by row; larger ones go through blocks of arrays, from which only stars and counts come back, so a dense group
costs rows in proportion to its size, not to its square.  Components come from star contraction over
checkpointed edge tables.  Null text counts as empty.  Repeated rows and repeated ids each get their row; null ids are
kept, and are no component's id unless a component has no other.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import texts_of
from quartermaster.llm.common import cut, map_batches, schema_of
from quartermaster.session import scratch_path

SEED = 42
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
#: Fingerprints of a cell beyond which it is searched in blocks of arrays, and fingerprints of such a block on average.
DENSE_CELL, BLOCK_PRINTS = 16, 2048
#: Shingles whose bits are counted at once.
CHUNK = 100_000


def shingle_hashes(text: str, words: int) -> np.ndarray:
    w = text.encode().lower().split()  # bytes: lower() changes A-Z only, split() cuts at \x20 and \x09-\x0D
    if not w:
        return np.zeros(0, np.uint64)
    joined, h = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([h(joined, SEED)], np.uint64)
    after = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    begins, ends = [0, *after[:-words].tolist()], (after[words - 1:] - 1).tolist()
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(begins, ends)), np.uint64, len(ends))


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint: the bits set in over half the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), CHUNK):
        part = hashes[a:a + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, words: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row."""
    def run(batch):
        return {"doc_id": batch.column(key), "fp": [fingerprint(shingle_hashes(t, words)) for t in texts_of(batch, text)]}

    return map_batches(df.select(F.col(key).cast("long").alias(key), text), run, schema_of(("doc_id", T.LongType()), ("fp", T.LongType())))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segment_counts(fp: F.Column) -> F.Column:
    """The bit counts of the 32 segments in unary: each segment's two bits sorted."""
    low = F.lit(LOW_BITS)
    up = F.shiftrightunsigned(fp, 1)
    either, both = fp.bitwiseOR(up).bitwiseAND(low), fp.bitwiseAND(up).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def block_masks(max_bits: int) -> list[int]:
    """The segments of each of the 2 * max_bits blocks."""
    blocks = [0] * (2 * max_bits)
    for s in range(SEGMENTS if blocks else 0):
        blocks[s * len(blocks) // SEGMENTS] |= 3 << 2 * s
    return [signed(m) for m in blocks]


def grid_masks(max_bits: int) -> list[int]:
    """One mask for each grid: the segments of ``max_bits`` out of 2 * max_bits blocks (of all, for distance 0)."""
    return [signed(sum(c) & (1 << 64) - 1) for c in combinations(block_masks(max_bits), max_bits)] if max_bits else [-1]


def first_grid(a: F.Column, b: F.Column, max_bits: int) -> F.Column:
    """The number of the first grid in which two vectors of counts share a cell: that of their first blocks that agree."""
    if max_bits == 0:
        return F.lit(0)
    n, k = 2 * max_bits, max_bits
    agrees = [F.when(a.bitwiseXOR(b).bitwiseAND(F.lit(m)) == 0, 1).otherwise(0) for m in block_masks(max_bits)]
    number = F.lit(0)
    # grids are numbered as combinations in order: a block left out skips every combination that takes it next
    for i, here in enumerate(agrees):
        seen = sum(agrees[:i], F.lit(0))
        skipped = F.lit(0)
        for t in range(k):
            skipped = F.when(seen == t, comb(n - i - 1, k - t - 1)).otherwise(skipped)
        number = number + F.when(here == 1, 0).otherwise(skipped)
    return number


def cells_of(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(grid, cell, counts, fp): every fingerprint's cell in each grid."""
    masks = F.array(*(F.struct(F.lit(i).alias("grid"), F.lit(m).alias("mask")) for i, m in enumerate(grid_masks(max_bits))))
    cells = nodes.select("fp", segment_counts(F.col("fp")).alias("counts"), F.explode(masks).alias("g"))
    return cells.select("g.grid", F.col("counts").bitwiseAND(F.col("g.mask")).alias("cell"), "counts", "fp")


def links(cells: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in ``max_bits`` bits or fewer, each found in the first grid
    in which they share a cell."""
    a, b = cells.alias("a"), cells.alias("b")
    near = F.bit_count(F.col("a.counts").bitwiseXOR(F.col("b.counts"))) <= max_bits
    same = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    first = first_grid(F.col("a.counts"), F.col("b.counts"), max_bits) == F.col("a.grid")
    pairs = a.join(b, (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell"))
                   & (F.col("a.fp") < F.col("b.fp")) & near & same & first)
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def dense_links(cells: DataFrame, sizes: DataFrame, max_bits: int) -> DataFrame:
    """The links of dense cells without their pairs: (a, b, null) for edges that join what is linked, and (a, null, n) for
    how many fingerprints are linked to a.

    A cell's members are dealt to blocks by hash, and every two blocks of it meet in one row of at most twice a block's
    members; there the same three checks as in ``links`` run on arrays, and only a star for each part that hangs together
    and one count for each member leave it.
    """
    blocks = F.ceil(F.col("n") / BLOCK_PRINTS).cast("int")
    dealt = cells.join(sizes, ["grid", "cell"]).withColumn("own", F.pmod(F.xxhash64("fp"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    meets = dealt.groupBy("grid", "cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")).agg(
        F.collect_list(F.struct((F.col("own") == F.least("own", "other")).alias("left"), "fp")).alias("prints"))
    out = schema_of(("a", T.LongType()), ("b", T.LongType()), ("links", T.LongType()))
    masks = np.array(block_masks(max_bits), np.int64).view(np.uint64)
    grids = list(combinations(range(len(masks)), max_bits)) if max_bits else [()]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                held = batch.column("prints")[r].values
                left = held.field("left").to_numpy(zero_copy_only=False)
                fp = held.field("fp").to_numpy()
                alone = batch.column("p")[r].as_py() == batch.column("q")[r].as_py()
                a, b = (fp, fp) if alone else (fp[left], fp[~left])
                x, y = linked_pairs(a, b, alone, grids[batch.column("grid")[r].as_py()], masks, max_bits)
                if not len(x):
                    continue
                u, n = np.unique(np.concatenate([x, y]), return_counts=True)
                root = star(u, x, y)
                on = u != root
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([root[on], u])), pa.array([*u[on].tolist(), *[None] * len(u)], pa.int64()),
                                                  pa.array([*[None] * int(on.sum()), *n.tolist()], pa.int64())], names=out.names)

    return meets.select("grid", "p", "q", "prints").mapInArrow(run, out)


def linked_pairs(a: np.ndarray, b: np.ndarray, alone: bool, grid: tuple, masks: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The links between two blocks of a cell (within one, if ``alone``) whose first grid this is."""
    low = np.uint64(LOW_BITS)

    def counts(fp):
        up = fp >> np.uint64(1)
        return ((fp | up) & low) | ((fp & up & low) << np.uint64(1))

    ua, ub = a.view(np.uint64), b.view(np.uint64)
    ca, cb = counts(ua), counts(ub)
    found = []
    for s in range(0, len(a), 256):
        near = np.bitwise_count(ca[s:s + 256, None] ^ cb) <= max_bits
        near &= np.bitwise_count(ua[s:s + 256, None] ^ ub) <= max_bits
        if alone:
            near &= a[s:s + 256, None] < b
        i, j = np.nonzero(near)
        found.append((i + s, j))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    agrees = (ca[i] ^ cb[j])[:, None] & masks == 0
    first = agrees & (np.cumsum(agrees, axis=1) <= max_bits)
    own = np.zeros(len(masks), bool)
    own[list(grid)] = True
    ok = (first == own).all(axis=1) if max_bits else np.ones(len(i), bool)
    return a[i[ok]], b[j[ok]]


def star(nodes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest node connected to each of the sorted ``nodes``."""
    i, j = np.searchsorted(nodes, x), np.searchsorted(nodes, y)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all() and (label[i] == label[j]).all():
            return nodes[label]
        label = new


def roots(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge and the smallest node of its component, by alternating large and small stars.

    Each round's edges are checkpointed; it ends when a round changes nothing.
    """
    def state(e):
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    def star(directed):
        """Links each neighbour v of u to the smallest of u and its neighbours."""
        low = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return directed.join(low, "u")

    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    now = state(edges)
    while now[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        large = star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = star(down)
        edges = cut(small.select("m", "v").union(small.select("m", "u")).toDF("a", "b").filter("a < b").distinct())
        before, now = now, state(edges)
        if before == now:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def components(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first, component_id, links) of every distinct fingerprint: its smallest id, its component's smallest id, and
    how many other fingerprints are within ``max_bits`` (at most 8)."""
    if not 0 <= max_bits <= 8:
        raise ValueError("the grids are made for distances of 0 to 8 bits")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    cells = cells_of(nodes, max_bits)
    sizes = cut(cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).filter(F.col("n") > DENSE_CELL))
    pairs = cut(links(cells.join(sizes, ["grid", "cell"], "left_anti"), max_bits))
    dense = cut(dense_links(cells, sizes, max_bits))
    found = roots(pairs.union(dense.filter("b IS NOT NULL").select("a", "b")))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ends = pairs.select(F.col("a").alias("fp"), F.lit(1).cast("long").alias("n")).union(pairs.select("b", F.lit(1).cast("long"))).union(
        dense.filter("b IS NULL").select("a", "links")).groupBy("fp").agg(F.sum("n").alias("links"))
    return rooted.join(least, "root").join(ends, "fp", "left").select(
        "fp", "first", "root", "component_id", F.coalesce("links", F.lit(0)).alias("links"))


def near_duplicates(df: DataFrame, words: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint hex, component_id, links): ``links`` counts the other fingerprints within ``max_bits``."""
    prints = cut(fingerprints(df, words, key, text))
    of_print = components(prints, max_bits).select("fp", "component_id", "links")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "links")


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all its columns: one with the component's smallest id (without ids, any one row).

    Rows are numbered, so repeated ids and rows without an id are told apart; the numbered rows are written first, as
    the number must not change when a task runs again.
    """
    row = "_simhash_row"
    while row.lower() in {c.lower() for c in docs.columns}:
        row += "_"
    path = scratch_path(docs.sparkSession, "simhash-rows")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    docs_n = docs.sparkSession.read.parquet(path)
    prints = cut(map_prints(docs_n, words, row, key, text))
    of_print = components(prints.select("fp", "doc_id"), max_bits).select("fp", "root")
    ordered = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
    chosen = prints.join(of_print, "fp").groupBy("root").agg(F.min(ordered).alias("m")).select(F.col("m.n").alias(row))
    return docs_n.join(chosen, row, "left_semi").select(*docs.columns)


def map_prints(docs: DataFrame, words: int, row: str, key: str, text: str) -> DataFrame:
    """(n, doc_id, fp) of numbered rows."""
    def run(batch):
        return {"n": batch.column(row), "doc_id": batch.column(key), "fp": [fingerprint(shingle_hashes(t, words)) for t in texts_of(batch, text)]}

    return map_batches(docs.select(row, F.col(key).cast("long").alias(key), text), run,
                       schema_of(("n", T.LongType()), ("doc_id", T.LongType()), ("fp", T.LongType())))
