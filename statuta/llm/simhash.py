"""SimHash near-duplicates by a binary trie self-join (operator 1).

Equal fingerprints collapse to one vertex first. Two fingerprints that differ in at most ``budget`` bits
agree on one of ``budget + 1`` blocks, so the trie is entered once per block, with that block's bits in
front: all fingerprints of one block value are a subtrie, and the subtries of one pass are independent.
Inside a subtrie the node pairs are walked together, level by level: a pair (a, b) becomes (a0, b0) and
(a1, b1) with the same number of differing bits, (a0, b1) and (a1, b0) with one more, and is dropped
beyond the budget. A subtrie of more than ``SPLIT`` fingerprints is walked some levels down as rows, so
that its node pairs become tasks of their own. Only a spanning forest of the links found leaves a task, or,
where links are candidates that are yet to be verified, a link of each vertex.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm import near
from statuta.llm.common import connected_components, lean, materialize, table

BITS = 64
#: Fingerprints of one subtrie beyond which its node pairs are dealt to several tasks, and levels that this walks.
SPLIT, LEVELS = 50_000, 8
#: Node pairs with at most so many fingerprint pairs are compared directly; pairs of nodes and links held at once.
LEAF, FRONT, LINKS = 64, 200_000, 1_000_000
#: Shingles of a text that are hashed at once.
CHUNK = 1 << 16

_BYTE = np.arange(256, dtype=np.uint64)
#: For each byte, its eight bits as eight counters of eight bits.
_LANES = sum(((_BYTE >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i) for i in range(8))


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set."""
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return np.ascontiguousarray(sums).view(np.uint8).reshape(len(sums), BITS).sum(axis=0, dtype=np.int64)


def _mix(h: np.ndarray, table: int) -> np.ndarray:
    """The hashes of a further table: those of table 0, spread anew."""
    if not table:
        return h
    h = (h ^ np.uint64(table * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def sketch(h: np.ndarray, tables: int) -> np.ndarray:
    """The SimHash of a set of shingle hashes, for each table."""
    if not len(h):
        return np.zeros(tables, np.uint64)
    ones = np.array([sum(_ones(_mix(h[i : i + CHUNK], k)) for i in range(0, len(h), CHUNK)) for k in range(tables)])
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42, tables: int = 1) -> np.ndarray:
    """A text's SimHash over its word shingles, for each table: a bit is set if it is in over half of the hashes."""
    from xxhash import xxh64_intdigest

    w = (text or b"").lower().split()
    if not w:
        return np.zeros(tables, np.uint64)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else iter([b" ".join(w)])
    n = max(1, len(w) - words + 1)
    hashes = map(xxh64_intdigest, shingles, repeat(seed))
    ones = np.zeros((tables, BITS), np.int64)
    for left in range(n, 0, -CHUNK):
        h = np.fromiter(hashes, np.uint64, count=min(left, CHUNK))
        for k in range(tables):
            ones[k] += _ones(_mix(h, k))
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, tables: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fps (the bits of each table's fingerprint as a long); null texts count as empty, with fingerprints zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words, seed, tables) for t in b.column(1)]
            flat = pa.array(np.concatenate(fps).view(np.int64) if fps else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * tables), flat)], ["doc_id", "fps"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fps array<long>")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (vertex, root) that connect what the links a-b connect."""
    v, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(v))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    keep = root != np.arange(len(v))
    return v[keep], v[root[keep]]


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b each vertex's own to the smallest that it links to."""
    v, w = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    first = np.concatenate([[True], v[1:] != v[:-1]])
    return v[first], w[first]


def walk(fp: np.ndarray, nodes: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked fingerprints. fp is sorted within each node; nodes: rows of a's and b's range and their differing bits.

    depth: levels above the nodes. A node pair with itself stands for the pairs inside the node.
    """
    ones: dict[int, np.ndarray] = {}

    def below(level: int) -> np.ndarray:
        if level not in ones:
            bit = (fp >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        return ones[level]

    stack = [(depth, nodes)]
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > FRONT:
            stack += [(level, pairs[i : i + FRONT]) for i in range(0, len(pairs), FRONT)]
            continue
        n, m = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        leaf = (n * m <= LEAF) | (level == BITS)
        for part in _chunks(pairs[leaf], (n * m)[leaf]):
            yield from _compare(fp, part, budget)
        pairs = pairs[~leaf]
        if not len(pairs):
            continue
        count = below(level)
        alo, ahi, blo, bhi, diff = pairs.T
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        own = alo == blo
        kids = [np.stack(x, axis=1) for x in ((alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1))]
        kids.append(np.stack((amid, ahi, blo, bmid, diff + 1), axis=1)[~own])
        kids = np.concatenate(kids)
        stack.append((level + 1, kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)]))


def _chunks(pairs: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of at most LINKS fingerprint pairs, as far as single node pairs allow."""
    if len(pairs):
        part = np.cumsum(sizes) // LINKS
        yield from np.split(pairs, np.flatnonzero(np.diff(part)) + 1)


def _compare(fp: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n, m = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
    size = n * m
    of = np.repeat(np.arange(len(pairs)), size)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    i, j = pairs[of, 0] + nth // m[of], pairs[of, 2] + nth % m[of]
    near = (i != j) & (np.bitwise_count(fp[i] ^ fp[j]) <= budget)
    if near.any():
        yield i[near], j[near]


def _rotated(fp, start: int):
    """The fingerprint with the block that starts at bit ``start`` (from the top) in front."""
    return fp if not start else F.shiftleft(fp, start).bitwiseOR(F.shiftrightunsigned(fp, BITS - start))


def links(vertices: DataFrame, budget: int = 2, split: int = SPLIT, fold: Callable = forest) -> DataFrame:
    """(a, b): of the pairs of vertices (tab, v, fp) of one table whose distinct fp differ in at most budget bits, what fold leaves per task: a spanning forest."""
    starts = [round(BITS * k / (budget + 1)) for k in range(budget + 2)]
    passes = F.explode(F.array(*[F.struct(F.lit(k).alias("pass"), _rotated(F.col("fp"), s).alias("r"), F.shiftrightunsigned(_rotated(F.col("fp"), s), BITS - (e - s)).alias("block"), F.lit(e - s).alias("width")) for k, (s, e) in enumerate(zip(starts, starts[1:]))]))
    rows = vertices.select("v", "tab", passes.alias("x")).select("v", "tab", "x.*")
    large = rows.groupBy("tab", "pass", "block").agg(F.count("*").alias("n")).where(F.col("n") > split).select("tab", "pass", "block", F.lit(True).alias("large"))
    rows = rows.join(large, ["tab", "pass", "block"], "left")
    masks = [m for m in range(1 << LEVELS) if m.bit_count() <= budget]
    node = F.shiftrightunsigned(F.expr("shiftleft(r, width)"), BITS - LEVELS).cast("int")
    other = F.when(F.col("large"), F.array(*map(F.lit, masks))).otherwise(F.array(F.lit(-1)))
    rows = rows.select("v", "r", "tab", "pass", "block", "width", node.alias("node"), F.explode(other).alias("mask"))
    low = F.least(F.col("node"), F.col("node").bitwiseXOR(F.col("mask")))
    rows = rows.select("v", "r", "tab", "pass", "block", "width", F.when(F.col("mask") < 0, F.lit(-1)).otherwise(low).alias("node"), "mask", F.when(F.col("mask") > 0, (F.col("node") != low).cast("int")).otherwise(F.lit(0)).alias("side"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        t = pd.concat(got, ignore_index=True)
        t["r"] = t["r"].to_numpy().view(np.uint64)
        t = t.sort_values(["width", "mask", "tab", "pass", "block", "node", "side", "r"], ignore_index=True)
        v, fp = t["v"].to_numpy(), t["r"].to_numpy()
        key = t[["width", "mask", "tab", "pass", "block", "node"]].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        last = np.append(first[1:], len(t))
        mid = first + np.add.reduceat((t["side"].to_numpy() == 0).astype(np.int64), first)
        cross = key[first, 1] > 0
        diff = np.array([int(m).bit_count() if m > 0 else 0 for m in key[first, 1]])
        nodes = np.stack([first, mid, np.where(cross, mid, first), np.where(cross, last, mid), diff], axis=1)
        nodes = nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3])]
        depth = key[nodes[:, 0], 0] + np.where(key[nodes[:, 0], 1] >= 0, LEVELS, 0)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for d in np.unique(depth):
            for i, j in walk(fp, nodes[depth == d], int(d), budget):
                held.append((v[i], v[j]))
                size += len(i)
                if size > 4 * LINKS:
                    held = [fold(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
        if held:
            a, b = fold(*map(np.concatenate, zip(*held)))
            yield pd.DataFrame({"a": a, "b": b})

    return rows.repartition("tab", "pass", "block", "node", "mask").mapInPandas(lean(run), "a long, b long")


def _linked(same: DataFrame, budget: int, split: int, fold: Callable = forest) -> DataFrame:
    """(a, b): links of vertices (v, fps), each of fingerprints of its own, by any table."""
    tables = same.select("v", F.posexplode("fps").alias("tab", "fp"))
    # texts of different fingerprints may have equal ones in a table
    one = tables.groupBy("tab", "fp").agg(F.min("v").alias("u"))
    equal = tables.join(one, ["tab", "fp"]).where("v <> u").select(F.col("v").alias("a"), F.col("u").alias("b"))
    return links(one.select(F.col("u").alias("v"), "tab", "fp"), budget, split, fold).unionByName(equal)


def candidates(sets: DataFrame, budget: int, split: int = SPLIT) -> DataFrame:
    """(a, b): links of sets (v, fps) that are to be verified: for each set one of each table and pass it has any in."""
    same = sets.groupBy("fps").agg(F.min("v").alias("u"))
    equal = sets.join(same, "fps").where("v <> u").select(F.col("v").alias("a"), F.col("u").alias("b"))
    return equal.unionByName(_linked(same.select(F.col("u").alias("v"), "fps"), budget, split, smallest))


def _similar(docs: DataFrame, words: int, similar: float, budget: int, tables: int, split: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, component_id by the similarity of sets: links of the tries, verified, then those they can't show (see ``near``)."""
    return near.components(docs, words, similar, partial(sketch, tables=tables), partial(candidates, budget=budget, split=split), id_col, text_col)


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, budget: int = 2, tables: int = 1, split: int = SPLIT, similar: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits, of table 0), component_id: for each row the smallest id that its links reach.

    Texts link if their fingerprints of some table differ in at most ``budget`` bits; tables hash the same
    shingles independently. Null texts are empty; every text without words has fingerprints zero and links
    like any other. A row with a null id gets its fingerprint, no links, and a null component. Rows that
    repeat an id are vertices of one id, so whatever any of them links to is shared. An empty table gives
    no rows; other columns are not read. With ``similar``, those links are candidates, and texts link if their
    sets of shingles have that Jaccard similarity, whether or not their fingerprints show it (see ``near``).
    """
    if similar is not None:
        found = _similar(docs, words, similar, budget, tables, split, id_col, text_col)
        base = fingerprints(docs, words, seed, 1, id_col, text_col).join(found, "doc_id", "left")
        return base.select("doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id")
    base = materialize(fingerprints(docs, words, seed, tables, id_col, text_col))
    known = base.where(F.col("doc_id").isNotNull())
    same = known.groupBy("fps").agg(F.min("doc_id").alias("v"))
    # an id that stands on several fingerprints joins their vertices
    repeated = known.groupBy("doc_id").agg(F.min("fps").alias("lo"), F.max("fps").alias("hi")).where("lo <> hi").select("doc_id")
    edges = known.join(repeated, "doc_id").join(same, "fps").select(F.col("doc_id").alias("a"), F.col("v").alias("b"))
    if tables > 1:
        found = _linked(same, budget, split)
    else:
        found = links(same.select("v", F.posexplode("fps").alias("tab", "fp")), budget, split)
    label = connected_components(found.unionByName(edges))
    component = same.join(label, "v", "left").select("fps", F.coalesce("component", "v").alias("component_id"))
    out = base.join(component, "fps", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Of rows that repeat the smallest id one stays, that with the smallest hash of its text. Rows with a null id
    are nobody's copies and all stay. An empty table gives no rows.
    """
    if how.get("similar") is not None:
        found = _similar(docs, id_col=id_col, text_col=text_col, **({"words": 3, "budget": 2, "tables": 1, "split": SPLIT} | how))
    else:
        found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    drop = found.where("component_id < doc_id").select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(drop, F.col(id_col) == F.col("__id"), "left_anti")
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    # rows without an id are spread by their texts and none is left out
    place = F.row_number().over(Window.partitionBy(id_col, F.when(F.col(id_col).isNull(), text)).orderBy(text))
    return kept.withColumn("__place", place).where(F.col(id_col).isNull() | (F.col("__place") == 1)).select(*docs.columns)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
