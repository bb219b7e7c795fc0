"""Removal of long repeated strings by a hash-compared suffix sort (operator 3).

A byte is removed if it lies in a string of ``length`` bytes that also starts elsewhere in the corpus.
Sorting every suffix of a corpus would move a multiple of it, so suffixes are first thinned without loss:

1. Each window of ``length`` bytes has an anchor, the k-gram in it of least hash (the leftmost of equal
   ones). Equal windows have equal anchors at equal places, so only suffixes about anchors that occur
   more than once can matter. Neighbouring windows of one anchor form a cell, and cells move as hashes.
2. Cells whose anchor occurs once are done. Cells equal as a whole, by their length, their anchor's place and two
   independent hashes of 64 and 62 bits, are repeated as a whole. Of the rest, one of each kind is cut out of its
   text, and the cells of an anchor are dealt by what lies right (or left) of it, since of two equal windows at
   least half of the context is on one side.
3. There the suffixes that start at the anchors, and the reversed prefixes that end there, are sorted by
   mergesort. A comparison finds the common extension by binary search over prefix polynomial hashes, so
   it takes a logarithmic number of steps; the bytes then verify every extension, and a group whose
   hashes collided is sorted by its bytes. Two windows are equal where both extensions are long enough.

Polynomial hashes are taken modulo 2**64 over mixed byte values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import lean, likely, table, written

LENGTH, GRAM = 200, 60
#: Window starts of a text, and bytes of several texts, that are hashed at once; suffixes that are sorted at once.
PIECE, BUFFER, SORTED = 1 << 20, 1 << 20, 1 << 14
#: Texts that are cut at once.
CUT = 1000
#: Members of a kind of cells that one task may hold, and kinds that may have more: what is broadcast of them.
HOT, HOT_KINDS = 10_000, 4096

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


#: Byte values, spread over 64 bits.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


#: A prime for second hashes, their two bases, and byte values below it.
_PRIME, _BASES = (1 << 31) - 1, (1_103_515_245, 1_812_433_253)
_SMALL = _VALUE % _U(_PRIME - 1) + _U(1)


@lru_cache(maxsize=8)
def _powers_mod(base: int, n: int) -> np.ndarray:
    p = np.ones(n, np.uint64)
    k = 1
    while k < n:  # the powers so far, times the next one
        p[k : 2 * k] = p[: min(k, n - k)] * _U(pow(base, k, _PRIME)) % _U(_PRIME)
        k *= 2
    return p


def second_hashes(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each span a:b of buf 62 bits of two polynomials modulo a prime, which have nothing to do with the hashes modulo 2**64."""
    out = np.zeros(len(a), np.uint64)
    for base in _BASES:
        power, inverse = _powers_mod(base, BUFFER + 2 * PIECE), _powers_mod(pow(base, -1, _PRIME), BUFFER + 2 * PIECE)
        h = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_SMALL[buf] * power[: len(buf)] % _U(_PRIME), out=h[1:])  # below 2**53
        out = (out << _U(31)) | ((h[b] - h[a]) % _U(_PRIME) * inverse[a] % _U(_PRIME))
    return out


def cells(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's place in the first, anchor's hash, cell's two hashes) of texts that lie at lo:hi of buf."""
    n, width = len(buf), length - gram + 1
    if n < length:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 3
    power, inverse = _powers(_BASE, BUFFER + 2 * PIECE), _powers(pow(_BASE, -1, 1 << 64), BUFFER + 2 * PIECE)
    h = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[buf] * power[:n], out=h[1:])
    grams = mix((h[gram:] - h[:-gram]) * inverse[: n - gram + 1])
    key = (grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    block = np.concatenate([key, np.full(-len(key) % width, _U(2**64 - 1))]).reshape(-1, width)
    count = n - length + 1  # sliding minimum: of a block's end and the next one's beginning
    left = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()[:count]
    right = np.minimum.accumulate(block, axis=1).ravel()[width - 1 : width - 1 + count]
    at = (np.minimum(left, right) & _U(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(count)
    text = np.searchsorted(hi, start, side="right")
    inside = start + length <= hi[np.minimum(text, len(hi) - 1)]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]) | (text[1:] != text[:-1])])
    a = np.flatnonzero(new)
    b = np.append(a[1:], count) - 1
    a, b = a[inside[a]], b[inside[a]]
    off = at[a] - a
    whole = mix(mix((h[b + length] - h[a]) * inverse[a]) + off.astype(np.uint64) * _U(_BASE))
    return text[a], a - lo[text[a]], b - a + 1, off, grams[at[a]], whole, second_hashes(buf, a, b + length)


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], list[bytes]]]:
    """Batches of pieces of texts, with each piece's text and place; long texts in pieces that overlap by a window."""
    where: list[tuple[int, int]] = []
    held: list[bytes] = []
    size = 0
    for k, t in enumerate(texts):
        for x in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[x : x + PIECE + length - 1] if len(t) > PIECE else t
            if held and size + len(part) > BUFFER:
                yield where, held
                where, held, size = [], [], 0
            where.append((k, x))
            held.append(part)
            size += len(part)
    if held:
        yield where, held


def find_cells(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, rk, a, w, off, kh, ch, c2 for all cells of rows (doc_id, rk, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, held in _pieces([x.as_py() for x in batch.column(2)], length):
                size = np.array([len(x) for x in held])
                hi = np.cumsum(size)
                text, a, w, off, kh, ch, c2 = cells(np.frombuffer(b"".join(held), np.uint8), hi - size, hi, length, gram)
                row, x = np.array(where).T
                row = pa.array(row[text])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(a + x[text], pa.int64()), pa.array(w, pa.int32()), pa.array(off, pa.int32()), pa.array(kh.view(np.int64)), pa.array(ch.view(np.int64)), pa.array(c2.view(np.int64))],
                    ["doc_id", "rk", "a", "w", "off", "kh", "ch", "c2"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"doc_id {kind}, rk int, a long, w int, off int, kh long, ch long, c2 long")


class Suffixes:
    """Strings in groups, as a matrix of bytes with lengths; their sorted order and common extensions."""

    def __init__(self, strings: list[bytes], group: np.ndarray, width: int) -> None:
        self.group, self.size = group, np.array([len(s) for s in strings])
        self.text = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
        self.hash = np.zeros((len(strings), width + 1), np.uint64)
        np.cumsum(_VALUE[self.text] * _powers(_BASE, BUFFER + 2 * PIECE)[:width], axis=1, out=self.hash[:, 1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extensions by binary search: the longest prefix length with equal hashes."""
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.hash[i, mid] == self.hash[j, mid]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether string i sorts before string j; a prefix sorts before what it begins."""
        n = self.common(i, j)
        last = self.text.shape[1] - 1
        a, b = self.text[i, np.minimum(n, last)], self.text[j, np.minimum(n, last)]
        return np.where((n < self.size[i]) & (n < self.size[j]), a < b, self.size[i] < self.size[j])

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, common extension of each with the one before, 0 at a group's first): mergesort within groups, all runs of a width at once."""
        n = len(self.group)
        first = np.searchsorted(self.group, self.group)
        end = np.searchsorted(self.group, self.group, side="right")
        order, place = np.arange(n), np.arange(n) - first
        largest, run = int((end - first).max(initial=0)), 1
        while run < largest:
            odd = (place // run) % 2 == 1
            begin = first + (place // (2 * run)) * 2 * run
            middle = np.minimum(begin + run, end)
            lo = np.where(odd, begin, middle)
            hi = np.where(odd, middle, np.minimum(middle + run, end))
            base = lo.copy()
            while (todo := np.flatnonzero(lo < hi)).size:
                mid = (lo[todo] + hi[todo]) // 2
                x, y = order[todo], order[mid]
                # of equal strings those of the left run stay in front
                right = np.where(odd[todo], ~self.before(x, y), self.before(y, x))
                lo[todo] = np.where(right, mid + 1, lo[todo])
                hi[todo] = np.where(right, hi[todo], mid)
            to = np.where(odd, np.arange(n) - run + (lo - base), np.arange(n) + (lo - base))
            merged = np.empty_like(order)
            merged[to] = order
            order, run = merged, 2 * run
        return self._verified(order, first)

    def _verified(self, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lcp = np.zeros(len(order), np.int64)
        if len(order) < 2:
            return order, lcp
        claimed, true = self.common(order[:-1], order[1:]), self._by_bytes(order[:-1], order[1:])
        if not np.array_equal(claimed, true):  # a collision: nothing that hashes said counts
            order = np.array(sorted(range(len(order)), key=lambda k: (self.group[k], self.text[k, : self.size[k]].tobytes())))
            true = self._by_bytes(order[:-1], order[1:])
        lcp[1:] = np.where(self.group[order[1:]] == self.group[order[:-1]], true, 0)
        return order, lcp

    def _by_bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = self.text[i] != self.text[j]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
        return np.minimum(n, np.minimum(self.size[i], self.size[j]))


def _classes(order: np.ndarray, lcp: np.ndarray, group: np.ndarray, least: int) -> np.ndarray:
    """For each string a number that it shares with those of its group that agree in the first ``least`` bytes."""
    new = lcp < least
    new[1:] |= group[order[1:]] != group[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def equal_windows(group: np.ndarray, seg: list[bytes], mid: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, int]]:
    """(strings, o) whose window that starts o bytes before the anchor occurs twice in the group. group ascends."""
    right = Suffixes([s[m:] for s, m in zip(seg, mid)], group, length)
    left = Suffixes([s[:m][::-1] for s, m in zip(seg, mid)], group, length - gram)
    by_right, by_left = right.sort(), left.sort()
    for o in range(int(low.min()), int(high.max()) + 1):
        live = np.flatnonzero((low <= o) & (o <= high))
        if not len(live):
            continue
        pair = _classes(*by_left, group, o) * (len(group) + 1) + _classes(*by_right, group, length - o)
        _, inverse, count = np.unique(pair[live], return_inverse=True, return_counts=True)
        if len(found := live[count[inverse] > 1]):
            yield found, o


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, CUT):
            yield b.slice(k, CUT)


def cut_out(docs: DataFrame, kinds: DataFrame, length: int, gram: int) -> DataFrame:
    """key, seg, mid, low, high, doc_id, rk, p: each cell's text about its anchor, once for windows right of the middle and once left."""
    half = (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in _slices(batches):
            out, at = [], []
            for k, (text, found) in enumerate(zip(b.column(2), b.column(3))):
                t = text.as_py()
                for c in found.as_py():
                    p = c["a"] + c["off"]
                    o0, o1 = c["off"] - c["w"] + 1, c["off"]
                    for side, low, high in ((0, o0, min(o1, half)), (1, max(o0, half + 1), o1)):
                        if low <= high:
                            near = t[p : p + length - half] if side == 0 else t[p - half - 1 : p + gram]
                            key = xxh64_intdigest(near, side + 1) ^ (c["kh"] & 0xFFFFFFFFFFFFFFFF)
                            out.append((key, t[p - high : p + length - low], high, low, high, p))
                            at.append(k)
            key, seg, mid, low, high, p = zip(*out) if out else ((),) * 6
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(seg, pa.binary()), *(pa.array(x, pa.int32()) for x in (mid, low, high)), b.column(0).take(at), b.column(1).take(at), pa.array(p, pa.int64())],
                ["key", "seg", "mid", "low", "high", "doc_id", "rk", "p"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    per_doc = kinds.groupBy("doc_id", "rk").agg(F.collect_list(F.struct("a", "w", "off", "kh")).alias("found"))
    both = _with(docs, per_doc, "inner").select("doc_id", "rk", "bytes", "found")
    return both.mapInArrow(lean(run), f"key long, seg binary, mid int, low int, high int, doc_id {kind}, rk int, p long")


def _with(docs: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    other = per_doc.withColumnsRenamed({"doc_id": "__id", "rk": "__rk"})
    return docs.join(other, docs["doc_id"].eqNullSafe(F.col("__id")) & (docs["rk"] == F.col("__rk")), how)


def sort_cells(cut: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, rk, a, e: runs of bytes covered by windows that equal a window of another cell of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        key = t["key"].to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        alone = np.searchsorted(key, key, side="right") - np.searchsorted(key, key) < 2
        order, key = order[~alone], key[~alone]
        firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        ends = np.append(firsts[1:], len(key)) if len(key) else []
        begin = 0
        for k, end in enumerate(ends):
            if k + 1 < len(ends) and ends[k + 1] - begin <= SORTED:
                continue
            part = t.take(pa.array(order[begin:end]))
            group = np.searchsorted(firsts, np.arange(begin, end), side="right")
            begin = end
            low, high = part["low"].to_numpy().astype(np.int64), part["high"].to_numpy().astype(np.int64)
            hits = list(equal_windows(group, part["seg"].to_pylist(), part["mid"].to_numpy(), low, high, length, gram))
            if not hits:
                continue
            who = np.concatenate([x for x, _ in hits])
            o = np.concatenate([np.full(len(x), y) for x, y in hits])
            by = np.lexsort((-o, who))
            who, o = who[by], o[by]
            new = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (o[1:] != o[:-1] - 1)]))
            last = np.append(new[1:], len(who)) - 1
            p = part["p"].to_numpy()[who[new]]
            row = pa.array(who[new])
            part = part.combine_chunks()
            yield pa.RecordBatch.from_arrays([part["doc_id"].take(row).combine_chunks(), part["rk"].take(row).combine_chunks(), pa.array(p - o[new]), pa.array(p - o[last] + length)], ["doc_id", "rk", "a", "e"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.repartition("key").mapInArrow(lean(run), f"doc_id {kind}, rk int, a long, e long")


def _members(found: DataFrame, kinds: DataFrame, on: list[str]) -> DataFrame:
    """The cells of the kinds (with n, their members). Kinds of many members are dealt to parts of ``HOT`` or more: there are at most ``HOT_KINDS`` of those."""
    total = kinds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    kinds = kinds.withColumn("parts", F.ceil(F.col("n") / F.lit(max(HOT, total // HOT_KINDS))).cast("int"))
    hot = kinds.where("parts > 1").select(*on, "parts")
    cells = likely(found, kinds, on).join(F.broadcast(hot), on, "left")
    cells = cells.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id", "a"), "parts"), F.lit(0)).cast("int")).drop("parts")
    return cells.join(kinds.select(*on, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), [*on, "part"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end of the removed runs, in bytes), kept (the remaining bytes).

    Null texts are empty, and texts shorter than ``length`` keep all bytes. Rows repeated whole are texts
    of their own, so that each is a repeat of the other. Null ids are kept, rows may share an id, an
    empty table gives no rows, and other columns are not read. Matches never cross texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.hash(text).alias("rk"), text.cast("binary").alias("bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = written(find_cells(rows.where(F.octet_length("bytes") >= length), length, gram), "cells")
    kind_of, place = ["kh", "ch", "c2", "w", "off"], ["doc_id", "rk", "a"]
    # equal cells fold to one kind before anything meets by its anchor, so a passage of many texts is a row
    kinds = found.groupBy(*kind_of).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in place])
    by_anchor = Window.partitionBy("kh")
    kinds = kinds.select("*", F.sum("n").over(by_anchor).alias("total"), (F.count("*").over(by_anchor) > 1).alias("mixed"))
    kinds = written(kinds.where("total > 1").drop("total"), "kinds")
    whole = _members(found, kinds.where("n > 1").select(*kind_of, "n"), kind_of)
    whole = whole.select("doc_id", "rk", "a", (F.col("a") + F.col("w") - 1 + length).alias("e"))
    part = sort_cells(cut_out(rows, kinds.where("mixed").select(*place, "w", "off", "kh"), length, gram), length, gram)
    runs = whole.unionByName(part).groupBy("doc_id", "rk").agg(F.collect_list(F.struct("a", "e")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            spans, kept = [], []
            for t, r in zip(b.column(1), b.column(2)):
                t, joined = t.as_py(), []
                for x in sorted((x["a"], x["e"]) for x in r.as_py() or ()):
                    if joined and x[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], x[1])
                    else:
                        joined.append([*x])
                edges = [0, *(y for x in joined for y in x), len(t)]
                spans.append([{"start": a, "end": e} for a, e in joined])
                kept.append(b"".join(t[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()), pc.binary_length(b.column(1)).cast(pa.int64())], ["doc_id", "spans", "kept", "n_bytes"])

    out = _with(rows, runs, "left").select("doc_id", "bytes", "runs")
    return out.mapInArrow(lean(cut), f"doc_id {kind}, spans array<struct<start:long,end:long>>, kept binary, n_bytes long").select("doc_id", "n_bytes", "spans", "kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
