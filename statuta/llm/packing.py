"""Best-fit packing of documents into sequences (operator 4).

The lengths of all pieces make a histogram of at most ``limit`` counts, whatever the corpus. Over it, a
configuration linear program (least number of sequences whose patterns cover every count) is solved by
multiplicative weights: lengths whose cover lags weigh more, and a knapsack dynamic program prices the
best patterns. The solution is rounded, what rounding leaves is solved and rounded again, and only what no
pattern fits any more is packed best-fit. Every
pattern comes with a multiplicity, so a piece needs only its rank among the pieces of its length: ranks
are dealt in salted runs, and a bounded schedule turns (length, rank) into a sequence and an offset.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.llm.common import lean, materialize, table
from statuta.llm.tokens import byte_tokens

Pattern = tuple[tuple[int, int], ...]

#: How fast a dual falls with its length's cover, and the share of open lengths (one in so many) that share prices.
RATE, TURN = 0.5, 16
#: Pieces of one length that are ranked together in one run.
RUN = 100_000


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first of several may be shorter."""
    first = n % limit or limit
    return [(0, first)] + [(s, limit) for s in range(first, n, limit)] if n > limit else [(0, n)]


def pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: a row for each piece, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = byte_tokens(tokenizer), end_id.to_bytes(4, "little")
        for b in batches:
            rows, at = [], []
            for k, text in enumerate((x.as_py() for x in b.column(1))):
                ids = (tokens.id_bytes(text) if text else b"") + end
                for i, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                    rows.append((i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    at.append(k)
            i, start, length, crc = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(i, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run, byte_tokens), f"doc_id {ids}, piece int, start long, length long, ids_crc32 long")


def best_values(value: np.ndarray, limit: int) -> np.ndarray:
    """For each room up to ``limit`` the length to take for the greatest value that fits (0: leave a place), by the knapsack's dynamic program."""
    best, pick = np.zeros(limit + 1), np.zeros(limit + 1, np.int64)
    reverse = value[::-1]  # reverse[limit - l] = value[l]
    for c in range(1, limit + 1):
        total = best[:c] + reverse[limit - c : limit]  # total[j]: take length c - j
        j = int(total.argmax())
        if total[j] > best[c - 1]:
            best[c], pick[c] = total[j], c - j
        else:
            best[c] = best[c - 1]
    return pick


def taken(pick: np.ndarray, room: int, first: int = 0) -> Pattern:
    """The pattern that the dynamic program packs into ``room``, about a piece of length ``first``."""
    took = Counter([first] if first else [])
    c = room - first
    while c > 0:
        if pick[c]:
            took[int(pick[c])] += 1
            c -= int(pick[c])
        else:
            c -= 1
    return tuple(sorted(took.items(), reverse=True))


def worth(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Duals to begin with: a length's share of a sequence, a little more for long ones, which fit worst."""
    return lengths / limit * (1 + 0.5 * lengths / limit)


def solve(counts: dict[int, int], limit: int) -> dict[Pattern, float]:
    """A fractional cover of the counts by patterns, by multiplicative weights.

    A length's dual falls exponentially, at ``RATE``, with the share of its count that is covered. A dynamic
    program prices the best pattern about each open length; those of the longest ``1 / TURN`` are used in turn,
    each as often as its scarcest length allows, before prices are made anew. So each step closes a length, no
    length is covered twice, and the cover is whole when the loop ends: there are no more steps than lengths.
    """
    lengths = np.array(sorted(counts))
    need = np.array([counts[n] for n in lengths], float)
    left, use = need.copy(), defaultdict(float)
    where = np.zeros(limit + 1, np.int64)
    where[lengths] = np.arange(len(lengths))
    duals = worth(lengths, limit)
    while (live := np.flatnonzero(left > 0)).size:
        value = np.zeros(limit + 1)
        value[lengths[live]] = duals[live] * np.exp(RATE * (left[live] / need[live] - 1))
        pick = best_values(value, limit)
        for k in live[::-1][: max(1, len(live) // TURN)]:
            p = taken(pick, limit, int(lengths[k]))
            at, a = where[[n for n, _ in p]], np.array([m for _, m in p], float)
            step = (left[at] / a).min()
            if step > 0:  # else a length that it holds has been closed since it was priced
                use[p] += step
                left[at] -= step * a
                left[left < 1e-9 * need] = 0
    return dict(use)


def rounded(counts: dict[int, int], limit: int) -> tuple[Counter[Pattern], dict[int, int]]:
    """Patterns of the linear program with whole multiplicities, and the counts that they leave.

    Multiplicities are rounded down; then full patterns, by what rounding took from them, are used once
    more where the counts allow. The program is solved again for what is left, until that yields nothing.
    """
    left, out = {n: c for n, c in counts.items() if c}, Counter()
    while left:
        use = sorted(solve(left, limit).items(), key=lambda kv: (int(kv[1]) - kv[1], kv[0]))
        before = sum(left.values())
        for whole in (True, False):
            for p, x in use:
                times = min([int(x) if whole else int(sum(n * m for n, m in p) == limit), *(left[n] // m for n, m in p)])
                out[p] += times
                for n, m in p:
                    left[n] -= m * times
        left = {n: c for n, c in left.items() if c}
        if sum(left.values()) == before:
            break
    return +out, left


def fill(left: dict[int, int], begun: Pattern, limit: int, value_of: np.ndarray) -> Pattern:
    """The best fit for what room ``begun`` leaves: priced anew whenever a length runs out."""
    took = Counter(dict(begun))
    room = limit - sum(n * m for n, m in begun)
    while room > 0:
        value = np.zeros(room + 1)
        able = [n for n in left if n <= room and left[n] > took[n]]
        if not able:
            break
        value[able] = value_of[able]
        before = room
        for n, m in taken(best_values(value, room), room):
            m = min(m, left[n] - took[n])
            took[n] += m
            room -= n * m
        if room == before:
            break
    return tuple(sorted(((n, m) for n, m in took.items() if m), reverse=True))


def best_fit(counts: dict[int, int], limit: int) -> Counter[Pattern]:
    """Longest length first, with the fullest filling for the rest of its sequence, as often as the counts allow.

    Each turn ends some length or needs another filling, so turns follow the number of lengths, not of pieces.
    """
    left, out, value_of = dict(counts), Counter(), worth(np.arange(limit + 1), limit)
    while left:
        longest = max(left)
        p = fill(left, ((longest, 1),), limit, value_of)
        times = min(left[n] // m for n, m in p)
        out[p] += times
        for n, m in p:
            left[n] -= m * times
            if not left[n]:
                del left[n]
    return out


def plan(counts: dict[int, int], limit: int) -> list[tuple[Pattern, int]]:
    """Patterns with multiplicities that hold every piece of the histogram exactly once."""
    out, left = rounded(counts, limit)
    out.update(best_fit(left, limit))
    return sorted(out.items())


def schedule(patterns: list[tuple[Pattern, int]]) -> pd.DataFrame:
    """length, first (rank), per (pieces of it in a sequence), seq (first sequence), at (offset): sorted by length, first."""
    rows, ranks, seq = [], Counter(), 0
    for p, times in patterns:
        at = 0
        for n, m in p:
            rows.append((n, ranks[n], m, seq, at))
            ranks[n] += m * times
            at += n * m
        seq += times
    return pd.DataFrame(rows, columns=["length", "first", "per", "seq", "at"]).sort_values(["length", "first"], ignore_index=True)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece in its place.

    A null text counts as empty, and an empty one is the end id alone. Repeated rows, null ids and ties
    are packed as rows of their own; an empty table gives no rows; other columns are not read. The
    driver holds the histogram and the schedule, both bounded by ``limit``.
    """
    cuts = materialize(pieces(docs, tokenizer, limit, end_id, id_col, text_col))
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``limit`` rows
    whole = counts.pop(limit, 0)
    rows = schedule([*plan(counts, limit), *([(((limit, 1),), whole)] if whole else [])])
    runs = {n: -(-c // RUN) for n, c in [*counts.items(), (limit, whole)]}
    salts = F.element_at(F.array(*[F.lit(runs.get(n, 1) or 1) for n in range(1, limit + 1)]), F.col("length").cast("int"))
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), salts).cast("int"))
    # a run's ranks follow those of the runs before it; there is about a run for RUN pieces
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", before.alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("rank", inside).join(base, ["length", "salt"]).withColumn("rank", (F.col("base") + F.col("rank")).cast("long")).drop("base", "salt")

    lengths, firsts, pers, seqs, ats = (rows[c].to_numpy(np.int64) for c in rows)
    start_of = np.searchsorted(lengths, np.arange(limit + 2))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, rank = b["length"].to_numpy(np.int64), b.pop("rank").to_numpy(np.int64)
            k = np.empty(len(b), np.int64)
            for x in np.unique(n):
                lo, hi = start_of[x], start_of[x + 1]
                k[n == x] = lo + np.searchsorted(firsts[lo:hi], rank[n == x], side="right") - 1
            nth, slot = np.divmod(rank - firsts[k], pers[k])
            yield b.assign(sequence_id=seqs[k] + nth, offset=ats[k] + slot * n)[[*b.columns, "sequence_id", "offset"]]

    out = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    ids = cuts.schema["doc_id"].dataType.simpleString()
    return out.mapInPandas(place, f"doc_id {ids}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
