"""Periodic runs of words (operator 12): suffix classes united by falling LCP.

A run is a stretch of words with smallest period q that no neighbouring word extends. For a text, suffixes are ranked by prefix
doubling, which also gives the longest common prefix (LCP) of neighbours in suffix order. As in Kruskal's algorithm the
neighbours are united from the largest LCP down. A union-find structure keeps the positions of each class in order; where the
union makes two positions i < j adjacent, their common prefix has exactly the LCP of the union, and with j - i <= LCP the words from
i to j + LCP have the period j - i. That is a seed. A smaller period would have put a position between them before (Fine and Wilf), so
the period is the smallest one. All seeds of a run share period and end, and its first position is one of them: the least
seed is the start.

A run of LEAST_WORDS words and EXPONENT periods has an LCP of `floor_of(...)` words or more at its start, so only positions whose
n-gram of that size occurs again in the text are ranked (a hash finds them; equal hashes of other n-grams cost time only).
Texts of an Arrow batch are ranked side by side in blocks of BLOCK_WORDS words, a longer text alone. Nothing moves between tasks.

Defined cases: null and empty texts and texts of blanks have no words, no runs and the empty text as their collapsed form; a null id
is carried along and leaves its text unaltered; repeated rows are judged alike; runs that overlap or lie in each other are all
reported; extra columns are left behind; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesloom.llm.common import chunks_by_size

LEAST_WORDS = 6
EXPONENT = 4
BLOCK_WORDS = 200_000

Run = tuple[int, int, int]  # start, length, period

FOUND = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs array<struct<start:bigint,length:bigint,period:bigint>>, runs_sha256 string, collapsed string, collapsed_sha256 string"
)


def floor_of(least_words: int, exponent: int) -> int:
    """The smallest LCP at the start of a run of so many words and periods, over all periods."""
    return min(max(least_words - q, (exponent - 1) * q) for q in range(1, least_words + 1))


def _repeated(ids: np.ndarray, texts: np.ndarray, size: int) -> np.ndarray:
    """Positions that may start an n-gram of this size which occurs again in the same text."""
    n = len(ids) - size + 1
    if n <= 1:
        return np.empty(0, np.int64)
    hashed = texts[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        hashed = (hashed ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
    order = np.argsort(hashed, kind="stable")
    same = np.zeros(n + 1, bool)
    same[1:-1] = hashed[order][1:] == hashed[order][:-1]
    within = texts[:n] == texts[size - 1 :]
    found = np.zeros(n, bool)
    found[order] = same[1:] | same[:-1]
    return np.flatnonzero(found & within)


def _ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the prefixes of 1, 2, 4, ... words of every position, until all differ; behind the end lies rank 0.

    ids are 1 and more. A rank is the place of its group, so positions that stand alone need no further sorting."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    held = ids[order]
    first = np.r_[True, held[1:] != held[:-1]]
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    levels, width = [rank], 1
    open_ = order[~(first & np.r_[first[1:], True])]
    while len(open_) and width < n:
        behind = np.minimum(open_ + width, n)
        key = rank[open_] * (n + 2) + rank[behind]
        place = np.argsort(key, kind="stable")
        open_, key = open_[place], key[place]
        group = rank[open_]
        new_group = np.r_[True, group[1:] != group[:-1]]
        first = np.r_[True, key[1:] != key[:-1]]
        starts = np.maximum.accumulate(np.where(new_group, np.arange(len(key)), 0))
        nearest = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        rank = rank.copy()
        rank[open_] = group + nearest - starts
        levels.append(rank)
        width *= 2
        open_ = open_[~(first & np.r_[first[1:], True])]
    return levels


def neighbours(ids: np.ndarray, wanted: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (left, right) that follow each other in suffix order among `wanted`, and their LCP where it is `least` or more.

    `wanted` must hold every position that shares so long a prefix with another one."""
    levels = _ranks(ids)
    order = wanted[np.argsort(levels[-1][wanted], kind="stable")]
    left, right = order[:-1].copy(), order[1:].copy()
    a, b, n = left.copy(), right.copy(), len(ids)
    length = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        # A prefix that reaches beyond the end has a rank of its own, equal to no other.
        equal = (rank[a] == rank[b]) & (a < n) & (b < n)
        step = equal.astype(np.int64) << k
        a, b, length = np.minimum(a + step, n), np.minimum(b + step, n), length + step
    some = length >= least
    return left[some], right[some], length[some]


def seeded(left: np.ndarray, right: np.ndarray, lcp: np.ndarray) -> dict[tuple[int, int], int]:
    """Least seed of each (period, end): unite classes by falling LCP, look at positions that become adjacent."""
    parent: dict[int, int] = {}
    classes: dict[int, list[int]] = {}
    seeds: dict[tuple[int, int], int] = {}
    order = np.argsort(-lcp, kind="stable")
    for i, j, shared in zip(left[order].tolist(), right[order].tolist(), lcp[order].tolist()):
        roots = []
        for x in (i, j):
            root = parent.setdefault(x, x)
            while root != (above := parent[root]):
                parent[root] = root = parent[above]
            roots.append(root)
        more, less = roots
        large, small = classes.get(more) or [more], classes.get(less) or [less]
        if len(large) < len(small):
            more, less, large, small = less, more, small, large
        # Positions ascend, so a neighbour below x comes from `small` only if it is the one before x there.
        last = -1
        for k, x in enumerate(small, 1):
            place = bisect_left(large, x)
            if place and x - (start := large[place - 1]) <= shared and start != last:
                period = x - start
                if seeds.get((period, x + shared), start) >= start:
                    seeds[period, x + shared] = start
            if place < len(large) and large[place] - x <= shared and (k == len(small) or large[place] < small[k]):
                period, end = large[place] - x, large[place] + shared
                if seeds.get((period, end), x) >= x:
                    seeds[period, end] = x
            large.insert(place, x)
            last = x
        parent[less] = more
        classes[more] = large
        classes.pop(less, None)
    return seeds


def runs_of(texts: list[np.ndarray], least_words: int = LEAST_WORDS, exponent: int = EXPONENT) -> list[list[Run]]:
    """The runs of each text (word numbers), ordered by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    least = floor_of(least_words, exponent)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return found
    ids, owners = np.concatenate(texts), np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum(sizes) - sizes
    again = np.unique(owners[_repeated(ids, owners, least)])
    if not len(again):
        return found
    # Texts with a repeated n-gram side by side; a word of its own behind each text keeps prefixes inside it.
    span = int(ids.max()) + 1
    parts, places, offset = [], [], 0
    for t in again.tolist():
        parts += [texts[t], np.array([span + len(parts)])]
        places.append(offset)
        offset += len(texts[t]) + 1
    joined = np.concatenate(parts)
    _, joined = np.unique(joined, return_inverse=True)
    numbers = np.repeat(np.arange(len(again)), sizes[again] + 1)
    wanted = _repeated(joined, numbers, least)
    # Equal words of different texts must not meet: a text's number is part of the word.
    joined = np.unique(numbers * (int(joined.max()) + 1) + joined, return_inverse=True)[1].astype(np.int64) + 1
    left, right, lcp = neighbours(joined, wanted, least)
    for (period, end), start in seeded(left, right, lcp).items():
        if end - start >= max(least_words, exponent * period):
            k = int(numbers[start])
            found[int(again[k])].append((start - places[k], end - start, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a periodic tail where the id's hash says so (ids with a crc32 divisible by 10)."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _row(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    # The largest length / period by cross multiplication; runs come by start and period, so the first of equals stays.
    best: Run | None = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    if runs:
        stays = kept(len(words), runs).tolist()
        collapsed = b" ".join([w for w, stay in zip(words, stays) if stay])
    else:
        collapsed = b" ".join(words)
    written = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (
        doc_id,
        len(words),
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        [dict(zip(("start", "length", "period"), r)) for r in runs],
        hashlib.sha256(written.encode()).hexdigest(),
        collapsed.decode(),
        hashlib.sha256(collapsed).hexdigest(),
    )


def periodic(
    documents: DataFrame,
    least_words: int = LEAST_WORDS,
    exponent: int = EXPONENT,
    prepare: Callable[[list[bytes], int | None], list[bytes]] | None = None,
    digests_only: bool = False,
) -> DataFrame:
    """Runs and collapsed text of every document (columns doc_id, text).

    `prepare` may alter the words of a text before they are searched. digests_only leaves the collapsed text itself out."""
    drop = {"collapsed"} if digests_only else set()
    fields = [f for f in FOUND.replace("array<struct<start:bigint,length:bigint,period:bigint>>", "RUNS").split(", ") if f.split()[0] not in drop]
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    kinds = {"bigint": pa.int64(), "string": pa.string(), "RUNS": pa.list_(run)}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields])
    places = [k for k, f in enumerate(FOUND.replace("array<struct<start:bigint,length:bigint,period:bigint>>", "RUNS").split(", ")) if f in fields]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks_by_size([len(t or b"") // 5 + 1 for t in texts], BLOCK_WORDS):
                codes: dict[bytes, int] = {}
                words = [(t or b"").split() for t in texts[part]]
                if prepare is not None:
                    words = [prepare(w, i) for w, i in zip(words, ids[part])]
                numbered = [np.fromiter((codes.setdefault(w, len(codes)) for w in ws), np.int64, len(ws)) for ws in words]
                rows = [_row(i, ws, runs) for i, ws, runs in zip(ids[part], words, runs_of(numbered, least_words, exponent))]
                columns = [[r[k] for r in rows] for k in places]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    declared = ", ".join(fields).replace("RUNS", "array<struct<start:bigint,length:bigint,period:bigint>>")
    return documents.select("doc_id", "text").mapInArrow(search, declared)
