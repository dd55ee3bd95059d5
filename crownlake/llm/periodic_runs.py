"""Periodic runs of words, by Lyndon roots.

A run is a stretch of consecutive words with smallest period q that holds at
least two periods (and ``min_length`` words) and that no neighbouring word
extends. Every run holds a Lyndon root: a word of length q that is the longest
Lyndon word from its start, under some order of the alphabet or under the
reverse order (Bannai et al., "The runs theorem"). So:

1. The first phase of Baier's suffix sorter ("Linear-time suffix sorting")
   refines groups of suffixes, the greatest first; it ends with one group for
   each longest Lyndon prefix, so the context length of a suffix's group is its
   Lyndon array entry. It runs once under the alphabet's order and once under
   the reverse order; no suffix array is made.
2. Each entry is a possible root. Longest common extensions to the right and to
   the left, found by prefix hashes and bisection, give the stretch that it spans.
3. Stretches long enough are runs. Each is compared word by word before it is
   returned; should two unequal stretches share a hash, the pass is repeated with other bases.

A run of m words or more repeats at least m / 2 of its words at a distance of
its period, and such repeats cover it. So words that no repeated ceil(m/2)-gram
of their text covers are left out first, which changes no run.

The work is per text, in Arrow batches within the scan's tasks: linear phases,
and a logarithmic number of array passes for the extensions. Nothing is shuffled.

Defined cases: a null, empty or blank text has no words and no runs. Null and
repeated ``doc_id`` and repeated rows are handled row by row. Columns other than
``doc_id`` and ``text`` are left behind. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import prepare, texts

RUNS = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
MODULUS = (1 << 31) - 1


def lyndon_lengths(ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position; stretches begin at ``starts`` and are independent.

    Phase one of the suffix sorter. The positions whose group is still to come form a linked list. The greatest group
    leaves the list; the left neighbour of each chain of its members takes their contexts into its own, and the
    neighbours that had the same group and the same chain length form a new group just above their old one.
    """
    n = len(ranks)
    if not n:
        return np.zeros(0, np.int64)
    alphabet, group_of = np.unique(ranks, return_inverse=True)
    k = len(alphabet)
    group = group_of.tolist() + [-1]  # slot n, also reached as -1, stands for the ends of a stretch
    after = np.arange(1, n + 2)
    after[starts[1:] - 1] = n
    before = np.arange(-1, n)
    before[starts] = -1
    right, left = after.tolist(), before.tolist()
    order = np.argsort(group_of, kind="stable")
    members = [m.tolist() for m in np.split(order, np.cumsum(np.bincount(group_of))[:-1])]
    length = [1] * k
    above, below = list(range(1, k + 1)), list(range(-1, k - 1))
    above[k - 1] = -1
    current = k - 1
    while current >= 0:
        grown: dict[tuple[int, int], list[int]] = {}
        for i in members[current]:
            if group[i] != current:
                continue
            j = left[i]
            if group[j] == current:
                continue
            chain, r = 1, right[i]
            while group[r] == current:
                chain += 1
                r = right[r]
            right[j], left[r] = r, j
            if j >= 0:
                grown.setdefault((group[j], chain), []).append(j)
        members[current] = ()
        for old, chain in sorted(grown, key=lambda key: -key[1]):
            new = len(members)
            moved = grown[old, chain]
            members.append(moved)
            length.append(length[old] + chain * length[current])
            higher = above[old]
            above.append(higher)
            below.append(old)
            above[old] = new
            if higher >= 0:
                below[higher] = new
            for j in moved:
                group[j] = new
        current = below[current]
    return np.array(length, np.int64)[np.array(group[:n], np.int64)]


class Extensions:
    """Longest common extensions of positions of one word sequence, by prefix hashes under two bases."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.tables = []
        values = words.astype(np.uint64) + np.uint64(1)
        for _ in range(2):
            base = int(rng.integers(1 << 20, MODULUS - 1))
            powers = np.ones(len(words) + 1, np.uint64)
            have = 1
            while have < len(powers):
                step = np.uint64(pow(base, have, MODULUS))
                more = min(have, len(powers) - have)
                powers[have : have + more] = powers[:more] * step % np.uint64(MODULUS)
                have += more
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1] % np.uint64(MODULUS), dtype=np.uint64)])
            self.tables.append((powers, sums % np.uint64(MODULUS)))

    def equal(self, a: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``a`` hash as those from ``a + shift``."""
        m = np.uint64(MODULUS)
        same = np.ones(len(a), bool)
        b = a + shift
        for powers, sums in self.tables:
            first = (sums[a + n] + m - sums[a]) % m * powers[shift] % m
            same &= first == (sums[b + n] + m - sums[b]) % m
        return same

    def longest(self, at: np.ndarray, shift: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``at`` on (or before ``at``) equal those ``shift`` further, at most ``limit``."""
        found = np.zeros(len(at), np.int64)
        if not len(at):
            return found
        step = 1 << max(int(limit.max()).bit_length() - 1, 0)
        while step:
            fits = np.flatnonzero(found + step <= limit)
            begin = at[fits] - found[fits] - step if back else at[fits] + found[fits]
            ok = self.equal(begin, shift[fits], np.full(len(fits), step))
            found[fits[ok]] += step
            step >>= 1
        return found


def maximal_runs(words: np.ndarray, starts: np.ndarray, min_length: int, seed: int = 1) -> np.ndarray:
    """Rows (start, length, period) of all runs within the stretches of ``words`` that begin at ``starts``."""
    n = len(words)
    if not n:
        return np.zeros((0, 3), np.int64)
    edges = np.append(starts, n)
    of = np.repeat(np.arange(len(starts)), np.diff(edges))
    low, high = edges[of], edges[of + 1]
    position = np.arange(n)
    roots = []
    for ranks in (words, -words):
        period = lyndon_lengths(ranks, starts)
        # A run needs a word that equals the one a period on, at the root's start or just before it.
        next_same = (position + period < high) & (words == words[np.minimum(position + period, n - 1)])
        last_same = (position > low) & (words[position - 1] == words[position + period - 1])
        at = np.flatnonzero(next_same | last_same)
        roots.append(period[at] * np.int64(n + 1) + at)
    code = np.unique(np.concatenate(roots))
    period, at = np.divmod(code, np.int64(n + 1))
    lce = Extensions(words, seed)
    # Of the equal roots that follow each other in one run, the first is enough.
    place = np.searchsorted(code, code - period)
    preceded = (at - period >= low[at]) & (code[place] == code - period)
    later = np.flatnonzero(preceded)
    preceded[later] = lce.equal(at[later] - period[later], period[later], period[later])
    at, period = at[~preceded], period[~preceded]
    ahead = lce.longest(at, period, high[at] - at - period, back=False)
    behind = lce.longest(at, period, at - low[at], back=True)
    total = period + ahead + behind
    keep = total >= np.maximum(min_length, 2 * period)
    found = np.unique(np.stack([(at - behind)[keep], total[keep], period[keep]], axis=1), axis=0)
    if all(np.array_equal(words[s : s + size - q], words[s + q : s + size]) for s, size, q in found.tolist()):
        return found
    return maximal_runs(words, starts, min_length, seed + 1)


def repeated_stretches(words: np.ndarray, bounds: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that repeated grams of their text cover; ``bounds`` are the texts' borders.

    Grams are compared by hash within a text; a shared hash only lets more words through.
    """
    n, size = len(words), max(-(-min_length // 2), 1)
    spans = n - size + 1
    if spans <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    odd = np.random.default_rng(7).integers(1 << 62, size=size + 1).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    code = text[:spans].astype(np.uint64) * odd[size]
    for t in range(size):
        code += (words[t : t + spans].astype(np.uint64) + np.uint64(1)) * odd[t]
    code ^= code >> np.uint64(32)
    whole = np.flatnonzero(text[:spans] == text[size - 1 :])
    order = whole[np.argsort(code[whole], kind="stable")]
    twin = code[order][1:] == code[order][:-1]
    repeated = order[np.append(twin, False) | np.append(False, twin)]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + size, -1)
    covered = np.cumsum(change[:-1]) > 0
    fresh = np.ones(n, bool)
    fresh[1:] = ~covered[:-1]
    fresh[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(covered & fresh)
    last = np.ones(n, bool)
    last[:-1] = fresh[1:] | ~covered[1:]
    ends = np.flatnonzero(covered & last) + 1
    long = ends - starts >= min_length
    return starts[long], ends[long]


def batch_runs(batch: list[bytes], min_length: int) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text and its runs as (start, length, period), sorted."""
    tokens = [t.split() for t in batch]  # bytes split at the six ASCII white-space characters only
    vocabulary: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in tokens], np.int64)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    words = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for t in tokens for w in t), np.int64, int(bounds[-1]))
    starts, ends = repeated_stretches(words, bounds, min_length)
    out: list[list[tuple[int, int, int]]] = [[] for _ in batch]
    if not len(starts):
        return tokens, out
    lengths = ends - starts
    inner = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)[:-1]])
    whence = np.repeat(starts - inner, lengths) + np.arange(lengths.sum())
    found = maximal_runs(words[whence], inner, min_length)
    begin = whence[found[:, 0]]
    owner = np.searchsorted(bounds, begin, side="right") - 1
    for text, start, (size, period) in zip(owner.tolist(), (begin - bounds[owner]).tolist(), found[:, 1:].tolist()):
        out[text].append((start, size, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return tokens, out


def collapse(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(tokens)
    change = np.zeros(len(tokens) + 1, np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    return b" ".join([tokens[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def _find(min_length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, runs = batch_runs(batch.column("text").cast(pa.binary()).to_pylist(), min_length)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            kept = pa.array([collapse(t, r) for t, r in zip(tokens, runs)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in tokens], pa.int64()), pa.array(rows, RUN_TYPE), kept.cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def find_runs(docs: DataFrame, min_length: int = 12) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs by (start, period), and its text without their repeats."""
    prepare(docs.sparkSession)
    return texts(docs).mapInArrow(_find(min_length), RUNS)


def run_digests(found: DataFrame) -> DataFrame:
    """Per row: the number of runs, the longest one (ties: smallest start, then period), and digests of runs and text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listing = F.array_join(
        F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), ""
    )
    best = found.select("*", longest.alias("best"))
    start, period = -F.col("best.s"), -F.col("best.p")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(F.col("best.length") * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Input of the query: every tenth text (by its id's crc32) gets a periodic tail; the others stay as they are."""
    code = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    plain = texts(docs).withColumn("__code", code)
    split = plain.withColumn(
        "__words", F.when(F.col("__code") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != F.lit("")))
    )
    n, g = F.size("__words"), F.floor(F.col("__code") / 10)
    sized = split.withColumns({"__from": F.when(n > 0, (g % F.nullif(n, F.lit(0))).cast("int"))})
    start = F.col("__from")
    sized = sized.withColumn("__period", (1 + F.floor((n - start) / (3 + g % 8))).cast("int"))

    def word(w: Column, i: Column) -> Column:
        return F.when(i >= start, F.get("__words", start + (i - start) % F.col("__period"))).otherwise(w)

    return sized.select(
        "doc_id", F.when(start.isNotNull(), F.array_join(F.transform("__words", word), " ")).otherwise(F.col("text")).alias("text")
    )
