"""Runs of words against plain enumeration of periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from crownlake.llm import periodic_runs, queries
from crownlake.llm.periodic_runs import batch_runs, find_runs, lyndon_lengths, maximal_runs

from .conftest import AWKWARD, table


def plain_lyndon(word):
    """Length of the longest Lyndon word from each position, by the definition."""
    n = len(word)
    return [max(j - i for j in range(i + 1, n + 1) if all(word[i:j] < word[k:j] for k in range(i + 1, j))) for i in range(n)]


def plain_runs(words, min_length):
    """Every run as (start, length, period), by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            run = words[i : i + size]
            if size >= max(min_length, 2 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng, letters=3, most=40):
    unit = [str(rng.randrange(letters)) for _ in range(rng.randrange(1, 9))]
    return (unit * 9)[: rng.randrange(1, most)] + [str(rng.randrange(letters)) for _ in range(rng.randrange(0, 12))]


def test_lyndon_lengths_under_both_orders():
    rng = random.Random(1)
    for _ in range(300):
        word = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(1, 16))]
        for ranks in (np.array(word), -np.array(word)):
            assert lyndon_lengths(ranks, np.array([0])).tolist() == plain_lyndon(ranks.tolist()), word
    assert lyndon_lengths(np.array([], int), np.array([0])).tolist() == []


def test_stretches_are_independent():
    rng = random.Random(2)
    parts = [[rng.randrange(2) for _ in range(rng.randrange(1, 10))] for _ in range(20)]
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
    whole = lyndon_lengths(np.array(sum(parts, [])), starts).tolist()
    assert whole == sum((plain_lyndon(p) for p in parts), [])


@pytest.mark.parametrize("min_length", [1, 2, 5, 12])
def test_runs_of_batches(min_length):
    rng = random.Random(min_length)
    for _ in range(150):
        docs = [some_words(rng) if rng.random() < 0.9 else [] for _ in range(rng.randrange(1, 6))]
        _, runs = batch_runs([" ".join(d).encode() for d in docs], min_length)
        assert runs == [plain_runs(d, min_length) for d in docs]


def test_shared_hashes_do_not_show(monkeypatch):
    """With a modulus so small that unequal stretches share hashes, the pass repeats until each run holds word by word."""
    monkeypatch.setattr(periodic_runs.Extensions, "equal", _sloppy(periodic_runs.Extensions.equal))
    words = np.array([int(c) for c in "0101010101012010101010101"])
    found = maximal_runs(words, np.array([0]), 2, seed=1)
    assert sorted(map(tuple, found.tolist())) == sorted(plain_runs(words.tolist(), 2))


def _sloppy(exact):
    """First seed: everything looks equal. Later seeds: exact."""
    made = []

    def equal(self, a, shift, n):
        if self not in made:
            made.append(self)
        return np.ones(len(a), bool) if made.index(self) == 0 else exact(self, a, shift, n)

    return equal


def test_find_runs_on_awkward_rows(ready, awkward, empty):
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(awkward, 3).collect()), key=repr)
    want = []
    for doc_id, text, *_ in AWKWARD:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words[:2000], 3) if len(words) < 100 else None
        want.append((doc_id, len(words), runs, words))
    want.sort(key=lambda r: repr((r[0], r[1])))
    got.sort(key=lambda r: repr((r[0], r[1])))
    for (doc_id, n, runs, collapsed), (want_id, want_n, want_runs, words) in zip(got, want, strict=True):
        assert (doc_id, n) == (want_id, want_n)
        if want_runs is not None:
            assert runs == want_runs
        else:  # the long text repeats 977 words
            assert (0, 30_000, 977) in runs and collapsed.split()[:977] == words[:977] and len(collapsed.split()) < 1000
    assert find_runs(empty).count() == 0


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}

    def digest(value):
        return hashlib.sha256(value.encode()).hexdigest()

    listing = digest("".join(f"{s},{size},{q}\n" for s, size, q in runs))
    kept = digest(" ".join(w for i, w in enumerate(words) if i not in drop))
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], listing, kept)


def test_query_against_brute_force(ready, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.choice([" ", "\n", " \x0b\t"]).join(some_words(rng, 4, 60)) + rng.choice(["", " x", "\x1f y", " "])) for i in range(300)]
    rows += [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 90)))) for i in range(300, 600)]
    rows += [(None, "a " * 20), (7, "a b " * 9), (7, "a b " * 9), (11, None), (12, ""), (13, " \n ")]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 30
    table(ready, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_periodic_runs(ready, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_report(*r) for r in rows), key=repr)
