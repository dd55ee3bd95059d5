"""Operators over groups of documents, and the pipeline, against brute force."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crownlake.llm import components, exact_dedup, mixing, ngram_join

from .conftest import AWKWARD, table


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("n,span", [(1, 1), (1, 1 << 40), (500, 1 << 20), (3000, 1 << 44)])
def test_golomb_round_trip(n, span):
    values = np.unique(np.random.default_rng(n).integers(0, span, n))
    assert (exact_dedup.golomb_decode(len(values), *exact_dedup.golomb_encode(values, span)) == values).all()


def test_exact_dedup(ready, empty):
    rows = [(i, ["Same TEXT", "same text", None, "", f"own {i}", "É"][i % 6]) for i in range(120)]
    got = {r.doc_id: r for r in exact_dedup.decisions(table(ready, rows).repartition(7)).collect()}
    for i, text in rows:
        group = [j for j, t in rows if ascii_lower(t) == ascii_lower(text)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(group), len(group), i == max(group))
        assert got[i].text_sha256 == hashlib.sha256(ascii_lower(text).encode()).hexdigest()
    assert exact_dedup.decisions(empty).count() == 0


def test_exact_dedup_awkward(awkward):
    assert exact_dedup.decisions(awkward).count() == len(AWKWARD)
    kept = exact_dedup.deduplicate(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({ascii_lower(t) for _, t, *_ in AWKWARD})


def closure(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components_chain_star_and_pairs(ready):
    links = [(i, i + 1) for i in range(0, 40)] + [(50, j) for j in range(51, 80)] + [(90, 91), (93, 92), (92, 94)]
    got = dict(components.components(ready.createDataFrame(links, "a bigint, b bigint")).collect())
    want = closure(95, links)
    assert got == {v: want[v] for v in {x for link in links for x in link}}


def gram_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_equals_all_pairs(ready, n, percent):
    rng = np.random.default_rng(n)
    bases = [[f"w{x}" for x in rng.integers(0, 400, size)] for size in (30, 60, 60, 120, 200)]
    texts = ["", None, "one two", "ONE two", " \n"]
    for _ in range(160):
        words = list(bases[rng.integers(len(bases))])
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(len(words))] = f"n{rng.integers(10_000)}"
        texts.append(" ".join(words))
    sets = [gram_set(t, n) for t in texts]
    links = [
        (a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = closure(len(sets), links)
    got = {r.doc_id: r for r in ngram_join.linked_groups(table(ready, list(enumerate(texts))).repartition(4), n, percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_ngram_join_awkward(awkward, empty):
    assert ngram_join.linked_groups(awkward).count() == len(AWKWARD)
    assert ngram_join.linked_groups(empty).count() == 0
    assert ngram_join.one_of_each(awkward).columns == awkward.columns


def brute_mix(rows, target, limit, share):
    """Copies of each row by the definition."""

    def place(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)

    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    totals = {}
    for i, _, s in rows:
        totals[s] = totals.get(s, 0) + size[i]
    budget = int(share * sum(totals.values()))

    def weights(a):
        raised = {s: t**a for s, t in totals.items()}
        return {s: r / sum(raised.values()) for s, r in raised.items()}

    def least(low, bad):
        high = 1.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (middle, high) if bad(weights(middle)) else (low, middle)
        return high

    power = 0.0
    if target is not None:
        power = least(0.0, lambda w: -sum(x * math.log(x) for x in w.values()) > target * math.log(len(totals)))
    if limit is not None and max(w * budget / totals[s] for s, w in weights(power).items()) > limit:
        power = least(power, lambda w: max(x * budget / totals[s] for s, x in w.items()) > limit)
    out = {}
    for s, w in weights(power).items():
        whole, rest = divmod(round(w * budget), totals[s])
        own = [(place(i), i) for i, _, of in rows if of == s]
        ran = 0
        for *_, p, i in sorted((place(whole, p % 1024, s), p % 1024, p // 1024 % 1024, p, i) for p, i in own):
            ran += size[i]
            out[i] = whole + (ran <= rest)
    return out


@pytest.mark.parametrize("target,limit,share", [(0.97, None, 1.0), (0.99, 1.5, 1.0), (None, 1.0, 0.9)])
def test_mixture_equals_definition(ready, target, limit, share):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["x"] * int(rng.integers(1, 40))), ["hot", "hot", "hot", "b", "c"][i % 5]) for i in range(400)]
    docs = table(ready, [(i, t, "en", s) for i, t, s in rows])
    got = {r.doc_id: r.copies for r in mixing.mixture(docs, target, limit, share).collect()}
    assert got == brute_mix(rows, target, limit, share)
    taken = mixing.mixed(docs, target, limit, share).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in taken} == {i: c for i, c in got.items() if c}


def test_mixture_awkward(awkward, empty):
    assert mixing.mixture(awkward, 0.9).count() == len(AWKWARD)
    assert mixing.mixture(empty, 0.9).count() == 0
    assert mixing.mixed(awkward, limit=1.0, budget_share=0.9).columns == awkward.columns


def test_pipeline_stages(ready, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(ready, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    rows = docs.groupBy("doc_id", "text").count().collect()
    pieces = corpus_pipeline.STAGES[-1][1](ready, docs, "")
    lengths = pieces.groupBy("doc_id", "copy", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert lengths and all(r.n == r.doc_tokens for r in lengths)
    # A piece for each row that went in: id 5 holds two texts, and the mixture repeats some rows.
    assert sorted((r.doc_id or -1, r.copy) for r in lengths) == sorted((r.doc_id or -1, c) for r in rows for c in range(r["count"]))


def test_pipeline_on_an_empty_table(ready, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(ready, docs, "")
    assert docs.count() == 0


def test_no_sequence_holds_a_document_twice(ready):
    rows = [(i, f"document {i} " + " ".join(f"w{(i * 7 + j) % 50}" for j in range(i % 90))) for i in range(120)]
    repeated = [r for r in rows for _ in range(1 + r[0] % 3)] + [rows[0]] * 20 + [(None, "no id")] * 3 + [(5, "another text of five")] * 2
    pieces = corpus_pipeline.packed(ready, table(ready, repeated).repartition(7), "").collect()
    assert len({(p.doc_id, p.copy, p.doc_tokens) for p in pieces}) == len(repeated)
    inside = {}
    for p in pieces:
        inside.setdefault(p.sequence_id, []).append((p.doc_id, p.doc_tokens))
    assert all(len(set(docs)) == len(docs) for docs in inside.values())
    assert max(len(docs) for docs in inside.values()) > 10


@pytest.mark.parametrize("sources", [["hot", "hot", "hot", "b", "c"], ["one"], ["a", "b"]])
def test_least_budget_loses_no_document(ready, sources):
    rows = [(i, " ".join(["x"] * (1 + i % 17)), "en", sources[i % len(sources)]) for i in range(300)]
    docs = table(ready, rows + [(1000, "", "en", "no tokens"), (None, "no id", "en", None)])
    got = {r.doc_id: r for r in mixing.mixture(docs, limit=2.0, budget_share=None).collect()}
    assert len(got) == 302 and all(1 <= r.copies <= 2 for r in got.values())
    assert any(r.copies == 2 for r in got.values()) and (got[1000].quota, got[1000].copies) == (0, 1)
    if "hot" in sources:
        assert all(r.copies == 1 for r in got.values() if r.source == "hot")
    assert mixing.mixed(docs.limit(0), limit=2.0, budget_share=None).count() == 0


@pytest.mark.parametrize("sources", [["hot", "hot", "hot", "b", "c"], ["one"], ["a", "b"]])
def test_mixing_stage_keeps_every_document(ready, sources):
    docs = table(ready, [(i, " ".join(["x"] * (1 + i % 17)), "en", sources[i % len(sources)]) for i in range(300)])
    mixed = corpus_pipeline.mix(ready, docs, "")
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.select("doc_id").collect()} == set(range(300))


def brute_one_of_each(rows, n, percent):
    """(id, set) of every kept row: one of each component, by the smallest id (null first), and all without words."""
    sets = [frozenset(gram_set(t, n)) for _, t in rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    groups = {}
    for row, label in enumerate(closure(len(sets), links)):
        groups.setdefault(label, []).append(row)
    least = ngram_join.NULL_KEY
    return [min(least if rows[r][0] is None else rows[r][0] for r in g) for g in groups.values()], {
        label: {sets[r] for r in g} for label, g in groups.items()
    }


def test_one_of_each_by_row_on_repeated_and_null_ids(ready, awkward):
    rng = np.random.default_rng(3)
    bases = [[f"w{x}" for x in rng.integers(0, 400, 60)] for _ in range(8)]
    rows = [(0, ""), (0, None), (3, " "), (None, ""), (70, "own clean text of this id"), (70, " ".join(bases[0]))]
    for i in range(120):
        words = list(bases[rng.integers(len(bases))])
        words[rng.integers(60)] = f"n{rng.integers(4)}"
        text = " ".join(words) if i % 5 else f"alone {i} with some other words {i}"
        rows.append((None if i % 11 == 0 else int(rng.integers(1, 60)), text.upper() if i % 7 == 0 else text))
        if i % 9 == 0:
            rows.append(rows[-1])
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each(table(ready, rows).repartition(5), 5, 80).collect()]
    assert all(row in rows for row in got)
    ids, sets = brute_one_of_each(rows, 5, 80)
    wordless = [r for r in rows if not gram_set(r[1], 5)]
    assert sorted((r for r in got if not gram_set(r[1], 5)), key=str) == sorted(wordless, key=str)
    worded = [(ngram_join.NULL_KEY if i is None else i, frozenset(gram_set(t, 5))) for i, t in got if gram_set(t, 5)]
    groups = [s for s in sets.values() if s != {frozenset()}]
    assert len(worded) == len(groups)
    assert sorted(i for i, _ in worded) == sorted(i for i, s in zip(ids, sets.values()) if s != {frozenset()})
    assert all(sum(own in s for _, own in worded) == 1 for s in groups)
    kept = ngram_join.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9]


def test_components_go_on_from_known_ones(ready):
    """The near-duplicate stage found all components anew for each lot of links, with a job of its own to count each round."""
    kind, rng = "a bigint, b bigint", np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2)) if a != b]
    known = components.stored(components.components(ready.createDataFrame(links[:25], kind)), "known")
    assert components.joined(known, ready.createDataFrame([], kind)) is known
    got = dict(components.joined(known, ready.createDataFrame(links[25:], kind)).collect())
    label = closure(60, links)
    assert got == {v: label[v] for link in links for v in link}
    assert components.components(ready.createDataFrame([], kind)).count() == 0
