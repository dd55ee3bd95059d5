"""The trained operators against plain versions: convolution, gradient, nearest-neighbour vote; contract columns of scans."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from crownlake.llm import exact_dedup, language_id, ngram_join, quality, queries
from crownlake.llm.language_id import FILTERS, PAD, STRIDE, WIDTHS, WINDOW, pooled, softmax, strongest, train

from .conftest import table
from .conftest_llm import TEXTS, card_ok
from .test_group_operators import closure, gram_set


def plain_pooled(row, filters):
    """Largest response of every filter over the places of one window, one multiplication at a time."""
    out = []
    for w in filters:
        for f in range(FILTERS):
            out.append(max(sum(w[j][row[at + j]][f] for j in range(len(w))) for at in range(STRIDE)))
    return out


def windows(n, seed=1):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 256, (n, WINDOW)).astype(np.uint8)
    rows[0, 40:] = PAD
    return rows


def test_pooled_equals_plain_convolution():
    rng = np.random.default_rng(2)
    filters = [rng.normal(0, 1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    model = language_id.Model(["a"], filters, np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    rows = windows(2)
    want = np.array([plain_pooled(r, filters) for r in rows])
    assert np.allclose(pooled(rows, *model.pairs()), want, atol=1e-4)
    top, where = strongest(rows, filters)
    assert np.allclose(top, want, atol=1e-4) and where.max() < STRIDE


def test_first_training_step_follows_the_numeric_gradient():
    """Adam's first step is the rate times the sign of the gradient; that sign is compared with finite differences."""
    rows, labels = windows(12, 5) % 7, np.arange(12) % 3
    start = train(rows, labels, ["a", "b", "c"], epochs=0)
    stepped = train(rows, labels, ["a", "b", "c"], epochs=1)

    def loss():
        top, _ = strongest(rows, start.filters)
        p = softmax((np.maximum(top + start.bias, 0) @ start.dense + start.dense_bias).astype(np.float64))
        return -np.log(p[np.arange(12), labels]).mean()

    rng, compared = np.random.default_rng(6), 0
    for own, other in zip([*start.filters, start.bias, start.dense, start.dense_bias], [*stepped.filters, stepped.bias, stepped.dense, stepped.dense_bias]):
        moved = np.argwhere(other != own)
        for at in map(tuple, moved[rng.permutation(len(moved))[:25]]):
            kept, slopes = own[at], []
            for h in (2e-3, -2e-3):
                own[at] = kept + h
                slopes.append(loss())
            own[at] = kept
            slope = (slopes[0] - slopes[1]) / 4e-3
            if abs(slope) > 2e-3:
                assert np.sign(slope) == -np.sign(other[at] - own[at])
                compared += 1
    assert compared > 30


def test_quality_vote_equals_plain_neighbours(ready):
    rng = random.Random(2)
    good, bad = "the quick brown fox jumps over a lazy dog and sleeps well".split(), "$$$ ### BUY!! 000 &&& xx11 %%%".split()
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(rng.randrange(1, 40)))) for i in range(400)]
    labels = ready.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    model = quality.fit(table(ready, rows), labels, 300)
    asked = [t for _, t in rows[:60]] + ["", "unseen words only", "é𝒳"]
    got = model.score(pa.array(asked))
    for text, score in zip(asked, got):
        if not text:
            assert score == model.share
            continue
        own = model.project(quality.features(pa.array([text])))[0].astype(float)
        votes = []
        for column in range(len(model.labels)):
            cosine = sum(a * b for a, b in zip(own, model.vectors[:, column].astype(float)))
            votes.append((cosine, max(cosine, 1e-6) ** quality.SHARPNESS * model.weights[column], model.labels[column]))
        near = sorted(votes, reverse=True)[: quality.NEIGHBOURS]
        assert abs(score - sum(v * y for _, v, y in near) / sum(v for _, v, _ in near)) < 2e-3
    assert np.mean((got[:60] > 0.5) == np.array([i % 2 for i in range(60)])) > 0.95


def secrets(text):
    kinds = [
        ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def personal(text):
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: card_ok(m[0])),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m)]


def test_contract_columns_of_the_scans(ready, tmp_path):
    rows = list(enumerate(TEXTS)) + [(5000, None)]
    table(ready, rows).write.parquet(str(tmp_path / "documents.parquet"))
    for query, plain, kinds in (
        (queries.op2_secret_scan, secrets, ["assign", "access", "hex"]),
        (queries.op3_personal_data, personal, ["email", "ip", "card", "phone"]),
    ):
        got = {r.doc_id: r for r in query(ready, str(tmp_path)).collect()}
        for i, text in rows:
            spans = plain(text or "")
            assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds], text
            assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest(), text


def test_contract_columns_of_the_fingerprints(ready, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(7000, TEXTS[3]), (7001, None), (7002, "")]
    table(ready, rows).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op5_fingerprints(ready, str(tmp_path)).collect()}
    texts = [t or "" for _, t in rows]
    edited = []
    for at, text in enumerate(texts):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + texts[(at + 1) % len(texts)][:half])
    by_text = {}
    for (i, _), text, new in zip(rows, texts, edited):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        for t, f in ((text, r.fingerprint), (new, r.edited_fingerprint)):
            assert by_text.setdefault(t, f) == f
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(by_text.values())) > 0.9 * len({tuple(filter(None, re.split(r"\n", t))) for t in by_text})


def test_shared_class_keys_are_told_apart(ready):
    """With keys of five bits most sets share theirs with another; the groups are those of all pairs all the same."""
    rng = np.random.default_rng(3)
    bases = [[f"w{x}" for x in rng.integers(0, 400, 40)] for _ in range(30)]
    rows = []
    for i in range(150):
        words = list(bases[i % 30])
        words[int(rng.integers(40))] = f"n{rng.integers(4)}"
        rows.append((i, " ".join(words)))
    sets = [frozenset(gram_set(t, 5)) for _, t in rows]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in ngram_join.linked_groups(table(ready, rows).repartition(5), 5, 80, key_bits=5).collect()}
    assert got == dict(enumerate(closure(len(sets), links)))


def test_stages_take_any_other_columns(ready, empty):
    """Columns named like the operators' own, and of types that have no order."""
    from pyspark.sql import functions as F

    rows = [(1, "same text here"), (2, "Same text here"), (2, "SAME text here"), (3, "another text of five words or more"), (None, None), (4, "")]
    names = ("__key", "__row", "__suspect_id", "__text", "__class", "row", "class", "digest", "label")
    docs = table(ready, rows).withColumns({c: F.lit(1) for c in names}).withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))
    exact = exact_dedup.deduplicate(docs)
    near = ngram_join.one_of_each(docs, 3, 80)
    assert exact.columns == near.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in exact.collect()) == [2, 3, 4]  # of the empty texts the row with an id stays
    assert sorted((r.doc_id or 0) for r in near.collect()) == [0, 1, 3, 4]
    assert all(r.extra == {"k": 1} for r in near.collect())
    for stage in (exact_dedup.deduplicate, ngram_join.one_of_each, language_id.recognised):
        assert stage(empty).count() == 0 and stage(empty).columns == empty.columns
