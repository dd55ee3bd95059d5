"""Operators that look at one document at a time, against brute force."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from .conftest_llm import TEXTS, card_ok

from crownlake.llm import fingerprints, language_id, packing, pii, quality, secret_scan, token_counts
from crownlake.llm.queries import tokenizer_path

from .conftest import AWKWARD, table

SENTENCES = {
    "en": "the house and the garden were with that thing which they should have",
    "de": "der die das und nicht eine mit auch für über schön werden sich haben",
    "fr": "le la les des une est dans pour avec très été où ça être même leur",
}


def labelled(n=60):
    rng = np.random.default_rng(1)
    out = []
    for i in range(n):
        lang = list(SENTENCES)[i % 3]
        out.append((i, " ".join(rng.permutation(SENTENCES[lang].split())), lang, "s"))
    return out


def test_language_learns_and_defines_awkward_cases(ready, awkward, empty):
    rows = {r.doc_id: r for r in language_id.language_report(table(ready, labelled()), 60).collect()}
    held = [r for r in rows.values() if r.held_out]
    assert {i for i, r in rows.items() if r.held_out} == {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == labelled()[r.doc_id][2] for r in held) >= 0.9 * len(held)
    got = language_id.language_report(awkward, 20).collect()
    assert len(got) == len(AWKWARD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 6)} == {"und"}
    assert language_id.language_report(empty).count() == 0
    kept = language_id.recognised(awkward, 20)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 4


def test_windows_cover_every_byte_sequence():
    data = np.arange(1000, dtype=np.int64) % 251
    starts, lengths, of = language_id.cut_windows(data.astype(np.uint8), np.array([0, 0, 3, 300, 1000]))
    grams = {(int(o), int(s) + i) for s, n, o in zip(starts, lengths, of) for i in range(max(0, n - 3))}
    assert grams == {(2, i) for i in range(3, 297)} | {(3, i) for i in range(300, 997)}


def test_secrets_match_plain_scan(ready, awkward, empty):
    found = {r.doc_id: r.spans for r in secret_scan.find_secrets(table(ready, list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        spans = []
        for n, rule in enumerate(secret_scan.RULES):
            spans += [(m.start(rule.begin), n, m.end()) for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.minimum]
        assert found[i] == ",".join(f"{secret_scan.RULES[n].kind}:{a}:{b}" for a, n, b in sorted(spans)), text[:80]
    assert any(found.values())
    assert secret_scan.find_secrets(awkward).count() == len(AWKWARD)
    assert secret_scan.find_secrets(empty).count() == 0


@pytest.mark.parametrize("pattern,text", [("abc|xbcd", "xbcd"), ("(ab)?cde", "cde"), ("a[bc]de+", "acdeee"), ("(?ai:AbC)[0-9]", "aBc1"), ("x{3}yz", "xxxyz"), ("a.b", "a-b")])
def test_trigram_queries_never_miss(pattern, text):
    rule = secret_scan.Rule("x", pattern)
    assert secret_scan.Scanner([rule]).spans(pa.array([text, "nothing"]))[0]


def test_personal_data_matches_plain_scan(ready, awkward, empty):
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", card_ok),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
    ]
    rows = {r.doc_id: r for r in pii.report(table(ready, list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        base = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]
        assert [s for s in rows[i].spans.split(",") if s and not s.startswith("iban")] == base, text[:80]
    assert any("iban" in r.spans for r in rows.values())
    assert pii.report(awkward).count() == len(AWKWARD)
    assert pii.report(empty).count() == 0


def test_language_filter_follows_its_model(ready):
    """Null languages get the right prediction, so a constant in the model's place fails."""
    words = {"en": "the of and that with", "de": "der und nicht mit ein", "fr": "les des une pour avec"}
    rng = random.Random(8)
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        text = " ".join(rng.choice(words[lang].split()) for _ in range(40))
        rows.append((i, text, lang if i % 2 else None, "a"))
    rows += [(900, "1234 !!", "en", "a"), (901, None, "en", "a"), (902, "", None, "a")]
    kept = {r.doc_id: r.lang for r in language_id.recognised(table(ready, rows), 120).collect()}
    assert kept == {i: ["en", "de", "fr"][i % 3] for i in range(240)}
    assert language_id.recognised(table(ready, rows), 120, confidence=1.1).count() == 0


def test_packing_round_trip(ready, awkward, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    docs = table(ready, list(enumerate(TEXTS)))
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), size=64).collect()
    ids = [e.ids + [packing.END_TOKEN] for e in tokenizer.encode_batch(TEXTS, add_special_tokens=False)]
    for i, own in enumerate(ids):
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start):
            part = np.array(own[p.start : p.start + p.length], "<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(own), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(own)
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert all(n <= 64 and n & (n - 1) == 0 for n in sequences.values())
    assert packing.pack(empty, tokenizer_path("word_bpe_49k.json")).count() == 0
    assert packing.pack(awkward, tokenizer_path("word_bpe_49k.json")).selectExpr("sum(length)").first()[0] > 30_000


def test_packing_encodes_as_the_library_does():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    rng = np.random.default_rng(3)
    signs = [*"abXYZéÉßÿÞÅ×.,;:!?'- \t\n\x0b\x1c\u0085\u00a0\u200b\u2028\u0301\u030a\u030c\u0308019<|>$日ΩдİǅﬁK", "<|endoftext|>", "'S", "...", "Word", "Naïve", ". "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 25))) for _ in range(20_000)]
    texts += ["Y\u030a J\u030c. H\u0331, T\u0308", "X <|endoftext|> X.", "É. É, ÉCOLE!? école...", ""]
    ids, offsets = packing.encode_batch(path, pa.array(texts))
    for i, want in enumerate(Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want.ids, texts[i]


def test_hilbert_neighbours_touch():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(packing.hilbert_key(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_fingerprints_recover_set_likeness(ready, awkward, empty):
    rows = {r.doc_id: r for r in fingerprints.edit_report(table(ready, list(enumerate(TEXTS)))).collect()}

    def near(a, b):
        x, y = (set(fingerprints.paragraph_digests(t).tolist()) for t in (a, b))
        return len(x & y) / len(x | y) if x | y else 1.0

    for i, text in enumerate(TEXTS):
        following = TEXTS[(i + 1) % len(TEXTS)]
        assert rows[i].near_edited == pytest.approx(near(text, fingerprints.edited(text, following)))
        assert rows[i].near_next == pytest.approx(near(text, following))
    assert fingerprints.edit_report(awkward).count() == len(AWKWARD)
    assert fingerprints.edit_report(empty).count() == 0
    alone = fingerprints.edit_report(table(ready, [(3, "one. two.")])).first()
    assert alone.near_next == 1.0


def test_quality_votes(ready, awkward, empty):
    rng = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(80):
        words = rng.permutation(SENTENCES["en"].split())
        rows.append((i, " ".join(words) if i % 2 else "!! ".join(w.upper() for w in words), "en", "s"))
        marks.append((i, i % 2, 0))
    labels = ready.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = quality.quality_report(table(ready, rows), labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out)
    assert all(0 <= r.score <= 1 for r in quality.quality_report(awkward, labels).collect())
    assert quality.quality_report(empty, labels).count() == 0
    assert {r.score for r in quality.quality_report(awkward, labels.where("false")).collect()} == {0.5}


def test_token_counts_equal_the_library_and_use_the_cache(ready, awkward, empty, tmp_path):
    import sentencepiece

    path, cache = tokenizer_path("piece_bpe_32k.model"), f"file://{tmp_path}/cache"
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spaces = ["  ", " x", "e ", "a  b ", "\n \n  ", "a \n b", "▁a ▁ b", "  a  b  "]
    docs = table(ready, list(enumerate(TEXTS + spaces)))
    for _ in range(2):
        got = {r.doc_id: r for r in token_counts.count_tokens(docs, path, cache).collect()}
        assert [got[i].n_tokens for i in range(len(got))] == [len(x) for x in model.encode(TEXTS + spaces)]
        assert all(got[i].n_bytes == len(t.encode()) for i, t in enumerate(TEXTS + spaces))
    assert ready.read.option("recursiveFileLookup", "true").parquet(cache).count() == len(set(TEXTS + spaces))
    counted = token_counts.count_tokens(awkward, path, cache).collect()
    assert len(counted) == len(AWKWARD) and {r.n_tokens for r in counted if r.doc_id in (1, 2)} == {0}
    assert token_counts.count_tokens(empty, path, cache).count() == 0


def test_token_counts_of_texts_that_hold_the_space_mark(ready):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    bits = ["▁", " ", "a", "b", "é", "word", "▁a", " ▁", "▁ ", "\n", "7"]
    texts = ["a▁ ", "▁", " ▁ ", "▁▁ "] + ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(20_000)]
    assert token_counts.count_batch(path, pa.array(texts)).tolist() == [len(x) for x in model.encode(texts)]


def test_half_counted_table_encodes_only_the_rest(ready, tmp_path, monkeypatch):
    path, cache = tokenizer_path("piece_bpe_32k.model"), f"file://{tmp_path}/cache"
    monkeypatch.setattr(token_counts, "HOT_ROWS", 5)
    rows = [(i, f"text {i % 40} " + "x " * (i % 7)) for i in range(400)] + [(1000 + i, "one very common text") for i in range(300)]
    half, docs = table(ready, rows[:200]), table(ready, rows)
    token_counts.count_tokens(half, path, cache).count()
    before = ready.read.option("recursiveFileLookup", "true").parquet(cache).count()
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path, cache).collect()}
    stored = ready.read.option("recursiveFileLookup", "true").parquet(cache)
    assert before == len({t for _, t in rows[:200]}) and stored.count() == len({t for _, t in rows})
    counts = token_counts.count_batch(path, pa.array([t for _, t in rows])).tolist()
    assert got == {i: (len(t), n) for (i, t), n in zip(rows, counts)}
    version = token_counts.tokenizer_digest(path)
    token_counts.append_to_cache(ready.read.option("recursiveFileLookup", "true").schema(token_counts.CACHE).parquet(cache), cache)  # a second run at once
    token_counts.compact(ready, cache, version)
    assert ready.read.option("recursiveFileLookup", "true").parquet(cache).count() == len({t for _, t in rows})
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path, cache).collect()} == got


def iban_brute(text):
    """From each word that can begin one: of the beginnings that pass mod-97, the one of its country's length, else the longest."""
    out = []
    for head in re.finditer(r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})", text):
        run = re.match(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9])*", text[head.start() :])[0]
        valid = []
        for end in range(1, len(run) + 1):
            part, rest = run[:end], text[head.start() + end : head.start() + end + 1]
            plain = part.replace(" ", "")
            if not re.match("[A-Za-z0-9]", rest) and not part.endswith(" ") and 15 <= len(plain) <= 34:
                if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                    valid.append(part)
        exact = [v for v in valid if f"{v[:2]}{len(v.replace(' ', ''))}" in pii.LENGTHS.split()]
        if valid:
            out.append((head.start(), head.start() + len((exact[:1] or valid[-1:])[0])))
    return out


def test_account_numbers_beside_capitals_and_figures(ready):
    de, gb = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    once = {
        f"{de} BIC COBADEFFXXX": de, f"{de} EUR 50": de, f"{de} 2024-01-01": de, f"ID AB12 {gb}": gb, f"AB12 3456 7890 1234 5678 {gb} REF 1": gb,
        f"é𝒳 {de} ABCDEFGHIJKLMNOPQRSTUVWXYZ": de, f"PAY {gb} NOW": gb, f"{de}.": de, f"{gb} bank": gb, "DE89 370 400 440 532 013 000 X": "DE89 370 400 440 532 013 000",
    }
    rng = np.random.default_rng(7)
    words = [de, gb, "AB12", "XY99", "EUR", "50", "BIC", "COBADEFFXXX", "bank", "\x01", "\x03", "é𝒳", "NO9386011117947", "-", "A1"]
    mixed = [" ".join(rng.choice(words, rng.integers(1, 14))) for _ in range(150)]
    rows = list(enumerate([*once, *mixed, f"{de} {gb} " * 3, "AB12 " * 400, f"x{de}", f"{de}x"]))
    got = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("iban")] for r in pii.report(table(ready, rows)).collect()}
    for i, text in rows:
        assert got[i] == iban_brute(text), text[:80]
        if text in once:
            assert got[i] == [(text.index(once[text]), text.index(once[text]) + len(once[text]))], text


def test_account_number_context_is_the_text_beside_it(ready):
    de = "DE89370400440532013000"
    rows = [(1, f"iban AB12 CD34 {de} EUR"), (2, f"{de} EUR 50 example"), (3, f"{de} EUR 50"), (4, "iban " + "." * 40 + de)]
    assert {r.doc_id: r.scores for r in pii.report(table(ready, rows)).collect()} == {1: "100", 2: "70", 3: "90", 4: "90"}


def test_texts_with_letters_pass_without_a_model(ready):
    def kept(rows):
        return sorted(r.doc_id for r in language_id.recognised(table(ready, rows), 60).collect())

    unusable = [(i, f"text number {i}", None, "s") for i in range(20)] + [(20, None), (21, ""), (22, "12 34")]
    assert kept(unusable) == list(range(20))
    held = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 == 2 else None, s) for i, t, lang, s in labelled()]
    assert kept(held) == list(range(60))
    assert kept([(i, t, "und", s) for i, t, _, s in labelled()] + [(60, "12 34")]) == list(range(60))


def test_logins_with_long_or_no_names(ready):
    long = "eyJ" + "a1._-" * 400
    rows = [(1, f"see https://user:{long}@host/x"), (2, "redis://:secret1@host:6379"), (3, f"ftp://{'u' * 65}:abc@h"), (4, "http://u:ab@h http://host:80/a@b")]
    rows += [(6, "9+postgresql+asyncpg.with.a.long.scheme.name://u:secret@h"), (7, "x" * 500_000), (8, "-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----")]
    rows += [(5, "ab://" + "x" * 300_000 + " " + "cd://u:" + "y" * 300_000)]
    found = {r.doc_id: r.spans for r in secret_scan.find_secrets(table(ready, rows)).collect()}
    logins = {i: [s for s in spans.split(",") if s.startswith("url_login")] for i, spans in found.items()}
    assert logins == {1: [f"url_login:4:{rows[0][1].index('@') + 1}"], 2: ["url_login:0:17"], 3: ["url_login:0:76"], 4: [], 5: [], 6: ["url_login:2:56"], 7: [], 8: []}
    assert found[8] == f"private_key:0:{len(rows[6][1])}"


def test_fingerprints_are_the_same_over_any_number_of_ranges(ready):
    docs = table(ready, [(i * 7 - 50, t) for i, t in enumerate(TEXTS)] + [(None, "null. id."), (-50, "same. id.")])
    asked, seen = ready.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("1", "3", "400"):
            ready.conf.set("spark.sql.shuffle.partitions", partitions)
            seen.append(sorted(map(tuple, fingerprints.edit_report(docs).collect()), key=repr))
    finally:
        ready.conf.set("spark.sql.shuffle.partitions", asked)
    assert len(seen[0]) == len(TEXTS) + 2 and seen[0] == seen[1] == seen[2]


def test_the_language_filter_evaluates_the_network_once(ready):
    docs = table(ready, [(i, t, "en" if i % 2 else "de", "a") for i, t in enumerate(TEXTS)])
    kept = language_id.recognised(docs, 60)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
