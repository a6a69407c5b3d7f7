"""Operators on single texts and on repeated text, against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import bpe, minhash, packing, quality, queries, substrings
from clickloom.llm.words import blocks

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def definition():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    found.no_truncation()
    found.no_padding()
    return found


HARD = [
    "", None, "hello world", "I'm  it's 'sample' ''s  's\n's 're 'rex don't'll've", "a  b\n\n c \t d   ", " " * 300 + "x",
    "aaaa" * 500, "x<|endoftext|>y <|endoftext|>", "èü 漢字 \U0001f600 １２ ½ ²",
    " 　a  b", "'", "''", " '", " 's", "x'", "\r\n \r\n", "\x00\x01", "y" * 20_000,
]


def test_encoder_equals_the_library(definition, library):
    rng = random.Random(1)
    texts = [*HARD, *["".join(rng.choice("abcdetTH  '\n'.srelv19é漢\U0001f600 ") for _ in range(rng.randint(0, 60)))
                      for _ in range(3000)]]
    encoder = bpe.Encoder(definition)
    for text, ids in zip(texts, encoder.batch(pa.array(texts, pa.string())), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids, text
        decoded = encoder.automaton.decode(np.array(ids, np.int64)).tobytes().decode("utf-8", "replace")
        assert decoded == library.decode(ids, skip_special_tokens=False)


def test_words_with_one_hash_are_told_apart(definition, monkeypatch):
    monkeypatch.setattr(bpe.Words, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    ids = bpe.Encoder(definition).batch(pa.array(["one two three"]))[0]
    assert bpe.Automaton(definition).decode(np.frombuffer(ids, "<u4").astype(np.int64)).tobytes() == b"one two three"


def test_op1(spark, folder, library, definition, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op1_bpe_codec"](spark, folder).collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    import hashlib

    for r in texts:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        found = rows[r.doc_id]
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found.decoded_sha256 == brute.hexed(library.decode(ids, skip_special_tokens=False))
    odd = bpe.encode(documents([(None, "a b", None), (1, None, "s"), (1, "", "s"), (1, "a b", "s")]), definition).collect()
    assert sorted(len(r.token_ids) for r in odd) == [0, 0, 8, 8]
    again = bpe.decode(bpe.encode(documents([(1, "a  b\n", "s"), (2, None, "s")]), definition), definition).collect()
    assert {r.doc_id: r.decoded for r in again} == {1: "a  b\n", 2: ""}
    assert bpe.encode(documents([]), definition).count() == 0


def _near_copies(rng, count):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(count):
        found = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        if texts and rng.random() < 0.6:
            found = brute.words(texts[rng.choice(list(texts))]) or found
            for _ in range(rng.randint(0, 4)):
                found[rng.randrange(len(found))] = rng.choice(vocabulary)
        texts[i * 3 + 1] = " ".join(found)
    return texts


def test_near_duplicates_against_all_pairs(documents):
    rng = random.Random(5)
    texts = {**_near_copies(rng, 300), 0: None, 2: "", 5: "A b", 8: "a B", 11: "a b c", 1002: " \n", 1005: "x " * 6000}
    settings = minhash.Settings(block=16)
    got = minhash.near_duplicates(documents([(i, t, "s") for i, t in texts.items()]), settings=settings).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_without_a_common_centre(documents):
    """A chain: neighbours are linked, the ends are not, and one bucket may hold them all."""
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(60):
        found = list(base)
        found[:i] = [f"v{j}" for j in range(i)]
        texts[100 - i] = " ".join(found)
    got = minhash.near_duplicates(documents([(i, t, "s") for i, t in texts.items()])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(texts)


def test_near_duplicates_of_odd_rows(documents):
    got = minhash.near_duplicates(documents([(None, "a b c", "s"), (7, "a b c", "s"), (7, "a b c", "s"), (9, "a b c", None)]))
    assert sorted(map(str, got.select("doc_id", "component_id", "kept").collect())) == sorted(map(str, [
        *got.sparkSession.createDataFrame(
            [(None, None, True), (7, 7, True), (7, 7, True), (9, 7, False)],
            "doc_id long, component_id long, kept boolean").collect()]))
    assert minhash.near_duplicates(documents([])).count() == 0


def _passages(rng, count):
    passages = [[f"p{k}_{i}" for i in range(rng.randint(15, 60))] for k in range(6)]
    out = []
    for i in range(count):
        found = []
        for _ in range(rng.randint(0, 5)):
            found += rng.choice(passages)[rng.randint(0, 5):]
            found += [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        out.append((i, rng.choice([" ", "\n", "\t "]).join(found)))
    return out


def test_repeats_against_all_windows(documents):
    rng = random.Random(9)
    rows = [*_passages(rng, 150), (1000, None), (1001, ""), (1002, "a " * 500), (1003, "a " * 19), (1004, "a " * 20)]
    shuffled = rng.sample(rows, len(rows))
    found = substrings.remove_repeats(documents([(i, t, "s") for i, t in shuffled])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == brute.remove_repeats(sorted(rows, key=lambda r: r[0]))
    for r in found:
        covered = {i for s in r.spans for i in range(s.start, s.start + s.length)}
        assert len(covered) == r.n_removed and all(s.length >= 20 for s in r.spans)


def test_repeats_over_many_chunks(spark, documents, monkeypatch):
    monkeypatch.setattr(substrings, "chunked", lambda *a, **k: chunked(*a, **{**k, "chunk_bytes": 4000}))
    from clickloom.llm.tables import chunked

    rows = _passages(random.Random(10), 120)
    found = substrings.remove_repeats(documents([(i, t, "s") for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == brute.remove_repeats(rows)


def test_repeats_of_odd_rows(documents):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(None, long, "s"), (4, long, "s"), (4, long, "s"), (None, long, None), (3, "x", "s")]
    found = substrings.remove_repeats(documents(rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("3", 0), ("4", 0), ("4", 30), ("None", 30), ("None", 30)]
    assert substrings.remove_repeats(documents([])).count() == 0
    same = substrings.remove_repeats(documents([(1, "a\n b", "s")]), original=True, carry=("source",)).first()
    assert (same.kept_text, same.source) == ("a\n b", "s")


def test_op4(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = [(i, n, gone, brute.hexed(kept)) for i, n, gone, kept in brute.remove_repeats([tuple(r) for r in rows])]
    assert sorted(map(tuple, queries.QUERIES["op4_substring_dedup"](spark, folder).collect())) == want


def test_op2(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {i: (n, c, i == c) for i, (n, c) in brute.near_duplicates({r.doc_id: r.text for r in rows}).items()}
    got = queries.QUERIES["op2_near_duplicates"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_quality_figures():
    rng = random.Random(3)
    parts = ["a", "b", "c\n", "\n", " ", "\t", "é", "漢|", "|", "#", "   x y z x y z x y z x y z x y z",
             " all rights reserved\n", "!! A!! B!! C!!\n"]
    texts = ["", None, "\n", "a", "a\n", "\na\n\na", "a\nb\na\n",
             *["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(1500)]]
    for start, stop, data, offsets in blocks(pa.array(texts), 5000):
        found = quality.judge_block(data, offsets, quality.Rules())
        for i in range(start, stop):
            got = [found[name][i - start] for name in quality.FIGURES[:6]]
            assert tuple(got) == brute.quality(texts[i]), texts[i]


def test_quality_verdicts(documents):
    other = "Here stands another line of plain prose, which says nothing at all but says it in whole words."
    clean = "The first sentence of this text has quite a number of words. The second one is shorter, but fine too. And a third."
    rows = [
        (1, clean, "s"), (2, clean + "\nAll rights reserved | Privacy policy\n" + other, "s"),
        (3, " | ".join(f"Item{i}" for i in range(40)), "s"), (4, " ".join(f"W{i}!!" for i in range(40)).upper(), "s"),
        (5, " ".join(f"word{i}%%%" for i in range(40)), "s"), (6, None, "s"), (7, "", None), (None, clean, "s"),
        (8, " ".join(w for w in clean.split() for _ in range(3)), "s"),
    ]
    got = {r.doc_id: r for r in quality.clean(documents(rows)).collect()}
    assert [i for i in sorted(k for k in got if k) if got[i].kept] == [1, 2] and got[None].kept
    assert got[1].clean_text == clean and got[2].clean_text == clean + "\n" + other
    assert got[2].n_lines_removed == 1 and got[6].clean_text is None
    kept = quality.keep_clean(documents(rows)).collect()
    assert {r.doc_id: r.n_chars for r in kept} == {1: len(clean), 2: len(clean) + 1 + len(other), None: len(clean)}
    assert quality.clean(documents([])).count() == 0


def test_op9(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op9_quality_rules"](spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows:
        f = got[r.doc_id]
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed) == brute.quality(r.text)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()
    assert all(got[r.doc_id].kept or got[r.doc_id].base_failed for r in labels)


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(2)
    items = sorted(((rng.randint(1, 60), rng.choice("abcdef"), rng.choice(range(40))) for _ in range(500)), reverse=True)
    sources, clusters = "abcdef", range(40)
    bits = [(n, 1 << sources.index(s), 1 << clusters.index(c)) for n, s, c in items]
    assert packing.best_fit(bits, 100) == brute.best_fit(items, 100)


def test_packing(spark, documents):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 1, 5, 9, 30, 61, 200]), rng.choice(["a", "b", None])) for i in range(200)]
    rows += [(None, "x y", "a"), (7, "w " * 30, "a"), (500, None, "a"), (501, " ".join(map(str, range(95))), "b")]
    measured = packing.measured(documents(rows))
    found = packing.pack(measured, capacity=30, shard_items=50).collect()
    lengths = {}
    for r in found:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: sum(len(brute.words(t)) for j, t, _ in rows if j == i) for i, t, _ in rows if brute.words(t)}
    bins = {}
    for r in found:
        bins.setdefault(r.bin_id, []).append(r)
    clusters = {r.doc_id: (r.source, r.cluster) for r in measured.where("doc_id <> 7").collect()}
    for name, members in bins.items():
        at = sorted((m.bin_offset, m.length) for m in members)
        assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False)) and at[0][0] == 0 and sum(n for _, n in at) <= 30
        for j in (0, 1):
            keys = [clusters[m.doc_id][j] for m in members if m.doc_id in clusters]
            keys = [k for k in keys if k is not None]
            assert len(keys) == len(set(keys)), name
    assert packing.pack(packing.measured(documents([]))).count() == 0


def test_packing_of_rows_that_share_an_id(documents, monkeypatch):
    """Full pieces of two texts, of one text under two sources and of thousands of equal rows lie in bins of their own."""
    monkeypatch.setattr(packing, "SLAB", 7)
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    rows = [(7, texts[0], "s"), (7, texts[1], "s"), (7, texts[1], "t"), (7, texts[1], None), *[(7, texts[2], "s")] * 50,
            (None, texts[0], "s"), (None, texts[0], "s"), (8, texts[2] + " more words", "s")]
    found = packing.pack(packing.measured(documents(rows)), capacity=30).collect()
    assert len(found) == len(rows) + 1 and sum(r.length for r in found) == 30 * len(rows) + 2
    assert len({r.bin_id for r in found}) == len(found)


def test_op8(spark, folder):
    found = queries.QUERIES["op8_best_fit_packing"](spark, folder)
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n for r in found.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == {r.doc_id: len(brute.words(r.text)) for r in rows if brute.words(r.text)}
    assert found.groupBy("bin_id").agg(F.sum("length").alias("n")).where(f"n > {packing.CAPACITY}").count() == 0
