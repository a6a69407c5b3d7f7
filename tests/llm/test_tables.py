"""Operators on pages, conversations, vectors, language models and the pipeline, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import chat, html, lm, minhash, quality, queries, substrings, vectors, warc
from clickloom.llm.components import components
from clickloom.llm.tables import shared_path

TEXT = "Some words that make up a sentence of the article, as long as sentences are. "


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(600, i) for i in range(601, 700)] + [(3, 3), (None, 5), (1, 2), (2, 1)]
    joined = brute.Sets()
    for a, b in edges:
        if a is not None and a != b:
            joined.join(a, b)
    want = {n: joined.find(n) for n in joined.parent if joined.find(n) != n}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<nav>x</nav>", ""), ("plain &lt;text&gt;", "plain <text>"),
    (f"<header>Site</header><nav><a>Home</a></nav><article><h1>T</h1><p>{TEXT}<p>Short.<p><b>x<br>y<p>z</article>",
     f"T\n{TEXT.strip()}\nShort.\nx y\nz"),
    (f"<div class='ad'>Buy<article><p>{TEXT}</p></article>", TEXT.strip()),
    (f"<div class=menu><a>a</a><a>b</a></div><div class=content><h2>T</h2><p>{TEXT}{TEXT}</p><p>ok</p></div>"
     f"<div id=cookie-notice>{TEXT}</div><div class=comments><p>{TEXT * 3}</p></div>",
     f"T\n{(TEXT * 2).strip()}\nok"),
    (f"<article><header><h1>T</h1></header><p>{TEXT}<form>Name</form><script>var a='<p>';</script><div class=share>s</div>"
     f"<p>a&amp;b&nbsp; c</p><section id=comments><article><p>{TEXT * 9}</p></article></section></article>",
     f"T\n{TEXT.strip()}\na&b c"),
    (f"<div class='main with-sidebar'><p>{TEXT}</p></div>", TEXT.strip()),
    (f"<article><p>{TEXT}</p><!-- no --><![if x]>y<![endif]></article", f"{TEXT.strip()}\ny"),
    (f"<article><p class=social-policy>{TEXT}</p><p><a href=x>{TEXT}</a></p><p class=ad>Buy</p><math><mi>x</mi></math></article>",
     f"{TEXT.strip()}\n{TEXT.strip()}\nx"),
    (f"<article><p>Teaser</p></article><div><p>{TEXT * 2}</p><p>{TEXT}</p></div>", f"{(TEXT * 2).strip()}\n{TEXT.strip()}"),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def plain_cluster(blocks):
    """Indexes of the blocks of a page that the ratio keeps; a block has its text, of that the links, and its tags"""
    ratios = [(len(t.replace(" ", "")) - n) / tags for t, n, tags in blocks]
    smooth = []
    for i in range(len(ratios)):
        near = [(math.exp(-0.5 * (i - j) ** 2), r) for j, r in enumerate(ratios) if abs(i - j) <= 3]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    mean = sum(smooth) / len(smooth)
    least = min(0.5 * math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth)), max(smooth))
    content = [x >= least for x in smooth]
    link = [n > 0.6 * len(t.replace(" ", "")) for t, n, _ in blocks]
    own = [i for i in range(len(blocks)) if content[i] and not link[i]]
    return [i for i in range(own[0], own[-1] + 1) if content[i] or not link[i]] if own else []


def test_pages_without_telling_names(monkeypatch):
    """Paragraphs of a body, among them menus of links before, between and after: the smoothed ratio alone decides."""
    rng = random.Random(3)
    pages, changed = [], 0
    for _ in range(200):
        blocks, parts = [], []
        for kind, most in (("menu", 9), ("text", 12), ("menu", 4), ("text", 8), ("menu", 9)):
            for _ in range(rng.randrange(most)):
                words = " ".join("w" * rng.randrange(1, 9) for _ in range(rng.choice((1, 3, 30, 90)) if kind == "text" else 2))
                linked = kind == "menu" or rng.random() < 0.1
                parts.append(f"<p><a href='/x'>{words}</a></p>" if linked else f"<p>{words}</p>")
                blocks.append((words, len(words.replace(" ", "")) * linked, 3 if linked else 1))
        pages.append(f"<html><body>{''.join(parts)}</body></html>")
        want = [blocks[i][0] for i in plain_cluster(blocks)] if blocks else []
        assert html.main_text(pages[-1]) == "\n".join(want)
        changed += len(want) < len(blocks)
    assert changed > 150
    kept = [html.main_text(page) for page in pages]
    monkeypatch.setattr(html, "content_lines", lambda ratios: np.ones(len(ratios), bool))
    assert sum(html.main_text(page) != text for page, text in zip(pages, kept)) > 100


def test_op3(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    import html as references
    import re

    for r in queries.QUERIES["op3_html_text"](spark, folder).collect():
        article = pages[r.page_id].html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(references.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)
    rows = spark.createDataFrame(
        [(None, None, None, "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html.extract(rows).collect()) == ["", "a", "a"]
    assert html.extract(rows.limit(0)).count() == 0


def _said(conversations):
    out = {}
    for conv, turn, role, text in sorted(conversations, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_chats_survive_the_round_trip(spark):
    rng = random.Random(8)
    parts = ["### ", "###", "#", "</turn>", "</turn", "</turn\\>", "\\", "\n", ": ", ":", " ", "user", "assistant", "é", "\U0001f600", "$1", "</turn>\n"]
    rows = [
        (i // 4, rng.randint(0, 3), rng.choice(["user", "assistant", "system", ": x", "a: ### b", "", None]),
         rng.choice([None, "", "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))])) for i in range(1200)]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (5, 0, "user", "same"), (5, 0, "user", "same")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    want = _said(rows)
    for r in chat.read_back(chat.format_chats(frame)).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id], r.formatted
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
    plain = chat.format_chats(frame.where("conv_id is null")).first()
    assert (plain.formatted, plain.escaped) == ("### assistant: y</turn>\n### user: x</turn>\n", False)
    assert chat.format_chats(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_chat_format", "op7_warc_archive"])
def test_against_sql(spark, folder, name):
    problem, rows, _ = compare(connect(folder), spark, folder, name, queries.QUERIES[name], queries.CHECKS[name])
    assert problem is None and rows > 0


def test_archive_dates(spark):
    rows = [(1, "u", "x", "2024-02-29 23:59:58.9", "a"), (2, "u", "x", None, "b"), (3, "\r\nWARC-Date: no", "y" * 1000, "1999-12-31 00:00:00", "c")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, at string, date string")
    path = shared_path(spark, "archive")
    warc.write_archive(frame, path, captured="at")
    found = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert (found[1].date, found[3].date) == ("2024-02-29T23:59:58Z", "1999-12-31T00:00:00Z")
    assert found[2].date[:3] == "202" and len(found[2].date) == 20
    assert all(r.header.count("\r\nWARC-Date: ") == 1 for r in found.values())


def test_archive(spark):
    long, short = "x" * 1200, "é" * 10
    rows = [
        (1, "u1", long, "a"), (5, "u5", long, "a"), (3, None, long, "a"), (2, "u2", short, "a"), (4, "u4", short, "a"),
        (6, "a\r\nWARC-Type: x", None, "a"), (None, "n", long, "a"), (7, "t", "y" * 1000, "a"), (7, "t", "y" * 1000, "a"),
        (8, "t", "z" * 999, "a"), (9, "t", "z" * 999, "a")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = shared_path(spark, "archive")
    warc.write_archive(frame, path)
    found = warc.read_archive(spark, path)
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in found.collect())
    assert got == sorted([
        ("1", "revisit", 5, 1200), ("5", "response", None, 1200), ("3", "revisit", 5, 1200), ("2", "response", None, 20),
        ("4", "response", None, 20), ("6", "response", None, 0), ("None", "revisit", 5, 1200), ("7", "response", None, 1000),
        ("7", "response", None, 1000), ("8", "response", None, 999), ("9", "response", None, 999)])
    payloads = {(r.page_id, bytes(r.payload)) for r in found.where("page_id < 7").collect()}
    assert payloads == {(i, (h or "").encode()) for i, _, h, _ in rows if i and i < 7}
    assert all(r.payload_digest == hashlib.sha1(r.payload).hexdigest() for r in found.collect())
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    records = {r.page_id: bytes(r.record) for r in warc.record_bytes(found).collect()}
    head, body = records[5].split(b"\r\n\r\n", 1)
    assert body == long.encode() + b"\r\n\r\n" and b"Content-Length: 1200" in head
    assert records[6].count(b"WARC-Type") == 2 and b"a%0D%0AWARC-Type" in records[6]
    path = shared_path(spark, "archive")
    warc.write_archive(frame.limit(0), path)
    assert warc.read_archive(spark, path).count() == 0


def test_damaged_payload_is_found(spark):
    path = shared_path(spark, "archive")
    frame = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    warc.write_archive(frame, path)
    spark.read.parquet(f"{path}/payloads").selectExpr("digest", "cast('y' as binary) as payload").write.mode("append").parquet(
        f"{path}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archive(spark, path).collect()


def _vectors(rng, count, width=8):
    found = {}
    for i in range(count):
        base = rng.normal(size=width)
        if found and rng.random() < 0.7:
            base = np.array(found[rng.choice(list(found))]) + rng.normal(size=width) * rng.choice([0, 0.05, 0.2])
        found[int(i * 2 + 1)] = [float(x) for x in np.float32(base)]
    return found


@pytest.mark.parametrize("settings", [
    vectors.Settings(), vectors.Settings(per_cell=20, block=16), vectors.Settings(per_cell=5, max_cells=3, block=1000)])
def test_vectors_against_all_pairs(spark, settings):
    rng = np.random.default_rng(12)
    found = _vectors(rng, 240)
    found.update({0: None, 2: [], 4: [0.0] * 8, 6: [math.nan] + [1.0] * 7, 8: [math.inf] + [1.0] * 7, 10: [None] + [1.0] * 7,
                  12: [1.0, 0.0, 0.0], 14: [2.0, 0.0, 0.0], 16: [1e30] * 8, 18: [1e-30] * 8})
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in found.items()],
                                  "vec_id long, embedding array<double>, label int, unit string")
    got = {r.vec_id: r for r in vectors.near_vectors(frame, settings=settings).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == brute.links(found)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_odd_vectors(spark):
    frame = spark.createDataFrame(
        [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(frame).collect())
    assert got == [("3", 1, 3, True), ("3", 1, 3, True), ("5", 1, 3, False), ("None", 0, None, True)]
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_vectors_are_written_once(spark):
    """Vectors without structure are near every cell; what is written must not grow with the number of cells."""
    found = np.float32(np.random.default_rng(3).normal(size=(3000, 32)))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(found)], "vec_id long, embedding array<float>")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {p for p in shared.iterdir()} if shared.exists() else set()
    settings = vectors.Settings(cosine=0.7, per_cell=50, block=50)
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame, settings=settings).collect()}
    units = found.astype(float) / np.linalg.norm(found.astype(float), axis=1)[:, None]
    want = (units @ units.T >= 0.7).sum(axis=1) - 1
    assert got == dict(enumerate(want.tolist()))
    written = sum(p.stat().st_size for top in set(shared.iterdir()) - before for p in top.rglob("*.parquet"))
    assert written < 4 * found.nbytes


def test_vectors_without_overlap(spark):
    """Vectors as near to one pivot as to all others have one cell, and near-equal ones need no pivots of their own."""
    found = np.eye(60)[np.arange(240) % 60] * (1 + np.arange(240) // 60)[:, None]
    found = np.concatenate([found, found[:60] + 1e-9])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(found)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(
        frame, settings=vectors.Settings(per_cell=4, block=3)).collect()}
    assert got == {i: (4, i % 60) for i in range(300)}


def test_vectors_of_one_id(spark):
    """An id with several vectors is one node: its vectors share links and component, whichever block they are in."""
    rows = [(7, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [0.1, 1.0, 0.0]), (3, [0.0, 0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for settings in (vectors.Settings(), vectors.Settings(per_cell=1, block=1)):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(frame, settings=settings).collect())
        assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (7, 2, 1), (7, 2, 1)]


def test_op10(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = brute.links({r.vec_id: r.embedding for r in rows})
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.QUERIES["op10_near_vectors"](spark, folder).collect()}
    assert got == want


def test_filter_finds_every_level():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.uint64) & ~np.uint64(0xFFFF)
    levels = rng.integers(1, 6, len(keys))
    words = np.zeros(lm.PARTS * 64, np.uint64)
    for level in range(1, 6):
        at, mask = lm.places(keys[levels >= level], level, len(words) * 64, 5)
        np.bitwise_or.at(words, at, mask)
    found = lm.levels(words, keys, 5)
    assert (found >= levels).all() and (found == levels).mean() > 0.9
    absent = lm.levels(words, rng.integers(0, 2**63, 5_000, dtype=np.uint64) & ~np.uint64(0xFFFF), 5)
    assert (absent > 0).mean() < 0.1


def _model_matches(docs, rows):
    want, total, _ = brute.language_model(docs)
    for r in rows:
        held, count, known, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, count, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_op6(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_lm_score"](spark, folder).collect()
    assert len(rows) == len(docs)
    _model_matches(docs, rows)


def test_language_model_learns_pairs(documents):
    rng = random.Random(3)
    follow = {i: rng.sample(range(200), 3) for i in range(200)}
    texts = {}
    for i in range(300):
        at, found = rng.randrange(200), []
        for _ in range(60):
            found.append(f"W{at}")
            at = rng.choice(follow[at])
        texts[i] = " ".join(found)
    texts.update({300: None, 301: "", 302: "never seen words"})
    docs = documents([(i, t, "s") for i, t in texts.items()])
    model = lm.learn(docs)
    rows = lm.score(docs, model).collect()
    _model_matches(texts, rows)
    unseen = [r for r in rows if r.held_out and r.doc_id < 300]
    assert sum(r.score for r in unseen) > 0.5 * sum(r.base_score for r in unseen)
    assert lm.score(documents([]), lm.learn(documents([]))).count() == 0
    odd = documents([(None, "a b", "s"), (1, "a", "s"), (1, "a", "s")])
    assert lm.score(odd, lm.learn(odd)).count() == 3


def test_filter_is_sized_by_its_entries(documents):
    """Short words have more pairs for each byte than any guess from bytes allows for; few absent pairs may look seen."""
    rng = random.Random(11)
    vocabulary = [a + b for a in "0123456789abcdefghijklmnopqrstuvwxyz" for b in "0123456789abcdefghijklmnopqrstuvwxyz"]
    held = [i for i in range(14_000) if zlib.crc32(str(i).encode()) % 7 == 2][:1500]
    learned = [i for i in range(14_000) if zlib.crc32(str(i).encode()) % 7 != 2][:400]
    texts = {i: " ".join(rng.choices(vocabulary, k=700)) for i in learned} | {i: rng.choice(vocabulary) for i in held}
    docs = documents([(i, t, "s") for i, t in texts.items()])
    model = lm.learn(docs)
    cut = {i: [*t.split(), None] for i, t in texts.items()}
    single = Counter(t for i in learned for t in cut[i])
    pairs = Counter(p for i in learned for p in zip(["", *cut[i]], cut[i]))
    entries = sum(n.bit_length() for n in pairs.values())
    assert model.pairs == len(pairs)
    assert model.slices.agg(F.sum(F.octet_length("words"))).first()[0] * 8 >= entries * model.settings.bits_per_pair
    single[""], total, kinds = len(learned), sum(single.values()), len(single)

    def exact(found):
        out = 0
        for h, w in zip(["", *found], found):
            n, alone = pairs[h, w], (single[w] + 1) / (total + kinds + 1)
            together = min(1.4 * 2 ** (n.bit_length() - 1) if n > 1 else n, single[h], single[w])
            novel = single[h] ** model.settings.novelty
            out += math.log10((together + novel * alone) / (single[h] + novel) if single[h] else alone)
        return out

    rows = lm.score(docs, model).where("held_out").collect()
    assert len(rows) == len(held)
    wrong = sum(r.score != pytest.approx(exact(cut[r.doc_id]), rel=1e-9) for r in rows)
    assert wrong < 0.05 * len(rows)


def test_pipeline(spark, folder, documents):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stage = lambda i, frame: corpus_pipeline.STAGES[i][1](spark, frame, folder)
    clean = stage(0, docs)
    assert clean.columns == docs.columns
    verdicts = {r.doc_id: r for r in quality.clean(docs).collect()}
    found = {r.doc_id: r for r in clean.collect()}
    assert set(found) == {i for i, v in verdicts.items() if v.kept}
    assert all(r.text == verdicts[i].clean_text and r.n_chars == len(r.text) for i, r in found.items())
    assert all(found[i] == rows[i] for i in found if not verdicts[i].n_lines_removed)
    one = stage(1, clean)
    groups = brute.near_duplicates({i: r.text for i, r in found.items()}, 80)
    unique = {r.doc_id: r for r in one.collect()}
    assert one.columns == docs.columns and unique == {i: found[i] for i, (_, c) in groups.items() if i == c}
    short = stage(2, one)
    left = {r.doc_id: r for r in short.collect()}
    assert short.columns == docs.columns
    for i, _, gone, kept in brute.remove_repeats([(i, unique[i].text) for i in sorted(unique)]):
        assert left[i].text == (kept if gone else unique[i].text) and left[i].n_chars == len(left[i].text)
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == {i for i, r in left.items() if brute.words(r.text)}


def test_pipeline_links_from_a_similarity_of_four_fifths(spark, documents):
    """Pairs of 0.80 to 0.85, which op2 does not link, lose their later copy; pairs just below 0.80 stay."""
    rng = random.Random(8)
    texts = {}
    for i in range(150):
        found = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))]
        texts[2 * i] = " ".join(found)
        for at in rng.sample(range(len(found)), max(1, round(len(found) / 46))):
            found[at] = "changed"
        texts[2 * i + 1] = " ".join(found)
    texts |= {900: " ".join(f"a{i}" for i in range(13)), 901: " ".join(f"a{i}" for i in range(12)) + " z"}  # 8 of 10
    docs = documents([(i, t, "s") for i, t in texts.items()])
    groups = {n: brute.near_duplicates(texts, n) for n in (80, 85)}
    want = {i for i, (_, c) in groups[80].items() if i == c}
    assert 901 not in want and 20 < sum(i == c for i, (_, c) in groups[85].items()) - len(want)
    assert len(want) > 152  # some pairs are below 0.80
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert minhash.Settings().percent == 85


def test_pipeline_keeps_each_text_that_occurs_once(spark, documents):
    """Ids that repeat with different texts: only copies go, whichever row has them."""
    rng = random.Random(12)
    x, y, z, w, v = [" ".join(f"{c}{rng.randrange(900)}" for _ in range(60)) for c in "xyzwv"]
    near = f"{z} end"
    rows = [(1, x), (5, x), (5, y), (7, z), (7, w), (7, w), (8, near), (9, v), (9, v), (None, v)]
    docs = documents([(i, t, "s") for i, t in rows])
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == Counter([(1, x), (5, y), (7, w), (8, near), (9, v), (None, v)])


def test_pipeline_of_odd_rows(spark, documents):
    text = " ".join(f"word{i}" for i in range(60))
    docs = documents([(None, text, "s"), (1, text, None), (1, text, None), (2, text, "s"), (3, None, "s"), (4, "x", "s")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 1
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0
