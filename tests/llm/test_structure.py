"""Conversation repair, URL filters and fill-in-the-middle, against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import infill, queries, repair, urls

ROW = "conv_id long, turn long, role string, text string, gaps int, audit string"


def faults(rows):
    """(role, text, fault) of (turn, role, text) rows in order"""
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = (
            "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def legal(turns):
    return re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns)) is not None


def cheapest(found):
    """(cost, audit, turns) by trying every prefix of every repair, one state for each last initial"""
    best = {"": (0, "", ())}

    def offer(ways, way):
        state = "".join(r[:1] for r, _ in way[2])[-1:]
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def allowed(turns, role):
        return re.fullmatch("s?(ua)*u?", "".join(r[:1] for r, _ in turns) + role[:1]) is not None and role[:1] in {"s", "u", "a"}

    def inserted(ways):
        ways = dict(ways)
        for _ in range(4):
            for cost, audit, turns in list(ways.values()):
                for role in ("user", "assistant"):
                    if allowed(turns, role):
                        offer(ways, (cost + 2, audit + "I", (*turns, (role, ""))))
        return ways

    for role, text, fault in found:
        after = {}
        for cost, audit, turns in inserted(best).values():
            offer(after, (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if allowed(turns, role):
                offer(after, (cost + more, audit + "K", (*turns, (role, text))))
            for other in ("user", "assistant"):
                if allowed(turns, other):
                    offer(after, (cost + more + 2, audit + "R", (*turns, (other, text))))
        best = after
    return min(w for w in inserted(best).values() if legal(w[2]))


def expected(rows):
    """The row of one conversation, given its (turn, role, text) rows"""
    rows = sorted(
        [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows],
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    cost, audit, turns = cheapest(found)
    numbers = {t for t, _, _ in rows if t is not None}
    kinds = Counter(f for _, _, f in found)
    pairs = ["".join(p) for p in itertools.pairwise([r[:1] for _, r, _ in rows])]
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, kinds["blank"], kinds["duplicate"], kinds["truncated"],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, brute.hexed("\n".join(f"{r}:{x}" for r, x in turns)))


def damage(conv, turn, role, text):
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = [" " if v is None else v for v in (role, text)]
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def check_repair(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], ROW)
    audits = repair.repair(frame).cache()
    got = {r[0]: tuple(r[1:]) for r in audits.collect()}
    want = {conv: expected(found) for conv, found in grouped(rows).items()}
    assert got == want
    turns = {}
    for r in sorted(repair.repaired_turns(frame, audits).collect(), key=lambda r: r.position):
        turns.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}"))
    for conv, row in want.items():
        assert [p for p, _ in turns.get(conv, [])] == list(range(len(turns.get(conv, []))))
        assert brute.hexed("\n".join(t for _, t in turns.get(conv, []))) == row[-1]


def any_rows(rng, conversations, length):
    texts = ["a.", "b!", "c?", "no end", "", " \t", "x. \n", "é.", None]
    return [
        (rng.choice([conv, None]) if conv < 2 else conv, rng.choice([None, rng.randrange(12)]),
         rng.choice(["user", "assistant", "system", "tool", None, "", "u"]), rng.choice(texts))
        for conv in range(conversations) for _ in range(rng.randrange(1, length))]


def test_plain_repair_is_the_least_of_all(spark):
    """The plain version itself, against all sequences of edits of short conversations."""
    rng = random.Random(4)

    def every(found, limit):
        if not found:
            yield 0, "", ()
        if limit:
            for cost, audit, turns in every(found, limit - 1):
                for role in ("user", "assistant"):
                    yield cost + 2, "I" + audit, ((role, ""), *turns)
        if found:
            role, text, fault = found[0]
            for cost, audit, turns in every(found[1:], limit):
                yield cost + 3, "D" + audit, turns
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    yield cost + more, "K" + audit, ((role, text), *turns)
                    for other in ("user", "assistant"):
                        yield cost + more + 2, "R" + audit, ((other, text), *turns)

    for _ in range(60):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c!"]))
                for i in range(rng.randrange(4))]
        found = faults(rows)
        assert cheapest(found) == min(w for w in every(found, 3) if legal(w[2]))


def test_repair(spark):
    check_repair(spark, any_rows(random.Random(1), 150, 12))
    check_repair(spark, [(1, 0, "system", "s."), (2, 0, "system", "s"), (3, None, None, None), (4, -(10**6), "user", "q?"),
                         (4, 10**6, "assistant", "a " * 50_000 + "."), (5, 0, "user", "q."), (5, 0, "user", "q."),
                         (6, 0, "assistant", "a."), (7, 1, "user", "x" * 100_000)])
    empty = spark.createDataFrame([], ROW)
    assert repair.repair(empty).count() == 0
    assert repair.repaired_turns(empty, repair.repair(empty)).count() == 0


def test_repair_over_many_tasks(spark):
    """Conversations, one of them with most rows, that begin and end in the midst of ranges; also one row thousands of times."""
    rng = random.Random(2)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", f"b{t}.", f"c{t}", ""]))
            for t in range(900)]
    rows += [(6, 3, "user", "again.")] * 700 + [(7, 0, "user", "q?"), (7, 1, "assistant", "a.")]
    rows += any_rows(rng, 5, 30)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frame = spark.createDataFrame([(*r, 1, "x") for r in rows], ROW)
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(spark.createDataFrame([], repair.PIECES).schema)
        ordered = repair.faulty_rows(frame).repartitionByRange("conv_id", "turn").sortWithinPartitions(*repair.ORDER)
        pieces = ordered.mapInArrow(repair._pieces(schema), repair.PIECES).where("kind = 'piece' and conv_id = 5").count()
        assert pieces > 5
        check_repair(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_audits_compare_even_when_all_hashes_collide(monkeypatch):
    rng = random.Random(3)
    for modulus in (repair.MODULUS, 1, 7):
        monkeypatch.setattr(repair, "MODULUS", modulus)
        nodes = [repair.Node()]
        for _ in range(300):
            nodes.append(repair.Node(rng.choice(nodes), rng.choice("KRDI")))
        for _ in range(2000):
            x, y = rng.choice(nodes), rng.choice(nodes)
            assert repair.before(x, y) == (x.text() < y.text())
        deep = nodes[-1]
        assert all(deep.above(d).text() == deep.text()[:d] for d in range(deep.depth + 1))


def test_op12(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    after = grouped([d for r in rows for d in damage(*r)])
    none = (0, 0, 0, 0, 0, 0, "", brute.hexed(""))
    want = {conv: expected(after[conv]) if conv in after else none for conv in grouped(rows)}
    found = queries.QUERIES["op12_conversation_repair"](spark, folder).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == want and len(found) == len(want)
    assert sum(r.cost for r in found) > 0 and {c for r in found for c in r.audit} == set("KRDI")


# URL filters


@pytest.mark.parametrize(("url", "host", "path"), [
    (None, "", ""), ("", "", ""), ("no scheme", "", ""), ("http://", "", ""), ("http://A.Example.NET", "a.example.net", ""),
    ("x://É.org/fr/?q#f", "É.org", "/fr/"), ("a://b://c/d", "b:", "//c/d"), ("http://h?p/x", "h", ""), ("http://h#p/x", "h", ""),
    ("HTTP://h/a\nb?c", "h", "/a\nb"), ("/a/b", "", ""),
])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(1, url)], "page_id long, url string")
    found = urls.filter_urls(row).collect()
    assert [(r.page_id, r.host, r.path) for r in found] == [(1, host, path)]


def plain_model(labelled):
    """{gram: ratio} by dictionaries"""
    def symbol(c):
        if c.isascii() and c.isalpha():
            return ord(c.lower()) - 96
        return 31 if ord(c) > 127 else 27 if c.isdigit() else {"/": 28, ".": 29}.get(c, 30)

    def cut(url):
        s = [0, 0, 0, *map(symbol, url), 0]
        return [tuple(s[i:i + 4]) for i in range(len(s) - 3)]

    counts = {flag: Counter(g[-k - 1:] for u, f in labelled if f == flag for g in cut(u) for k in range(4)) for flag in (True, False)}

    def chance(flag, gram):
        p = 1 / 32
        for k in range(4):
            after = {s: counts[flag][(*gram[3 - k:3], s)] for s in range(32)}
            total, kinds = sum(after.values()), sum(n > 0 for n in after.values())
            p = (after[gram[3]] + kinds * p) / (total + kinds) if total else p
        return p

    def ratio(gram):
        return math.floor((math.log(chance(True, gram)) - math.log(chance(False, gram))) * 65536 + 0.5)

    return cut, ratio, chance


def test_url_model(spark):
    rng = random.Random(5)
    rows = [(f"http://{rng.choice(['good', 'fine', 'spam', 'junk'])}{rng.choice(['-x', 'É', '.', ''])}/{rng.randrange(99)}",)
            for _ in range(60)]
    labelled = [(u, "good" in u or "fine" in u) for u, in rows]
    frame = spark.createDataFrame(labelled, "url string, accepted boolean")
    cut, ratio, chance = plain_model(labelled)
    model = urls.fit(frame).first()["model"]
    tried = {g for u, _ in labelled for g in cut(u)} | {tuple(rng.randrange(32) for _ in range(4)) for _ in range(60)}
    assert all(model[((g[0] * 32 + g[1]) * 32 + g[2]) * 32 + g[3]] == ratio(g) for g in tried)
    for flag in (True, False):
        for context in ((0, 0, 0), (1, 2, 3), (31, 31, 31)):
            assert sum(chance(flag, (*context, s)) for s in range(32)) == pytest.approx(1)
    assert urls.fit(frame.where("accepted")).first()["model"] is None


def test_url_filter_learns_the_rules(spark):
    rng = random.Random(6)
    good, bad = ["reading", "library", "science"], ["cheappills", "casino", "jackpot"]
    rules = (urls.Rule("ok.org", "/", True), urls.Rule("bad.org", "/", False), urls.Rule("x.bad.org", "/f", True))
    rows = []
    for i in range(1200):
        fine = rng.random() < 0.5
        host = f"{rng.choice(good if fine else bad)}.{rng.choice(['ok.org' if fine else 'bad.org', 'other.net'])}"
        rows.append((i, f"http://{host}/{rng.choice(good if fine else bad)}/{i}", fine))
    frame = spark.createDataFrame(rows, "page_id long, url string, rule boolean")
    found = {r.page_id: r for r in urls.filter_urls(frame, rules=rules).collect()}
    assert all((r.rule is not None) == ("other.net" not in rows[i][1]) for i, r in found.items())
    open_ones = [i for i, r in found.items() if r.rule is None]
    right = sum((found[i].verdict == "allow") == rows[i][2] for i in open_ones)
    assert len(open_ones) > 400 and right > 0.97 * len(open_ones)
    odd = [(None, None), (None, None), (1, ""), (2, "http://x.bad.org/far"), (2, "http://x.bad.org/ar"), (3, "http://bad.org"),
           (4, "http://notbad.org/"), (5, "http://ok.org/" + "long/" * 20_000)]
    found = urls.filter_urls(spark.createDataFrame(odd, "page_id long, url string"), rules=rules).collect()
    assert sorted((r.page_id or 0, r.rule or "", r.verdict) for r in found) == [
        (0, "", "allow"), (0, "", "allow"), (1, "", "allow"), (2, "bad.org/", "block"), (2, "x.bad.org/f", "allow"), (3, "", "allow"),
        (4, "", "allow"), (5, "ok.org/", "allow")]
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_no_row_carries_the_url_model(spark, folder):
    frame = queries.QUERIES["op11_url_filter"](spark, folder)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _model" not in plan and "scalar-subquery" in plan
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


# Fill in the middle


def test_boundary_sets():
    rng = np.random.default_rng(7)
    kinds = Counter()
    for size, top in ((0, 1), (1, 1), (50, 10**6), (5000, 70_000), (60_000, 70_000), (200_000, 300_000), (3000, 10**7)):
        values = np.sort(rng.choice(top, size, replace=False)).astype(np.int64) if size else np.zeros(0, np.int64)
        values = np.concatenate([values, np.arange(2 * 10**7, 2 * 10**7 + size)])
        if size == 200_000:
            values = np.union1d(values, np.arange(4 * 10**7, 4 * 10**7 + 70_000, 2))
        held = infill.BoundarySet(values)
        kinds.update(type(c).__name__ for c in held.containers)
        assert len(held) == len(values)
        ranks = {0, len(values) - 1, *rng.integers(0, max(1, len(values)), 300).tolist()} if len(values) else set()
        assert all(held.select(k) == values[k] for k in ranks)
        for k in (-1, len(values)):
            with pytest.raises(IndexError):
                held.select(k)
    assert set(kinds) == {"ArrayContainer", "RunContainer", "BitmapContainer"}


def plain_infill(doc_id, text, cut=100, first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ["".join(u) for u in (units[:low], units[low:high], units[high:])]
    if h[3] % 100 < first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(documents):
    rng = random.Random(8)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "é\n漢\U0001f600\nx", "<P>\nx", "a<M>b", "<S\n>\n<\nP", "x<\n<P\n",
             "a\r\nb\x0bc\n", "\n" * 70_000, "y" * 200_000 + "\nz"]
    texts += ["".join(rng.choice("ab é\n\n<PSM>") for _ in range(rng.randrange(80))) for _ in range(400)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "a\nb\nc", "s"), (None, "a\nb\nc", "s"), (4, "other\ntext", "s")]
    docs = documents(rows)
    for cut, first in ((100, 50), (40, 100), (0, 0)):
        made = infill.fill_in_middle(docs, settings=infill.Settings(7, cut, first))
        found = made.select("*", infill.restored(F.col("output"), F.col("form")).alias("back")).collect()
        got = Counter(tuple(r)[:6] for r in found)
        assert got == Counter((i, *plain_infill(i, t, cut, first)) for i, t, _ in rows)
        backs = Counter((r.doc_id, r.back) for r in found)
        assert backs == Counter((i, t or "") for i, t, _ in rows)
    assert infill.fill_in_middle(documents([])).count() == 0
