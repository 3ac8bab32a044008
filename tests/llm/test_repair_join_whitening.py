"""Conversation repair, n-gram join and whitening against plain versions: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitymart.llm import linededup, ngramjoin, quality, repair, urls, whitening

# --- op11


def plain_best(pattern, entry=repair.START, targets=repair.ENDS):
    """Relaxes every node until nothing changes."""
    best, changed = {(0, entry): (0, "")}, True
    while changed:
        changed = False
        for (i, s), (cost, audit) in list(best.items()):
            then = 3 if s == 2 else 2
            steps = [(i, then, cost + 5, audit + "I")]
            if i < len(pattern):
                steps.append((i + 1, s, cost + 2, audit + "D"))
                if pattern[i] != "x":
                    more = 5 if pattern[i].isupper() else 0
                    steps.append((i + 1, then, cost + 1 + more, audit + "R"))
                    steps += [(i + 1, to, cost + more, audit + "K") for at, c, to in [(0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)] if (at, c) == (s, pattern[i].lower())]
            for j, to, *label in steps:
                if (j, to) not in best or tuple(label) < best[j, to]:
                    best[j, to], changed = tuple(label), True
    return min((best[len(pattern), t] for t in targets if (len(pattern), t) in best), default=None)


def test_search_finds_the_least_of_the_cheapest():
    rng = random.Random(1)
    for _ in range(400):
        pattern = "".join(rng.choice("suaoxSUAO") for _ in range(rng.randint(0, 7)))
        for entry in repair.STATES:
            for targets in [repair.ENDS, *((t,) for t in repair.STATES)]:
                assert repair.search(pattern, entry, targets) == plain_best(pattern, entry, targets)


def test_search_ends_soon_on_long_patterns():
    rng = random.Random(2)
    for weights in ("suaox", "s", "sssua", "UAx", "au"):
        pattern = "".join(rng.choice(weights) for _ in range(repair.SEGMENT))
        assert repair.search(pattern, repair.START, repair.ENDS) == plain_best(pattern)


TALK = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (2, 0, "assistant", "First?"), (2, 1, "user", "cut off"), (2, 5, "user", " \t\n"),
    (3, None, "user", "When?"), (3, 4, "assistant", "Now."), (3, 4, "assistant", "Now."), (3, 4, "assistant", "Never."), (4, 7, None, None), (5, 0, "user", ""), (None, 0, "user", "Who?"),
    (6, 0, "tool", "x."), (6, 1, "", "y."), (6, 2, "système", "Très bien ! "),
]
COLUMNS = "conv_id long, turn long, role string, text string"


def talk(spark, rows=TALK):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"{COLUMNS}, place int, audit string")


def plain_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, pattern, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
        letter = role[:1] if role[:1] in tuple("sua") else "o"
        pattern += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        seen.add((role, text))
        if fault:
            faults[fault] += 1
    turns = {r[0] for r in rows} - {None}
    cost, audit = plain_best(pattern)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines, at, state = [], 0, 0
    for edit in audit:
        row = rows[at] if edit != "I" else (0, "", "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            lines.append(f"{row[1]}:{row[2]}")
            state = 1 if state == 0 and row[1][:1] == "s" else 3 if state == 2 else 2
        else:
            lines.append(("assistant:" if state == 2 else "user:") + row[2])
            state = 3 if state == 2 else 2
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        own += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", "So?", "Yes."]
    return [(c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(texts)) for c in range(n) for _ in range(rng.randint(1, 9))]


@pytest.mark.parametrize("segment", [512, 2])
def test_repair(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = TALK + [(c + 100, *r) for c, *r in conversations(3, 60)]
    damage = repair.damaged(talk(spark, rows))
    got = {r[0]: tuple(r)[1:] for r in repair.reports(damage).collect()} if segment == 512 else walked(plain_damage(rows))
    want = {c: plain_report(own)[0] for c, own in plain_damage(rows).items()}
    assert got == want and len(want) == 67
    if segment == 512:
        assert repair.reports(talk(spark, [])).collect() == []


def walked(conversations):
    """Reports by ``Walk`` itself, in this process."""
    out = {}
    for c, rows in conversations.items():
        walk, seen = repair.Walk(), set()
        for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
            walk.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        out[c] = tuple(walk.report().values())
    return out


def test_a_conversation_of_many_segments():
    rng = random.Random(4)
    rows = [(i, rng.choice(["user", "assistant", "system"]), f"{i} {rng.choice(['ok.', 'cut'])}") for i in range(5 * repair.SEGMENT)]
    got = walked({1: rows})[1]
    assert got == plain_report(rows)[0]


def test_repaired_messages_are_those_of_the_digest(spark):
    rows = TALK + conversations(5, 40)
    damage = repair.damaged(talk(spark, rows))
    told = repair.reports(damage)
    lines = {}
    for r in sorted(repair.repaired(damage, told).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in told.collect():
        assert hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


# --- op12


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain_join(rows):
    sets, label = [plain_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return sorted(((d, len(s), least.get(x)) for (d, _), s, x in zip(rows, sets, label)), key=str)


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randint(0, 199)] = f"x{rng.randint(0, 10**9)}"
        out.append(" ".join(words))
    return out


def corpus():
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [None, "", " \n\t", "one", "One", "two words", "TWO\u000bwords", "a b c", "a b c d", "É é É", "é é é", "naïve text here"]
    texts += near_copies(1, 40, 3) + near_copies(2, 30, 9) + [" ".join(f"v{rng.randint(0, 900)}" for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 90))) for _ in range(40)]
    texts += ["la " * 5000, "la " * 7000, " ".join(map(str, range(30_000))), " ".join(map(str, range(31_000)))]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(3, "one"), (5, "another text of words"), (None, "one"), (None, "nobody else says this")]


@pytest.mark.parametrize("group", [3000])
def test_join_equals_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(ngramjoin, "GROUP", group)
    monkeypatch.setattr("entitymart.llm.neardup.GROUP", group)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, size int, point string")
    got = sorted((tuple(r) for r in ngramjoin.join_similar(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == plain_join(rows)


def test_join_of_nothing(spark):
    assert ngramjoin.join_similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pairs_share_the_matches_that_the_smaller_prefix_asks_for():
    rng = np.random.default_rng(3)
    order = rng.permutation(3000)
    for _ in range(300):
        base = rng.choice(3000, size=rng.integers(1, 120), replace=False)
        a, b = (np.array([x for x in base if rng.random() > 0.04] or [0]) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        for asks in range(1, ngramjoin.MOST + 1):
            la, lb = ngramjoin.least_overlap(len(a), 90), ngramjoin.least_overlap(len(b), 90)
            if asks <= min(la, lb):
                pa = a[np.argsort(order[a])][: len(a) - la + asks]
                pb = b[np.argsort(order[b])][: len(b) - lb + asks]
                assert len(np.intersect1d(pa, pb)) >= asks


def test_a_common_passage_asks_for_no_sets(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(i, passage + " " + " ".join(f"q{rng.randint(0, 10**9)}" for _ in range(120))) for i in range(200)], "doc_id long, text string")
    rows = ngramjoin.prefixes(docs, ngramjoin.sketch(docs, 3), 3, 90)
    points = rows.groupBy("point").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    assert ngramjoin.asked_bands(ngramjoin.members(points, 90), 90).count() == 0


# --- op13


def plain_components(vectors):
    x = np.floor(1024 * np.asarray(vectors, dtype=float)) + 100000
    c = x - x.mean(axis=0)
    w, v = np.linalg.eigh(c.T @ c / len(x))
    keep = w[::-1][:8] > x.shape[1] * 2e-16 * w.max()
    w, v = w[::-1][:8][keep], v[:, ::-1][:, :8][:, keep]
    return x, c @ v / np.sqrt(w), w / np.trace(c.T @ c / len(x))


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, component string")


def test_whitening(spark):
    rng = np.random.default_rng(4)
    good = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12)).astype(np.float32)
    good[200:] = good[0]  # a common vector
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [1.0] * 11 + [float("inf")]), (904, [1.0] * 5), (905, [])]
    got = whitening.components(vectors_of(spark, rows + bad)).toPandas()
    x, want, explained = plain_components(good)
    assert sorted(got.vec_id.unique()) == list(range(300)) and set(got.component) == set(range(1, 9)) and set(got.n) == {300}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(wide) - np.abs(want)).max() < 1e-9
    n, sums = len(x), x.sum(axis=0).astype(int).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == exact
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-12) and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_whitening_of_little(spark):
    assert whitening.components(vectors_of(spark, [])).collect() == []
    assert whitening.components(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = whitening.components(vectors_of(spark, [(1, [0.0, 0.0]), (1, [1.0, 1.0]), (None, [2.0, 2.0]), (3, [3e38, -3e38]), (4, [1e-40, 0.0])])).collect()
    assert {r["component"] for r in line} <= {1, 2} and all(np.isfinite(r["whitened"]) for r in line) and len({r["vec_id"] for r in line}) == 4
    assert len(whitening.components(vectors_of(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0])])).collect()) == 2


@pytest.mark.parametrize("case", ["spread", "near", "nearer", "two", "rank"])
def test_eigenvectors_to_double_precision(case):
    rng = np.random.default_rng(6)
    values = {
        "spread": np.arange(40.0, 0, -1), "near": np.r_[10 + np.arange(8)[::-1] * 1e-6, rng.random(32)], "nearer": np.r_[10 + np.arange(8)[::-1] * 1e-12, rng.random(32)],
        "two": np.r_[np.full(20, 3.0), np.full(20, 2.0)], "rank": np.r_[1e6, 1 + 1e-7, 1, np.zeros(37)],
    }[case]
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(40) - 0.5 * (q.T @ q))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigen(a)
    assert np.abs(a @ x - x * found).max() < 1e-16 * np.abs(a).max() and np.abs(x.T @ x - np.eye(40)).max() < 1e-16
    if case in ("spread", "near", "nearer"):
        assert np.abs(np.abs((q * x).sum(axis=0)[:8]) - 1).max() < 1e-12


def test_sums_are_exact_beyond_doubles(spark):
    rows = [(1, [2.0**20, 1.0]), (2, [-(2.0**20), 2.0]), (3, [2.0**19, -3.0])]
    fit = whitening.Fit(whitening.clean(vectors_of(spark, rows)))
    x = [[int(1024 * c) + 100000 for c in v] for _, v in rows]
    assert fit.sums == [sum(c) for c in zip(*x)]
    assert whitening.products(np.array(x) - 5) == [sum((r[i] - 5) * (r[j] - 5) for r in x) for i, j in ((0, 0), (0, 1), (1, 1))]


# --- earlier operators on other ids and very long values


@pytest.mark.parametrize(("doc_type", "label_type"), [("long", "int"), ("int", "long"), ("string", "long"), ("string", "string")])
def test_quality_labels_of_other_types(spark, doc_type, label_type):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=40)) + ("." if i % 2 else " buy now !!!"), i % 2) for i in range(200)]
    base = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    told = lambda d, l: quality.fit(base.select(F.col("doc_id").cast(d), "text"), base.select(F.col("doc_id").cast(l), "quality"))
    assert told(doc_type, label_type).threshold == pytest.approx(told(doc_type, doc_type).threshold, abs=1e-12)


def test_long_texts_of_repeated_lines(spark):
    text = "\n".join(f"line {i % 5000} of a text" for i in range(120_000))
    began = time.monotonic()
    rows = linededup.dedup_lines(spark.createDataFrame([(1, text), (2, text + "\nend")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {1: 115_000, 2: 120_000} and time.monotonic() - began < 90


def test_hosts_of_very_many_labels(spark):
    host = ".".join(["a"] * 20_000) + ".example.net"
    rules = spark.createDataFrame([("example.net", "/x/", "block")], "host string, path string, verdict string")
    got = urls.judge(spark.createDataFrame([(1, f"http://{host}/x/y"), (2, f"http://{host}/z")], "page_id long, url string"), rules).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow"}
