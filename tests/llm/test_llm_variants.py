"""Spelling variants, periodic runs and quality rules: against brute-force versions."""
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from test_llm_text import docs_frame
from verdant.llm import periodic_runs as P
from verdant.llm import quality_rules as Q
from verdant.llm import queries
from verdant.llm import spelling_variants as V
from verdant.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- spelling variants ----------------------------------------------------------

def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_variants(texts, drop_every=97):
    count = Counter()
    for i, text in texts:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % drop_every == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1:]
            count[r] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    # words one edit apart agree without one letter each, or one is the other without one
    by_hole = defaultdict(set)
    for w in words:
        by_hole[w].add(w)
        for k in range(len(w)):
            by_hole[w[:k] + w[k + 1:]].add(w)
    out = {}
    for w, n in words.items():
        holes = {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}
        around = {x for h in holes for x in by_hole[h] if near(w, x)}
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * n else None
        out[w] = (form, n, len(around), words.get(form))
    res = {}
    for w, (form, n, m, f) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        res[w] = (form, root, n, m, f)
    return res


def got_variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_of_the_documents_equal_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = brute_variants(texts)
    assert got_variants(queries.op11_spelling_variants(spark, SF)) == want and len(want) > 1000


@pytest.mark.parametrize("seed", range(3))
def test_index_search_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(15):
        size, letters = rng.randint(5, 9), "abcdé"[:rng.randint(1, 5)]

        def some(k):
            return sorted({"".join(rng.choice(letters) for _ in range(k)) for _ in range(rng.randint(1, 150))})

        asked = some(size)
        for missing in (False, True):
            words, cut = some(size - missing), size // 2
            a, w = V._matrix(asked), V._matrix(words)
            found = [*zip(*V.one_error(V.Index(w), a, cut, missing)),
                     *zip(*V.one_error(V.Index(w[:, ::-1]), a[:, ::-1], size - cut, missing, -1))]
            want = {(i, j) for i, x in enumerate(asked) for j, y in enumerate(words) if near(x, y)}
            assert sorted((int(i), int(j)) for i, j in found) == sorted(want)


def test_variants_many_shards_hot_halves_and_edges(spark, monkeypatch):
    rng = random.Random(3)
    # a third of the words share their second half, another share their first
    words = ["".join(rng.choice("abc") for _ in range(4)) + "ation" for _ in range(60)]
    words += ["super" + "".join(rng.choice("abc") for _ in range(4)) for _ in range(60)]
    words += ["".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(80)]
    words += ["x" * 3000 + "y", "x" * 3001 + "y", "aaaaa", "aaaaaa", "ÉTÉÉÉ", "étééé", "Ünter×÷"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(20)]
    texts += [(50, None), (51, ""), (None, " ".join(words) + "."), (52, "1234 ---"), (53, " ".join(words)), (53, " ".join(words))]
    want = brute_variants(texts, 5)
    df = docs_frame(spark, texts)
    assert got_variants(V.variant_groups(df, drop_every=5)) == want
    for name, value in (("SHARD", 150), ("SPLIT", 20), ("PLACES", 16), ("SEARCHES", 7)):
        monkeypatch.setattr(V, name, value)
    assert got_variants(V.variant_groups(df, drop_every=5)) == want
    assert V.variant_groups(df.limit(0)).collect() == []


# -- periodic runs -------------------------------------------------------------------

def brute_runs(ws, least=12):
    out = {}
    for q in range(1, len(ws) // 2 + 1):
        i = 0
        while i + q < len(ws):
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_periodic(i, text):
    ws = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode())
    if i is not None and h % 10 == 0 and ws:
        g = h // 10
        a = g % len(ws)
        p = 1 + (len(ws) - a) // (3 + g % 8)
        ws = ws[:a] + [ws[a + (k - a) % p] for k in range(a, len(ws))]
    runs = sorted(brute_runs(ws), key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for k, w in enumerate(ws) if k not in gone)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(digest.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def periodic_texts(rng):
    def part(depth=0):
        kind, n = rng.randint(0, 6), rng.randint(0, 160)
        if kind == 0:
            return [rng.randint(0, 1) for _ in range(n)]
        if kind == 1:
            return [rng.randint(0, 20) for _ in range(n)]
        if kind == 2:
            return ([rng.randint(0, 3) for _ in range(rng.randint(1, 30))] * 20)[:n]
        if kind == 3:
            a, b = [0], [0, 1]
            while len(b) < 200:
                a, b = b, b + a
            return b[rng.randint(0, 10):n]
        if kind == 4:  # highly periodic regions that meet
            u, x = [rng.randint(0, 9) for _ in range(rng.randint(1, 6))], []
            for _ in range(rng.randint(1, 5)):
                x += (u * 40)[:rng.randint(1, 120)] + [rng.randint(0, 9)] * (rng.random() < .3)
            return x
        if kind == 5:
            x = [rng.randint(0, 1)]
            for _ in range(7):
                x = x + [1 - v for v in x] if rng.random() < .7 else x + x
            return x
        if depth > 2:
            return []
        u, v = part(depth + 1), part(depth + 1)
        return u + v + u + v + u[:rng.randint(0, len(u))]
    return part


@pytest.mark.parametrize("seed", range(2))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    part = periodic_texts(rng)
    for _ in range(12):
        texts = [part() for _ in range(rng.randint(1, 6))]
        for least in (1, 12):
            got = P.runs_of([np.array(t, np.int64) for t in texts], least)
            for t, g in zip(texts, got):
                assert [tuple(r) for r in g.tolist()] == sorted(brute_runs(t, least), key=lambda r: (r[0], r[2])), t


def test_runs_of_the_documents_equal_brute_force(spark):
    docs = table(spark, SF, "documents").filter("length(text) < 4000 or text is null")
    want = {r.doc_id: brute_periodic(r.doc_id, r.text) for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count() and all(got[i] == w for i, w in want.items())
    assert sum(w[0] > 0 for w in want.values()) > 5


def test_runs_edges(spark):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12), (None, "x y z " * 5 + "w"),
             (6, "é é " * 30), (7, "tick tock " * 6 + "end"), (8, "  " * 12)]
    got = P.find_runs(docs_frame(spark, texts)).collect()
    assert len(got) == len(texts)
    by = {r.id: r for r in got}
    for i in (1, 2, 3):
        assert (by[i].n_words, by[i].runs, by[i].collapsed) == (0, [], "")
    assert by[4].runs == [] and by[4].collapsed == " ".join(["a"] * 11)
    assert [tuple(r) for r in by[5].runs] == [(0, 12, 1)] and by[5].collapsed == "a"
    assert [tuple(r) for r in by[None].runs] == [(0, 15, 3)] and by[None].collapsed == "x y z w"
    assert by[7].collapsed == "tick tock end" and by[6].collapsed == "é é" and by[8].collapsed == " "
    assert P.find_runs(docs_frame(spark, [])).collect() == []


def test_runs_of_a_very_long_text(spark):
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 500)}" for _ in range(60_000)]
    ws = base + base + ["a", "b"] * 20_000 + base[:50_000] + ["c"] * 50_000
    began = time.monotonic()
    (row,) = P.find_runs(docs_frame(spark, [(1, " ".join(ws))])).collect()
    assert time.monotonic() - began < 60
    spans = {tuple(r) for r in row.runs}
    assert {(0, 120_000, 60_000), (120_000, 40_000, 2), (210_000, 50_000, 1)} <= spans and row.n_words == len(ws)


# -- quality rules ---------------------------------------------------------------------

def brute_rules(text):
    text = text or ""
    ws = WORD.findall(text)
    wins = Counter(zip(ws, ws[1:], ws[2:]))
    inside = {p + d for p, w in enumerate(zip(ws, ws[1:], ws[2:])) if wins[w] > 1 for d in range(3)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    c = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
         "n_marks": len(re.findall(r"[!-@\[-`{-~]", text)), "n_capitals": len(re.findall("[A-Z]", text)),
         "n_stop_words": sum(w in Q.STOP_WORDS or w[:1].lower() + w[1:] in Q.STOP_WORDS for w in ws), "n_lines": len(lines),
         "n_bullets": sum(bool(re.match(r"[ \t]*[-*•‣·][ \t]", s)) for s in lines),
         "n_ellipses": sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z", s)) for s in lines)}
    base = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
    failed = [r.name for r in Q.RULES if c[r.whole] and not (
        (r.least or 0) <= 1000 * c[r.part] / c[r.whole] <= (float("inf") if r.most is None else r.most))]
    return c, base, failed


def test_rules_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = ["the", "The", "of", "é", "Été", "###", "a|b", "END", "x...", "go…", "été.", "*", "-", "1,2"]
    texts = [(i, "".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t", "\r\n", " ", "\x0b"])
                         for _ in range(rng.choice([0, 1, 2, 3, 10, 60, 300])))) for i in range(120)]
    texts += [(200, None), (201, ""), (None, "a b c " * 40), (202, " \n \n"), (3, texts[3][1]), (203, "line... \nline..."),
              *((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())]
    rows = Q.judged(docs_frame(spark, texts)).collect()
    assert len(rows) == len(texts) and {"df", "source", "__gone"} <= set(rows[0].asDict())
    for r in rows:
        counts, base, failed = brute_rules(r.text)
        assert {c: r[c] for c in Q.COUNTS} == counts, r.text
        assert (r.base_failed, r.failed, r.kept) == (base, failed, not base and not failed)
    assert Q.judged(docs_frame(spark, [])).collect() == []
    assert [r.kept for r in Q.judged(docs_frame(spark, texts[:4]).withColumnRenamed("df", "kept")).collect()] == \
        [not brute_rules(t)[1] and not brute_rules(t)[2] for _, t in texts[:4]]


def test_rules_of_a_very_long_text(spark):
    text = "the cat sat on a mat\n" * 50_000 + " ".join(f"w{i}" for i in range(100_000))
    began = time.monotonic()
    (row,) = Q.judged(docs_frame(spark, [(1, text)])).collect()
    assert time.monotonic() - began < 30
    counts, base, failed = brute_rules(text)
    assert {c: row[c] for c in Q.COUNTS} == counts and (row.base_failed, row.failed) == (base, failed)


def test_rules_keep_the_good_and_drop_the_bad(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = Q.judged(docs).join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= .98 * len(good) and sum(bad) <= .02 * len(bad) and len(good) > 200 and len(bad) > 20


def test_rules_run_no_python(spark):
    from verdant.llm.queries import op13_quality_rules
    plan = op13_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
