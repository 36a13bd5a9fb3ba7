"""Decontamination, line dedup, n-gram join: against brute-force versions."""
import hashlib
import random
import re

import numpy as np
import pytest

from verdant.llm import components, decontaminate as D, line_dedup as L, ngram_join as N

DOC = "doc_id long, text string, lang string, source string, n_chars long, __gone string, df int, n int"


def docs_frame(spark, texts):
    """(id, text) pairs as a table with extra columns of clashing names."""
    rows = [(i, t, None, "s", None if t is None else len(t), "x", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, DOC)


# -- decontamination ----------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items):
    ws = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        bw = WORD.findall((body or "").translate(LOWER))
        for s in range(max(1, len(bw) - 12)) if bw else ():
            win = bw[s:s + 13]
            for p in range(len(ws) - len(win) + 1):
                if ws[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(ws)


def random_case(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "É", "été", "a1", "x"] + [f"w{i}" for i in range(40)]

    def passage(k):
        return [rng.choice(vocab) for _ in range(k)]

    items = [(i, " ".join(passage(k))) for i, k in enumerate([0, 1, 2, 3, 5, 12, 13, 14, 30, 30, 60])]
    items += [(11, items[9][1]), (12, None), (9, items[9][1])]
    texts = []
    for i in range(60):
        ws = passage(rng.choice([0, 1, 2, 8, 30, 200]))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1] or ""
            part = part.split()
            a = rng.randint(0, len(part))
            at = rng.randint(0, len(ws))
            ws[at:at] = part[a:a + rng.choice([3, 13, 14, 40])]
        texts.append((i, rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < .2 else w for w in ws)))
    return items, texts + [(100, None), (101, ""), (102, "!!! ..."), (103, (items[8][1] + " ") * 300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed):
    items, texts = random_case(seed)
    docs = docs_frame(spark, texts + texts[:3])  # repeated rows come back once
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in D.contamination(docs, bench).collect()}
    want = {i: brute_hits(t, [x for x in items if x[0] is not None]) for i, t in texts}
    assert got == want
    kept = sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect())
    assert kept == sorted([i for i, _ in texts + texts[:3] if not want[i][3]])
    assert D.drop_contaminated(docs, bench).columns == docs.columns


def test_contamination_beyond_the_broadcast_bound_and_with_empty_tables(spark, monkeypatch):
    items, texts = random_case(3)
    docs, bench = docs_frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, D.contamination(docs, bench).collect()))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(map(str, D.contamination(docs, bench).collect())) == want
    assert {r.n_hit for r in D.contamination(docs, bench.limit(0)).collect()} == {0}
    assert D.contamination(docs.limit(0), bench).count() == 0


def test_candidates_of_documents_are_not_broadcast(spark, monkeypatch):
    """Of the documents' side only hashes are broadcast, and beyond their bound nothing."""
    items, texts = random_case(4)
    docs, bench = docs_frame(spark, texts + texts[:3]), spark.createDataFrame(items, "item_id long, text string")
    real, sent = D.F.broadcast, []

    def seen(df):
        sent.append(sorted(df.columns))
        return real(df)
    monkeypatch.setattr(D.F, "broadcast", seen)
    want = sorted(map(str, D.contamination(docs, bench).collect()))
    assert sent == [["s"], ["off", "s", "win"], ["h"]]
    monkeypatch.setattr(D, "BROADCAST_KEYS", 0)
    assert sorted(map(str, D.contamination(docs, bench).collect())) == want
    assert sent[3:] == [["s"], ["off", "s", "win"]]


def test_null_ids_of_documents_and_items(spark):
    body = " ".join(f"w{i}" for i in range(20))
    docs = docs_frame(spark, [(None, body), (None, "clean"), (1, body)])
    bench = spark.createDataFrame([(None, body)], "item_id long, text string")
    got = {(r.doc, r.n_words): (r.n_hit, list(r["items"])) for r in D.contamination(docs, bench).collect()}
    assert got == {(None, 20): (20, []), (None, 1): (0, []), (1, 20): (20, [])}


# -- line dedup ---------------------------------------------------------------

def brute_lines(texts):
    seen, out = set(), {}
    for i, t in sorted(texts):
        if t is None:
            out[i] = (None, 0, 0)
            continue
        lines = t.split("\n")
        full = [k for k, s in enumerate(lines) if s.strip(" ")]
        gone = set()
        for a in range(max(1, len(full) - 2)) if full else ():
            run = full[a:a + 3]
            key = tuple(lines[k] for k in run)
            if key in seen:
                gone.update(run)
            seen.add(key)
        out[i] = ("\n".join(s for k, s in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(12)] + ["", "  "]
    texts = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 3, 4, 8, 40])))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "\n\n"), (103, "x\n" * 3000), (104, "solo"), (105, "solo")]
    docs = docs_frame(spark, texts)
    got = {r.doc_id: (r["__text"], r["__n_lines"], r["__n_removed"]) for r in L.dedup_lines(docs).collect()}
    assert got == brute_lines(texts)
    out = L.strip_repeats(docs)
    assert out.columns == docs.columns
    want = {i: v for i, v in brute_lines(texts).items() if not (v[2] and not (v[0] or "").replace("\n", "").strip(" "))}
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == {i: v[0] for i, v in want.items()}
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_line_dedup_repeated_rows_null_ids_and_empty_table(spark):
    text = "a\nb\nc\nd"
    docs = docs_frame(spark, [(5, text), (5, text), (None, text), (6, "z\n" + text)])
    got = sorted((str(r.doc_id), r["__text"]) for r in L.dedup_lines(docs).collect())
    assert got == [("5", ""), ("5", ""), ("6", "z"), ("None", text)]
    assert L.dedup_lines(docs.limit(0)).count() == 0


# -- n-gram join ----------------------------------------------------------------

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(text):
    ws = WORDS.findall((text or "").translate(LOWER))
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_components(texts):
    sets = {i: brute_sets(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((root(x), root(y)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    shared = [rng.choice(vocab) for _ in range(60)]
    texts, bases = [], []
    for i in range(n):
        if bases and rng.random() < .6:  # edits put pairs near the threshold; chains form
            ws = list(rng.choice(bases[-12:]))
            for _ in range(rng.randint(0, max(1, len(ws) // 28))):
                at = rng.randrange(len(ws))
                ws[at:at + rng.randint(0, 2)] = [rng.choice(vocab)]
        else:
            ws = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 6, 9, 40, 120, 300]))]
            if rng.random() < .5:
                ws += shared
        bases.append(ws)
        texts.append((i, " ".join(w.upper() if rng.random() < .05 else w for w in ws)))
    rng.shuffle(texts)
    return texts + [(900, None), (901, ""), (902, " \t\n"), (903, "w " * 5000), (904, "w " * 4000), (905, "É"), (906, "é")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    texts = near_copies(seed)
    docs = docs_frame(spark, texts + texts[:5])
    got = N.join_components(docs).collect()
    assert len(got) == len(texts) + 5
    want = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, (_, c) in want.items() if c == i}


@pytest.mark.parametrize("heavy,ids,rows,block,asking,group", [(0, 1, 8192, 256, 1024, 512), (5, 10 ** 6, 3, 2, 2, 4)])
def test_bounds_change_nothing(spark, monkeypatch, heavy, ids, rows, block, asking, group):
    texts = near_copies(7)
    monkeypatch.setattr(N, "HEAVY", heavy)
    monkeypatch.setattr(N, "HEAVY_FROM", 2)
    monkeypatch.setattr(N, "BROADCAST_IDS", ids)
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "ASKING", asking)
    monkeypatch.setattr(N, "GROUP", group)
    monkeypatch.setattr(N, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(N, "FLUSH_TOKENS", 100)
    monkeypatch.setattr("verdant.llm.common.BATCH_ROWS", rows)
    got = N.join_components(docs_frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_a_family_whose_leader_is_not_linked_with_all(spark):
    """Half of the copies are far from the others: components have to be asked."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(120):
        ws = list(base)
        for _ in range(rng.choice([1, 2, 4, 6, 8])):
            ws[rng.randrange(len(ws))] = f"x{rng.randrange(10 ** 6)}"
        texts.append((i, " ".join(ws)))
    got = N.join_components(docs_frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_prefix_orders_never_lose_a_pair():
    """On random set pairs at and around the threshold: prefixes under rarity and rotations meet."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        common = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
        x = np.unique(np.r_[common, rng.integers(0, 2 ** 64, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)])
        y = np.unique(np.r_[common, rng.integers(0, 2 ** 64, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)])
        both = len(np.intersect1d(x, y))
        is_link = 100 * both >= 75 * (len(x) + len(y) - both)
        assert N.linked(x, y) == is_link
        if is_link:
            known = np.unique(rng.choice(common, n) >> np.uint64(24))
            counts = rng.integers(8, 50, len(known))
            assert len(np.intersect1d(N.rarest(x, 40, known, counts), N.rarest(y, 40, known, counts)))


def test_packed_values_come_back():
    rng = np.random.default_rng(2)
    for values in (np.empty(0, np.uint64), np.array([0, 2 ** 63 + 5], np.uint64), np.array([7, 8, 9], np.uint64),
                   np.unique(rng.integers(0, 2 ** 32, 200_000, dtype=np.uint64))):
        assert np.array_equal(N._unpacked(N._packed(values)), values)


@pytest.mark.parametrize("bits", [32, 36, 40])
def test_packed_values_stay_small_as_the_values_widen(bits):
    """As many values as a task holds of a range, out of 2**bits: the steps' width decides, no fixed one."""
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 2 ** bits, 1_000_000, dtype=np.uint64))
    parts = np.split(values, range(300, len(values), 300))
    packed = [N._packed(x) for x in parts]
    assert all(np.array_equal(N._unpacked(p), x) for p, x in zip(packed, parts))
    assert sum(map(len, packed)) < len(values) * (bits - 20 + 4) / 8 + 9 * len(parts)


def test_a_write_leaves_no_shuffle_files(spark):
    """Those of a stored frame go at once, those of other queries stay."""
    from pathlib import Path
    from verdant.llm.common import CLEANUP, stored
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {p for d in local for p in Path(d).rglob("shuffle_*")}
    kept = spark.range(100_000).repartition(7, "id").selectExpr("id * 2 AS x").persist()
    kept.count()
    before = files()
    was = spark.conf.get(CLEANUP, None)
    frame = stored(spark.range(100_000).repartition(7, "id"), "t")
    import time
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(.1)
    assert not files() - before and files() >= before and len(before) > 0
    assert frame.count() == kept.count() == 100_000 and spark.conf.get(CLEANUP, None) == was
    kept.unpersist()


def test_blocks_compared_in_passes_give_the_same_links(spark, monkeypatch):
    texts = near_copies(8)
    monkeypatch.setattr(N, "BLOCK", 2)
    monkeypatch.setattr(N, "ASKING", 2)
    monkeypatch.setattr(N, "GROUP", 4)
    real, real_stored, found, names = N.asked, N.stored, [], []
    monkeypatch.setattr(N, "stored", lambda df, name: names.append(name) or real_stored(df, name))

    def twice(asks, members, known):
        names.clear()
        once = real(asks, members, known)
        assert names.count("jac-links") == 1
        monkeypatch.setattr(N, "PASS_BYTES", 1)
        few = real(asks, members, known)
        assert names.count("jac-links") > 3
        found.extend(sorted(map(tuple, x.collect())) for x in (once, few))
        return few
    monkeypatch.setattr(N, "asked", twice)
    got = N.join_components(docs_frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert found[0] == found[1]


def test_join_with_null_ids_shared_ids_and_empty_table(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = docs_frame(spark, [(None, a), (3, a), (4, a), (5, b), (5, a), (6, b)])
    got = {(r.doc_id, r.component_id) for r in N.join_components(docs).collect()}
    assert got == {(None, None), (3, 3), (4, 3), (5, 3), (5, 5), (6, 5)}
    assert N.join_components(docs.limit(0)).count() == 0


def test_one_row_of_each_component_with_shared_repeated_and_null_ids(spark):
    def text(x, edit=None):
        ws = [f"{x}{i}" for i in range(60)]
        return " ".join(ws if edit is None else [*ws[:-1], edit])

    a, b, c, d, e = (text(x) for x in "abcde")
    rows = [(1, a), (5, a), (5, b), (9, text("b", "y")),   # id 5 goes for a, stays for b
            (7, c), (7, c), (7, c), (8, text("c", "z")),   # repeated rows: one of them
            (None, d), (None, text("d", "q")), (None, d),  # no ids at all: one of them
            (None, e), (20, text("e", "q")),               # the row with an id
            (30, None), (31, ""), (31, "")]                # no shingles: links with nothing
    kept = N.one_of_each(docs_frame(spark, rows))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    some, d_rows = [x for x in got if x[0] is not None], [x for x in got if x[0] is None]
    assert sorted(some, key=repr) == sorted(
        [(1, a), (5, b), (7, c), (20, text("e", "q")), (30, None), (31, ""), (31, "")], key=repr)
    assert len(d_rows) == 1 and d_rows[0][1].startswith("d0 ")
    unique = docs_frame(spark, [(1, a), (2, text("a", "x")), (3, b)])
    assert sorted(r.doc_id for r in N.one_of_each(unique).collect()) == [1, 3]


def test_connected_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i + 1, i) for i in range(40)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    links = spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")
    got = {r.v: r.c for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(200)}}


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    rng = random.Random(4)
    texts = [None, "", " \t", "É é", "a", "A b\x0bc\x0cd e F"] + [
        "".join(rng.choice(["x", "Y", "é", "　", "\xa0", " ", "\n", "\t", "\r"]) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    sets = N.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(brute_sets(t)) for t in texts]
    monkeypatch.setattr(N, "SEGMENT", 7)
    again = N.shingle_sets(texts[::-1])[::-1]
    assert all(np.array_equal(a, b) and np.array_equal(a, N.shingle_sets([t])[0]) for a, b, t in zip(sets, again, texts))
    # words differ in order, length and zero bytes
    words = ["ab", "ba", "a", "aa", "aaa", "\0", "\0\0", "\0a", "a\0"]
    assert len({int(N.shingle_sets([w])[0][0]) for w in words}) == len(words)


def test_form_letters_are_not_asked_by_pair(spark, monkeypatch):
    """Unlinked texts that share a passage write asks by pool, not k(k-1)/2 of them."""
    rng = random.Random(5)
    form = [f"f{i}" for i in range(100)]
    texts = [(i, " ".join(form + [f"u{i}x{rng.randrange(10 ** 6)}" for _ in range(30)])) for i in range(300)]
    texts += [(1000 + i, texts[i][1] + " end") for i in range(20)]
    rows = {}
    real = N.asked

    def counted(asks, members, known):
        rows["asks"], rows["members"] = asks.count(), members.count()
        return real(asks, members, known)
    monkeypatch.setattr(N, "asked", counted)
    got = N.join_components(docs_frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert rows["asks"] <= 10 * len(texts)


def test_very_long_texts(spark):
    rng = random.Random(6)
    ws = [f"w{rng.randrange(3000)}" for _ in range(200_000)]
    near = list(ws)
    near[1000:1100] = ["other"] * 100
    texts = [(1, " ".join(ws)), (2, " ".join(near)), (3, " ".join(reversed(ws))), (4, "x" * 3_000_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.join_components(docs_frame(spark, texts)).collect()}
    assert got[2][1] == 1 and got[3][1] == 3 and got[4] == (1, 4) and got[1][0] == len(brute_sets(texts[0][1]))


def test_line_dedup_and_decontamination_of_long_texts(spark):
    """Work grows with the length of a text."""
    import time

    lines = [f"line {i} of a long text" for i in range(100_000)]
    text = "\n".join(lines + lines[:50_000])
    began = time.monotonic()
    (row,) = L.dedup_lines(docs_frame(spark, [(1, text)])).collect()
    assert row["__n_removed"] == 50_000 and row["__text"] == "\n".join(lines) and time.monotonic() - began < 60
    words = [f"w{i}" for i in range(200_000)]
    items = spark.createDataFrame([(1, " ".join(words[500:540])), (2, "none of it"), (3, " ".join(words[-5:]))], "item_id long, text string")
    began = time.monotonic()
    (row,) = D.contamination(docs_frame(spark, [(1, " ".join(words))]), items).collect()
    assert (row.n_words, row.n_hit, row["items"]) == (200_000, 45, ["1", "3"]) and time.monotonic() - began < 60
