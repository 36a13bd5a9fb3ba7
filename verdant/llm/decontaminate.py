"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into item-sized windows (13 words, or all words of a shorter
item).  A document holds a window only if it holds all of the window's
shingles, so with the shingles in one global order of rarity a prefix of one
shingle, the rarest, is necessary: the join compares a document's shingles
with that one alone.  Positional and length bounds (the window must begin and
end inside the document) come before the exact comparison of the words.

Only DataFrame functions run here.  Rarity is counted over all documents.  The
windows' side is broadcast while it has at most ``BROADCAST_ROWS`` rows; beyond
that the joins shuffle.  Exploded rows hold a place and a hash; documents are read
again for the words of those with a candidate, so work grows with a text's words,
not with their square.  Of the documents' side at most ``BROADCAST_KEYS`` hashes
are broadcast; candidates meet their texts through a shuffle.

Defined results: a null text has no words; a null or repeated item counts by
its id as text (null ids name no item); rows that agree in id and text are one
document and come back once; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import ascii_lower, forget, stored

WINDOW = 13
SHINGLE = 3
BROADCAST_ROWS = 200_000
BROADCAST_KEYS = 1_000_000  # hashes of texts with a candidate, 8 bytes each

# What parts words: ASCII other than digits and (lower-case) letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _shingles(ws: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, by position from 0."""
    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(ws, i + k) for k in range(width)])

    last = F.size(ws) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), run)).otherwise(
        F.array().cast("array<bigint>"))


def windows(items: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(item, win): every window of every item."""
    ws = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws"))
    ws = ws.filter(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))
    return ws.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("ws"), i, F.lit(size)))).alias("win"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(hits, wins)``: hits has a row (doc, h, n_words, start, len, win) for each
    window found in a document, and one with start null for a document without;
    wins has (item, win).  Both are written to the shared scratch folder."""
    wins = stored(windows(items, item_id, item_text, size).distinct(), "decon-windows")
    distinct = wins.select("win").distinct()
    # a window of fewer words than a shingle is one shingle of all its words
    widths = [r["w"] for r in distinct.select(
        F.least(F.size("win"), F.lit(SHINGLE)).alias("w")).distinct().orderBy("w").collect()]
    n = wins.count()

    def by_width(ws: Column) -> Column:
        return F.concat(*[_shingles(ws, w) for w in widths]) if widths else F.array().cast("array<bigint>")

    shingle = distinct.select("win", F.least(F.size("win"), F.lit(SHINGLE)).alias("w"))
    own = None
    for w in widths:
        own = F.when(F.col("w") == w, _shingles(F.col("win"), w)) if own is None else own.when(
            F.col("w") == w, _shingles(F.col("win"), w))
    own = F.array().cast("array<bigint>") if own is None else own
    shingle = shingle.select("win", F.posexplode(own).alias("off", "s"))

    base = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("h"),
                       words(F.col(text_col)).alias("ws"))

    # rarity: how often the documents hold each shingle of the benchmark
    seen = (base.select(F.explode(by_width(F.col("ws"))).alias("s"))
            .join(_small(shingle.select("s").distinct(), n * size), "s").groupBy("s").agg(F.count("*").alias("df")))
    seen = stored(seen, "decon-rarity")
    # the rarest shingle of each window; a window with one that no document holds occurs nowhere
    prefix = (shingle.join(seen, "s", "left").groupBy("win")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "s", "off")).alias("p"))
              .filter("p.df > 0").select("win", F.col("p.s").alias("s"), F.col("p.off").alias("off")))
    prefix = stored(prefix, "decon-prefix")

    # candidates: place and shingle alone meet the prefixes, no row carries its text's words
    pieces = []
    for w in widths:
        pieces.append(F.transform(_shingles(F.col("ws"), w), lambda s, i: F.struct(i.alias("pos"), s.alias("s"))))
    none = F.array().cast("array<struct<pos:int,s:bigint>>")
    # one element without a shingle keeps every document
    mark = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("bigint").alias("s")))
    counted = base.select("doc", "h", "ws", F.size("ws").alias("n_words"))
    rows = counted.select("doc", "h", "n_words", F.explode(F.concat(mark, none, *pieces)).alias("e"))
    rows = rows.select("doc", "h", "n_words", F.col("e.pos").alias("pos"), F.col("e.s").alias("s"))
    met = rows.join(_small(prefix, n), "s", "left").withColumn("start", F.col("pos") - F.col("off"))
    fits = (F.col("start") >= 0) & (F.col("start") + F.size("win") <= F.col("n_words"))
    met = stored(met.filter(F.col("pos").isNull() | F.coalesce(fits, F.lit(False)))
                 .select("doc", "h", "n_words", "start", "win"), "decon-candidates")

    # the exact words: the candidates of a document meet its text, which is parted once.  Texts
    # with a candidate are picked by their hashes; neither candidates nor texts are broadcast
    tried = met.filter("win is not null")
    keys = stored(tried.select("h").distinct(), "decon-keys")
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
    if keys.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(keys), "h", "left_semi")
    sides = texts.unionByName(tried.select("doc", "h", "n_words", F.struct("start", "win").alias("c")), allowMissingColumns=True)
    each = sides.groupBy("doc", "h").agg(F.first("t", ignorenulls=True).alias("t"), F.max("n_words").alias("n_words"),
                                         F.collect_set("c").alias("cs")).filter(F.size("cs") > 0)

    def held(ws: Column) -> Column:
        return F.filter(F.col("cs"), lambda c: F.slice(ws, c["start"] + 1, F.size(c["win"])) == c["win"])

    found = F.transform(F.array(words(F.col("t"))), held)[0]
    hits = each.select("doc", "h", "n_words", F.explode(found).alias("c")).select(
        "doc", "h", "n_words", "c.start", F.size("c.win").alias("len"), "c.win")
    marks = met.filter("win is null").select("doc", "h", "n_words", "start", F.lit(None).cast("int").alias("len"), "win")
    hits = stored(marks.unionByName(hits), "decon-hits")
    forget(met, keys, prefix, seen)
    return hits, wins


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = WINDOW,
                  share: tuple[int, int] = (1, 20)) -> DataFrame:
    """Per document (doc, h): n_words, n_hit (words inside an occurrence),
    items (ids as text, sorted) and contaminated (n_hit at least the ``share`` of n_words)."""
    hits, wins = occurrences(docs, items, id_col, text_col, item_id, item_text, size)
    key = ["doc", "h"]
    before = Window.partitionBy(*key).orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    spans = hits.select(*key, "n_words", "start", "len").distinct()
    counts = (spans.withColumn("new", F.when(F.col("start").isNull(), 0).otherwise(new))
              .groupBy(*key).agg(F.max("n_words").cast("long").alias("n_words"), F.sum("new").cast("long").alias("n_hit")))
    found = (hits.filter("win is not null").select(*key, "win").distinct().join(wins, "win")
             .filter("item is not null").groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items")))
    same = (counts["h"] == found["h"]) & counts["doc"].eqNullSafe(found["doc"])
    num, den = share
    return (counts.join(found, same, "left")
            .select(counts["doc"], counts["h"], "n_words", "n_hit",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((F.col("n_hit") > 0) & (F.col("n_hit") * den >= F.col("n_words") * num)).alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that are not contaminated, all columns as they are."""
    bad = (contamination(docs, items, id_col, text_col).filter("contaminated")
           .select(F.col("doc").alias("__doc"), F.col("h").alias("__h")))
    same = docs[id_col].eqNullSafe(bad["__doc"]) & (F.xxhash64(docs[text_col]) == bad["__h"])
    return docs.join(bad, same, "left_anti")
