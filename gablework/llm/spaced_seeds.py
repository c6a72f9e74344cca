"""Benchmark decontamination by spaced seeds. DataFrame functions only.

A mask says which of a few consecutive words count; the others may differ. All seeds of all texts are hashed
per mask and joined with the benchmark's seeds. A hit says that an item may lie in a text at a certain
place. There, words are compared one by one: the item leaks when ``share`` of some ``window`` consecutive
words of it (of all its words, if it has fewer) stand in the text, so single words may be replaced.

The benchmark's seeds are broadcast after they were written and measured; a large benchmark is joined by
shuffle. Hits are distinct (text, item, place), so a passage that many texts share costs a row each.

The two masks lose nothing: of every window of 11 to 20 words with at most a fifth of them replaced, at least one seed
is left, wherever the replaced words stand. Shorter items have seeds of neighbouring words, as long as the longest stretch that
must be left (the whole item below five words); texts get such seeds only if the benchmark has items that need them.

Defined results: A-Z are lower case, words are separated by ASCII white space. A null text has no words; a text
or item without words is never reported. ``leaks`` names documents, so rows without id are left out there; ``clean`` examines
them by their texts. Repeated rows count once. Texts with equal ids count as one document. Other columns are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.shared import col, is_small, materialize

MASKS = ("110111", "110001011")
SHORT = 11  # items with fewer words have seeds of neighbouring words
WINDOW = 20
SHARE = 0.8
SPACES = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    plain = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    plain = F.trim(plain, F.lit(SPACES))
    return F.when(plain != "", F.split(plain, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")


def short_width(words: int, share: float = SHARE) -> int:
    """How many neighbouring words of a short item are left unchanged at least, if enough of its words are."""
    replaced = words - math.ceil(share * words)
    return words if replaced == 0 else -(-(words - replaced) // (replaced + 1))


def hashed_words(df: DataFrame) -> DataFrame:
    """(id, h): hashes of the words. The generators keep the optimizer from putting the split and the hashes into every use of them."""
    split = df.select("id", F.explode(F.array(words_of(F.col("text")))).alias("w"))
    return split.select("id", F.explode(F.array(F.transform("w", lambda w: F.xxhash64(w)))).alias("h"))


def of_mask(name: Column, mask: str) -> Column:
    used = [k for k, m in enumerate(mask) if m == "1"]
    last = F.size("h") - len(mask)
    seeds_ = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(name, *[F.get("h", i + k) for k in used]))
    return F.when(last >= 0, seeds_).otherwise(F.array().cast("array<bigint>"))


def seeds(hashed: DataFrame, masks: Sequence[str], first: int = 0) -> DataFrame:
    """(id, at, seed): a hash of the words that count, for every place and mask; ``at`` counts from 0."""
    every = hashed.select("id", F.explode(F.array(*[of_mask(F.lit(first + n), m) for n, m in enumerate(masks)])).alias("s"))
    return every.select("id", F.posexplode("s").alias("at", "seed"))


def item_seeds(items: DataFrame, masks: Sequence[str], share: float) -> tuple[DataFrame, list[int]]:
    """Seeds of all items, and which widths of neighbouring words they need."""
    hashed = hashed_words(items)
    size = F.size("h")
    found = seeds(hashed.where(size >= SHORT), masks)
    lengths = sorted(r["n"] for r in hashed.where((size > 0) & (size < SHORT)).select(size.alias("n")).distinct().collect())  # ten at most
    for n in lengths:
        width = short_width(n, share)
        found = found.unionByName(seeds(hashed.where(size == n), ["1" * width], -width))
    return found, sorted({short_width(n, share) for n in lengths})


def small_or_not(df: DataFrame, label: str) -> DataFrame:
    kept = materialize(df, label)
    return F.broadcast(kept) if is_small(kept) else kept


def hits(docs: DataFrame, items: DataFrame, masks: Sequence[str] = MASKS, share: float = SHARE) -> DataFrame:
    """(id, item, shift): places where a seed of an item stands in a text, ``shift`` words later than in the item."""
    found, widths = item_seeds(items, masks, share)
    wanted = small_or_not(found.select(F.col("id").alias("item"), F.col("at").alias("item_at"), "seed").distinct(), "seeds")
    hashed = hashed_words(docs)
    own = seeds(hashed, masks)
    for width in widths:
        own = own.unionByName(seeds(hashed, ["1" * width], -width))
    return own.join(wanted, "seed").select("id", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def verified(docs: DataFrame, items: DataFrame, found: DataFrame, window: int, share: float) -> DataFrame:
    """(id, item, shift, n_equal, n_aligned) of the hits whose words agree well enough."""
    item_words = small_or_not(items.select(F.col("id").alias("item"), words_of(F.col("text")).alias("b")).distinct(), "items")
    texts_hit = docs.join(small_or_not(found, "hits"), "id").select("id", "item", "shift", F.explode(F.array(words_of(F.col("text")))).alias("a"))
    both = texts_hit.join(item_words, "item")
    low = F.greatest(F.lit(0), -F.col("shift"))
    high = F.least(F.size("b"), F.size("a") - F.col("shift")) - 1
    both = both.withColumn("needed", F.least(F.size("b"), F.lit(window))).where((high - low + 1) >= F.col("needed"))
    equal = F.transform(F.sequence(low, high), lambda i: (F.get("b", i) == F.get("a", i + F.col("shift"))).cast("int"))
    both = both.select("id", "item", "shift", "needed", F.explode(F.array(equal)).alias("equal"))
    n_equal = F.aggregate("equal", F.lit(0), lambda s, x: s + x)
    starts = F.sequence(F.lit(1), F.size("equal") - F.col("needed") + 1)
    good = F.exists(starts, lambda k: F.aggregate(F.slice("equal", k, F.col("needed")), F.lit(0), lambda s, x: s + x)
                    >= F.ceil(F.lit(share) * F.col("needed")))
    return both.where(good).select("id", "item", "shift", n_equal.alias("n_equal"), F.size("equal").alias("n_aligned")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, window: int = WINDOW, share: float = SHARE,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_equal, n_places): one row per leaked item and document that holds it.

    ``n_equal``: words that agree at the best place; ``n_places``: places where the item stands."""
    texts_, items = texts(docs, id_col, text_col), texts(benchmark, item_col, item_text_col)
    found = verified(texts_, items, hits(texts_, items, masks, share), window, share)
    return found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("n_equal").cast("long").alias("n_equal"), F.countDistinct("shift").alias("n_places"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document holds no leaked item, all columns kept. A row without id is a document by itself."""
    bad = small_or_not(leaks(docs, benchmark).select("doc_id").distinct(), "leaks")
    kept = docs.where("doc_id IS NOT NULL").join(bad, "doc_id", "left_anti").select(*docs.columns)
    name = F.xxhash64(F.col("text").cast("string"))
    alone = docs.where("doc_id IS NULL")
    bad_text = small_or_not(leaks(alone.select(name.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__name")).distinct(), "leaks")
    return kept.unionByName(alone.withColumn("__name", name).join(bad_text, "__name", "left_anti").select(*docs.columns))


def _sql_words(table: str, key: str) -> str:
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return (f"SELECT DISTINCT {key} AS id, list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w "
            f"FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL")


def _sql_seeds(source: str) -> str:
    parts = []
    for n, mask in enumerate(MASKS):
        key = " || ' ' || ".join(f"w[i + {k + 1}]" for k, m in enumerate(mask) if m == "1")
        parts.append(f"SELECT id, i, {n} AS m, {key} AS seed FROM (SELECT id, w, unnest(range(0, len(w) - {len(mask) - 1})) AS i FROM {source})")
    return " UNION ALL ".join(parts)


def leaks_sql(docs: str = "documents", items: str = "benchmark") -> str:
    """The same rows in SQL."""
    return f"""
WITH d AS ({_sql_words(docs, 'doc_id')}), b AS ({_sql_words(items, 'item_id')}),
ds AS ({_sql_seeds('d')}), bs AS ({_sql_seeds(f'(SELECT * FROM b WHERE len(w) >= {SHORT})')}),
hit AS (SELECT DISTINCT ds.id AS doc_id, bs.id AS item_id, ds.i - bs.i AS shift FROM ds JOIN bs ON ds.m = bs.m AND ds.seed = bs.seed
  UNION SELECT d.id, b.id, unnest(range(0, len(d.w) - len(b.w) + 1)) FROM d, b WHERE len(b.w) BETWEEN 1 AND {SHORT - 1}),
both_ AS (SELECT doc_id, item_id, shift, d.w AS a, b.w AS b, least(len(b.w), {WINDOW}) AS needed,
  greatest(0, -shift) AS low, least(len(b.w), len(d.w) - shift) AS high
  FROM hit JOIN d ON d.id = doc_id JOIN b ON b.id = item_id),
eq AS (SELECT doc_id, item_id, shift, needed, list_transform(range(low, high), lambda i: (a[i + shift + 1] = b[i + 1])::INT) AS equal
  FROM both_ WHERE high - low >= needed),
ok AS (SELECT doc_id, item_id, shift, list_sum(equal) AS n_equal FROM eq
  WHERE list_max(list_transform(range(0, len(equal) - needed + 1), lambda k: list_sum(equal[k + 1 : k + needed]))) >= ceil({SHARE} * needed))
SELECT doc_id, item_id, max(n_equal)::BIGINT AS n_equal, count(DISTINCT shift) AS n_places FROM ok GROUP BY doc_id, item_id"""
