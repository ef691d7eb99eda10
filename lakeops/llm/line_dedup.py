"""Line dedup by site-relative frequency, with DataFrame functions only.

Of each site (host, or the source of a document), a line is boilerplate if the pages that hold it are more than ``ratio`` of the site's pages,
and at least ``MIN_PAGES`` pages.  Such lines are removed wherever they stand on the site.  Lines compare whole and exactly; lines
without a word are never removed.  A page whose every line with a word would go is a copy of another page and not a page with boilerplate: it stays whole
and is left to near-duplicate removal.

Null text stays null.  Pages without a site (null) belong to no site and stay whole.  Repeated rows count as pages of their own.

A site's boilerplate is small: its pages hold ``p * l`` different lines (p pages, l distinct lines a page on average), and a line needs more than
``ratio * p`` of them, so there are fewer than ``l / ratio`` such lines.  That set, not the text, travels: by broadcast if all sites' sets
together are measured to be below ``SET_BYTES``, else by a join on the site, whose hot sites Spark's adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.scratch import stored

RATIO, MIN_PAGES = 0.002, 3
SET_BYTES = 32 << 20
LINE_BYTES = 32
HAS_WORD = r"[^\x20\x09-\x0D]"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def digest(line: Column) -> Column:
    """128 bits of a line, as two hashes."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines): the digests of each site's boilerplate lines, of pages (site, text)."""
    known = pages.filter("site IS NOT NULL")
    different = F.array_distinct(F.transform(F.filter(lines_of(F.col("text")), lambda x: x.rlike(HAS_WORD)), digest))
    held = known.select("site", F.explode(different).alias("line")).groupBy("site", "line").agg(F.count("*").alias("pages"))
    totals = known.groupBy("site").agg(F.count("*").alias("total"))
    frequent = held.filter(F.col("pages") >= min_pages).join(totals, "site").filter(F.col("pages") > ratio * F.col("total"))
    return frequent.groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, set_bytes: int = SET_BYTES
) -> DataFrame:
    """``docs`` with ``text`` cleaned, and the columns ``n_lines`` and ``n_dropped`` (both null for a null text), which replace columns of these names."""
    pages = docs.select(F.col(site).cast("string").alias("site"), F.col(text).cast("string").alias("text"))
    sets = stored(boilerplate(pages, ratio, min_pages))
    size = sets.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("n")).first()["n"] * LINE_BYTES
    sets = sets.select(F.col("site").alias("__site"), F.col("lines").alias("__lines"))
    joined = docs.join(F.broadcast(sets) if size <= set_bytes else sets, F.col(site).cast("string") == F.col("__site"), "left")
    whole = lines_of(F.col(text).cast("string"))
    # The page's own lines meet the site's set once, by hashing; then each line is sought among those found.
    own = F.transform(F.filter(whole, lambda x: x.rlike(HAS_WORD)), digest)
    joined = joined.withColumn("__hits", F.when(F.col("__lines").isNotNull(), F.array_intersect(own, "__lines")))
    stays = lambda x: ~x.rlike(HAS_WORD) | ~F.array_contains(F.col("__hits"), digest(x))
    kept = F.when(F.coalesce(F.size("__hits") <= 0, F.lit(True)), whole).otherwise(F.filter(whole, stays))
    marked = joined.withColumn("__whole", whole).withColumn("__kept", kept)
    is_copy = F.exists("__whole", lambda x: x.rlike(HAS_WORD)) & ~F.exists("__kept", lambda x: x.rlike(HAS_WORD))
    marked = marked.withColumn("__kept", F.when(is_copy, F.col("__whole")).otherwise(F.col("__kept")))
    n_lines, n_kept = F.size("__whole").cast("long"), F.size("__kept").cast("long")
    null = F.lit(None).cast("long")
    counts = [F.when(F.col(text).isNull(), null).otherwise(n).alias(c) for n, c in ((n_lines, "n_lines"), (n_lines - n_kept, "n_dropped"))]
    columns = [F.array_join("__kept", "\n").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return marked.select(*columns, *counts)
