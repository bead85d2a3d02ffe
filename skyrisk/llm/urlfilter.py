"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

A list holds entries of two kinds: rules (host, path, verdict), which fit their host, all its
subdomains and every path that starts with theirs, and canonical URLs, which fit themselves.
Every url of a page asks for a few keys: its canonical URL, and one (host suffix, path prefix)
for each shape of the rules, a shape being a number of host labels and a length of path. A key
is looked up in one block of 256 bits, eight bits of it. Keys whose bits are all set are only
possible hits; an exact hash join of the distinct ones with the list removes false positives,
and what is left is put beside the urls again.

The filter has at most `MOST_BLOCKS` blocks (4 MB of bits), whatever the size of the list, so
that its broadcast is bounded: a longer list has more false positives to join, and the same
results. Keys that many urls share are joined once, then dealt to the urls over `SALTS` parts.

Among the rules that fit, the longest text (host and path) decides, at equal length the longer
host, at equal host and path the one that blocks. Without a rule a url is blocked if its
canonical URL is listed. Null urls and urls without `://` have an empty host and path and are
allowed. Repeated rows are judged once each; rows with equal id and url are counted and given
back as often. Entries with a null part fit nothing; empty tables give no rows, or allow all.
Other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.shared import landed

MOST_BLOCKS = 1 << 17
BITS_PER_KEY = 12
SALTS = 16
RULE, PAGE = "rule", "page"


def lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The parts between the first `://` and the query or fragment, empty if there are none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))
    return lower(F.regexp_extract(rest, r"^[^/]*", 0)), F.regexp_replace(rest, r"^[^/]*", "")


def canonical(host: Column, path: Column) -> tuple[Column, Column]:
    """One spelling of an address: no `www.`, no default port, no closing dot, no closing
    slashes, an empty path for the root."""
    return F.regexp_replace(host, r"^www\.|(\.|:80|:443)\z", ""), F.regexp_replace(path, r"/+\z", "")


def parsed(pages: DataFrame, key: str, url: str) -> DataFrame:
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    return rows.select("id", "url", host.alias("host"), path.alias("path"))


def canonical_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """host, path: canonical URLs of the rows that have one, each once."""
    rows = parsed(pages, url, url).where("host <> ''")
    host, path = canonical(F.col("host"), F.col("path"))
    return rows.select(host.alias("host"), path.alias("path")).distinct()


def _bits(key: Column, blocks: int) -> list[Column]:
    """The block of a key and the bits it sets there, as four words of two bits each."""
    more = F.xxhash64(key, F.lit(1))
    at = [F.shiftright(more, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(8)]
    one = F.lit(1).cast("long")
    words = [
        F.call_function("shiftleft", one, at[2 * j]).bitwiseOR(F.call_function("shiftleft", one, at[2 * j + 1] + 32)).alias(f"w{j}")
        for j in range(4)
    ]
    return [key.bitwiseAND(F.lit(blocks - 1)).alias("block"), *words]


def _entries(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """kind, host, path, blocks: every key of the list once, hashed."""
    rule = rules.select(F.lit(RULE).alias("kind"), lower(F.col("host")).alias("host"), "path", (F.col("verdict") == "block").alias("blocks"))
    page = listed.select(F.lit(PAGE).alias("kind"), "host", "path", F.lit(True).alias("blocks"))
    rows = rule.union(page).dropna().groupBy("kind", "host", "path").agg(F.max("blocks").alias("blocks"))
    return rows.withColumn("key", F.xxhash64("kind", "host", "path"))


def bloom(entries: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The blocks of the filter over `n` keys, and how many there may be. Every task sets the
    bits of its keys before blocks are shuffled."""
    blocks = 1
    while blocks < MOST_BLOCKS and blocks * 256 < n * BITS_PER_KEY:
        blocks *= 2
    return entries.select(*_bits(F.col("key"), blocks)).groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"f{j}") for j in range(4)]), blocks


def _keys(shapes: list[tuple[int, int]]) -> Column:
    """What a url asks for, as an array of (kind, host, path)."""
    host, path = F.col("host"), F.col("path")
    labels = F.size(F.split(host, r"\."))
    asked = [
        F.when(
            (host != "") & (labels >= n) & (F.length(path) >= size),
            F.struct(F.lit(RULE).alias("kind"), F.substring_index(host, ".", -n).alias("host"), F.substring(path, 1, size).alias("path")),
        )
        for n, size in shapes
    ]
    own_host, own_path = canonical(host, path)
    asked.append(F.when(host != "", F.struct(F.lit(PAGE).alias("kind"), own_host.alias("host"), own_path.alias("path"))))
    return F.array_compact(F.array(*asked))


def possible(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """id, url and each key of theirs that the filter lets through."""
    shape = entries.where(F.col("kind") == RULE).select(F.size(F.split("host", r"\.")).alias("n"), F.length("path").alias("size"))
    shapes = sorted((r["n"], r["size"]) for r in shape.distinct().collect())  # pairs of small numbers
    blocks, n = bloom(entries, entries.count())
    asked = rows.select("id", "url", F.explode(_keys(shapes)).alias("k")).select("id", "url", "k.*")
    asked = asked.select("id", "url", "kind", "host", "path", *_bits(F.xxhash64("kind", "host", "path"), n))
    met = asked.join(F.broadcast(blocks), "block")  # at most MOST_BLOCKS rows of five numbers
    for j in range(4):
        met = met.where(F.col(f"w{j}").bitwiseAND(F.col(f"f{j}")) == F.col(f"w{j}"))
    return met.select("id", "url", "kind", "host", "path")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, listed for every row of `pages`. `rules` has host, path
    and verdict (block or allow), `listed` host and path of canonical URLs to block."""
    rows = parsed(pages, key, url)
    entries = landed(_entries(rules, listed), "entries")
    hits = possible(rows, entries)
    on = ["kind", "host", "path"]
    # The exact join, of distinct keys on both sides.
    true = hits.select(*on).distinct().join(entries.hint("shuffle_hash"), on).select(*on, "blocks")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    met = salted.join(true.withColumn("salt", salts), [*on, "salt"])
    text = F.concat("host", "path")
    best = F.when(F.col("kind") == RULE, F.struct(F.length(text).alias("n"), F.length("host").alias("h"), "blocks", text.alias("text")))
    met = met.select("id", "url", F.lit(0).cast("long").alias("n"), best.alias("best"), (F.col("kind") == PAGE).alias("listed"))
    own = rows.select("id", "url", F.lit(1).cast("long").alias("n"), F.lit(None).cast(met.schema["best"].dataType).alias("best"), F.lit(False).alias("listed"))
    judged = own.union(met).groupBy("id", "url").agg(F.sum("n").alias("n"), F.max("best").alias("best"), F.max("listed").alias("listed"))
    host, path = host_and_path(F.col("url"))
    return judged.select(
        F.col("id").alias(key),
        host.alias("host"),
        path.alias("path"),
        F.col("best.text").alias("rule"),
        F.when(F.coalesce("best.blocks", "listed"), "block").otherwise("allow").alias("verdict"),
        "listed",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("_copy"),
    ).drop("_copy")
