"""Benchmark passages in documents, by Wu-Manber search over words.

Every window of ``width`` consecutive words of a benchmark item is a pattern. Patterns of one length share
three tables: how far the search may jump on a block of words, which patterns end with a block, and the
patterns themselves. A block that ends no pattern moves the search on by its shift; a block that does leads to
a bucket of patterns, each compared word by word.

The benchmark is read in blocks of about ``block_bytes`` of text, by a hash of the item. A usual benchmark is one
block and one pass of the documents. With more, each block's narrow hits are written before the next block is read and
its broadcast is destroyed, so only one block's texts are on the driver and the workers at a time.

Null and wordless texts have no words, hence no hits. Items without words are no patterns; an item of fewer words
than a window is one pattern. An item with a null id is searched like others: its words are hit and make a document
contaminated, but it has no name to list. Equal items all count. Repeated documents each get their own row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from affinis.llm.columns import with_text_column
from affinis.llm.words import folded_words
from affinis.session import cut_lineage

HITS = StructType([
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
    StructField("items", ArrayType(StringType())),
])


class WuManber:
    """Patterns of equal length in words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], length: int):
        self.length, self.block = length, min(3, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[list[bytes], set[str]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                block = pattern[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            self.buckets[pattern[length - self.block:]].append((list(pattern), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of every occurrence."""
        shift, jump, block, length = self.shift.get, self.jump, self.block, self.length
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block:end])
            step = shift(key, jump)
            if step:
                end += step
                continue
            window = words[end - length:end]
            for pattern, items in self.buckets[key]:
                if pattern == window:
                    yield end - length, items
            end += 1


def compile_items(items: list[tuple[str | None, bytes]], width: int) -> list[WuManber]:
    """One table set per pattern length."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        words = folded_words(text)
        length = min(width, len(words))
        for start in range(len(words) - length + 1) if words else ():
            by_length[length][tuple(words[start:start + length])].add(name)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


def find_hits(words: list[bytes], searches: list[WuManber]) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint spans of hit words in order, and the items that hit."""
    found, items = [], set()
    for search in searches:
        for start, names in search.search(words):
            found.append((start, start + search.length))
            items |= names
    return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 10, out: str = "hits", block_bytes: int = 2_000_000,
) -> DataFrame:
    """``docs`` with a struct ``out``: number of words, spans of hit words (end exclusive), sorted item names.

    An input column named ``out`` is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item).cast("string").alias("name"), F.col(item_text).cast("binary").alias("text")
    ).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks))

    def sent(number: int):
        return spark.sparkContext.broadcast([(r["name"], bytes(r["text"])) for r in items.where(part == number).collect()])

    if n_blocks == 1:
        block = sent(0)
        return with_text_column(docs, text, out, HITS, lambda: _hits_of(block.value, width))
    names = [c for c in docs.columns if c != out]
    held = cut_lineage(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), F.col(f"`{text}`").alias("text")
    ).withColumn("row", F.monotonically_increasing_id()))
    found = []
    for number in range(n_blocks):
        block = sent(number)
        hits = with_text_column(held.select("row", "text"), "text", "hits", HITS, lambda block=block: _hits_of(block.value, width))
        keep = F.lit(number == 0) | (F.size("hits.spans") > 0)
        found.append(cut_lineage(hits.select("row", "hits").where(keep)))
        block.destroy()
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # at most one row per document and block, so a group is as large as the benchmark has blocks
    whole = every.groupBy("row").agg(
        F.max("hits.n_words").alias("n_words"), F.flatten(F.collect_list("hits.spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits.items")))).alias("items"),
    ).select("row", F.struct("n_words", _merged_spans(F.col("spans")).alias("spans"), "items").alias("found"))
    joined = held.select("row", "whole").join(whole, "row")
    return joined.select(*[F.col("whole").getField(c).alias(c) for c in names], F.col("found").alias(out))


def _hits_of(items: list[tuple[str | None, bytes]], width: int):
    searches = compile_items(items, width)

    def of(value: bytes | None) -> dict:
        words = folded_words(value)
        spans, names = find_hits(words, searches)
        return {"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(n for n in names if n is not None)}

    return of


def _merged_spans(spans):
    """Spans in order, joined where they meet."""
    kind = HITS["spans"].dataType
    joined = F.aggregate(
        F.array_sort(spans), F.lit(None).cast(kind),
        lambda done, s: F.when(done.isNull(), F.array(s)).when(
            s["start"] <= F.element_at(done, -1)["end"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return F.coalesce(joined, F.array().cast(kind))


def n_hit(hits) -> F.Column:
    """Number of hit words."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
