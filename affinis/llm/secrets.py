"""Secrets in texts, and how widely each candidate is owned.

Three base kinds are found in every text: assignments, access keys, long hex runs. A fourth, ``token``, takes other
long mixed runs that look random. Candidates are hashed (values are never kept) and counted over the whole corpus by
distinct repositories and owners. A value of ``wide`` owners or more is a copied example; so is one of two owners or
more that ``wide_repositories`` repositories have. A value of one owner looks live in however many repositories it is,
as does one that few repositories of few owners have. Counting removes repeated (hash, owner, repository) rows first,
with map-side combine, so a placeholder in a third of all texts costs a row per repository.

All base spans are reported whatever the verdict; a ``token`` span is reported only if it looks live.
Null texts are empty. Null owners count as one owner, apart from the empty name. Repeated rows each report their spans and count once.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from affinis.llm.columns import with_text_column
from affinis.llm.words import signed
from affinis.session import cut_lineage

# The base patterns, on UTF-8 bytes.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "token")

TOKEN = re.compile(rb"[A-Za-z0-9+/_-]+={0,2}")
TOKEN_CHARS = 24
#: Owners, and repositories of more than one owner, that make a value an example.
WIDE, WIDE_REPOSITORIES = 3, 5

_IS_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_IS_TOKEN = bytes(116 if chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/_-") else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

CANDIDATES = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("hash", LongType()),
]))


def _runs(mask: bytes, mark: bytes, length: int):
    """Starts of maximal runs of at least ``length`` marks."""
    at = mask.find(mark * length)
    while at >= 0:
        yield at
        end = mask.find(b" ", at)
        at = mask.find(mark * length, end) if end >= 0 else -1


def byte_spans(text: bytes) -> list[tuple[int, int, str, bytes]]:
    """(start, end, kind, value) in bytes."""
    found = []
    lower = text.translate(_LOWER)
    if any(word in lower for word in _KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                found.append((m.start(), m.end(), "assign", m[2]))
    if b"AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    for at in _runs(text.translate(_IS_HEX), b"h", 32):
        m = HEX.match(text, at)
        found.append((at, m.end(), "hex", m[0]))
    base = [(a, b) for a, b, _, _ in found]
    for at in _runs(text.translate(_IS_TOKEN), b"t", TOKEN_CHARS):
        m = TOKEN.match(text, at)
        if _looks_random(m[0]) and not any(a < m.end() and at < b for a, b in base):
            found.append((at, m.end(), "token", m[0]))
    return found


def _looks_random(value: bytes) -> bool:
    """Digits, capitals and small letters, and hardly a sign that repeats."""
    kinds = (any(48 <= b <= 57 for b in value), any(65 <= b <= 90 for b in value), any(97 <= b <= 122 for b in value))
    return all(kinds) and len(set(value)) >= 12


def find_candidates(text: bytes | None) -> list[dict]:
    """Spans in code points, in order."""
    out, at, chars = [], 0, 0
    found = sorted(byte_spans(text), key=lambda s: (s[0], KINDS.index(s[2]))) if text else ()
    for start, end, kind, value in found:
        chars, at = chars + len(text[at:start].decode("utf-8", "replace")), start
        out.append({
            "kind": kind, "start": chars, "end": chars + end - start, "hash": signed(xxhash.xxh3_64_intdigest(value)),
        })
    return out


def with_candidates(docs: DataFrame, text: str = "text", out: str = "candidates") -> DataFrame:
    """``docs`` with all candidates of the text. One pass, no shuffle."""
    return with_text_column(docs, text, out, CANDIDATES, lambda: find_candidates)


def ownership(candidates: DataFrame, wide: int = WIDE, wide_repositories: int = WIDE_REPOSITORIES) -> DataFrame:
    """(hash, n_owners, n_repositories, example) from rows (hash, owner, repository)."""
    seen = candidates.select("hash", "owner", "repository").distinct()
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    copied = (F.col("n_owners") >= wide) | ((F.col("n_owners") >= 2) & (F.col("n_repositories") >= wide_repositories))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")
    ).withColumn("example", copied)


def judged_spans(
    scanned: DataFrame, owner: Column, repository: Column, candidates: str = "candidates", wide: int = WIDE,
) -> DataFrame:
    """(row, spans) for every row of ``scanned`` with a candidate; ``scanned`` has a unique ``row``.

    spans: kind, start, end, hash, n_owners, n_repositories, example, by start and kind; ``token`` spans only where
    they are no examples.
    """
    each = cut_lineage(scanned.where(F.size(candidates) > 0).select(
        "row", owner.cast("string").alias("owner"), repository.alias("repository"), F.explode(candidates).alias("c")
    ).select("row", "owner", "repository", "c.*"))
    judged = each.join(ownership(each, wide), "hash").where("kind <> 'token' or not example")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("order")
    return judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", order, "end", "kind", "hash", "n_owners", "n_repositories", "example"
    ))).alias("spans"))


def scan_secrets(
    docs: DataFrame, text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
    wide: int = WIDE, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns of every row of ``docs``, with ``spans`` as of ``judged_spans`` (empty where none)."""
    names = [f"keep_{k}" for k in range(len(keep))]
    columns = [F.col(c).alias(n) for c, n in zip(keep, names, strict=True)]
    narrow = docs.select(
        *columns, F.col(owner).cast("string").alias("owner"), F.struct(*repository).alias("repository"),
        F.col(text).alias("text"),
    )
    scanned = with_candidates(narrow, "text").drop("text").withColumn("row", F.monotonically_increasing_id())
    scanned = cut_lineage(scanned)
    spans = judged_spans(scanned, F.col("owner"), F.xxhash64("repository"), wide=wide)
    empty = F.array().cast(spans.schema["spans"].dataType)
    return scanned.select("row", *names).join(spans, "row", "left").select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.coalesce("spans", empty).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def redact(
    docs: DataFrame, text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
    wide: int = WIDE, mark: str = "[secret]",
) -> DataFrame:
    """``docs`` with every live-looking span replaced by ``mark``; copied examples stay.

    Texts without a candidate pass by; only the others are joined with the verdicts.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), F.col(owner).cast("string").alias("owner"),
        F.xxhash64(*repository).alias("repository"), F.col(text).alias("text"),
    )
    scanned = with_candidates(packed, "text").withColumn("row", F.monotonically_increasing_id())
    scanned = cut_lineage(scanned)
    live = judged_spans(scanned, F.col("owner"), F.col("repository"), wide=wide).select(
        "row", F.filter("spans", lambda s: ~s["example"]).alias("spans")
    )
    some = scanned.where(F.size("candidates") > 0).join(live, "row", "left")
    clean = scanned.where(F.size("candidates") == 0)
    cut = F.aggregate(
        F.coalesce("spans", F.array().cast(live.schema["spans"].dataType)),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(
            a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at")
        )).otherwise(F.struct(
            F.concat(a["done"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("done"),
            s["end"].alias("at"),
        )),
        lambda a: F.concat(a["done"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    out = lambda df, body: df.select(*[
        body.alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in names
    ])
    return out(clean, F.col("text")).unionByName(out(some, cut))
