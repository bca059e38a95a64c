"""Conversation repair against a plain dynamic programme that keeps the least audit of every state."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from affinis.llm import conversation_repair as R

LEGAL = re.compile(r"(s?(ua)+)?")


def least_audit(rows):
    """(cost, audit) of the cheapest edits of (initial, must go, truncated) rows, by prefixes of role initials' states."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = {"": (0, "")}

    def add(found, state, cost, audit):
        if state not in found or (cost, audit) < found[state]:
            found[state] = (cost, audit)

    def with_insertions(states):
        found = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(found.items()):
                for role in "ua":
                    if (state, role) in after:
                        add(found, after[state, role], cost + 5, audit + "I")
        return found

    for initial, must_go, truncated in rows:
        found = {}
        for state, (cost, audit) in with_insertions(states).items():
            add(found, state, cost + 2, audit + "D")
            if must_go:
                continue
            for role in "sua":
                if (state, role) not in after:
                    continue
                if role == initial:
                    add(found, after[state, role], cost + 5 * truncated, audit + "K")
                if role != "s":
                    add(found, after[state, role], cost + 1 + 5 * truncated, audit + "R")
        states = found
    return min(v for k, v in with_insertions(states).items() if k in ("", "a"))


def brute(original, spoken):
    """The report of every conversation of ``original`` from rows (conv, turn, role, text)."""
    out = {}
    groups = defaultdict(list)
    for conv, turn, role, text in spoken:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv in {r[0] for r in original}:
        rows = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
            cut = not blank and not again and re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?"
            seen.add((role, text))
            for k, fault in enumerate((blank, again and not blank, cut)):
                counts[k] += fault
            judged.append((role[:1], blank or again, cut))
        turns = [r[0] for r in rows if r[0] is not None]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit = least_audit(judged)
        place, at, said = 0, 0, []
        odd = len(audit.replace("D", "")) % 2
        for edit in audit:
            role, text = ("", "") if edit == "I" else rows[at][1:]
            at += edit != "I"
            if edit != "D":
                said.append(f"{role if edit == 'K' else ('user', 'assistant')[(place - odd) % 2]}:{text}")
                place += 1
        assert LEGAL.fullmatch("".join(s[0] for s in said)), audit
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def conversations():
    rng = random.Random(9)
    rows = []
    for conv in [*range(120), None]:
        n = rng.choice((0, 1, 2, 5, 9, 40))
        for turn in range(n):
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None, "usher", "Assistant"))
            text = rng.choice(("Yes.", "No!", "a\nlonger one, é?", "cut off", "", " \t\n", None, "trail. \x0b", f"{rng.random()}."))
            rows.append((conv, rng.choice((turn, turn, turn + 3, None)), role, text))
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(60)]  # nothing to do
    rows += [(501, t, "user", "never ends") for t in range(40)] + [(501, 40, "assistant", "x.")]
    rows += [(502, 7, "user", "the same row.")] * 50 + [(502, 8, "assistant", "x.")] * 30  # repeated rows
    rows += [(503, t, "user", f"never ends {t}") for t in range(90)] + [(503, 99, "assistant", "Done.")]
    rows += [(504, t, "assistant", "") for t in range(70)] + [(504, 71, "assistant", "Done.")]
    rows += [(505, t, "system", f"{t}.") for t in range(30)] + [(506, None, None, None)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(conversations(), SCHEMA).repartition(3)


def report(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in names) for r in df.collect()}


def test_damage_equals_brute_force(table):
    found = sorted(map(tuple, R.damaged(table).collect()), key=str)
    assert found == sorted(damage(conversations()), key=str)


@pytest.mark.parametrize("chunk_rows, passes", [(4096, 3), (7, 3), (1, 0), (3, 1)])
def test_report_equals_brute_force(table, chunk_rows, passes):
    """One chunk, fix-up passes that suffice, matrices at once, matrices after a pass."""
    clashing = table.select("*", F.lit(1).alias("conv"), F.lit(2).alias("at"), F.lit("x").alias("digest"))
    found = R.repair_report(clashing, ids=table, chunk_rows=chunk_rows, passes=passes)
    assert report(found) == brute(conversations(), conversations())


def test_damaged_conversations(table):
    found = R.repair_report(R.damaged(table), ids=table, chunk_rows=5)
    assert report(found) == brute(conversations(), damage(conversations()))


def test_repaired_rows_are_legal(spark, table):
    spoken, _, audits = R.audited(table, chunk_rows=6)
    rows = defaultdict(list)
    for r in R.repaired_rows(spoken, audits).collect():
        rows[r["conv"]].append((r["place"], r["role"], r["text"]))
    digests = {c: v[-1] for c, v in brute(conversations(), conversations()).items()}
    for conv, own in rows.items():
        own.sort()
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert LEGAL.fullmatch("".join(role[0] for _, role, _ in own))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in own).encode()).hexdigest() == digests[conv]


def test_all_rows_dropped_and_no_rows(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)
    found = R.repair_report(R.damaged(one), ids=one)
    assert report(found) == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert R.repair_report(one.limit(0)).collect() == []
