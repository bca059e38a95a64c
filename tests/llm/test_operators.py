"""Operators on small tables against brute force, with nulls, empty and long texts, ties, repeats and odd columns."""

from __future__ import annotations

import gzip
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import (
    archives, decontamination, near_duplicates, packing, quality_classifier, quality_rules, repeated_passages, secrets,
    sharding, text_stats, token_packing,
)
from affinis.llm.words import WordHashes, folded_words
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, source string, lang string, row string, hash bigint, words int, n double"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'é' if rng.random() < 0.1 else ''}" for _ in range(n))


def corpus():
    """(doc_id, text): prose, near and exact copies, shared passages, repetition, junk, odd rows."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(60, 200)) for _ in range(30)]
    words = texts[0].split()
    for k in range(12):  # near copies of one text, each with a few words changed
        own = list(words)
        for _ in range(1 + k % 4):
            own[rng.randrange(len(own))] = f"x{k}"
        texts.append(" ".join(own))
    texts += [texts[1]] * 4 + [texts[1].upper() + "!!"]
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 40)}\n{passage} {prose(rng, 30)}" for _ in range(3)] + [passage + " " + passage]
    texts += ["a b c", "A b, c", "one", "", "   \n\t", "the the the " * 60, prose(rng, 9000), "née ça \x0bva"]
    rows = list(enumerate(texts))
    rows += [rows[2], rows[2], (None, "null id text with words in it"), (None, texts[3]), (900, None), (901, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"src{(i or 0) % 3}" if i != 7 else None, "en", "r", 1, 2, 0.5) for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_near_duplicates(docs):
    found = near_duplicates.near_duplicate_classes(docs)
    assert rows_of(found, "doc_id", "class_id") == sorted(brute.near_classes(corpus()), key=str)
    assert sum(r["first_row"] for r in found.collect()) >= len({c for _, c in brute.near_classes(corpus())})


def test_one_row_of_each_class_stays(docs):
    kept = near_duplicates.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect() if folded_words((r["text"] or "").encode())]
    bags = [brute.shingles(t) for t in texts]
    assert all(brute.jaccard(a, b) < 0.8 for k, a in enumerate(bags) for b in bags[k + 1:])
    assert {tuple(brute.folded(t)) for t in texts} <= {tuple(brute.folded(t)) for _, t in corpus()}


def test_links_without_the_lead(spark, monkeypatch):
    """A chain in one bucket: b and c are similar, both are not similar to the lead."""
    rng = random.Random(1)
    a = [f"a{k}" for k in range(100)]
    chain = [a]
    for k in range(1, 9):
        chain.append([f"z{k}_{i}" if (k - 1) * 10 <= i < k * 10 else w for i, w in enumerate(chain[-1])])
    texts = [" ".join(c) for c in chain]
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "node bigint, text string")
    members = table.selectExpr("node", "96 as n_cells", "7L as bucket", "0L as lead", "96 as lead_cells", "9L as n")
    for name, value in (("LEADS", 2), ("CELL_NODES", 3), ("MORE_LEADS", 1)):
        monkeypatch.setattr(near_duplicates, name, value)
    table = table.withColumn("text", F.col("text").cast("binary"))
    links = near_duplicates.links_to_leads(members, table, 0.7)
    parts = near_duplicates.components_in_buckets(members, table, 0.7)
    want = dict(brute.near_classes(list(enumerate(texts)), 0.7))
    assert links.count() < 4 and set(want.values()) == {0}
    assert {r["node"]: r["component"] for r in parts.collect()} == want


def test_links_of_a_large_group_grow_with_its_nodes(spark, monkeypatch):
    """Copies of one text, each changed so that most pairs are near and many are not: links stay a forest per cell."""
    rng = random.Random(12)
    base = prose(rng, 120, 5000).split()
    texts = []
    for k in range(300):
        own = list(base)
        for at in rng.sample(range(120), 1 + k % 5):
            own[at] = f"x{k}_{at}"
        texts.append(" ".join(own))
    made, met = [], near_duplicates._met

    def counted(*args):
        found = met(*args)
        made.append(found.count())
        return found

    monkeypatch.setattr(near_duplicates, "_met", counted)
    monkeypatch.setattr(near_duplicates, "LEADS", 16)
    found = near_duplicates.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert rows_of(found, "doc_id", "class_id") == sorted(brute.near_classes(list(enumerate(texts))), key=str)
    assert sum(made) < 24 * len(texts)


def test_rows_of_one_id_and_text_keep_the_least(spark):
    text = prose(random.Random(1), 50)
    rows = [(1, text, "b"), (1, text, "a"), (1, text, None), (2, text, "0"), (None, text, "c"), (3, None, "z"), (3, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, note string").repartition(3)
    kept = sorted(map(tuple, near_duplicates.keep_first(docs).collect()), key=str)
    assert kept == [(1, text, None), (3, None, "y")]


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(3)
    a = [f"w{rng.randrange(60)}".encode() for _ in range(400)]
    b = a[:300] + [f"v{rng.randrange(60)}".encode() for _ in range(100)]
    hashes = WordHashes()
    x, y = near_duplicates.unit_cells(a, hashes), near_duplicates.unit_cells(b, hashes)
    assert len(set(x.tolist())) == len(x) == 396
    want = near_duplicates.weighted_jaccard(x, y)
    assert want == pytest.approx(brute.jaccard(brute.shingles(b" ".join(a).decode()), brute.shingles(b" ".join(b).decode())))
    got = (near_duplicates.signature(x, 2000) == near_duplicates.signature(y, 2000)).mean()
    assert abs(got - want) < 0.05
    assert (near_duplicates.signature(x[:1], 50) != 0).all()


@pytest.mark.parametrize("block_bytes", [2_000_000, 300])
def test_decontamination(spark, docs, block_bytes):
    texts = dict(r for r in corpus() if r[0] is not None)
    items = [
        (1, " ".join(texts[4].split()[5:30]).upper()), (2, "one"), (3, ""), (4, None), (5, "B C"),
        (6, " ".join(texts[5].split()[:10])), (6, " ".join(texts[5].split()[:10])), (7, prose(random.Random(99), 40)),
        (None, " ".join(texts[8].split()[3:40])),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.benchmark_hits(docs, benchmark, block_bytes=block_bytes)
    assert found.columns == [*docs.columns, "hits"]
    got = rows_of(found.select(
        "doc_id", "hits.n_words", decontamination.n_hit(F.col("hits")).alias("n_hit"), F.size("hits.items").alias("k"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("sha"),
    ), "doc_id", "n_words", "n_hit", "k", "sha")
    windows = brute.benchmark_windows(items)
    assert got == sorted(((i, *brute.contamination(t, windows)[:4]) for i, t in corpus()), key=str)


def check_bins(items, placed, capacity, per_source):
    """Capacity and conflicts of every bin, and that each item went where the definition says."""
    bins = []
    for (size, source, cluster), (number, offset) in zip(items, placed, strict=True):
        fits = lambda b: (
            b["room"] >= size and (cluster is None or cluster not in b["clusters"])
            and (per_source is None or b["sources"][source] < per_source)
        )
        rooms = [b["room"] for b in bins if fits(b)]
        if number == len(bins):
            assert not rooms
            bins.append({"room": capacity, "clusters": set(), "sources": defaultdict(int)})
        own = bins[number]
        assert fits(own) and (not rooms or own["room"] == min(rooms)) and offset == capacity - own["room"]
        own["room"] -= size
        own["sources"][source] += 1
        if cluster is not None:
            own["clusters"].add(cluster)


@pytest.mark.parametrize("per_source", [None, 1, 2, 3])
def test_best_fit(per_source):
    rng = random.Random(per_source or 9)
    items = [
        (rng.randrange(1, 101), rng.choice("aaabcd"), rng.choice([None, None, rng.randrange(20), 1])) for _ in range(400)
    ] + [(37, "a", 5)] * 60 + [(20, "c", 6)] * 60
    items.sort(key=lambda p: (-p[0], p[2] is None, p[2] or 0, p[1]))
    check_bins(items, packing.best_fit(items, 100, per_source), 100, per_source)


def test_packing_is_lossless(docs):
    measured = packing.measured_documents(docs)
    sizes = defaultdict(list)
    for i, t in corpus():
        sizes[i].append(len(brute.plain(t)))
    found = packing.pack(measured, capacity=128, per_source=2, group_rows=20).collect()
    got = defaultdict(int)
    spans = defaultdict(list)
    for r in found:
        got[r["doc_id"]] += r["length"]
        assert (r["length"] > 0) == (r["bin"] is not None)
        if r["length"]:
            spans[r["bin"]].append((r["bin_offset"], r["bin_offset"] + r["length"]))
    assert dict(got) == {i: sum(s) for i, s in sizes.items()}
    for own in spans.values():
        own.sort()
        assert own[-1][1] <= 128 and own[0][0] == 0 and all(a[1] == b[0] for a, b in zip(own, own[1:]))


def test_text_stats(docs):
    found = text_stats.with_stats(docs)
    assert found.columns == [*docs.columns, "stats"]
    got = rows_of(
        found.select("doc_id", *[f"stats.{c}" for c in text_stats.COUNTS], quality_rules.base_failed().alias("failed")),
        "doc_id", *text_stats.COUNTS, "failed",
    )
    assert got == sorted(((i, *brute.rule_base(t)) for i, t in corpus()), key=str)


def labelled_rows():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        text = prose(rng, 80, 5000)
        bad = i % 4 == 0
        if bad:
            text = text.replace(" ", " ## ") if i % 8 else text.upper()
        rows.append((i, text))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_rules_are_learned(spark):
    rows, labels = labelled_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame([*labels, (None, 0), (3, None), (7000, 0)], "doc_id bigint, quality int")
    stats = text_stats.with_stats(docs)
    rules = quality_rules.learn_rules(quality_rules.label_stats(table, stats))
    assert rules and all(1 <= len(r.conditions) <= 4 for r in rules)
    found = {r["doc_id"]: r["kept"] for r in stats.select("doc_id", quality_rules.kept(rules).alias("kept")).collect()}
    truth = dict(labels)
    right = sum(found[i] == bool(truth[i]) for i in found)
    assert right >= 0.98 * len(found)
    assert sum(not found[i] for i in found if truth[i]) <= 0.01 * len(found)


def test_no_labels_no_rules(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality_rules.learn_rules(quality_rules.label_stats(labels, text_stats.with_stats(docs))) == []
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not brute.rule_base(t)[-1] for _, t in corpus())


def test_jump_shards(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789, 0xDEADBEEF]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 24, 100):
        got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_shard(F.col("k"), n).alias("s")).collect()}
        assert got == {k: brute.jump_hash(k, n) for k in keys}


def test_shards_move_only_into_the_new_one_and_slots_have_no_gap(spark):
    rows = [(i if i % 3 else 5, f"t{i}") for i in range(3000)] + [(None, "x")] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, shard string").repartition(4)
    found = sharding.number_slots(sharding.assign_shards(df, "doc_id", 24), block_rows=500).collect()
    assert len(found) == len(rows)
    assert all(r["grown_shard"] in (r["shard"], 24) for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_archives(spark):
    html = ["<p>é</p>", "", None, "<p>é</p>", "WARC/1.0\r\n\r\n\r\n", "http://a 0.0.0.0 1 text/html 3\nabc", "\n\r\n", "x" * 90_000, ""]
    rows = [(10 - i, f"http://h/{i} a" if i else None, h) for i, h in enumerate(html)] + [(7, "u", "<p>é</p>"), (7, "u", "<p>é</p>"), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = archives.archive_round_trip(pages)
    got = sorted(((
        None if r["page_id"] is None else int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
        None if r["refers_to"] is None else int(r["refers_to"]),
    ) for r in found.collect()), key=str)
    want = brute.pages(sorted(((i, h) for i, _, h in rows), key=lambda r: (r[0] is None, r[0] or 0)))
    assert got == sorted(want, key=str)
    assert len({r["record_id"] for r in found.collect()}) == len(rows)
    assert {r["date"] for r in found.collect()} == {"2001-02-03T04:05:06Z"}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    more = b" 200 - - 12 f.arc" if version == 2 else b""
    block = f"{version} 0 org\n{archives.ARC_TITLES[version]}\n".encode()
    content = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nhttp://x 1 2 3 4\n"
    data = b"filedesc://a 0 2001 text/plain" + more + b" %d\n" % len(block) + block + b"\n"
    data += b"http://a b 1.2.3.4 20200101 text/html" + more + b" %d\n" % len(content) + content + b"\n"
    data += b"dns:x 1.2.3.4 20200101 text/dns" + more + b" 0\n\n"
    (_, first, body), (_, second, none) = archives.arc_records(data)
    assert first["url"] == "http://a b" and first["type"] == "text/html" and body == content and none == b""
    assert archives.split_http(body)[1] == b"http://x 1 2 3 4\n" and second["url"] == "dns:x"
    with pytest.raises(archives.ArchiveError):
        list(archives.arc_records(data[:-40]))


def test_archives_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert archives.archive_round_trip(pages).count() == 0


def test_room_tree():
    rng = random.Random(4)
    lengths = sorted((rng.randrange(1, 65) for _ in range(500)), reverse=True)
    placed = token_packing.best_fit_decreasing(lengths, 64)
    rooms = []
    for length, (row, offset) in zip(lengths, placed, strict=True):
        fits = [r for r in rooms if r >= length]
        if row == len(rooms):
            assert not fits
            rooms.append(64)
        assert not fits or rooms[row] == min(fits)
        assert offset == 64 - rooms[row]
        rooms[row] -= length


def test_token_matrices(spark, docs):
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {b"w1": 256, b" w": 257, b" w1": 258}
    stored = token_packing.token_matrices(docs, ranks, width=64, chunk_tokens=5000)
    rows = stored.collect()
    encoding = tiktoken.Encoding("x", pat_str=token_packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2").reshape(r["n_rows"], 64) if r["n_rows"] else None
        placed = [s for s in r["segments"] if s["length"]]
        assert list(r["position_resets"]) == sorted(s["row"] * 64 + s["offset"] for s in placed)
        assert list(r["cu_seqlens"]) == sorted(r["cu_seqlens"])
        for s in r["segments"]:
            own = ids[s["row"], s["offset"]:s["offset"] + s["length"]].tolist() if s["length"] else []
            pieces[s["doc_id"]].append((s["piece"], s["start"], own))
    for i, text in corpus():
        if i is None or i == 2:
            continue
        own = sorted(pieces[i])
        assert sum((p[2] for p in own), []) == (encoding.encode_ordinary(text) if text else [])
        assert [p[1] for p in own] == list(range(0, max(1, sum(len(p[2]) for p in own)), 64))
    segments = token_packing.read_segments(stored).collect()
    assert len(segments) == sum(len(r["segments"]) for r in rows)
    one = next(s for s in segments if s["doc_id"] == 0 and s["piece"] == 0)
    ids = np.array(encoding.encode_ordinary(corpus()[0][1])[:64], "<u2")
    assert one["ids_crc32"] == zlib.crc32(ids.tobytes())


def secret_rows():
    key = "AKIA" + "ABCDEFGHIJKLMNOP"
    hexes = "0123456789abcdef" * 3
    mixed = "Zk3vQ9xT7bL2mN8pR4sWy6Ud"
    return [
        (1, f"é password = '{'a1B2c3D4'}' and {key}x", "a"), (2, f"token={hexes} TOKEN : short", "a"),
        (3, f"{mixed} ſecret=abcdefghij secret=abcdefghij", "a"), (4, "api_key:\"k" + "9" * 8 + "\"apikey=12345678=", "b"),
        (5, f"é {hexes}g{hexes}", "b"), (6, f"x {hexes}", "c"), (7, None, None), (8, "", "d"), (9, "AKIAAB AKIA" + "9" * 12, None),
        (10, "passwd=passwd=passwd=abcdefgh", "a"), (2, f"token={hexes} TOKEN : short", "a"), (None, f"{hexes}", "d"),
        (11, "a1b2c3d4" * 40_000, "e"),
    ]


def test_secrets(spark):
    docs = spark.createDataFrame([(*r, "en", 1) for r in secret_rows()], "doc_id bigint, text string, source string, lang string, spans int")
    found = secrets.scan_secrets(docs).collect()
    got = sorted(((r["doc_id"], secrets_text([s for s in r["spans"] if s["kind"] != "token"])) for r in found), key=str)
    want = sorted(((i, brute.spans_text(brute.secret_spans(t))) for i, t, _ in secret_rows()), key=str)
    assert got == want
    by_id = {r["doc_id"]: r for r in found}
    assert [s["kind"] for s in by_id[3]["spans"]] == ["token", "assign"]
    # the same hex run has the owners a, b, c and d
    assert all(s["example"] and s["n_owners"] == 4 for s in by_id[6]["spans"])
    assert not any(s["example"] for s in by_id[1]["spans"])


def secrets_text(spans):
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def test_redaction(spark):
    docs = spark.createDataFrame([(*r, "en", 1) for r in secret_rows()], "doc_id bigint, text string, source string, lang string, spans int")
    done = secrets.redact(docs)
    assert done.columns == docs.columns
    by_id = {r["doc_id"]: r["text"] for r in done.collect()}
    assert by_id[1] == "é [secret]' and [secret]x" and by_id[7] is None and by_id[8] == ""
    assert by_id[6] == secret_rows()[5][1]
    assert len(by_id) == len({r[0] for r in secret_rows()})


def test_difference_cover():
    cover = repeated_passages.COVER
    assert {(a - b) % repeated_passages.PERIOD for a in cover for b in cover} == set(range(repeated_passages.PERIOD))


@pytest.mark.parametrize("unit_bytes", [1_000_000, 400])
def test_repeated_passages(docs, unit_bytes):
    found = repeated_passages.remove_repeated_passages(docs, unit_bytes=unit_bytes)
    want = [(i, *r) for (i, _), r in zip(corpus(), brute.passages([t for _, t in corpus()]), strict=True)]
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)


def test_classifier(spark):
    rows, labels = labelled_rows()
    docs = spark.createDataFrame([*rows, (9000, None), (9001, ""), (None, "text")], "doc_id bigint, text string")
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id bigint, quality int")
    network = quality_classifier.fit(docs, table)
    found = quality_classifier.with_score(docs, network).collect()
    assert len(found) == len(rows) + 3 and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    truth = dict(labels)
    right = sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held if r["doc_id"] in truth)
    assert right >= 0.97 * sum(r["doc_id"] in truth for r in held)


def test_classifier_gradients():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in quality_classifier.initial(1).items()}
    block = rng.integers(1, 255, (5, quality_classifier.CHUNK)).astype(np.uint8)
    counts, y = np.array([2, 3]), np.array([1.0, 0.0])

    def loss(w):
        tops = quality_classifier.pooled(block, w)
        features = np.stack([np.concatenate([t.max(0), t.mean(0)]) for t in np.split(tops, [2])])
        p = quality_classifier.combined(features, w)[1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality_classifier._gradients(block, counts, y, w)
    for name in w:
        at = np.unravel_index(np.abs(grads[name]).argmax(), w[name].shape)
        moved = {k: v.copy() for k, v in w.items()}
        moved[name][at] += 1e-5
        assert (loss(moved) - loss(w)) / 1e-5 == pytest.approx(grads[name][at], rel=2e-2, abs=1e-5)


def test_chunks_cover_the_text():
    data = bytes(range(1, 251)) * 9
    own = quality_classifier.chunks(data)
    starts = [data.find(bytes(c)) for c in own]
    assert len(own) > 4 and bytes(own[0]) == data[:512] and bytes(own[-1]) == data[-512:] and -1 not in starts
    assert quality_classifier.chunks(None).shape == (1, 512)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert near_duplicates.near_duplicate_classes(none).count() == 0
    assert near_duplicates.keep_first(none).count() == 0
    assert decontamination.benchmark_hits(docs, benchmark).where(F.size("hits.spans") > 0).count() == 0
    assert packing.pack(packing.measured_documents(none)).count() == 0
    assert text_stats.with_stats(none).count() == 0
    assert sharding.number_slots(sharding.assign_shards(none, "doc_id", 24)).count() == 0
    assert token_packing.token_matrices(none, {bytes([b]): b for b in range(256)}).count() == 0
    assert secrets.scan_secrets(none).count() == 0 and secrets.redact(none).count() == 0
    assert repeated_passages.remove_repeated_passages(none).count() == 0
    network = quality_classifier.fit(none, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert network.constant == 0.5 and quality_classifier.with_score(none, network).count() == 0


def test_gzip_members():
    members = [gzip.compress(f"record {k}\n".encode() * (k % 50)) for k in range(3000)] + [gzip.compress(b"x" * 300_000)]
    want = b"".join(f"record {k}\n".encode() * (k % 50) for k in range(3000)) + b"x" * 300_000
    assert archives.unzipped(b"".join(members)) == want
    with pytest.raises(archives.ArchiveError):
        archives.unzipped(b"".join(members)[:-5])


def test_large_pages_get_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "FILE_BYTES", 20_000)
    rows = [(k, f"http://x/{k}", "y" * (15_000 if k % 20 == 3 else 5)) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    archives.write_arc(pages, f"{tmp_path}/arc", records_per_file=10)
    counts = [len(list(archives.arc_records(archives.unzipped(f.read_bytes())))) for f in tmp_path.glob("arc/part-*")]
    assert sorted(counts) == [1] * 3 + [7] + [10] * 5
    archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", records_per_file=10)
    read = archives.read_warc(spark, f"{tmp_path}/warc")
    assert sorted((int(r["page_id"]), r["payload_bytes"]) for r in read.collect()) == [(k, len(h)) for k, _, h in rows]


def test_foreign_bytes_come_through(spark, tmp_path):
    """Payloads that are no UTF-8, in gzip members, as an archive from elsewhere has them."""
    payloads = [bytes(range(256)) * 3, "né".encode("latin-1"), b"", b"\xff\xfe\r\n\r\nARC"]
    block = f"1 0 org\n{archives.ARC_TITLES[1]}\n".encode()
    records = [b"filedesc://a 0.0.0.0 2001 text/plain %d\n" % len(block) + block]
    for k, payload in enumerate(payloads):
        records.append(b"\nhttp://x/%d 1.2.3.4 2001 text/html %d\n" % (k, len(payload)) + payload)
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "old.arc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    archives.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    read = archives.read_warc(spark, f"{tmp_path}/warc").collect()
    assert sorted((r["target"], bytes(r["payload"])) for r in read) == [(f"http://x/{k}", p) for k, p in enumerate(payloads)]
    assert all(r["payload_digest"] == archives.sha1_base32(bytes(r["payload"])) for r in read)


def test_ownership_counts_owners_and_repositories(spark):
    rows = [(1, "a", r) for r in range(9)]  # one owner, many repositories
    rows += [(2, o, r) for o, r in (("a", 1), ("a", 2), ("b", 3), ("b", 4))] * 3  # two owners, four repositories
    rows += [(3, o, r) for o, r in (("a", 1), ("a", 2), ("a", 5), ("b", 3), ("b", 4))]  # two owners, five
    rows += [(4, o, 1) for o in ("a", None, "")] + [(5, None, 1), (5, None, 1)]
    table = spark.createDataFrame(rows, "hash bigint, owner string, repository int")
    found = {r["hash"]: (r["n_owners"], r["n_repositories"], r["example"]) for r in secrets.ownership(table).collect()}
    assert found == {1: (1, 9, False), 2: (2, 4, False), 3: (2, 5, True), 4: (3, 3, True), 5: (1, 1, False)}


def test_long_training_texts_count_to_the_end():
    """A sign in one chunk out of many decides, wherever it is; blocks of chunks give the gradient of all at once."""
    rng = random.Random(4)
    texts, labels = [], []
    for k in range(120):
        body = prose(rng, 900, 3000)
        at = rng.randrange(2000, 4000)
        texts.append((body[:at] + (" $$$$$$$$$$$$$$$$ " if k % 2 else " ") + body[at:]).encode())
        labels.append(k % 2)
    block = np.concatenate([quality_classifier.chunks(t) for t in texts[:8]])
    counts = np.array([len(quality_classifier.chunks(t)) for t in texts[:8]])
    w, y = quality_classifier.initial(), np.array(labels[:8], np.float32)
    whole = quality_classifier._gradients(block, counts, y, w)
    before, quality_classifier.TRAIN_BLOCK = quality_classifier.TRAIN_BLOCK, 10
    cut = quality_classifier._gradients(block, counts, y, w)
    quality_classifier.TRAIN_BLOCK = before
    assert all(np.allclose(whole[k], cut[k], atol=1e-5) for k in whole)
    network = quality_classifier.train(texts[:90], labels[:90])
    right = sum((quality_classifier.score(t, network) >= 0.5) == bool(y) for t, y in zip(texts[90:], labels[90:]))
    assert right >= 27


def test_slots_keep_columns_of_any_name(spark):
    rows = [(i, f"r{i}", i * 2, i * 3, "w", 9) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, slot_row string, slot_part int, slot_start int, slot_within string, slot int")
    found = sharding.number_slots(sharding.assign_shards(df, "doc_id", 4), block_rows=7).collect()
    kept = sorted((r["doc_id"], r["slot_row"], r["slot_part"], r["slot_start"], r["slot_within"]) for r in found)
    assert kept == [r[:5] for r in rows]
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_near_copies_are_found_by_brute_force(spark):
    """Every pair of different texts at 0.8 or more, by counting shared shingles, is in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    classes = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(docs).collect()}
    bags = {r["doc_id"]: brute.shingles(r["text"]) for r in docs.collect() if r["text"]}
    owners = defaultdict(list)
    for i, bag in bags.items():
        for shingle, n in bag.items():
            owners[shingle].append((i, n))
    shared = defaultdict(int)
    for own in owners.values():
        for a, n in own:
            for b, m in own:
                if a < b:
                    shared[a, b] += min(n, m)
    sizes = {i: sum(bag.values()) for i, bag in bags.items()}
    pairs = [(a, b) for (a, b), n in shared.items() if n / (sizes[a] + sizes[b] - n) >= 0.8]
    found = sum(classes[a] == classes[b] for a, b in pairs)
    print(f"pairs at 0.8: {len(pairs)}, in one class: {found}")
    assert len(pairs) > 50 and found >= 0.99 * len(pairs)
