"""The pipeline on small tables against brute force, stage by stage."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import prose

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hash bigint"


def documents():
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(30, 90), 3000) for _ in range(25)]
    texts += [texts[0], texts[0].upper(), texts[1] + " more", texts[2].replace(" ", "  ", 3)]
    texts += [f"{prose(rng, 30)} {texts[3]} {prose(rng, 200)}"]  # holds a text that the benchmark has
    texts += ["short text", "the the the " * 40, "", None, prose(rng, 5000, 3000)]
    texts += [f"{prose(rng, 25, 3000)} token = {k * 8} {prose(rng, 10, 3000)}" for k in ("ab12", "cd34")]
    texts += [f"{prose(rng, 25, 3000)} token = {'ef56' * 8} {prose(rng, 10, 3000)}" for _ in range(4)]
    rows = [(i, t, "en", f"src{i % 4}", len(t or ""), "r", 1) for i, t in enumerate(texts)]
    return [*rows, rows[4], (900, "a repeated row without id " * 8, "en", None, 5, "r", 1)]


def write(spark, folder, labels):
    benchmark = [(1, documents()[3][1]), (2, None), (3, "never seen in any text of these at all here now")]
    spark.createDataFrame(documents(), COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def live_redacted(rows):
    """Texts with the base secrets of fewer than three owners replaced."""
    values, owners = defaultdict(set), {}
    for i, t, _, source, *_ in rows:
        owners[i] = source
        for a, kind, b in brute.secret_spans(t):
            value = t[a:b].split("= ")[-1] if kind == 0 else t[a:b]
            values[value].add(source)
    out = {}
    for i, t, *_ in rows:
        done, at = "", 0
        for a, kind, b in brute.secret_spans(t):
            value = t[a:b].split("= ")[-1] if kind == 0 else t[a:b]
            if len(values[value]) >= 3:
                continue
            if a >= at:
                done += t[at:a] + "[secret]"
            at = max(at, b)
        out[i] = done + t[at:]
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    sf_dir = write(spark, tmp_path, [])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/stage{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/stage{k}")
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == before.columns

    rows = [r for r in documents() if not brute.rule_base(r[1])[-1]]
    assert Counter(r["doc_id"] for r in seen["quality rules"]) == Counter(r[0] for r in rows)
    classes = dict(brute.near_classes([(r[0], r[1]) for r in rows]))
    rows = list({r[0]: r for r in rows if classes[r[0]] == r[0]}.values())
    assert sorted(r["doc_id"] for r in seen["near-dedup"]) == sorted(r[0] for r in rows)
    windows = brute.benchmark_windows([(1, documents()[3][1]), (3, "never seen in any text of these at all here now")])
    rows = [r for r in rows if not brute.contamination(r[1], windows)[-1]]
    assert sorted(r["doc_id"] for r in seen["decontamination"]) == sorted(r[0] for r in rows)
    texts = live_redacted(rows)
    assert {r["doc_id"]: r["text"] for r in seen["secret scans"]} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secret scans"])
    assert sum("[secret]" in t for t in texts.values()) == 2
    lengths, bins = Counter(), defaultdict(list)
    for r in seen["best-fit packing"]:
        lengths[r["doc_id"]] += r["length"]
        bins[r["bin"]].append((r["bin_offset"], r["length"], r["doc_id"]))
    assert lengths == Counter({i: len(brute.plain(t)) for i, t in texts.items()})
    sources = {r[0]: r[3] for r in rows}
    for own in bins.values():
        own.sort()
        assert own[-1][0] + own[-1][1] <= 2048 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:]))
        assert max(Counter(sources[i] for _, _, i in own).values()) <= 2


def test_run_rejects_what_the_rules_learn(spark, tmp_path):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        text = prose(rng, 40, 5000)
        rows.append((i, text.replace(" ", " $$ ") if i % 4 == 0 else text, "en", f"s{i % 7}", 1))
        labels.append((i, int(i % 4 != 0)))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, "x")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert left == {i for i in range(400) if i % 4}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
