"""One query per operator over the whole of its table, and SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import (
    archives, conversation_repair, decontamination, near_duplicates, packing, quality_classifier, quality_rules,
    repeated_passages, secrets, sequence_packing, sharding, text_stats, token_packing, vector_codes,
)
from affinis.session import cut_lineage, scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A file of the public tokenizers, read by the driver.
WORD_VOCABULARY = "word_bpe_49k.json"
SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates.near_duplicate_classes(docs).select("doc_id", "class_id", "n_rows", "first_row")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.benchmark_hits(docs, _table(spark, sf_dir, "benchmark"))
    hit = decontamination.n_hit(F.col("hits"))
    return found.select(
        "doc_id", "hits.n_words", hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.pack(packing.measured_documents(docs))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = cut_lineage(text_stats.with_stats(docs).select("doc_id", "stats"))
    rules = quality_rules.learn_rules(quality_rules.label_stats(_table(spark, sf_dir, "labels"), stats))
    return stats.select(
        "doc_id", *[f"stats.{c}" for c in text_stats.COUNTS], quality_rules.base_failed().alias("base_failed"),
        quality_rules.kept(rules).alias("kept"), quality_rules.rule_number(rules).alias("rule"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
    )
    return sharding.number_slots(sharding.assign_shards(docs, "doc_id", SHARDS)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archives.archive_round_trip(_table(spark, sf_dir, "pages"))
    return read.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "matrices")
    matrices = token_packing.token_matrices(docs, token_packing.read_ranks(VOCABULARY))
    matrices.write.option("compression", "zstd").parquet(path)
    return token_packing.read_segments(spark.read.parquet(path))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "token")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["example"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["example"])).cast("long").alias("n_examples"),
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.remove_repeated_passages(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality_classifier.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.with_score(docs, network).select(
        "doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), ids=conversations)


def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = sequence_packing.read_vocabulary(public_tokenizers.path(WORD_VOCABULARY))
    return sequence_packing.pack_sequences(docs, vocabulary)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, codebooks = vector_codes.vector_codes(vectors)
    return vector_codes.with_label_error(coded).select(
        "row.vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_decontamination, op3_best_fit_packing, op4_quality_rules, op5_sharding,
        op6_arc_to_warc, op7_token_packing, op8_secrets, op9_repeated_passages, op10_quality_classifier, op11_conversation_repair, op12_sequence_packing,
        op13_vector_codes,
    )
}

_FOLDED = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)



def _codes_sql() -> str:
    """k-means in whole numbers: two rounds of assignment and floored means, then a last assignment."""
    steps = []
    for k in range(3):
        steps.append(f"""
        d{k} AS (
          SELECT r, p, e, sum((v.x - b.x) * (v.x - b.x)) AS d FROM v JOIN b{k} b USING (p, i) GROUP BY ALL),
        a{k} AS (SELECT r, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM d{k} GROUP BY r, p)""")
        if k < 2:
            steps.append(f"""
        m{k} AS (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM a{k} JOIN v USING (r, p) GROUP BY p, e, i),
        b{k + 1} AS (
          SELECT p, e, i, CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
          FROM b{k} LEFT JOIN m{k} USING (p, e, i))""")
    return f"""
        WITH k AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r, vec_id, label, embedding FROM embeddings
          WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (
          SELECT r, j // n AS p, j % n AS i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM (
            SELECT r, len(embedding) // 16 AS n, unnest(generate_series(0, len(embedding) - 1)) AS j,
                   unnest(embedding) AS x FROM k)),
        b0 AS (SELECT p, r AS e, i, x FROM v WHERE r < 64), {",".join(steps)},
        c AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code,
                     CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM b2) AS codebooks_sha256
        FROM k JOIN c USING (r)"""


def _repair_sql() -> str:
    """The cheapest edits row by row: for each state the least of cost and audit, as eight digits and the edits."""

    def more(x: str, cost: str, edit: str) -> str:
        return f"printf('%08d', CAST(substr({x}, 1, 8) AS BIGINT) + {cost}) || substr({x}, 9) || '{edit}'"

    inserted = (
        f"least(u, {more('e', '5', 'I')}, {more('s', '5', 'I')}, {more('a', '5', 'I')}) AS cu, "
        f"least(a, {more('u', '5', 'I')}, {more('e', '10', 'II')}, {more('s', '10', 'II')}) AS ca"
    )

    def turned(x: str, initial: str) -> str:
        return (f"CASE WHEN gone THEN NULL WHEN k = '{initial}' THEN {more(x, 'late', 'K')} "
                f"ELSE {more(x, 'late + 1', 'R')} END")

    return rf"""
        WITH RECURSIVE tab AS (
          SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
                     CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM (SELECT unnest(range(256)) AS i))),
        n AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
          FROM conversations),
        f AS (
          SELECT n.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''),
                   lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295)
                 % 20 AS fault FROM n, tab),
        d AS (
          SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE fault <> 0),
        o AS MATERIALIZED (
          SELECT *, lag(k) OVER (PARTITION BY cid ORDER BY i) AS k0, blank OR again AS gone,
                 CASE WHEN NOT blank AND NOT again AND ends NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS late FROM (
           SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 AS again FROM (
            SELECT dense_rank() OVER (ORDER BY conv_id) AS cid, conv_id, turn, role, text, role[1:1] AS k,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
                   NOT regexp_matches(text, '[^ 	-
]') AS blank,
                   right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ends FROM d))),
        v AS (
          SELECT DISTINCT cid, CAST(0 AS BIGINT) AS i, '00000000' AS e, CAST(NULL AS VARCHAR) AS s,
                 CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM o
          UNION ALL
          SELECT cid, i, {more('e', '2', 'D')},
                 least({more('s', '2', 'D')}, CASE WHEN k = 's' AND NOT gone THEN {more('e', 'late', 'K')} END),
                 least({more('cu', '2', 'D')}, {turned('least(e, s, ca)', 'u')}),
                 least({more('ca', '2', 'D')}, {turned('cu', 'a')})
          FROM (SELECT v.cid, o.i, e, s, {inserted}, k, gone, late FROM v JOIN o ON v.cid = o.cid AND o.i = v.i + 1)),
        w AS (SELECT cid, least(e, ca) AS best FROM (SELECT *, {inserted} FROM v)
              JOIN (SELECT cid, max(i) AS i FROM o GROUP BY cid) USING (cid, i)),
        p AS (
          SELECT cid, ch, sum(CASE ch WHEN 'I' THEN 0 ELSE 1 END) OVER b AS i,
                 sum(CASE ch WHEN 'D' THEN 0 ELSE 1 END) OVER b AS place, odd FROM (
            SELECT cid, unnest(string_split(best[9:], '')) AS ch, generate_subscripts(string_split(best[9:], ''), 1) AS pos,
                   length(replace(best[9:], 'D', '')) % 2 AS odd FROM w)
          WINDOW b AS (PARTITION BY cid ORDER BY pos)),
        r AS (
          SELECT p.cid, string_agg(
                   CASE WHEN ch = 'K' THEN role WHEN (place - 1 - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
                   || ':' || CASE ch WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS body
          FROM p LEFT JOIN o ON p.cid = o.cid AND p.i = o.i AND ch <> 'I' WHERE ch <> 'D' GROUP BY p.cid),
        c AS (
          SELECT cid, conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count_if(blank) AS blank, count_if(NOT blank AND again) AS duplicate, count_if(late > 0) AS truncated,
                 count_if(k0 IS NOT NULL AND k0 || k NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY cid, conv_id)
        SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
               CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
               CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(CAST(best[:8] AS BIGINT), 0) AS cost,
               coalesce(best[9:], '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN c ON q.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN w USING (cid) LEFT JOIN r USING (cid)"""


#: SQL for the operators whose result SQL can state; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_FOLDED} AS w FROM benchmark),
        p AS (
          SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS seq FROM (
            SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
            FROM b WHERE len(w) > 0)),
        o AS (
          SELECT r, i, n, item FROM (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS seq FROM (
              SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
              FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)) JOIN p USING (n, seq)),
        h AS (
          SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS pos FROM o)
          GROUP BY 1),
        t AS (
          SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM o) GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
    "op6_arc_to_warc": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
                 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
        SELECT page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda j:
                 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                   (CAST('0x' || substr(hex, CAST(1 + 5 * (j // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31
                 AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to FROM p""",
    "op9_repeated_passages": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        v AS (
          SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (
            SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
        gone AS (
          SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS pos FROM v
          WHERE h IN (SELECT h FROM v GROUP BY 1 HAVING count(*) > 1)),
        words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        kept AS (
          SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS body
          FROM words ANTI JOIN gone USING (r, pos) GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
    "op11_conversation_repair": _repair_sql(),
    "op13_vector_codes": _codes_sql(),
}
