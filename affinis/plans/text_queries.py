"""Queries and oracles over documents, messages and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinis.functions.numbers import rounded
from affinis.functions.text import HEADER_NAMES, STOP_WORDS, extension, file_type, title_of
from affinis.operators import text as X
from affinis.plans import views as V
from affinis.plans.sql import define, g2, r6, with_
from affinis.session import cut_lineage, spread
from affinis.sources.documents import one_line


def labelled_docs(spark, sf):
    return V.docs(spark, sf).select(F.col("lang").alias("label"), "doc_id", one_line(F.col("text")).alias("text"))


def analyzed_tokens(spark, sf):
    return X.analyzed_tokens(V.docs(spark, sf))


def sentence_terms(spark, sf):
    return X.sentence_term_counts(V.table(spark, sf, "conversations"), ["conv_id", "turn"])


def message_words(spark, sf):
    return X.message_words(V.messages(spark, sf))


def message_features(spark, sf):
    return X.message_features(V.messages(spark, sf)).withColumn("value", rounded("value"))


def bigrams_llr(spark, sf):
    return X.bigrams(V.docs(spark, sf)).withColumn("llr", rounded("llr", 4))


def doc_tfidf(spark, sf):
    docs = V.docs(spark, sf)
    return X.doc_tfidf(cut_lineage(X.analyzed_tokens(docs)), V.table(spark, sf, "documents")).withColumn("weight", rounded("weight"))


def page_text(spark, sf):
    """Title, author and error of every page, and whether it has a body without markup."""
    parts = X.extract_pages(spread(V.table(spark, sf, "pages").select("page_id", "html")))
    clean = (F.length("body") > 0) & ~F.col("body").contains("<p>")
    return parts.select("page_id", "title", "author", "error", clean.alias("clean_body"))


def page_title(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", title_of(F.col("html")).alias("title"))


def file_types(spark, sf):
    url = F.col("url")
    return V.table(spark, sf, "pages").select("page_id", extension(url).alias("ext"), file_type(url).alias("type"))


def doc_sentences(spark, sf):
    """Per document: do positions run from 0 in every sentence, and the letters of its words in order, as MD5."""
    sentences = X.sentence_words(V.docs(spark, sf)).groupBy("doc_id", "sentence").agg(
        F.array_sort(F.collect_list(F.struct("position", "word"))).alias("words")
    )
    dense = (F.col("words")[0]["position"] == 0) & (F.element_at("words", -1)["position"] == F.size("words") - 1)
    whole = sentences.select("doc_id", "sentence", dense.alias("dense"), F.array_join("words.word", "").alias("said"))
    return whole.groupBy("doc_id").agg(
        F.bool_and("dense").alias("dense"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("sentence", "said"))), lambda s: s["said"]
        ), "").alias("said"),
    ).select("doc_id", "dense", F.md5(F.regexp_replace("said", r"[^\p{L}]", "").cast("binary")).alias("letters_md5"))


def sentence_terms_listed(spark, sf):
    """Terms of conversation turns without a list of stop words from a table: the words of the parts' names."""
    words = V.table(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
    types = V.table(spark, sf, "pages").select(F.explode(F.split(F.lower("html"), "[^a-z]+")).alias("word"))
    stops = words.unionByName(types).distinct()
    terms = X.sentence_term_counts(V.table(spark, sf, "conversations"), ["conv_id", "turn"], ())
    return X.without_listed(terms, "term", stops, "word")


QUERIES = {
    "sentence_terms_listed": sentence_terms_listed,
    "labelled_docs": labelled_docs,
    "analyzed_tokens": analyzed_tokens,
    "sentence_terms": sentence_terms,
    "message_words": message_words,
    "message_features": message_features,
    "bigrams_llr": bigrams_llr,
    "doc_tfidf": doc_tfidf,
    "page_text": page_text,
    "page_title": page_title,
    "file_types": file_types,
    "doc_sentences": doc_sentences,
}

# ---------------------------------------------------------------- oracle

STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
SPLIT = r"string_split_regex(lower(text), '[^\p{L}\p{N}_]+')"

define(
    "token_rows",
    f"""
    SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos FROM (
      SELECT doc_id, unnest({SPLIT}) AS token, generate_subscripts({SPLIT}, 1) AS pos FROM documents)
    WHERE regexp_full_match(token, '[a-z]{{3,}}') AND token NOT IN ({STOPS})""",
)
define("doc_tokens", "SELECT doc_id, token, count(*) AS n FROM token_rows GROUP BY 1, 2", "token_rows")
define(
    "doc_weights",
    """
    SELECT doc_id, token, ln(1e0 + n) * ln(total / CAST(df AS DOUBLE)) AS w FROM doc_tokens
    JOIN (SELECT token, count(*) AS df FROM doc_tokens GROUP BY 1) USING (token),
         (SELECT count(*) AS total FROM documents)
    WHERE df >= 5 AND df * 100 <= total * 95""",
    "doc_tokens",
)
define(
    "pair_counts",
    """
    SELECT a.token AS first, b.token AS second, count(*) AS n FROM token_rows a
    JOIN token_rows b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 GROUP BY 1, 2""",
    "token_rows",
)
define(
    "message_lines",
    r"""
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (
      SELECT doc_id, string_split_regex(regexp_replace(
        'From: ' || source || chr(10) || 'Subject: ' || lang || ' text' || chr(10) || chr(10) || chr(10) || text,
        '\r?\n\z', ''), '\r?\n') AS ls FROM documents)""",
)
_HEADER = " OR ".join(f"starts_with(line, '{h}')" for h in HEADER_NAMES)
define(
    "counted_lines",
    rf"""
    SELECT doc_id, regexp_replace(line, '.*:', '') AS text FROM message_lines WHERE {_HEADER}
    UNION ALL
    SELECT doc_id, line FROM message_lines JOIN (
      SELECT doc_id, min(pos) AS start FROM (
        SELECT doc_id, pos, regexp_full_match(line, '\s*') AS blank,
               coalesce(lag(regexp_full_match(line, '\s*')) OVER (PARTITION BY doc_id ORDER BY pos), true) AS before
        FROM message_lines) WHERE blank AND before GROUP BY 1) USING (doc_id) WHERE pos >= start""",
    "message_lines",
)
define(
    "message_counts",
    f"""
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({SPLIT}) AS word FROM counted_lines)
    WHERE word <> '' AND word NOT IN ({STOPS}) GROUP BY 1, 2""",
    "counted_lines",
)
define(
    "turn_terms",
    rf"""
    SELECT conv_id, turn, term, count(*) AS n FROM (
      SELECT conv_id, turn, unnest(string_split(regexp_replace(lower(text), '[^\p{{L}} ]', '', 'g'), ' ')) AS term
      FROM conversations) WHERE length(term) > 1 AND term NOT IN ({STOPS}) GROUP BY 1, 2, 3""",
)
_EXT = r"lower(regexp_extract(regexp_replace(url, '[?#].*', ''), '\.([^./]*)$', 1))"

ORACLE = {
    "labelled_docs": r"""
        SELECT lang AS label, doc_id, regexp_replace(regexp_replace(text, '\r?\n\z', ''), '\r?\n', ' ', 'g') AS text
        FROM documents""",
    "analyzed_tokens": with_(["doc_tokens"], "SELECT * FROM doc_tokens"),
    "sentence_terms": with_(["turn_terms"], "SELECT * FROM turn_terms"),
    "message_words": with_(["message_counts"], "SELECT * FROM message_counts"),
    "message_features": with_(
        ["message_counts", "message_lines"],
        f"""
        SELECT doc_id, feature, {r6('value', 'value')} FROM (
          SELECT doc_id, 'body=' || word AS feature, ln(1e0 + n) AS value FROM message_counts
          UNION ALL SELECT doc_id, 'intercept', 1e0 FROM documents
          UNION ALL SELECT doc_id, 'line', CAST(count(*) // 30 AS DOUBLE) FROM message_lines GROUP BY 1
          UNION ALL SELECT doc_id, 'log(line)', ln(CAST(count(*) + 1 AS DOUBLE)) FROM message_lines GROUP BY 1)""",
    ),
    "bigrams_llr": with_(
        ["pair_counts"],
        f"""
        SELECT first, second, n, {r6('llr', 'llr', 4)} FROM (
          SELECT *, {g2('n', 'x - n', 'y - n', 't - x - y + n')} AS llr FROM pair_counts
          JOIN (SELECT first, CAST(sum(n) AS BIGINT) AS x FROM pair_counts GROUP BY 1) USING (first)
          JOIN (SELECT second, CAST(sum(n) AS BIGINT) AS y FROM pair_counts GROUP BY 1) USING (second),
          (SELECT CAST(sum(n) AS BIGINT) AS t FROM pair_counts) WHERE n >= 2) WHERE llr >= 50""",
    ),
    "doc_tfidf": with_(
        ["doc_weights"],
        f"""
        SELECT doc_id, token, {r6('w / norm', 'weight')} FROM doc_weights
        JOIN (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM doc_weights GROUP BY 1) USING (doc_id) WHERE norm > 0""",
    ),
    "sentence_terms_listed": r"""
        SELECT conv_id, turn, term, count(*) AS n FROM (
          SELECT conv_id, turn, unnest(string_split(regexp_replace(lower(text), '[^\p{L} ]', '', 'g'), ' ')) AS term
          FROM conversations) WHERE length(term) > 1
        AND term NOT IN (SELECT unnest(string_split(lower(p_name), ' ')) FROM part)
        AND term NOT IN (SELECT unnest(string_split_regex(lower(html), '[^a-z]+')) FROM pages) GROUP BY 1, 2, 3""",
    "page_text": r"""
        SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title[^>]*>.*?</title>')
          THEN replace(replace(replace(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)),
            '&lt;', '<'), '&gt;', '>'), '&amp;', '&') END AS title,
          nullif(regexp_extract(html, '(?is)<meta name="author" content="([^"]*)"', 1), '') AS author,
          CAST(NULL AS VARCHAR) AS error, true AS clean_body FROM pages""",
    "doc_sentences": r"""
        SELECT doc_id, true AS dense, md5(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters_md5 FROM documents
        WHERE regexp_matches(text, '[\p{L}\p{N}]')""",
    "page_title": r"""
        SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title[^>]*>.*?</title>')
          THEN trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) END AS title FROM pages""",
    "file_types": f"""
        SELECT page_id, {_EXT} AS ext, CASE {_EXT}
          WHEN 'text' THEN 'text' WHEN 'txt' THEN 'text' WHEN 'html' THEN 'html' WHEN 'htm' THEN 'html'
          WHEN 'xml' THEN 'xml' WHEN 'pdf' THEN 'pdf' WHEN 'rtf' THEN 'rtf' WHEN 'odt' THEN 'ootext'
          WHEN 'xls' THEN 'msexcel' WHEN 'xlsx' THEN 'msexcel' WHEN 'doc' THEN 'msword' WHEN 'docx' THEN 'msword'
          WHEN 'ppt' THEN 'mspowerpoint' WHEN 'pptx' THEN 'mspowerpoint' WHEN 'pst' THEN 'msoutlook'
          WHEN 'vsd' THEN 'visio' WHEN 'png' THEN 'png' WHEN 'jpg' THEN 'jpeg' WHEN 'jpeg' THEN 'jpeg'
          WHEN 'mp3' THEN 'mp3' ELSE 'undef' END AS type FROM pages""",
}
