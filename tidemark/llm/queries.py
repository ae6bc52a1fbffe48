"""One query per operator over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, decontaminate, fertility, html_main, jaccard, langid, line_dedup, mixing, passage_dedup, pii, prefix_trie, run_dedup, spelling, stupid_backoff, toxicity
from tidemark.llm.common import bucket_of, word_count
from tidemark.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *[of(kind) for kind in pii.BASE_KINDS], F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("pii")).alias("spans"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)))
    model = langid.learn(docs.where(bucket_of("doc_id", 4) != 2))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_main.extract_main(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, tokeniser measures and verdict for every document."""
    found = fertility.judge(table(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, "n_tokens", *fertility.MEASURES)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies and number of links of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("k")


def op6_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, counted over all documents."""
    found = stupid_backoff.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


def op6_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document from n-grams of up to three words."""
    found = stupid_backoff.score(table(spark, sf_dir, "documents"), order=3)
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), learn_from=bucket_of("doc_id", 5) != 0)
    held_out = F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False))
    found = toxicity.score(docs, model, out="score")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of words, inside lines and across them, that occurred before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return run_dedup.dedup_runs(docs).select("doc_id", "removed_words", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"), "kept_text")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "removed_words", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"), "kept_text")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages, word by word, that occurred before."""
    return passage_dedup.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "kept_text", "removed_words")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted for training, read back from the formatted string."""
    planted = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(planted).alias("text"))
    turns = turns.unionByName(more)
    found = chat_format.format_chat(turns).withColumns(
        {"turns": chat_format.read_turns(F.col("formatted")), "loss": F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss_mask")), "")}
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with planted misprints."""
    return spelling.spelling_variants(spelling.count_words(table(spark, sf_dir, "documents"), misprint=199))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt with common beginnings."""
    turns = materialise(prefix_trie.turn_keys(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns), turns)


_SIZES = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight, 2.0::DOUBLE * source_size AS most FROM sources
), levels AS (
    SELECT *, row_number() OVER byratio AS rank,
        (1.5::DOUBLE * sum(source_size) OVER () - (sum(most) OVER byratio - most)) / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted WINDOW byratio AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), level AS (
    SELECT arg_min(level, rank) AS level FROM levels WHERE level <= most / weight
), targets AS (
    SELECT source, source_size, coalesce(least(most, weight * level.level), most) AS target FROM weighted CROSS JOIN level
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS place
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), epochs AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM placed
)
SELECT doc_id, size, source_size, target,
    CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - place)) AS BIGINT) AS taken
FROM epochs
"""

_BACKOFF = r"""
WITH words AS (
    SELECT doc_id, r, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a
    FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))
), single AS (
    SELECT b AS w, count(*) AS n FROM words GROUP BY b
), pair AS (
    SELECT a, b, count(*) AS n FROM words WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) >= 2
), scored AS (
    SELECT r, CASE WHEN words.a IS NULL THEN ln(o.n / (SELECT sum(n) FROM single))
        WHEN pair.n IS NOT NULL THEN ln(pair.n / c.n)
        ELSE ln(o.n / (SELECT sum(n) FROM single)) + ln(0.4) END AS s
    FROM words JOIN single o ON words.b = o.w LEFT JOIN single c ON words.a = c.w LEFT JOIN pair ON words.a = pair.a AND words.b = pair.b
), summed AS (
    SELECT r, count(*) AS n, sum(s) AS s FROM scored GROUP BY r
)
SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(s, 0.0), 4) AS log_score, round(s / n, 6) AS mean_log
FROM (SELECT doc_id, row_number() OVER () AS r FROM documents) LEFT JOIN summed USING (r)
"""

_TRIGRAMS = r"""
WITH words AS (
    SELECT r, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a, CASE WHEN i > 2 THEN w[i - 2] END AS z
    FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (
        SELECT row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))
), single AS (
    SELECT b AS w, count(*) AS n FROM words GROUP BY b
), pair AS (
    SELECT a, b, count(*) AS n FROM words WHERE a IS NOT NULL GROUP BY a, b HAVING count(*) >= 2
), triple AS (
    SELECT z, a, b, count(*) AS n FROM words WHERE z IS NOT NULL GROUP BY z, a, b HAVING count(*) >= 2
), scored AS (
    SELECT r, CASE WHEN triple.n IS NOT NULL THEN ln(triple.n / p.n)
        ELSE CASE WHEN words.z IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN pair.n IS NOT NULL THEN ln(pair.n / c.n)
            ELSE ln(o.n / (SELECT sum(n) FROM single)) + CASE WHEN words.a IS NULL THEN 0 ELSE ln(0.4) END END END AS s
    FROM words JOIN single o ON words.b = o.w LEFT JOIN single c ON words.a = c.w LEFT JOIN pair ON words.a = pair.a AND words.b = pair.b
        LEFT JOIN pair p ON words.z = p.a AND words.a = p.b LEFT JOIN triple ON words.z = triple.z AND words.a = triple.a AND words.b = triple.b
), summed AS (
    SELECT r, count(*) AS n, sum(s) AS s FROM scored GROUP BY r
)
SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(s, 0.0), 4) AS log_score, round(s / n, 6) AS mean_log
FROM (SELECT doc_id, row_number() OVER () AS r FROM documents) LEFT JOIN summed USING (r)
"""

_WINDOWS = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wanted AS (
    SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM wanted
), places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lengths WHERE len(w) >= n)
), hits AS (
    SELECT r, i, p.n, item FROM places p JOIN wanted q ON p.n = q.n AND p.g = q.g
), words AS (
    SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r
), items AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_CHAT = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM given
), marked AS (
    SELECT *, i = 1 OR role <> lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS opens,
        regexp_replace(regexp_replace(role, '(\[)(\\*/?INST\])', '\1\\\2', 'g'), '(<)(\\*/?s>)', '\1\\\2', 'g') AS safe_role,
        regexp_replace(regexp_replace(text, '(\[)(\\*/?INST\])', '\1\\\2', 'g'), '(<)(\\*/?s>)', '\1\\\2', 'g') AS safe_text
    FROM numbered
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(safe_text) + CASE WHEN opens THEN length('[INST]' || safe_role || '[/INST]' || '</s>') ELSE length('<s>') END) AS BIGINT) AS formatted_chars,
    CAST(count(*) FILTER (opens) AS BIGINT) AS n_blocks
FROM marked GROUP BY conv_id
"""

_SPELLING = r"""
WITH RECURSIVE steps AS (
    SELECT list(list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END) ORDER BY n) AS t
    FROM range(256) AS r(n)
), runs AS (
    SELECT doc_id, run, count(*) AS k FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
    ) GROUP BY ALL
), coded AS (
    SELECT run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
), summed AS (
    SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h
    FROM coded, steps
), counted AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n
    FROM summed GROUP BY word HAVING sum(k) >= 5 AND length(word) >= 6
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counted
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM places
), near AS (
    SELECT p.word, q.word AS other, q.n AS other_n FROM cut p JOIN cut q ON p.i = q.i AND p.a = q.a AND p.b = q.b AND p.word <> q.word
    UNION SELECT p.word, q.word, q.n FROM cut p JOIN counted q ON p.a || p.b = q.word
    UNION SELECT q.word, p.word, p.n FROM cut p JOIN counted q ON p.a || p.b = q.word
), best AS (
    SELECT word, count(*) AS n_near, min({'less': -other_n, 'other': other}) AS b FROM near GROUP BY word
), formed AS (
    SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * c.n THEN b.other END AS form, CASE WHEN -b.less >= 5 * c.n THEN -b.less END AS form_n
    FROM counted c LEFT JOIN best USING (word)
), ways AS (
    SELECT word, form AS root FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT ways.word, formed.form FROM ways JOIN formed ON ways.root = formed.word WHERE formed.form IS NOT NULL
), ends AS (
    SELECT ways.word, ways.root FROM ways JOIN formed ON ways.root = formed.word WHERE formed.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)
"""

_TRIE = r"""
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, conv_id - (conv_id % 100 + 100) % 100 AS lender,
        xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
    SELECT ids.conv_id, i, t FROM ids JOIN own ON own.conv_id = lender AND i <= h
    UNION ALL SELECT conv_id, i, t FROM ids JOIN own USING (conv_id) WHERE i > h
), paths AS (
    SELECT conv_id, coalesce(list(t ORDER BY i) FILTER (t IS NOT NULL), []) AS p FROM ids LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), steps AS (
    SELECT conv_id, depth, p[1:depth] AS n, depth = len(p) AS ends FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS depth FROM paths)
), nodes AS (
    SELECT n, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
        (count(*) - 1) * coalesce(length(n[depth].text), 0) AS own_saved
    FROM steps GROUP BY n, depth
), below AS (
    SELECT n[1:depth - 1] AS n, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below USING (n, depth)
), totals AS (
    SELECT n[1:a] AS n, a AS depth, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(own_saved) AS BIGINT) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM counted) GROUP BY ALL
)
SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN totals USING (n, depth) LEFT JOIN nodes up ON up.depth = c.depth - 1 AND up.n = c.n[1:c.depth - 1]
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_langid": op2_langid,
    "op3_html": op3_html,
    "op4_fertility": op4_fertility,
    "op5_jaccard": op5_jaccard,
    "op6_backoff": op6_backoff,
    "op6_trigrams": op6_trigrams,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op9_word_runs": op9_word_runs,
    "op9_passages": op9_passages,
    "op10_decontamination": op10_decontamination,
    "op11_chat": op11_chat,
    "op12_spelling": op12_spelling,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {"op6_backoff": _BACKOFF, "op6_trigrams": _TRIGRAMS, "op7_mixing": _SIZES, "op10_decontamination": _WINDOWS, "op11_chat": _CHAT, "op12_spelling": _SPELLING, "op13_prefix_trie": _TRIE}
