"""Registered queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat_format, fingerprint, html_text, license_scan, mixing, ngram_join, periodic_runs, quality, secret_scan, suffix_dedup, vector_join, whitening
from ledgerloom.llm.tables import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes from each document, and the pass and output shard of each time."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    draws = F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["epoch"], d["shard"])), ",")
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), draws.alias("draws"))


def op3_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by a cosine of 0.95 or more."""
    return vector_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the similarity of their three-word shingles, 90 % or more."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its text edited with the next one's, and how alike they are."""
    edited = fingerprint.with_edited(table(spark, sf_dir, "documents"))
    return edited.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question of every conversation as a tool call, with the answer as its result, and the turns that are neither."""
    conversations = table(spark, sf_dir, "conversations")
    calls, results = chat_format.conversation_calls(conversations)
    # Fixed schemas of the tools that these calls name.
    tools = [("answer", "question", "string", True), ("answer", "turn", "integer", True)]
    tools += [("search", "question", "string", True), ("search", "turn", "integer", True), ("search", "limit", "integer", True)]
    parameters = spark.createDataFrame(tools, "name string, parameter string, type string, required boolean")
    linked = chat_format.link_tool_calls(calls, results, parameters).unionByName(chat_format.other_turns(conversations))
    n_errors = F.size("errors").cast("long")
    return linked.select("conv_id", "call_id", F.col("level").cast("long").alias("level"), "turn", "status", F.when(F.col("errors").isNotNull(), n_errors).alias("n_errors"), F.array_join("errors", ",").alias("errors"), F.sha2("json", 256).alias("json_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, digests and spans of the secrets in every document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in the lines of every document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    confirmed = F.filter("licenses", lambda x: x["confirmed"])
    return found.select(
        "doc_id",
        F.size(confirmed).cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform(confirmed, lambda x: F.concat_ws(":", x["line"], x["family"])), ",").alias("lines"),
        (F.size("licenses") - F.size(confirmed)).cast("long").alias("n_unconfirmed"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of tokens of every document, digests of their ids and of what they decode to."""
    done = bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in about every tenth document, picked by a hash of its id, words repeat with some period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    n, g = F.size("words"), div(F.col("h"), F.lit(10))
    a = g % n
    placed = split.where("size(words) > 0").select("doc_id", "words", n.alias("n"), a.alias("a"), (1 + div(n - a, 3 + g % 8)).alias("p"))

    def source(i: Column) -> Column:
        return F.get("words", F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int"))

    planted = placed.select("doc_id", F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), source), " ").alias("text"))
    return split.where("coalesce(size(words) <= 0, true)").select("doc_id", "text").unionByName(planted)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, after some were planted, and digests of what is left without their repetitions."""
    found = periodic_runs.collapse_runs(with_planted_run(table(spark, sf_dir, "documents").select("doc_id", "text")))

    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # Runs are in order of start and period, and only a greater exponent replaces an earlier one.
    return found.withColumn("best", F.aggregate("runs", nothing, better)).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 400 bytes that occur elsewhere too."""
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), suffix_dedup.MIN_BYTES)
    return left.select(
        "row.doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight whitened components of greatest variance.

    A deviation beyond the range of a long, which takes millions of vectors, is null; the operator has it as a decimal.
    """
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_mixing": op2_mixing,
    "op3_vector_join": op3_vector_join,
    "op4_ngram_join": op4_ngram_join,
    "op5_fingerprint": op5_fingerprint,
    "op6_chat_format": op6_chat_format,
    "op7_secret_scan": op7_secret_scan,
    "op8_license_scan": op8_license_scan,
    "op9_quality": op9_quality,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op3_vector_join": """
        WITH RECURSIVE v AS (
          SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
        reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        component AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN component c ON vec_id = c.a LEFT JOIN counted d ON vec_id = d.a
    """,
    "op4_ngram_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        links AS (
          SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common.n >= 90 * (p.n + q.n - common.n)),
        reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        component AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d JOIN component ON d.doc_id = a LEFT JOIN sizes ON d.doc_id = sizes.doc_id
    """,
    "op6_chat_format": """
        WITH calls AS (
          SELECT conv_id, 'call_' || turn AS call_id, turn, min(text) AS question
          FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
        results AS (
          SELECT conv_id, 'call_' || (turn - 1) AS call_id, turn AS result_turn, min(text) AS content
          FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
        -- A call uses that of two turns before: levels count along unbroken rows of every second turn.
        islands AS (SELECT conv_id, turn, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM calls),
        levels AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS level FROM islands),
        linked AS (
          SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.turn, r.result_turn) AS turn,
            CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
            c.turn AS asked, c.question, r.content, length(c.question) AS n
          FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
        judged AS (
          SELECT *, CASE WHEN asked IS NULL THEN NULL WHEN n <= 60 THEN '' WHEN n % 2 = 1 THEN 'type:limit' WHEN n % 10 = 0 THEN 'missing:limit' ELSE '' END AS errors,
            CASE WHEN n <= 60 OR n % 10 = 0 THEN '' WHEN n % 2 = 1 THEN '"limit":"' || n || '",' ELSE '"limit":' || n || ',' END AS given
          FROM linked)
        SELECT j.conv_id, call_id, coalesce(level, 0) AS level, j.turn, status,
          CAST(CASE WHEN errors = '' THEN 0 WHEN errors IS NOT NULL THEN 1 END AS BIGINT) AS n_errors, errors,
          sha256('{' || CASE WHEN asked IS NOT NULL THEN '"arguments":{' || given || '"question":' || CAST(to_json(question) AS VARCHAR) || ',"turn":' || asked || '},' ELSE '' END
            || '"id":"' || call_id || '"' || CASE WHEN asked IS NOT NULL THEN ',"name":"' || CASE WHEN n > 60 THEN 'search' ELSE 'answer' END || '"' ELSE '' END
            || CASE WHEN content IS NOT NULL THEN ',"result":' || CAST(to_json(content) AS VARCHAR) ELSE '' END || ',"status":"' || status || '"}') AS json_sha256
        FROM judged j LEFT JOIN levels v ON j.conv_id = v.conv_id AND j.asked = v.turn
        UNION ALL
        SELECT conv_id, NULL, 0, turn, 'message', NULL, NULL,
          sha256('{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}')
        FROM conversations WHERE role NOT IN ('user', 'assistant')
    """,
    "op11_periodic_runs": r"""
        WITH split AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CAST(doc_id AS VARCHAR) AS id FROM documents),
        sums AS (
          SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce([4294967295] || range(8 * len(id)), lambda c, i:
            xor(xor(c, CASE WHEN i % 8 = 0 THEN ord(id[i // 8 + 1]) ELSE 0 END) >> 1,
              CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ord(id[i // 8 + 1]) ELSE 0 END) % 2 = 1 THEN 3988292384 ELSE 0 END))) AS h FROM split),
        marks AS (SELECT doc_id, w, n, h, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM sums),
        words AS (
          SELECT doc_id, n, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
          FROM (SELECT *, unnest(range(n)) AS i FROM marks)),
        grams AS (
          SELECT doc_id, n, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS g, lead(word, 3) OVER o IS NOT NULL AS whole
          FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        pairs AS (
          SELECT x.doc_id, x.i, y.i - x.i AS period FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
          WHERE x.whole AND y.whole),
        stretches AS (
          SELECT doc_id, period, min(i) AS start, max(i) - min(i) + 4 + period AS length
          FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs) GROUP BY doc_id, period, island),
        candidates AS (SELECT * FROM stretches WHERE length >= greatest(6, 4 * period)),
        runs AS (
          SELECT * FROM candidates r WHERE NOT EXISTS (
            SELECT 1 FROM candidates s WHERE s.doc_id = r.doc_id AND s.period < r.period AND r.period % s.period = 0 AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
        totals AS (
          SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
            min_by({start: start, length: length, period: period}, (-CAST(length AS DOUBLE) / period, start, period)) AS best
          FROM runs GROUP BY doc_id),
        kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words w
          WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
          1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN totals t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
    "op12_suffix_dedup": """
        WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        strings AS (SELECT doc_id, i, md5(raw[i + 1:i + 400]) AS h FROM (SELECT *, unnest(range(n - 399)) AS i FROM texts)),
        repeated AS (SELECT doc_id, i FROM strings WHERE h IN (SELECT h FROM strings GROUP BY h HAVING count(*) > 1)),
        marked AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS new FROM repeated),
        spans AS (
          SELECT doc_id, min(i) AS start, max(i) + 400 AS stop
          FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked) GROUP BY doc_id, span),
        edges AS (
          SELECT doc_id, stop AS from_byte, lead(start) OVER (PARTITION BY doc_id ORDER BY start) AS to_byte FROM spans
          UNION ALL SELECT doc_id, 0, min(start) FROM spans GROUP BY doc_id),
        parts AS (
          SELECT t.doc_id, string_agg(hex(raw[from_byte + 1:coalesce(to_byte, n)]), '' ORDER BY from_byte) AS kept FROM texts t JOIN edges e ON t.doc_id = e.doc_id GROUP BY t.doc_id),
        totals AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(stop - start) AS BIGINT) AS n_removed FROM spans GROUP BY doc_id)
        SELECT t.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN n_spans IS NULL THEN raw ELSE unhex(kept) END) AS kept_sha256
        FROM texts t LEFT JOIN totals s ON t.doc_id = s.doc_id LEFT JOIN parts p ON t.doc_id = p.doc_id
    """,
}
