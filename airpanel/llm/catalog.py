"""Registered queries of the numbered operators, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.llm.exact import exact_groups
from airpanel.llm import language
from airpanel.llm.merkle import digest, fold, leaf, manifest, proof_text
from airpanel.llm.mixing import mixed
from airpanel.llm.near import near_duplicates
from airpanel.llm.periodic import periodic_runs, run_lines, strongest
from airpanel.llm.pieces import encoding_report
from airpanel.llm.quality import RULES, STOP_WORDS, quality
from airpanel.llm.secrets import secrets
from airpanel.llm.topk import quantised, top_k
from airpanel.llm.toolcalls import ANSWER, from_conversations, linked
from airpanel.llm.toxicity import toxicity
from airpanel.llm.warc import archive_folder, read_warc, write_warc
from airpanel.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def _query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_exact_dedup", rf"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
""")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, found by chunk recipes."""
    return exact_groups(_table(spark, sf_dir, "documents"))


@_query("op5_mix_sources", rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY 1),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS words, sum(w) OVER () AS weights,
             coalesce(sum(source_size * 2.0::DOUBLE) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before FROM s
      WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (words - cap_before) * w >= (weights - w_before) * cap AS is_full FROM r),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
             w * (words - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / (sum(w) FILTER (NOT is_full) OVER ()) END::DOUBLE AS target,
             ('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN 'n' ELSE 's' END || coalesce(source, '')), 1, 8))::BIGINT
               / 4294967296.0::DOUBLE AS u FROM f),
n AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size,
               ('0x' || substr(md5('c' || coalesce(d.doc_id::VARCHAR, '')), 1, 2))::BIGINT, d.doc_id) AS i
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(i * rate + u) - floor((i - 1) * rate + u)))::BIGINT AS taken FROM n
""")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document adds to the mix of its source."""
    taken = F.col("size") * F.col("copies")
    return mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_RATIO = {
    "words": "n_words::DOUBLE",
    "chars_per_word": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END",
    "symbols_per_word": "CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END",
    "stop_words_per_word": "CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END",
    "repeated_lines": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END",
    "repeated_words": "CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END",
}
_WITHIN = " AND ".join(f"({_RATIO[n]} BETWEEN {a} AND {'1e300' if b == float('inf') else b})" for n, a, b in RULES)


@_query("op8_quality_rules", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
w AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM a),
v AS (SELECT rid, i, w, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
c AS (SELECT rid, i FROM v WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w, w2, w3) > 1),
k AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) x(o) GROUP BY 1),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
             coalesce(n_repeat_words, 0) AS n_repeat_words FROM a LEFT JOIN k USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_WITHIN} AS kept FROM m
""")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality(_table(spark, sf_dir, "documents"))


@_query("op4_secret_scan")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets(_table(spark, sf_dir, "documents"))


@_query("op10_warc", """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
""")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    manifest = write_warc(_table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op3_near_dedup")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: three-word shingles, similarity of 0.85 or more."""
    return near_duplicates(_table(spark, sf_dir, "documents"), words=3, num=85, den=100)


@_query("op6_toxicity")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; the model is fitted on labels outside fold 0."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op9_sentencepiece")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return encoding_report(_table(spark, sf_dir, "documents"))


@_query("op2_language_id")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page and of every document."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    rows = language.from_pages(pages).unionByName(language.from_documents(docs))
    languages = language.languages_of(docs)
    return language.identify(rows, language.fit(docs, languages), languages)


@_query("op7_chat_format", rf"""
WITH asked AS (SELECT c.*, (SELECT max(u.turn) FROM conversations u
    WHERE u.conv_id = c.conv_id AND u.role = 'user' AND u.turn < c.turn) AS asked FROM conversations c),
answers AS (SELECT conv_id, asked, min(turn) AS turn FROM asked WHERE role = 'assistant' AND asked IS NOT NULL GROUP BY 1, 2),
worded AS (SELECT *, 'call_' || CAST(turn AS VARCHAR) AS call_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words
  FROM asked WHERE role = 'user'),
written AS (SELECT *, CASE WHEN text IS NULL THEN to_json({{words: words}}) ELSE to_json({{question: text, words: words}}) END AS arguments FROM worded),
calls AS (SELECT w.*, a.turn AS partner_turn, row_number() OVER (PARTITION BY w.conv_id, w.call_id ORDER BY left(md5(concat_ws(':', role, w.turn, text)), 16)) AS nth,
    CAST(2 * (SELECT count(*) FROM answers b WHERE b.conv_id = w.conv_id AND b.turn <= w.turn) AS INTEGER) AS level
  FROM written w LEFT JOIN answers a ON a.conv_id = w.conv_id AND a.asked = w.turn),
results AS (SELECT a.*, row_number() OVER (PARTITION BY conv_id, asked ORDER BY turn, left(md5(concat_ws(':', role, turn, text)), 16)) AS nth,
    'call_' || CAST(asked AS VARCHAR) AS call_id,
    CAST(2 * (SELECT count(*) FROM answers b WHERE b.conv_id = a.conv_id AND b.turn <= a.asked) + 1 AS INTEGER) AS level
  FROM asked a WHERE role = 'assistant')
SELECT conv_id, turn, 'call' AS kind, call_id,
  CASE WHEN conv_id IS NULL OR turn IS NULL THEN 'open' WHEN nth > 1 THEN 'repeated' WHEN partner_turn IS NOT NULL THEN 'linked' ELSE 'open' END AS status,
  CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN level END AS level, turn AS order_turn, partner_turn,
  CASE WHEN text IS NULL THEN '$.question: missing; $.words: below minimum' WHEN text = '' THEN '$.question: too short; $.words: below minimum'
    WHEN words = 0 THEN '$.words: below minimum' END AS reason,
  CAST(to_json({{role: 'assistant', tool_calls: [{{function: {{arguments: arguments, name: 'answer'}}, id: call_id, type: 'function'}}]}}) AS VARCHAR) AS json
FROM calls
UNION ALL SELECT conv_id, turn, 'result', call_id, CASE WHEN asked IS NULL THEN 'orphan' WHEN nth > 1 THEN 'repeated' ELSE 'linked' END,
  CASE WHEN asked IS NOT NULL THEN level END, turn, asked, NULL, CAST(to_json({{content: text, role: 'tool', tool_call_id: call_id}}) AS VARCHAR) FROM results
UNION ALL SELECT conv_id, turn, 'message', NULL, 'plain', 0, turn, NULL, NULL, CAST(to_json({{content: text, role: role}}) AS VARCHAR)
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
""")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as canonical JSON; a user's turn is a call that the next assistant turn answers, on top of the answers before it."""
    return linked(*from_conversations(_table(spark, sf_dir, "conversations")), ANSWER)


def _crc(name: str) -> Column:
    """Unsigned crc32 of a decimal number; null for null."""
    return F.crc32(F.col(name).cast("string").cast("binary"))


def _repeating(name: str) -> Column:
    """The text of the rows, where a tenth of them repeat some of their words up to their end."""
    words = F.filter(F.split(F.col("text"), SPACE), lambda w: w != "")
    n, h = F.size(words), _crc(name)
    g = F.expr(f"crc32(CAST(CAST({name} AS STRING) AS BINARY)) div 10")
    a = (g % n).cast("int")
    period = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, period), F.ceil((n - a) / period).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & F.col("text").rlike(WORD), made).otherwise(F.col("text"))


@_query("op11_periodic_runs")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    found = periodic_runs(_table(spark, sf_dir, "documents"), _repeating("doc_id"))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(run_lines(F.col("runs"))).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"), "n_words")


@_query("op12_topk_search", """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score, c.rid AS cid
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, cid) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    rows = quantised(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    best = top_k(rows, F.col("id") % 50 == 0, k=5)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", f"({n_chars})", "text")) + ")"


# crc32 bit by bit: each byte is followed by eight shifts.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""


@_query("op13_merkle_manifest", f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_leaf_sql()} AS leaf,
         CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} END AS changed FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM d),
low AS (SELECT tree, 0 AS lvl, idx, n, leaf AS h FROM o UNION ALL
        SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM low
        WHERE n > 1 GROUP BY tree, lvl, n, idx // 2),
top AS (SELECT 0 AS lvl, tree AS idx, (SELECT count(*) FROM low WHERE n = 1) AS n, h FROM low WHERE n = 1 UNION ALL
        SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM top
        WHERE n > 1 GROUP BY lvl, n, idx // 2),
steps AS (SELECT o.rid, s.lvl, s.h, s.idx % 2 AS slot FROM o JOIN low s
            ON s.tree = o.tree AND s.n > 1 AND s.idx = xor(o.idx >> s.lvl, 1) UNION ALL
          SELECT o.rid, 1000 + s.lvl, s.h, s.idx % 2 FROM o JOIN top s ON s.n > 1 AND s.idx = xor(o.tree >> s.lvl, 1)),
paths AS (SELECT rid, string_agg(h, '' ORDER BY lvl) AS proof, list(h ORDER BY lvl) AS hs, list(slot ORDER BY lvl) AS slots,
                 list(lvl ORDER BY lvl) AS lvls FROM steps GROUP BY rid),
every AS (SELECT tree, lvl, 0 AS up FROM low WHERE n > 1 AND idx = 0 UNION ALL
          SELECT t.tree, 1000 + s.lvl, 1 FROM (SELECT DISTINCT tree FROM o) t, top s WHERE s.n > 1 AND s.idx = 0),
heights AS (SELECT tree, list(lvl ORDER BY lvl) AS all_lvls FROM every GROUP BY tree),
f AS (SELECT o.*, p.proof, low.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
             list_reduce(list_prepend(coalesce(o.changed, o.leaf), list_transform(coalesce(t.all_lvls, []), lambda l:
               CASE WHEN list_position(p.lvls, l) IS NULL THEN '-'
                    ELSE (CASE p.slots[list_position(p.lvls, l)] WHEN 0 THEN '<' ELSE '>' END) || p.hs[list_position(p.lvls, l)] END)),
               lambda a, x: sha256(CASE x[1] WHEN '-' THEN a WHEN '<' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
      FROM o LEFT JOIN paths p USING (rid) LEFT JOIN heights t USING (tree) JOIN low ON low.tree = o.tree AND low.n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
""")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents, and what a changed length does to it."""
    fields = lambda n_chars: [F.col(c) for c in ("doc_id", "source", "lang")] + [n_chars, F.col("text")]
    changed = F.when(_crc("doc_id") % 7 == 0, leaf(fields(F.col("n_chars") + 1)))
    made = manifest(_table(spark, sf_dir, "documents"), fields(F.col("n_chars")), "lang", "doc_id", also={"changed": changed})
    folded = made.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", digest(proof_text(F.col("path"))).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
