"""Registered queries of the operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (bagminhash, decontaminate, filter_audit, license_diagonals, line_dedup, mixing, quality_ranker,
               quality_rules, records, shared_terms, site_style_tree, toxicity, warc)
from .common import FUNCTION_WORDS, held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op8_binary_records")
def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a framed record of token ids, read back from the files."""
    return records.encode_documents(spark, read_table(spark, sf_dir, "documents"),
                                    tokenizer_path(), end_id=2)


@query("op9_bradley_terry")
def op9_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by pairwise ranking."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_ranker.fit(docs, read_table(spark, sf_dir, "labels"))
    score = F.col("score")
    return (quality_ranker.rank(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score,
                    (score >= quality_ranker.DECISION).cast("int").alias("predicted")))


def _sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _op1_sql() -> str:
    q = quality_rules
    rest, classes = "t", []
    for pattern in q.CLASSES.values():
        pattern = pattern.replace("'", "''")
        left = f"regexp_replace({rest}, '{pattern}', '', 'g')"
        classes.append(f"length({rest}) - length({left})")
        rest = left
    classes.append(f"length({rest})")
    class_columns = ", ".join(f"{c} AS c{i}" for i, c in enumerate(classes))
    class_rows = " UNION ALL ".join(f"SELECT doc_id, {i} AS i, c{i} AS c FROM base" for i in range(len(classes)))
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
      FROM d),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM a),
win AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM
        (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2) AS n FROM win WHERE w2 IS NOT NULL)
        WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
base AS (SELECT a.doc_id, lang, len(ws)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                coalesce(cover.n, 0)::BIGINT AS n_repeat_words, length(t) AS n_chars, {class_columns}
         FROM a LEFT JOIN cover ON a.doc_id = cover.doc_id),
b AS (SELECT *, n_words < {q.MIN_BASE_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
      FROM base),
cls AS ({class_rows}),
com AS (SELECT doc_id, lower(w) AS i, count(*) AS c FROM w
        WHERE w IN {_sql_list(q._COMMON_CASED)} GROUP BY 1, 2),
good AS (SELECT * FROM b WHERE NOT base_failed AND lang IN {_sql_list(FUNCTION_WORDS)}),
tot AS (SELECT lang, sum(n_words) AS n, sum(n_chars) AS m FROM good GROUP BY lang),
refc AS (SELECT g.lang, i, sum(c) / any_value(m) AS q FROM good g JOIN cls USING (doc_id) JOIN tot ON g.lang = tot.lang GROUP BY g.lang, i),
jc AS (SELECT b.doc_id, r.lang, sqrt(greatest(sum(
          CASE WHEN c > 0 THEN c / n_chars * log2(2 * (c / n_chars) / (c / n_chars + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (c / n_chars + q)) ELSE 0 END) / 2, 0)) AS js
       FROM b JOIN cls USING (doc_id) JOIN refc r USING (i) WHERE n_chars >= {q.MIN_CHARS} GROUP BY 1, 2),
words_in AS (SELECT unnest({list(q.COMMON)}) AS i),
refw1 AS (SELECT tot.lang, v.i, coalesce(sum(c), 0) / any_value(tot.n) AS q
          FROM tot CROSS JOIN words_in v
          LEFT JOIN (SELECT lang, i, c FROM good JOIN com USING (doc_id)) x ON x.lang = tot.lang AND x.i = v.i
          GROUP BY tot.lang, v.i),
doc_words AS (SELECT doc_id, n_words, i, c FROM b JOIN com USING (doc_id) WHERE n_words >= {q.MIN_WORDS}),
sums AS (SELECT b.doc_id, l.lang, any_value(b.n_words) AS n,
                coalesce(sum(c / x.n_words * log2(2 * (c / x.n_words) / (c / x.n_words + q))
                  + CASE WHEN q > 0 THEN q * log2(2 * q / (c / x.n_words + q)) ELSE 0 END), 0) AS d,
                coalesce(sum(q), 0) AS seen, coalesce(sum(c), 0) AS c
         FROM (SELECT doc_id, n_words FROM b WHERE n_words >= {q.MIN_WORDS}) b
         CROSS JOIN (SELECT lang FROM tot) l
         LEFT JOIN doc_words x ON x.doc_id = b.doc_id
         LEFT JOIN refw1 r ON r.lang = l.lang AND r.i = x.i
         GROUP BY b.doc_id, l.lang),
shares AS (SELECT lang, sum(q) AS q FROM refw1 GROUP BY lang),
jw AS (SELECT doc_id, s.lang, sqrt(greatest((d + h.q - seen
          + CASE WHEN n > c THEN (n - c) / n * log2(2 * ((n - c) / n) / ((n - c) / n + 1 - h.q)) ELSE 0 END
          + CASE WHEN h.q < 1 THEN (1 - h.q) * log2(2 * (1 - h.q) / ((n - c) / n + 1 - h.q)) ELSE 0 END) / 2, 0)) AS js
       FROM sums s JOIN shares h ON s.lang = h.lang),
mc AS (SELECT doc_id, min(js) AS js FROM jc GROUP BY doc_id),
mw AS (SELECT doc_id, min(js) AS js FROM jw GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(mc.js, 0) <= {q.MAX_JS_CHARS} AND coalesce(mw.js, 0) <= {q.MAX_JS_WORDS} AS kept,
       round(mc.js, 6) AS js_chars, round(mw.js, 6) AS js_words
FROM b LEFT JOIN mc ON b.doc_id = mc.doc_id LEFT JOIN mw ON b.doc_id = mw.doc_id
"""


@query("op1_divergence_rules", _op1_sql())
def op1_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, and distance from the language references, of every document."""
    return (quality_rules.apply(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept",
                    F.round("js_chars", 6).alias("js_chars"), F.round("js_words", 6).alias("js_words")))


@query("op10_warc_salvage", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(x, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM s
""")
def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, and the archives read back by the salvage reader."""
    return (warc.round_trip(spark, read_table(spark, sf_dir, "pages"))
            .where(F.col("gap").isNull())
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op7_poisson_mix", f"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n, power(count(*)::DOUBLE, {mixing.ALPHA}) AS target
                     FROM documents GROUP BY source),
rates AS (SELECT source, target * (SELECT sum(n)::DOUBLE FROM s) / (n * (SELECT sum(target) FROM s)) AS rate FROM s),
d AS (SELECT d.*, rate, ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT
          / 4503599627370496.0 AS u
      FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
cdf AS (SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS cdf FROM rates
        UNION ALL
        SELECT source, rate, k + 1, term * rate / (k + 1), cdf + term * rate / (k + 1) FROM cdf
        WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
copies AS (SELECT d.*, c.k AS copy FROM d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND d.u >= c.cdf)
SELECT doc_id, text, lang, source, n_chars, copy, round(rate, 9) AS rate,
       ('0x' || substr(md5('{mixing.SEED + 1}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || copy::VARCHAR), 1, 13))::BIGINT
          / 4503599627370496.0 AS mix_key
FROM copies
""")
def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights, in global random order."""
    return (mixing.mix(read_table(spark, sf_dir, "documents"))
            .withColumn("rate", F.round("rate", 9)))


@query("op3_template_decontamination")
def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents and the benchmark items they hold."""
    return (decontaminate.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
            .drop("text_hash"))


@query("op2_counterfactual_toxicity")
def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    score = F.col("score")
    return (toxicity.score(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score,
                    (score >= 0.5).cast("int").alias("predicted")))


@query("op6_site_style_tree")
def op6_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return (site_style_tree.extract(read_table(spark, sf_dir, "pages"))
            .select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")))


@query("op4_bagminhash_dedup")
def op4_bagminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (bagminhash.classes(docs)
            .select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept")))


@query("op5_line_runs", f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS k FROM d),
w AS (SELECT doc_id, x, k, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n FROM l
      WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')),
s AS (SELECT doc_id, list(x ORDER BY k) AS xs, list(k ORDER BY k) AS ks, list(n ORDER BY k) AS ns FROM w GROUP BY doc_id),
p AS (SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM s),
t AS (SELECT *, list_filter(range(1, least({line_dedup.MIN_WORDS}, len(ks) - i + 1) + 1),
                            lambda m: list_sum(ns[i:i + m - 1]) >= {line_dedup.MIN_WORDS})[1] AS t FROM p),
b AS (SELECT doc_id, i, xs[i:i + t - 1] AS block, ks[i:i + t - 1] AS lines FROM t WHERE t IS NOT NULL),
later AS (SELECT doc_id, lines FROM
          (SELECT *, row_number() OVER (PARTITION BY block ORDER BY doc_id, i) AS r FROM b) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(lines) AS k FROM later),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
left_over AS (SELECT l.doc_id, string_agg(x, chr(10) ORDER BY l.k) AS text
              FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.k = gone.k WHERE gone.k IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(left_over.text, '') END AS text,
       coalesce(g.n, 0) AS n_deleted
FROM d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN left_over ON d.doc_id = left_over.doc_id
""")
def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line runs that occur earlier."""
    return (line_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "text", F.aggregate("deleted", F.lit(0).cast("bigint"), lambda n, r: n + r["lines"])
                    .alias("n_deleted")))


_ALNUM = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op11_sql() -> str:
    m = license_diagonals
    templates = ", ".join("(" + f"{i}, '{label}', '" + text.replace("'", "''") + "')"
                          for i, (label, text) in enumerate(m.TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in m.PHRASES.items())
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS ws FROM documents),
t AS (SELECT id, label, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS ws FROM (VALUES {templates}) v(id, label, text)),
tg AS (SELECT id, label, len(ws) AS size, unnest(range(len(ws) - {m.K - 1})) AS j, ws FROM t),
tk AS (SELECT id, label, size, j, array_to_string(ws[j + 1:j + {m.K}], ' ') AS g FROM tg),
dg AS (SELECT doc_id, ws, unnest(range(len(ws) - {m.K - 1})) AS i FROM d WHERE len(ws) >= {m.K}),
dk AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + {m.K}], ' ') AS g FROM dg),
v AS (SELECT doc_id, id, label, size, i, j, i - j AS diagonal FROM dk JOIN tk USING (g)),
o AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, id ORDER BY diagonal) <= {m.BAND}
                     THEN 0 ELSE 1 END AS new FROM (SELECT DISTINCT doc_id, id, diagonal FROM v)),
band AS (SELECT doc_id, id, diagonal, sum(new) OVER (PARTITION BY doc_id, id ORDER BY diagonal) AS band FROM o),
p AS (SELECT v.*, band, unnest(range({m.K})) AS k FROM v JOIN band USING (doc_id, id, diagonal)),
s AS (SELECT doc_id, id, label, count(DISTINCT j + k) / any_value(size) AS cover,
             count(DISTINCT i + k) / (max(i + k) - min(i + k) + 1) AS density
      FROM p GROUP BY doc_id, id, label, band),
ok AS (SELECT doc_id, list(DISTINCT label) AS labels, max(cover) AS score FROM s
       WHERE cover >= {m.MIN_COVER} AND density >= {m.MIN_DENSITY} GROUP BY doc_id),
w AS (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM d),
b AS (SELECT doc_id, i, label FROM w, (VALUES {phrases}) f(phrase, label)
      WHERE array_to_string(ws[i + 1:i + len(string_split(phrase, ' '))], ' ') = phrase),
bs AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM b GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(bs.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word,
       hi::BIGINT AS last_word, coalesce(array_to_string(list_sort(bs.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(ok.labels, [])))),
                                ','), '') AS labels,
       coalesce(round(score, 9), 0)::DOUBLE AS score
FROM d LEFT JOIN bs ON d.doc_id = bs.doc_id LEFT JOIN ok ON d.doc_id = ok.doc_id
"""


@query("op11_diagonal_voting", _op11_sql())
def op11_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (license_diagonals.scan(docs)
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                    F.round("score", 9).alias("score")))


@query("op12_filter_orders", """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
f AS (SELECT doc_id, part,
        CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END
      + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
      + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
      + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
walk AS (SELECT '' AS prefix, 0 AS applied, 0 AS bit, 0 AS step
         UNION ALL
         SELECT prefix || letter, walk.applied | letters.bit, letters.bit, step + 1
         FROM walk JOIN letters ON walk.applied & letters.bit = 0),
m AS (SELECT part, prefix, step, bit,
        sum(n) FILTER (mask & applied = 0) AS kept,
        sum(n) FILTER (mask & bit > 0 AND mask & (applied - bit) = 0) AS removed,
        sum(n) FILTER (mask & bit > 0 AND mask & (applied - bit) > 0) AS redundant,
        sum(n) FILTER (mask = bit) AS unique_fails,
        sum(good) FILTER (mask & bit > 0 AND mask & (applied - bit) = 0) AS good_lost,
        sum(toxic) FILTER (mask & bit > 0 AND mask & (applied - bit) = 0) AS toxic_lost
      FROM c JOIN walk ON step > 0 GROUP BY part, prefix, step, bit),
o AS (SELECT m.*, w.prefix AS filter_order FROM m JOIN walk w ON w.step = 5 AND starts_with(w.prefix, m.prefix))
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM o
""")
def op12_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters under all 120 orders, per source."""
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op13_shared_terms", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{shared_terms.TERM}') AS ws FROM documents),
s AS (SELECT count(*) AS big_n, sum(len(ws))::BIGINT AS big_l FROM d WHERE len(ws) > 0),
i AS (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{shared_terms.TERM}')) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf
       FROM (SELECT doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
df AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, big_n),
c AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) AS score
      FROM tf JOIN df USING (term), s),
r AS (SELECT item_id, doc_id, sum(score)::BIGINT AS score FROM i JOIN c USING (term) GROUP BY item_id, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
""")
def op13_shared_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return (shared_terms.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
            .select("item_id", "rank", "doc_id", "score"))
