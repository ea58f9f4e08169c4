"""The queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, language, lines, packing, periodic_runs, pii, simhash, suffixes, token_counts, token_store, toxicity, vector_file
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace the base spans of personal data, the first of any that overlap."""
    out, end = [], 0
    for kind, a, b in sorted(pii.base_spans(text), key=lambda s: (s[1], -s[2])):
        if a >= end:
            out.append((a, b, f"<{kind}>"))
            end = b
    return out


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after the redaction of personal data."""
    return token_counts.edited_counts(table(spark, sf_dir, "documents"), tokenizer_path(), rule=redactions)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.Detector(corpus=pii.labelled(docs)))
    counts = [f"n_{k}" for k in pii.KINDS]
    n_spans = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ","))).cast("long")
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", n_spans.alias("n_spans"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


_LINE_SETS = """SELECT doc_id, i, list_sort(list_distinct(list_filter(regexp_split_to_array(translate(lines[i + 1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D\\x20]+'), lambda x: x <> ''))) AS w
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"""
OP4_SQL = f"""
WITH s AS MATERIALIZED (SELECT doc_id, i, w, len(w) AS n FROM ({_LINE_SETS}) WHERE len(w) > 0),
c AS MATERIALIZED (SELECT w, n, min({{'d': doc_id, 'i': i}}) AS f, row_number() OVER () AS id FROM s GROUP BY w, n),
t AS MATERIALIZED (SELECT id, n, f, unnest(w) AS x FROM c),
o AS (SELECT a.id, a.n, b.n AS m, count(*) AS k FROM t a JOIN t b ON a.x = b.x AND b.f < a.f AND 4 * a.n <= 5 * b.n AND 4 * b.n <= 5 * a.n GROUP BY a.id, b.id, a.n, b.n),
near AS (SELECT DISTINCT id FROM o WHERE 5 * k >= 4 * (n + m - k)),
gone AS (SELECT s.doc_id, s.i FROM s JOIN c USING (w) WHERE c.f <> {{'d': s.doc_id, 'i': s.i}} OR c.id IN (SELECT id FROM near)),
l AS (SELECT doc_id, lines[i + 1] AS line, i FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))
SELECT l.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(gone.i) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN gone.i IS NULL THEN line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.top_k(vector_file.build(table(spark, sf_dir, "embeddings")), k=20, every=20)


OP6_SQL = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT * FROM ok WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id AS query_id, ok.vec_id, CAST(list_sum(list_transform(list_zip(q.v, ok.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q JOIN ok ON ok.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items, digest = F.size("items").cast("long"), F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return marked.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), "contaminated")


_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
OP8_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, n, w[s:s + n - 1] AS g FROM (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
spans AS (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM pos, (SELECT DISTINCT n FROM wins) l),
hit AS (SELECT doc_id, i, n, item_id FROM spans JOIN wins USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
WITH d AS MATERIALIZED (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r, list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
o AS (SELECT lang, source, r, unnest(w) AS term FROM d),
v AS MATERIALIZED (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN v USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
vn AS (SELECT lang, count(*) AS v FROM v GROUP BY lang),
gn AS (SELECT lang, source, sum(n) AS t FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // CAST(coalesce(t, 0) + 2 * vn.v AS HUGEINT) AS BIGINT) AS p
  FROM g JOIN v USING (lang) JOIN vn USING (lang) LEFT JOIN gn ON g.lang = gn.lang AND g.source = gn.source LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND v.term = c.term),
s AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
sn AS (SELECT lang, sum(n) AS t FROM s GROUP BY lang),
q AS (SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // CAST(t + 2 * v AS HUGEINT) AS BIGINT) AS q FROM s JOIN sn USING (lang) JOIN vn USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def planted_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where one document in ten becomes periodic, and its period."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), least=6, exponent=4, tail=planted_tail)
    line = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"), best.period.alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        digest(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


OP12_SQL = """
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: list_transform(range(0, 8), lambda b: (ascii(s) >> b) & 1)))),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) AS h FROM documents),
a AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS f FROM d),
t AS MATERIALIZED (SELECT doc_id, r, n, CASE WHEN f IS NULL THEN w ELSE list_transform(range(0, n), lambda i: CASE WHEN i < f THEN w[i + 1] ELSE w[f + (i - f) % (1 + (n - f) // (3 + (h // 10) % 8)) + 1] END) END AS w FROM a),
p AS MATERIALIZED (SELECT r, n, unnest(w) AS x, unnest(range(0, n)) AS i FROM t WHERE n >= 6),
e AS (SELECT a.r, b.i - a.i AS q, a.i FROM p a JOIN p b ON a.r = b.r AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e) GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM s GROUP BY ALL),
best AS (SELECT * FROM (SELECT r, b.start, b.length, b.period FROM runs b) QUALIFY row_number() OVER (PARTITION BY r ORDER BY length * 1e0 / period DESC, start, period) = 1),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
l AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS l FROM (SELECT r, unnest(w) AS x, unnest(range(0, n)) AS i FROM t) p ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(l.l, '')) AS runs_sha256, sha256(coalesce(kept.l, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN l USING (r) LEFT JOIN kept USING (r)
"""


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}
ORACLE_SQL: dict[str, str] = {"op4_line_dedup": OP4_SQL, "op6_exact_top_k": OP6_SQL, "op8_decontamination": OP8_SQL, "op11_source_divergence": OP11_SQL, "op12_periodic_runs": OP12_SQL}
