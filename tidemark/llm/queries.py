"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_digest
from tidemark.llm.collocations import collocations
from tidemark.llm.common import in_fold, table
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.html import extract_text
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.lm import lm_scores
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.pii import pii_digest
from tidemark.llm.quality import quality_filter
from tidemark.llm.simhash import hex_fingerprint, simhash_components
from tidemark.llm.substring import substring_dedup
from tidemark.llm.topk import exact_top_k
from tidemark.llm.toxicity import toxicity_scores, train

#: Rank file of the encoding query, by its name among the public tokenizers.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the items: one row for each pair."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.round(F.max("matched"), 6).alias("matched"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the fold held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~in_fold(F.col("doc_id"), 4, 2)))
    return toxicity_scores(docs, model).select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    return pii_digest(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate of its source."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document, cutoffs from all labels by language."""
    found = quality_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy scores of every document."""
    found = lm_scores(table(spark, sf_dir, "documents"), ~in_fold(F.col("doc_id"), 10, 0))
    return found.select("doc_id", in_fold(F.col("doc_id"), 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every document through the byte-level vocabulary."""
    return bpe_digest(table(spark, sf_dir, "documents"), RANKS)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of 50 words."""
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector with all others."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of highest score of each language."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op7_language_model": op7_language_model,
    "op8_bpe": op8_bpe,
    "op9_html": op9_html,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_top_k": op11_top_k,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_decontamination": r"""
WITH masks(m, a, b, c, d, e, f, g) AS (VALUES (0, 0, 1, 3, 4, 6, 8, 9), (1, 0, 1, 2, 5, 7, 8, 9), (2, 0, 2, 3, 4, 6, 7, 9)),
docs AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x != '') AS w FROM documents),
items AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x != '') AS w FROM benchmark),
ipos AS (SELECT item_id, w, unnest(range(0, len(w) - 9)) AS j FROM items WHERE len(w) >= 10),
iseed AS (SELECT item_id, w, j, m, w[j+a+1] || ' ' || w[j+b+1] || ' ' || w[j+c+1] || ' ' || w[j+d+1] || ' ' || w[j+e+1] || ' ' || w[j+f+1] || ' ' || w[j+g+1] AS seed
          FROM ipos, masks),
dpos AS (SELECT doc_id, w, unnest(range(0, len(w) - 9)) AS i FROM docs WHERE len(w) >= 10),
near AS (SELECT doc_id, w, i FROM dpos WHERE w[i+1] || ' ' || w[i+10] IN (SELECT w[j+1] || ' ' || w[j+10] FROM ipos)),
dseed AS (SELECT doc_id, w, i, m, w[i+a+1] || ' ' || w[i+b+1] || ' ' || w[i+c+1] || ' ' || w[i+d+1] || ' ' || w[i+e+1] || ' ' || w[i+f+1] || ' ' || w[i+g+1] AS seed FROM near, masks),
hits AS (SELECT DISTINCT doc_id, item_id, i - j AS o, j, len(t.w) AS n FROM dseed d JOIN iseed t USING (m, seed)),
regions AS (SELECT DISTINCT doc_id, item_id, o, least(n, 30) AS width, unnest(range(greatest(0, j - 20), greatest(0, least(j, n - 30)) + 1)) AS s FROM hits),
scored AS (SELECT r.doc_id, r.item_id, len(list_filter(range(s, s + width), lambda k: o + k >= 0 AND coalesce(d.w[o + k + 1] = t.w[k + 1], false)))::DOUBLE / width AS matched
           FROM regions r JOIN docs d USING (doc_id) JOIN items t USING (item_id))
SELECT doc_id, item_id, round(max(matched), 6) AS matched FROM scored WHERE matched >= 0.8 GROUP BY doc_id, item_id
""",
    "op4_line_dedup": r"""
WITH lines AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
seen AS (SELECT source, unnest(list_distinct(list_filter(list_transform(l, lambda x: trim(x)), lambda x: x != ''))) AS line FROM lines),
flagged AS (SELECT source, line FROM (SELECT source, line, count(*) AS n FROM seen GROUP BY source, line) JOIN totals USING (source) WHERE n >= 5 AND n > pages * 0.05::DOUBLE),
dropped AS (SELECT source, list(line) AS gone FROM flagged GROUP BY source),
kept AS (SELECT doc_id, l, list_filter(l, lambda x: NOT coalesce(list_contains(gone, trim(x)), false)) AS k FROM lines LEFT JOIN dropped USING (source))
SELECT doc_id, array_to_string(k, chr(10)) AS text, len(l)::BIGINT AS n_lines, (len(l) - len(k))::BIGINT AS n_removed FROM kept
""",
    "op10_substring_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM docs WHERE len(w) >= 50),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i+1:i+50], ' ')) AS h FROM places),
firsts AS (SELECT h, min(doc_id) AS first FROM wins GROUP BY h),
starts AS (SELECT doc_id, list(i) AS s FROM wins JOIN firsts USING (h) WHERE first < doc_id GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list_transform(s, lambda x: range(x, x + 50)))) AS g FROM starts),
gone_at AS (SELECT doc_id, unnest(g) AS i FROM gone),
word_at AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM docs),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM word_at ANTI JOIN gone_at USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs d LEFT JOIN left_over USING (doc_id)
""",
    "op11_top_k": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows AS (SELECT vec_id, min(v) AS v FROM v GROUP BY vec_id),
scored AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score FROM rows q JOIN rows r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op12_collocations": r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS parts FROM documents),
pieces AS (SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(parts) AS part FROM docs)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
phrases AS (SELECT lang, w[i:i+m-1] AS p, count(*) AS f FROM places, (VALUES (1), (2), (3), (4), (5)) AS lengths(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
inner_parts AS (SELECT lang, f, p, unnest(range(2, len(p))) AS m FROM phrases WHERE len(p) > 2),
inside AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest(list_transform(range(1, len(p) - m + 2), lambda i: p[i:i+m-1])) AS part FROM inner_parts) GROUP BY lang, part),
alone AS (SELECT c.lang, c.p, c.f AS a FROM phrases c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.part WHERE len(c.p) > 1 AND (i.f IS NULL OR 100 * i.f < 100 * c.f)),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM alone),
scored AS (SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
           FROM cuts c JOIN totals t ON c.lang = t.lang JOIN phrases x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN phrases y ON y.lang = c.lang AND y.p = c.p[k+1:]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scored),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""",
    "op13_hard_negatives": r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
firsts AS (SELECT vec_id, min({'v': v, 'label': label}) AS r FROM v GROUP BY vec_id),
rows AS (SELECT vec_id, r.v AS v, r.label AS label FROM firsts),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same),
near AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
         FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND p.place <= 5 AND NOT s.same AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM near WHERE rank <= 3
""",
}
