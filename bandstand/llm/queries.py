"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from bandstand.llm.bpe import token_digests
from bandstand.llm.collocations import PhraseRules, collocations
from bandstand.llm.html_text import BlockRules, extract_pages
from bandstand.llm.language import LanguageRules, held_out, predict_languages, train_language_model
from bandstand.llm.line_dedup import LineRules, drop_frequent_lines
from bandstand.llm.mixing import Mix, mix_plan
from bandstand.llm.near_text import NearText, near_text_components
from bandstand.llm.near_vectors import Forest, near_vector_components
from bandstand.llm.order_minhash import OrderMinHash, fingerprints
from bandstand.llm.private_data import KINDS, count_of, private_spans, span_text
from bandstand.llm.registry import ORACLE, QUERIES, query, table  # noqa: F401
from bandstand.llm.token_counts import over_limit, token_counts
from bandstand.llm.vantage import VantageSearch, nearest_vectors
from bandstand.llm.variants import VariantRules, damaged_words, variant_groups


@query("op1_block_rules")
def op1_block_rules(spark, d):
    return extract_pages(table(spark, d, "pages"), "page_id", "url", "html", BlockRules())


@query("op2_pivotal_mix")
def op2_pivotal_mix(spark, d):
    plan = mix_plan(table(spark, d, "documents"), "doc_id", "text", "source", Mix(weights=(1, 2, 3), most=3, share=1.0))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_chosen_path_join")
def op3_chosen_path_join(spark, d):
    return near_text_components(table(spark, d, "documents"), "doc_id", "text", NearText(words=3, percent=85))


@query("op4_token_counts")
def op4_token_counts(spark, d):
    counted = token_counts(table(spark, d, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", over_limit(512))


@query("op5_order_minhash")
def op5_order_minhash(spark, d):
    return fingerprints(table(spark, d, "documents"), "doc_id", "text", OrderMinHash())


@query("op6_output_codes")
def op6_output_codes(spark, d):
    docs = table(spark, d, "documents")
    model = train_language_model(docs, "doc_id", "text", "lang", LanguageRules())
    found = predict_languages(docs, "doc_id", "text", model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op7_private_data")
def op7_private_data(spark, d):
    found = private_spans(table(spark, d, "documents"), "doc_id", "text")
    secret = F.transform("added", lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("place"), x["end"].alias("end")))
    return found.select(
        "doc_id",
        *[count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", secret))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        (F.size("base") + F.size("added") > 0).alias("private"),
    )


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
), usable AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (SELECT a, min(b) AS least FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
  vec_id <= coalesce(least, vec_id) AS kept
FROM v LEFT JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query("op8_projection_forest", OP8_SQL)
def op8_projection_forest(spark, d):
    return near_vector_components(table(spark, d, "embeddings"), "vec_id", "embedding", Forest(cosine=0.9))


@query("op9_byte_bpe")
def op9_byte_bpe(spark, d):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(table(spark, d, "documents"), "doc_id", "text", ranks)


OP10_SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), often AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY doc_id
"""


@query("op10_line_runs", OP10_SQL)
def op10_line_runs(spark, d):
    kept = drop_frequent_lines(table(spark, d, "documents"), "doc_id", "text", LineRules(min_docs=10, min_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
), usable AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) / (q.norm * c.norm) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op11_vantage_trees", OP11_SQL)
def op11_vantage_trees(spark, d):
    return nearest_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0, VantageSearch(neighbours=5, factor=1.0))


@query("op12_variant_blocks")
def op12_variant_blocks(spark, d):
    rules = VariantRules(least_chars=5, least_count=3, times=2)
    return variant_groups(damaged_words(table(spark, d, "documents"), "doc_id", "text", 97, rules.least_chars), rules)


_OP13_LENGTHS = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, unnest([array_to_string(ws[i : i + {k - 1}], ' ') FOR i IN range(1, len(ws) - {k} + 2)]) AS phrase FROM piece WHERE len(ws) >= {k}"
    for k in range(1, 6)
)
OP13_SQL = rf"""
WITH text AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), piece AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM text
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM ({_OP13_LENGTHS}) GROUP BY ALL
), total AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k >= 2 AND f >= 100
), held AS (
  SELECT lang, array_to_string(ws[i : j], ' ') AS phrase, max(a) AS longer
  FROM cand, unnest(range(1, k + 1)) AS u(i), unnest(range(1, k + 1)) AS v(j) WHERE j > i AND j - i + 1 < k GROUP BY ALL
), cut AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, n, (1000 * c.a * n) // (l.f * r.f) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000 * c.a * n) // (l.f * r.f), cut) AS place
  FROM cand c JOIN total USING (lang), unnest(range(1, c.k)) AS u(cut)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1 : c.k], ' ')
), ranked AS (
  SELECT cut.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM cut LEFT JOIN held USING (lang, phrase) WHERE place = 1 AND 100 * coalesce(longer, 0) < 100 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


@query("op13_itemset_phrases", OP13_SQL)
def op13_itemset_phrases(spark, d):
    return collocations(table(spark, d, "documents"), "lang", "text", PhraseRules(longest=5, least=100, top=2000))
