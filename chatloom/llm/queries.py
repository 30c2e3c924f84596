"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm.align import aligned_tokens
from chatloom.llm.bpe_counts import token_counts
from chatloom.llm.decompose import decomposed_documents
from chatloom.llm.html_text import extract
from chatloom.llm.jaccard import link_components
from chatloom.llm.lexical import ranked_documents
from chatloom.llm.maxent import language_scores
from chatloom.llm.mixing import mix_sources
from chatloom.llm.packing import packed_documents
from chatloom.llm.quality import quality_scores
from chatloom.llm.quality_rules import quality_rules
from chatloom.llm.tables import read
from chatloom.llm.topk import top_k
from chatloom.llm.toxicity import toxicity_scores


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; null html gives an empty one. Columns: page_id, url, text, n_chars."""
    return extract(read(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document. Columns: doc_id, size, source_size, target, taken. Null texts have size 0, null sources are one source."""
    mix = mix_sources(read(spark, sf_dir, "documents"), max_epochs=3, cycle=(5, 2, 1))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 4096 tokens. Null texts are the end id alone."""
    return packed_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near copies of every document. Null texts link with nothing."""
    return link_components(read(spark, sf_dir, "documents"), width=5, percent=75)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for each vector whose id is divisible by 20. Nulls and non-finite components take no part."""
    return top_k(read(spark, sf_dir, "embeddings"), k=20, every=20, scale=64.0)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, null texts too."""
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, null texts too."""
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document; null texts have none."""
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document; null texts are one end token."""
    return language_scores(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; null texts have no words and fail."""
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every document's tokens by two tokenizers; texts without tokens give zeros and an empty digest."""
    return aligned_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all documents for every benchmark item; items without terms have none."""
    return ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, each a sequence of a power of two up to 2048 tokens. Null texts are the end id alone."""
    return decomposed_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_html_text, op2_mix_sources, op3_best_fit_packing, op4_ngram_jaccard, op5_exact_top_k, op6_quality_classifier, op7_toxicity, op8_token_counts, op9_language_model, op10_quality_rules,
             op11_token_alignment, op12_lexical_search, op13_binary_packing)
    return {f.__name__: f for f in found}


#: The 20 best by integer product, ties to the smaller id.
TOP_K_SQL = """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: isnan(x) or isinf(x))) = 0
), s as (
  select q.row, q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from (select * from v where vec_id % 20 = 0) q join v c on q.row <> c.row and len(q.e) = len(c.e)
), r as (
  select query_id, (row_number() over (partition by row order by score desc, vec_id))::integer as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""


#: Scores in 64-bit integers; only a term's weight goes through doubles.
SEARCH_SQL = r"""
with d as (
  select row_number() over () as row_id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
), totals as (
  select count(*)::bigint as n_docs, sum(len(terms))::bigint as n_terms from d where len(terms) > 0
), p as (
  select row_id, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*)::bigint as tf
  from (select row_id, doc_id, len(terms)::bigint as n, unnest(terms) as term from d) group by row_id, term
), i as (
  select item_row, item_id, term, count(*)::bigint as times
  from (select row_number() over () as item_row, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_row, item_id, term
), w as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from p, totals where term in (select term from i) group by term, n_docs
), s as (
  select item_row, any_value(item_id) as item_id, row_id, any_value(doc_id) as doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::bigint as score
  from i join w using (term) join p using (term), totals group by item_row, row_id
), r as (
  select item_id, (row_number() over (partition by item_row order by score desc, doc_id nulls last))::integer as rank, doc_id, score from s where score > 0
)
select item_id, rank, doc_id, score from r where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_top_k": TOP_K_SQL, "op12_lexical_search": SEARCH_SQL}
