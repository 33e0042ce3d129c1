"""Q: text search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stemming import portuguese_stem, portuguese_stem_sql
from ..functions.text import stem_sql, stop_words_sql, tokens
from ..operators import textsearch as Q
from ..session import scratch_path
from ..sources import tables
from .registry import query

TERMS = ["thon", "erin"]
STEM_TERMS = ["the", "thons", "erins"]

TOKENS_SQL = rf"""(SELECT doc_id, term FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\P{{L}}+')) AS term FROM documents) x
  WHERE term <> '' AND term NOT IN ({stop_words_sql()}))"""


@query("text_match_all", sql=f"""
SELECT doc_id FROM {TOKENS_SQL} t WHERE term IN ('thon', 'erin')
GROUP BY doc_id HAVING COUNT(DISTINCT term) = 2
""")
def text_match_all(spark, sf_dir):
    """Q1: documents containing all query terms as whole tokens (letter runs of
    the whole lower-cased text; stop words dropped from the query)."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text")
    return Q.match_all(d, "text", TERMS).select("doc_id")


@query("text_match_stem", sql=f"""
SELECT doc_id FROM (SELECT doc_id, {stem_sql('term')} AS stem FROM {TOKENS_SQL} t) s
WHERE stem IN ({', '.join(f"'{w}'" for w in Q.query_terms(STEM_TERMS, stem=True))})
GROUP BY doc_id HAVING COUNT(DISTINCT stem) = {len(Q.query_terms(STEM_TERMS, stem=True))}
""")
def text_match_stem(spark, sf_dir):
    """Q1 with stemming on both sides; the stop word of the query is dropped."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text")
    return Q.match_all(d, "text", STEM_TERMS, stem=True).select("doc_id")


@query("stem_portuguese", sql=portuguese_stem_sql(
    "(SELECT unnest(regexp_split_to_array(lower(text), '\\P{L}+')) AS term FROM documents) t WHERE term <> ''", "term"))
def stem_portuguese(spark, sf_dir):
    """Q1: the Portuguese stem of every word of the documents."""
    d = tables(spark, sf_dir).documents.select(F.explode(tokens("text")).alias("term")).distinct()
    return d.select("term", portuguese_stem(F.col("term")).alias("stem"))


PORTUGUESE_TERMS = ["the", "thonado", "erinava"]


@query("text_match_portuguese", sql=f"""
SELECT doc_id FROM {TOKENS_SQL} t
JOIN ({portuguese_stem_sql(TOKENS_SQL + " tk", "term")}) s ON s.term = t.term
WHERE s.stem IN (SELECT stem FROM ({portuguese_stem_sql("(VALUES ('thonado'), ('erinava')) q(term)", "term")}) x)
GROUP BY doc_id HAVING COUNT(DISTINCT s.stem) = 2
""")
def text_match_portuguese(spark, sf_dir):
    """Q1 with the Portuguese configuration: stop words out, both sides stemmed."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text")
    return Q.match_all_portuguese(d, "text", PORTUGUESE_TERMS).select("doc_id")


@query("inverted_index", sql=f"SELECT DISTINCT term, doc_id FROM {TOKENS_SQL} t")
def inverted_index(spark, sf_dir):
    """Q2: postings (term, doc_id) of every document (GIN re-aimed)."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text")
    return Q.postings(d, "doc_id", "text")


@query("index_search", sql=f"""
SELECT doc_id FROM {TOKENS_SQL} t WHERE term IN ('thon', 'erin')
GROUP BY doc_id HAVING COUNT(DISTINCT term) = 2
""")
def index_search(spark, sf_dir):
    """Q3: build the index (written clustered by term), then answer the query
    by intersecting the postings of its terms."""
    d = tables(spark, sf_dir).documents.select("doc_id", "text")
    path = scratch_path(spark, "inverted_index")
    Q.write_index(Q.postings(d, "doc_id", "text"), path)
    return Q.search(spark.read.parquet(path), TERMS)
