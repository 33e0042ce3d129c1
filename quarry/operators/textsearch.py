"""Q: full-text match, inverted index and index lookup.

The index is a table of postings ``(term, doc_id)`` -- never a list per
term, so a very common term is many rows spread over tasks, not one huge
array. Written range-partitioned and sorted by (term, doc_id), a term lookup
reads only the files and row groups whose min/max cover it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stemming import portuguese_stem
from ..functions.text import STOP_WORDS, TOKEN_SPLIT, letter_runs, light_stem, stem_word, tokens


def query_terms(terms: list[str], stem: bool = False) -> list[str]:
    """The distinct tokens that a query asks for: lower-cased letter runs (a
    term of two words gives two), stop words dropped, stemmed on request."""
    found = {w for t in terms for w in letter_runs(t.lower()) if w not in STOP_WORDS}
    return sorted({stem_word(w) for w in found} if stem else found)


def match_all(docs: DataFrame, text: str, terms: list[str], stem: bool = False) -> DataFrame:
    """``to_tsvector(text) @@ 'a & b'``: documents holding every term. A query
    of stop words alone matches nothing, as in the server.

    A document can only hold a token if its lower-cased text contains it, so
    that cheap substring test runs first. With ``stem`` (approximate) both
    sides are stemmed; a stem need not be part of the word, so the test is
    then on the tokens alone."""
    want = query_terms(terms, stem)
    if not want:
        return docs.filter(F.lit(False))
    if stem:
        drop = F.array(*[F.lit(w) for w in STOP_WORDS])
        stems = F.transform(F.array_except(tokens(text), drop), light_stem)
        return docs.filter(F.size(F.array_except(F.array(*[F.lit(w) for w in want]), stems)) == 0)
    low = F.lower(F.col(text))
    # a token equals t  <=>  t occurs in the lower-cased text with no letter on
    # either side; tokens are letters only, so nothing needs quoting
    pre, exact = F.lit(True), F.lit(True)
    for t in want:
        pre = pre & low.contains(t)
        exact = exact & low.rlike(r"(?<!\p{L})" + t + r"(?!\p{L})")
    return docs.filter(pre).filter(exact)


def match_all_portuguese(docs: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """``match_all`` with the Portuguese text configuration: words of the text
    and of the query are reduced to their Snowball stems (``functions.stemming``)."""
    asked = [w for t in terms for w in letter_runs(t.lower()) if w not in STOP_WORDS]
    if not asked:
        return docs.filter(F.lit(False))
    drop = F.array(*[F.lit(w) for w in STOP_WORDS])
    stems = F.transform(F.array_except(tokens(text), drop), portuguese_stem)
    want = F.transform(F.array(*[F.lit(w) for w in sorted(set(asked))]), portuguese_stem)   # folded to a constant
    return docs.filter(F.size(F.array_except(want, stems)) == 0)


def postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Postings ``(term, doc_id)``: one row per distinct non-stop term of each
    document. ``array_except`` drops duplicates and stop words in one
    hash-based pass per document, so building the postings needs no shuffle;
    the index writer then clusters them by term."""
    drop = F.array(*[F.lit(w) for w in ("",) + tuple(STOP_WORDS)])
    terms = F.array_except(F.split(F.lower(F.col(text)), TOKEN_SPLIT), drop)
    return docs.select(F.explode(terms).alias("term"), F.col(doc_id).alias("doc_id"))


def write_index(post: DataFrame, path: str, n_partitions: int | None = None) -> None:
    ranged = (post.repartitionByRange(n_partitions, "term", "doc_id") if n_partitions
              else post.repartitionByRange("term", "doc_id"))  # AQE sizes the partitions
    ranged.sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(path)


def search(post: DataFrame, terms: list[str]) -> DataFrame:
    """Intersect the postings of all terms: documents where every term occurs;
    the same terms as ``match_all`` asks for."""
    want = query_terms(terms)
    hits = post.filter(F.col("term").isin(want)).groupBy("doc_id").agg(F.countDistinct("term").alias("_n"))
    return hits.filter(F.col("_n") == len(want)).select("doc_id")
