"""Search corpus (V1) and exact nearest-neighbour search.

The corpus is a DataFrame with an embedding column; search is a projection of
the distance to a query vector followed by a top-k. A batch of queries that
each carry a facet value meets the corpus by an equi-join on that facet, and
the per-query top-k runs as a window with a group limit, which Spark applies
partially before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import join_texts, rounded
from ..functions.vectors import cosine_distance, literal_norm, ranking, vector_literal
from ..schemas import vector_doc_schema
from .dedup import keep_first


def build_corpus(filings: DataFrame, texts: DataFrame, key: str = "adsh",
                 text_key: str | None = None, summary: str = "filing_summary",
                 extracted: str = "extracted_pdf_text",
                 order_by: Sequence[str] | None = None) -> DataFrame:
    """V1 before encoding: one row per key (keep-first), texts left-joined,
    nulls as '' and ``full_text = summary + "\\n\\n" + extracted``.

    "First" is by ``order_by``, then by all other columns, so the row kept never
    depends on the order in which rows arrive."""
    first = keep_first(filings, [key], [*(order_by or []),
                                        *[c for c in filings.columns if c != key]])
    tk = text_key or key
    t = texts.select(F.col(tk).alias("_tk"), F.col(extracted).alias("_extracted"))
    joined = first.join(t, first[key] == t["_tk"], "left")
    return (joined.withColumn(extracted, F.col("_extracted"))
            .withColumn("has_text", F.col("_tk").isNotNull())
            .withColumn("full_text", join_texts(summary, extracted))
            .drop("_tk", "_extracted"))


def publish_corpus(wh, corpus: DataFrame, facet: str = "form", name: str = "search_corpus",
                   dim: int | None = None, vec_col: str = "embedding") -> tuple[str, DataFrame]:
    """Write the search table partitioned by its facet, so a filtered
    search prunes partitions. Rows whose vector length differs from ``dim``
    are not written; they are returned as the failure side (A7).

    With ``dim`` the table has the columns of ``schemas.vector_doc_schema``. Returns
    (version, rejected rows).
    """
    from .quality import vector_length

    if dim is None:
        return wh.publish({name: corpus}, partition_by={name: [facet]}), corpus.limit(0)
    wanted = [f.name for f in vector_doc_schema().fields if f.name in corpus.columns]
    corpus = corpus.select(*wanted, *[c for c in corpus.columns if c not in wanted])
    ok = vector_length(corpus, vec_col, dim)
    version = wh.publish({name: corpus.filter(ok)}, partition_by={name: [facet]})
    return version, corpus.filter(~ok)


def _facet_filter(df: DataFrame, facet: str | None, value) -> DataFrame:
    """Filter only when a facet value is given."""
    if facet is None or value is None:
        return df
    return df.filter(F.col(facet) == F.lit(value))


def knn(corpus: DataFrame, query: Sequence[float], k: int = 10, id_col: str = "id",
        vec_col: str = "embedding", facet: str | None = None, facet_value=None,
        keep: Sequence[str] = (), round_to: int | None = 6) -> DataFrame:
    """The k nearest rows to one query vector by cosine distance (smaller is nearer).

    Rows are ranked by the distance itself (see ``vectors.ranking``), then by id; only
    the output is rounded to ``round_to``."""
    dist: Column = cosine_distance(vec_col, vector_literal(query),
                                   b_norm=F.lit(literal_norm(query)))
    scored = _facet_filter(corpus, facet, facet_value).select(
        id_col, *keep, dist.alias("distance"))
    top = scored.orderBy(*ranking("distance", id_col)).limit(k)
    return top.withColumn("distance", _shown(round_to))


def _shown(round_to: int | None, col: str = "distance") -> Column:
    """The distance as returned; ranking doesn't use the rounded one."""
    return F.col(col) if round_to is None else rounded(col, round_to)


def knn_per_query(corpus: DataFrame, queries: DataFrame, facet: str, k: int = 10,
                  id_col: str = "id", vec_col: str = "embedding", qid: str = "qid",
                  qvec: str = "qvec", round_to: int | None = 6) -> DataFrame:
    """(qid, facet, rank, id, distance): each query's k nearest rows within its facet.

    Queries meet the corpus by an equi-join on the facet (no cross product);
    Spark broadcasts the query side when its measured size allows.
    """
    j = corpus.select(facet, id_col, vec_col).join(
        queries.select(qid, facet, qvec), facet)
    scored = j.select(qid, facet, id_col, cosine_distance(vec_col, qvec).alias("distance"))
    w = Window.partitionBy(qid).orderBy(*ranking("distance", id_col))
    ranked = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(qid, facet, F.col("rank").cast("long").alias("rank"), id_col,
                         _shown(round_to).alias("distance"))


def facet_centroids(corpus: DataFrame, facet: str, vec_col: str = "embedding") -> DataFrame:
    """(facet, qvec): mean vector per facet value, as an ML summarizer aggregate."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>")))
    return corpus.groupBy(facet).agg(vector_to_array(mean).alias("qvec"))


def facet_counts(corpus: DataFrame, facet: str) -> DataFrame:
    """Rows per facet value."""
    return corpus.groupBy(facet).agg(F.count(F.lit(1)).alias("n"))


# --- text search as users call it (V2 over V1) -------------------------------------
def search_corpus(filings: DataFrame, texts: DataFrame, key: str = "adsh",
                  text_key: str | None = None, **corpus) -> DataFrame:
    """(id, cik, name, form, full_text): what the search table and its index are built from."""
    built = build_corpus(filings, texts, key=key, text_key=text_key, **corpus)
    return built.select(F.col(key).cast("string").alias("id"), F.col("cik").cast("string").alias("cik"),
                        "name", "form", "full_text")


def search_texts(index, documents: DataFrame, queries: DataFrame, k: int = 10,
                 facet: str = "form", round_to: int | None = 5) -> DataFrame:
    """(qid, rank, id, cik, name, form, distance): each text query's k nearest documents.

    ``index``: a ``text.TfIdf`` over ``documents`` (key ``id``), built with the facet.
    ``queries``: qid, text and optionally ``facet``; a null facet searches all
    documents. Only the k rows per query meet the documents' attributes.
    """
    hits = index.search_batch(queries, k=k, facet=facet, round_to=round_to)
    shown = documents.select("id", "cik", "name", "form")
    return hits.withColumnRenamed(index.key, "id").join(shown, "id").select(
        "qid", "rank", "id", "cik", "name", "form", "distance")
