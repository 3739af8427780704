"""Term statistics and sparse vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions.arrays import let_sql, max_tf, term_counts
from pagemill.session import BROADCAST_ROWS, fits, frequent_join, settle


def exploded_tokens(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    return docs.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))


def term_frequency(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(id, term, tf) rows. Counted inside the row, so nothing is shuffled."""
    return docs.select(id_col, F.explode(term_counts(F.col(tokens_col))).alias("c")).select(id_col, "c.term", "c.tf")


def document_max_tf(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """Largest term frequency of each non-empty document."""
    return docs.filter(F.size(tokens_col) > 0).select(id_col, max_tf(term_counts(F.col(tokens_col))).alias("max_tf"))


def normalised_tf(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(id, term, weight), weight = tf / max tf of the document."""
    # Generated from an expression, not from a column: of a column's size a filter
    # would be made, and the terms counted again for it.
    weights = let_sql(
        term_counts(F.col(tokens_col)),
        """c -> get(transform(array(coalesce(array_max(transform(c, x -> x.tf)), 1L)),
          m -> transform(c, x -> named_struct('term', x.term, 'weight', x.tf / m))), 0)""",
    )
    return docs.select(id_col, F.explode(weights).alias("c")).select(id_col, "c.term", "c.weight")


def vocabulary(docs: DataFrame, min_df: int = fixed.MIN_DOCUMENT_FREQUENCY, tokens_col: str = "tokens") -> DataFrame:
    """(term, df, cf, score = df * cf) for terms in at least `min_df` documents.
    One shuffle of partial sums per term."""
    counted = docs.select(F.explode(term_counts(F.col(tokens_col))).alias("c"))
    sums = counted.groupBy(F.col("c.term").alias("term")).agg(
        F.count("*").alias("df"), F.sum("c.tf").alias("cf")
    )
    return sums.filter(F.col("df") >= min_df).withColumn("score", F.col("df") * F.col("cf"))


def top_terms(vocab: DataFrame, k: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """Best k terms by score, ties by term."""
    return vocab.orderBy(F.desc("score"), "term").limit(k)


def remove_stop_tokens(tokens: DataFrame, stop: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Anti join of exploded tokens with a stop table (token)."""
    words = settle(stop.select("token").distinct(), "stop")
    return tokens.join(F.broadcast(words) if fits(words, limit) else words, "token", "left_anti")


def restrict_terms(terms: DataFrame, vocab: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Semi join of term rows with a vocabulary."""
    words = settle(vocab.select("term").distinct(), "vocabulary")
    return terms.join(F.broadcast(words) if fits(words, limit) else words, "term", "left_semi")


def vector_norms(vectors: DataFrame, id_col: str = "doc_id", weight: str = "weight") -> DataFrame:
    """Euclidean norm per vector id."""
    w = F.col(weight).cast("double")
    return vectors.groupBy(id_col).agg(F.sqrt(F.sum(w * w)).alias("norm"))


def dot_products(vectors: DataFrame, model: DataFrame, id_col: str = "doc_id", weight: str = "weight",
                 limit: int = BROADCAST_ROWS) -> DataFrame:
    """(id, dot, matched) of every vector that shares a term with the model. `vectors`
    should be cheap to read: a larger model has them read several times."""
    side = settle(model.select("term", F.col("weight").alias("_w")), "weights")
    return frequent_join(vectors, side, "term", limit).groupBy(id_col).agg(
        F.sum(F.col(weight).cast("double") * F.col("_w")).alias("dot"), F.count("*").alias("matched")
    )


def cosine_value(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    """0 unless the dot product is positive."""
    return F.when(dot > 0, dot / (norm_a * norm_b)).otherwise(F.lit(0.0))


def coverage_cosine(cosine: Column, matched: Column, model_size: Column) -> Column:
    """Cosine weighted by the share of model terms that matched."""
    return cosine * matched / model_size
