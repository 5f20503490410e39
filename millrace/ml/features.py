"""Feature stages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    Binarizer,
    CountVectorizerModel,
    OneHotEncoder,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    UnivariateFeatureSelector,
    VectorAssembler,
    VectorSlicer,
    Word2Vec,
    Word2VecModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.ordered import row_index
from millrace.scratch import keep

PART_ROWS = 100_000
#: The most frequent terms, which every task gets; the others of a vocabulary are joined.
HEAD = 1 << 18
#: Values of lists that a task works on at once.
SLICE = 500_000

# -- text -----------------------------------------------------------------


def tokenizer(text: str, out: str) -> Tokenizer:
    """Lower case, split at each whitespace character."""
    return Tokenizer(inputCol=text, outputCol=out)


def stop_words_remover(terms: str, out: str, words: Sequence[str] | None = None
                       ) -> StopWordsRemover:
    """Drops the default English stop words, or the given ones."""
    remover = StopWordsRemover(inputCol=terms, outputCol=out)
    return remover.setStopWords(list(words)) if words else remover


def vocabulary(df: DataFrame, terms: str, size: int | None = None, min_df: int = 1) -> list[str]:
    """The ``size`` most frequent terms (all without a size) that occur in ``min_df`` rows or more.

    Equal counts are ordered by the term, so that every run picks the same ones.
    The list is the only thing that reaches the driver.
    """
    counted = df.select(
        F.inline(
            F.concat(
                F.transform(terms, lambda w: F.struct(
                    w.alias("term"), F.lit(1).alias("uses"), F.lit(0).alias("rows"))),
                F.transform(F.array_distinct(terms), lambda w: F.struct(
                    w.alias("term"), F.lit(0).alias("uses"), F.lit(1).alias("rows"))),
            )
        )
    )
    top = (
        counted.groupBy("term")
        .agg(F.sum("uses").alias("uses"), F.sum("rows").alias("rows"))
        .where(F.col("rows") >= min_df)
        .orderBy(F.desc("uses"), "term")
    )
    return [r["term"] for r in (top.limit(size) if size else top).collect()]


def counter(known: Sequence[str], terms: str, out: str) -> CountVectorizerModel:
    """Term counts over a vocabulary, which is sent in one piece: ``from_vocabulary`` calls the JVM for each term."""
    if not known or any("\0" in term for term in known):
        return CountVectorizerModel.from_vocabulary(list(known), inputCol=terms, outputCol=out)
    jvm = SparkSession.active().sparkContext._jvm
    array = jvm.java.util.regex.Pattern.compile("\0").split("\0".join(known), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    return model.setInputCol(terms).setOutputCol(out)._set(vocabSize=len(known))


def count_vectorizer(
    df: DataFrame, terms: str, out: str, size: int | None = None, min_df: int = 1
) -> CountVectorizerModel:
    """Term counts over the fitted vocabulary."""
    return counter(vocabulary(df, terms, size, min_df), terms, out)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows in a row whose lists have about ``SLICE`` values together, or one row with more."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.list_value_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def list_column(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Values in a row cut into lists of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


def _distinct(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each distinct term of each list: the list's number, the term's code, how often it has it; all
    terms by their code."""
    coded = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    codes, many = coded.indices, max(1, len(coded.dictionary))
    rows = np.repeat(np.arange(len(lists)), sizes)
    if codes.null_count:    # a null is no term
        rows, codes = rows[codes.is_valid().to_numpy(zero_copy_only=False)], codes.drop_null()
    pairs, n = np.unique(rows * many + codes.to_numpy(zero_copy_only=False), return_counts=True)
    return pairs // many, pairs % many, n, coded.dictionary


def vocabulary_table(df: DataFrame, terms: str, min_df: int = 1) -> DataFrame:
    """``vocabulary`` without a size as a stored table (term, idx), for as many terms as there are."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, terms):
                _, code, n, words = _distinct(part.column(terms))
                uses, rows = np.bincount(code, n, len(words)).astype(np.int64), np.bincount(code, minlength=len(words))
                yield pa.record_batch({"term": words, "uses": uses, "rows": rows})

    found = (
        df.select(terms).mapInArrow(counted, "term string, uses long, rows long").groupBy("term")
        .agg(F.sum("uses").alias("uses"), F.sum("rows").alias("rows"))
        .where(F.col("rows") >= min_df)
        .select("term", (-F.col("uses")).alias("__less"))
    )
    # numbering reads its input twice
    return keep(row_index(keep(found, "terms"), ["__less", "term"]).select("term", "idx"), "terms")


class TermCounter:
    """Term counts over a vocabulary in a table (term, idx), however large.

    Where ``CountVectorizerModel`` holds all terms in each task, the ``HEAD`` most frequent are sent
    here and the others are joined.
    """

    def __init__(self, known: DataFrame, terms: str, out: str, row: str = "row"):
        self.known, self.terms, self.out, self.row = known, terms, out, row

    def transform(self, df: DataFrame) -> DataFrame:
        """The counts instead of the terms, and a number that tells rows apart.

        The counts are a sparse vector as a struct: size of the vocabulary, rising indices, values.
        """
        terms, size = self.terms, self.known.count()
        inside = self.known.where(F.col("idx") < HEAD).orderBy("idx").select("term").toArrow().column(0).combine_chunks()
        df = df.withColumn(self.row, F.monotonically_increasing_id())
        others = [c for c in df.columns if c not in (terms, self.out)]

        def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, terms):
                    rows, code, n, words = _distinct(part.column(terms))
                    idx = pc.index_in(words, value_set=inside).fill_null(-1).to_numpy(zero_copy_only=False)[code]
                    rare = np.flatnonzero(idx < 0)
                    sent = np.lexsort((idx, rows))
                    sent = sent[idx[sent] >= 0]
                    values, total = n.astype(np.int32), part.num_rows
                    rest = pa.StructArray.from_arrays([words.take(pa.array(code[rare])), pa.array(values[rare])], ["term", "n"])
                    sizes, more = np.bincount(rows[sent], minlength=total), np.bincount(rows[rare], minlength=total)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in others), list_column(sizes, pa.array(idx[sent].astype(np.int32))),
                         list_column(sizes, pa.array(values[sent])), list_column(more, rest)],
                        names=[*others, "__idx", "__n", "__rest"])

        kinds = StructType.fromDDL("__idx array<int>, __n array<int>, __rest array<struct<term: string, n: int>>")
        found = df.select(*others, terms).mapInArrow(numbered, StructType([*df.select(*others).schema.fields, *kinds.fields]))
        idx, n = F.col("__idx"), F.col("__n")
        if size > HEAD:
            found = keep(found, "terms")
            rare = found.select(self.row, F.inline("__rest")).join(self.known.where(F.col("idx") >= HEAD), "term")
            rare = rare.groupBy(self.row).agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "n"))).alias("__more"))
            found = found.drop("__rest").join(rare, self.row, "left")
            none = F.array().cast("array<int>")
            idx, n = F.concat(idx, F.coalesce("__more.idx", none)), F.concat(n, F.coalesce("__more.n", none))
        counts = F.struct(F.lit(size).cast("int").alias("size"), idx.alias("indices"), n.alias("values"))
        return found.select(*others, counts.alias(self.out))


def word_parts(df: DataFrame) -> int:
    """In how many pieces to train word vectors: one per ``PART_ROWS`` rows."""
    return df.count() // PART_ROWS + 1


def word_learner(terms: str, out: str, size: int = 2, min_count: int = 0, seed: int = 7, parts: int = 1) -> Word2Vec:
    """Word embeddings; a row's vector is the mean of its words.

    The model, and so the vocabulary, is the library's and has to fit on one machine; a larger
    ``min_count`` makes it smaller.
    """
    return Word2Vec(vectorSize=size, minCount=min_count, inputCol=terms, outputCol=out, seed=seed, numPartitions=parts)


def word_vectors(
    df: DataFrame, terms: str, out: str, size: int = 2, min_count: int = 0,
    seed: int = 7, parts: int | None = None,
) -> Word2VecModel:
    """Fitted word embeddings.  The library trains on one partition by default, i.e. all text in one
    task; here on as many as the data asks for, a number that does not depend on the cluster."""
    return word_learner(terms, out, size, min_count, seed, parts or word_parts(df)).fit(df)


# -- categories and numbers ----------------------------------------------


class LabelIndex:
    """Labels and their numbers as a table; as many labels as there are."""

    def __init__(self, column: str, out: str, labels: DataFrame):
        self.column, self.out, self.labels = column, out, labels

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the number; rows with null or unknown labels drop out."""
        own = self.labels.select(F.col("label").alias("__label"), F.col("idx").cast("double").alias(self.out))
        return df.join(own, F.col(self.column).cast("string") == F.col("__label")).drop("__label")


def string_index(df: DataFrame, column: str, out: str) -> LabelIndex:
    """Most frequent label is 0, ties alphabetical."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg((-F.count("*")).alias("__n"))
    return LabelIndex(column, out, keep(row_index(counts, ["__n", "label"]), "labels"))


def one_hot(index: str, out: str) -> OneHotEncoder:
    """One position per category but the last."""
    return OneHotEncoder(inputCol=index, outputCol=out)


def binarizer(column: str, out: str, threshold: float) -> Binarizer:
    """1.0 where the value is above the threshold, else 0.0."""
    return Binarizer(threshold=threshold, inputCol=column, outputCol=out)


def assembler(columns: Sequence[str], out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out)


def scaler(features: str, out: str) -> StandardScaler:
    """Divides by the sample standard deviation; does not center."""
    return StandardScaler(inputCol=features, outputCol=out)


def chi_square_selector(features: str, label: str, out: str, top: int = 1
                        ) -> UnivariateFeatureSelector:
    """Keeps the categorical features that depend most on the label."""
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol=out, selectionMode="numTopFeatures"
    )
    return selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(
        top
    )


def slicer(features: str, out: str, indices: Sequence[int]) -> VectorSlicer:
    return VectorSlicer(inputCol=features, outputCol=out, indices=list(indices))


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Positions of a vector as plain columns."""
    values = vector_to_array(vector)
    return df.withColumns({n: values[i] for i, n in enumerate(names)})
