"""Text features with the weights of a standard TF-IDF vectoriser, as ML pipeline stages."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF, CountVectorizer, ElementwiseProduct, HashingTF, NGram, Normalizer, RegexTokenizer,
    SQLTransformer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

from hooklens.functions.text import TOKEN

DEFAULT_FEATURES = 1 << 18
MAX_DF = 0.95


def fit_text_features(
    train: DataFrame,
    num_features: int = DEFAULT_FEATURES,
    exact_vocabulary: bool = False,
    max_df: float = MAX_DF,
    text: str = "text",
    output: str = "text_vector",
) -> PipelineModel:
    """Pipeline text -> unit TF-IDF vector of words and word pairs, fitted on `train`.

    Terms are hashed into a fixed width, so nothing on the driver grows with the data.
    `exact_vocabulary` keeps the terms themselves (at most `num_features` of them) instead.
    The library IDF lacks the +1 of the usual smoothed form and has no upper document
    limit; both go into one scaling vector made from its document counts.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=TOKEN, gaps=False),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
    ]
    prepared = PipelineModel(stages).transform(train)
    if exact_vocabulary:
        counter = CountVectorizer(
            inputCol="_terms", outputCol="_tf", minDF=1.0, maxDF=max_df, vocabSize=num_features
        ).fit(prepared)
    else:
        counter = HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counter.transform(prepared))
    limit = max_df * idf.numDocs
    scale = [
        (w + 1.0) if df <= limit else 0.0 for w, df in zip(idf.idf.toArray(), idf.docFreq)
    ]
    return PipelineModel(
        [
            *stages,
            counter,
            ElementwiseProduct(
                scalingVec=Vectors.dense(scale), inputCol="_tf", outputCol="_weighted"
            ),
            Normalizer(p=2.0, inputCol="_weighted", outputCol=output),
            SQLTransformer(statement="SELECT * EXCEPT (_words, _pairs, _terms, _tf, _weighted) FROM __THIS__"),
        ]
    )
