"""Train on synthetic, test on real: accuracy of a bag-of-words classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer, SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTE = "No accuracy: it takes two labels on each side, ten training rows and five test rows."


def accuracy(synthetic: DataFrame, real: DataFrame, text: str, label: str, features: int = 5000, iterations: int = 1000) -> dict:
    """{"synthetic_to_real_accuracy": accuracy}, unrounded; None and a note with fewer than two classes on a side, ten
    training rows or five test rows. Rows of a null or empty label are left out; labels unseen in training count as wrong.

    Lower-case words of two letters or digits at least, one- and two-grams, the
    ``features`` most frequent; L2-penalised logistic regression.
    """
    def rows(df: DataFrame) -> DataFrame:
        return df.where(F.coalesce(F.col(label), F.lit("")) != "").select(F.coalesce(text, F.lit("")).alias("text"), F.col(label).alias("label_text"))

    train, test = rows(synthetic).persist(), rows(real)
    try:
        n_train, classes = train.agg(F.count(F.lit(1)), F.collect_set("label_text")).first()
        n_test, k_test = test.agg(F.count(F.lit(1)), F.count_distinct("label_text")).first()
        if len(classes) < 2 or n_train < 10 or k_test < 2 or n_test < 5:
            return {"synthetic_to_real_accuracy": None, "note": NOTE}
        index = F.create_map(*[F.lit(x) for i, c in enumerate(sorted(classes)) for x in (c, float(i))])
        stages = [
            RegexTokenizer(inputCol="text", outputCol="one", gaps=False, pattern=r"[\p{L}\p{N}_]{2,}"),
            NGram(n=2, inputCol="one", outputCol="two"),
            SQLTransformer(statement="SELECT *, concat(one, two) AS grams FROM __THIS__"),
            CountVectorizer(inputCol="grams", outputCol="features", vocabSize=features),
            LogisticRegression(maxIter=iterations, regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False),
        ]
        model = Pipeline(stages=stages).fit(train.withColumn("label", F.try_element_at(index, "label_text")))
        hits = model.transform(test.withColumn("label", F.coalesce(F.try_element_at(index, "label_text"), F.lit(-1.0))))
        return {"synthetic_to_real_accuracy": hits.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]}
    finally:
        train.unpersist()
