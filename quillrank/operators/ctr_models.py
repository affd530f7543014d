"""Click models from Spark ML: linear, FM, boosted trees, trees with a linear model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import FMClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed parameters of the linear and factorisation models.
RATE, EPOCHS, LAMBDA, FACTORS = 0.2, 20, 0.002, 2


def hashed(columns: list[str], categorical: list[str], size: int) -> FeatureHasher:
    return FeatureHasher(inputCols=columns, categoricalCols=categorical, numFeatures=size, outputCol="features")


def linear(columns: list[str], categorical: list[str], size: int = 1 << 12) -> Pipeline:
    """Logistic regression on hashed one-hot columns; with crosses it is the wide model."""
    return Pipeline(stages=[hashed(columns, categorical, size),
                            LogisticRegression(regParam=LAMBDA, maxIter=EPOCHS, labelCol="label")])


def factorization_machine(columns: list[str], categorical: list[str], size: int = 1 << 12) -> Pipeline:
    return Pipeline(stages=[hashed(columns, categorical, size),
                            FMClassifier(factorSize=FACTORS, stepSize=RATE, regParam=LAMBDA, maxIter=EPOCHS,
                                         labelCol="label", seed=7)])


def boosted_trees(estimators: int = 6, depth: int = 2, rate: float = 0.08, sampled: bool = False) -> GBTClassifier:
    """Gradient boosted trees with leaf output; ``sampled`` draws 90% of rows and half of the columns.

    Spark bounds trees by depth only; there is no cap on the leaf count.
    """
    extra = {"subsamplingRate": 0.9, "featureSubsetStrategy": "0.5"} if sampled else {}
    return GBTClassifier(maxIter=estimators, maxDepth=depth, stepSize=rate, seed=0, labelCol="label",
                         featuresCol="features", leafCol="leaves", **extra)


def logits(scored: DataFrame, keep: tuple[str, ...] = ("sample_id", "label")) -> DataFrame:
    """(keep..., logit, probability) of a Spark ML classifier's output."""
    p = vector_to_array("probability")[1]
    safe = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return scored.select(*keep, F.log(safe / (1 - safe)).alias("logit"), p.alias("probability"))


class TreesAndLinear:
    """Boosted trees whose leaf numbers, one-hot per tree, feed a logistic regression."""

    def __init__(self, columns: list[str], **trees):
        self.assembler = VectorAssembler(inputCols=columns, outputCol="features")
        self.trees = boosted_trees(**trees)

    def fit(self, train: DataFrame, everything: DataFrame | None = None) -> "TreesAndLinear":
        """Both models see ``train``; the leaf encoder sees ``everything`` if given."""
        everything = (train if everything is None else everything).persist()
        train = train.persist()
        self.gbt = self.trees.fit(self.assembler.transform(train))
        leaves = [f"leaf{i}" for i in range(self.gbt.getNumTrees)]
        hot = [f"hot{i}" for i in range(self.gbt.getNumTrees)]
        encoder = OneHotEncoder(inputCols=leaves, outputCols=hot, dropLast=False, handleInvalid="keep")
        self.encoder = encoder.fit(self.leaves(everything))
        self.joined = VectorAssembler(inputCols=hot, outputCol="encoded")
        self.model = LogisticRegression(featuresCol="encoded", labelCol="label", maxIter=100).fit(self.encode(train))
        train.unpersist()
        everything.unpersist()
        return self

    def leaves(self, samples: DataFrame) -> DataFrame:
        """The samples with one leaf number per tree."""
        found = self.gbt.transform(self.assembler.transform(samples)).withColumn("l", vector_to_array("leaves"))
        return found.select(*samples.columns, *[F.col("l")[i].alias(f"leaf{i}")
                                                for i in range(self.gbt.getNumTrees)])

    def encode(self, samples: DataFrame) -> DataFrame:
        return self.joined.transform(self.encoder.transform(self.leaves(samples)))

    def predict(self, samples: DataFrame) -> DataFrame:
        """(sample_id, label, logit, probability)."""
        return logits(self.model.transform(self.encode(samples)))
