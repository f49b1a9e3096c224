"""pyspark.ml Estimator / Model wrappers for the kNN operators (N8 surface).

``KNN().setK(5).fit(train).transform(query)`` adds ``neighbors`` (and
``distances``); ``KNNClassifier`` adds ``prediction``, ``probability`` and
``raw``; ``KNNRegression`` adds ``prediction``.  The features column is an
``array<double>`` or an ml ``Vector``.  Fitting keeps a reference to the
training DataFrame (and the class count for the classifier) -- nothing is
collected; the search runs at transform time through :mod:`knn`.

The tree sizes set the plan of a table too large to broadcast: ``topTreeSize``
/ ``topTreeLeafSize`` pivots (``pivots`` overrides it) and leaves of
``subTreeLeafSize`` candidates.  ``balanceThreshold`` 0 (default) searches
exactly; above 0 a query visits only pivots within ``bufferSize`` of its nearest
one (below 0: estimated when fitting).  Estimators and fitted models are saved
and loaded like any other, a model with its training rows beside it.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import SparkSession

from . import knn as N
from .stats import label_histogram


def _param(name, doc, kind):
    return Param(Params._dummy(), name, doc, kind)


class _KNNParams(Params):
    k = _param("k", "number of neighbours", TypeConverters.toInt)
    featuresCol = _param("featuresCol", "features column (array<double> or Vector)", TypeConverters.toString)
    idCol = _param("idCol", "row id column", TypeConverters.toString)
    labelCol = _param("labelCol", "label column", TypeConverters.toString)
    weightCol = _param("weightCol", "weight column (empty: 1)", TypeConverters.toString)
    auxCols = _param("auxCols", "columns carried into neighbors", TypeConverters.toListString)
    maxDistance = _param("maxDistance", "radius cap", TypeConverters.toFloat)
    topTreeSize = _param("topTreeSize", "with topTreeLeafSize: number of pivots", TypeConverters.toInt)
    topTreeLeafSize = _param("topTreeLeafSize", "sampled rows per pivot", TypeConverters.toInt)
    subTreeLeafSize = _param("subTreeLeafSize", "candidates in a leaf around a pivot", TypeConverters.toInt)
    bufferSize = _param("bufferSize", "tau; < 0 estimates it", TypeConverters.toFloat)
    balanceThreshold = _param("balanceThreshold", "> 0 enables the tau search", TypeConverters.toFloat)
    pivots = _param("pivots", "pivot partitions (< 0: from the tree sizes, 0: none)", TypeConverters.toInt)
    seed = _param("seed", "seed", TypeConverters.toInt)
    excludeSelf = _param("excludeSelf", "leave out the candidate of the query's own id", TypeConverters.toBoolean)
    blockRows = _param("blockRows", "rows of a chunk of a pivot", TypeConverters.toInt)
    broadcastBytes = _param("broadcastBytes", "training tables up to this size are broadcast", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        p = N.KNNParams()
        self._setDefault(k=5, featuresCol="features", idCol="id", labelCol="label", weightCol="", auxCols=[],
                         maxDistance=float("inf"), topTreeSize=p.top_tree_size, topTreeLeafSize=p.top_tree_leaf_size,
                         subTreeLeafSize=p.sub_tree_leaf_size, bufferSize=-1.0, balanceThreshold=0.0,
                         pivots=-1, seed=7, excludeSelf=False, blockRows=p.block_rows, broadcastBytes=p.broadcast_bytes)

    def _knn_params(self) -> N.KNNParams:
        g = self.getOrDefault
        radius = g("maxDistance")
        return N.KNNParams(k=g("k"), features_col=g("featuresCol"), id_col=g("idCol"), label_col=g("labelCol"),
                           weight_col=g("weightCol") or None, aux_cols=list(g("auxCols")),
                           max_distance=None if radius == float("inf") else radius,
                           top_tree_size=g("topTreeSize"), top_tree_leaf_size=g("topTreeLeafSize"),
                           sub_tree_leaf_size=g("subTreeLeafSize"), buffer_size=g("bufferSize"),
                           balance_threshold=g("balanceThreshold"), pivots=g("pivots"), seed=g("seed"),
                           exclude_self=g("excludeSelf"), block_rows=g("blockRows"), broadcast_bytes=g("broadcastBytes"),
                           exact=g("balanceThreshold") <= 0)

    def _tau(self, train):
        p = self._knn_params()
        if p.exact:
            return None
        if p.buffer_size >= 0:
            return p.buffer_size
        return float(N.estimate_tau(train, p).first()["tau"])


def _setter(name):
    def put(self, value):
        return self._set(**{name: value})
    put.__name__ = f"set{name[0].upper()}{name[1:]}"
    return put


for _name, _value in list(vars(_KNNParams).items()):
    if isinstance(_value, Param):
        setattr(_KNNParams, f"set{_name[0].upper()}{_name[1:]}", _setter(_name))


class _KNNModelWriter(MLWriter):
    """Parameters, tau and class count as metadata; the training rows as Parquet in ``data``."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, SparkSession.getActiveSession().sparkContext,
                                         extraMetadata={"tau": m.tau, "numClasses": m.num_classes})
        m.train.write.mode("overwrite").parquet(f"{path}/data")


class _KNNModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        spark = SparkSession.getActiveSession()
        meta = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
        if not meta["class"].endswith("." + self.cls.__name__):
            raise ValueError(f"{path} holds a {meta['class']}, not a {self.cls.__name__}")
        model = self.cls(spark.read.parquet(f"{path}/data"), meta["tau"], meta["numClasses"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class _KNNModelBase(Model, _KNNParams, MLWritable, MLReadable):
    def __init__(self, train=None, tau=None, num_classes=None):
        super().__init__()
        self.train, self.tau, self.num_classes = train, tau, num_classes

    def write(self):
        return _KNNModelWriter(self)

    @classmethod
    def read(cls):
        return _KNNModelReader(cls)


class KNNModel(_KNNModelBase):
    def _transform(self, dataset):
        return N.knn_join(dataset, self.train, self._knn_params(), self.tau)


class KNNClassificationModel(_KNNModelBase):
    def _transform(self, dataset):
        return N.knn_classify(dataset, self.train, self._knn_params(), self.num_classes, self.tau)


class KNNRegressionModel(_KNNModelBase):
    def _transform(self, dataset):
        return N.knn_regress(dataset, self.train, self._knn_params(), self.tau)


class _KNNEstimatorBase(Estimator, _KNNParams, DefaultParamsWritable, DefaultParamsReadable):
    _model = KNNModel

    def _make(self, train, tau):
        return self._model(train, tau)

    def _fit(self, dataset):
        m = self._make(dataset, self._tau(dataset))
        m._resetUid(self.uid)
        return self._copyValues(m)


class KNN(_KNNEstimatorBase):
    _model = KNNModel


class KNNRegression(_KNNEstimatorBase):
    _model = KNNRegressionModel


class KNNClassifier(_KNNEstimatorBase):
    _model = KNNClassificationModel

    def _make(self, train, tau):
        p = self._knn_params()
        h = label_histogram(train, p.label_col, p.weight_col)
        n = int(h.agg({"cls": "max"}).first()[0]) + 1
        return KNNClassificationModel(train, tau, n)
