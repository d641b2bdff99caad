"""Feature encoding with MLlib stages (H1-H6).

One multi-column ``StringIndexer`` indexes every feature *and* the label in a
single pass over the training rows (the original job fits twelve separate
indexers, i.e. twelve passes). Unseen values get the extra ``__unknown``
index, which ``OneHotEncoder(dropLast=True)`` drops, so an unseen category is
an all-zero block and every training category keeps its own slot.
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.operators.cleaning import qcol
from catlens.operators.ranking import position_in_group

FEATURES = "features"
LABEL = "label"
PREDICTION = "prediction"
PREDICTED_LABEL = "predicted_label"
# Reserved feature name of the per-class row counts in vocabulary_counts.
ROWS = "__rows__"


def idx_col(c: str) -> str:
    return f"{c}_idx"


def vec_col(c: str) -> str:
    return f"{c}_vec"


def index_stage(cfg: JobConfig) -> StringIndexer:
    """H1 + H4: category -> index by descending training frequency (ties by
    value), unseen -> extra index; the label is indexed in the same pass."""
    feats = list(cfg.feature_cols)
    return StringIndexer(
        inputCols=feats + [cfg.label_col],
        outputCols=[idx_col(c) for c in feats] + [LABEL],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot_stage(cfg: JobConfig) -> OneHotEncoder:
    """H2: index -> sparse 0/1 block per feature (dropLast drops ``__unknown``)."""
    feats = list(cfg.feature_cols)
    return OneHotEncoder(
        inputCols=[idx_col(c) for c in feats], outputCols=[vec_col(c) for c in feats], dropLast=True
    )


def assemble_stage(cfg: JobConfig) -> VectorAssembler:
    """H3: concatenate the blocks into ``features``."""
    return VectorAssembler(inputCols=[vec_col(c) for c in cfg.feature_cols], outputCol=FEATURES)


def feature_stages(cfg: JobConfig) -> list:
    return [index_stage(cfg), one_hot_stage(cfg), assemble_stage(cfg)]


def vocabulary_counts(train: DataFrame, cfg: JobConfig) -> DataFrame:
    """(label, feature, category, n) over the training rows: one pass.

    The rows are unpivoted to (label, feature, category) and counted with
    partial aggregation; the shuffle keys spread over all reducers, so a hot
    label or category adds rows (one per map task) to a reducer rather than
    one big buffer. The result has at most (labels x vocabulary) rows: the
    size of the fitted model, not of the data. It gives both the indexer's
    frequency order and the Naive Bayes sufficient statistics.
    """
    pairs = [F.struct(F.lit(c).alias("feature"), qcol(c).alias("category")) for c in cfg.feature_cols]
    # plus one row-count entry per row, so class totals do not depend on
    # any feature being non-NULL (NULLs are not vocabulary, as in StringIndexer)
    pairs.append(F.struct(F.lit(ROWS).alias("feature"), F.lit("").alias("category")))
    return (
        train.select(F.col(cfg.label_col), F.inline(F.array(*pairs)))
        .filter(F.col("category").isNotNull())
        .groupBy(cfg.label_col, "feature", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_counts(counts: DataFrame) -> DataFrame:
    """(feature, category, n) of the vocabulary counts, labels summed up."""
    return counts.filter(F.col("feature") != ROWS).groupBy("feature", "category").agg(F.sum("n").alias("n"))


def class_counts(counts: DataFrame, cfg: JobConfig) -> DataFrame:
    """(label, n): training rows per class (at most k + 1 rows)."""
    return counts.filter(F.col("feature") == ROWS).select(F.col(cfg.label_col), "n")


def _freq_order(counts: dict) -> list[str]:
    """Frequency descending, ties by value in UTF-16 code-unit order (the
    order StringIndexer uses)."""
    return [v for v, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode("utf-16-be")))]


def _by_frequency(value: str) -> list:
    """The same order as columns."""
    return [F.desc("n"), F.encode(F.col(value), "UTF-16BE").asc()]


class Vocabulary:
    """The label arrays that MLlib's indexer models hold (feature vocabularies and classes)."""

    def __init__(self, categories, classes, cfg: JobConfig):
        self.cfg = cfg
        per_feature: dict[str, dict[str, int]] = {c: {} for c in cfg.feature_cols}
        for feat, cat, n in categories:
            per_feature[feat][cat] = n
        self.label_n = dict(classes)
        self.labels = _freq_order(self.label_n)
        self.arrays = [_freq_order(per_feature[c]) for c in cfg.feature_cols]

    def indexers(self) -> list[StringIndexerModel]:
        """H1 + H4 fitted from the counts (same labels as StringIndexer.fit):
        one model per column, features first, the label last."""
        feats = list(self.cfg.feature_cols)
        out = [
            StringIndexerModel.from_labels(arr, inputCol=c, outputCol=idx_col(c), handleInvalid="keep")
            for c, arr in zip(feats, self.arrays)
        ]
        out.append(StringIndexerModel.from_labels(self.labels, inputCol=self.cfg.label_col, outputCol=LABEL, handleInvalid="keep"))
        return out

    @property
    def num_slots(self) -> int:
        return sum(len(a) for a in self.arrays)


def fit_vocabulary(train: DataFrame, cfg: JobConfig, counts: DataFrame | None = None) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and the persisted counts it comes from (labels x vocabulary rows; the caller unpersists), or the given ones.

    To the driver go one row per category, which MLlib's indexer models hold there anyway, and one per class.
    """
    if counts is None:
        counts = vocabulary_counts(train, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    categories = [tuple(r) for r in category_counts(counts).collect()]
    return Vocabulary(categories, [tuple(r) for r in class_counts(counts, cfg).collect()], cfg), counts


def fit_features(train: DataFrame, cfg: JobConfig, counts: DataFrame | None = None):
    """H1-H4 fitted on the training rows: (PipelineModel of indexers, encoder
    and assembler, Vocabulary or None, vocabulary counts or None).

    With ``cfg.fit_from_counts`` the indexers come from one aggregation of
    vocabulary counts and the encoder reads only their metadata (no pass);
    otherwise MLlib's StringIndexer.fit runs.
    """
    from pyspark.ml import Pipeline, PipelineModel

    if not cfg.fit_from_counts:
        return Pipeline(stages=feature_stages(cfg)).fit(train), None, None
    vocab, counts = fit_vocabulary(train, cfg, counts)
    stages = vocab.indexers()
    indexed = train
    for m in stages:
        indexed = m.transform(indexed)
    encoder = one_hot_stage(cfg).fit(indexed)
    return PipelineModel(stages=stages + [encoder, assemble_stage(cfg)]), vocab, counts


def indexer_models(pipeline_model) -> list[StringIndexerModel]:
    return [st for st in pipeline_model.stages if isinstance(st, StringIndexerModel)]


def labels_arrays(pipeline_model) -> list[list[str]]:
    """Label arrays of every indexed column, features first, label last."""
    out = []
    for m in indexer_models(pipeline_model):
        out.extend(list(a) for a in m.labelsArray)
    return out


def apply_indexers(pipeline_model, df: DataFrame) -> DataFrame:
    for m in indexer_models(pipeline_model):
        df = m.transform(df)
    return df


def label_names(pipeline_model) -> list[str]:
    """Training labels in index order (the label is indexed last)."""
    return labels_arrays(pipeline_model)[-1]


def index_to_label(pipeline_model, df: DataFrame) -> DataFrame:
    """H6: predicted index -> class name."""
    return IndexToString(
        inputCol=PREDICTION, outputCol=PREDICTED_LABEL, labels=label_names(pipeline_model)
    ).transform(df)


def category_index_table(counts: DataFrame, cfg: JobConfig, keep: list) -> DataFrame:
    """(feature, category, idx, slot, slot_name) from the vocabulary counts, without a collect of categories.

    ``slot`` is the position in ``features``: the index plus the sizes of the
    blocks before (one size per feature goes to the driver). A feature's categories are ranked over all range
    partitions they fill, so no task reads a whole feature; ``keep`` gets what releases the ranked rows.
    """
    ranked, sizes = position_in_group(category_counts(counts), "feature", _by_frequency("category"), "idx", keep)
    offset, offsets = 0, []
    for c in cfg.feature_cols:
        offsets += [F.lit(c), F.lit(offset)]
        offset += sizes.get(c, 0)
    slot = (F.col("idx") + F.element_at(F.create_map(*offsets), F.col("feature"))).cast("int")
    return ranked.select(
        "feature", "category", F.col("idx").cast("int").alias("idx"), slot.alias("slot"), F.concat("feature", F.lit(vec_col("")), F.lit("_"), "category").alias("slot_name")
    )


def label_index_table(counts: DataFrame, cfg: JobConfig) -> DataFrame:
    """H4: (label, label_idx) of the at most k + 1 classes."""
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*_by_frequency(cfg.label_col))) - 1
    return class_counts(counts, cfg).select(F.col(cfg.label_col), rank.cast("int").alias("label_idx"))


def one_hot_long(indexed: DataFrame, pipeline_model, cfg: JobConfig, key_col: str) -> DataFrame:
    """(key, feature, slot, slot_name) of every active one-hot slot: one narrow projection.

    The slot is the block's offset plus the row's index, its name is the
    row's own value, and an index equal to the block's size (unseen value)
    is the all-zero block.
    """
    offset, blocks = 0, []
    for c, labels in zip(cfg.feature_cols, labels_arrays(pipeline_model)):
        idx = F.col(idx_col(c)).cast("int")
        name = F.concat(F.lit(f"{vec_col(c)}_"), qcol(c))
        blocks.append(F.struct(F.lit(c).alias("feature"), F.when(idx < len(labels), idx + offset).alias("slot"), name.alias("slot_name")))
        offset += len(labels)
    long = indexed.select(F.col(key_col), F.inline(F.array(*blocks)))
    return long.filter(F.col("slot").isNotNull())


def slot_names(pipeline_model, cfg: JobConfig) -> list[str]:
    """Slot names of the fitted model, in slot order: its label arrays are the blocks."""
    return [f"{vec_col(c)}_{v}" for c, labels in zip(cfg.feature_cols, labels_arrays(pipeline_model)) for v in labels]
