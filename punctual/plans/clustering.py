"""From modelling tables to clustered tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators import cluster, encode
from punctual.operators.embedding import WordVectors
from punctual.operators.kmeans import KMeansFit
from punctual.plans import columns as names
from punctual.staging import stage


@dataclass(frozen=True)
class ClusteredSplits:
    frames: dict[str, DataFrame]
    embedding: WordVectors
    scaler: PipelineModel
    model: KMeansFit
    features: DataFrame


def cluster_splits(
    frames: dict[str, DataFrame],
    categories: Sequence[str] = tuple(names.CLUSTER_CATEGORIES),
    numbers: Sequence[str] = tuple(names.NUMBERS),
    k: int = cluster.CLUSTERS,
    key: str = "index",
    train: str = "train",
) -> ClusteredSplits:
    """Embed the categories, scale them with the numbers, cluster the training rows and label every split.

    Word vectors, scales and centres come from the training rows. Category columns stay as they are,
    and the label is carried through the transforms, so no row is joined to itself.
    """
    documents = {name: _documents(df, categories, numbers) for name, df in frames.items()}
    embedding = cluster.fit_embedding(documents[train])
    embedded = {name: embedding.transform(df) for name, df in documents.items()}
    floats = [f"_{n}" for n in numbers]
    scaler = encode.fit_scaler(embedded[train], ["category_vec", *floats], out="features", raw="raw_features")
    scaled = {name: scaler.transform(df) for name, df in embedded.items()}
    # The training vectors are read once per iteration and by the sweep and the silhouette.
    vectors = stage(scaled[train].select(key, "features"), "vectors")
    model = cluster.fit_kmeans(vectors, k=k)
    labelled = {
        name: cluster.assign(model, df, frames[name].columns).drop(*names.CLUSTER_TARGETS)
        for name, df in scaled.items()
    }
    return ClusteredSplits(labelled, embedding, scaler, model, vectors)


def _documents(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    floats = {f"_{n}": F.col(n).cast("float") for n in numbers}
    return encode.tokenise(encode.category_document(df.withColumns(floats), categories))
