"""Queries: training, saving, continuing and restoring the convolutional day network."""

from __future__ import annotations

from dataclasses import fields

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.learning_queries import _NETWORK
from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import with_ctes
from flowmosaic.catalog.tables import SEED, SPEC, event_days, net_weights
from flowmosaic.catalog.tables_queries import key, r
from flowmosaic.operators import network
from flowmosaic.operators.forward import NetWeights, extract_features
from flowmosaic.operators.splits import protocol_split_augment
from flowmosaic.session import shared_dir
from flowmosaic.sources.weights import WeightStore

_SETTINGS = network.NetworkSettings(rate=2e-3, seed=SEED)


def _examples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Augmented train days under a key of their own, and other raw days."""
    examples = protocol_split_augment(event_days(spark, sf_dir), 0.8, SEED)
    named = examples.withColumn("example", F.concat_ws("/", "source_date", "batch"))
    return named.filter("role = 'train'"), named.filter("role = 'test'")


@query()
def net_day_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The convolutional network after 20 steps, on days it has not seen."""
    train, test = _examples(spark, sf_dir)
    state = network.train_network(train, SPEC, "example", 20, _SETTINGS)
    return network.predict_days(test.filter("others IS NOT NULL"), SPEC, state.network, "example")


@query()
def net_training_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and accuracy of every step; the run is saved after step 10 and continued from the stored state."""
    train, _ = _examples(spark, sf_dir)
    store = WeightStore(spark, shared_dir(spark, "weights"))
    store.save(network.train_network(train, SPEC, "example", 10, _SETTINGS))
    return network.trace_table(train, network.train_network(train, SPEC, "example", 10, _SETTINGS, store.restore()))


def _stored(spark: SparkSession) -> WeightStore:
    """Three steps with different weights, two of them retained; the older of these has the fixed weights."""
    store = WeightStore(spark, shared_dir(spark, "weights"), keep=2)
    out = np.zeros((64, network.CLASSES)), np.zeros(network.CLASSES)
    base = net_weights()
    for step, factor in ((6000, 3.0), (7000, 1.0), (8000, 0.5)):
        layers = NetWeights(*[factor * getattr(base, f.name) for f in fields(NetWeights)])
        net = network.DayNetwork(layers, *out)
        zeros = {k: np.zeros_like(v) for k, v in net.arrays().items()}
        store.save(network.TrainingState(net, zeros, zeros, step))
    return store


@query(with_ctes("tensor others", """SELECT date, label, CAST(i AS INTEGER) AS i, round(v, 4) AS value
    FROM net_out JOIN days USING (date)""", _NETWORK))
def extract_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every day from the oldest retained weights."""
    state = _stored(spark).restore("oldest")
    out = extract_features(event_days(spark, sf_dir), SPEC, state.network.layers)
    long = out.select("date", "label", F.posexplode("features").alias("i", "value"))
    return long.select(key(), "label", "i", r("value", 4))
