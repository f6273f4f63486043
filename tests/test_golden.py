"""Published results on the public mushroom table; set GOLDEN_ARFF to its path to run."""

import os

import numpy as np
import pytest

from clusterloom.operators import evaluate, fekm, kernel_kmeans, pca, prep
from clusterloom.operators.blocks import Blocks
from clusterloom.sources import arff

PATH = os.environ.get("GOLDEN_ARFF")
pytestmark = pytest.mark.skipif(not PATH, reason="GOLDEN_ARFF is not set")

# fixed values: published inertias for k = 2 .. 10 in the plane of two components, and with the RBF kernel
PLANE = (16478.029, 2694.112, 1716.707, 1181.544, 971.674, 820.551, 739.765, 714.683, 571.208)
RBF = (1240.0507, 1184.0259, 925.4655, 869.594, 864.022, 833.1764, 820.008, 799.18, 713.2575)


@pytest.fixture(scope="module")
def mushroom(spark):
    features, model = prep.prepare(arff.read_arff(spark, PATH))  # class = last column
    assert len(model.feature_names) == 111 and model.fills == {"stalk-root": "b"}
    return features.persist()


def test_pca_then_farthest_pair(mushroom):
    flat = pca.fit_pca(mushroom).transform(mushroom, 2)
    fits = fekm.fit_fekm(flat, list(range(2, 11)))
    assert np.allclose([fits[k, "euclidean"].inertia for k in range(2, 11)], PLANE, rtol=1e-6)


def test_original_space(mushroom):
    model = fekm.fit_fekm(Blocks(mushroom), [2])[2, "euclidean"]
    got = evaluate.metric_suite(model.transform(mushroom)).first()
    assert np.isclose(model.inertia, 71904.50782823094)
    assert np.allclose([got["ari"], got["purity"], got["davies_bouldin"], got["f_measure"]], [0.0833097, 0.3874938, 2.0021070, 0.4322054], atol=1e-6)


def test_rbf(mushroom):
    fits = kernel_kmeans.fit_kernel_kmeans(mushroom, list(range(2, 11)))
    assert np.allclose([fits[k].inertia for k in range(2, 11)], RBF, rtol=2e-4)
