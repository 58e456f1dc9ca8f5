"""Recall and candidates of the buckets for vectors without clusters, by width."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from tenderlens.llm import nearest  # noqa: E402


@pytest.mark.parametrize("width", [16, 64, 100, 128, 256, 384, 768, 1024])
def test_recall(width):
    index, asked = nearest.Index(), np.arange(150)
    rows = nearest.unit(np.random.default_rng(3).normal(size=(2500, width)))
    own = nearest.buckets(rows, index, 1)[:, :, 0]
    probed = nearest.buckets(rows[asked], index)
    met = np.zeros((len(asked), len(rows)), bool)
    for t in range(index.tables):
        looked = np.zeros((len(asked), 2 << (width - 1).bit_length()), bool)
        looked[asked[:, None], probed[:, t]] = True
        met |= looked[:, own[:, t]]
    scores = rows[asked] @ rows.T
    scores[asked, asked] = -2.0
    recall = np.take_along_axis(met, np.argsort(-scores, axis=1)[:, :5], axis=1).mean()
    print(f"width {width}: {probed.shape[2]} probes, recall {recall:.3f}, candidates {met.mean():.3f}")
    assert recall >= 0.9


def test_probes_of_the_given_table():
    assert nearest.probes_of(nearest.Index(), 64) == 28
