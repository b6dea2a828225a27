"""The language model's arrays by unit: results are those of a row for each token, also where logits are far from zero."""

import numpy as np
import pytest

import skylens.llm.language_model as lm


@pytest.mark.parametrize("scale", [1.0, 400.0])
def test_outputs_by_unit_are_softmaxes_of_the_logits(scale):
    rng = np.random.default_rng(6)
    network = lm.Network(2)
    network.w["classes"] *= np.float32(scale)
    network.w["words"] *= np.float32(scale)
    h = np.tanh(rng.standard_normal((lm.HIDDEN, 90))).astype(np.float32)
    y = rng.integers(0, lm.SHORT + lm.TAIL_CLASSES, 90)
    y[:3] = lm.SHORT, 0, lm.SHORT - 1
    got, d_h, grads = network.outputs(h, y, grad=True)

    def log_softmax(logits):
        logits = logits - logits.max()
        return logits - np.log(np.exp(logits).sum())

    for i, target in enumerate(y.tolist()):
        own = h[:, i].astype(np.float64)
        k = target // lm.CLASS_WORDS if target < lm.SHORT else target - lm.SHORT + lm.HEAD_CLASSES
        want = log_softmax(own @ network.w["classes"].astype(np.float64))[k]
        if target < lm.SHORT:
            want += log_softmax(own @ network.w["words"][k].astype(np.float64))[target % lm.CLASS_WORDS]
        assert got[i] == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert np.isfinite(d_h).all() and all(np.isfinite(g).all() for g in grads.values())
    assert d_h.shape == h.shape and got == pytest.approx(network.output(h.T, y)[0], rel=1e-5, abs=1e-5)
