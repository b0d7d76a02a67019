"""The language model is as large as the README's held-out likelihood says."""

from __future__ import annotations

from pathlib import Path

import numpy as np

from tidemark.llm import language_model as lm


def test_vectors_and_noise_classes():
    model = lm.Model.fresh(np.ones(lm.CLASSES))
    assert model.target.shape == (lm.CLASSES, 24) and model.context.shape == (lm.ORDER, lm.CLASSES + 1, 24) and lm.NOISE == 64
    assert f"vectors of {lm.WIDTH} numbers and {lm.NOISE} noise classes" in (Path(lm.__file__).parents[2] / "README.md").read_text()
