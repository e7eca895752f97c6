"""All queries of the operators; importing the modules registers them."""

from __future__ import annotations

from gaugeworks.llm import (  # noqa: F401
    context_tree,
    decontaminate,
    jaccard,
    language_centroids,
    lexical,
    licenses,
    line_rules,
    merkle,
    mixing,
    packing,
    quality_net,
    secrets,
    toxicity,
)
from gaugeworks.llm.common import ORACLES, QUERIES  # noqa: F401
