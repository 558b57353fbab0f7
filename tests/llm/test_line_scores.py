"""Operator 3: how texts travel to the model and back."""

from __future__ import annotations

import numpy as np

from tests.fixtures import plan_of, rows_of
from torque.llm.line_crf import FEATURES, Model, score


def test_a_text_is_sent_once_within_its_row(spark):
    docs = spark.createDataFrame([(1, "a line\nand one"), (2, None), (3, "")],
                                 "doc_id long, text string")
    scored = score(docs, Model(np.ones(3 * len(FEATURES) + 1), np.zeros((2, 2))))
    sent = next(line for line in plan_of(scored).splitlines() if "Project [" in line and
                "struct(" in line or "named_struct(" in line)
    assert "AS text" not in sent
    found = rows_of(scored, "doc_id", "text", "score", order=["doc_id"])
    assert [r[:2] for r in found] == [(1, "a line\nand one"), (2, None), (3, "")]
    assert found[1][2] == found[2][2]


def test_the_text_may_be_replaced_by_its_score(spark):
    docs = spark.createDataFrame([(1, "a line"), (2, None)], "doc_id long, text string")
    scored = score(docs, Model(np.ones(3 * len(FEATURES) + 1), np.zeros((2, 2))), name="text")
    assert scored.columns == ["doc_id", "text"] and scored.schema["text"].dataType.typeName() == "double"
    assert scored.count() == 2
