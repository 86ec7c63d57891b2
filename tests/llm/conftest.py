from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from stratalake.llm.workers import reach_workers  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(autouse=True)
def _workers(spark):
    reach_workers(spark)


@pytest.fixture
def docs(spark):
    """Rows of documents from (doc_id, text[, lang[, source]]), with columns that clash."""
    def make(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 1, "x", 2, 0.5, True)
            for r in rows
        ]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, "
            "lang_pred string, size long, score double, keep boolean",
        )

    return make
