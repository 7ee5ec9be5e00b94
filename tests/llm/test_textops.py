from __future__ import annotations

import pyarrow as pa
from pyspark import cloudpickle

from tripmart.llm.near_dedup import NearDedup, signature_rows
from tripmart.llm.textops import Words, slices


def test_functions_sent_to_tasks_stay_small_after_use_on_the_driver():
    (_, _, data, offsets) = next(slices(pa.array(["some words of a text " * 1000])))
    assert len(Words(data, offsets).hashes()) == 5000
    assert len(cloudpickle.dumps(signature_rows(NearDedup()))) < 200_000
