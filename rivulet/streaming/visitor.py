"""Streaming new-visitor flag repair: one value state per device.

The state (the device's first-visit DATE) is set once, by the device's first
line, and never changed; there is no TTL unless ``ttl_ms`` is given. Within a
micro-batch a device's lines are not ordered, so for a device without state
the earliest line (by seq) of the batch decides. Only then are the device's
rows of that batch held together; once the state exists, Arrow chunks stream
straight through. A device's rows per batch are bounded by the trigger size
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``). The log job does without
(``jobs.log_batch_writer``); this form is for a state TTL, or for repaired
lines as a stream of their own.
"""

from __future__ import annotations

import sys
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DateType, StructField, StructType

from rivulet.session import ensure_state_store

# The state function and processor below run in executor Python workers.
# Pickle this module's code by value so workers need no installed copy of
# the package (on a cluster it may still be shipped with --py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_SCHEMA = StructType([StructField("first_visit", DateType(), True)])
OUT_SCHEMA = ("seq long, mid string, is_new string, is_new_fixed string, "
              "visit_day date, first_visit date, value string")
IN_COLS = ["seq", "mid", "is_new", "visit_day", "seed_day", "value"]
OUT_COLS = ["seq", "mid", "is_new", "is_new_fixed", "visit_day", "first_visit", "value"]


def _apply(pdf: pd.DataFrame, first_visit) -> pd.DataFrame:
    flag = pdf["is_new"].to_numpy(dtype=object)
    reset = (flag == "1") & (pdf["visit_day"].to_numpy(dtype=object) != first_visit)
    pdf = pdf.assign(is_new_fixed=np.where(reset, "0", flag), first_visit=first_visit)
    return pdf[OUT_COLS]


class FirstVisitProcessor(StatefulProcessor):
    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first_visit", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            fv = self.state.get()[0]
            for pdf in rows:
                yield _apply(pdf, fv)
            return
        batch = pd.concat(list(rows), ignore_index=True)
        fv = batch["seed_day"].iloc[int(batch["seq"].values.argmin())]
        self.state.update((fv,))
        yield _apply(batch, fv)

    def close(self) -> None:
        pass


def _grouped_state_fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The same rule for ``applyInPandasWithState`` (state travels in-band
    with the Arrow batches instead of one call per state access)."""
    if state.exists:
        fv = state.get[0]
        for pdf in pdfs:
            yield _apply(pdf, fv)
        return
    batch = pd.concat(list(pdfs), ignore_index=True)
    fv = batch["seed_day"].iloc[int(batch["seq"].values.argmin())]
    state.update((fv,))
    yield _apply(batch, fv)


def repair_flags_stream(tagged: DataFrame, ttl_ms: int | None = None, api: str = "grouped") -> DataFrame:
    """Tagged lines (streaming) -> OUT_SCHEMA rows with the repaired flag, for
    good lines, keyed by device."""
    ensure_state_store(tagged.sparkSession)
    g = (tagged.where(F.col("dirty_reason").isNull())
         .select(F.col("mid").alias("device"), *IN_COLS).groupBy("device"))
    if api == "grouped" and ttl_ms is None:
        return g.applyInPandasWithState(_grouped_state_fn, OUT_SCHEMA, "first_visit date",
                                        "append", "NoTimeout")
    return g.transformWithStateInPandas(
        statefulProcessor=FirstVisitProcessor(ttl_ms), outputStructType=OUT_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
