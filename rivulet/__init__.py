"""rivulet: a Spark-native real-time warehouse layer.

Two jobs, each expressed as DataFrame transforms that run unchanged on batch
and Structured Streaming input:

* the log job   (``rivulet.operators.logs``): JSON log lines -> dirty split ->
  new-visitor flag repair per device -> one-pass fan-out into topics;
* the dimension job (``rivulet.operators.changes/configs/dims``): database
  change records routed by a versioned, CDC-fed configuration into key-value
  dimension tables kept as an append-only cell log plus a fold.
"""

__version__ = "0.1.0"
